"""Validation of region files and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.operators.order import with_coordinates
from strandwise.operators.regions import placed_reads
from strandwise.sources.files import materialize, small
from strandwise.sources.text import region_of_name


def declared(lines: DataFrame) -> DataFrame:
    """(file, chr, region_start, region_end) of the files whose names declare a region.

    The names are written first, a row a file, so that a name is parsed once and not for each of its lines."""
    names = materialize(lines.select("file").distinct(), "names")
    return names.withColumn("region", region_of_name(F.col("file"))).where("region is not null").select("file", "region.*")


def declared_files(catalog: DataFrame) -> DataFrame:
    """What `declared` gives, for the files of a catalogue (name): also those without a line."""
    return catalog.select(F.col("name").alias("file"), region_of_name(F.col("name")).alias("region")).where("region is not null").select("file", "region.*")


def file_outcomes(catalog: DataFrame, counted: DataFrame) -> DataFrame:
    """(name, bytes, outcome) of catalogued files, each once: read, skipped (too large), failed (its counters are not ok),
    empty, or unnamed (its name declares no region). counted: file (the bare name) and ok, of region_check."""
    rows = catalog.join(counted.select(F.col("file").alias("name"), "ok"), "name", "left")
    outcome = F.when(F.col("state") == "skipped", "skipped").when(F.col("ok").isNull(), "unnamed").when(F.col("state") == "empty", "empty").when(F.col("ok"), "read").otherwise("failed")
    return rows.select("name", "bytes", outcome.alias("outcome"))


def judged(lines: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Add to the lines of region files (file, line_no, line) what the file's name declares and a verdict `kind`:

    unparsed, unmapped, bad_chr, bad_range or good; headers and blank lines are left out, as are files whose names
    declare no region. `names`: what `declared` gives, where it is known."""
    body = lines.select("file", "line_no", X.without_cr(F.col("line")).alias("line")).where((F.col("line") != "") & ~X.is_header(F.col("line")))
    rows = with_coordinates(body).join(small(declared(lines) if names is None else names), "file")
    rows = rows.select("file", "line_no", "line", "rname", "pos", "valid", "chr", "region_start", "region_end")
    kind = (
        F.when(~F.col("valid"), "unparsed")
        .when((F.col("rname") == S.UNSET) | (F.col("pos") <= 0), "unmapped")
        .when(F.col("rname") != F.col("chr"), "bad_chr")
        .when(~F.col("pos").between(F.col("region_start"), F.col("region_end")), "bad_range")
        .otherwise("good")
    )
    return rows.withColumn("kind", kind)


def region_check(lines: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Counters of each file and whether it passes; a file without records passes with nothing counted.

    A file without a single line is not among `lines` and so not here, unless `names` (of `declared`) has it."""
    names = declared(lines) if names is None else names
    count = lambda *kinds: F.count_if(F.col("kind").isin(*kinds))
    counted = judged(lines, names).groupBy("file").agg(
        F.count(F.lit(1)).alias("total"), count("bad_chr", "bad_range", "good").alias("checked"), count("bad_chr").alias("bad_chr"),
        count("bad_range").alias("bad_range"), count("unparsed", "unmapped").alias("unmapped_or_zero"), (count("bad_chr", "bad_range") == 0).alias("ok"),
    )
    return names.select("file").join(counted, "file", "left").fillna(0).fillna(True, ["ok"])  # a row a file


def region_check_errors(lines: DataFrame, most: int = S.MAX_MESSAGES) -> DataFrame:
    """(file, line_no, kind, rn): the first `most` messages of each file."""
    bad = judged(lines).where(F.col("kind").isin("unparsed", "bad_chr", "bad_range"))
    rn = F.row_number().over(Window.partitionBy("file").orderBy("line_no"))
    return bad.select("file", "line_no", "kind", rn.cast("long").alias("rn")).where(F.col("rn") <= most)


def region_catalog(names: DataFrame) -> DataFrame:
    """(chr, region_start, region_end) that the names (column name) declare, each once."""
    return names.select(region_of_name(F.col("name")).alias("r")).where("r is not null").select("r.*").distinct()


def line_kinds(lines: DataFrame) -> DataFrame:
    return lines.groupBy(X.line_kind(F.col("line")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def load_stats(lines: DataFrame, chroms: DataFrame) -> DataFrame:
    """(total, used): lines that are no header, blank ones included, and used reads among them; one scan."""
    rows = placed_reads(lines, chroms)
    return rows.agg(F.count_if(~X.is_header(F.col("line"))).alias("total"), F.count_if("used").alias("used"))
