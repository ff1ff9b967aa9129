"""Readers of alignment text, FASTA and region lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.operators.order import last_known
from strandwise.sources.files import materialize, small


def read_lines(spark: SparkSession, path: str | list[str], max_file_bytes: int | None = None) -> DataFrame:
    """(file, line_no, line) of every file; lines end at \\n only, so a \\r stays.

    The text is read once, by one scan, and written with the row ids of that scan; line numbers come from the written ids
    and the written blocks' line counts. Splits, settings and cluster sizes that change later therefore cannot change a
    number or lose a line, and later uses read the written columns. Lines are not shuffled: the counts, a row a block, are
    broadcast up to BROADCAST_ROWS blocks and joined by Spark's choice beyond. `max_file_bytes` leaves out larger files.
    A folder without files gives no lines; one without a readable path raises."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"),
    )
    if max_file_bytes is not None:
        raw = raw.where(F.col("size") <= max_file_bytes)
    raw = materialize(raw.drop("size").withColumn("hash", F.xxhash64("file")), "text")  # 24 bytes a block to broadcast
    blocks = raw.groupBy("hash", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("hash").orderBy("block")) - F.col("n")
    blocks = materialize(blocks.select("hash", "block", (before - F.col("first")).alias("shift")), "blocks")
    return raw.join(small(blocks), ["hash", "block"]).select("file", (F.col("row") + F.col("shift")).alias("line_no"), "line")


def read_region_files(spark: SparkSession, folder: str, max_file_bytes: int | None = None) -> DataFrame:
    """(file, line_no, line) of the files of a folder whose names hold '.sam'; `file` is the bare name.

    What follows '.sam' does not matter; hidden files and folders inside are left out."""
    lines = read_lines(spark, f"{folder.rstrip('/')}/*.sam*", max_file_bytes)
    return lines.withColumn("file", F.substring_index("file", "/", -1))


def file_catalog(spark: SparkSession, path: str, containing: str = "", max_file_bytes: int | None = None) -> DataFrame:
    """(file, name, bytes, state) of every file below a folder, from Spark's file listing alone: no content is read.

    state: empty, skipped (larger than `max_file_bytes`, where it is given) or readable. Scans leave out files of no bytes,
    so names come from the listing (the driver has it for any scan) and sizes from the scan. Names without `containing` and
    hidden files are left out; a folder without files gives no rows."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    sizes = found.select(same("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    names = spark.createDataFrame([(n,) for n in found.inputFiles()], "file string").withColumn("file", same("file"))
    size = F.coalesce("size", F.lit(0).cast("long"))
    state = F.when(size == 0, "empty").when(size > (max_file_bytes if max_file_bytes is not None else (1 << 63) - 1), "skipped").otherwise("readable")
    rows = names.join(sizes, "file", "left").select("file", F.url_decode(F.replace(F.substring_index("file", "/", -1), F.lit("+"), F.lit("%2B"))).alias("name"), size.alias("bytes"), state.alias("state"))
    return rows.where(F.col("name").contains(containing))


def scan_records(lines: DataFrame) -> DataFrame:
    """Lines that duplicate marking reads: no headers, no blank lines; a record ends at \\r as well."""
    cut = lines.where(~X.is_header(F.col("line"))).select(*[c for c in lines.columns if c != "line"], F.posexplode(F.split("line", "\r")).alias("sub", "line"))
    return cut.where((F.col("line") != "") & ~X.is_header(F.col("line")))


def parse(lines: DataFrame) -> DataFrame:
    """Add what duplicate marking needs (flag, rname, pos, rnext, pnext, score, orientation) to record lines."""
    f = X.parts(F.col("line"))
    at = lambda k: F.get("f", F.lit(k))
    rows = lines.withColumn("f", f).withColumn("n_fields", X.n_fields(F.col("line")))
    return rows.select(
        *lines.columns, "n_fields", X.flag_value(at(1)).alias("flag"), at(2).alias("rname"), X.loose_integer(at(3)).alias("pos"),
        at(6).alias("rnext"), X.loose_integer(at(7)).alias("pnext"), X.quality_score(at(10)).alias("score"),
    ).withColumn("orientation", X.orientation(F.col("flag")))


def typed(lines: DataFrame) -> DataFrame:
    """Every field of a line with its type; numbers that do not parse, or do not fit the type, are null."""
    f = F.split(X.without_cr(F.col("line")), "\t", -1)
    at = lambda k: F.get("f", F.lit(k))
    return lines.withColumn("f", f).select(
        *lines.columns, X.line_bytes(F.col("line")).alias("line_bytes"), at(0).alias("qname"), X.strict_integer(at(1)).try_cast("int").alias("flag"), at(2).alias("rname"),
        X.strict_integer(at(3)).alias("pos"), X.strict_integer(at(4)).try_cast("int").alias("mapq"), at(5).alias("cigar"), at(6).alias("rnext"), X.strict_integer(at(7)).alias("pnext"),
        X.strict_integer(at(8)).alias("tlen"), at(9).alias("seq"), at(10).alias("qual"), F.slice("f", F.lit(12), F.greatest(F.size("f"), F.lit(1))).alias("tags"), X.line_kind(F.col("line")).alias("kind"),
    )


def fasta_lengths(lines: DataFrame, wanted: Column | None = None, blanks: bool = False) -> DataFrame:
    """(name, length, ord) of FASTA lines (line_no, line): bytes of sequence, by first appearance of the name.

    Blanks and tabs before a name are skipped; it ends at the next one. `blanks`: blanks and tabs inside sequence lines
    count. Sequence lines before any name are ignored. The name of a line is the nearest one above, carried over blocks of
    lines, so no task gets all of them."""
    head = F.col("line").startswith(">")
    name = F.regexp_extract("line", r"^>[ \t]*([^ \t\r]*)", 1)
    size = F.octet_length(F.regexp_replace("line", r"[\r\n]" if blanks else r"[ \t\r\n]", ""))
    rows = lines.select("line_no", F.when(head, name).alias("own"), F.when(head, 0).otherwise(size).cast("long").alias("size"))
    named = last_known(rows, "line_no", "own", "name").withColumn("at", F.when(F.col("own").isNotNull(), F.col("line_no")))
    out = named.where("name is not null").groupBy("name").agg(F.sum("size").alias("length"), F.min("at").alias("ord"))
    return out if wanted is None else out.where(wanted)


def parse_region_list(lines: DataFrame, most: int | None = S.MAX_LISTED_REGIONS) -> DataFrame:
    """(line_no, chr, region_start, region_end) of a region list; any bad line fails the load, as do more than `most` regions
    (None: any number).

    Blank lines and lines that start with # are skipped; columns beyond the third are ignored."""
    rows = lines.withColumn("t", F.regexp_replace("line", r"^[ \t\r\n]+|[ \t\r\n]+\z", "")).where((F.col("t") != "") & ~F.col("t").startswith("#"))
    f = F.split("t", r"[ \t]+")
    start, end = (F.when(F.get(f, F.lit(k)).rlike(r"^[+-]?[0-9]+\z"), F.get(f, F.lit(k)).try_cast("long")) for k in (1, 2))
    checked = rows.select("line_no", "line", F.get(f, F.lit(0)).alias("chr"), start.alias("region_start"), end.alias("region_end"))
    good = (F.size(f) >= 3) & F.coalesce((start >= 1) & (start <= end), F.lit(False))
    bad = rows.where(~good).select("line").take(1)
    if bad:
        raise ValueError(f"bad region line: {bad[0][0]!r}")
    if most is not None and checked.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} regions")
    return checked.select("line_no", "chr", "region_start", "region_end")


def region_of_name(name: Column) -> Column:
    """struct(chr, region_start, region_end) of a file name chr_start_end[_more].sam..., null where it does not fit."""
    f = F.split(X.stem(name), "_")
    number = lambda k: F.when(F.get(f, F.lit(k)).rlike(r"^[+-]?[0-9]+\z"), F.get(f, F.lit(k)).try_cast("long"))
    start, end = number(1), number(2)
    ok = name.contains(".sam") & (F.size(f) >= 3) & F.coalesce((start > 0) & (start <= end), F.lit(False))
    return F.when(ok, F.struct(F.get(f, F.lit(0)).alias("chr"), start.alias("region_start"), end.alias("region_end")))
