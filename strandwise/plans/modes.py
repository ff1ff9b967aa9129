"""The composite flows: sort, mark duplicates, both, and the region tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.operators import checks as C
from strandwise.operators import duplicates as D
from strandwise.operators import order as O
from strandwise.operators import regions as R
from strandwise.sources.files import materialize, small, write_region_files, write_region_list
from strandwise.sources.named import write_named_files
from strandwise.sources.text import file_catalog, parse, read_region_files, scan_records


def sort_lines(lines: DataFrame, policy: str = S.COMPAT) -> DataFrame:
    """Every line, in coordinate order."""
    return O.coordinate_sort(lines, policy)


def named_records(parsed: DataFrame) -> DataFrame:
    """Parsed lines as the dictionary counts them: a name in the last field that an empty one ends is none."""
    return parsed.withColumns({c: F.when(F.col("n_fields") > k, F.col(c)) for c, k in (("rname", 2), ("rnext", 6))})


def mark_lines(lines: DataFrame, policy: str = S.COMPAT, most_names: int | None = None, presorted: bool = False) -> DataFrame:
    """Records with tid, mate_tid, score, is_dup, flag_out and line_out.

    presorted: arrival is the coordinate order of the lines rather than their order in the file. Inside a duplicate
    key both agree, so only the numbering of names differs."""
    parsed = parse(scan_records(lines))
    arrival = ["line_no"]
    if presorted:
        parsed = O.with_coordinates(parsed.withColumnsRenamed({"rname": "name", "pos": "place"})).withColumnsRenamed({"rname": "c_rname", "pos": "c_pos", "name": "rname", "place": "pos", "valid": "c_valid"})
        arrival = ["c_valid", "c_rname", "c_pos", "line_no"]
    names = O.reference_dictionary(named_records(parsed), arrival, most_names)
    marked = D.mark_duplicates(D.records(parsed), policy, names=names if most_names is not None else None)
    out = D.with_tids(marked, names)
    return out.withColumn("line_out", X.rewritten(F.col("line"), F.col("flag_out")))


def named_outputs(names: DataFrame, mode: str) -> DataFrame:
    """(file, name): the output's name of each input; two inputs with one name raise. names: file, a row a file."""
    named = materialize(names.select("file", X.output_name(F.substring_index("file", "/", -1), mode).alias("name")), "named")
    twice = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("one"), F.max("file").alias("other")).where("n > 1").first()
    if twice:
        raise ValueError(f"{twice.one} and {twice.other} would both be written as {twice.name}")
    return named


def process_files(lines: DataFrame, path: str, mode: str, policy: str = S.COMPAT, write_mode: str = "errorifexists") -> DataFrame:
    """Sort ('sort'), mark ('markdup') or do both ('all') to each file of (file, line_no, line) by itself and write it.

    An input with lines gets one file of its output's name under `path`. Returns (file, name, n_lines). `lines` are read
    several times: pass written ones, such as read_lines gives."""
    named = named_outputs(lines.select("file").distinct(), mode)
    if mode == "sort":
        out = O.with_coordinates(lines, policy == S.STRICT)
        order = O.COORDINATE_ORDER
    else:
        out, order = mark_file(lines, policy, presorted=mode == "all"), ["section", *MARKED_ORDER]
    out = out.join(small(named), "file").select("name", *order, "line")
    done = write_named_files(out, path, "name", order, write_mode)
    return named.join(done.select("name", F.col("lines").alias("n_lines")), "name", "left").select("file", "name", "n_lines").fillna(0)


MARKED_ORDER = ["tid", "pos", "mate_tid", "pnext", "orientation", "line_no"]


def mark_file(lines: DataFrame, policy: str = S.COMPAT, presorted: bool = False) -> DataFrame:
    """(section, sort columns, line): the header block, then the marked records; write ordered by all but line."""
    marked = mark_lines(lines, policy, presorted=presorted)
    head = D.header_block(O.with_coordinates(lines), tuple(O.COORDINATE_ORDER)) if presorted else D.header_block(lines)
    zero = [F.lit(0).cast("long").alias(c) for c in MARKED_ORDER[:-1]]
    files = ["file"] if "file" in lines.columns else []
    head = head.select(*files, F.lit(0).alias("section"), *zero, "line_no", "line")
    body = marked.select(*files, F.lit(1).alias("section"), *MARKED_ORDER, F.col("line_out").alias("line"))
    return head.unionByName(body)


def weighted_regions(lines: DataFrame, chroms: DataFrame, target: int = S.TARGET_BYTES, carry: bool = False) -> DataFrame:
    return R.greedy_regions(R.bin_weights(R.used_reads(lines, chroms)), chroms, target, carry=carry)


def weighted_split(lines: DataFrame, chroms: DataFrame, target: int = S.TARGET_BYTES) -> DataFrame:
    """Used reads with their weighted region; the reads are found once and written."""
    used = materialize(R.used_reads(lines, chroms), "used")
    return R.assign(used.drop("length"), R.greedy_regions(R.bin_weights(used), chroms, target))


def write_tiles(lines: DataFrame, chroms: DataFrame, path: str, tiles: int = S.TILES, mode: str = "errorifexists") -> DataFrame:
    """Write the reads of each equal tile (`files`, a file chr_start_end_rid.sam each, in input order and without headers;
    tiles without reads have an empty one) and the list of all tiles (`list`); returns the tiles."""
    found = materialize(R.static_regions(chroms, tiles), "tiles")
    placed = tiled_split(lines, chroms, tiles).select("rid", "line_no", "line").join(small(found), "rid")
    write_region_files(placed, None, f"{path}/files", [*R.REGION, "rid"], every=found, mode=mode)
    write_region_list(found, f"{path}/list", " ", mode)
    return found


def check_folder(spark: SparkSession, folder: str, max_file_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Counters of each region file of a folder, also of empty ones, and the outcome of every file there.

    Files of any size are read. Where `max_file_bytes` is given, larger ones are not, and have no counters."""
    catalog = materialize(file_catalog(spark, folder, ".sam", max_file_bytes), "catalog")
    lines = read_region_files(spark, folder, max_file_bytes)
    checked = materialize(C.region_check(lines, C.declared_files(catalog.where("state <> 'skipped'"))), "checked")
    return checked, C.file_outcomes(catalog, checked)


def write_fates(lines: DataFrame, regions: DataFrame, path: str, policy: str = S.COMPAT, mode: str = "errorifexists") -> DataFrame:
    """Write every line once, in a folder of its fate (see regions.fates) with the region of placed ones, as Parquet; one
    pass. strict: malformed lines raise once all is written, so that they can be looked at. Returns (fate, n)."""
    R.fates(lines, regions).select("fate", F.when(F.col("region_start").isNotNull(), F.concat_ws("_", *R.REGION)).alias("region"), "line_no", "line").write.mode(mode).partitionBy("fate").parquet(path)
    counts = lines.sparkSession.read.schema("region string, line_no long, line string, fate string").parquet(path).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))
    if policy == S.STRICT and (bad := counts.where("fate = 'malformed'").first()):
        raise ValueError(f"{bad.n} malformed lines, in {path}/fate=malformed")
    return counts


def tiled_split(lines: DataFrame, chroms: DataFrame, tiles: int = S.TILES) -> DataFrame:
    return R.static_assign(lines, chroms, tiles).where("rid is not null")
