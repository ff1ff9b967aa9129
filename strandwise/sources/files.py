"""Writers: text files with a header block, region files and region lists; tables in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandwise.functions.fields import line_bytes


def write_lines(lines: DataFrame, path: str, order: list[str], mode: str = "errorifexists") -> None:
    """Write lines in order, LF-ended; part files follow the order. mode 'overwrite' empties the folder first."""
    materialize(lines, "lines").repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.mode(mode).text(path)


RANGE_BYTES = 64 << 20  # of lines that one task sorts, in about three times as much memory, and writes


def write_named(rows: DataFrame, path: str, name: str, order: list[str], size: int, mode: str = "errorifexists") -> None:
    """One folder `name=value` for each value of the column `name`: its lines in order, LF-ended.

    `rows` are written ones (ranges are found before rows are dealt) of `size` bytes. They are dealt by ranges of (name,
    order), so a value with very many lines becomes several part files, which follow the order, and small ones share a
    task."""
    columns = [name, *order]
    ranges = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // RANGE_BYTES))
    rows.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns).select(name, "line").write.mode(mode).partitionBy(name).text(path)


def write_region_files(assigned: DataFrame, headers: DataFrame | None, path: str, keys: list[str], every: DataFrame | None = None, mode: str = "errorifexists", layout: str = "files") -> DataFrame | None:
    """A file `<keys joined by _>.sam` for each region: the full header, then its lines in input order.

    assigned: keys, line_no, line. `every` (keys): regions that get a file even if no line is theirs. Returns (name, bytes,
    lines) of the files. layout 'folders' gives a folder `region=<keys>` of part files instead, for stores that only Spark
    reaches; there a region without lines and header has none."""
    region = F.concat_ws("_", *(F.col(k).cast("string") for k in keys)).alias("region")
    rows, seen = measured(assigned.select(region, F.lit(1).alias("section"), "line_no", "line"), "assigned", bytes=F.sum(line_bytes(F.col("line"))))
    size = seen["bytes"] or 0
    if headers is not None:
        used = rows.select("region") if every is None else rows.select("region").unionByName(every.select(region))
        used = materialize(used.distinct(), "used")  # a row a region
        head, facts = measured(headers.select("line_no", "line"), "headers", n=F.count(F.lit(1)), bytes=F.sum(line_bytes(F.col("line"))))
        size += used.count() * (facts["bytes"] or 0)
        rows = rows.unionByName(used.crossJoin(small(head, facts["n"])).select("region", F.lit(0).alias("section"), "line_no", "line"))
    if layout == "folders":
        return write_named(rows, path, "region", ["section", "line_no"], size, mode)
    from strandwise.sources.named import write_named_files

    file = lambda df: df.withColumn("region", F.concat("region", F.lit(".sam")))
    return write_named_files(file(rows), path, "region", ["section", "line_no"], mode, None if every is None else file(every.select(region)), size=size)


def write_region_list(regions: DataFrame, path: str, sep: str = "\t", mode: str = "errorifexists") -> None:
    """chr, start and end of each region, a row a region, by number (`rid`) if there is one, else by chr, start and end."""
    cols = ["chr", "region_start", "region_end"]
    order = (["rid"] if "rid" in regions.columns else []) + cols
    regions.select(*order).coalesce(1).sortWithinPartitions(*order).select(*cols).write.mode(mode).option("sep", sep).csv(path)


def scratch_path(spark, label: str) -> str:
    """A new folder name in the cluster's shared folder (spark.checkpoint.dir), deleted when the driver ends.

    Where it is unset, a session on one machine takes a temporary folder; a cluster's has no folder that all can see."""
    import tempfile
    import uuid

    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strandwise-"))
        base = context.getCheckpointDir()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Folders that scratch_path gives inside are deleted at the end, so that a long session keeps no intermediate tables.

    For work that ends in written outputs: frames that were made inside cannot be read afterwards."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once in the shared folder and read it again: later uses neither recompute it nor read more columns
    than they need, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SORT_ROWS = 500_000  # rows that one task sorts: 100 to 200 MB
FEW_ROWS = 10_000  # rows that are not worth a task of their own


def sort_ranges(spark: SparkSession, rows: int) -> int:
    """Partitions in which so many rows are sorted. Spark merges partitions by their compressed bytes unless their number is
    given, and a sort of 64 MB of those takes several times as much memory, or spills."""
    return max(1, -(-rows // SORT_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // FEW_ROWS)))


def measured(df: DataFrame, label: str, **facts: Column) -> tuple[DataFrame, dict]:
    """`df` materialised, and aggregates over it that are taken while it is written."""
    seen = Observation()
    return materialize(df.observe(seen, *(c.alias(n) for n, c in facts.items())), label), seen.get


BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A join side that is broadcast where it has at most BROADCAST_ROWS rows (counted unless given); else Spark's choice."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


HOT_ROWS = 200_000  # rows of one key that one task may get


def left_join_counted(rows: DataFrame, facts: DataFrame, key: list[str], n: str, hot_rows: int | None = None) -> DataFrame:
    """`rows` left-joined with written `facts`, a row a key with its number of rows `n`, which goes.

    Few facts are broadcast. Else the keys of more than `hot_rows` rows are (so few that they fit in BROADCAST_ROWS), and
    their rows stay where they are; only the rest is shuffled by key."""
    size, total = facts.agg(F.count(F.lit(1)), F.coalesce(F.sum(n), F.lit(0))).first()
    if size <= BROADCAST_ROWS and hot_rows is None:
        return rows.join(F.broadcast(facts.drop(n)), key, "left")
    hot_rows = max(hot_rows or HOT_ROWS, total // BROADCAST_ROWS)
    hot = facts.where(F.col(n) > hot_rows).drop(n)
    known = F.broadcast(hot.select(*key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(known, key, "left_anti").join(facts.where(F.col(n) <= hot_rows).drop(n), key, "left"))
