"""Coordinate order, gapless numbering of a total order, and the reference dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.sources.files import left_join_counted, materialize, sort_ranges


def numbered(df: DataFrame, order: list, name: str, keep: list[str] | None = None) -> DataFrame:
    """Number all rows from 0 in the order of the columns, without a single-task window.

    Rows are counted, range-partitioned into as many ranges as their number asks for, sorted and written with their
    partition and place, so that both are fixed; the partitions' counts (a row a partition) are broadcast and give the
    offsets. `keep`: the columns that are written, where not all are."""
    rows = df.repartitionByRange(sort_ranges(df.sparkSession, df.count()), *order).sortWithinPartitions(*order).select(*keep or df.columns)
    rows = materialize(rows.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()), "numbered")
    counts = rows.groupBy("__p").agg(F.min("__m").alias("__first"), F.count(F.lit(1)).alias("__n"))
    shift = F.sum("__n").over(Window.orderBy("__p")) - F.col("__n") - F.col("__first")
    return rows.join(F.broadcast(counts.select("__p", shift.alias("__s"))), "__p").withColumn(name, F.col("__m") + F.col("__s")).drop("__p", "__m", "__s")


def numbered_in(df: DataFrame, groups: list[str], order: list, name: str) -> DataFrame:
    """Number the rows of each group from 0 in the order of the columns; no group is brought to one task.

    All rows are numbered by (groups, order); a group's least number, from a partial aggregate, is taken off. Group columns
    hold no nulls."""
    rows = numbered(df, [*groups, *order], "__no")
    first = materialize(rows.groupBy(*groups).agg(F.min("__no").alias("__least"), F.count(F.lit(1)).alias("__size")), "groups")
    return left_join_counted(rows, first, groups, "__size").withColumn(name, F.col("__no") - F.col("__least")).drop("__no", "__least")


_DIGIT = 16  # bits of a level


def last_known(df: DataFrame, at: str, value: str, name: str) -> DataFrame:
    """Add the nearest value that is not null at or above each row, by the row numbers `at` (0 or more, below 2^48).

    Numbers are cut into blocks of 65 536, blocks into blocks of blocks, and those again; each level carries its last known
    value on inside groups of 65 536 rows at most, so no window and no task gets all rows, whatever the values are."""
    block, above = F.shiftright(at, _DIGIT), F.shiftright("__b", _DIGIT)
    rows = df.withColumn("__b", block)

    def closing(level: DataFrame, key: str, up: Column, known: str) -> DataFrame:
        last = level.where(F.col(known).isNotNull()).groupBy(up.alias("__up")).agg(F.max_by(known, key).alias("__v"))
        return level.select(up.alias("__up")).distinct().join(last, "__up", "left")

    def before(groups: Column, key: str) -> Column:
        return F.last("__v", True).over(Window.partitionBy(groups).orderBy(key).rowsBetween(Window.unboundedPreceding, -1))

    blocks = materialize(closing(rows, at, block, value).withColumnRenamed("__up", "__b"), "blocks")  # a row for 65 536
    supers = closing(blocks, "__b", above, "__v").withColumnRenamed("__up", "__s")
    supers = supers.select("__s", before(F.shiftright("__s", _DIGIT), "__s").alias("__w"))
    carried = blocks.select("__b", above.alias("__s"), before(above, "__b").alias("__c")).join(supers, "__s").select("__b", F.coalesce("__c", "__w").alias("__c"))
    inside = F.last(value, True).over(Window.partitionBy("__b").orderBy(at))
    return rows.withColumn("__i", inside).join(carried, "__b").withColumn(name, F.coalesce("__i", "__c")).drop("__b", "__i", "__c")


def with_coordinates(lines: DataFrame, headers_first: bool = False) -> DataFrame:
    """Add rname, pos and valid by the strict parse; what does not parse has null coordinates.

    A header line whose fourth field is an integer counts as a record unless `headers_first`."""
    f = F.split("line", "\t", 5)
    rows = lines.withColumn("rname", F.get(f, F.lit(2))).withColumn("pos", X.strict_integer(F.get(f, F.lit(3))))
    valid = F.col("pos").isNotNull()
    if headers_first:
        valid = valid & ~X.is_header(F.col("line"))
    rows = rows.withColumn("valid", valid)
    return rows.withColumns({c: F.when(F.col("valid"), F.col(c)) for c in ("rname", "pos")})


COORDINATE_ORDER = ["valid", "rname", "pos", "line_no"]


def coordinate_sort(lines: DataFrame, policy: str = S.COMPAT) -> DataFrame:
    """Lines in coordinate order: what has no coordinates first, then by name bytewise, position and line number.

    One range exchange; on several files, each keeps its own order under `file`."""
    rows = with_coordinates(lines, policy == S.STRICT)
    order = (["file"] if "file" in lines.columns else []) + COORDINATE_ORDER
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def reference_dictionary(records: DataFrame, arrival: list[str], most: int | None = None) -> DataFrame:
    """([file,] name, tid): names of RNAME and RNEXT numbered by first appearance, from 0.

    records: rname, rnext and the `arrival` columns. '*' and '=' are no names. Beyond `most` names the tid is -1. Records are
    read once: the first of each pair of names by a partial aggregate, then the names of the pairs."""
    files = [c for c in ("file",) if c in records.columns]
    pairs = records.groupBy(*files, "rname", "rnext").agg(F.min(arrival[0] if len(arrival) == 1 else F.struct(*arrival)).alias("at"))
    names = pairs.select(*files, "at", F.explode(F.array(F.struct(F.col("rname").alias("name"), F.lit(0).alias("side")), F.struct(F.col("rnext").alias("name"), F.lit(1).alias("side")))).alias("x"))
    names = names.select(*files, "at", "x.name", "x.side").where("name is not null and name <> '*' and not (side = 1 and name = '=')")
    seen = materialize(names.groupBy(*files, "name").agg(F.min(F.struct("at", "side")).alias("first")), "names")  # a row a name
    seen = numbered_in(seen, files, ["first"], "tid") if files else numbered(seen, ["first"], "tid")
    tid = F.col("tid") if most is None else F.when(F.col("tid") < most, F.col("tid")).otherwise(-1)
    return seen.select(*files, "name", tid.cast("long").alias("tid"))
