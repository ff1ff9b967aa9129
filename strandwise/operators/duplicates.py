"""Duplicate marking.

Records of one key (name, position, mate name, mate position, orientation) form a group. The first eligible record
leads; of those from the leader on, the best score survives and the earliest wins ties. The parsed records are written
once; the decisions are partial aggregates over the key, FLAG, score and arrival alone, and only keys of two records or
more have a decision to join back. A key that very many records share, such as all unplaced reads, is broadcast to its
records and never gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.sources.files import left_join_counted, materialize, small

KEY = ["rname", "pos", "mate", "pnext", "orientation"]
_ARRIVAL_BITS = 46  # with 16 bits of score one long; line numbers stay below 2^46


def records(parsed: DataFrame) -> DataFrame:
    """Parsed lines that duplicate marking keeps (11 fields or more), with the mate's name."""
    return parsed.where(F.col("n_fields") >= S.MIN_FIELDS).withColumn("mate", X.mate_name(F.col("rname"), F.col("rnext")))


def mark_duplicates(rows: DataFrame, policy: str = S.COMPAT, arrival: str = "line_no", names: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Add is_dup and flag_out to `records`.

    compat: unmapped, secondary and supplementary records cannot lead, but compete behind a leader. strict: they neither
    compete nor are marked. A bit set before stays set. `names` (name, tid): a dictionary with a cap, whose names of
    tid -1 count as '*'. `hot_rows`: see left_join_counted. No rows give no rows; columns that begin with __ are the
    engine's own."""
    files = [c for c in ("file",) if c in rows.columns]
    rows = materialize(rows, "records")
    if names is not None:
        over = names.where("tid < 0").select(*files, F.col("name"), F.lit(True).alias("over"))
        for c in ("rname", "mate"):
            rows = rows.join(small(over.withColumnRenamed("name", c)), [*files, c], "left").withColumn(c, F.when(F.col("over"), F.lit(S.UNSET)).otherwise(F.col(c))).drop("over")
    key = files + KEY
    eligible = F.col("flag").bitwiseAND(F.lit(S.NOT_PRIMARY)) == 0
    rank = F.shiftleft("score", _ARRIVAL_BITS) + (F.lit((1 << _ARRIVAL_BITS) - 1) - F.col(arrival))
    # rows of equal keys have equal hashes; nulls in a key are values of their own
    hashed = [F.xxhash64(*key).alias("__k1"), F.xxhash64(*reversed(key), F.lit(7)).alias("__k2")]
    narrow = rows.select(*hashed, F.col(arrival).alias("__at"), eligible.alias("__eligible"), rank.alias("__rank"))
    pair = ["__k1", "__k2"]
    groups = narrow.groupBy(*pair).agg(
        F.count(F.lit(1)).alias("__n"), F.min(F.when(F.col("__eligible"), F.col("__at"))).alias("__lead"), F.max(F.when(F.col("__eligible"), F.col("__rank"))).alias("__best")
    )
    groups = materialize(groups.where("__n > 1"), "groups")
    if policy == S.COMPAT:  # what is not eligible competes behind the leader
        others = left_join_counted(narrow.where("not __eligible"), groups.select(*pair, "__n", "__lead"), pair, "__n", hot_rows).where("__at > __lead")
        others = others.groupBy(*pair).agg(F.max("__rank").alias("__other"))
        groups = materialize(groups.join(others, pair, "left").withColumn("__best", F.greatest("__best", "__other")).drop("__other"), "decisions")
    joined = left_join_counted(rows.select("*", *hashed, eligible.alias("__eligible"), rank.alias("__rank")), groups, pair, "__n", hot_rows)
    competes = F.col("__eligible") if policy == S.STRICT else F.col(arrival) >= F.col("__lead")
    is_dup = competes & (F.col("__rank") < F.col("__best"))
    out = joined.withColumn("is_dup", F.coalesce(is_dup, F.lit(False)))
    flag_out = F.when(F.col("is_dup"), F.col("flag").bitwiseOR(F.lit(S.FLAG_DUPLICATE))).otherwise(F.col("flag"))
    return out.withColumn("flag_out", flag_out).select(*rows.columns, "is_dup", "flag_out")


def duplicate_groups(marked: DataFrame) -> DataFrame:
    """Size and number of duplicates of each key."""
    files = [c for c in ("file",) if c in marked.columns]
    return marked.groupBy(*files, *KEY).agg(F.count(F.lit(1)).alias("group_size"), F.count_if("is_dup").alias("n_dup"))


def with_tids(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Add tid and mate_tid (-1 for '*'); the dictionary is a row a name."""
    files = [c for c in ("file",) if c in rows.columns and c in names.columns]
    out, size = rows, names.count()
    for c, t in (("rname", "tid"), ("mate", "mate_tid")):
        out = out.join(small(names.select(*files, F.col("name").alias(c), F.col("tid").alias(t)), size), [*files, c], "left").withColumn(t, F.coalesce(t, F.lit(-1).cast("long")))
    return out


def header_block(lines: DataFrame, order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """The unbroken run of header lines at the start of each file, its lines in `order`."""
    files = ["file"] if "file" in lines.columns else ["__all"]
    rows = (lines if "file" in lines.columns else lines.withColumn("__all", F.lit(0))).withColumn("__at", F.struct(*order))
    other = rows.where(~X.is_header(F.col("line"))).groupBy(*files).agg(F.min("__at").alias("__end"))  # a row a file
    joined = rows.join(other, files, "left")
    return joined.where(X.is_header(F.col("line")) & (F.col("__end").isNull() | (F.col("__at") < F.col("__end")))).select(*lines.columns)
