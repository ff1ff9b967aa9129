"""K-d tree sharding: split at weighted medians along the widest metadata dimension until leaves reach the target bytes.

The rows' metadata (no texts) are written once. Each level needs two small aggregates: the extent of every open node in
every dimension, and byte histograms of every node along its widest one (value bins, then hash bins inside the bin with
the median, so ties, even a value that a third of all rows share, are split too). All bins are summed on the map side
first; the cuts, one row a node, are joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandwise.operators.order import numbered

from .common import gapless_rank, materialize, utf8_crc32

BINS = 4096
BROADCAST_ROWS = 1_000_000  # distinct values; more are joined by shuffling
MOST_LEVELS = 62  # bits of a node


def text_number(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Replace a string column by `name`: the place of the whole string among the distinct ones, from 1; null is 0."""
    values = materialize(rows.select(column).where(F.col(column).isNotNull()).distinct(), "values")
    places = numbered(values, [column], "__at").select(column, (F.col("__at") + 1).cast("double").alias(name))
    places = F.broadcast(places) if values.count() <= BROADCAST_ROWS else places
    return rows.join(places, column, "left").fillna(0.0, [name]).drop(column)


def number(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def kd_shards(rows: DataFrame, dims: list[str], weight: str, target: int | None = None, levels: int | None = None, tie: str = "tie") -> DataFrame:
    """Add `node` (long: the path of cuts as bits) to `rows`, which are written once.

    dims: double columns without nulls; weight: bytes, at least 1; tie: a long, spread evenly, that splits equal values.
    Every node is cut `levels` times, or as long as it is above `target` bytes and a cut can part its rows; a leaf that is
    done before others has its path filled up with zeros. Each cut leaves half of a
    node's bytes, less at most what the bin of the median holds of ties in value and hash, on either side."""
    nodes = materialize(rows.withColumn("node", F.lit(0).cast("long")), "metadata")
    total = nodes.agg(F.sum(weight), *(F.max(d) - F.min(d) for d in dims)).first()
    found_nodes = 0
    extents = [float(x or 0) or 1.0 for x in total[1:]]
    spread = F.shiftrightunsigned(F.xxhash64(tie), 1)
    for _ in range((MOST_LEVELS if levels is None else levels) if total[0] else 0):
        stats = nodes.groupBy("node").agg(F.sum(weight).alias("bytes"), *(f(d).alias(f"{n}_{k}") for k, d in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))))
        if levels is None:
            state = stats.agg(F.count(F.lit(1)), F.max("bytes")).first()  # no new node: what is left cannot be parted
            if state[1] <= target or state[0] == found_nodes:
                break
            found_nodes, stats = state[0], stats.where(F.col("bytes") > target)
        width = F.greatest(*(F.struct(((F.col(f"hi_{k}") - F.col(f"lo_{k}")) / F.lit(e)).alias("w"), F.lit(-k).alias("k")) for k, e in enumerate(extents))) if len(dims) > 1 else F.struct(F.lit(0.0).alias("w"), F.lit(0).alias("k"))
        dim = -width["k"]
        pick = lambda n: F.coalesce(*(F.when(dim == k, F.col(f"{n}_{k}")) for k in range(len(dims))))
        stats = stats.select("node", dim.alias("dim"), pick("lo").alias("lo"), pick("hi").alias("hi"))
        value = F.coalesce(*(F.when(F.col("dim") == k, F.col(d)) for k, d in enumerate(dims)))
        placed = nodes.join(stats, "node").withColumn("value", value)
        share = (F.col("value") - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)
        placed = placed.withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("long"))
        coarse = _median(placed.groupBy("node", "bin").agg(F.sum(weight).alias("w"), F.min("value").alias("vlo"), F.max("value").alias("vhi")), "bin")
        coarse = materialize(coarse.select("node", F.col("at").alias("bin0"), "half", F.col("below").alias("below0"), "vlo", "vhi"), "coarse")
        # inside the bin of the median: by value where it varies, and by hash among equal values
        inside = placed.join(coarse, "node").where("bin = bin0")
        fine = F.when(F.col("vhi") > F.col("vlo"), F.floor((F.col("value") - F.col("vlo")) / (F.col("vhi") - F.col("vlo")) * (BINS - 1))).otherwise(F.lit(0)).cast("long")
        inside = inside.withColumn("fine", fine)
        middle = _median(inside.groupBy("node", "fine").agg(F.sum(weight).alias("w"), F.first("half").alias("half0"), F.first("below0").alias("below0")), "fine", "half0", "below0")
        middle = materialize(middle.select("node", F.col("at").alias("fine0"), F.col("below").alias("below1"), F.col("half").alias("half1")), "middle")
        hashed = inside.join(middle, "node").where("fine = fine0").withColumn("slot", F.shiftrightunsigned(spread, 63 - 16))
        last = _median(hashed.groupBy("node", "slot").agg(F.sum(weight).alias("w"), F.first("half1").alias("half0"), F.first("below1").alias("below0")), "slot", "half0", "below0")
        cut = materialize(
            coarse.select("node", "bin0", "vlo", "vhi").join(middle.select("node", "fine0"), "node").join(last.select("node", F.col("at").alias("slot0"), "after"), "node").join(stats, "node"), "cut"
        )
        value = F.coalesce(*(F.when(F.col("dim") == k, F.col(d)) for k, d in enumerate(dims)))
        found = nodes.join(cut, "node", "left").withColumn("value", value).withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("long")).withColumn("fine", fine)
        slot = F.shiftrightunsigned(spread, 63 - 16)
        right = (F.col("bin") > F.col("bin0")) | (
            (F.col("bin") == F.col("bin0"))
            & ((F.col("fine") > F.col("fine0")) | ((F.col("fine") == F.col("fine0")) & ((slot > F.col("slot0")) | ((slot == F.col("slot0")) & F.col("after")))))
        )
        nodes = materialize(found.withColumn("node", F.col("node") * 2 + F.coalesce(right, F.lit(False)).cast("long")).select(*rows.columns, "node"), "nodes")
    return nodes


def _median(bins, name: str, half: str | None = None, below: str | None = None):
    """Per node, the bin in which the running weight passes half: at, half, below (before the bin), after (the bin goes right)."""
    w = Window.partitionBy("node")
    base = F.col(below) if below else F.lit(0)
    run = bins.withColumn("total", F.col(half) if half else F.sum("w").over(w) / 2).withColumn("upto", base + F.sum("w").over(w.orderBy(name)))
    run = run.withColumn("before", F.col("upto") - F.col("w")).withColumn("last", F.max(name).over(w) == F.col(name))
    hit = run.where("upto >= total and before < total or (last and upto < total) or (before >= total and before = 0)")
    first = F.row_number().over(w.orderBy(name))
    extra = [c for c in ("vlo", "vhi") if c in bins.columns]
    after = (F.col("upto") - F.col("total")) > (F.col("total") - F.col("before"))
    return hit.withColumn("rn", first).where("rn = 1").select("node", F.col(name).alias("at"), F.col("total").alias("half"), F.col("before").alias("below"), after.alias("after"), *extra)


def document_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): documents in 2^k shards of near equal bytes.

    Size is the UTF-8 bytes of the text plus 1 (null: 1). Dimensions: size, language, source and doc_id; nulls count as
    0 or before all others. Repeated rows are separate rows; an empty table gives no rows."""
    levels = shards.bit_length() - 1
    if 1 << levels != shards:
        raise ValueError("a binary tree has 2^k leaves")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    none = F.lit(None).cast("string")
    lang, source = (F.col(c) if c in docs.columns else none for c in ("lang", "source"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), utf8_crc32(F.col(text_col)).alias("text_crc32"),
        F.log1p(size.cast("double")).alias("d0"), lang.alias("lang"), source.alias("source"), number(F.col(id_col)).alias("d3"),
    ).withColumn("tie", F.xxhash64("doc_id", "text_crc32", "size"))
    rows = text_number(text_number(rows, "lang", "d1"), "source", "d2")
    nodes = kd_shards(rows, ["d0", "d1", "d2", "d3"], "size", levels=levels)
    nodes = nodes.withColumn("shard", F.col("node").cast("int"))
    return gapless_rank(nodes, ["shard"], ["tie", "doc_id"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
