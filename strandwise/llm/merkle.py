"""Merkle dataset manifest: a hash tree over the rows of each group, and one over the groups' roots.

Nodes keep their preimage: the children's digests in order, as hex text of 64 characters each. A leaf's proof is the list
of its ancestors' preimages with its own slot in each: the siblings are what is left when the slot is cut out, and a
changed leaf is folded by putting its digest into the slot, hashing, and going on with the parent.

Rows are numbered by a range exchange, so no group is in one task, however large. Levels go up by groups of `fan` nodes,
and proofs come down the same way: each node joins its parent, which has `fan` children at most, so no key of any join
is hot although all leaves of a group share its upper nodes. All of it is Spark's own functions; no Python runs in tasks.

A table without rows has no manifest rows. Rows are leaves of their own even where they are equal; ties of the order are
settled by the leaf's digest. A null group is a group, and comes first; a null in the order comes first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwise.operators.order import numbered
from strandwise.sources.files import left_join_counted

from .common import materialize

FAN = 16
DIGEST = 64  # hex characters
BROADCAST_NODES = 10_000  # nodes whose preimages, 1 KB each and a few levels of them, may be broadcast


def digest(text: Column) -> Column:
    """Lower-case hex sha256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def framed(*columns: Column) -> Column:
    """Columns as one text that no other values can give: - for null, else the UTF-8 byte count, a colon, the value."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def _upward(leaves: DataFrame, largest: int, fan: int) -> list[tuple[DataFrame, int]]:
    """[(nodes, their number)] of all levels above `leaves` (tree, pos, n, hash), written; n: nodes of the tree's level."""
    levels, below = [], leaves
    while largest > 1:
        run = F.array_sort(F.collect_list(F.struct("pos", "hash")))
        nodes = below.where("n > 1").groupBy("tree", F.floor(F.col("pos") / fan).alias("up")).agg(run.alias("run"), F.max("n").alias("n"))
        preimage = F.array_join(F.transform("run", lambda x: x["hash"]), "")
        nodes = nodes.select("tree", F.col("up").alias("pos"), F.ceil(F.col("n") / fan).alias("n"), preimage.alias("preimage"))
        below = materialize(nodes.withColumn("hash", digest(F.col("preimage"))), "nodes")
        levels.append((below, below.count()))
        largest = -(-largest // fan)
    return levels


def _downward(leaves: DataFrame, levels: list[tuple[DataFrame, int]], tops: DataFrame, n_tops: int, fan: int) -> DataFrame:
    """`leaves` with what `tops` (tree and more, with `path`, a row a tree) have, and their ancestors before it in `path`."""
    tops = F.broadcast(tops) if n_tops <= BROADCAST_NODES else tops
    more = [c for c in tops.columns if c not in ("tree", "path")]
    above, size = None, 0
    for nodes, count in [*reversed(levels), (leaves, 0)]:
        found = nodes.where("n = 1").join(tops, "tree")
        if above is not None:
            up = above.select("tree", F.col("pos").alias("up"), F.col("preimage").alias("__image"), F.col("path").alias("__path"), *more)
            up = F.broadcast(up) if size <= BROADCAST_NODES else up
            step = F.struct(F.col("__image").alias("preimage"), F.pmod("pos", F.lit(fan)).cast("int").alias("slot"))
            lower = nodes.where("n > 1").withColumn("up", F.floor(F.col("pos") / fan)).join(up, ["tree", "up"])
            found = found.unionByName(lower.withColumn("path", F.concat(F.array(step), "__path")).drop("up", "__image", "__path"))
        above, size = found, count
    return above


_PATH = "array<struct<preimage:string,slot:int>>"


def manifest(df: DataFrame, fields: Sequence[str], group: str, order: Sequence[str], keep: Sequence[str] = (), more: dict[str, Column] | None = None, fan: int = FAN) -> DataFrame:
    """`keep` and `more` with leaf, subroot (of the row's group), root and path (ancestors' preimages and slots, upward).

    The leaf is the digest of `fields`, framed; leaves of a group go by `order`, groups by their value bytewise, null first.
    Columns of `df` that are not named are not read. A group of one row has its leaf as subroot, one group its subroot as
    root."""
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    carried = {c: F.col(c) for c in keep} | (more or {})
    names = {c: f"__k{i}" for i, c in enumerate(carried)}
    rows = df.select(
        key.alias("__g"), digest(framed(*(F.col(c) for c in fields))).alias("__leaf"),
        *(F.col(c).alias(f"__o{i}") for i, c in enumerate(order)), *(x.alias(names[c]) for c, x in carried.items()),
    )
    rows = materialize(rows, "leaves")  # texts are read and hashed once; what follows moves digests
    rows = numbered(rows, ["__g", *(f"__o{i}" for i in range(len(order))), "__leaf"], "__no")
    groups = materialize(rows.groupBy("__g").agg(F.count(F.lit(1)).alias("n"), F.min("__no").alias("tree")), "groups")
    n_groups, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    placed = left_join_counted(rows, groups.withColumn("__n", F.col("n")), ["__g"], "__n")
    leaves = placed.select("tree", (F.col("__no") - F.col("tree")).alias("pos"), "n", F.col("__leaf").alias("hash"), *names.values())
    levels = _upward(leaves.select("tree", "pos", "n", "hash"), largest or 0, fan)
    subroots = leaves.where("n = 1").select("tree", "hash")
    for nodes, _ in levels:
        subroots = subroots.unionByName(nodes.where("n = 1").select("tree", "hash"))
    # trees are numbered by their first row, so their order is the groups'
    tops = numbered(subroots, ["tree"], "pos").select(F.lit(0).cast("long").alias("tree"), "pos", F.lit(n_groups).cast("long").alias("n"), "hash", F.col("tree").alias("of"))
    tops = materialize(tops, "subroots")
    above = _upward(tops.select("tree", "pos", "n", "hash"), n_groups, fan)
    root = (above[-1][0] if above else tops).where("n = 1").select("tree", F.col("hash").alias("root"), F.array().cast(_PATH).alias("path"))
    top_paths = _downward(tops, above, root, 1, fan).select(F.col("of").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    found = _downward(leaves, levels, materialize(top_paths, "top-paths"), n_groups, fan)
    return found.select(*(F.col(names[c]).alias(c) for c in carried), F.col("hash").alias("leaf"), "subroot", "root", "path")


def siblings(path: Column) -> Column:
    """Digests of the siblings on the way up, concatenated, left to right: each preimage without the own slot."""
    cut = lambda p: F.concat(p["preimage"].substr(F.lit(1), p["slot"] * DIGEST), p["preimage"].substr((p["slot"] + 1) * DIGEST + 1, F.length(p["preimage"])))
    return F.array_join(F.transform(path, cut), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    put = lambda below, p: digest(F.concat(p["preimage"].substr(F.lit(1), p["slot"] * DIGEST), below, p["preimage"].substr((p["slot"] + 1) * DIGEST + 1, F.length(p["preimage"]))))
    return F.aggregate(path, leaf, put)


def verified(stored: DataFrame, df: DataFrame, fields: Sequence[str], on: str) -> DataFrame:
    """(on, ok): rows of `df` against a written manifest with the unique, non-null column `on`: whether a row still folds to
    the root. A row that the manifest does not have, or that `df` has lost, is not ok."""
    now = df.select(F.col(on).alias("__on"), digest(framed(*(F.col(c) for c in fields))).alias("__now"))
    both = stored.select(on, "root", "path").join(now, F.col(on) == F.col("__on"), "full")
    ok = F.coalesce(folded(F.col("__now"), F.col("path")) == F.col("root"), F.lit(False))
    return both.select(F.coalesce(on, "__on").alias(on), ok.alias("ok"))
