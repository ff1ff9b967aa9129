"""Mixing sources to target weights by hierarchical budgets.

A tree of domain, language and source carries weights. A budget of tokens runs down it: the children of a node share
its budget by weight, none beyond what its leaves can give (their tokens times the epochs allowed); what a child cannot
take is shared among its siblings by weight, and only what a whole subtree lacks reaches the subtree's own siblings. A
leaf's budget is then spent on seeded epochs: whole passes first, then the prefix of the next pass's seeded order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BUCKETS = 4096  # hash ranges a leaf and epoch, so that no leaf is ranked in one task


def word_tokens(text: Column) -> Column:
    """Words of the whole text and an end mark: 1 for null and empty texts."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("long") + 1


def water_fill(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """Add `budget` to nodes(parent..., weight double, capacity long, parent_budget double).

    Siblings get min(capacity, level * weight) with the level that spends the parent's budget; a sibling is full where
    the siblings that fill up before it, and its own level, take no more than the budget."""
    w = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), *order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_of = Window.partitionBy(*parent)
    full = F.col("cap_upto") + (F.col("weight_all") - F.col("weight_upto")) * F.col("capacity") / F.col("weight") <= F.col("parent_budget")
    return (
        nodes.withColumn("cap_upto", F.sum("capacity").over(upto))
        .withColumn("weight_upto", F.sum("weight").over(upto))
        .withColumn("weight_all", F.sum("weight").over(all_of))
        .withColumn("full", full)
        .withColumn("cap_full", F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(all_of), F.lit(0)))
        .withColumn("weight_open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(all_of), F.lit(0.0)))
        .withColumn("budget", F.when(F.col("full"), F.col("capacity").cast("double")).otherwise((F.col("parent_budget") - F.col("cap_full")) * F.col("weight") / F.col("weight_open")))
        .drop("cap_upto", "weight_upto", "weight_all", "full", "cap_full", "weight_open")
    )


def leaf_budgets(tokens: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], budget: float, epochs: int) -> DataFrame:
    """(levels..., leaf_tokens, budget) from (levels..., leaf_tokens); one row a leaf of the tree.

    weights: level -> value -> weight among its siblings; 1.0 where none is given. Weights are above 0."""
    spark = tokens.sparkSession
    tree = tokens.withColumn("capacity", F.col("leaf_tokens") * epochs)
    above = None
    for k, level in enumerate(levels):
        path = levels[: k + 1]
        nodes = tree.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        known = weights.get(level) or {"": 1.0}
        table = spark.createDataFrame([(v, float(x)) for v, x in known.items()], f"`{level}` string, weight double")
        nodes = nodes.join(F.broadcast(table), level, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        total = F.least(F.lit(float(budget)), F.sum("capacity").over(Window.partitionBy(F.lit(0))).cast("double"))
        nodes = nodes.withColumn("parent_budget", total) if above is None else nodes.join(above.withColumnRenamed("budget", "parent_budget"), levels[:k])
        above = materialize(water_fill(nodes, levels[:k] or [F.lit(0)], path).select(*path, "budget"), "budgets")  # a row a node
    return tree.join(above, levels).select(*levels, "leaf_tokens", "budget")


def mix(
    docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, float]], share: float, epochs: int = 1, seed: int = 1,
    tokens: Column | None = None, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
) -> DataFrame:
    """(doc_id, levels..., n_tokens, epoch, copies[, row]): the documents chosen, one row a document.

    The budget is `share` of all tokens. copies: times that the document is used (1 to `epochs`); epoch: the pass of
    its last use, from 0. The last pass is cut at the document edge nearest to what is left: a document is used where the
    pass's tokens up to its middle stay within it; passes are ordered by md5 of seed, epoch and doc_id, then doc_id and tokens. Null levels are
    the level value 'none'; rows that are equal in all of this are separate rows that go in or stay out together, unless
    `row_col` (a long, another one in each row, stable) tells them apart: it breaks these ties, stands in for a null doc_id
    in the md5, and is returned as `row`."""
    names = list(levels)
    row = [] if row_col is None else ["row"]
    count = word_tokens(F.col(text_col)) if tokens is None else tokens
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.coalesce(c.cast("string"), F.lit("none")).alias(n) for n, c in levels.items()), count.alias("n_tokens"), *(F.col(row_col).alias(n) for n in row))
    rows = materialize(rows, "tokens")
    leaves = materialize(rows.groupBy(*names).agg(F.sum("n_tokens").alias("leaf_tokens")), "leaves")  # a row a leaf
    total = leaves.agg(F.sum("leaf_tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, names, weights, share * total, epochs)
    passes = F.floor(F.col("budget") / F.col("leaf_tokens")).cast("long")
    plan = plan.withColumn("whole", F.least(passes, F.lit(epochs).cast("long")))
    plan = materialize(plan.select(*names, "whole", (F.floor("budget").cast("long") - F.col("whole") * F.col("leaf_tokens")).alias("rest")), "plan")
    name = F.coalesce(F.col("doc_id").cast("string"), *(F.concat(F.lit("none:"), F.col(n).cast("string")) for n in row), F.lit("none"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), name).cast("binary"))
    keyed = rows.join(plan, names).withColumn("key", key).withColumn("bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
    sums = keyed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("__n"))
    w = Window.partitionBy(*names).orderBy("bucket")
    starts = sums.select(*names, "bucket", (F.sum("__n").over(w) - F.col("__n")).alias("__before"))
    run = F.sum("n_tokens").over(Window.partitionBy(*names, "bucket").orderBy("key", "doc_id", "n_tokens", *row))
    ranked = keyed.withColumn("__run", run).join(starts, [*names, "bucket"])
    fits = 2 * (F.col("__before") + F.col("__run")) - F.col("n_tokens") <= 2 * F.col("rest")
    copies = F.col("whole") + fits.cast("long")
    return ranked.withColumn("copies", copies).where("copies > 0").select("doc_id", *names, "n_tokens", (F.col("copies") - 1).alias("epoch"), "copies", *row)
