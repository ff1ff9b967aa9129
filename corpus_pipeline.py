"""The corpus pipeline: quality rules, quality classifier, near-duplicates, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents, further
columns too, unchanged whatever their names. An empty table passes through as one. Rows without doc_id are rows like any
other; nulls in other columns are allowed everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm import bestfit, minhash, mixing, queries, repetition, rffquality
from strandwise.llm.common import materialize

SYMBOLS_PER_WORD = 2.0  # the rules drop texts that are mostly symbols; whether fewer are too many is for the classifier to say
MIN_WORDS = 1  # the rules drop texts without words; whether a short text is good is for the classifier to say
MIX_SHARE = 0.8  # of all tokens that reach the mixing stage
CACHE_UNITS = 60_000  # of the packing stage's encoder: workers keep it through later stages
RUN_BYTES = 1 << 20  # of texts that it encodes at once: workers share their memory with what earlier stages left
BROADCAST_ROWS = 1_000_000  # 8 MB of ids; more are joined by shuffling


def _bounded(ids: DataFrame) -> DataFrame:
    ids = materialize(ids, "ids")
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go: too much repetition, hardly anything but symbols, or no word at all.

    Null and empty texts have no word. Copies of a row are judged alike."""
    return repetition.rule_filter(docs, min_words=MIN_WORDS, symbols_per_word=SYMBOLS_PER_WORD)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: scores below its threshold, short texts among them.

    A null text is scored as an empty one. Without labels all stay. Copies of a text score alike."""
    return rffquality.quality_filter(docs, queries.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id; all without doc_id stay.

    Rows of one doc_id are one document: of those with different texts the one with the least text stays, null first, and
    of equal texts that with the least columns, as JSON."""
    found = materialize(minhash.near_duplicates(docs), "near")
    copies = found.where("not kept").select("doc_id").distinct()
    left = docs.join(_bounded(copies), "doc_id", "left_anti").select(*docs.columns)
    ids = found.where("kept and doc_id is not null").agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if ids[0] == ids[1]:
        return left
    least = F.min_by(F.struct(*left.columns), F.struct("text", F.to_json(F.struct(*left.columns))))
    one = left.where("doc_id is not null").groupBy("doc_id").agg(least.alias("__one"))
    return one.select(*(F.col("__one")[c].alias(c) for c in left.columns)).unionByName(left.where("doc_id is null"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the target weights choose stay, each once; rows without doc_id are chosen like all others.

    Where each row has a doc_id of its own, the choice is joined on it; else rows are numbered and joined on the number,
    for which the table is written once more."""
    mix = lambda rows, **more: mixing.mix(rows, queries.levels(), queries.WEIGHTS, MIX_SHARE, epochs=1, seed=queries.SEED, **more)
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:
        return docs.join(_bounded(mix(docs).select("doc_id")), "doc_id", "left_semi").select(*docs.columns)
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # written: the numbers are fixed
    return rows.join(_bounded(mix(rows, row_col=row).select(F.col("row").alias(row))), row, "left_semi").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what stayed, in few sequences; a null text is its end token alone, and each row has pieces of its own,
    rows of one doc_id too. Pieces of one length are interchangeable: a tie may take either place."""
    return bestfit.best_fit(docs, queries.vocabulary("byte_bpe_50k.json"), 0, queries.TARGET, cache_units=CACHE_UNITS, run_bytes=RUN_BYTES)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_dedup),
    ("mixing", source_mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
