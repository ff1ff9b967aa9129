import glob
import itertools
import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
import corpus as B

import corpus_pipeline
from strandwise.llm import queries, rffquality


def test_stages_keep_the_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
        if k < 4:
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0 and len(set(counts)) > 3
    assert docs.select("doc_id").distinct().count() == counts[-1]
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset").collect())) == sorted(map(tuple, docs.drop("sequence_id", "offset").collect()))


def test_every_stage_has_an_effect_in_sequence(spark, sf_dir):
    """Each stage on what its predecessor kept, against plain twins where a twin is short, and the labels."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    first = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [{r.doc_id: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
        kept.append({r.doc_id: r for r in docs.collect()})
    assert all(set(b) < set(a) for a, b in itertools.pairwise(kept)), [len(k) for k in kept]
    good, bad = ({r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"quality = {q}").collect()} for q in (1, 0))
    assert bad & (set(kept[1]) - set(kept[2])) and len(good & (set(kept[0]) - set(kept[2]))) <= 0.02 * len(good)
    # rules: what the base measures reject goes, and no text that neither repeats a word window or line nor has symbols
    for d, r in kept[0].items():
        words, _, symbols, lines, repeats, _ = B.repetition(r.text)
        if not words or 100 * repeats > 50 * words or symbols > 2 * words:
            assert d not in kept[1]
        elif not repeats and not lines and not symbols:
            assert d in kept[1]
    # classifier: the rows that the scores of the same rows accept
    left = first.where(F.col("doc_id").isin(list(kept[1])))
    scores = rffquality.quality_scores(left, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert {r.doc_id for r in scores if r.predicted} == set(kept[2])
    groups = B.duplicate_groups([(d, r.text) for d, r in kept[2].items()], 5, 80, 100)
    assert set(kept[3]) == {d for d, (_, _, best) in groups.items() if best}
    # mixing: the query's SQL over these rows, with the pipeline's share and one epoch
    con = duckdb.connect()
    con.register("documents", first.where(F.col("doc_id").isin(list(kept[3]))).toArrow())
    mixed = queries._mixing_sql().replace(f"{queries.SHARE}::DOUBLE", f"{corpus_pipeline.MIX_SHARE}::DOUBLE").replace(f") * {queries.EPOCHS})::BIGINT AS capacity", ") * 1)::BIGINT AS capacity").replace(f"::BIGINT, {queries.EPOCHS}) AS whole", "::BIGINT, 1) AS whole")
    assert set(kept[4]) == {d for (d,) in con.sql(f"select doc_id from ({mixed})").fetchall()}
    packed = corpus_pipeline.packing(spark, docs, sf_dir).collect()
    library = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    tokens = {d: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for d, r in kept[4].items()}
    held, used = {}, {}
    for p in packed:
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
        used.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert held == tokens
    for places in used.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= queries.TARGET


def test_rows_of_one_id_and_other_texts_are_one_document(spark):
    rows, _ = stage_corpus(spark)
    one = [(7, t, "en", "src0") for t in (rows[3][1], rows[5][1], rows[9][1])]
    for order in (one, one[::-1]):
        got = corpus_pipeline.near_dedup(spark, B.frame(spark, [*order, *order, (None, None, "en", "src0")]).repartition(3), "").collect()
        assert sorted((r.doc_id or -1, r.text or "") for r in got) == [(-1, ""), (7, min(t for _, t, *_ in one))]


def test_empty_table_passes_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twins(spark, sf_dir, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]}) q").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want)


def stage_corpus(spark):
    """Rows with and without doc_id, all of one source, the texts unlike each other; columns with names used inside."""
    rows = [(k if k % 2 else None, " ".join(f"w{k}x{i}" for i in range(60)), "en", "src0") for k in range(40)]
    return rows, B.frame(spark, rows).repartition(3)


def test_mixing_keeps_rows_without_id(spark):
    rows, docs = stage_corpus(spark)
    docs = docs.withColumn("__row", F.lit("own"))
    got = corpus_pipeline.source_mixing(spark, docs, "")
    assert got.columns == docs.columns
    got = sorted(r.text for r in got.collect())
    assert len(set(got)) == len(got) == 32  # the share of rows of one length, whether or not they have an id
    assert 0 < sum(1 for d, t, *_ in rows if d is None and t in got) < 20
    copies = B.frame(spark, [(None, "equal in all", "en", "src0")] * 50 + [(5, "equal in all", "en", "src0")] * 50)
    assert corpus_pipeline.source_mixing(spark, copies, "").count() == 80
    named = B.frame(spark, [(k, t, lang, source) for k, (_, t, lang, source) in enumerate(rows)])
    numbered = named.unionByName(B.frame(spark, [(None, None, "en", "alone")]))  # of another leaf
    one, other = (sorted(r.doc_id for r in corpus_pipeline.source_mixing(spark, d, "").where("source = 'src0'").collect()) for d in (named, numbered))
    assert one == other  # the same choice by id and by number


def test_near_dedup_keeps_rows_without_id(spark):
    rows, _ = stage_corpus(spark)
    twin = (99, rows[1][1], "en", "src0")
    got = corpus_pipeline.near_dedup(spark, B.frame(spark, [*rows, rows[1], rows[0], twin]), "").collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == sorted((d or -1, t) for d, t, *_ in [*rows, rows[0]])


def test_quality_rules_leave_columns_of_the_same_names(spark):
    rows, docs = stage_corpus(spark)
    more = [(7, "short but whole", "en", "src0"), (8, "again and " * 40, "en", "src0"), (9, "a*** b###", "en", "src0"), (10, "", "en", "src0"), (None, None, None, None)]
    docs = docs.unionByName(B.frame(spark, more)).withColumn("word_chars", F.lit(1.5))
    got = corpus_pipeline.quality_rules(spark, docs, "")
    assert got.schema == docs.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.where("text like 'w%' or text like 'short%'").collect()))
    assert {(r.n_words, r.kept, r.word_chars) for r in got.collect()} == {("x", "x", 1.5)}


def test_each_quality_stage_keeps_good_and_rejects_bad(spark, sf_dir):
    """Each on all documents, judged by the labels; rows without doc_id, repeats, nulls and clashing names pass the classifier."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # enough labels
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good, bad = ({r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"quality = {q}").collect()} for q in (1, 0))
    ruled = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, sf_dir).select("doc_id").collect()}
    assert len(good - ruled) <= 0.01 * len(good)
    one = docs.where(f"doc_id = {min(good & ruled)}").first()
    more = spark.createDataFrame([one, one, one.asDict() | {"doc_id": None}, one.asDict() | {"lang": None, "source": None, "n_chars": None}], docs.schema)
    odd = docs.unionByName(more).withColumn("x", F.lit("x")).withColumn("score", F.lit(7))
    got = corpus_pipeline.materialize(corpus_pipeline.quality_classifier(spark, odd, sf_dir), "classified")
    assert got.columns == odd.columns and {(r.x, r.score) for r in got.select("x", "score").distinct().collect()} == {("x", 7)}
    after = {r.doc_id for r in got.collect()}
    assert len(good - after) <= 0.02 * len(good) and len(bad & after) <= 0.1 * len(bad)
    assert got.where(F.col("text") == F.lit(one.text)).count() >= 5
