"""Tasks stay small and rows are moved and written no more often than needed, whatever the session's settings."""

import os

import pytest
from pyspark.sql import functions as F

from strandwise import fixtures as X
from strandwise.operators import order
from strandwise.sources import files, named


def test_numbered_sorts_a_bounded_number_of_rows_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(files, "SORT_ROWS", 1000)
    rows = order.numbered(spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k")), ["k"], "no")
    assert len(rows.inputFiles()) >= 10
    ks = sorted(k * 7919 % 10_007 for k in range(10_000))
    assert [(r.k, r.no) for r in sorted(rows.collect(), key=lambda r: r.no)] == list(zip(ks, range(10_000), strict=True))
    assert order.numbered(spark.range(0).select(F.col("id").alias("k")), ["k"], "no").count() == 0


def test_numbered_rows_are_not_shuffled_again(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"  # as for rows whose sizes Spark does not know
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = order.numbered(spark.range(1000), ["id"], "no")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_lines_are_written_once_and_their_items_without_what_only_orders(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(X, "_WRITTEN", {})
    monkeypatch.setattr(X, "_NUMBERED", {}, raising=False)
    wide = X.sam_lines(spark, sf_dir)
    assert [k[2] for k in X._WRITTEN] == []
    [source] = {os.path.dirname(p) for p in wide.inputFiles()}
    assert not {"l_extendedprice", "l_shipdate"} & set(spark.read.parquet(source).columns)
    assert X.dirty_lines(spark, sf_dir).count() == wide.count() and [k[2] for k in X._WRITTEN] == ["dirty"]


def test_numbered_keeps_some_columns(spark):
    rows = order.numbered(spark.range(100).select("id", (-F.col("id")).alias("by")), ["by"], "no", ["id"])
    assert rows.columns == ["id", "no"] and all(r.id + r.no == 99 for r in rows.collect())


def test_text_files_are_dealt_in_bounded_numbers_of_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(X, "_WRITTEN", {})
    monkeypatch.setattr(X, "TEXT_LINES", 100)
    monkeypatch.setattr(files, "SORT_ROWS", 500, raising=False)
    written = [os.path.join(at, f) for at, _, found in os.walk(X.text_folder(spark, sf_dir).removeprefix("file:")) for f in found if f.startswith("part-")]
    assert len(written) == len({os.path.dirname(f) for f in written}) == 60
    assert len({os.path.basename(f)[:10] for f in written}) > 6


@pytest.mark.parametrize("layout", ["files", "folders"])
def test_writers_sort_at_most_64_mb_of_lines_in_a_task(spark, tmp_path, monkeypatch, layout):
    rows, asked = spark.range(160).select(F.lit("a.sam").alias("to"), F.col("id").alias("at"), F.col("id").cast("string").alias("line")), []
    deal = type(rows).repartitionByRange
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, n, *by: asked.append(n) or deal(self, n, *by))
    write = named.write_named_files if layout == "files" else files.write_named
    write(rows, str(tmp_path / "out"), "to", ["at"], size=1 << 30)
    assert asked == [16]
    written = sorted(p for p in (tmp_path / "out").rglob("*") if p.is_file() and p.name[0] not in "._")
    assert "".join(p.read_text() for p in written) == "".join(f"{k}\n" for k in range(160))


@pytest.mark.parametrize("arrival", [["line_no"], ["place", "line_no"]])
def test_dictionary_is_that_of_a_walk_and_reads_the_records_once(spark, arrival):
    rows = [("*", "=", 9, 0), ("b", "a", 3, 1), ("a", "c", 3, 2), (None, "d", 1, 3), ("c", "*", 0, 4), ("b", "=", 0, 5), ("e", None, 2, 6)]
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(x):
        reads.add(1)
        return x

    records = spark.createDataFrame(rows, "rname string, rnext string, place long, line_no long").repartition(2)
    got = {r.name: r.tid for r in order.reference_dictionary(records.withColumn("rname", read("rname")), arrival).collect()}
    want: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: r[3] if len(arrival) == 1 else (r[2], r[3])):
        for name in (r[0], None if r[1] == "=" else r[1]):
            if name not in (None, "*"):
                want.setdefault(name, len(want))
    assert got == want and reads.value == len(rows)
