"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the lengths of frequent units, broadcast once; tier two is each worker's own cache, which
encodes what the table lacks. Units of texts that are counted are never shuffled; the sums of the sample that chooses the
table are, a row a unit and task."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, lean, slices, small_batches
from .encoding import RUN_BYTES, PieceCounter, loaded

TABLE_UNITS = 20_000  # broadcast bound: about 1 MB
SAMPLE_DOCS, SAMPLE_BYTES = 2_000, 64 << 10  # about so many texts, of so many bytes at most, choose which units are frequent; the choice changes speed, never counts


def frequent_units(docs: DataFrame, model: str, text_col: str, units: int = TABLE_UNITS, sample: int = SAMPLE_DOCS, most: int = SAMPLE_BYTES) -> dict[str, int]:
    """Lengths of the `units` most frequent units of about `sample` texts, taken evenly from the whole table.

    Each task sums up its own texts first and encodes on the executors; units of the sample alone are counted together."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = loaded(PieceCounter, model), Counter()
        for batch in batches:
            if counter.splits:
                _, code, names = counter.units(batch.column(0))
                seen.update(dict(zip(names, np.bincount(code, minlength=len(names)).tolist())))
        top = [(u, n) for u, n in seen.most_common(units) if u and n > 1]
        lengths = counter.lengths([u for u, _ in top])
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in top], pa.string()), pa.array(lengths, pa.int32()), pa.array([n for _, n in top], pa.int64())], names=["unit", "n", "times"])

    n = docs.count()
    text = F.col(text_col).alias("text")
    chosen = docs.select(text).sample(min(1.0, sample / max(n, 1)), seed=1).where(F.octet_length("text") <= most).limit(2 * sample)
    top = chosen.mapInArrow(summed, "unit string, n int, times long").groupBy("unit", "n").agg(F.sum("times").alias("times"))
    return {r[0]: r[1] for r in top.orderBy(F.col("times").desc(), "unit").limit(units).collect()}


def token_counts(
    docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", table_units: int = TABLE_UNITS, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows, and rows without doc_id, each get a row; other columns
    are not read; an empty table gives no rows."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_units(docs, model, text_col, table_units, sample_docs))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(PieceCounter, model)
        counter.frequent = table.value
        for batch in lean(batches):
            _, offsets = buffers(batch.column(1))
            for i, j in slices(offsets, RUN_BYTES):
                made = [pa.array(np.diff(offsets[i : j + 1])), pa.array(counter.counts(batch.column(1).slice(i, j - i)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *made], names=["doc_id", "n_bytes", "n_tokens"])

    small_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counted = source.mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
