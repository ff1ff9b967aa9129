"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression.

One pass over the texts writes a few statistics a document. The features approximate a Gaussian kernel over the
standardised statistics; each partition sums its part of the normal equations, and the sums are added in a tree, so
what reaches the driver is a few matrices of D x D whatever the number of labels. Calibration sees labels that the
ridge did not, as counts in fixed bins."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, Hashed, buffers, lean, materialize, slices, small_batches
from .repetition import measure

FEATURES = 256
RIDGE = 1e-3
BINS = 512
FOLDS = 5
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_chars", "upper", "digits", "symbols", "marks", "other_marks", "non_ascii", "breaks", "entropy",
    "distinct", "repeat_words", "dup_grams", "dup_lines", "dup_line_count", "words_per_line", "bytes_per_word", "distinct_bytes",
)

_CLASS = np.zeros(256, np.int64)  # 0: lower case and blanks
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[list(b"#*$%&|<>")] = 3
_CLASS[list(b".,;:'\"-")] = 4
_CLASS[list(b"!?()[]{}/\\=+_~^@`")] = 5
_CLASS[128:] = 6
_CLASS[10] = 7


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each document of a run; an empty text has a row of zeros but for ratios' defaults."""
    m = measure(data, offsets, {5: 1.0}, 1.0, 1e9)
    run = Hashed(data, offsets, lower=True)
    n = np.diff(run.offsets)
    size = np.maximum(n, 1)
    counts = np.zeros(run.docs * 256, np.int64)
    for low in range(0, len(run.data), BLOCK):
        piece = run.data[low : low + BLOCK]
        doc = np.repeat(np.arange(run.docs), np.diff(np.clip(run.offsets, low, low + len(piece))))
        counts += np.bincount(doc * 256 + piece, minlength=len(counts))
    counts = counts.reshape(-1, 256)
    share = counts @ (_CLASS[:, None] == np.arange(8)) / size[:, None]
    each = counts / size[:, None]
    entropy = -(each * np.log2(np.where(each > 0, each, 1))).sum(1)
    words, kinds = np.maximum(m["n_words"], 1), np.unique(run.words + run.doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F), return_index=True)[1]
    distinct = np.bincount(run.doc[kinds], minlength=run.docs) / words
    lines = share[:, 7] * size + 1
    return np.column_stack([
        np.log1p(m["n_words"]), m["word_chars"] / words, share[:, 1], share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 7], entropy,
        distinct, m["n_repeat_words"] / words, m["dup_gram_share"], m["dup_line_share"], np.log1p(m["n_dup_lines"]), np.log1p(m["n_words"] / lines), n / words, (each > 0).sum(1) / 64,
    ]).astype(np.float64)


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x): the statistics of every whole text; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(1))
            parts = [statistics(data, offsets[i : j + 1]) for i, j in slices(offsets)]
            if parts:
                x = np.concatenate(parts)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))], names=["doc_id", "x"])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text")).mapInArrow(rows, "doc_id long, x array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of rows of `width` doubles (column `v`, binary), added in a tree of 16 to 1; at most 16 reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for v in batch.column(0):
                total += np.frombuffer(v.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    n = parts.rdd.getNumPartitions()
    while n > 16:
        n = math.ceil(n / 16)
        parts = parts.repartition(n).mapInArrow(add, "v binary")
    return sum((np.frombuffer(bytes(r[0])) for r in parts.collect()), np.zeros(width))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return np.column_stack([math.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones(len(z))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return 0.999 * np.interp(raw, self.at, self.value) + 0.001 * np.clip((raw + 1) / 3, 0, 1)


def pool(at: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: knots (mean place, mean value) of the blocks."""
    blocks: list[list[float]] = []
    for a, k, s in zip(at.tolist(), n.tolist(), y.tolist()):
        blocks.append([a * k, k, s])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 5) -> Model:
    """A model of materialised rows (x, y 0 or 1, fold): folds 1 to FOLDS - 2 fit the ridge, fold FOLDS - 1 calibrates."""
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * d)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            total += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    train = rows.where((F.col("fold") > 0) & (F.col("fold") < FOLDS - 1)).select("x", F.col("y").cast("double").alias("y"))
    m = summed(train.mapInArrow(moments, "v binary"), 1 + 2 * d)
    n = max(m[0], 1)
    mean = m[1 : 1 + d] / n
    scale = np.sqrt(np.maximum(m[1 + d :] / n - mean**2, 0)) + 1e-6
    rng = np.random.default_rng(seed)
    w, b = rng.normal(0, 1 / math.sqrt(d), (d, features)), rng.uniform(0, 2 * math.pi, features)
    model = Model(mean, scale, w, b, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    if not m[0]:
        return model
    k = features + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            z, y = model.features(_matrix(batch.column(0), d)), batch.column(1).to_numpy()
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    s = summed(train.mapInArrow(normal, "v binary"), k * (k + 1)).reshape(k, k + 1)
    penalty = ridge * n * np.eye(k) / features
    penalty[-1, -1] = 1e-9
    model.beta = np.linalg.solve(s[:, :k] + penalty, s[:, k])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column(0), d)), -1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum((raw + 1) / 3 * BINS, BINS - 1).astype(np.int32)), batch.column(1)], names=["bin", "y"])

    for part in (rows.where(F.col("fold") == FOLDS - 1).select("x", F.col("y").cast("double").alias("y")), train):
        counts = part.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).orderBy("bin").collect()
        if counts:
            model.at, model.value = pool(np.array([(r.bin + 0.5) / BINS * 3 - 1 for r in counts]), np.array([float(r.n) for r in counts]), np.array([r.s for r in counts]))
            break
    return model


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit on all labelled rows of (doc_id, x) outside fold 0."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y is not null and doc_id is not null")
    known = known.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("y").alias("y"))
    return fit(materialize(stats.join(known, "doc_id").withColumn("fold", fold(F.col("doc_id"))), "labelled"))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    labels: (id, label 0 or 1); null labels are left out, the highest counts where an id has several. Labels of ids in
    fold 0 are never read. Null and empty texts are scored as empty; repeated rows each get a row; without any label
    the score is near 0.5."""
    stats = materialize(document_statistics(docs, id_col, text_col), "statistics")
    model, d = train(stats, labels, label_col, id_col), len(STATISTICS)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(model.score(_matrix(batch.column(1), d)), 0, 1))], names=["doc_id", "score"])

    return stats.mapInArrow(scored, "doc_id long, score double").select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least THRESHOLD; texts are read again rather than shuffled."""
    model = train(materialize(document_statistics(docs, id_col, text_col), "statistics"), labels, label_col, id_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(text_col))
            parts = [model.score(statistics(data, offsets[i : j + 1])) for i, j in slices(offsets)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)
