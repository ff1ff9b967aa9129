"""Toxicity: cumulative-link ordinal regression on sparse text features.

A document's features are its distinct words and longer words' beginnings (64-bit hashes; letters and digits, A-Z in
lower case), so that inflected and compounded forms are met too. Severity grades
share one weight vector: P(grade <= k) = sigmoid(threshold_k - w.x), thresholds ascending. Words are chosen and weights
fitted on a bounded sample of labelled rows (SAMPLE_ROWS); every whole text is then scored in a narrow pass."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hashed, buffers, materialize, mix, slices

SAMPLE_ROWS = 10_000  # labelled rows that choose words and fit weights
PREFIXES = (5, 6, 7, 8)  # bytes
MOST_WORDS = 2_048  # words of the model, those that tell most; the driver holds and broadcasts their weights
LEAST_ROWS = 5  # a chosen word occurs in so many labelled rows
LEAST_Z = 6.0  # and its toxic share is so many standard deviations from the base rate
FLAG = 0.5

_SPLIT = np.ones(256, bool)
_SPLIT[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False


def _kinds(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) of every occurrence: of the words, then of the beginnings of each length."""
    run = Hashed(data, offsets, lower=True, separators=_SPLIT)
    yield run.doc, run.words
    size = run.ends - run.starts
    for k in PREFIXES:
        longer = np.flatnonzero(size > k)
        yield run.doc[longer], mix(run.span(run.starts[longer], run.starts[longer] + k) + np.uint64(k))


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, occurrences), sorted by document and feature; kinds are counted one by one, so that a very long
    text needs memory for one kind of its features."""
    doc, feature, times = (np.concatenate(c) for c in zip(*(_distinct(*kind) for kind in _kinds(data, offsets))))
    order = np.lexsort((feature, doc))
    return doc[order], feature[order], times[order]


def _distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, occurrences), sorted by document."""
    order = np.lexsort((feature, doc))
    doc, feature = doc[order], feature[order]
    fresh = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (feature[1:] != feature[:-1])])) if len(doc) else np.zeros(0, np.int64)
    return doc[fresh], feature[fresh], np.diff(np.append(fresh, len(doc)))


def word_rows(rows: DataFrame) -> DataFrame:
    """(y, half, words array<long>, times array<int>) of (y, half, text)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for i, j in slices(offsets):
                doc, word, times = _features(data, offsets[i : j + 1])
                ends = pa.array(np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32))
                columns = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.ListArray.from_arrays(ends, pa.array(word.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(columns, names=["y", "half", "words", "times"])

    return rows.mapInArrow(made, "y int, half int, words array<long>, times array<int>")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    words: np.ndarray  # chosen hashes, ascending
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each threshold."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def fit_ordinal(grades: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, words: np.ndarray, levels: int, steps: int = 600, penalty: float = 1e-3) -> Ordinal:
    """Full-batch descent (Adam, falling steps) on the mean negative log-likelihood; row, column, value: the sparse features."""
    n, d, k = len(grades), len(words), levels - 1
    shares = np.array([(grades <= g).mean() for g in range(k)]).clip(1e-3, 1 - 1e-3)
    start = np.log(shares / (1 - shares))
    p = np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    first, second = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        w, theta = p[:d], np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])]))
        s = np.bincount(row, weights=w[column] * value, minlength=n)
        upper = np.column_stack([_sigmoid(theta[None, :] - s[:, None]), np.ones(n)])
        lower = np.column_stack([np.zeros(n), upper[:, :-1]])
        at = np.arange(n)
        up, lo = upper[at, grades], lower[at, grades]
        like = np.maximum(up - lo, 1e-12)
        d_up, d_lo = up * (1 - up) / like, lo * (1 - lo) / like
        g_score = (d_up - d_lo) / n  # of the negative log-likelihood
        g_theta = np.zeros(k)
        np.add.at(g_theta, grades[grades < k], -d_up[grades < k] / n)
        np.add.at(g_theta, grades[grades > 0] - 1, d_lo[grades > 0] / n)
        tail = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([np.bincount(column, weights=g_score[row] * value, minlength=d) + penalty * w / max(d, 1), tail[:1], tail[1:] * np.exp(p[d + 1 :])])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        p = p - 0.1 * (1 - (t - 1) / steps) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Ordinal(words, p[:d], np.cumsum(np.concatenate([p[d : d + 1], np.exp(p[d + 1 :])])))


def _train(rows: DataFrame, levels: int, most_words: int, least_rows: int, least_z: float) -> Ordinal:
    """Choose words and fit. Grades above 0 are quantiles, among toxic rows, of how often words occur that are toxic by
    the other half of the rows, so that no row's grade comes from its own label or from the words chosen with its help."""
    seen = materialize(word_rows(rows), "words")
    total = {r[0]: (int(r[1]), int(r[2])) for r in seen.groupBy("half").agg(F.count(F.lit(1)), F.sum("y")).collect()}
    n, toxic = (sum(t[k] for t in total.values()) for k in (0, 1))
    none = Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.full(levels - 1, 20.0))
    if not n or not toxic or toxic == n:
        return none
    halves = [F.sum(F.when(F.col("half") == k, x)).alias(f"{c}{k}") for k in (0, 1) for c, x in (("n", F.lit(1)), ("p", F.col("y")))]
    counts = seen.select(F.explode("words").alias("word"), "half", "y").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"), *halves).fillna(0)
    base = toxic / n
    z = (F.col("p") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    found = counts.where(F.col("n") >= least_rows).withColumn("z", z).where(F.abs("z") >= least_z).orderBy(F.abs("z").desc(), "word").limit(most_words + 1).collect()
    if not found:
        return none
    if len(found) > most_words:
        warnings.warn(f"more than {most_words} words tell toxic rows apart; those that tell least are not used", stacklevel=3)
        found = found[:most_words]
    found.sort(key=lambda r: r.word % (1 << 64))
    words = np.array([r.word for r in found], np.int64).view(np.uint64)
    # toxic by the rows of one half: above that half's base rate
    bad = np.array([[r[f"p{k}"] > r[f"n{k}"] * total.get(k, (1, 0))[1] / total.get(k, (1, 0))[0] for k in (0, 1)] for r in found])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], []]
            for ws, ts in zip(batch.column(2), batch.column(3)):
                w, t = np.array(ws.as_py(), np.int64).view(np.uint64), np.array(ts.as_py(), np.int64)
                at = np.minimum(np.searchsorted(words, w), len(words) - 1)
                hit = words[at] == w
                out[0].append(at[hit].tolist())
                out[1].append(t[hit].tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.list_(pa.int32())) for x in out)], names=["y", "half", "at", "times"])

    sample = seen.mapInArrow(reduced, "y int, half int, at array<int>, times array<int>").collect()  # SAMPLE_ROWS short rows at most
    y = np.array([r.y for r in sample])
    strength = np.array([sum(1 + np.log(t) for a, t in zip(r["at"], r["times"]) if bad[a, 1 - r.half]) for r in sample])
    cuts = np.quantile(strength[y > 0], np.arange(1, levels - 1) / (levels - 1))
    grades = np.where(y > 0, 1 + np.searchsorted(cuts, strength, "right"), 0)
    row = np.repeat(np.arange(len(sample)), [len(r["at"]) for r in sample])
    column = np.concatenate([np.array(r["at"], np.int64) for r in sample])
    value = 1 + np.log(np.concatenate([np.array(r["times"], np.float64) for r in sample]))
    return fit_ordinal(grades, row, column, value, words, levels)


def toxicity(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", levels: int = 3,
    sample_rows: int = SAMPLE_ROWS, most_words: int = MOST_WORDS, least_rows: int = LEAST_ROWS, least_z: float = LEAST_Z,
) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic) of every row: expected grade, likeliest grade and whether p_toxic >= FLAG.

    `sample_rows` labelled rows at most, drawn by a hash of doc_id, choose `most_words` words at most, each in `least_rows` rows
    and `least_z` deviations from the base rate, and fit the weights; a warning says when more would qualify. Every whole text is scored. Grades go from 0 (not toxic) to levels - 1. Null and empty texts have no words and get the grades' base rates;
    null labels are left out, the highest counts where an id has several; repeated rows each get a row. Without both
    kinds of labels nothing is toxic."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    known = materialize(known.groupBy("doc_id").agg(F.max("y").alias("y")), "labels")
    share = 0.95 * sample_rows / max(known.count(), 1)  # a hash cut-off; the limit only guards the bound
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.where(hashed < int(share * (1 << 30))).limit(sample_rows).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    model = _train(texts.join(F.broadcast(known), "doc_id").select("y", "half", "__text"), levels, most_words, least_rows, least_z)  # sample_rows rows of 12 bytes at most

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in slices(offsets):
                s = np.zeros(j - i)
                if len(model.words):
                    hits = []
                    for doc, word in _kinds(data, offsets[i : j + 1]):
                        at = np.minimum(np.searchsorted(model.words, word), len(model.words) - 1)
                        hit = np.flatnonzero(model.words[at] == word)
                        hits.append((doc[hit], at[hit]))
                    doc, at, times = _distinct(*(np.concatenate(c) for c in zip(*hits)))
                    s = np.bincount(doc, weights=model.weights[at] * (1 + np.log(times)), minlength=j - i)
                above = model.above(s)
                each = -np.diff(np.column_stack([np.ones(j - i), above, np.zeros(j - i)]), axis=1)
                columns = [batch.column(0).slice(i, j - i), pa.array(above.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "severity", "grade", "p_toxic"])

    return texts.mapInArrow(scored, "doc_id long, severity double, grade int, p_toxic double").withColumn("toxic", F.col("p_toxic") >= FLAG)
