"""Shared helpers of the corpus operators: materialised tables, gapless ranks, components, text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandwise.sources.files import left_join_counted, materialize, scratch_path  # noqa: F401

#: ASCII blanks: everything else is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


BATCH_SETTING, DEFAULT_BATCH, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bytes an Arrow batch from Spark's default, so that batches of texts take little of a worker's
    memory and of the executor's buffers; a setting of the session's own stays."""
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, BATCH)


RANK_ROWS = 100_000  # rows that one task ranks


def gapless_rank(df: DataFrame, group: list[str], order: list[str], name: str, rows: int = RANK_ROWS) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without bringing a group to one task.

    Rows are ranked inside (group, hash bucket), with a bucket for about `rows` rows of the largest group; the buckets'
    counts give the offsets. The numbering follows the hash, not `order`; `df` must be stable (materialised), `group` must
    hold no nulls."""
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    bucket = F.pmod(F.xxhash64(*order), F.lit(-(-largest // rows) or 1)).cast("int")
    ranked = df.withColumn("__b", bucket)
    starts = (
        ranked.groupBy(*group, "__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__s", F.sum("__n").over(Window.partitionBy(*group).orderBy("__b")) - F.col("__n"))
        .drop("__n")
    )
    inner = F.row_number().over(Window.partitionBy(*group, "__b").orderBy(*order))
    return (
        ranked.withColumn("__r", inner.cast("long") - 1)
        .join(starts, [*group, "__b"])
        .withColumn(name, F.col("__r") + F.col("__s"))
        .drop("__b", "__r", "__s")
    )


def connected_components(edges: DataFrame, label: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); component is the smallest node reachable.

    Alternates large-star and small-star steps until the edge set is a forest of stars. Each step is a partial aggregate
    and a join with its rows, a row a node with the node's number of edges: they are broadcast where they are few, else the
    hubs' are, so that the edges of a hub stay where they are. Each round is written to the shared folder."""
    cur = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label
    )
    before = None
    for _ in range(rounds):
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(state) or not state[0]:
            break
        before = tuple(state)
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = left_join_counted(both, materialize(low, label), ["u"], "n").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), label)
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), label)
        small = left_join_counted(large, low, ["u"], "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), label)
    else:
        raise RuntimeError(f"components of {label} not found in {rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def utf8_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


# ---- text buffers in tasks -------------------------------------------------------------------------------------

_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_MULT = 0x9E3779B97F4A7C15
BLOCK = 1 << 18  # bytes of a text that are worked on at once


def _powers(base: int) -> np.ndarray:
    """1, base, base ** 2, ... for the places of a block, modulo 2 ** 64."""
    out = np.full(BLOCK + 1, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER, _INVERSE = _powers(_MULT), _powers(pow(_MULT, -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow has kept of a batch goes back before the next one comes."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def slices(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `most` bytes (one document at least), so that memory stays small."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def trues_before(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of true bytes of `mask` before each of the ascending places `at`, block by block."""
    out, total, done = np.zeros(len(at), np.int64), 0, 0
    for low in range(0, len(mask), BLOCK):
        count = np.zeros(min(BLOCK, len(mask) - low) + 1, np.int64)
        np.cumsum(mask[low : low + BLOCK], out=count[1:])
        end = int(np.searchsorted(at, low + BLOCK))
        inside = at[done:end]
        out[done:end] = total + count[inside - low]
        total, done = total + int(count[-1]), end
    out[done:] = total
    return out


class Hashed:
    """Words of a run of documents with 64-bit hashes, all from prefix sums over the bytes.

    The sums are taken over blocks, so that a very long text needs memory for its words and a block, not some eight-byte
    numbers for each of its bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SEP):
        base = int(offsets[0])
        self.data = data[base : int(offsets[-1])]
        self.offsets = offsets - base
        n, docs = len(self.data), len(offsets) - 1
        self.docs = docs
        self._table = _BYTES[_LOWER] if lower else _BYTES
        self._whole = self._prefix(0, n) if n <= BLOCK else None
        blank = separators[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        near = np.ones(n, bool)
        near[1:] = blank[:-1]
        self.starts = np.flatnonzero(~blank & (near | edge[:n]))
        near[:] = True
        near[:-1] = blank[1:]
        self.ends = np.flatnonzero(~blank & (near | edge[1:])) + 1
        del blank, edge, near
        self.first = np.searchsorted(self.starts, self.offsets)  # word number at each document's start
        self.words = self.span(self.starts, self.ends)
        self.doc = np.repeat(np.arange(docs, dtype=np.int32), np.diff(self.first))

    def _prefix(self, low: int, high: int) -> np.ndarray:
        """Sums of the weighted bytes from low (at most a block) up to each place."""
        out = np.zeros(high - low + 1, np.uint64)
        np.cumsum(self._table[self.data[low:high]] * _POWER[: high - low], out=out[1:])
        return out

    def _long(self, start: int, end: int) -> int:
        """The weighted sum of more bytes than a block."""
        total = 0
        for low in range(start, end, BLOCK):
            total += int(self._prefix(low, min(low + BLOCK, end))[-1]) * pow(_MULT, low - start, 1 << 64)
        return total % (1 << 64)

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes from start to end, with the length; starts and ends ascend."""
        if self._whole is not None:
            h = (self._whole[ends] - self._whole[starts]) * _INVERSE[starts]
        else:
            h, i = np.empty(len(starts), np.uint64), 0
            while i < len(starts):
                low = int(starts[i])
                j = int(np.searchsorted(ends, low + BLOCK, "right"))
                if j <= i:
                    h[i] = self._long(low, int(ends[i]))
                    j = i + 1
                else:
                    sums, s, e = self._prefix(low, int(ends[j - 1])), starts[i:j] - low, ends[i:j] - low
                    h[i:j] = (sums[e] - sums[s]) * _INVERSE[s]
                i = j
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the first word, hash) of every n-word window inside a document."""
        if len(self.words) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        size = len(self.words) - n + 1
        h = np.full(size, np.uint64(n), np.uint64)
        for k in range(n):
            h = h * np.uint64(0xC6BC279692B5C323) + self.words[k : k + size]
        at = np.flatnonzero(self.doc[:size] == self.doc[n - 1 :])
        return at, mix(h[at])

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """The number of true ones per document of a flag for each byte."""
        return np.diff(trues_before(values, self.offsets))

    def per_doc_words(self, values: np.ndarray) -> np.ndarray:
        """Sums per document of a value for each word."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]
