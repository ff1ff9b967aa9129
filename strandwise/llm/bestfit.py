"""Best-fit packing of token pieces into sequences of fixed capacity, in bulk-synchronous supersteps.

A superstep range-sorts unplaced pieces and the sequences' gaps together, largest first, so that a sweep down the order
meets each gap before the pieces that fit in it. Every task sweeps its range: a piece takes the successor gap, the
smallest one on its stack, and what is left of that gap goes back in. What a range cannot settle by itself is ranked:
its pieces without a gap and its gaps without a piece. The ranges' counts (a row a range) say which ranks of which range
meet, so no two pieces get the same place, and a join on range and rank carries that out. The shrunken gaps go into the
next superstep. Pieces come in bands that halve in length, so large ones are placed before small ones fill what is left;
where no gap is large enough, sequences are opened. What is few enough for one task is swept there to the end, which is
best-fit decreasing."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffers, lean, materialize, slices, small_batches
from .encoding import LIMIT, RUN_BYTES, ByteLevelEncoder, loaded

CAPACITY = 2048
ROWS_A_TASK = 100_000  # pieces and gaps that one task sweeps, about 20 MB
PLACED, LEFT, FREE, SHRUNK = range(4)  # a piece with a place or without; a gap that no piece of the range took, or too small for it
SWEPT = "part int, role int, rank long, size long, seq long, offset long"


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str, cache_units: int = LIMIT, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and the end id, cut where longer than `capacity`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ByteLevelEncoder, tokenizer, cache_units)
        for batch in lean(batches):
            _, offsets = buffers(batch.column(1))
            for i, j in slices(offsets, run_bytes):
                ids, ends = encoder.ids(batch.column(1).slice(i, j - i), end_id)
                n = np.diff(ends)
                first = (n - 1) % capacity + 1
                times = (n - first) // capacity + 1
                of = np.repeat(np.arange(j - i), times)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                start = np.where(piece == 0, 0, first[of] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[of], capacity)
                raw = memoryview(ids).cast("B")
                at = 4 * (ends[of] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                kept = (batch.column(0).take(pa.array(of + i)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()))
                yield pa.RecordBatch.from_arrays(list(kept), names=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Sweep:
    """One range's sweep, from the largest size down."""

    def __init__(self, capacity: int):
        self.capacity, self.stack, self.shrunk, self.left = capacity, [], [], 0

    def piece(self, size: int) -> tuple[int, int | None, int | None, int | None]:
        """(role, rank, sequence, offset) of a piece."""
        self._ripen(size)
        if not self.stack:
            self.left += 1
            return LEFT, self.left - 1, None, None
        gap, seq = self.stack.pop()
        if gap - size >= size:
            self.stack.append((gap - size, seq))
        elif gap > size:
            heapq.heappush(self.shrunk, (size - gap, seq))
        return PLACED, None, seq, self.capacity - gap

    def gap(self, size: int, seq: int) -> None:
        self._ripen(size)
        self.stack.append((size, seq))

    def _ripen(self, size: int) -> None:
        """Shrunken gaps that the sweep has reached go on the stack, which stays in order of size."""
        while self.shrunk and -self.shrunk[0][0] >= size:
            gap, seq = heapq.heappop(self.shrunk)
            self.stack.append((-gap, seq))


def _swept(rows: DataFrame, capacity: int) -> DataFrame:
    """SWEPT and payload of sorted (size, seq, payload): `seq` is null for pieces, `payload` for gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sweep, kind = TaskContext.get().partitionId(), Sweep(capacity), None
        names = [*(c.split()[0] for c in SWEPT.split(", ")), "payload"]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

        def made(values: list[list], payload: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(v, k) for v, k in zip(values, kinds)), payload], names=names)

        for batch in batches:
            kind = batch.column(2).type
            sizes, seqs, out = batch.column(0).to_pylist(), batch.column(1), []
            for size, seq in zip(sizes, seqs.to_pylist()):
                if seq is None:
                    role, rank, place, offset = sweep.piece(size)
                    out.append((part, role, rank, size, place, offset))
                else:
                    sweep.gap(size, seq)
            yield made(list(zip(*out)) if out else [[]] * 6, batch.column(2).filter(seqs.is_null()))
        if kind is not None:
            gaps = [(part, FREE, k, size, seq, None) for k, (size, seq) in enumerate(reversed(sweep.stack))]
            gaps += [(part, SHRUNK, None, -size, seq, None) for size, seq in sweep.shrunk]
            yield made(list(zip(*gaps)) if gaps else [[]] * 6, pa.nulls(len(gaps), kind))

    payload = rows.schema["payload"].dataType.simpleString()
    return rows.mapInArrow(run, f"{SWEPT}, payload {payload}")


def meetings(ranges: dict[int, dict[int, tuple[int, int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks meet across ranges: (part, from, to, gap_part, first gap's rank, pieces a gap).

    ranges: part -> role -> (count, smallest, largest size), LEFT pieces and FREE gaps. Parts follow each other from the
    largest sizes down; a part's pieces take the nearest gaps above, those above theirs, and so on."""
    stack: list[list[int]] = []
    found = []
    for part in sorted(ranges):
        count, _, largest = ranges[part].get(LEFT, (0, 0, 0))
        rank = 0
        while rank < count and stack:
            top = stack[-1]
            gap_part, first, free, smallest = top
            each = smallest // largest
            take = min(free * each, count - rank)
            used = -(-take // each)
            found.append((part, rank, rank + take, gap_part, first, each))
            rank += take
            top[1], top[2] = first + used, free - used
            if not top[2]:
                stack.pop()
        if FREE in ranges[part]:
            free, smallest, _ = ranges[part][FREE]
            stack.append([part, 0, free, smallest])
    return found


def _superstep(spark, unplaced: DataFrame, gaps: DataFrame, rows: int, capacity: int, rows_a_task: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(placements, unplaced, gaps, number unplaced) after one sweep of (size, payload) into (size, seq)."""
    none = F.lit(None).cast(unplaced.schema["payload"].dataType)
    state = unplaced.select("size", F.lit(None).cast("long").alias("seq"), "payload", F.xxhash64("payload").alias("spread"))
    state = state.unionByName(gaps.select("size", "seq", none.alias("payload"), F.xxhash64("seq").alias("spread")))
    order = [F.col("size").desc(), F.col("seq").isNull(), F.col("spread"), F.col("seq")]
    state = state.coalesce(1) if rows <= rows_a_task else state.repartitionByRange(-(-rows // rows_a_task), *order[:3])
    swept = materialize(_swept(state.sortWithinPartitions(*order).select("size", "seq", "payload"), capacity), "swept")
    facts = swept.where(F.col("role").isin(LEFT, FREE)).groupBy("part", "role").agg(F.count(F.lit(1)), F.min("size"), F.max("size")).collect()  # two rows a task
    ranges: dict[int, dict[int, tuple]] = {}
    for part, role, *values in facts:
        ranges.setdefault(part, {})[role] = tuple(values)
    found = meetings(ranges)
    placed = swept.where(F.col("role") == PLACED).select("payload", "size", "seq", "offset")
    left = swept.where(F.col("role") == LEFT).select("part", "rank", "size", "payload")
    free = swept.where(F.col("role") == FREE).select("part", "rank", "size", "seq")
    shrunk = swept.where(F.col("role") == SHRUNK).select("size", "seq")
    n = sum(r[LEFT][0] for r in ranges.values() if LEFT in r) - sum(hi - lo for _, lo, hi, *_ in found)
    if not found:
        return placed, left.select("size", "payload"), shrunk.unionByName(free.select("size", "seq")), n
    table = F.broadcast(spark.createDataFrame(found, "part int, lo long, hi long, gap_part int, first long, each long"))  # fewer than two rows a task
    step = F.col("rank") - F.col("lo")
    asked = left.join(table, "part").where("rank >= lo and rank < hi")
    asked = asked.select("size", "payload", F.col("gap_part").alias("part"), (F.col("first") + F.floor(step / F.col("each"))).alias("rank"), (step % F.col("each")).alias("slot"))
    met = materialize(asked.join(free.withColumnRenamed("size", "gap"), ["part", "rank"]), "met")
    before = "sum(size) OVER (PARTITION BY seq ORDER BY slot) - size"  # at most `capacity` pieces a sequence
    placed = placed.unionByName(met.select("payload", "size", "seq", (F.lit(capacity) - F.col("gap") + F.expr(before)).alias("offset")))
    taken: dict[int, int] = {}
    for _, lo, hi, gap_part, first, each in found:
        taken[gap_part] = max(taken.get(gap_part, 0), first - (lo - hi) // each)  # rounded up
    done = {part: hi for part, _, hi, *_ in found}
    past = lambda df, upto: df.join(F.broadcast(spark.createDataFrame(list(upto.items()), "part int, upto long")), "part", "left").where("rank >= coalesce(upto, 0)")
    rest = met.groupBy("seq").agg((F.max("gap") - F.sum("size")).alias("size")).where("size > 0")
    gaps = shrunk.unionByName(past(free, taken).select("size", "seq")).unionByName(rest.select("size", "seq"))
    return placed, past(left, done).select("size", "payload"), gaps, n


def place(cut: DataFrame, capacity: int = CAPACITY, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Add sequence_id and offset to materialised pieces (any columns; `length` from 1 to `capacity`)."""
    spark = cut.sparkSession
    payload = F.struct(*(F.col(f"`{c}`") for c in cut.columns))
    rows = cut.select(F.col("length").cast("long").alias("size"), payload.alias("payload"))
    full = rows.where(F.col("size") == capacity)  # each a sequence of its own: no place to look for
    out = full.select("payload", (-1 - F.monotonically_increasing_id()).alias("seq"), F.lit(0).cast("long").alias("offset"))
    band = F.floor(F.log2(F.lit(float(capacity)) / F.col("size"))).cast("int")  # band b: lengths above capacity / 2^(b+1)
    some = rows.where(F.col("size") < capacity)
    counts = {r[0]: r[1] for r in some.groupBy(band.alias("b")).agg(F.count(F.lit(1))).collect()}
    gaps, n_gaps, most, opened = spark.createDataFrame([], "size long, seq long"), 0, 0, 0
    bands = sorted(counts)
    while bands:
        now = list(bands) if sum(counts[b] for b in bands) + n_gaps <= rows_a_task // 2 else bands[:1]  # half: sequences to open count as well
        bands = bands[len(now) :]
        unplaced, n = some.where(band.isin(now)), sum(counts[b] for b in now)
        while n:
            # as many sequences for pieces that no gap can hold as they need if each is with others of its length
            each = 1 / F.floor(F.lit(capacity) / F.col("size"))
            need, least = unplaced.agg(F.ceil(F.sum(F.when(F.col("size") > most, each))), F.min("size")).first()
            new, least = int(need or 0), least if bands else 1
            fresh = spark.range(new).select(F.lit(capacity).cast("long").alias("size"), (F.col("id") + opened).alias("seq"))
            opened += new
            used = gaps.where(F.col("size") >= least).unionByName(fresh)
            placed, unplaced, after, n = _superstep(spark, unplaced, used, n + n_gaps + new, capacity, rows_a_task)
            out = out.unionByName(placed.select("payload", "seq", "offset"))
            if n or bands:
                gaps = materialize(after.unionByName(gaps.where(F.col("size") < least)), "gaps")
                n_gaps, most = gaps.agg(F.count(F.lit(1)), F.max("size")).first()
                most = most or 0
    return out.select("payload.*", F.col("seq").alias("sequence_id"), "offset")


def best_fit(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", rows_a_task: int = ROWS_A_TASK,
    cache_units: int = LIMIT, run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every token of every text in few sequences.

    Null and empty texts hold the end id alone. Rows of one doc_id, and rows without doc_id, are packed each; pieces of one
    length are interchangeable. An empty table gives no rows. Other columns of `docs` are not read. `cache_units`
    bounds each half of a worker's cache of units, `run_bytes` what is encoded at once: memory and speed, never ids."""
    cut = materialize(pieces(docs, tokenizer, end_id, capacity, id_col, text_col, cache_units, run_bytes), "pieces")
    return place(cut, capacity, rows_a_task).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
