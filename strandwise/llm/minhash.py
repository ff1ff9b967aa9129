"""Near-duplicate groups by b-bit MinHash.

1. One pass hashes the word shingles of each whole text and keeps a hash of its set, its band keys and the packed low
   bits of its minima. Equal sets collapse to one representative before anything is paired, so a group of copies costs
   one row; sets and band keys that very many rows share are broadcast to them.
2. Representatives that share a band key are tied to the key's smallest one; the components of those ties are the
   candidate groups. No pairs are made.
3. The texts of candidates are read again for their full sets. Inside a candidate
   group, in blocks of bounded size, pairs not yet joined are estimated from the packed bits (collision-corrected) and
   those near the threshold or above are confirmed on full sets; the links that join are kept.
4. Components of the confirmed links are the duplicate groups.

A group larger than a block is first compared with a few pivots, spread over salts; only rows that the main pivot does
not join are compared with the others, block by block. No bucket, partner or candidate is capped."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwise.sources.files import left_join_counted

from .common import Hashed, buffers, connected_components, lean, materialize, mix, slices, small_batches

ROWS = 6  # minima a band: texts that share a hundredth of their shingles meet in a band once in 1e10 pairs
BITS = 4  # low bits kept of each minimum
MISS = 1e-7  # chance that no band shows a pair at the threshold
BLOCK_ROWS = 1000
BLOCK_BYTES = 32 << 20
PIVOTS = 4
SALTS = 16
BROADCAST_ROWS = 1_000_000  # 8 MB of ids


def band_count(similarity: float) -> int:
    """Bands for a miss chance of MISS at `similarity`, as many as fill whole longs with their minima's low bits."""
    need = math.log(MISS) / math.log(1 - similarity**ROWS)
    step = (64 // BITS) // math.gcd(ROWS, 64 // BITS)
    return step * math.ceil(need / step)


def _factors(hashes: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(run: Hashed, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash), sorted by document: each `size`-word window, or the whole sequence of a shorter text."""
    at, hashes = run.grams(size)
    docs = run.doc[at]
    n_words = np.diff(run.first)
    for n in range(1, size):
        short = np.flatnonzero(n_words == n)
        if len(short):
            h = np.full(len(short), np.uint64(1000 + n), np.uint64)
            for k in range(n):
                h = h * np.uint64(0xC6BC279692B5C323) + run.words[run.first[short] + k]
            docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, mix(h)])
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[fresh], hashes[fresh]


def minima(docs: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents that have shingles, their n minima)."""
    starts = np.flatnonzero(np.diff(docs, prepend=-1))
    out = np.empty((len(starts), n), np.uint64)
    for k, factor in enumerate(_factors(n)):
        out[:, k] = np.minimum.reduceat(hashes * factor, starts)
    return docs[starts], mix(out)


def packed(lows: np.ndarray) -> np.ndarray:
    """The low BITS of each minimum, 64 / BITS of them in one word."""
    per = 64 // BITS
    shifts = (np.arange(per, dtype=np.uint64) * np.uint64(BITS))[None, None, :]
    low = (lows & np.uint64((1 << BITS) - 1)).reshape(len(lows), -1, per)
    return np.bitwise_or.reduce(low << shifts, axis=2)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of a packed signature with many, corrected for chance matches of BITS bits."""
    x = one[None, :] ^ many
    for k in range(1, BITS):
        x = x | (x >> np.uint64(k)) if k == 1 else x | ((one[None, :] ^ many) >> np.uint64(k))
    lowest = np.uint64(int("1".rjust(BITS, "0") * (64 // BITS), 2))
    differ = np.bitwise_count(x & lowest).sum(axis=1, dtype=np.int64)
    n = many.shape[1] * (64 // BITS)
    chance = 2.0**-BITS
    return ((n - differ) / n - chance) / (1 - chance)


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands, packed): set size, 128-bit hash of the set, band keys and the packed low bits of
    the minima; no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(1))
            for i, j in slices(offsets):
                run = Hashed(data, offsets[i : j + 1], lower=True)
                doc, h = shingles(run, size)
                counts = np.bincount(doc, minlength=j - i)
                have, lows = minima(doc, h, bands * ROWS)
                starts = np.flatnonzero(np.diff(doc, prepend=-1))
                keys = np.zeros((2, j - i), np.uint64)
                for k in range(2):
                    if len(starts):
                        keys[k, have] = mix(np.add.reduceat(mix(h + np.uint64(k + 1)), starts) + counts[have].astype(np.uint64))
                band = np.full((len(have), bands), np.uint64(11), np.uint64)
                for k in range(ROWS):
                    band = band * np.uint64(0xC6BC279692B5C323) + lows[:, k::ROWS]
                band = mix(band + np.arange(bands, dtype=np.uint64)[None, :])
                ends = np.zeros(j - i, np.int64)
                ends[have] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(ends)]).astype(np.int32)), pa.array(band.reshape(-1).view(np.int64)))
                bits: list = [None] * (j - i)
                for d, low in zip(have.tolist(), packed(lows)):
                    bits[d] = low.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(counts.astype(np.int64)), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), lists, pa.array(bits, pa.binary())],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "packed"],
                )

    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text"))
    return source.mapInArrow(rows, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, packed binary")


def full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(rep, cc, packed, bytes, shingles) of (rep, cc, packed, text): with the sorted full set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(3))
            for i, j in slices(offsets):
                doc, h = shingles(Hashed(data, offsets[i : j + 1], lower=True), size)
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                sets = [h[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                kept = [batch.column(k).slice(i, j - i) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.binary())], names=["rep", "cc", "packed", "bytes", "shingles"])

    return texts.mapInArrow(rows, "rep long, cc long, packed binary, bytes long, shingles binary")


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |a & b| >= num * |a | b| for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def joins(reps: list[int], sets: list[bytes], low: list[bytes], main: list[bool], num: int, den: int) -> list[tuple[int, int]]:
    """Links that join the rows of one block; rows of `main` count as joined from the start.

    Every pair not yet joined is looked at: sizes first, then the packed estimate less six standard deviations, then
    the full sets."""
    n = len(reps)
    arrays = [np.frombuffer(s, np.uint64) for s in sets]
    size = np.array([len(a) for a in arrays])
    sig = np.stack([np.frombuffer(x, np.uint64) for x in low])
    label = np.arange(n)
    inside = np.flatnonzero(np.array(main, bool))
    if len(inside):
        label[inside] = inside[0]
    floor = _floor(num, den, sig.shape[1] * (64 // BITS))
    links = []
    for i in range(n - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(rest):
            continue
        low_size, high_size = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        rest = rest[den * low_size >= num * high_size]
        rest = rest[estimate(sig[i], sig[rest]) >= floor] if len(rest) else rest
        for j in rest.tolist():
            if label[j] != label[i] and similar(arrays[i], arrays[j], num, den):
                links.append((reps[i], reps[j]))
                label[label == label[j]] = label[i]
    return links


def _block_links(blocks: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """(a, b): links inside each group of `keys`; groups are runs of the sorted partitions."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def flush():
            found = joins(*map(list, zip(*held)), num, den) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(len(keys))]
            values = [batch.column(k).to_pylist() for k in range(len(keys), len(keys) + 4)]
            for key, row in zip(zip(*columns), zip(*values)):
                if key != current:
                    if len(held) > 1:
                        yield flush()
                    held, current = [], key
                held.append(row)
        if len(held) > 1:
            yield flush()

    return (
        blocks.select(*keys, "rep", "shingles", "packed", "main")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "rep")
        .mapInArrow(rows, "a long, b long")
    )


def _floor(num: int, den: int, bits: int) -> float:
    """The least estimate from `bits` minima that may still be a link: six standard deviations below the threshold."""
    t = num / den
    return t - 6 * math.sqrt(t * (1 - t) / bits) - 0.02


def _likely(cells: DataFrame, keys: list[str], num: int, den: int) -> DataFrame:
    """(keys, rep, main) of the rows of each cell that have a partner by the packed bits, not both of `main`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def flush():
            sig = np.stack([np.frombuffer(r[-1], np.uint64) for r in held])
            main = np.array([r[-2] for r in held], bool)
            floor, keep = _floor(num, den, sig.shape[1] * (64 // BITS)), np.zeros(len(held), bool)
            for i in np.flatnonzero(~main).tolist():
                hit = estimate(sig[i], sig) >= floor
                hit[i] = False
                keep |= hit
                keep[i] |= hit.any()
            kept = [held[i][:-1] for i in np.flatnonzero(keep).tolist()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()))], names=[*keys, "rep", "main"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[: len(keys)] != current:
                    if len(held) > 1:
                        yield flush()
                    held, current = [], row[: len(keys)]
                held.append(row)
        if len(held) > 1:
            yield flush()

    dealt = cells.select(*keys, "rep", "main", "packed").repartition(*keys).sortWithinPartitions(*keys, "rep")
    return dealt.mapInArrow(rows, "cc long, kind string, x int, y int, rep long, main boolean")


def _pair_links(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of those (a, b, set_a, set_b) that are similar."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den) for x, y in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return pairs.mapInArrow(rows, "a long, b long")


def _confirmed(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links that join what is similar inside each candidate group of `sets`."""
    groups = sets.groupBy("cc").agg(F.count(F.lit(1)).alias("m"), F.sum("bytes").alias("total")).where("m > 1")
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_BYTES)).cast("int")
    groups = materialize(groups.withColumn("blocks", blocks), "groups")
    sized = sets.join(groups.select("cc", "blocks"), "cc")
    small = sized.where("blocks = 1").withColumn("main", F.lit(False))
    links = _block_links(small, ["cc"], num, den)
    if groups.where("blocks > 1").isEmpty():
        return links
    # hot groups: a few pivots, then only what the main pivot does not join against the rest, block by block
    order = F.xxhash64("rep")
    hot = materialize(sized.where("blocks > 1").withColumn("h", order).withColumn("slot", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(PIVOTS)).cast("int")), "hot")
    chosen = hot.groupBy("cc", "slot").agg(F.min("h").alias("h"))
    pivots = hot.join(chosen, ["cc", "slot", "h"]).select("cc", F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    salted = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = hot.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).join(salted, ["cc", "salt"]).where("rep <> b")
    tied = materialize(_pair_links(pairs.select(F.col("rep").alias("a"), "b", F.col("shingles").alias("set_a"), "set_b"), num, den), "pivots")
    degree = tied.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(pivots.select("cc", "b"), "b", "right")
    best = degree.groupBy("cc").agg(F.max(F.struct(F.coalesce("n", F.lit(0)), "b"))["b"].alias("pivot"))
    joined = tied.select(F.col("a").alias("rep"), F.col("b").alias("pivot")).withColumn("tie", F.lit(True))
    roles = hot.select("cc", "rep", "blocks", "bytes").join(best, "cc").join(joined, ["rep", "pivot"], "left")
    roles = materialize(roles.withColumn("main", F.coalesce("tie", F.col("rep") == F.col("pivot"))).select("cc", "rep", "bytes", "blocks", "main"), "roles")
    left = roles.where("not main").groupBy("cc").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("lefts"))
    roles = roles.join(left, "cc").withColumn("own", F.pmod(F.xxhash64("rep", F.lit(2)), F.when(F.col("main"), F.col("blocks")).otherwise(F.col("lefts"))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    own, lefts, count = F.col("own"), F.col("lefts"), F.col("blocks")
    cell = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    cells = F.when(F.col("main"), F.transform(every(lefts), lambda x: cell("m", x, own))).otherwise(
        F.concat(
            F.transform(every(count), lambda y: cell("m", own, y)),
            F.transform(every(lefts), lambda y: cell("l", F.least(own, y), F.greatest(own, y))),
        )
    )
    placed = roles.select("cc", "rep", "main", F.explode(cells).alias("cell")).select("cc", "rep", "main", "cell.kind", "cell.x", "cell.y")
    # packed bits alone go to every cell first; full sets follow only those rows that have a likely partner there
    likely = materialize(_likely(placed.join(hot.select("rep", "packed"), "rep"), ["cc", "kind", "x", "y"], num, den), "likely")
    rows = likely.join(hot.select("rep", "shingles", "packed"), "rep")
    return links.unionByName(tied).unionByName(_block_links(rows, ["cc", "kind", "x", "y"], num, den))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): groups of texts with den * intersection >= num * union.

    Words are what stands between ASCII blanks, A-Z in lower case; a set holds the distinct `size`-word shingles, or
    the whole sequence of a shorter text. component_id is the smallest doc_id reachable over links; kept is
    doc_id = component_id. Null texts and texts without words have an empty set and link with nothing. Rows of one
    doc_id are one document. Rows without doc_id link with nothing; their component is null and they are kept."""
    bands = band_count(num / den)
    signed = materialize(signatures(docs, id_col, text_col, size, bands), "signatures")
    known = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = signed.where(known).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    classes = materialize(classes, "classes")  # only sets of several rows: all others stand for themselves
    sets_of = signed.select("doc_id", "n_shingles", "bands", "packed", *(F.when(known, F.col(k)).alias(k) for k in ("k1", "k2")))
    shared = left_join_counted(sets_of, classes, ["k1", "k2"], "n").withColumn("rep", F.coalesce("first", "doc_id"))
    own = F.col("k1").isNotNull() & (F.col("rep") == F.col("doc_id"))
    table = materialize(shared.select("doc_id", "n_shingles", "rep", *(F.when(own, F.col(c)).alias(c) for c in ("bands", "packed"))), "table")
    reps = table.where("bands is not null")
    keys = reps.select("rep", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first")).where("n > 1")
    met = left_join_counted(keys, materialize(buckets, "buckets"), ["key"], "n")
    ties = met.where("rep <> first").select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()
    groups = materialize(connected_components(ties, "candidates"), "candidates")
    wanted = groups.select(F.col("node").alias("rep"), F.col("component").alias("cc"))
    count = groups.count()
    few = count <= BROADCAST_ROWS
    low = reps.select("rep", "packed").dropDuplicates(["rep"])
    wanted = materialize(low.join(F.broadcast(wanted) if few else wanted, "rep"), "wanted")
    light = count <= BROADCAST_ROWS // 4  # of 140 bytes each
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("__text")).join(F.broadcast(wanted) if light else wanted, "rep")
    sets = materialize(full_sets(texts.select("rep", "cc", "packed", "__text"), size), "sets")
    found = connected_components(_confirmed(sets, num, den), "links").withColumnsRenamed({"node": "rep"})
    return table.join(found, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("component", "rep"), F.lit(True)).alias("kept")
    )
