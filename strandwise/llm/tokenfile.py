"""Token-id files: each document is one zstandard frame, all with one shared dictionary.

A file set is a folder: `dictionary` (bytes and sha256) and `blocks`, Parquet rows of about BLOCK_BYTES that hold whole
frames one after another (`frames`), with an index (doc ids, frame ends, token counts, the tokens of the part before
the block) and the dictionary's hash. Blocks
follow in ascending doc_id order over (part, block). One short document is read from one block's index and one frame.
Texts are encoded and compressed where they are read, so that only frames move. Everything goes through Spark's reader
and writer, so any store works and a lost task is written again."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import buffers, lean, materialize, slices, small_batches
from .encoding import RUN_BYTES, ByteLevelEncoder, loaded

DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS, SAMPLE_BYTES = 400, 16 << 10  # about so many texts, each of so many bytes at most, train the dictionary: it changes sizes, never ids
LEAST_SAMPLES, LEAST_BYTES = 16, 8 << 10  # what is less is too little to train on and serves as raw content
PART_BYTES = 32 << 20  # of frames in a file
GROUP_BYTES = 8 << 20  # of a row group: what a reader holds at once
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4096
LEVEL = 3
BROADCAST_PARTS = 1_000_000  # 12 MB; more files are joined by shuffling
BLOCKS = "part int, block int, before long, dictionary_sha256 string, doc_ids array<long>, ends array<long>, n_tokens array<long>, tokens long, frames binary"


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of id arrays; fewer than LEAST_SAMPLES or LEAST_BYTES serve as raw content."""
    import zstandard

    total = sum(map(len, samples))
    if len(samples) >= LEAST_SAMPLES and total > LEAST_BYTES:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 10)), samples).as_bytes()
        except zstandard.ZstdError:  # samples too much alike
            pass
    return b"".join(samples)[-size:]


def sample_ids(source: DataFrame, tokenizer: str, end_id: int, docs: int = SAMPLE_DOCS, most: int = SAMPLE_BYTES) -> list[bytes]:
    """Id arrays of about `docs` texts (2 x `docs` at most) of at most `most` bytes, taken evenly from the whole table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ByteLevelEncoder, tokenizer)
        for batch in batches:
            ids, ends = encoder.ids(batch.column(0), end_id)
            yield pa.RecordBatch.from_arrays([pa.array([ids[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())], names=["ids"])

    n = source.count()
    short = source.sample(min(1.0, docs / max(n, 1)), seed=1).where(F.octet_length("text") <= most).select("text").limit(2 * docs)
    return [bytes(r[0]) for r in short.mapInArrow(rows, "ids binary").collect()]


FRAMES = "doc_id long, n long, crc long, frame binary"


def frames_of(source: DataFrame, tokenizer: str, end_id: int, dictionary: bytes) -> DataFrame:
    """FRAMES of (doc_id, text): number and crc32 of each text's ids, compressed; no shuffle."""
    import zstandard

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ByteLevelEncoder, tokenizer)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        for batch in lean(batches):
            _, offsets = buffers(batch.column(1))
            for i, j in slices(offsets, RUN_BYTES):
                ids, ends = encoder.ids(batch.column(1).slice(i, j - i), end_id)
                raw, at = memoryview(ids).cast("B"), (4 * ends).tolist()
                cuts = list(zip(at, at[1:]))
                made = [pa.array(np.diff(ends)), pa.array([zlib.crc32(raw[a:b]) for a, b in cuts], pa.int64()), pa.array([press.compress(raw[a:b]) for a, b in cuts], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *made], names=["doc_id", "n", "crc", "frame"])

    small_batches(source.sparkSession)
    return source.mapInArrow(rows, FRAMES)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write every whole text's ids with the end id; returns the dictionary's sha256.

    Null and empty texts hold the end id alone. Rows without doc_id come first; rows of one doc_id follow each other by
    the number and crc32 of their ids. Other columns are not read. An empty table gives no blocks."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dictionary = train_dictionary(sample_ids(source, tokenizer, end_id))
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, content binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def cut() -> pa.RecordBatch:
            ends = np.cumsum([len(f) for _, _, f in held]).tolist()
            values = [part, block, before, digest, [d for d, _, _ in held], ends, [n for _, n, _ in held], sum(n for _, n, _ in held), b"".join(f for _, _, f in held)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            names = ["part", "block", "before", "dictionary_sha256", "doc_ids", "ends", "n_tokens", "tokens", "frames"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.append((doc_id, n, frame))
                size += len(frame)
                if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCS:
                    yield cut()
                    block, before, held, size = block + 1, before + sum(n for _, n, _ in held), [], 0
        if held:
            yield cut()

    frames = materialize(frames_of(source, tokenizer, end_id, dictionary), "frames")  # written: range bounds are found before rows are dealt
    total = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_first(), "n", "crc"]
    files = max(-(-total // PART_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // BLOCK_BYTES)), 1)
    ordered = frames.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "n", "frame")
    ordered.mapInArrow(rows, BLOCKS).write.option("compression", "none").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/blocks")
    return digest


def _frames(spark: SparkSession, path: str):
    """A function in tasks: (frames, ends) -> ids of each document; checks the dictionary's hash first."""
    import zstandard

    row = spark.read.parquet(f"{path}/dictionary").first()  # one row of DICTIONARY_BYTES at most
    digest, content = row["sha256"], bytes(row["content"])
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError("the dictionary does not match its hash")

    def opened():
        press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))

        def ids(sha: str, frames: bytes, start: int, end: int) -> bytes:
            if sha != digest:
                raise ValueError("a block was written with another dictionary")
            return press.decompress(frames[start:end])

        return ids

    return opened


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) read back from the files; start counts all ids before the document."""
    opened = _frames(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = materialize(blocks.groupBy("part").agg(F.sum("tokens").alias("n")).select("part", before.alias("part_start")), "parts")  # a row a file
    starts = F.broadcast(parts) if parts.count() <= BROADCAST_PARTS else parts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = opened()
        for batch in batches:
            for b in range(batch.num_rows):
                sha, doc_ids, ends, counts, frames, start = (batch.column(k)[b].as_py() for k in range(6))
                ids = [ids_of(sha, frames, s, e) for s, e in zip([0, *ends], ends)]
                if [len(x) // 4 for x in ids] != counts:
                    raise ValueError("a frame does not hold as many ids as the index says")
                first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) + start
                columns = [pa.array(doc_ids, pa.int64()), pa.array(first), pa.array(counts, pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = blocks.join(starts, "part").withColumn("start", F.col("part_start") + F.col("before"))
    joined = joined.select("dictionary_sha256", "doc_ids", "ends", "n_tokens", "frames", "start")
    return joined.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def lookup(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """(doc_id, ids) of one document: the index is filtered first, one frame is decompressed."""
    opened = _frames(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = opened()
        for batch in batches:
            for b in range(batch.num_rows):
                sha, doc_ids, ends, frames = (batch.column(k)[b].as_py() for k in range(4))
                found = [ids_of(sha, frames, ([0, *ends])[k], ends[k]) for k, d in enumerate(doc_ids) if d == doc_id]
                ids = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(found), pa.int64()), ids], names=["doc_id", "ids"])

    return blocks.select("dictionary_sha256", "doc_ids", "ends", "frames").mapInArrow(rows, "doc_id long, ids array<int>")
