"""Alignment text as a Spark data source: planned byte ranges to read, single named files to write.

Reading: files are cut into byte ranges once; a first job counts the lines that start in each range, and the ranges with
their first line numbers are what the second job reads, so numbers and lines come from the same cuts whatever settings
change between, and nothing is joined or written. A file whose size is no longer the planned one raises.

Writing: each task streams its rows, which come by name and order, into temporary files of its own, one for each name, and
reports them. The commit, which only sees what succeeded, renames a name's only piece to `name`. Names that several tasks
have written are put together by tasks, a name a task, streamed in the order of the pieces. Failed attempts leave files
in a temporary folder only, which goes at the commit or the abort.

Tasks open files by pyarrow's file systems, so paths must be ones that it reaches: a folder all machines share, HDFS with
its client library, S3, GCS or Azure. For other stores there are read_lines and the folder layout of files.write_named."""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from strandwise.functions.fields import line_bytes
from strandwise.sources.files import materialize, measured

RANGE_BYTES = 128 << 20
MOST_RANGES = 20_000  # ranges grow beyond RANGE_BYTES so that the plan stays small
CHUNK = 4 << 20
WRITE_BYTES = 64 << 20  # of lines that one task sorts, in about three times as much memory, and writes
FORMAT = "alignment_text"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def listed(path: str, containing: str = "") -> list[tuple[str, int]]:
    """(file, bytes) of the files below a path by name: hidden ones and those in hidden folders are left out, as are names
    without `containing`."""
    store, root = _store(path)
    info = store.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    found = store.get_file_info(pafs.FileSelector(root, recursive=True))
    inside = lambda f: f.path[len(root) :].strip("/").split("/")
    return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not any(map(_hidden, inside(f))) and containing in inside(f)[-1])


@dataclass
class ByteRange(InputPartition):
    file: str
    size: int
    start: int
    end: int
    first: int = 0  # number of the first line that starts in the range
    index: int = 0

    def __post_init__(self):
        super().__init__(self.index)


class RangeReader(DataSourceReader):
    """Lines that start in each range, or with `count` how many."""

    def __init__(self, options: dict):
        self.path, self.count = options["path"], options.get("count") == "true"
        self.range_bytes, self.containing, self.plan = int(options.get("rangebytes", RANGE_BYTES)), options.get("containing", ""), options.get("plan")

    def partitions(self) -> list[ByteRange]:
        if self.plan:
            return [ByteRange(*r) for r in json.loads(self.plan)]
        files = listed(self.path, self.containing)
        width = max(self.range_bytes, -(-sum(n for _, n in files) // MOST_RANGES), 1)
        cuts = [(f, n, a, min(n, a + width)) for f, n in files for a in range(0, n, width)]
        return [ByteRange(*c, 0, k) for k, c in enumerate(cuts)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if part is None or part.file is None:
            return
        store, _ = _store(self.path)
        with store.open_input_file(part.file) as file:
            if file.size() != part.size:
                raise ValueError(f"{part.file} has changed: {part.size} bytes were planned, it has {file.size()}")
            if self.count:
                yield pa.RecordBatch.from_arrays([pa.array([json.dumps([part.file, part.size, part.start, part.end])]), pa.array([self._starts(file, part)], pa.int64()), pa.array([""])], ["file", "line_no", "line"])
                return
            yield from self._lines(file, part)

    @staticmethod
    def _starts(file: pa.NativeFile, part: ByteRange) -> int:
        """Lines that start in the range: ends before its bytes, and the file's first line."""
        n, at, end = int(part.start == 0), max(0, part.start - 1), part.end - 1
        file.seek(at)
        while at < end:
            chunk = file.read(min(CHUNK, end - at))
            n += chunk.count(b"\n")
            at += len(chunk)
        return n

    @staticmethod
    def _lines(file: pa.NativeFile, part: ByteRange) -> Iterator[pa.RecordBatch]:
        """Batches of (file, line_no, line); whole chunks are cut at line ends by numpy."""
        number, at = part.first, max(0, part.start - 1)
        file.seek(at)
        inside = part.start == 0  # whether what comes next is a line of this range
        held: list[bytes] = []  # the start of a line whose end is still to come
        while True:
            chunk = file.read(CHUNK)
            data = np.frombuffer(chunk, np.uint8)
            ends = np.flatnonzero(data == 10)
            skipped = 0
            if not inside:
                if not len(ends) and chunk:
                    at += len(chunk)
                    continue
                if not chunk or at + int(ends[0]) + 1 >= part.end:
                    return
                skipped, ends, inside = int(ends[0]) + 1, ends[1:], True
            last = not chunk
            starts = np.concatenate([[skipped], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
            keep = int(np.searchsorted(at + starts, part.end, "left"))  # the first one may have begun in an earlier chunk
            if held and len(ends):
                keep = max(keep, 1)
            if keep:
                body = b"".join(held) + chunk[skipped : int(ends[keep - 1])]
                lines = np.frombuffer(body, np.uint8)
                breaks = lines == 10
                offsets = np.zeros(keep + 1, np.int64)
                offsets[1:-1] = np.flatnonzero(breaks) - np.arange(keep - 1)
                offsets[-1] = len(lines) - (keep - 1)
                text = pa.LargeStringArray.from_buffers(keep, pa.py_buffer(offsets), pa.py_buffer(lines[~breaks].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.repeat(part.file, keep), pa.array(np.arange(number, number + keep)), text.cast(pa.string())], ["file", "line_no", "line"])
                number += keep
                held = []
            if keep < len(ends):
                return
            rest = int(ends[-1]) + 1 if len(ends) else skipped
            if last:
                if held and b"".join(held):
                    yield pa.RecordBatch.from_arrays([pa.array([part.file]), pa.array([number]), pa.array([b"".join(held).decode("utf-8", "replace")])], ["file", "line_no", "line"])
                return
            if not held and at + rest >= part.end:
                return
            if rest < len(chunk):
                held.append(chunk[rest:])
            at += len(chunk)


@dataclass
class Pieces(WriterCommitMessage):
    order: int  # of the task
    pieces: list  # (name, temporary file, bytes, lines)


class NamedWriter(DataSourceArrowWriter):
    """Rows (name, line) into a file a name; a null line makes the file without a line."""

    def __init__(self, options: dict):
        self.path, self.existing, self.job = options["path"], options.get("existing", "error"), options.get("job") or uuid.uuid4().hex
        store, root = _store(self.path)
        there = store.get_file_info(root).type == pafs.FileType.Directory
        old = [f for f in store.get_file_info(pafs.FileSelector(root)) if not _hidden(f.base_name)] if there else []
        if self.existing == "error" and old:
            raise FileExistsError(f"{self.path} has files")

    def _temporary(self, root: str) -> str:
        return posixpath.join(root, f"_temporary-{self.job}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Pieces:
        store, root = _store(self.path)
        folder, done, out, now = self._temporary(root), [], None, None
        store.create_dir(folder, recursive=True)
        try:
            for batch in iterator:
                names, lines = batch.column("name").to_pylist(), batch.column("line")
                cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a == b:
                        continue
                    if names[a] != now or out is None:
                        if out is not None:
                            out.close()
                        now = names[a]
                        if not now or "/" in now or _hidden(now):
                            raise ValueError(f"no name for a file: {now!r}")
                        temporary = posixpath.join(folder, uuid.uuid4().hex)
                        out = store.open_output_stream(temporary)
                        done.append([now, temporary, 0, 0])
                    text = [x for x in lines.slice(a, b - a).to_pylist() if x is not None]
                    if text:
                        body = ("\n".join(text) + "\n").encode()
                        out.write(body)
                        done[-1][2] += len(body)
                        done[-1][3] += len(text)
        finally:
            if out is not None:
                out.close()
        context = TaskContext.get()
        return Pieces(context.partitionId() if context else 0, done)

    def commit(self, messages: list[Pieces | None]) -> None:
        """Rename what is whole; what came in pieces goes to a hidden folder, in order; write the list of names."""
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        if self.existing == "overwrite":
            for f in store.get_file_info(pafs.FileSelector(root)):
                if f.path != self._temporary(root):
                    (store.delete_dir if f.type == pafs.FileType.Directory else store.delete_file)(f.path)
        by_name: dict[str, list] = {}
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.order):
            for name, *piece in m.pieces:
                by_name.setdefault(name, []).append(piece)
        folder = posixpath.join(root, f"_names-{self.job}")
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(posixpath.join(folder, "names.json")) as out:
            for name, pieces in sorted(by_name.items()):
                moved = []
                for k, (temporary, _, _) in enumerate(pieces):
                    to = posixpath.join(root, name) if len(pieces) == 1 else posixpath.join(folder, f"{name}.{k:06d}")
                    store.move(temporary, to)
                    moved.append(to)
                row = {"name": name, "pieces": moved, "bytes": sum(p[1] for p in pieces), "lines": sum(p[2] for p in pieces)}
                out.write((json.dumps(row) + "\n").encode())
        self._clear(store, root)

    def _clear(self, store: pafs.FileSystem, root: str) -> None:
        if store.get_file_info(self._temporary(root)).type == pafs.FileType.Directory:
            store.delete_dir(self._temporary(root))

    def abort(self, messages: list[Pieces | None]) -> None:
        self._clear(*_store(self.path))


class AlignmentText(DataSource):
    """format("alignment_text"): reads (file, line_no, line), writes (name, line)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, line_no long, line string"

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options)


def read_ranges(spark: SparkSession, path: str, containing: str = "", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, line_no, line) of the files below a path, numbered by planned byte ranges; lines end at \\n only.

    The counts of the first job, a row a range, MOST_RANGES at most beyond one a file, are the plan of the reading job."""
    spark.dataSource.register(AlignmentText)
    reader = lambda: spark.read.format(FORMAT).option("containing", containing).option("rangeBytes", range_bytes)
    rows = [] if not listed(path, containing) else reader().option("count", "true").load(path).select("file", "line_no").collect()
    ranges = sorted([*json.loads(r.file), r.line_no] for r in rows)
    plan, file, at = [], None, 0
    for k, (f, size, start, end, n) in enumerate(ranges):
        at = at if f == file else 0
        plan.append([f, size, start, end, at, k])
        file, at = f, at + n
    if not plan:
        return spark.createDataFrame([], "file string, line_no long, line string")
    return reader().option("plan", json.dumps(plan)).load(path)


def _put_together(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        for batch in batches:
            for name, pieces in zip(batch.column("name").to_pylist(), batch.column("pieces").to_pylist(), strict=True):
                temporary = posixpath.join(posixpath.dirname(pieces[0]), uuid.uuid4().hex)
                with store.open_output_stream(temporary) as out:
                    for piece in pieces:
                        with store.open_input_stream(piece) as part:
                            while chunk := part.read(CHUNK):
                                out.write(chunk)
                store.move(temporary, posixpath.join(root, name))
            yield pa.RecordBatch.from_arrays([batch.column("name")], ["name"])

    return run


def write_named_files(lines: DataFrame, path: str, name: str, order: list[str], mode: str = "errorifexists", every: DataFrame | None = None, range_bytes: int = WRITE_BYTES, size: int | None = None) -> DataFrame:
    """One file `name` for each value of the column `name`: its lines in order, LF-ended. Returns (name, bytes, lines).

    every (name): names that get a file even if no line is theirs. Rows are dealt by ranges of (name, order), about
    `range_bytes` each, so a name with very many lines is written by several tasks and many small ones share a task. mode:
    errorifexists, overwrite (what is in the folder goes at the commit) or append (other files stay). `size`: the lines'
    bytes where `lines` are written ones, which are then not written again before they are dealt."""
    spark, job = lines.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(AlignmentText)
    rows = lines.select(F.col(name).alias("name"), *(F.col(c).alias(f"__o{k}") for k, c in enumerate(order)), "line")
    by = ["name", *(f"__o{k}" for k in range(len(order)))]
    if every is not None:
        rows = rows.unionByName(every.select(F.col(name).alias("name"), F.lit(None).cast("string").alias("line")), allowMissingColumns=True)
    if size is None:
        rows, seen = measured(rows, "lines", bytes=F.sum(line_bytes(F.col("line"))))
        size = seen["bytes"] or 0
    ranges = max(spark.sparkContext.defaultParallelism, -(-size // range_bytes))
    dealt = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by).select("name", "line")
    existing = {"errorifexists": "error", "error": "error"}.get(mode, mode)
    dealt.write.format(FORMAT).mode("append").option("existing", existing).option("job", job).save(path)
    found = spark.read.schema("name string, pieces array<string>, bytes long, lines long").json(f"{path}/_names-{job}/names.json")
    kept = materialize(found.select("name", "bytes", "lines"), "names")
    parts = found.where(F.size("pieces") > 1).select("name", "pieces")
    if not parts.isEmpty():
        parts.repartition("name").mapInArrow(_put_together(path), "name string").write.format("noop").mode("overwrite").save()
    store, root = _store(path)
    store.delete_dir(posixpath.join(root, f"_names-{job}"))
    return kept
