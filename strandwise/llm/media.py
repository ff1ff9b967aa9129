"""Media columns: signature sniffing.

An Aho-Corasick automaton finds every magic number in a blob in one scan; a validator of the format walks its structure
and gives the length, so that a chance match is refused, a wrong declared type is corrected and media inside other bytes
are carved out. Everything is a narrow pass over the blobs."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20  # of blobs handled at once
SPANS = "array<struct<type:string,offset:long,length:long,width:long,height:long>>"


class Span(NamedTuple):
    type: str
    offset: int
    length: int
    width: int
    height: int


def _png(b: bytes, at: int) -> tuple[int, int, int] | None:
    i, size = at + 8, None
    while i + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, i)
        end = i + 12 + n
        if end > len(b) or zlib.crc32(b[i + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if size is None:
            if kind != b"IHDR" or n != 13:
                return None
            size = struct.unpack_from(">II", b, i + 8)
        if kind == b"IEND":
            return end - at, *size
        i = end
    return None


def _riff(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 12 > len(b):
        return None
    size = struct.unpack_from("<I", b, at + 4)[0]
    end, i, channels, data = at + 8 + size, at + 12, 0, None
    if end > len(b) or size < 4:
        return None
    while i + 8 <= end:
        kind, n = struct.unpack_from("<4sI", b, i)
        if i + 8 + n > end:
            return None
        if kind == b"fmt " and n >= 16:
            channels = struct.unpack_from("<H", b, i + 10)[0]
        if kind in (b"data", b"VP8 ", b"VP8L", b"VP8X"):
            data = n
        i += 8 + n + n % 2
    return None if data is None or i not in (end, end + 1) else (8 + size, data, channels)  # the last pad byte may be missing


def _wav(b: bytes, at: int):
    return _riff(b, at) if b[at + 8 : at + 12] == b"WAVE" else None


def _webp(b: bytes, at: int):
    return _riff(b, at) if b[at + 8 : at + 12] == b"WEBP" else None


def _bmp(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 54 > len(b):
        return None
    size, reserved, start, header, width, height, planes, depth, packing = struct.unpack_from("<IIIIiiHHI", b, at + 2)
    # packing -> depths: 1 and 2 are run lengths (bottom-up only), 3 has bit fields: after a 40-byte header, in a larger one
    depths = {0: (1, 4, 8, 16, 24, 32), 1: (8,), 2: (4,), 3: (16, 32)}.get(packing, ())
    if reserved or header not in (40, 108, 124) or planes != 1 or depth not in depths or width <= 0 or not height:
        return None
    body = (width * depth + 31) // 32 * 4 * abs(height)
    if packing in (1, 2):
        body = struct.unpack_from("<I", b, at + 34)[0]
        if not body or height < 0:
            return None
    fields = 12 if packing == 3 and header == 40 else 0
    if size != start + body or start < 14 + header + fields or at + size > len(b):
        return None
    return size, width, abs(height)


def _gif(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 13 > len(b):
        return None
    width, height, flags = struct.unpack_from("<HHB", b, at + 6)
    i = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)

    def blocks(i: int) -> int:
        while i < len(b) and b[i]:
            i += b[i] + 1
        return i + 1

    while i < len(b):
        if b[i] == 0x3B:
            return i + 1 - at, width, height
        if b[i] == 0x21:
            i = blocks(i + 2)
        elif b[i] == 0x2C and i + 10 <= len(b):
            i = blocks(i + 11 + (3 << (b[i + 9] & 7) + 1 if b[i + 9] & 128 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> tuple[int, int, int] | None:
    i, size = at + 2, (0, 0)
    while i + 4 <= len(b):
        if b[i] != 0xFF:
            return None
        if b[i + 1] == 0xFF:  # fill byte
            i += 1
            continue
        kind = b[i + 1]
        n = struct.unpack_from(">H", b, i + 2)[0]
        if kind in range(0xC0, 0xD0) and kind not in (0xC4, 0xC8, 0xCC) and i + 9 <= len(b):
            size = struct.unpack_from(">HH", b, i + 5)[::-1]
        i += 2 + n
        if kind == 0xDA:
            while i + 1 < len(b):  # entropy-coded data, to the next marker
                i = b.find(b"\xff", i)
                if i < 0 or i + 1 >= len(b):
                    return None
                if b[i + 1] == 0xD9:
                    return i + 2 - at, *size
                if b[i + 1] == 0xFF:  # fill byte
                    i += 1
                    continue
                if b[i + 1] and b[i + 1] not in range(0xD0, 0xD8):
                    break
                i += 2
    return None


def _au(b: bytes, at: int) -> tuple[int, int, int] | None:
    if at + 24 > len(b):
        return None
    start, size, kind, rate, channels = struct.unpack_from(">IIIII", b, at + 4)
    if size == 0xFFFFFFFF:  # unknown: to the blob's end
        size = max(0, len(b) - at - start)
    if start < 24 or start > 4096 or kind not in range(1, 28) or not 0 < channels <= 16 or not rate or at + start + size > len(b):
        return None
    return start + size, size, channels


#: Magic number -> type and validator (fixed values of the formats).
MAGIC: dict[bytes, tuple[str, Callable]] = {
    b"\x89PNG\r\n\x1a\n": ("image/png", _png),
    b"RIFF": ("audio/wav", _wav),
    b"GIF87a": ("image/gif", _gif),
    b"GIF89a": ("image/gif", _gif),
    b"\xff\xd8\xff": ("image/jpeg", _jpeg),
    b"BM": ("image/bmp", _bmp),
    b".snd": ("audio/basic", _au),
}
WEBP = ("image/webp", _webp)  # shares RIFF with wav


def parts(batches: Iterator[pa.RecordBatch], column: int | str) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of about BATCH_BYTES of a column, one row at least, so that few blobs are held at once."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, int(n * BATCH_BYTES / max(batch.column(column).nbytes, 1)))
        for i in range(0, n, step):
            yield batch.slice(i, step)


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for magic in MAGIC:
        found.add_word(magic.decode("latin-1"), magic)
    found.make_automaton()
    return found


def sniff(blob: bytes, finder) -> list[Span]:
    """The valid media in a blob, outermost and first ones first; what lies inside one of them is part of it."""
    spans, free = [], 0
    for last, magic in sorted(finder.iter(blob.decode("latin-1")), key=lambda x: x[0] + 1 - len(x[1])):
        at = last + 1 - len(magic)
        if at < free:
            continue
        for kind, check in (MAGIC[magic], WEBP) if magic == b"RIFF" else (MAGIC[magic],):
            if found := check(blob, at):
                spans.append(Span(kind, at, *found))
                free = at + found[0]
                break
    return spans


def sniff_media(df: DataFrame, blob_col: str, declared_col: str) -> DataFrame:
    """Add media (SPANS), media_type (of the first span; null where there is none) and type_corrected.

    Null and empty blobs hold no media. Columns of `df` with these names are replaced."""
    keep = [c for c in df.columns if c not in ("media", "media_type", "type_corrected")]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"media {SPANS}, media_type string, type_corrected boolean"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch in parts(batches, blob_col):
            spans = [sniff(b.as_py() or b"", finder) for b in batch.column(blob_col)]
            kinds = [s[0].type if s else None for s in spans]
            wrong = [k is not None and k != d.as_py() for k, d in zip(kinds, batch.column(declared_col))]
            struct_type = pa.list_(pa.struct([("type", pa.string()), *((n, pa.int64()) for n in ("offset", "length", "width", "height"))]))
            made = [pa.array([[s._asdict() for s in x] for x in spans], struct_type), pa.array(kinds, pa.string()), pa.array(wrong, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], names=[*keep, "media", "media_type", "type_corrected"])

    return df.select(*keep).mapInArrow(rows, schema)


# ---- 8-bit media that hold a payload ----------------------------------------------------------------------------

ROW = 192  # payload unit: 64 pixels of 3 samples


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def store(payload: bytes, kind: str) -> bytes:
    """The payload as 8-bit samples of an image 64 pixels wide or of mono sound."""
    height = len(payload) // ROW
    if kind == "image/png":
        lines = np.zeros((height, ROW + 1), np.uint8)
        lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, ROW)
        return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", struct.pack(">IIBBBBB", 64, height, 8, 2, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")
    if kind == "image/bmp":
        return b"BM" + struct.pack("<IIIIiiHHIIiiII", 54 + len(payload), 0, 54, 40, 64, height, 1, 24, 0, len(payload), 2835, 2835, 0, 0) + payload
    if kind == "audio/wav":
        return b"RIFF" + struct.pack("<I4s4sIHHIIHH4sI", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(payload)) + payload
    return b".snd" + struct.pack(">IIIII", 24, len(payload), 2, 8000, 1) + payload


def samples(media: bytes, kind: str) -> bytes:
    """The stored samples, read back from what `store` wrote."""
    if kind == "image/png":
        body, i = b"", 8
        while i < len(media):
            n, chunk = struct.unpack_from(">I4s", media, i)
            body += media[i + 8 : i + 8 + n] if chunk == b"IDAT" else b""
            i += 12 + n
        lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(-1, ROW + 1)
        return lines[:, 1:].tobytes()
    if kind == "image/bmp":
        return media[struct.unpack_from("<I", media, 10)[0] :]
    if kind == "audio/wav":
        return media[44:]
    return media[struct.unpack_from(">I", media, 4)[0] :]


KINDS = ("image/png", "image/bmp", "audio/wav", "audio/basic")
PREFIX = (b"", b"BM not a picture; RIFF....WAVE neither: ", b"\x00\x01carrier\x00")
SUFFIX = (b"", b"", b"\x00end of carrier GIF89a")


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, blob, declared): each whole text padded with blanks to a multiple of ROW and stored as media.

    The text alone decides the format, the bytes around the medium and the declared type, which is wrong for some. A null
    text is an empty one. Repeated rows, rows of one doc_id and rows without one each get a row; no rows give none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            counts, blobs, declared = [], [], []
            for t in batch.column(1):
                text = (t.as_py() or "").encode()
                payload = text + b" " * ((-len(text)) % ROW or (0 if text else ROW))
                pick = zlib.crc32(payload)
                blobs.append(PREFIX[pick // 4 % 3] + store(payload, KINDS[pick % 4]) + SUFFIX[pick // 12 % 3])
                declared.append(KINDS[pick // 36 % 4])
                counts.append(len(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary()), pa.array(declared)], names=["doc_id", "n_bytes", "blob", "declared"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(rows, "doc_id long, n_bytes long, blob binary, declared string")


def carved(sniffed: DataFrame) -> DataFrame:
    """Digest of each row's first medium, carved from its blob and read back (see queries.op5); for media as `store` writes
    them. Rows without media have nulls; each row has its own, also repeated ones and those without doc_id."""
    names = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "blob"):
            made: list[list] = [[] for _ in range(6)]
            for blob, declared, media, wrong in zip(*(batch.column(c) for c in ("blob", "declared", "media", "type_corrected"))):
                spans = media.as_py()
                if not spans:
                    for column in made:
                        column.append(None)
                    continue
                span = spans[0]
                medium = blob.as_py()[span["offset"] : span["offset"] + span["length"]]
                payload = samples(medium, span["type"])  # of kinds that hold no payload: the bytes after their first ones
                values = np.frombuffer(payload, np.uint8)
                facts = [declared.as_py(), span["type"], "corrected" if wrong.as_py() else "confirmed", span["offset"], span["length"], span["width"], span["height"], int(values.sum(dtype=np.int64)), int(values.max()), int((np.bincount(values, minlength=256) > 0).sum())]
                row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(medium), hashlib.sha256(medium).hexdigest(), "|".join(map(str, facts)))
                for column, v in zip(made, row):
                    column.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            out = [pa.array(v, k) for v, k in zip(made, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *out], names=[x.split()[0] for x in names.split(", ")])

    return sniffed.select("doc_id", "n_bytes", "blob", "declared", "media", "type_corrected").mapInArrow(rows, names)
