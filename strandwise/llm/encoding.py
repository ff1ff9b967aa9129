"""Exact, cached encoders around the tokenizer libraries.

Words repeat, so most of a text is looked up. A unit is what stands between two single blanks: byte-level BPE and
sentencepiece BPE never join tokens across such a blank, which is checked when the vocabulary is loaded; texts with
other white space at a unit's edge, or with special strings, take the library's own path as a whole. A batch's units
are coded by Arrow, so that Python sees each distinct one once."""

from __future__ import annotations

import itertools
import json
import re
import struct
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 300_000  # entries in each half of a worker's cache, about 60 MB a half
RUN_BYTES = 4 << 20  # of texts encoded at once
SEGMENT = 1 << 20  # longer texts are encoded in segments that end at a blank


class Cache:
    """A bounded cache in two halves: a full one becomes the older half, from which what is still asked for comes back."""

    def __init__(self, limit: int = LIMIT):
        self.limit, self.young, self.older = limit, {}, {}

    def all(self, keys: list[str], make: Callable[[list[str]], list]) -> list:
        """The values of `keys` (distinct); `make` gives those of the keys that are missing."""
        out = list(map(self.young.get, keys))
        at = [k for k, v in enumerate(out) if v is None]
        if not at:
            return out
        lacking = [keys[k] for k in at]
        found = list(map(self.older.get, lacking))
        new = [k for k, v in zip(lacking, found) if v is None]
        made = iter(make(new)) if new else iter(())
        found = [next(made) if v is None else v for v in found]
        if len(self.young) + len(lacking) > self.limit:
            self.young, self.older = {}, self.young
        self.young.update(zip(lacking[: self.limit], found))
        for k, v in zip(at, found):
            out[k] = v
        return out


#: The split of byte-level BPE for texts of Latin-1 characters, with its classes spelt out (fixed values: letters,
#: numbers and white space of Unicode below U+0100).
_LETTER, _NUMBER, _BLANK = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t\n\x0b\x0c\r \x85\xa0"
LATIN = f"'(?:[sdmt]|ll|ve|re)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"


def byte_characters() -> dict[int, str]:
    """Byte-level BPE's character for each byte: printable Latin-1 stands for itself, the rest follows U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def split_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(first unit of each text and the end, codes, distinct units): what stands between single blanks."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return first, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def filled(column: pa.Array) -> pa.Array:
    """A text column with empty texts for nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.large_string()), "")


class ByteLevelEncoder:
    """Token ids of the `tokenizers` library.

    Units are found, coded and put together a batch at a time; only the distinct ones are looked up, and what no cache
    has is tokenized by the library's own model."""

    def __init__(self, path: str, limit: int = LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        self.cached = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout")
            and not model.get("unk_token") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and spec.get("truncation") is None and spec.get("padding") is None
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._model, self._pre, self._split = self.tokenizer.model, self.tokenizer.pre_tokenizer, re.compile(LATIN).findall
        self._characters = byte_characters()
        self._blank = self._characters[32]
        self._units, self._pieces, self._mapped = Cache(limit), Cache(limit // 2), Cache(limit // 4)

    def _tokenized(self, mapped: list[str]) -> list[bytes]:
        out = []
        for piece in mapped:
            out.append(array("I", [t.id for t in self._model.tokenize(piece)]).tobytes())
        return out

    def _ids_of(self, pieces: list[str], cache: Cache, mapped: Callable[[str], str]) -> list[bytes]:
        known = list(dict.fromkeys(pieces))
        values = cache.all(known, lambda new: self._tokenized([mapped(p) for p in new]))
        return list(map(dict(zip(known, values)).__getitem__, pieces))

    def _latin_ids(self, pieces: list[str]) -> list[bytes]:
        return self._ids_of(pieces, self._pieces, self._map)

    def _map(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", self._blank)
        return piece.encode().decode("latin-1").translate(self._characters)

    def _made(self, units: list[str]) -> list[bytes]:
        """Ids of units that follow a blank; NONE for a unit that cannot stand alone."""
        out: list = [NONE] * len(units)
        alone = [k for k, u in enumerate(units) if u and u == u.strip()]
        plain = alone if _latin(" ".join(units)) else [k for k in alone if _latin(units[k])]
        if len(plain) < len(alone):
            for k in sorted(set(alone).difference(plain)):
                out[k] = self.text_ids(" " + units[k])
        if plain:
            pieces = self._split(" " + " ".join([units[k] for k in plain]))
            found = self._latin_ids(pieces)
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            first = [k for k, p in enumerate(pieces) if p[0] == " "]  # each unit begins with the one piece that holds its blank
            cuts, raw = np.concatenate([[0], ends])[[*first, len(pieces)]].tolist(), b"".join(found)
            for k, a, b in zip(plain, cuts, cuts[1:]):
                out[k] = raw[a:b]
        return out

    def _opening(self, units: list[str]) -> list[bytes]:
        """Ids of units that no blank precedes."""
        pieces = [self._split(u) if _latin(u) else [] for u in units]
        found = iter(self._latin_ids([p for x in pieces for p in x]))
        return [b"".join(itertools.islice(found, len(x))) if x else self.text_ids(u) for u, x in zip(units, pieces)]

    def text_ids(self, text: str) -> bytes:
        """Ids of a text without special strings, by pieces; the library itself cuts where it goes beyond Latin-1."""
        if not text:
            return b""
        if _latin(text):
            return b"".join(self._latin_ids(self._split(text)))
        return b"".join(self._ids_of([p for p, _ in self._pre.pre_tokenize_str(text)], self._mapped, str))

    def whole(self, text: str) -> bytes:
        """Ids by the library's own path."""
        if not text:
            return b""
        if not self.cached or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.text_ids(text)

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of whole texts, each followed by `end` if given; a null is an empty text."""
        texts = filled(texts)
        tail = b"" if end is None else struct.pack("<I", end)
        if not self.cached:
            return _joined([self.whole(t.as_py()) + tail for t in texts])
        odd = np.zeros(len(texts), bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        long = np.flatnonzero((size > SEGMENT) & ~odd)
        parts, owner, starts = texts, np.arange(len(texts)), np.ones(len(texts), bool)
        if len(long):
            cut = [segments(t.as_py()) if k in set(long.tolist()) else [t.as_py()] for k, t in enumerate(texts)]
            owner = np.repeat(owner, [len(c) for c in cut])
            starts = np.concatenate([[True], owner[1:] != owner[:-1]])
            parts = pa.array([s for c in cut for s in c], pa.large_string())
        first, code, units = split_units(parts)
        values = self._units.all(units, self._made)
        at = first[:-1][starts]  # the unit that no blank precedes
        later = np.ones(len(code), bool)
        later[at] = False
        bad = np.fromiter((v is NONE for v in values), bool, len(values))
        of = np.repeat(owner, np.diff(first))
        odd[of[later & bad[code]]] = True
        heads = self._opening([units[c] for c in code[at].tolist()])
        for k in np.flatnonzero(odd).tolist():
            heads[k] = self.whole(texts[k].as_py())
        pool = [*(b"" if v is NONE else v for v in values), *heads, tail]
        length = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        begin = np.cumsum(length) - length
        pick = code.astype(np.int64)
        pick[at] = len(values) + np.arange(len(at))
        n = length[pick]
        n[later & odd[of]] = 0
        if end is not None:
            last = np.cumsum(np.bincount(of, minlength=len(texts)))
            pick, n = np.insert(pick, last, len(pool) - 1), np.insert(n, last, 1)
            of = np.insert(of, last, np.arange(len(texts)))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, weights=n, minlength=len(texts)).astype(np.int64))])
        ends = np.cumsum(n)
        place = np.repeat(begin[pick] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.frombuffer(b"".join(pool), "<u4")[place], offsets


#: In place of ids: the unit cannot stand alone.
NONE = b"\xff"


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), "<u4"), np.concatenate([[0], np.cumsum([len(v) // 4 for v in values])]).astype(np.int64)


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """The text cut at blanks, which go, into parts of about `size` characters."""
    out, at = [], 0
    while (cut := text.find(" ", at + size)) >= 0:
        out.append(text[at:cut])
        at = cut + 1
    return [*out, text[at:]]


class PieceCounter:
    """Token counts of a sentencepiece model: a table of frequent units first, then a worker's cache."""

    MARK = "▁"

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        norm = proto.normalizer_spec
        self.splits = (
            proto.trainer_spec.model_type == 2 and norm.name == "identity" and norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces and norm.escape_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
            and all(p.type != 4 and self.MARK not in p.piece.lstrip(self.MARK) for p in proto.pieces)
            and any(p.piece == self.MARK for p in proto.pieces)
        )
        self.frequent = frequent or {}
        self._cache = Cache()
        self._runs = re.compile(f"{self.MARK}+[^{self.MARK}]*")

    def _made(self, units: list[str]) -> list[int]:
        return [len(x) or 1 for x in self.model.encode(units, num_threads=1)]  # a single mark with nothing after it is a token

    def lengths(self, units: list[str]) -> list[int]:
        """Tokens of distinct units: the table's, else the worker's cache's, else encoded."""
        out = list(map(self.frequent.get, units))
        rest = [k for k, n in enumerate(out) if n is None]
        for k, n in zip(rest, self._cache.all([units[k] for k in rest], self._made)):
            out[k] = n
        return out

    def runs(self, text: str) -> list[str]:
        """Units of a text with marks of its own or with runs of blanks: each stands for a blank and the text to the next run."""
        return [u[1:].replace(self.MARK, " ") for u in self._runs.findall(self.MARK + text.replace(" ", self.MARK))]

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(text, code) of every unit and the distinct units."""
        texts = filled(texts)
        marked = pc.match_substring(texts, self.MARK).to_numpy(zero_copy_only=False)
        first, code, units = split_units(texts)
        of = np.repeat(np.arange(len(texts)), np.diff(first))
        if "" in units:
            marked[of[code == units.index("")]] = True
        keep = ~marked[of]
        of, code = of[keep], code[keep].astype(np.int64)
        if marked.any():
            known, more_of, more = {u: k for k, u in enumerate(units)}, [], []
            for k in np.flatnonzero(marked).tolist():
                text = texts[k].as_py()
                runs = self.runs(text) if text else []
                more_of += [k] * len(runs)
                more += [known.setdefault(u, len(known)) for u in runs]
            of, code, units = np.concatenate([of, np.array(more_of, np.int64)]), np.concatenate([code, np.array(more, np.int64)]), list(known)
        return of, code, units

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of whole texts, without begin or end; a null is an empty text."""
        if not self.splits:
            return np.array([len(x) for x in self.model.encode(filled(texts).to_pylist(), num_threads=1)], np.int64)
        of, code, units = self.units(texts)
        n = np.array(self.lengths(units), np.int64)
        return np.bincount(of, weights=n[code] if len(code) else None, minlength=len(texts)).astype(np.int64)


_LOADED: dict[tuple, object] = {}


def loaded(kind: type, path: str, *more) -> object:
    """One encoder a worker process and vocabulary; its caches live as long as the worker."""
    key = (kind, path, *more)
    if key not in _LOADED:
        _LOADED[key] = kind(path, *more)
    return _LOADED[key]
