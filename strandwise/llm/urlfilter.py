"""URL filters: all glob rules at once over each URL, by a bit-parallel automaton.

A glob is written over the canonical URL: a dot, the host, the path. `*` is any run of characters but /, `**` any run,
`?` one character but /, [a-z] and [!a-z] one ASCII character of a set or not of it, and \\x the character x itself. Every
glob is a row of bits, one for each place inside it; all rows are packed into as many 64-bit words as they need. A byte of
the URL moves all places of all globs by a shift, an AND with the byte's mask and an OR with the places that wait (stars).
Numpy takes the words of a whole batch of URLs a byte at a time, the longest URLs first, so that no URL is padded.

Work is narrow: no shuffle, whatever hosts are frequent. A URL of n bytes takes n steps and a few words of memory."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buffers, slices, small_batches

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTE = np.arange(256)
_NO_SLASH = _BYTE != ord("/")
_TAIL = (_BYTE & 0xC0) == 0x80  # later bytes of a character


def _elements(glob: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """(bytes that wait at the start, [(bytes that move on, bytes that wait behind)]) of a glob."""
    waits, moves, i = [np.zeros(256, bool)], [], 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            deep = glob.startswith("**", i)
            waits[-1] = waits[-1] | (np.ones(256, bool) if deep else _NO_SLASH)
            i += 1 + deep
            continue
        if c == "?":
            moves.append(_NO_SLASH & ~_TAIL)
            waits.append(_TAIL.copy())  # the rest of the character
        elif c == "[":
            end = glob.index("]", i + 2)
            inside = glob[i + 1 : end]
            negated = inside.startswith("!")
            inside = inside[negated:]
            chosen = np.zeros(256, bool)
            k = 0
            while k < len(inside):
                high = inside[k + 2] if inside[k + 1 : k + 2] == "-" and k + 2 < len(inside) else inside[k]
                chosen[ord(inside[k]) : ord(high) + 1] = True
                k += 3 if high is not inside[k] else 1
            moves.append(~chosen & _NO_SLASH & ~_TAIL if negated else chosen)
            waits.append(_TAIL.copy() if negated else np.zeros(256, bool))
            i = end
        else:
            if c == "\\" and i + 1 < len(glob):
                i += 1
                c = glob[i]
            for byte in c.encode():
                moves.append(_BYTE == byte)
                waits.append(np.zeros(256, bool))
        i += 1
    return waits[0], list(zip(moves, waits[1:], strict=True))


class Globs:
    """Globs packed into multiword masks."""

    def __init__(self, globs: Sequence[str]):
        parsed = [_elements(g) for g in globs]
        bits = sum(1 + len(parts) for _, parts in parsed)
        self.words = max(1, -(-bits // 64))
        move, wait = (np.zeros((256, self.words * 64), bool) for _ in range(2))
        start, self.finals, at = np.zeros(self.words * 64, bool), [], 0
        for first, parts in parsed:
            start[at], wait[:, at] = True, first
            for k, (on, behind) in enumerate(parts, at + 1):
                move[:, k], wait[:, k] = on, behind
            at += 1 + len(parts)
            self.finals.append(at - 1)
        self.move, self.wait, self.start = (self._packed(x) for x in (move, wait, start[None]))

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(bits), self.words).astype(np.uint64)

    def ends(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The words of each string (bytes between offsets) after its last byte."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = offsets[:-1][order], sizes[order]
        state = np.repeat(self.start, len(order), axis=0)
        running = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # strings longer than t
        for t, n in enumerate(running):
            byte, now = data[starts[:n] + t], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)  # from word to word
            state[:n] = (moved & self.move[byte]) | (now & self.wait[byte])
        out = np.empty_like(state)
        out[order] = state
        return out

    def hits(self, ends: np.ndarray, k: int) -> np.ndarray:
        """Which strings glob k matches as a whole."""
        word, bit = divmod(self.finals[k], 64)
        return (ends[:, word] >> np.uint64(bit)) & np.uint64(1) != 0


def escaped(text: str) -> str:
    """A glob for just this text."""
    return "".join("\\" + c if c in "*?[\\" else c for c in text)


def rule_glob(host: str, path: str) -> str:
    """The glob of a rule: the host or any subdomain of it, and paths that start with `path`."""
    return f"*.{escaped(host)}{escaped(path)}**"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first :// and /, ? or #, A-Z lower-cased; then up to ? or #. Both empty where there is no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_verdicts(df: DataFrame, rules: Sequence[tuple[str, str, str]], blocked: Sequence[str] = (), allowed: Sequence[str] = (), url: str = "url", keep: Sequence[str] | None = None, default: str = ALLOW) -> DataFrame:
    """`keep` (all columns unless given) with host, path, rule and verdict of each row's URL.

    rules: (verdict, host, path); of those that fit the longest wins, of equally long ones that with the longer host, then
    the one that allows. Without a rule, URLs that a glob of `allowed` matches are allowed, those of `blocked` blocked, and
    others get `default`. A null URL, or one without ://, has an empty host and path and is judged like any other. Rows
    are independent: equal rows get equal results, columns named like a result are replaced, no rows give no rows."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != ALLOW))
    globs = Globs([*(rule_glob(h, p) for _, h, p in order), *allowed, *blocked])
    names, n_rules, n_allowed = [*(f"{h}{p}" for _, h, p in order), None], len(order), len(allowed)
    host, path = host_and_path(F.col(url))
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("host", "path", "rule", "verdict")]
    rows = df.select(*kept, host.alias("host"), path.alias("path"))
    small_batches(df.sparkSession)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [f".{h}{p}" for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            data, offsets = buffers(pa.array(texts, pa.large_string()))
            rule, verdict = [], []
            for i, j in slices(offsets):
                ends = globs.ends(data, offsets[i : j + 1])
                found = np.full(j - i, n_rules)
                open_ = np.ones(j - i, bool)
                for k in range(n_rules):
                    hit = open_ & globs.hits(ends, k)
                    found[hit] = k
                    open_ &= ~hit
                good, bad = (np.zeros(j - i, bool) for _ in range(2))
                for k in range(n_rules, n_rules + n_allowed):
                    good |= globs.hits(ends, k)
                for k in range(n_rules + n_allowed, len(globs.finals)):
                    bad |= globs.hits(ends, k)
                rule += [names[k] for k in found]
                verdict += [order[k][0] if k < n_rules else ALLOW if g else BLOCK if b else default for k, g, b in zip(found, good, bad, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], [*batch.schema.names, "rule", "verdict"])

    schema = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("").cast("string")}).schema
    return rows.mapInArrow(judged, schema)
