"""Quality rules: repetition coverage.

Hashes of all windows of several n-gram lengths are rolled in numpy over a run of documents at once; a document's
coverage is the share of its word characters inside n-grams (and lines) that repeat earlier ones of the same document.
First occurrences do not count, so one sentence said twice leaves a document of usual length alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Hashed, buffers, lean, slices, small_batches, trues_before

SYMBOLS = b"#*$%&|<>"
#: n-gram length -> largest share of word characters inside n-grams said before (the published thresholds of Gopher's rules).
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_COVERAGE = 0.30
SYMBOLS_PER_WORD = 0.1
MIN_WORDS = 50
REPEAT_PERCENT = 50
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_share double, dup_gram_share double, base_failed boolean, kept boolean"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_DOC = np.uint64(0xA0761D6478BD642F)


def _repeated(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where (document, hash) occurs twice or more."""
    keys = hashes + docs.astype(np.uint64) * _DOC
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def _later(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where (document, hash) occurred before."""
    out = _repeated(hashes, docs)
    at = np.flatnonzero(out)
    if len(at):
        _, once = np.unique(hashes[at] + docs[at].astype(np.uint64) * _DOC, return_index=True)
        out[at[once]] = False
    return out


def _covered(run: Hashed, n: int, repeats=_repeated) -> np.ndarray:
    """True for words inside an n-word window that `repeats` names: found twice or more in the document, or before."""
    at, hashes = run.grams(n)
    hit = at[repeats(hashes, run.doc[at])] if len(at) else at
    change = np.zeros(len(run.words) + 1, np.int32)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + n, -1)
    return np.cumsum(change[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, coverage: dict[int, float], line_coverage: float, symbols: float, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """All measures of a run of documents (bytes and offsets)."""
    run = Hashed(data, offsets)
    body = run.data
    points = (body & 0xC0) != 0x80
    chars = trues_before(points, run.ends) - trues_before(points, run.starts)
    n_words, word_chars = np.diff(run.first), run.per_doc_words(chars)
    total = np.maximum(word_chars, 1)
    # lines: from a document's start or after \n, to the next \n or the document's end
    breaks = np.flatnonzero(body == 10)
    starts = np.sort(np.concatenate([run.offsets[:-1], breaks + 1]))
    real = np.bincount(np.searchsorted(run.offsets, breaks, "right") - 1, minlength=run.docs) + 1
    doc = np.repeat(np.arange(run.docs), real)
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.cumsum(real) - 1
    ends[last] = run.offsets[1:]
    first_word = np.searchsorted(run.starts, starts)
    end_word = np.searchsorted(run.starts, ends)
    keep = end_word > first_word
    doc, starts, ends, first_word, end_word = doc[keep], starts[keep], ends[keep], first_word[keep], end_word[keep]
    later = _later(run.span(starts, ends), doc)
    n_dup_lines = np.bincount(doc[later], minlength=run.docs)
    word_sum = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(chars, out=word_sum[1:])
    line_chars = np.bincount(doc[later], weights=(word_sum[end_word] - word_sum[first_word])[later], minlength=run.docs)
    n_repeat = run.per_doc_words(_covered(run, 3))
    bad = np.zeros(run.docs, bool)
    worst = np.zeros(run.docs)
    for k, most in coverage.items():
        share = run.per_doc_words(chars * _covered(run, k, _later)) / total
        bad |= share > most
        worst = np.maximum(worst, share)
    n_symbols = run.per_doc(_IS_SYMBOL[body])
    line_share = line_chars / total
    base = (n_words < min_words) | (100 * n_repeat > REPEAT_PERCENT * n_words)
    verdict = ~bad & (line_share <= line_coverage) & (n_symbols <= symbols * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat,
        "dup_line_share": line_share, "dup_gram_share": worst, "base_failed": base, "kept": ~base & verdict,
    }


def repetition_rules(
    docs: DataFrame, text_col: str = "text", coverage: dict[int, float] | None = None, line_coverage: float = LINE_COVERAGE,
    symbols_per_word: float = SYMBOLS_PER_WORD, carry: list[str] | None = None, min_words: int = MIN_WORDS,
) -> DataFrame:
    """Add the measures of COLUMNS to `carry` (all columns by default); one narrow pass, no shuffle.

    Null and empty texts have no words: all counts are 0, and with a `min_words` of 1 or more base_failed is true and kept
    is false. Repeated rows each get their own row. Columns of `docs` that bear one of the new names are replaced."""
    import re

    names = re.findall(r"(\w+) (?:long|double|boolean)", COLUMNS)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in names]
    used = docs.select(*dict.fromkeys([*carry, text_col]))
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry), COLUMNS])
    coverage = dict(coverage or COVERAGE)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(text_col))
            parts = [measure(data, offsets[i : j + 1], coverage, line_coverage, symbols_per_word, min_words) for i, j in slices(offsets)]
            if parts:
                made = [pa.array(np.concatenate([p[c] for p in parts])) for c in names]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *made], names=[*carry, *names])

    small_batches(docs.sparkSession)
    return used.mapInArrow(rows, schema)


def rule_filter(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, symbols_per_word: float = SYMBOLS_PER_WORD) -> DataFrame:
    """The rows of `docs`, all columns as they are, that repetition_rules keeps; one narrow pass, no shuffle.

    Null and empty texts go with a `min_words` of 1 or more; each of repeated rows is judged alike."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            data, offsets = buffers(batch.column(text_col))
            parts = [measure(data, offsets[i : j + 1], COVERAGE, LINE_COVERAGE, symbols_per_word, min_words)["kept"] for i, j in slices(offsets)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts)))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(rows, docs.schema)
