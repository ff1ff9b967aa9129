"""Plain twins of media columns, quality statistics and toxicity features; odd ids in every operator on documents."""

import hashlib
import io
import math
import os
import struct
import sys
import wave
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import corpus as B

from strandwise.llm import bestfit, kdshard, media, mixing, ordinal, queries, repetition, rffquality, tokencount
from strandwise.llm.common import BLOCK, Hashed, buffers, trues_before

ROWS = [r for r in B.corpus(4, 50) if r[0] != 2001] + [(3000, "ab " * 4000, "en", "src0"), (3001, "Line one.\nLine one.\n\n Line one.\nx#y|z 12 É!", "fr", None)]


# ---- media ---------------------------------------------------------------------------------------------------------


def plain_medium(payload, kind):
    if kind == "audio/wav":
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(1)
            w.setframerate(8000)
            w.writeframes(payload)
        return out.getvalue(), 0, 0
    height = len(payload) // 192
    if kind == "image/bmp":
        head = b"BM" + (54 + len(payload)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
        info = b"".join(x.to_bytes(n, "little") for x, n in ((40, 4), (64, 4), (height, 4), (1, 2), (24, 2), (0, 4), (len(payload), 4), (2835, 4), (2835, 4), (0, 4), (0, 4)))
        return head + info + payload, 64, height
    if kind == "image/png":
        lines = b"".join(b"\0" + payload[i : i + 192] for i in range(0, len(payload), 192))
        chunk = lambda name, body: len(body).to_bytes(4, "big") + name + body + zlib.crc32(name + body).to_bytes(4, "big")
        head = (64).to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, 2, 0, 0, 0])
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines, 1)) + chunk(b"IEND", b""), 64, height
    return b".snd" + b"".join(x.to_bytes(4, "big") for x in (24, len(payload), 2, 8000, 1)) + payload, 0, 0


def test_media_columns_are_those_of_plain_files(spark):
    rows = ROWS + ROWS[:2] + [(None, ROWS[0][1], None, None), (None, None, None, None)]
    got = media.carved(media.sniff_media(media.text_media(B.frame(spark, rows)), "blob", "declared")).collect()
    want = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        pick = zlib.crc32(payload)
        kind, declared = media.KINDS[pick % 4], media.KINDS[pick // 36 % 4]
        medium, width, height = plain_medium(payload, kind)
        before = (b"", b"BM not a picture; RIFF....WAVE neither: ", b"\x00\x01carrier\x00")[pick // 4 % 3]
        facts = (declared, kind, "confirmed" if kind == declared else "corrected", len(before), len(medium), width, height, sum(payload), max(payload), len(set(payload)))
        found = [r for r in got if r.payload_sha256 == hashlib.sha256(payload).hexdigest()]
        if kind.startswith("audio"):  # width and height of sound are what the sniffer counts: not of the file
            facts = (*facts[:5], *found[0].feature.split("|")[5:7], *facts[7:])
        want.append((doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(medium), hashlib.sha256(medium).hexdigest(), "|".join(map(str, facts))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.feature.split("|")[1] for r in got} == set(media.KINDS)


# ---- quality statistics ----------------------------------------------------------------------------------------------


def plain_statistics(text):
    raw = (text or "").encode()
    words, n = raw.split(), len(raw)
    size, count = max(n, 1), max(len(words), 1)
    chars = [len(w.decode()) for w in words]
    seen, covered = set(), set()
    for i in range(len(words) - 4):
        gram = tuple(words[i : i + 5])
        if gram in seen:
            covered |= set(range(i, i + 5))
        seen.add(gram)
    lines, again, again_chars = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.split():
            if line in lines:
                again, again_chars = again + 1, again_chars + sum(len(w.decode()) for w in line.split())
            lines.add(line)
    share = lambda keep: sum(map(keep, raw)) / size
    each = [k / size for k in Counter(raw).values()]
    lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    repeat = B.repetition(text)[4]
    return [
        math.log1p(len(words)), sum(chars) / count, share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in b"#*$%&|<>"), share(lambda b: b in b".,;:'\"-"),
        share(lambda b: b in b"!?()[]{}/\\=+_~^@`"), share(lambda b: b >= 128), share(lambda b: b == 10), -sum(p * math.log2(p) for p in each), len(set(lower)) / count, repeat / count,
        sum(chars[i] for i in covered) / max(sum(chars), 1), again_chars / max(sum(chars), 1), math.log1p(again), math.log1p(len(words) / (raw.count(b"\n") + 1)), n / count, len(each) / 64,
    ]


def test_quality_statistics_are_those_of_plain_counts(spark):
    got = {r.doc_id: r.x for r in rffquality.document_statistics(B.frame(spark, ROWS), "doc_id", "text").collect()}
    assert len(got) == len(ROWS)
    for doc_id, text, *_ in ROWS:
        want = plain_statistics(text)
        assert len(want) == len(rffquality.STATISTICS)
        wrong = [(n, a, b) for n, a, b in zip(rffquality.STATISTICS, got[doc_id], want, strict=True) if abs(a - b) > 1e-9]
        assert not wrong, (doc_id, wrong)


# ---- toxicity features -----------------------------------------------------------------------------------------------


def plain_features(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in raw).split()
    return Counter([("word", w) for w in words] + [(k, w[:k]) for w in words for k in ordinal.PREFIXES if len(w) > k])


def test_toxicity_features_are_words_and_their_beginnings():
    texts = [t for _, t, *_ in ROWS] + ["Nasty, nastily NASTINESS nastiest é´abcdefghi", None]
    data, offsets = buffers(pa.array(texts, pa.string()))
    doc, feature, times = ordinal._features(data, offsets)
    names, hashes = {}, {}
    for k, text in enumerate(texts):
        want, mine = plain_features(text), np.flatnonzero(doc == k)
        assert sorted(want.values()) == sorted(times[mine].tolist())
        # a feature is the same hash in every text, and each hash one feature
        for name in want:
            one, _ = buffers(pa.array([name[1].decode("utf-8", "ignore")])) if name[0] == "word" else (None, None)
            if one is not None and name not in hashes:
                f = np.concatenate([h for _, h in ordinal._kinds(*buffers(pa.array([name[1].decode()])))])
                hashes[name] = int(f[0])
                assert names.setdefault(int(f[0]), name) == name
                for size, h in zip([s for s in ordinal.PREFIXES if len(name[1]) > s], f[1:].tolist(), strict=True):
                    assert names.setdefault(h, (size, name[1][:size])) == (size, name[1][:size])
        assert {names[h]: n for h, n in zip(feature[mine].tolist(), times[mine].tolist(), strict=True)} == dict(want)


def test_a_bound_on_words_is_told(spark):
    rows = [(k, f"plain{k % 7} " + ("vile nasty awful" if k % 5 == 0 else "kind"), "en", "s") for k in range(300)]
    table = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(300)], "doc_id long, toxic int")
    with pytest.warns(UserWarning, match="more than 2 words"):
        got = ordinal.toxicity(B.frame(spark, rows), table, most_words=2).collect()
    assert sum(r.toxic for r in got) == 60


# ---- packing by ranges -------------------------------------------------------------------------------------------------


def test_packing_query_over_many_ranges(spark, sf_dir, monkeypatch):
    """The query's rows where a task sweeps 300 pieces and gaps: every piece as in one task, and about as few sequences."""
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    monkeypatch.setattr(bestfit.best_fit, "__defaults__", tuple(300 if d == bestfit.ROWS_A_TASK else d for d in bestfit.best_fit.__defaults__))
    got = queries.op6(spark, sf_dir).collect()
    monkeypatch.undo()
    one = queries.op6(spark, sf_dir).collect()
    piece = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(piece, got)) == sorted(map(piece, one))
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        end = 0
        for at, n in sorted(found):
            assert at == end
            end += n
        assert end <= queries.TARGET
    bound = -(-sum(r.length for r in got) // queries.TARGET)
    assert len(places) <= 1.01 * bound + 1 and len({r.sequence_id for r in one}) <= 1.01 * bound + 1


# ---- ids that repeat or are not there ----------------------------------------------------------------------------------

OPERATORS = {
    "shards": lambda docs, labels: kdshard.document_shards(docs, 8).drop("shard", "slot", "grown_shard"),
    "rules": lambda docs, labels: repetition.repetition_rules(docs.select("doc_id", "text"), carry=["doc_id"]),
    "media": lambda docs, labels: media.carved(media.sniff_media(media.text_media(docs), "blob", "declared")),
    "quality": lambda docs, labels: rffquality.quality_scores(docs, labels).drop("held_out"),
    "tokens": lambda docs, labels: tokencount.token_counts(docs, queries.vocabulary("piece_bpe_32k.model"), 40),
    "toxicity": lambda docs, labels: ordinal.toxicity(docs, labels),
    "mixing": lambda docs, labels: mixing.mix(docs, {"lang": F.col("lang"), "source": F.col("source")}, {}, 1.0).drop("lang", "source"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_of_one_id_and_rows_without(spark, name):
    """Each row has a row of its own, with the values that its text has under any id."""
    twice = [ROWS[1], ROWS[1], ROWS[1][:1] + ROWS[2][1:], (None, *ROWS[1][1:]), (None, *ROWS[1][1:]), (None, None, None, None)]
    rows = ROWS[:30] + twice
    labels = spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(0, 40)] + [(3, None, None), (None, 1, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")
    found = [r.asDict() for r in OPERATORS[name](B.frame(spark, rows).repartition(3), labels).collect()]
    assert len(found) == len(rows)
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    of = lambda d: [{k: v for k, v in r.items() if k not in ("doc_id", "epoch", "copies")} for r in found if r["doc_id"] == d]
    same = of(ROWS[1][0])
    texts = {str(x) for x in same}
    assert len(same) == 4 and len(texts) <= 2  # three rows of one text, one of another
    assert {str(x) for x in of(ROWS[2][0])} <= texts
    assert len([x for x in of(None) if str(x) in texts]) >= 2


# ---- very long texts -------------------------------------------------------------------------------------------------


def long_text():
    """More than five blocks: a word and a line longer than a block, words and code points over blocks' edges."""
    rng = np.random.default_rng(3)
    words = [f"w{k}É" if k % 7 == 0 else f"W{k}" for k in rng.integers(0, 5000, 100_000).tolist()]
    line = "é" * (BLOCK - 3) + "x"  # one word of twice a block
    return " ".join(words) + "\n" + line + "\n" + " ".join(words[:60_000]) + "\n" + line + "\n" + "a " * 200_000 + "# end!"


def test_blocks_of_a_long_text_do_not_show():
    text = long_text()
    raw = text.encode()
    assert len(raw) > 5 * BLOCK
    for lower in (False, True):
        run = Hashed(*buffers(pa.array(["short one", text, None, "tail of it"])), lower=lower)
        assert np.diff(run.first).tolist() == [2, len(raw.split()), 0, 3]
        # every word has the hash that it has in a text of its own, the one longer than a block the sum of its bytes
        mine = dict(zip(raw.split(), run.words[run.first[1] : run.first[2]].tolist()))
        kinds = [w for w in mine if len(w) < BLOCK]
        alone = Hashed(*buffers(pa.array([w.decode() for w in kinds[:3000]])), lower=lower)
        assert [mine[w] for w in kinds[:3000]] == alone.words.tolist()
        again = Hashed(*buffers(pa.array([next(w.decode() for w in mine if len(w) > BLOCK), "x"])), lower=lower)
        assert [mine[w] for w in mine if len(w) > BLOCK] == again.words[:1].tolist()
        assert again.words[0] != again.words[1]


def test_marks_are_counted_over_blocks():
    mask = np.random.default_rng(5).random(2 * BLOCK) < 0.5
    at = np.sort(np.concatenate([[0, 0, BLOCK - 1, BLOCK, BLOCK, BLOCK + 1, 2 * BLOCK, 2 * BLOCK], np.random.default_rng(6).integers(0, 2 * BLOCK, 99)]))
    assert trues_before(mask, at).tolist() == [int(mask[:k].sum()) for k in at]
    assert trues_before(np.zeros(0, bool), np.zeros(3, np.int64)).tolist() == [0, 0, 0]


def test_a_long_text_is_measured_as_a_short_one(spark):
    text = long_text()
    rows = [(1, text, "en", "s"), (2, "short", "en", "s")]
    got = {r.doc_id: r.x for r in rffquality.document_statistics(B.frame(spark, rows), "doc_id", "text").collect()}
    wrong = [(n, a, b) for n, a, b in zip(rffquality.STATISTICS, got[1], plain_statistics(text), strict=True) if abs(a - b) > 1e-9]
    assert not wrong
    facts = {r.doc_id: r for r in repetition.repetition_rules(B.frame(spark, rows), carry=["doc_id"]).collect()}[1]
    assert (facts.n_words, facts.word_chars, facts.n_symbols, facts.n_dup_lines, facts.n_repeat_words) == tuple(B.repetition(text)[:5])
    _, feature, times = ordinal._features(*buffers(pa.array([text])))
    assert sorted(times.tolist()) == sorted(plain_features(text).values()) and len(set(feature.tolist())) == len(feature)


MEASURED = """
import resource, sys
import numpy as np, pyarrow as pa
from strandwise.llm import minhash, ordinal, repetition, rffquality
from strandwise.llm.common import Hashed, buffers
names = np.array([f"w{k:x}" for k in np.random.default_rng(1).integers(0, 1 << 24, 200_000)])
data, offsets = buffers(pa.array([" ".join(" ".join(np.random.default_rng(k).permutation(names)) for k in range(12))]))
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024
before = peak()
{
    "rules": lambda: repetition.measure(data, offsets, repetition.COVERAGE, 0.3, 0.1),
    "statistics": lambda: rffquality.statistics(data, offsets),
    "shingles": lambda: minhash.shingles(Hashed(data, offsets, lower=True), 3),
    "features": lambda: ordinal._features(data, offsets),
}[sys.argv[1]]()
print((peak() - before) / len(data))
"""


@pytest.mark.parametrize("work", ["rules", "statistics", "shingles", "features"])
def test_memory_of_a_long_text(work):
    """Of a text of 18 MB in common words; before it was taken in blocks the rules took some 50 bytes a byte."""
    import subprocess

    done = subprocess.run([sys.executable, "-c", MEASURED, work], capture_output=True, text=True, timeout=300, check=True)
    assert float(done.stdout) < 20
