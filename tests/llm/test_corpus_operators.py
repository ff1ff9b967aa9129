import bisect
import hashlib
import os
import struct
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import corpus as B

from strandwise.llm import bestfit, common, encoding, kdshard, media, minhash, mixing, ordinal, queries, repetition, rffquality, tokencount, tokenfile

ROWS = B.corpus()
TEXTS = {r[0]: r[1] for r in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    return B.frame(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return B.frame(spark, [])


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def ids(tokenizer):
    return {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for d, t in TEXTS.items()}


@pytest.mark.parametrize(("size", "num", "den", "block"), [(3, 85, 100, 1000), (5, 4, 5, 1000), (3, 85, 100, 2)])
def test_near_duplicates_equal_brute_force(docs, monkeypatch, size, num, den, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size=size, num=num, den=den).collect()}
    assert got == B.duplicate_groups(ROWS, size, num, den)


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join([*base[: k % 60], f"x{k}", *base[k % 60 + 1 :]]), "en", "s") for k in range(90)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(B.frame(spark, rows), size=3, num=85, den=100).collect()}
    assert got == B.duplicate_groups(rows, 3, 85, 100)


def test_near_duplicates_odd_rows(spark, empty):
    assert minhash.near_duplicates(empty).count() == 0
    text = "the same long text of some words here"
    rows = [(7, text, "", ""), (7, text, "", ""), (9, text, "", ""), (None, text, "", "")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(B.frame(spark, rows)).collect()), key=repr)
    assert got == [(7, 7, True), (7, 7, True), (9, 7, False), (None, None, True)]


def test_hot_sets_and_bands_are_broadcast(docs, monkeypatch):
    joined = minhash.left_join_counted
    monkeypatch.setattr(minhash, "left_join_counted", lambda *a: joined(*a, hot_rows=2))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size=3, num=85, den=100).collect()}
    assert got == B.duplicate_groups(ROWS, 3, 85, 100)


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:900], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    doc = np.repeat([0, 1], [len(a), len(b)])
    _, lows = minhash.minima(doc, np.concatenate([a, b]), 960)
    low = minhash.packed(lows)
    assert abs(minhash.estimate(low[0], low[1:])[0] - 900 / (len(a) + len(b) - 900)) < 0.06


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 99), (99, 98), (98, 100)] + [(500, k) for k in range(501, 540)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((98, 99, 100), 98), **dict.fromkeys(range(500, 540), 500)}


def test_repetition_base_equals_brute_force(docs, empty):
    got = repetition.repetition_rules(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == B.repetition(TEXTS[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert repetition.repetition_rules(empty).count() == 0


def test_repetition_least_words(docs, empty):
    base = {d: B.repetition(t) for d, t in TEXTS.items()}
    for least in (0, 1, 5, 50):
        got = {r.doc_id: r for r in repetition.repetition_rules(docs, min_words=least).collect()}
        assert all(r.base_failed == (base[d][0] < least or 2 * base[d][4] > base[d][0]) for d, r in got.items())
        assert sorted(r.doc_id for r in repetition.rule_filter(docs, min_words=least).collect()) == sorted(d for d, r in got.items() if r.kept)
    assert repetition.rule_filter(empty, min_words=1).count() == 0


def test_repetition_verdict(spark):
    clean = " ".join(f"word{k}" for k in range(200))
    phrase = " ".join(f"rep{k}" for k in range(12))
    rows = [(1, clean, "", ""), (2, clean + (" " + phrase) * 4, "", ""), (3, "\n".join([clean] + ["the very same line of text"] * 20), "", ""), (4, clean.replace(" ", "$$ "), "", ""), (5, clean, "", "")]
    got = {r.doc_id: r.kept for r in repetition.repetition_rules(B.frame(spark, rows)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True}


PARTS = list("aZ é²½¼'s'll9.,!\n\t  \x1c\x85\xa0ªµ_-ñÿ\x00\xad日 ́'t're▁") + ["<|endoftext|>", "<s>", " the", "  ", "long" * 30]


def odd_texts(n):
    rng = np.random.default_rng(3)
    return ["".join(rng.choice(PARTS, rng.integers(0, 14))) for _ in range(n)] + [None, ""]


@pytest.mark.parametrize("segment", [7, encoding.SEGMENT])
def test_encoder_equals_the_library(tokenizer, monkeypatch, segment):
    monkeypatch.setattr(encoding, "SEGMENT", segment)
    monkeypatch.setattr(encoding.segments, "__defaults__", (segment,))
    encoder = encoding.ByteLevelEncoder(queries.vocabulary("byte_bpe_50k.json"))
    assert encoder.cached
    texts = odd_texts(4000)
    ids, ends = encoder.ids(pa.array(texts), 0)
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    assert [len(x) for x in encoder.ids(pa.array([], pa.string()))] == [0, 1]


def test_piece_counter_equals_the_library():
    counter = encoding.PieceCounter(queries.vocabulary("piece_bpe_32k.model"), {"the": 1})
    texts = odd_texts(2000)
    assert counter.counts(pa.array(texts)).tolist() == [len(x) for x in counter.model.encode([t or "" for t in texts], num_threads=1)]
    assert len(counter.counts(pa.array([], pa.string()))) == 0


def test_cache_stays_bounded():
    cache = encoding.Cache(10)
    for k in range(100):
        keys = [str(x % 25) for x in range(k, k + 3)]
        assert cache.all(keys, lambda new: [x + "!" for x in new]) == [x + "!" for x in keys]
    many = [str(k) for k in range(50)]
    assert cache.all(many, lambda new: [x + "!" for x in new]) == [x + "!" for x in many]
    assert len(cache.young) <= 10 and len(cache.older) <= 10


def test_token_counts(docs, empty):
    import sentencepiece

    path = queries.vocabulary("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for more in ({}, {"table_units": 3, "sample_docs": 2}):
        got = tokencount.token_counts(docs, path, limit=100, **more).collect()
        assert len(got) == len(ROWS)
        for r in got:
            n = len(model.encode(TEXTS[r.doc_id] or ""))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((TEXTS[r.doc_id] or "").encode()), n, n > 100)
    assert tokencount.token_counts(empty, path).count() == 0


def packed(rows, capacity):
    """Sequences of (sequence_id, offset, length); offsets have no gaps."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_best_fit(docs, empty, ids):
    got = bestfit.best_fit(docs, queries.vocabulary("byte_bpe_50k.json")).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for doc_id, all_ids in ids.items():
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(all_ids[4 * at : 4 * (at + r.length)]))
            assert k == 0 or r.length == 2048
            at += r.length
        assert at == len(all_ids) // 4
    total = sum(len(x) // 4 for x in ids.values())
    assert packed(got, 2048) <= -(-total // 2048) + 1
    assert bestfit.best_fit(empty, queries.vocabulary("byte_bpe_50k.json")).count() == 0


def test_best_fit_of_repeated_rows_and_rows_without_id(spark):
    rows = [(7, "the same", "", "")] * 3 + [(None, "the same", "", ""), (None, None, None, None)]
    got = bestfit.best_fit(B.frame(spark, rows), queries.vocabulary("byte_bpe_50k.json"), capacity=4).collect()
    assert sorted((r.doc_id or -1, r.piece, r.length) for r in got) == [(-1, 0, 1), (-1, 0, 3)] + [(7, 0, 3)] * 3
    assert packed(got, 4) == 4


def decreasing(lengths, capacity):
    """Number of sequences of best-fit decreasing, piece by piece."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        bisect.insort(gaps, gap - length)
    return len(gaps)


@pytest.mark.parametrize(("name", "task"), [("mixed", 10**6), ("mixed", 300), ("tiny", 200), ("one length", 150), ("large", 300)])
def test_supersteps_come_near_best_fit_decreasing(spark, name, task):
    rng = np.random.default_rng(4)
    capacity = 200
    lengths = {"mixed": rng.integers(1, 201, 1500), "tiny": rng.integers(1, 6, 1500), "one length": np.full(700, 67), "large": rng.integers(90, 201, 900)}[name].tolist()
    cut = common.materialize(spark.createDataFrame(list(enumerate(lengths)), "seq long, length long"), "cut")
    got = bestfit.place(cut, capacity, task).collect()
    assert sorted((r.seq, r.length) for r in got) == list(enumerate(lengths))
    most = decreasing(lengths, capacity)
    assert packed(got, capacity) <= (most if task > len(lengths) else most * 1.01 + 1)


def test_meetings_of_ranges():
    ranges = {0: {bestfit.FREE: (3, 90, 100)}, 1: {bestfit.LEFT: (2, 40, 45), bestfit.FREE: (1, 41, 41)}, 2: {bestfit.LEFT: (7, 10, 20)}}
    # two pieces of 45 go into one gap of 90 at least; then gaps of 41 take two of 20 each, those of 90 four
    assert bestfit.meetings(ranges) == [(1, 0, 2, 0, 0, 2), (2, 0, 2, 1, 0, 2), (2, 2, 7, 0, 1, 4)]


def test_token_files(spark, docs, empty, ids, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_DOCS", 7)
    path = common.scratch_path(spark, "tokens")
    digest = tokenfile.write_token_files(docs, path, queries.vocabulary("byte_bpe_50k.json"))
    at = 0
    got = sorted(tokenfile.read_token_files(spark, path, with_ids=True).collect())
    assert [r.doc_id for r in got] == sorted(ids)
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids[r.doc_id]) // 4, zlib.crc32(ids[r.doc_id]))
        assert np.array(r.ids, "<u4").tobytes() == ids[r.doc_id]
        at += r.n_tokens
    assert tokenfile.lookup(spark, path, 1005).first().ids == np.frombuffer(ids[1005], "<u4").tolist()
    assert tokenfile.lookup(spark, path, 77777).count() == 0
    stored = spark.read.parquet(f"{path}/dictionary").first()
    assert stored.sha256 == digest == hashlib.sha256(bytes(stored.content)).hexdigest()
    repeated = common.scratch_path(spark, "tokens")
    rows = [(5, "b b b", "", ""), (5, "a", "", ""), (5, "a", "", ""), (None, "z", "", ""), (4, None, "", "")]
    tokenfile.write_token_files(B.frame(spark, rows), repeated, queries.vocabulary("byte_bpe_50k.json"))
    got = sorted((tuple(r) for r in tokenfile.read_token_files(spark, repeated).drop("ids_crc32").collect()), key=lambda r: r[1])
    assert got == [(None, 0, 2), (4, 2, 1), (5, 3, 2), (5, 5, 2), (5, 7, 4)]
    other = common.scratch_path(spark, "tokens")
    tokenfile.write_token_files(empty, other, queries.vocabulary("byte_bpe_50k.json"))
    assert tokenfile.read_token_files(spark, other).count() == 0


def test_kd_shards(spark, docs, empty):
    for rows, frame in ((ROWS, docs), ([(k % 7, "tie", "en", "src0") for k in range(4000)], None)):
        got = kdshard.document_shards(frame if frame is not None else B.frame(spark, rows), 8).collect()
        assert len(got) == len(rows)
        sizes, slots = defaultdict(int), defaultdict(list)
        for r in got:
            sizes[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
            assert r.law == "bytes" and r.grown_shard is None
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(sizes) <= set(range(8))
        if frame is not None:
            for r in got:
                raw = (TEXTS[r.doc_id] or "").encode()
                assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    distinct = B.frame(spark, [(k, "w" * (k % 50), "en", f"src{k % 3 if k % 3 else 0}") for k in range(4000)])
    sizes = [r.s for r in kdshard.document_shards(distinct, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 8 + 200
    assert kdshard.document_shards(empty, 8).count() == 0
    by_target = kdshard.kd_shards(distinct.selectExpr("doc_id", "cast(doc_id as double) d", "10L w", "xxhash64(doc_id) tie"), ["d"], "w", target=6000)
    assert by_target.groupBy("node").agg(F.sum("w").alias("w")).where("w > 6000").isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_kd_cuts_are_weighted_medians_along_the_widest_dimension(spark, seed):
    """Every node's cut is looked at by itself: its dimension, the order of both sides and their bytes."""
    rng = np.random.default_rng(seed)
    data = [(k, float(rng.integers(0, 50)), float(rng.normal() * 9), int(rng.integers(1, 40))) for k in range(600)]
    table = spark.createDataFrame(data, "doc_id long, a double, b double, w long").withColumn("tie", F.xxhash64("doc_id"))
    got = kdshard.kd_shards(table, ["a", "b"], "w", levels=3).collect()
    whole = [max(r[c] for r in got) - min(r[c] for r in got) for c in ("a", "b")]
    for level in range(3):
        nodes = defaultdict(lambda: ([], []))
        for r in got:
            nodes[r.node >> (3 - level)][r.node >> (2 - level) & 1].append(r)
        for left, right in nodes.values():
            both = left + right
            width = [(max(r[c] for r in both) - min(r[c] for r in both)) / e for c, e in zip(("a", "b"), whole)]
            c = "a" if width[0] >= width[1] else "b"
            assert max(r[c] for r in left) <= min(r[c] for r in right)
            bytes_ = [sum(r.w for r in side) for side in (left, right)]
            assert abs(bytes_[0] - bytes_[1]) <= 2 * max(r.w for r in both)


def test_kd_shards_part_sources_with_a_common_beginning(spark):
    rows = B.frame(spark, [(7, "same text", "en", f"https://site{k % 2}") for k in range(400)])
    numbers = {r.source: r.d for r in kdshard.text_number(rows.selectExpr("source", "source s"), "s", "d").distinct().collect()}
    assert numbers == {"https://site0": 1.0, "https://site1": 2.0}


def test_kd_target_holds_for_every_leaf(spark):
    rows = spark.range(400).selectExpr("id doc_id", "cast(id as double) d", "if(id < 20, 90L, 1L) w", "xxhash64(id) tie")
    got = kdshard.kd_shards(rows, ["d"], "w", target=100).groupBy("node").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in got) == 400 and max(r.w for r in got) <= 100
    one = kdshard.kd_shards(rows.where("doc_id in (1, 2)"), ["d"], "w", target=50)
    assert [r.w for r in one.groupBy("node").agg(F.sum("w").alias("w")).collect()] == [90, 90]


def water(budget, nodes):
    """Shares of the budget by weight, none above its capacity, by raising the level step by step."""
    open_, out = dict(nodes), {}
    while open_:
        level = budget / sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c <= level * w}
        if not full:
            return out | {k: level * w for k, (w, _) in open_.items()}
        for k, c in full.items():
            out[k] = c
            budget -= c
            del open_[k]
    return out


def test_mixing_budgets_and_prefixes(spark, docs, empty):
    levels = {"domain": F.when(F.col("source").isin("src0", "src1"), "a").otherwise("b"), "lang": F.col("lang"), "source": F.col("source")}
    weights = {"domain": {"a": 1.0, "b": 3.0}, "lang": {"en": 2.0}, "source": {"src0": 5.0}}
    share, epochs = 0.7, 2
    got = mixing.mix(docs, levels, weights, share, epochs, seed=3).collect()
    leaf_docs = defaultdict(list)
    for d, t, lang, source in ROWS:
        leaf_docs["a" if source in ("src0", "src1") else "b", lang or "none", source or "none"].append((d, len((t or "").encode().split()) + 1))
    tokens = {k: sum(n for _, n in v) for k, v in leaf_docs.items()}
    budgets = {(): min(share * sum(tokens.values()), epochs * sum(tokens.values()))}
    for depth, level in enumerate(("domain", "lang", "source")):
        capacity = defaultdict(int)
        for k, n in tokens.items():
            capacity[k[: depth + 1]] += epochs * n
        done = {}
        for parent, b in budgets.items():
            children = {k: (weights[level].get(k[-1], 1.0), c) for k, c in capacity.items() if k[:-1] == parent}
            done |= water(b, children)
        budgets = done
    want = {}
    for leaf, members in leaf_docs.items():
        whole, = [min(int(budgets[leaf] / tokens[leaf]), epochs)]
        rest, run = int(budgets[leaf]) - whole * tokens[leaf], 0
        for _, d, n in sorted((hashlib.md5(f"3:{whole}:{d}".encode()).hexdigest(), d, n) for d, n in members):
            run += n
            copies = whole + (2 * run - n <= 2 * rest)
            if copies:
                want[d] = copies
    assert {r.doc_id: r.copies for r in got} == want
    assert mixing.mix(empty, levels, weights, share).count() == 0


def test_media_round_trip(docs, empty):
    got = media.carved(media.sniff_media(media.text_media(docs), "blob", "declared")).collect()
    assert len(got) == len(ROWS)
    for r in got:
        raw = (TEXTS[r.doc_id] or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert media.carved(media.sniff_media(media.text_media(empty), "blob", "declared")).count() == 0


def test_carving_of_rows_without_media(spark):
    blob = media.store(bytes(192), "audio/wav")
    rows = spark.createDataFrame([(1, 3, bytearray(blob), None), (2, 0, None, "image/png"), (3, 0, bytearray(), None), (None, 1, bytearray(b"RIFF"), None)], "doc_id long, n_bytes long, blob binary, declared string")
    got = {r.doc_id: (r.payload_bytes, r.media_bytes, r.feature) for r in media.carved(media.sniff_media(rows, "blob", "declared")).collect()}
    assert got[1][:2] == (192, len(blob)) and got[2] == got[3] == got[None] == (None, None, None)


def test_sniffing(spark):
    payload = bytes(range(192)) * 2
    finder = media.automaton()
    for kind in media.KINDS:
        blob = media.store(payload, kind)
        found = media.sniff(b"BM RIFF junk " + blob + b"\x89PNG\r\n\x1a\n cut short", finder)
        assert [(s.type, s.offset, s.length) for s in found] == [(kind, 13, len(blob))]
        assert media.samples(blob, kind) == payload
        assert media.sniff(blob[:-1], finder) == []  # a cut file is refused
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00" + bytes(6) + b",\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    jpeg = b"\xff\xd8\xff\xc0\x00\x0b\x08\x00\x02\x00\x03\x01\x01\x11\x00\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00ab\xff\x00c\xff\xd9"
    found = media.sniff(gif + b"--" + jpeg, finder)
    assert [(s.type, s.width, s.height, s.length) for s in found] == [("image/gif", 1, 1, len(gif)), ("image/jpeg", 3, 2, len(jpeg))]
    rows = spark.createDataFrame([(1, bytearray(gif), "image/png"), (2, None, "image/png"), (3, bytearray(), None), (4, bytearray(gif), "image/gif")], "id int, b binary, d string")
    got = {r.id: (r.media_type, r.type_corrected, len(r.media)) for r in media.sniff_media(rows, "b", "d").collect()}
    assert got == {1: ("image/gif", True, 1), 2: (None, False, 0), 3: (None, False, 0), 4: ("image/gif", False, 1)}


def test_sniffing_of_variants(spark):
    finder = media.automaton()
    bmp = lambda header, depth, packing, body, size=0, gap=b"": b"BM" + struct.pack("<IIIIiiHHIIiiII", 14 + header + len(gap) + len(body), 0, 14 + header + len(gap), header, 3, 2, 1, depth, packing, size, 0, 0, 0, 0) + bytes(header - 40) + gap + body
    wav = media.store(b"abc", "audio/wav")  # odd length, no pad byte
    au = b".snd" + struct.pack(">IIIII", 24, 0xFFFFFFFF, 2, 8000, 1) + b"to the end"
    jpeg = b"\xff\xd8\xff\xff\xff\xc0\x00\x0b\x08\x00\x02\x00\x03\x01\x01\x11\x00\xff\xff\xda\x00\x08\x01\x01\x00\x00\x3f\x00ab\xff\x00c\xff\xff\xd9"
    bitmaps = [bmp(40, 16, 0, bytes(16)), bmp(124, 32, 3, bytes(24)), bmp(108, 16, 3, bytes(16)), bmp(40, 16, 3, bytes(16), gap=bytes(12)), bmp(40, 8, 1, b"\x03\x01\x00\x00\x03\x02\x00\x01", 8), bmp(40, 4, 2, b"\x03\x11\x00\x01", 4)]
    for kind, blobs in (("image/bmp", bitmaps), ("audio/wav", [wav, wav + b"after"]), ("audio/basic", [au]), ("image/jpeg", [jpeg])):
        for blob in blobs:
            whole = len(blob) - (5 if blob.endswith(b"after") else 0)
            assert [(s.type, s.offset, s.length) for s in media.sniff(b"junk" + blob, finder)] == [(kind, 4, whole)]
    assert [(s.width, s.height) for s in media.sniff(jpeg, finder)] == [(3, 2)]
    refused = [bmp(40, 24, 3, bytes(24), gap=bytes(12)), bmp(40, 16, 3, bytes(16)), bmp(40, 8, 1, b"\x00\x01", 0), bmp(40, 8, 1, b"\x00\x01", 8)]
    assert [media.sniff(b, finder) for b in refused] == [[]] * 4
    assert media.sniff(jpeg[:-1], finder) == [] and media.sniff(au[:20], finder) == []


def test_pooling_is_isotonic():
    at, value = rffquality.pool(np.arange(6.0), np.ones(6), np.array([0.0, 1, 0, 0, 1, 1]))
    assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all() and value[0] == 0 and value[-1] == 1


def test_quality_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = rffquality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in got]) > 0.93
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([x > y for x in good for y in bad]) > 0.95


def test_ridge_equals_the_direct_solution(spark):
    """Normal equations summed by partition against least squares over all rows at once, and pooling against its definition."""
    rng = np.random.default_rng(9)
    d = len(rffquality.STATISTICS)
    x = rng.normal(size=(600, d))
    y, fold = (x[:, 0] + 0.3 * rng.normal(size=600) > 0).astype(int), rng.integers(1, 5, 600)
    rows = spark.createDataFrame([(a.tolist(), int(b), int(c)) for a, b, c in zip(x, y, fold)], "x array<double>, y int, fold int").repartition(5)
    model = rffquality.fit(common.materialize(rows, "rows"), features=32)
    z, used = model.features(x[fold < 4]), y[fold < 4]
    root = np.sqrt(rffquality.RIDGE * len(used) / 32) * np.eye(33)
    root[-1, -1] = np.sqrt(1e-9)
    direct = np.linalg.lstsq(np.vstack([z, root]), np.concatenate([used, np.zeros(33)]), rcond=None)[0]
    assert np.allclose(model.beta, direct, atol=1e-6)
    bins = np.minimum((np.clip(model.raw(x[fold == 4]), -1, 2) + 1) / 3 * rffquality.BINS, rffquality.BINS - 1).astype(int)
    kinds = np.unique(bins)
    mean, n = np.array([y[fold == 4][bins == b].mean() for b in kinds]), np.array([(bins == b).sum() for b in kinds])
    avg = lambda i, j: (mean[i : j + 1] * n[i : j + 1]).sum() / n[i : j + 1].sum()
    isotonic = [max(min(avg(i, j) for j in range(k, len(kinds))) for i in range(k + 1)) for k in range(len(kinds))]  # max-min formula
    assert np.allclose(sorted(set(np.round(isotonic, 9))), np.round(model.value, 9))


def test_quality_never_reads_held_out_labels(spark, docs):
    labels = spark.createDataFrame([(d, d % 2) for d in TEXTS], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(rffquality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda y: sorted((r.doc_id, round(r.score, 9)) for r in rffquality.quality_scores(docs, y).collect())
    assert score(labels) == score(flipped)
    none = rffquality.quality_scores(docs, labels.limit(0)).collect()
    assert len(none) == len(ROWS) and all(0 <= r.score <= 1 for r in none)


def test_ordinal_recovers_severity():
    rng = np.random.default_rng(5)
    n = 3000
    counts = np.where(rng.random(n) < 0.3, rng.integers(1, 6, n), 0)
    grades = np.digitize(counts, [1, 4])
    row = np.repeat(np.arange(n), counts)
    column = rng.integers(0, 3, len(row))
    model = ordinal.fit_ordinal(grades, row, column, np.ones(len(row)), np.arange(3, dtype=np.uint64), 3)
    s = np.bincount(row, weights=model.weights[column], minlength=n)
    expected = model.above(s).sum(1)
    assert (np.diff(model.thresholds) > 0).all() and np.corrcoef(expected, grades)[0, 1] > 0.95


def test_gradient_leads_to_the_least_loss():
    """The fitted weights and thresholds cannot be bettered by a small step in any direction."""
    rng = np.random.default_rng(8)
    n, d = 400, 4
    x = rng.integers(0, 3, (n, d)).astype(float)
    grades = np.digitize(x @ np.array([1.0, -0.5, 0.3, 0.0]) + rng.logistic(size=n), [0.8, 2.0])
    row, column = np.nonzero(x)
    model = ordinal.fit_ordinal(grades, row, column, x[row, column], np.arange(d, dtype=np.uint64), 3, steps=3000, penalty=0.0)

    def loss(w, theta):
        upto = np.column_stack([np.zeros(n), 1 / (1 + np.exp(-(theta[None, :] - (x @ w)[:, None]))), np.ones(n)])
        return -np.log(upto[np.arange(n), grades + 1] - upto[np.arange(n), grades]).mean()

    best = loss(model.weights, model.thresholds)
    for k in range(d + 2):
        for step in (-0.02, 0.02):
            move = np.zeros(d + 2)
            move[k] = step
            assert loss(model.weights + move[:d], model.thresholds + move[d:]) >= best - 1e-7


def test_toxicity_on_held_out_labels(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = ordinal.toxicity(docs, labels.where(~held)).join(labels.where(held & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    assert np.mean([r.toxic for r in got if r.label == 1]) >= 0.9
    assert np.mean([r.toxic for r in got if r.label == 0]) <= 0.02


def test_toxicity(spark, empty):
    filler = [f"plain{k}" for k in range(40)]
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(400):
        words = list(rng.choice(filler, 30))
        if k % 5 == 0:
            words += ["nasty", "Vile!"] if k % 10 else ["vile"]
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, int(k % 5 == 0)))
    rows += [(900, None, "", ""), (901, "", "", ""), (902, "quite nasty indeed", "", "")]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in ordinal.toxicity(B.frame(spark, rows), table).collect()}
    assert len(got) == len(rows)
    assert all(got[k].toxic == (k % 5 == 0) for k in range(400)) and got[902].toxic and not got[900].toxic and not got[901].toxic
    assert min(got[15].severity, got[20].severity) > got[1].severity
    assert {got[k].severity for k in range(0, 400, 5)} != {got[15].severity}
    twice = ordinal.toxicity(B.frame(spark, [rows[0], rows[0], (None, rows[5][1], "", "")]).unionByName(B.frame(spark, rows[1:400])), table).collect()
    assert sum(r.doc_id == 0 for r in twice) == 2 and [r.toxic for r in twice if r.doc_id is None] == [True]
    assert ordinal.toxicity(empty, table).count() == 0
    assert ordinal.toxicity(B.frame(spark, rows), table.limit(0)).where("toxic").count() == 0
