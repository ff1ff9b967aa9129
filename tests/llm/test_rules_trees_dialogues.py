"""URL filters, Merkle manifests and conversation repair against brute force."""

import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwise.llm import dialogue, merkle, queries, urlfilter

# ---- URL filters ---------------------------------------------------------------------------------------------------

URLS = [
    "https://a.org/", "http://a.org", "https://EXAMPLE.org/es/1?x#y", "http://www.example.org/en/12", "http://www.example.org/en/2", "ftp://x.com/fr/1", "ftp://x.com/de/1?u=/fr/", "http://com/de/",
    "http://notexample.org/es/", "nothing", "", None, "://", "a://b://c/d", "http://ads-x.net/1", "http://x.net/ads-1", "http://ÉÀ.net/é?", "http://x.net/a.exe", "http://x.net/wp-admin/", "http://x.net#/wp-admin/",
    "http://free-bets.net", "http://free-bet.net", "http://[::1]:80/de/", "http://x.com/" + "long/" * 20_000 + "a.zip", "http://user@h.com:8080/de/x", "http://example.org/en/1?q", "http://x.com/d\ne/",
]


def glob_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        elif glob[i] == "[":
            end = glob.index("]", i + 2)
            body = glob[i + 1 : end]
            out, i = out + ("[^/" + body[1:] if body[0] == "!" else "[" + body) + "]", end + 1
        else:
            i += glob[i] == "\\"
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out, re.S)


def plain_verdict(url, rules, blocked, allowed=()):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, *max(fit, key=lambda x: len(x[0]))
    match = lambda globs: any(glob_regex(g).fullmatch("." + host + path) for g in globs)
    return host, path, None, "allow" if match(allowed) or not match(blocked) else "block"


def test_url_verdicts_are_those_of_plain_matching(spark):
    rows = [(k // 2, u, "x", "y") for k, u in enumerate(URLS + URLS)] + [(None, "http://a.com/de/", "x", "y")]
    df = spark.createDataFrame(rows, "page_id int, url string, host string, verdict string")
    got = urlfilter.url_verdicts(df, queries.URL_RULES, queries.BLOCKED_URLS, ["**/wp-admin/ok**"], keep=["page_id", "url"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(r.url, queries.URL_RULES, queries.BLOCKED_URLS, ["**/wp-admin/ok**"]), r.url[:80] if r.url else r.url
    whole = urlfilter.url_verdicts(df.where("page_id = 0"), queries.URL_RULES)
    assert sorted(whole.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    assert urlfilter.url_verdicts(df.where("false"), queries.URL_RULES, queries.BLOCKED_URLS).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_globs_in_many_words_are_those_of_regexes(seed):
    rng = random.Random(seed)
    pieces = ["*", "**", "?", "a", "b", "/", ".", "é", "[ab]", "[!a]", "[a-c]", "\\*", "abcab" * 5]
    globs = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 9))).replace("***", "**") for _ in range(60)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    texts = ["".join(rng.choice(["a", "b", "c", "/", ".", "é", "*", "日", "abcab"]) for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    packed = urlfilter.Globs(globs)
    assert packed.words > 3
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    ends = packed.ends(np.frombuffer(b"".join(data), np.uint8), offsets)
    for k, g in enumerate(globs):
        rule = glob_regex(g)
        assert packed.hits(ends, k).tolist() == [bool(rule.fullmatch(t)) for t in texts], g


def test_equally_long_rules_and_other_defaults(spark):
    df = spark.createDataFrame([("http://b.a.org/x",), ("http://z.net/",)], "url string")
    rules = [("block", "a.org", "/x"), ("allow", "b.a.org", "/"), ("block", "b.a.org", "/")]
    got = {r.url: (r.rule, r.verdict) for r in urlfilter.url_verdicts(df, rules, allowed=["*.z.*/"], default="block").collect()}
    assert got == {"http://b.a.org/x": ("b.a.org/", "allow"), "http://z.net/": (None, "allow")}


# ---- Merkle manifest -----------------------------------------------------------------------------------------------

FIELDS = queries.LEAF_FIELDS


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(hashes, fan):
    """(root, [siblings of each leaf, concatenated])."""
    level, at, proofs = list(hashes), list(range(len(hashes))), [""] * len(hashes)
    while len(level) > 1:
        for i, k in enumerate(at):
            run = range(k // fan * fan, min(len(level), k // fan * fan + fan))
            proofs[i] += "".join(level[j] for j in run if j != k)
        level = [sha("".join(level[j : j + fan])) for j in range(0, len(level), fan)]
        at = [k // fan for k in at]
    return level[0], proofs


def plain_manifest(rows, fan=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    inner = {}
    for g in order:
        leaves = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        inner[g] = leaves, *plain_tree([plain_leaf(r) for r in leaves], fan)
    root, upper = plain_tree([inner[g][1] for g in order], fan)
    return root, [(r[0], plain_leaf(r), inner[g][1], root, sha(inner[g][2][i] + upper[k])) for k, g in enumerate(order) for i, r in enumerate(inner[g][0])]


def some_rows(n, sources, seed=1):
    rng = random.Random(seed)
    rows = [(k, rng.choice(sources), rng.choice(["en", None]), rng.choice([5, None]), rng.choice(["Text É", "", None, "lower"])) for k in range(n)]
    return rows + rows[:3] + [(None, sources[0], None, None, None), (None, sources[0], None, None, "X" * 100_000)]


@pytest.mark.parametrize(("n", "sources", "fan"), [(300, ["a"], 16), (300, ["b", None, "", "é", "-"], 16), (40, [f"s{k}" for k in range(30)], 3), (1, ["a", "b"], 2)])
def test_manifest_is_the_plain_tree(spark, n, sources, fan):
    rows = some_rows(n, sources)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("leaf", F.lit("own")).repartition(5)
    got = merkle.manifest(df, FIELDS, "source", ["doc_id"], keep=["doc_id"], fan=fan)
    got = got.withColumn("proof", merkle.digest(merkle.siblings(F.col("path")))).withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    root, want = plain_manifest(rows, fan)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.again == root for r in got)


def test_changed_rows_do_not_fold_to_the_root(spark, tmp_path):
    rows = [r for r in some_rows(100, ["a", "b", None]) if r[0] is not None][:100]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    merkle.manifest(df, FIELDS, "source", ["doc_id"], keep=["doc_id"]).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    changed = df.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text"))).where("doc_id <> 11")
    bad = {r.doc_id for r in merkle.verified(stored, changed, FIELDS, "doc_id").where("not ok").collect()}
    assert bad == {k for k in range(100) if k % 7 == 0} | {11}
    assert merkle.manifest(df.where("false"), FIELDS, "source", ["doc_id"]).count() == 0


def test_merkle_query_tampers_rows(spark, tmp_path):
    rows = [r for r in some_rows(200, ["a", "b", None])]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12(spark, str(tmp_path)).collect()
    _, want = plain_manifest(rows)
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        text = {plain_leaf(x): x[4] for x in rows}[r.leaf]
        assert r.verified == (r.folded_root == r.root) == (not hit or text is None or text == text.lower().replace("É".lower(), "É"))
    empty = tmp_path / "empty"
    df.where("false").write.parquet(str(empty / "documents.parquet"))
    assert queries.op12(spark, str(empty)).count() == 0


# ---- conversation repair -------------------------------------------------------------------------------------------

GRAMMAR = re.compile(r"(s?(ua)+)?")
_BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_faults(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.rstrip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(turns):
    """(cost, audit, repaired) by a memoised search over all edits."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
    faults, step = plain_faults(turns), {"": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(t, state, added):
        ways = []
        if t == len(turns) and state in ("", "a"):
            ways.append((0, ""))
        if added < 4:
            cost, rest = best(t, step[state], added + 1)
            ways.append((cost + 2, "I" + rest))
        if t < len(turns):
            first, fault = turns[t][0][:1], faults[t]
            cost, rest = best(t + 1, state, 0)
            ways.append((cost + 3, "D" + rest))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if first == step[state] or (state == "" and first == "s"):
                    cost, rest = best(t + 1, first, 0)
                    ways.append((cost + late, "K" + rest))
                cost, rest = best(t + 1, step[state], 0)
                ways.append((cost + late + 2, "R" + rest))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    return cost, audit, plain_apply(turns, audit)


def plain_apply(turns, audit):
    lines, state, t, step = [], "", 0, {"": "u", "s": "u", "u": "a", "a": "u"}
    for edit in audit:
        if edit == "K":
            lines.append(turns[t])
            state = turns[t][0][0]
        elif edit in "RI":
            state = step[state]
            lines.append(({"u": "user", "a": "assistant"}[state], turns[t][1] if edit == "R" else ""))
        t += edit != "I"
    assert t == len(turns) and GRAMMAR.fullmatch("".join(r[0] for r, _ in lines))
    return lines


def plain_row(rows):
    """What a conversation's row of digests must be; rows: (turn, role, text), in order."""
    turns = [(r, x) for _, r, x in rows]
    faults = plain_faults(turns)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    cost, audit, lines = plain_repair(turns)
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in lines))


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        value = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{value(conv)}:{value(turn)}".encode()) % 20
        role, text = value(role), value(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0)) for c, x in out.items()}


def some_talks(seed, n=120, most=9):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        turn = rng.choice([0, 5])
        for _ in range(rng.choice([1, 2, most, most])):
            rows.append((conv if conv else None, turn if rng.random() < 0.97 or turn > 5 else None, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(["a.", "b!", "c", " \n", None, f"é{turn}? \t", "d." * 3])))
            turn += rng.choice([1, 1, 1, 3])
    return [r for k, r in enumerate(rows) if (r[0], r[1]) not in {(x[0], x[1]) for x in rows[:k]}]


@pytest.mark.parametrize(("seed", "segment"), [(1, 512), (2, 512), (3, 2), (4, 3)])
def test_repairs_are_the_cheapest(spark, seed, segment):
    rows = some_talks(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("edit", F.lit("own")).repartition(5)
    hurt = dialogue.damaged(df)
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.conversation_digests(hurt, df, segment).collect()}
    want = {c: plain_row(x) for c, x in plain_damage(rows).items()}
    assert got == want
    turns = dialogue.repaired_turns(hurt, segment).collect()
    for c, x in plain_damage(rows).items():
        mine = [r for r in turns if r.conv_id == c]
        mine = sorted(enumerate(mine), key=lambda p: (p[1].no, p[0]))
        assert "".join(r.edit for _, r in mine) == want[c][6]
        assert [(r.role, r.text) for _, r in mine if r.edit != "D"] == plain_repair([(a, b) for _, a, b in x])[2]


def test_small_conversations_by_trying_all_edits():
    for turns in itertools.product([("user", "a."), ("assistant", "b"), ("system", "c."), ("x", "d"), ("user", " ")], repeat=2):
        faults, found = plain_faults(turns), []
        for n in range(0, 7):
            for audit in itertools.product("KRDI", repeat=n):
                if sum(e != "I" for e in audit) != 2:
                    continue
                t, cost, ok = 0, 0, True
                for e in audit:
                    if e == "I":
                        cost += 2
                        continue
                    ok &= e == "D" or faults[t] not in ("blank", "duplicate")
                    cost += {"K": 0, "R": 2, "D": 3}[e] + (e != "D" and faults[t] == "truncated")
                    t += 1
                if ok:
                    try:
                        plain_apply(turns, audit)
                    except (AssertionError, KeyError):
                        continue
                    found.append((cost, "".join(audit)))
        assert min(found) == plain_repair(turns)[:2], turns


def test_one_conversation_of_many_segments(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant", "assistant", "system"]), f"t{k}" + rng.choice([".", ""])) for k in range(700)] + [(2, 0, "user", "x."), (3, None, "assistant", "x" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.conversation_digests(df, segment=16).collect()}
    whole = {r.conv_id: tuple(r)[1:] for r in dialogue.conversation_digests(df).collect()}
    groups = {c: [r[1:] for r in rows if r[0] == c] for c in (1, 2, 3)}
    assert got == whole and {c: got[c] for c in (2, 3)} == {c: plain_row(groups[c]) for c in (2, 3)}
    head = plain_row(groups[1][:200])
    assert {r.conv_id: tuple(r)[1:] for r in dialogue.conversation_digests(df.where("conv_id = 1 and turn < 200"), segment=16).collect()} == {1: head}
    assert dialogue.conversation_digests(df.where("false")).count() == 0
    lost = dialogue.conversation_digests(df.where("false"), df.where("conv_id = 2")).collect()
    assert [tuple(r) for r in lost] == [(2, 0, 0, 0, 0, 0, 0, "", sha(""))]
