"""Small corpora and brute-force twins for the corpus operators."""

import random
from collections import Counter, defaultdict

WORDS = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta.", "theta,", "iota", "kappa", "la", "mu", "nu", "xi", "omi", "pi"]


def corpus(seed=1, n=60):
    """(doc_id, text, lang, source): originals, exact and near copies, and the odd cases."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        if k and rng.random() < 0.3:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            text = " ".join(words)
        else:
            text = " ".join(rng.choice(WORDS) + (rng.choice(["", "\n", "\t"]) if rng.random() < 0.1 else "") for _ in range(rng.choice([5, 60, 120, 300])))
        rows.append((k, text, rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "src2", "odd", None])))
    odd = ["", " \n\t ", "one", "ONE", "two words", "a  b\n c <|endoftext|> d<s> ", "x▁y   \n\n z\t\tq ² ﬁ é́ 12３ a_b", "日本語 テスト 　 x\x1cy\x85 z's don't", "\n a", "foo\n  bar \nbaz  \nq", "same line\nsame line\nsame line"]
    rows += [(1000 + k, t, "en", "src0") for k, t in enumerate(odd)]
    rows.append((2000, None, None, None))
    rows.append((2001, "long " * 30_000 + "tail", "en", "src1"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, rows):
    """The corpus with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in ("n_words", "kept", "rep", "length", "bucket", "size", "n_tokens", "media", "score", "node")})


def shingle_sets(rows, size):
    sets = {}
    for doc_id, text, *_ in rows:
        raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        w = raw.split()
        sets[doc_id] = frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    return sets


def duplicate_groups(rows, size, num, den):
    """doc_id -> (set size, component, kept), by comparing all pairs that share a shingle."""
    sets = shingle_sets(rows, size)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        shared = Counter(o for s in sets[d] for o in holders[s])
        for o, n in shared.items():
            if den * n >= num * (len(sets[d]) + len(sets[o]) - n):
                low, high = sorted((find(d), find(o)))
                parent[high] = low
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def repetition(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed), plainly."""
    text = text or ""
    w = text.encode().split()
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)
