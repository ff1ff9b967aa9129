"""The corpus operators as queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bestfit, dialogue, kdshard, media, merkle, minhash, mixing, ordinal, repetition, rffquality, tokencount, tokenfile, urlfilter
from .common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

DOMAINS = ("web", "books", "code", "news")
WEIGHTS = {"domain": {"web": 5.0, "books": 2.0, "code": 1.5, "news": 1.5}, "lang": {"en": 7.0, "de": 1.0, "fr": 1.0, "es": 1.0}}
SHARE, EPOCHS, SEED = 0.6, 3, 1
TARGET = 2048


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    if importlib.util.find_spec("public_tokenizers") is None:
        raise FileNotFoundError(f"no folder of public tokenizers to take {name} from")
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def levels() -> dict[str, Column]:
    """The tree's levels: the domain goes by the source's number."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int") % len(DOMAINS)
    domain = F.coalesce(*(F.when(number == k, F.lit(d)) for k, d in enumerate(DOMAINS)))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), levels(), WEIGHTS, SHARE, EPOCHS, SEED)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshard.document_shards(table(spark, sf_dir, "documents"), 8)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, num=85, den=100)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = repetition.repetition_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.carved(media.sniff_media(media.text_media(table(spark, sf_dir, "documents")), "blob", "declared"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.best_fit(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 0, TARGET)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), 0)
    return tokenfile.read_token_files(spark, path)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rffquality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), 4096)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: (verdict, host, path), fixed by the contract of op11.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: What is blocked where no rule fits: labels of hosts, and files that are no pages.
BLOCKED_URLS = ("*.ads-**", "*.adult-**", "*.casino-**", "*.cheap-**", "*.free-bet?.**", "*.spam-**", "**/wp-admin/**", "**/cgi-bin/**", "**.[ez][xi][ep]")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, BLOCKED_URLS, keep=["page_id"])


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and each row folded again: with the digest of its tampered form where crc32 of its id says so."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", UPPER, LOWER)
    now = merkle.digest(merkle.framed(*(lowered if c == "text" else F.col(c) for c in LEAF_FIELDS)))
    rows = merkle.manifest(docs, LEAF_FIELDS, "source", ["doc_id"], keep=["doc_id"], more={"now": F.when(tampered, now)})
    found = rows.withColumn("folded_root", merkle.folded(F.coalesce("now", "leaf"), F.col("path")))
    proof = merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    return dialogue.conversation_digests(dialogue.damaged(talks), talks)


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1, "op2_kd_shards": op2, "op3_minhash": op3, "op4_repetition": op4, "op5_media": op5, "op6_best_fit": op6,
        "op7_token_files": op7, "op8_rff_quality": op8, "op9_token_counts": op9, "op10_toxicity": op10,
        "op11_url_filter": op11, "op12_merkle": op12, "op13_dialogue_repair": op13,
    }


BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def _mixing_sql() -> str:
    case = " ".join(f"WHEN {k} THEN '{d}'" for k, d in enumerate(DOMAINS))
    parts = [f"""d AS (SELECT doc_id, coalesce(CASE TRY_CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % {len(DOMAINS)} {case} END, 'none') AS domain,
  coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + 1 AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS leaf_tokens FROM d GROUP BY ALL),
total AS (SELECT {SHARE}::DOUBLE * sum(leaf_tokens)::DOUBLE AS budget FROM leaves)"""]  # fmt: skip
    names = ["domain", "lang", "source"]
    for k, level in enumerate(names):
        path, parent = ", ".join(names[: k + 1]), ", ".join(names[:k])
        weight = " ".join(f"WHEN '{v}' THEN {x}::DOUBLE" for v, x in WEIGHTS.get(level, {}).items())
        weight = f"CASE {level} {weight} ELSE 1.0::DOUBLE END" if weight else "1.0::DOUBLE"
        given = f"JOIN (SELECT {parent}, budget AS parent_budget FROM b{k - 1}) USING ({parent})" if k else ", (SELECT budget AS parent_budget FROM total)"
        by = f"PARTITION BY {parent} " if k else ""
        parts.append(f"""n{k} AS (SELECT *, {weight} AS weight FROM (SELECT {path}, (sum(leaf_tokens) * {EPOCHS})::BIGINT AS capacity FROM leaves GROUP BY {path}) {given}),
r{k} AS (SELECT *, sum(capacity) OVER w AS cap_upto, sum(weight) OVER w AS weight_upto, sum(weight) OVER ({by}) AS weight_all, sum(capacity) OVER ({by}) AS cap_all FROM n{k}
  WINDOW w AS ({by}ORDER BY capacity::DOUBLE / weight, {path} ROWS UNBOUNDED PRECEDING)),
f{k} AS (SELECT *, cap_upto::DOUBLE + (weight_all - weight_upto) * capacity::DOUBLE / weight <= {"parent_budget" if k else "least(parent_budget, cap_all::DOUBLE)"} AS is_full FROM r{k}),
b{k} AS (SELECT {path}, CASE WHEN is_full THEN capacity::DOUBLE ELSE
  ({"parent_budget" if k else "least(parent_budget, cap_all::DOUBLE)"} - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({by}), 0)::DOUBLE) * weight / sum(CASE WHEN NOT is_full THEN weight END) OVER ({by}) END AS budget FROM f{k})""")  # fmt: skip
    parts.append(f"""p AS (SELECT domain, lang, source, leaf_tokens, least(floor(budget / leaf_tokens)::BIGINT, {EPOCHS}) AS whole, floor(budget)::BIGINT AS budget FROM leaves JOIN b2 USING (domain, lang, source)),
k AS (SELECT d.*, whole, budget - whole * leaf_tokens AS rest, md5('{SEED}:' || whole || ':' || coalesce(doc_id::VARCHAR, 'none')) AS key FROM d JOIN p USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens) AS run FROM k),
c AS (SELECT *, whole + CASE WHEN 2 * run - n_tokens <= 2 * rest THEN 1 ELSE 0 END AS copies FROM s)
SELECT doc_id, domain, lang, source, n_tokens, (copies - 1)::BIGINT AS epoch, copies::BIGINT AS copies FROM c WHERE copies > 0""")
    return "WITH " + ",\n".join(parts)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MINHASH_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
  WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY 1) c USING (doc_id)"""


def _repetition_sql() -> str:
    parts = [f"""t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS ws FROM t)),
base AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY 1),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM t)),
lw AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS rn,
  length(regexp_replace(line, '{BLANKS}', '', 'g')) AS chars FROM l WHERE regexp_matches(line, '{WORD}')),
dl AS (SELECT doc_id, count(*) FILTER (rn > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (rn > 1), 0) AS line_chars FROM lw GROUP BY 1)"""]  # fmt: skip
    for n in (3, *repetition.COVERAGE):
        found = "count(*) OVER (PARTITION BY doc_id, g) > 1" if n == 3 else "row_number() OVER (PARTITION BY doc_id, g ORDER BY pos) > 1"
        gram = " || ' ' || ".join(["w", *(f"lead(w, {k}) OVER o" for k in range(1, n))])
        parts.append(f"""g{n} AS (SELECT doc_id, pos, w, {gram} AS g FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
h{n} AS (SELECT doc_id, pos, w, CASE WHEN g IS NOT NULL AND {found} THEN 1 ELSE 0 END AS dup FROM g{n}),
c{n} AS (SELECT doc_id, sum(cov) AS words, sum(cov * length(w)) AS chars FROM (SELECT doc_id, w, max(dup) OVER (PARTITION BY doc_id ORDER BY pos ROWS {n - 1} PRECEDING) AS cov FROM h{n}) GROUP BY 1)""")
    bad = " OR ".join(f"coalesce(c{n}.chars, 0)::DOUBLE / total > {most}::DOUBLE" for n, most in repetition.COVERAGE.items())
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in (3, *repetition.COVERAGE))
    parts.append(f"""m AS (SELECT t.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(line_chars, 0) AS line_chars, greatest(coalesce(word_chars, 0), 1)::DOUBLE AS total
  FROM t LEFT JOIN base USING (doc_id) LEFT JOIN dl USING (doc_id)),
v AS (SELECT m.*, coalesce(c3.words, 0)::BIGINT AS n_repeat_words, ({bad}) AS bad FROM m {joins}),
x AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.REPEAT_PERCENT} * n_words AS base_failed FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT bad AND line_chars::DOUBLE / total <= {repetition.LINE_COVERAGE}::DOUBLE AND n_symbols <= {repetition.SYMBOLS_PER_WORD}::DOUBLE * n_words AS kept FROM x""")
    return "WITH " + ",\n".join(parts)


URL_SQL = f"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, verdict, rule_host, rule_path) AS (VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'), ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')),
f AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM h JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches('.' || host, '[.](ads|adult|casino|cheap|spam)-|[.]free-bet.[.]') OR contains(path, '/wp-admin/') OR contains(path, '/cgi-bin/')
  OR regexp_matches(host || path, '[.][ez][xi][ep]$') THEN 'block' ELSE 'allow' END) AS verdict FROM h LEFT JOIN f USING (page_id)"""

_FRAMED = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in LEAF_FIELDS)
_LOWERED = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" if c == "translated" else f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*LEAF_FIELDS[:-1], "translated"))
#: node(tree, level, pos, n, hash, preimage): tree is the number of a source, -1 above all sources.
MERKLE_SQL = f"""WITH RECURSIVE polynomial AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS translated, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) AS c FROM documents, polynomial),
l AS (SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, sha256({_FRAMED}) AS leaf, CASE WHEN xor(c, 4294967295) % 5 = 0 THEN sha256({_LOWERED}) END AS now FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
low(tree, level, pos, n, hash, preimage) AS (SELECT tree, 0, pos, n, leaf, '' FROM leaves UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)), string_agg(hash, '' ORDER BY pos) FROM low WHERE n > 1 GROUP BY tree, level, n, pos // 16),
sub AS (SELECT tree, hash, level AS height FROM low WHERE n = 1),
high(tree, level, pos, n, hash, preimage) AS (SELECT -1::BIGINT, 0, tree, (SELECT count(*) FROM sub), hash, '' FROM sub UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)), string_agg(hash, '' ORDER BY pos) FROM high WHERE n > 1 GROUP BY tree, level, n, pos // 16),
top AS (SELECT hash AS root, level AS height FROM high WHERE n = 1),
steps AS (SELECT leaves.tree, leaves.pos AS leaf_pos, low.level, (leaves.pos // pow(16, low.level - 1)::BIGINT) % 16 AS slot, preimage FROM leaves JOIN low ON low.tree = leaves.tree AND low.level > 0 AND low.pos = leaves.pos // pow(16, low.level)::BIGINT UNION ALL
  SELECT leaves.tree, leaves.pos, height + high.level, (leaves.tree // pow(16, high.level - 1)::BIGINT) % 16, preimage FROM leaves JOIN sub USING (tree) JOIN high ON high.level > 0 AND high.pos = leaves.tree // pow(16, high.level)::BIGINT),
paths AS (SELECT tree, leaf_pos AS pos, list(preimage ORDER BY level) AS images, list(slot ORDER BY level) AS slots, string_agg(substr(preimage, 1, slot * 64) || substr(preimage, slot * 64 + 65), '' ORDER BY level) AS siblings FROM steps GROUP BY 1, 2),
fold(tree, pos, k, hash) AS (SELECT tree, pos, 0, coalesce(now, leaf) FROM leaves UNION ALL
  SELECT fold.tree, fold.pos, k + 1, sha256(substr(images[k + 1], 1, slots[k + 1] * 64) || hash || substr(images[k + 1], slots[k + 1] * 64 + 65)) FROM fold JOIN paths USING (tree, pos) WHERE k < len(images)),
ends AS (SELECT tree, pos, arg_max(hash, k) AS folded_root FROM fold GROUP BY 1, 2)
SELECT doc_id, leaf, sub.hash AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN sub USING (tree) CROSS JOIN top LEFT JOIN paths USING (tree, pos) JOIN ends USING (tree, pos)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _mixing_sql(), "op3_minhash": MINHASH_SQL, "op4_repetition": _repetition_sql(), "op11_url_filter": URL_SQL, "op12_merkle": MERKLE_SQL}
