"""Every operator as a query over the driver's tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise import fixtures as X
from strandwise import schema as S
from strandwise.functions import fields as C
from strandwise.operators import checks, duplicates, order, regions
from strandwise.plans import modes, report
from strandwise.sources import files, named, text
from strandwise.streaming import files as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def _with(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}" + ",\n".join(ctes) + "\n" + select


# ---- SQL twins' common parts --------------------------------------------------------------------------------------

SAM, CHROMS = X.SAM_SQL, X.CHROMS_SQL
ATOI = r"coalesce(TRY_CAST(regexp_extract(coalesce({x}, ''), '^[ \t\n\x0B\f\r]*([+-]?[0-9]+)', 1) AS BIGINT), 0)"
STRICT = r"CASE WHEN regexp_matches({x}, '^-?[0-9]+$') AND NOT contains({x}, chr(13)) AND NOT contains({x}, chr(10)) THEN TRY_CAST({x} AS BIGINT) END"


def _records(src: str) -> str:
    """rec: every record line, parsed loosely; keyed: those with 11 fields, with the duplicate key."""
    return f"""r0 AS (SELECT line_no, unnest(string_split(line, chr(13))) AS line FROM {src} WHERE NOT starts_with(line, '@')),
r1 AS (SELECT line_no, line, string_split(line, chr(9)) AS f FROM r0 WHERE line <> '' AND NOT starts_with(line, '@')),
rec AS (SELECT line_no, line, (len(f) - CASE WHEN f[-1] = '' THEN 1 ELSE 0 END)::BIGINT AS n_fields, ({ATOI.format(x="f[2]")} & 65535)::BIGINT AS flag, f[3] AS rname, {ATOI.format(x="f[4]")} AS pos,
  f[7] AS rnext, {ATOI.format(x="f[8]")} AS pnext, least(65535, coalesce(list_sum(list_transform(string_split(f[11], ''), lambda c: CASE WHEN c = '' THEN 0 ELSE least(greatest(ord(c) - 33, 0), 15) END)), 0))::BIGINT AS score FROM r1),
keyed AS (SELECT *, CASE WHEN rnext = '=' THEN rname ELSE rnext END AS mate,
  (CASE WHEN flag & 1 <> 0 THEN CASE WHEN flag & 16 <> 0 THEN 1 ELSE 0 END + CASE WHEN flag & 32 <> 0 THEN 2 ELSE 0 END ELSE 0 END)::BIGINT AS orientation FROM rec WHERE n_fields >= 11)"""


KEY = "rname, pos, mate, pnext, orientation"
MARKED = f"""lead_of AS (SELECT *, min(CASE WHEN flag & 2308 = 0 THEN line_no END) OVER (PARTITION BY {KEY}) AS lead_no FROM keyed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}, line_no >= lead_no ORDER BY score DESC, line_no) AS rn FROM lead_of),
marked AS (SELECT *, coalesce(line_no >= lead_no AND rn > 1, false) AS is_dup FROM ranked)"""
MARKED_STRICT = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {KEY}, flag & 2308 = 0 ORDER BY score DESC, line_no) AS rn FROM keyed),
marked AS (SELECT *, flag & 2308 = 0 AND rn > 1 AS is_dup FROM ranked)"""
FLAG_OUT = "(CASE WHEN is_dup THEN flag | 1024 ELSE flag END)::BIGINT"


def _dictionary(arrival: str) -> str:
    return f"""names AS (SELECT rname AS name, {arrival} AS a, 0 AS side FROM rec WHERE n_fields > 2 AND rname <> '*' UNION ALL
  SELECT rnext, {arrival}, 1 FROM rec WHERE n_fields > 6 AND rnext NOT IN ('*', '=')),
dict AS (SELECT name, (row_number() OVER (ORDER BY first) - 1)::BIGINT AS tid FROM (SELECT name, min(struct_pack(a := a, side := side)) AS first FROM names GROUP BY 1))"""


def _coordinates(src: str, headers_first: bool = False) -> str:
    """pt: the strict parse of every line."""
    head = "AND NOT starts_with(line, '@')" if headers_first else ""
    return f"""a0 AS (SELECT line_no, line, string_split(line, chr(9))[3] AS n, string_split(line, chr(9))[4] AS p FROM {src}),
a1 AS (SELECT *, {STRICT.format(x="p")} AS v FROM a0),
pt AS (SELECT line_no, line, v IS NOT NULL {head} AS valid, CASE WHEN v IS NOT NULL {head} THEN n END AS rname, CASE WHEN v IS NOT NULL {head} THEN v END AS pos FROM a1)"""


USED = "used AS (SELECT pt.line_no, pt.line, pt.rname, pt.pos, length FROM pt JOIN chroms ON name = rname WHERE valid AND pos BETWEEN 1 AND length)"
BINS = f"""bins AS (SELECT rname, least((pos - 1) // {S.BIN_WIDTH}, greatest((length + {S.BIN_WIDTH - 1}) // {S.BIN_WIDTH} - 1, 0))::BIGINT AS bin, sum(strlen(line) + 1)::BIGINT AS weight FROM used GROUP BY 1, 2)"""
GREEDY = f"""cum AS (SELECT rname, bin, sum(weight) OVER (PARTITION BY rname ORDER BY bin) AS c FROM bins),
cuts(rname, bin, c) AS (SELECT rname, min(bin), min(c) FROM cum WHERE c >= {X.TARGET} GROUP BY rname UNION ALL
  SELECT rname, bin, c FROM (SELECT cum.rname, cum.bin, cum.c, row_number() OVER (PARTITION BY cum.rname ORDER BY cum.bin) AS rn FROM cuts JOIN cum ON cum.rname = cuts.rname AND cum.bin > cuts.bin AND cum.c >= cuts.c + {X.TARGET}) WHERE rn = 1),
ends AS (SELECT rname, least((bin + 1) * {S.BIN_WIDTH}, {X.CHROM_LENGTH})::BIGINT AS region_end FROM cuts),
greedy AS (SELECT rname AS chr, coalesce(lag(region_end) OVER (PARTITION BY rname ORDER BY region_end) + 1, 1)::BIGINT AS region_start, region_end FROM ends UNION ALL
  SELECT name, coalesce(max(region_end), 0) + 1, any_value(length) FROM chroms LEFT JOIN ends ON rname = name GROUP BY name HAVING coalesce(max(region_end), 0) + 1 <= any_value(length)),
placed AS (SELECT line_no, line, chr, region_start, region_end FROM used JOIN greedy ON chr = rname AND pos BETWEEN region_start AND region_end)"""
REGIONS = (SAM, CHROMS, _coordinates("dirty", True), USED, BINS, GREEDY)

sam, dirty, chroms = X.sam_lines, X.dirty_lines, X.chroms


# ---- scans and parsing ----------------------------------------------------------------------------------------------


@query("scan_lines", _with(SAM, select="SELECT line_no, line FROM sam"))
def scan_lines(spark, d):
    return sam(spark, d)


@query("read_text", _with(SAM, select=f"SELECT line_no // {X.TEXT_LINES} AS file_no, line_no % {X.TEXT_LINES} AS line_no, line FROM dirty"))
def read_text(spark, d):
    lines = text.read_lines(spark, X.text_folder(spark, d))
    return lines.select(F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("long").alias("file_no"), "line_no", "line")


@query("scan_records", _with(SAM, _records("dirty"), select="SELECT line_no, line FROM rec"))
def scan_records(spark, d):
    return text.scan_records(dirty(spark, d)).select("line_no", "line")


@query(
    "line_kinds",
    _with(
        SAM,
        r"""k0 AS (SELECT line, regexp_replace(line, '\r+$', '') AS body FROM dirty), k1 AS (SELECT line, body, string_split(body, chr(9)) AS f FROM k0)""",
        select="""SELECT CASE WHEN starts_with(line, '@') THEN 'header' WHEN body = '' THEN 'blank' WHEN len(f) - CASE WHEN f[-1] = '' THEN 1 ELSE 0 END < 11 THEN 'malformed' ELSE 'record' END AS kind, count(*)::BIGINT AS n FROM k1 GROUP BY 1""",
    ),
)
def line_kinds(spark, d):
    return checks.line_kinds(dirty(spark, d))


@query("parse_rname_pos", _with(SAM, _coordinates("dirty"), select="SELECT line_no, rname, pos, valid FROM pt"))
def parse_rname_pos(spark, d):
    return order.with_coordinates(dirty(spark, d)).select("line_no", "rname", "pos", "valid")


@query("markdup_fields", _with(SAM, _records("dirty"), select="SELECT line_no, flag, rname, pos, rnext, pnext, score FROM keyed"))
def markdup_fields(spark, d):
    return duplicates.records(text.parse(text.scan_records(dirty(spark, d)))).select("line_no", "flag", "rname", "pos", "rnext", "pnext", "score")


_TYPED = r"""ty AS (SELECT line_no, line, string_split(regexp_replace(line, '\r+$', ''), chr(9)) AS f, regexp_replace(line, '\r+$', '') AS body FROM dirty)"""
_INT = lambda k, of="BIGINT": f"TRY_CAST({STRICT.format(x=f'f[{k}]')} AS {of})"


@query(
    "typed_fields",
    _with(
        SAM,
        _TYPED,
        select=f"""SELECT line_no, (strlen(line) + 1)::BIGINT AS line_bytes, f[1] AS qname, {_INT(2, "INT")} AS flag, f[3] AS rname, {_INT(4)} AS pos, {_INT(5, "INT")} AS mapq, f[6] AS cigar, f[7] AS rnext, {_INT(8)} AS pnext, {_INT(9)} AS tlen, f[10] AS seq, f[11] AS qual,
  coalesce(array_to_string(f[12:], chr(9)), '') AS tags, CASE WHEN starts_with(line, '@') THEN 'header' WHEN body = '' THEN 'blank' WHEN len(f) - CASE WHEN f[-1] = '' THEN 1 ELSE 0 END < 11 THEN 'malformed' ELSE 'record' END AS kind FROM ty""",
    ),
)
def typed_fields(spark, d):
    return text.typed(dirty(spark, d).select("line_no", "line")).drop("line").withColumn("tags", F.array_join("tags", "\t"))


def _value(column: str) -> Query:
    return lambda spark, d: duplicates.records(text.parse(text.scan_records(dirty(spark, d)))).select("line_no", F.col(column).alias("value"))


for _name, _column in (("qual_score", "score"), ("orientation", "orientation"), ("mate_norm", "mate")):
    query(_name, _with(SAM, _records("dirty"), select=f"SELECT line_no, {_column} AS value FROM keyed"))(_value(_column))


@query("rewrite_flag", _with(SAM, _records("dirty"), MARKED, select=f"SELECT line_no, array_to_string(list_concat([string_split(line, chr(9))[1], {FLAG_OUT}::VARCHAR], string_split(line, chr(9))[3:]), chr(9)) AS line_out FROM marked"))
def rewrite_flag(spark, d):
    marked = duplicates.mark_duplicates(duplicates.records(text.parse(text.scan_records(dirty(spark, d)))))
    return marked.select("line_no", C.rewritten(F.col("line"), F.col("flag_out")).alias("line_out"))


EDGE_NAMES = ["chr01", "chr022", "chr23", "chr0", "chr+5", "chr", "chrx", "chrX ", "chr1_alt", "1", "chr-1", ""]
_WANTED = "regexp_full_match(name, 'chr(X|Y|{plus}0*([1-9]|1[0-9]|2[0-2]))')"


@query(
    "wanted_chroms",
    _with(
        SAM,
        "names(name) AS (SELECT string_split(line, chr(9))[3] FROM sam UNION SELECT * FROM (VALUES " + ", ".join(f"('{n}')" for n in EDGE_NAMES) + "))",
        select=f"SELECT name, {_WANTED.format(plus='')} AS wanted, {_WANTED.format(plus='[+]?')} AS wanted_tiled FROM names",
    ),
)
def wanted_chroms(spark, d):
    edges = spark.createDataFrame([(n,) for n in EDGE_NAMES], "name string")
    names = sam(spark, d).select(C.part(F.col("line"), 2).alias("name")).union(edges).distinct()
    return names.select("name", C.wanted_weighted(F.col("name")).alias("wanted"), C.wanted_tiled(F.col("name")).alias("wanted_tiled"))


# ---- order and duplicates ---------------------------------------------------------------------------------------------


@query("coord_sort", _with(SAM, _coordinates("dirty"), select="SELECT line_no, row_number() OVER (ORDER BY valid, rname NULLS FIRST, pos NULLS FIRST, line_no) - 1 AS out_ord FROM pt"))
def coord_sort(spark, d):
    return order.numbered(order.with_coordinates(dirty(spark, d)), order.COORDINATE_ORDER, "out_ord").select("line_no", "out_ord")


@query("header_block", _with(SAM, select="SELECT line_no, line FROM dirty WHERE line_no < (SELECT min(line_no) FROM dirty WHERE NOT starts_with(line, '@'))"))
def header_block(spark, d):
    return duplicates.header_block(dirty(spark, d)).select("line_no", "line")


@query("ref_dict", _with(SAM, _records("dirty"), _dictionary("line_no"), select="SELECT name, tid FROM dict"))
def ref_dict(spark, d):
    parsed = text.parse(text.scan_records(dirty(spark, d)))
    return order.reference_dictionary(modes.named_records(parsed), ["line_no"])


@query("dup_groups", _with(SAM, _records("dirty"), MARKED, select=f"SELECT {KEY}, count(*)::BIGINT AS group_size, count(*) FILTER (is_dup)::BIGINT AS n_dup FROM marked GROUP BY ALL"))
def dup_groups(spark, d):
    return duplicates.duplicate_groups(duplicates.mark_duplicates(duplicates.records(text.parse(text.scan_records(dirty(spark, d))))))


def _markdup(policy: str) -> Query:
    return lambda spark, d: duplicates.mark_duplicates(duplicates.records(text.parse(text.scan_records(dirty(spark, d)))), policy).select("line_no", "score", "is_dup", "flag_out")


for _name, _sql in (("compat", MARKED), ("strict", MARKED_STRICT)):
    query(f"markdup_{_name}", _with(SAM, _records("dirty"), _sql, select=f"SELECT line_no, score, is_dup, {FLAG_OUT} AS flag_out FROM marked"))(_markdup(_name))

_TIDS = "tids AS (SELECT m.*, coalesce(p.tid, -1) AS tid, coalesce(q.tid, -1) AS mate_tid FROM marked m LEFT JOIN dict p ON p.name = m.rname LEFT JOIN dict q ON q.name = m.mate)"
_SORTED = "sorted AS (SELECT line_no, row_number() OVER (ORDER BY valid, rname NULLS FIRST, pos NULLS FIRST, line_no) AS s FROM pt)"
_OUT = "row_number() OVER (ORDER BY tid, pos, mate_tid, pnext, orientation, line_no) - 1 AS out_ord"


@query("markdup_order", _with(SAM, _records("dirty"), MARKED, _dictionary("line_no"), _TIDS, select=f"SELECT line_no, tid, {_OUT} FROM tids"))
def markdup_order(spark, d):
    return order.numbered(modes.mark_lines(dirty(spark, d)), modes.MARKED_ORDER, "out_ord").select("line_no", "tid", "out_ord")


@query(
    "sort_markdup",
    _with(
        SAM,
        _records("dirty"),
        MARKED,
        _coordinates("dirty"),
        _SORTED,
        _dictionary("(SELECT s FROM sorted WHERE sorted.line_no = rec.line_no)"),
        _TIDS,
        select=f"SELECT line_no, tid, score, {FLAG_OUT} AS flag_out, {_OUT} FROM tids",
    ),
)
def sort_markdup(spark, d):
    return order.numbered(modes.mark_lines(dirty(spark, d), presorted=True), modes.MARKED_ORDER, "out_ord").select("line_no", "tid", "score", "flag_out", "out_ord")


# ---- counters, FASTA and weighted regions ---------------------------------------------------------------------------


@query("used_reads", _with(SAM, CHROMS, _coordinates("dirty", True), USED, select="SELECT line_no, rname, pos FROM used"))
def used_reads(spark, d):
    return regions.used_reads(dirty(spark, d), chroms(spark)).select("line_no", "rname", "pos")


@query("sam_load_stats", _with(SAM, CHROMS, _coordinates("dirty", True), USED, select="SELECT (SELECT count(*) FROM dirty WHERE NOT starts_with(line, '@'))::BIGINT AS total, (SELECT count(*) FROM used)::BIGINT AS used"))
def sam_load_stats(spark, d):
    return checks.load_stats(dirty(spark, d), chroms(spark))


@query("chr_counts", _with(SAM, CHROMS, _coordinates("dirty", True), USED, select="SELECT rname, count(*)::BIGINT AS n FROM used GROUP BY 1"))
def chr_counts(spark, d):
    return regions.used_reads(dirty(spark, d), chroms(spark)).groupBy("rname").agg(F.count(F.lit(1)).alias("n"))


_FASTA = r"""fh AS (SELECT line_no, line, CASE WHEN starts_with(line, '>') THEN regexp_extract(line, '^>[ \t]*([^ \t\r]*)', 1) END AS own FROM fasta),
fn AS (SELECT line_no, line, own, last_value(own IGNORE NULLS) OVER (ORDER BY line_no) AS name FROM fh),
flen AS (SELECT name, sum(CASE WHEN own IS NULL THEN strlen(regexp_replace(line, '[{skip}\r\n]', '', 'g')) ELSE 0 END)::BIGINT AS length, min(CASE WHEN own IS NOT NULL THEN line_no END) AS ord FROM fn WHERE name IS NOT NULL GROUP BY 1)"""


@query("fasta_lengths", _with(X.FASTA_SQL, _FASTA.format(skip=r" \t"), select="SELECT name, length FROM flen"))
def fasta_lengths(spark, d):
    return text.fasta_lengths(X.fasta_lines(spark, d)).select("name", "length")


@query("fasta_offsets", _with(X.FASTA_SQL, _FASTA.format(skip=""), select=f"SELECT name, length, coalesce(sum(length) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM flen WHERE {_WANTED.format(plus='[+]?')}"))
def fasta_offsets(spark, d):
    return regions.offsets(_fasta_chroms(spark, d)).select("name", "length", "offset")


@query("bin_weights", _with(SAM, CHROMS, _coordinates("dirty", True), USED, BINS, select="SELECT rname, bin, weight FROM bins"))
def bin_weights(spark, d):
    return regions.bin_weights(regions.used_reads(dirty(spark, d), chroms(spark)))


@query("greedy_regions", _with(*REGIONS, select="SELECT chr, region_start, region_end FROM greedy", recursive=True))
def greedy_regions(spark, d):
    return modes.weighted_regions(dirty(spark, d), chroms(spark), X.TARGET)


@query(
    "greedy_carry",
    _with(
        *REGIONS[:-1],
        f"""cum AS (SELECT rname, bin, sum(weight) OVER (PARTITION BY rname ORDER BY bin) AS c FROM bins),
top AS (SELECT rname, max(c)::BIGINT AS total FROM cum GROUP BY 1),
steps AS (SELECT rname, unnest(range(1, total // {X.TARGET} + 1)) AS k FROM top),
ends AS (SELECT s.rname, k, least((min(bin) + 1) * {S.BIN_WIDTH}, {X.CHROM_LENGTH})::BIGINT AS region_end FROM steps s JOIN cum ON cum.rname = s.rname AND c >= k * {X.TARGET} GROUP BY 1, 2)""",
        select="""SELECT rname AS chr, coalesce(lag(region_end) OVER (PARTITION BY rname ORDER BY k) + 1, 1)::BIGINT AS region_start, region_end FROM ends UNION ALL
  SELECT name, coalesce(max(region_end), 0) + 1, any_value(length) FROM chroms LEFT JOIN ends ON rname = name GROUP BY name HAVING coalesce(max(region_end), 0) + 1 <= any_value(length)""",
    ),
)
def greedy_carry(spark, d):
    return modes.weighted_regions(dirty(spark, d), chroms(spark), X.TARGET, carry=True)


@query("assign_region", _with(*REGIONS, select="SELECT line_no, chr, region_start, region_end FROM placed", recursive=True))
def assign_region(spark, d):
    return modes.weighted_split(dirty(spark, d), chroms(spark), X.TARGET).select("line_no", "chr", "region_start", "region_end")


@query("region_sizes", _with(*REGIONS, select="SELECT concat_ws('_', chr, region_start, region_end) AS region, count(*)::BIGINT AS n, sum(strlen(line) + 1)::BIGINT AS bytes FROM placed GROUP BY 1", recursive=True))
def region_sizes(spark, d):
    placed = modes.weighted_split(dirty(spark, d), chroms(spark), X.TARGET)
    return placed.groupBy(F.concat_ws("_", "chr", "region_start", "region_end").alias("region")).agg(F.count(F.lit(1)).alias("n"), F.sum(C.line_bytes(F.col("line"))).alias("bytes"))


# ---- region lists, names and checks ---------------------------------------------------------------------------------

_LIST = r"""rl AS (SELECT regexp_split_to_array(regexp_replace(line, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g'), '[ \t]+') AS f FROM region_lines WHERE NOT regexp_matches(line, '^[ \t\r\n]*(#|$)')),
listed AS (SELECT f[1] AS chr, f[2]::BIGINT AS region_start, f[3]::BIGINT AS region_end FROM rl)"""
_SPLIT = "spl AS (SELECT line_no, concat_ws('_', chr, region_start, region_end) AS region FROM pt JOIN listed ON chr = rname AND pos BETWEEN region_start AND region_end WHERE valid AND pos > 0)"


def _listed(spark) -> DataFrame:
    return text.parse_region_list(X.constant_lines(spark, X.REGION_LINES))


@query("parse_region_list", _with(X.LONG_LIST_SQL, _LIST, select="SELECT chr, region_start, region_end FROM listed"))
def parse_region_list(spark, d):
    return text.parse_region_list(X.order_lines(spark, d, X.LIST_SQL), most=None).select("chr", "region_start", "region_end")


@query("split_by_list", _with(SAM, X.REGION_LINES_SQL, _LIST, _coordinates("dirty", True), _SPLIT, select="SELECT line_no, region FROM spl"))
def split_by_list(spark, d):
    return regions.split_by_list(dirty(spark, d), _listed(spark).drop("line_no")).select("line_no", F.concat_ws("_", "chr", "region_start", "region_end").alias("region"))


#: Forty spans a chromosome, of one to three steps with gaps between some, so that they overlap.
_OVERLAPPING = f"""SELECT name AS chr, CAST(1 + k * {X.CHROM_LENGTH // 40} AS BIGINT) AS region_start, CAST(least({X.CHROM_LENGTH}, (k + 1 + k % 3) * {X.CHROM_LENGTH // 40}) AS BIGINT) AS region_end FROM {{chroms}} CROSS JOIN range(40) AS r(k) WHERE k % 7 < 5"""
_PROBE = f"""ol AS (SELECT *, row_number() OVER (PARTITION BY chr ORDER BY region_start, region_end) - 1 AS k, count(*) OVER (PARTITION BY chr) AS n FROM ({_OVERLAPPING.format(chroms="chroms")})),
probe(line_no, chr, pos, lo, hi) AS (SELECT line_no, rname, pos, 0::BIGINT, n - 1 FROM pt JOIN (SELECT DISTINCT chr, n FROM ol) ON chr = rname WHERE valid AND pos > 0 UNION ALL
  SELECT line_no, p.chr, pos, CASE WHEN pos > region_end THEN k + 1 ELSE lo END, CASE WHEN pos < region_start THEN k - 1 ELSE hi END FROM probe p JOIN ol ON ol.chr = p.chr AND k = (lo + hi) // 2 WHERE lo <= hi AND pos NOT BETWEEN region_start AND region_end)"""


@query(
    "split_by_list_compat",
    _with(SAM, CHROMS, _coordinates("dirty", True), _PROBE, select="SELECT line_no, concat_ws('_', ol.chr, region_start, region_end) AS region FROM probe p JOIN ol ON ol.chr = p.chr AND k = (lo + hi) // 2 WHERE lo <= hi AND pos BETWEEN region_start AND region_end", recursive=True),
)
def split_by_list_compat(spark, d):
    spans = spark.sql(_OVERLAPPING.format(chroms="{chroms}").replace("range(40) AS r(k)", "(SELECT id AS k FROM range(40)) r"), chroms=chroms(spark))
    found = regions.split_by_list(dirty(spark, d), spans, S.COMPAT)
    return found.select("line_no", F.concat_ws("_", "chr", "region_start", "region_end").alias("region"))


@query(
    "split_stats",
    _with(SAM, X.REGION_LINES_SQL, _LIST, _coordinates("dirty", True), _SPLIT, select=r"SELECT (SELECT count(*) FROM dirty WHERE NOT starts_with(line, '@') AND regexp_replace(line, '\r+$', '') <> '')::BIGINT AS total, (SELECT count(*) FROM spl)::BIGINT AS assigned"),
)
def split_stats(spark, d):
    return regions.split_stats(dirty(spark, d), _listed(spark).drop("line_no"))


_NAMES = r"""fn0 AS (SELECT line AS name, string_split(string_split(line, '.sam')[1], '_') AS f, contains(line, '.sam') AS sam FROM region_names),
fn1 AS (SELECT name, f, sam, CASE WHEN regexp_matches(f[2], '^[+-]?[0-9]+$') THEN TRY_CAST(f[2] AS BIGINT) END AS s, CASE WHEN regexp_matches(f[3], '^[+-]?[0-9]+$') THEN TRY_CAST(f[3] AS BIGINT) END AS e FROM fn0),
fn2 AS (SELECT *, coalesce(sam AND s > 0 AND s <= e, false) AS ok FROM fn1),
rn AS (SELECT name, ok, CASE WHEN ok THEN f[1] END AS chr, CASE WHEN ok THEN s END AS region_start, CASE WHEN ok THEN e END AS region_end FROM fn2)"""


def _names(spark, d) -> DataFrame:
    return X.order_lines(spark, d, X.NAMES_SQL).select(F.col("line").alias("name"))


@query("parse_region_filename", _with(X.REGION_NAMES_SQL, _NAMES, select="SELECT name, chr, region_start, region_end, ok, suffix(name, '.sam') AS ends_so FROM rn"))
def parse_region_filename(spark, d):
    rows = _names(spark, d).withColumn("r", text.region_of_name(F.col("name")))
    return rows.select("name", "r.chr", "r.region_start", "r.region_end", F.col("r").isNotNull().alias("ok"), C.has_suffix(F.col("name"), ".sam").alias("ends_so"))


@query("region_catalog", _with(X.REGION_NAMES_SQL, _NAMES, select="SELECT DISTINCT chr, region_start, region_end FROM rn WHERE ok"))
def region_catalog(spark, d):
    return checks.region_catalog(_names(spark, d))


_CHECK = f"""{_coordinates("dirty", True)},
rf AS ({X.FILES_SQL.format(src="pt")}),
rf1 AS (SELECT * FROM (SELECT rf.*, pt.rname, pt.pos, string_split(string_split(file, '.')[1], '_') AS f FROM rf JOIN pt USING (line_no)) WHERE f[2]::BIGINT > 0),
judged AS (SELECT file, line_no, CASE WHEN starts_with(line, '@') OR regexp_replace(line, '\\r+$', '') = '' THEN 'none' WHEN rname IS NULL THEN 'unparsed' WHEN rname = '*' OR pos <= 0 THEN 'unmapped' WHEN rname <> f[1] THEN 'bad_chr' WHEN pos NOT BETWEEN f[2]::BIGINT AND f[3]::BIGINT THEN 'bad_range' ELSE 'good' END AS kind FROM rf1)"""


@query(
    "region_check",
    _with(
        SAM,
        _CHECK,
        select="""SELECT file, count(*) FILTER (kind <> 'none')::BIGINT AS total, count(*) FILTER (kind IN ('good', 'bad_chr', 'bad_range'))::BIGINT AS checked, count(*) FILTER (kind = 'bad_chr')::BIGINT AS bad_chr, count(*) FILTER (kind = 'bad_range')::BIGINT AS bad_range,
  count(*) FILTER (kind IN ('unmapped', 'unparsed'))::BIGINT AS unmapped_or_zero, count(*) FILTER (kind LIKE 'bad%') = 0 AS ok FROM judged GROUP BY 1""",
    ),
)
def region_check(spark, d):
    return checks.region_check(X.region_files(spark, d))


@query("region_check_errors", _with(SAM, _CHECK, select="SELECT file, line_no, kind, rn FROM (SELECT file, line_no, kind, row_number() OVER (PARTITION BY file ORDER BY line_no) AS rn FROM judged WHERE kind LIKE 'bad%' OR kind = 'unparsed') WHERE rn <= 10"))
def region_check_errors(spark, d):
    return checks.region_check_errors(X.region_files(spark, d))


# ---- tiles, names and sinks -------------------------------------------------------------------------------------------

_OFFSETS = """off AS (SELECT name, length, coalesce(sum(length) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM chroms),
tot AS (SELECT sum(length)::BIGINT AS total, ((sum(length) + 6143) // 6144)::BIGINT AS width FROM chroms)"""
_LOOSE = f"""ld AS (SELECT line_no, string_split(line, chr(9)) AS f FROM dirty WHERE NOT starts_with(line, '@') AND regexp_replace(line, '\\r+$', '') <> ''),
lp AS (SELECT line_no, CASE WHEN len(f) >= 4 THEN f[3] END AS rname, CASE WHEN len(f) >= 4 THEN {ATOI.format(x="f[4]")} END AS pos FROM ld),
tiled AS (SELECT line_no, CASE WHEN rname <> '*' AND pos > 0 THEN o + pos - 1 END AS g, CASE WHEN o IS NOT NULL AND rname <> '*' AND pos > 0 THEN least((o + pos - 1) // width, 6143)::BIGINT END AS rid FROM lp LEFT JOIN off ON name = rname CROSS JOIN tot)"""


#: Chromosomes by the FASTA made of documents.
_FASTA_CHROMS = (X.FASTA_SQL, _FASTA.format(skip=""), f"chroms AS (SELECT name, length, ord FROM flen WHERE {_WANTED.format(plus='[+]?')})")


def _fasta_chroms(spark, d) -> DataFrame:
    return text.fasta_lengths(X.fasta_lines(spark, d), C.wanted_tiled(F.col("name")), blanks=True)


@query(
    "static_regions",
    _with(
        *_FASTA_CHROMS,
        _OFFSETS,
        """t AS (SELECT r AS rid, least(r * width, total - 1) AS a, least((r + 1) * width, total) - 1 AS b FROM range(6144) x(r), tot)""",
        select="SELECT rid::BIGINT AS rid, name AS chr, (a - o + 1)::BIGINT AS region_start, least(b - o + 1, length)::BIGINT AS region_end FROM t JOIN off ON a >= o AND a < o + length",
    ),
)
def static_regions(spark, d):
    return regions.static_regions(_fasta_chroms(spark, d))


@query("global_coord", _with(SAM, CHROMS, _OFFSETS, _LOOSE, select="SELECT line_no, g::BIGINT AS g FROM tiled WHERE g IS NOT NULL"))
def global_coord(spark, d):
    return regions.static_assign(dirty(spark, d), chroms(spark)).where("g is not null").select("line_no", "g")


@query("static_assign", _with(SAM, CHROMS, _OFFSETS, _LOOSE, select="SELECT line_no, rid FROM tiled WHERE rid IS NOT NULL"))
def static_assign(spark, d):
    return modes.tiled_split(dirty(spark, d), chroms(spark)).select("line_no", "rid")


@query("static_stats", _with(SAM, CHROMS, _OFFSETS, _LOOSE, select="SELECT count(*)::BIGINT AS total, count(rid)::BIGINT AS mapped, (count(*) - count(rid))::BIGINT AS unmapped FROM tiled"))
def static_stats(spark, d):
    rows = regions.static_assign(dirty(spark, d), chroms(spark))
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count("rid").alias("mapped"), (F.count(F.lit(1)) - F.count("rid")).alias("unmapped"))


_MODES = {"sort": ".sorted.sam", "markdup": ".markdup.sam", "all": ".sorted.markdup.sam", "other": ".processed.sam"}


@query("output_name", _with(X.REGION_NAMES_SQL, "m(mode, suffix) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _MODES.items()) + ")", select="SELECT line AS input, mode, left(string_split(line, '.sam')[1], 127) || suffix AS name FROM region_names, m"))
def output_name(spark, d):
    named = [_names(spark, d).select(F.col("name").alias("input"), F.lit(m).alias("mode"), C.output_name(F.col("name"), m).alias("name")) for m in _MODES]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@query("region_path", _with(*REGIONS, select="SELECT concat_ws('_', chr, region_start, region_end) AS region, 'out/' || concat_ws('_', chr, region_start, region_end) || '.sam' AS path FROM greedy", recursive=True))
def region_path(spark, d):
    found = modes.weighted_regions(dirty(spark, d), chroms(spark), X.TARGET)
    return found.select(F.concat_ws("_", "chr", "region_start", "region_end").alias("region"), C.region_path(F.lit("out"), F.col("chr"), F.col("region_start"), F.col("region_end")).alias("path"))


@query(
    "run_summary",
    _with(
        SAM,
        _records("dirty"),
        MARKED,
        select="""SELECT 'lines' AS metric, count(*)::BIGINT AS value FROM dirty UNION ALL SELECT 'headers', count(*) FROM dirty WHERE starts_with(line, '@') UNION ALL
  SELECT 'records', count(*) FROM marked UNION ALL SELECT 'duplicates', count(*) FROM marked WHERE is_dup UNION ALL SELECT 'dropped', count(*) FROM rec WHERE n_fields < 11""",
    ),
)
def run_summary(spark, d):
    return report.run_counters(dirty(spark, d))


@query("write_region_files", _with(*REGIONS, select="SELECT concat_ws('_', chr, region_start, region_end) AS region, (count(*) + 3)::BIGINT AS n_lines FROM placed GROUP BY 1", recursive=True))
def write_region_files(spark, d):
    head = spark.createDataFrame([(k, f"@HD\tVN:{k}") for k in range(3)], "line_no long, line string")
    path = files.scratch_path(spark, "regions")
    files.write_region_files(modes.weighted_split(dirty(spark, d), chroms(spark), X.TARGET), head, path, regions.REGION)
    return _file_counts(spark, path)


def _file_counts(spark, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path).select(C.stem(F.col("_metadata.file_name")).alias("region"))
    return lines.groupBy("region").agg(F.count(F.lit(1)).alias("n_lines"))


_SPLIT_FILES = """head(line_no, line) AS (SELECT k, '@HD' || chr(9) || 'VN:' || k FROM range(3) h(k)), region_line AS (SELECT concat_ws('_', chr, region_start, region_end) || '.sam' AS name, 1 AS section, line_no, line FROM placed),
file_line AS (SELECT * FROM region_line UNION ALL SELECT name, 0, head.line_no, head.line FROM (SELECT DISTINCT name FROM region_line), head)"""


def _split_folder(spark, d) -> str:
    """A folder with the weighted split of the dirty lines, a file a region."""
    head = spark.createDataFrame([(k, f"@HD\tVN:{k}") for k in range(3)], "line_no long, line string")
    path = files.scratch_path(spark, "regions")
    files.write_region_files(modes.weighted_split(dirty(spark, d), chroms(spark), X.TARGET), head, path, regions.REGION)
    return path


@query("region_file_digests", _with(*REGIONS, _SPLIT_FILES, select="SELECT name, sum(strlen(line) + 1)::BIGINT AS bytes, md5(string_agg(line || chr(10), '' ORDER BY section, line_no)) AS digest FROM file_line GROUP BY 1", recursive=True))
def region_file_digests(spark, d):
    found = spark.read.format("binaryFile").load(_split_folder(spark, d))
    return found.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"), F.md5("content").alias("digest"))


@query("region_round_trip", _with(*REGIONS, _SPLIT_FILES, select="SELECT name AS file, count(*)::BIGINT AS total, count(*)::BIGINT AS checked, 0::BIGINT AS bad_chr, 0::BIGINT AS bad_range, 0::BIGINT AS unmapped_or_zero, true AS ok FROM file_line WHERE section = 1 GROUP BY 1", recursive=True))
def region_round_trip(spark, d):
    return modes.check_folder(spark, _split_folder(spark, d))[0]


_TILES = """t AS (SELECT r AS rid, least(r * width, total - 1) AS a, least((r + 1) * width, total) - 1 AS b FROM range(6144) x(r), tot),
tiles AS (SELECT rid, name AS chr, (a - o + 1)::BIGINT AS region_start, least(b - o + 1, length)::BIGINT AS region_end FROM t JOIN off ON a >= o AND a < o + length)"""


@query("write_tile_files", _with(SAM, CHROMS, _OFFSETS, _LOOSE, _TILES, select="SELECT concat_ws('_', chr, region_start, region_end, rid) AS region, count(*)::BIGINT AS n_lines FROM tiled JOIN tiles USING (rid) GROUP BY 1"))
def write_tile_files(spark, d):
    path = files.scratch_path(spark, "tiles")
    modes.write_tiles(dirty(spark, d), chroms(spark), path)
    return _file_counts(spark, f"{path}/files")


LARGE_FILE, CHECKED_TILES = 2_700, 2_048
_FEWER = lambda sql: sql.replace("6144", str(CHECKED_TILES)).replace("6143", str(CHECKED_TILES - 1))


@query(
    "file_catalog",
    _with(
        SAM, CHROMS, _FEWER(_OFFSETS), _FEWER(_LOOSE), _coordinates("dirty", True), _FEWER(_TILES),
        f"""tile_line AS (SELECT tiles.rid, chr, region_start, region_end, pt.rname, pt.pos, pt.valid, pt.line FROM tiled JOIN tiles USING (rid) JOIN pt USING (line_no)),
tile_size AS (SELECT tiles.rid, coalesce(sum(strlen(line) + 1), 0)::BIGINT AS bytes, coalesce(bool_or(valid AND rname <> '*' AND pos > 0 AND (rname <> tiles.chr OR pos NOT BETWEEN tiles.region_start AND tiles.region_end)), false) AS bad FROM tiles LEFT JOIN tile_line USING (rid) GROUP BY 1)""",
        select=f"SELECT outcome, count(*)::BIGINT AS n, sum(bytes)::BIGINT AS bytes FROM (SELECT bytes, CASE WHEN bytes > {LARGE_FILE} THEN 'skipped' WHEN bytes = 0 THEN 'empty' WHEN bad THEN 'failed' ELSE 'read' END AS outcome FROM tile_size) GROUP BY 1",
    ),
)
def file_catalog(spark, d):
    path = files.scratch_path(spark, "tiles")
    modes.write_tiles(dirty(spark, d), chroms(spark), path, CHECKED_TILES)
    outcomes = modes.check_folder(spark, f"{path}/files", LARGE_FILE)[1]
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


def _read_list(spark, path: str) -> DataFrame:
    return text.parse_region_list(text.read_lines(spark, path), S.TILES).select("line_no", "chr", "region_start", "region_end")


@query("write_tile_list", _with(*_FASTA_CHROMS, _OFFSETS, _TILES, select="SELECT rid::BIGINT AS line_no, chr, region_start, region_end FROM tiles"))
def write_tile_list(spark, d):
    path = files.scratch_path(spark, "tile-list")
    files.write_region_list(regions.static_regions(_fasta_chroms(spark, d)), path, sep=" ")
    return _read_list(spark, path)


@query("write_region_list", _with(*REGIONS, select="SELECT row_number() OVER (ORDER BY chr, region_start) - 1 AS line_no, chr, region_start, region_end FROM greedy", recursive=True))
def write_region_list(spark, d):
    path = files.scratch_path(spark, "region-list")
    files.write_region_list(modes.weighted_regions(dirty(spark, d), chroms(spark), X.TARGET), path)
    return _read_list(spark, path)


def _processed(spark, lines: DataFrame, mode: str) -> DataFrame:
    """(name, ord, line) of the written outputs."""
    path = files.scratch_path(spark, mode)
    modes.process_files(lines, path, mode)
    return text.read_lines(spark, path).select(F.substring_index("file", "/", -1).alias("name"), F.col("line_no").alias("ord"), "line")


@query("process_sort", _with(SAM, _coordinates("dirty"), select="SELECT concat('f', line_no % 3, '.sorted.sam') AS name, row_number() OVER (PARTITION BY line_no % 3 ORDER BY valid, rname NULLS FIRST, pos NULLS FIRST, line_no) - 1 AS ord, line FROM pt"))
def process_sort(spark, d):
    lines = dirty(spark, d).withColumn("file", F.concat(F.lit("in/f"), (F.col("line_no") % 3).cast("string"), F.lit(".sam")))
    return _processed(spark, lines, "sort")


_LINE_OUT = f"array_to_string(list_concat([string_split(line, chr(9))[1], {FLAG_OUT}::VARCHAR], string_split(line, chr(9))[3:]), chr(9))"
_HEAD = "SELECT 0 AS section, -1 AS tid, 0 AS pos, 0 AS mate_tid, 0 AS pnext, 0 AS orientation, line_no, line FROM dirty WHERE line_no < (SELECT min(line_no) FROM dirty WHERE NOT starts_with(line, '@'))"


@query(
    "process_markdup",
    _with(
        SAM, _records("dirty"), MARKED, _dictionary("line_no"), _TIDS,
        f"written AS ({_HEAD} UNION ALL SELECT 1, tid, pos, mate_tid, pnext, orientation, line_no, {_LINE_OUT} FROM tids)",
        select="SELECT 'one.markdup.sam' AS name, row_number() OVER (ORDER BY section, tid, pos, mate_tid, pnext, orientation, line_no) - 1 AS ord, line FROM written",
    ),
)
def process_markdup(spark, d):
    return _processed(spark, dirty(spark, d).withColumn("file", F.lit("one.sam")), "markdup")


_HEAD_SORTED = "SELECT 0 AS section, -1 AS tid, 0 AS pos, 0 AS mate_tid, 0 AS pnext, 0 AS orientation, line_no, line FROM pt WHERE NOT valid AND starts_with(line, '@') AND line_no < (SELECT min(line_no) FROM pt WHERE NOT valid AND NOT starts_with(line, '@'))"


@query(
    "process_all",
    _with(
        SAM, _records("dirty"), MARKED, _coordinates("dirty"), _SORTED, _dictionary("(SELECT s FROM sorted WHERE sorted.line_no = rec.line_no)"), _TIDS,
        f"written AS ({_HEAD_SORTED} UNION ALL SELECT 1, tid, pos, mate_tid, pnext, orientation, line_no, {_LINE_OUT} FROM tids)",
        select="SELECT 'one.sorted.markdup.sam' AS name, row_number() OVER (ORDER BY section, tid, pos, mate_tid, pnext, orientation, line_no) - 1 AS ord, line FROM written",
    ),
)
def process_all(spark, d):
    return _processed(spark, dirty(spark, d).withColumn("file", F.lit("one.sam")), "all")


@query("read_ranges", ORACLES["read_text"])
def read_ranges(spark, d):
    lines = named.read_ranges(spark, X.text_folder(spark, d), range_bytes=1 << 20)
    return lines.select(F.regexp_extract("file", "file_no=([0-9]+)", 1).cast("long").alias("file_no"), "line_no", "line")


@query("stream_sort", ORACLES["process_sort"])
def stream_sort(spark, d):
    source, path, checkpoint = (files.scratch_path(spark, x) for x in ("arriving", "sorted", "stream"))
    lines = dirty(spark, d).withColumn("name", F.concat(F.lit("f"), (F.col("line_no") % 3).cast("string"), F.lit(".sam")))
    named.write_named_files(lines, source, "name", ["line_no"])
    for _ in range(2):  # the second run finds nothing left to do
        streams.process_stream(spark, source, path, "sort", checkpoint, files=2).awaitTermination()
    return text.read_lines(spark, path).select(F.substring_index("file", "/", -1).alias("name"), F.col("line_no").alias("ord"), "line")


_FATES = r"""listed_chr AS (SELECT DISTINCT chr FROM listed),
fated AS (SELECT pt.line_no, CASE WHEN starts_with(line, '@') THEN 'header' WHEN regexp_replace(line, '\r+$', '') = '' THEN 'blank' WHEN NOT valid THEN 'malformed' WHEN rname = '*' OR pos < 1 THEN 'unplaced'
  WHEN rname NOT IN (SELECT chr FROM listed_chr) THEN 'other_chr' WHEN spl.line_no IS NULL THEN 'gap' ELSE 'placed' END AS fate FROM pt LEFT JOIN spl ON spl.line_no = pt.line_no)"""


@query("line_fates", _with(SAM, X.REGION_LINES_SQL, _LIST, _coordinates("dirty", True), _SPLIT, _FATES, select="SELECT fate, count(*)::BIGINT AS n FROM fated GROUP BY 1"))
def line_fates(spark, d):
    return modes.write_fates(dirty(spark, d), _listed(spark).drop("line_no"), files.scratch_path(spark, "fates"))


@query("sweep_regions", ORACLES["assign_region"])
def sweep_regions(spark, d):
    used = regions.used_reads(dirty(spark, d), chroms(spark))
    found = modes.weighted_regions(dirty(spark, d), chroms(spark), X.TARGET)
    return regions.sweep(used.select("line_no", "rname", "pos"), found).select("line_no", *regions.REGION)


def _pointers(carry: bool) -> Query:
    return lambda spark, d: regions.greedy_by_pointers(regions.bin_weights(regions.used_reads(dirty(spark, d), chroms(spark))), chroms(spark), X.TARGET, carry=carry)


for _name, _carry in (("greedy_regions", False), ("greedy_carry", True)):
    query(_name + "_pointers", ORACLES[_name])(_pointers(_carry))


@query(
    "file_dicts",
    _with(
        SAM, _records("dirty"),
        """fnames AS (SELECT line_no % 3 AS k, rname AS name, line_no AS a, 0 AS side FROM rec WHERE n_fields > 2 AND rname <> '*' UNION ALL SELECT line_no % 3, rnext, line_no, 1 FROM rec WHERE n_fields > 6 AND rnext NOT IN ('*', '=')),
ffirst AS (SELECT k, name, min(struct_pack(a := a, side := side)) AS first FROM fnames GROUP BY 1, 2)""",
        select="SELECT 'f' || k || '.sam' AS file, name, (row_number() OVER (PARTITION BY k ORDER BY first) - 1)::BIGINT AS tid FROM ffirst",
    ),
)
def file_dicts(spark, d):
    lines = dirty(spark, d).withColumn("file", F.concat(F.lit("f"), (F.col("line_no") % 3).cast("string"), F.lit(".sam")))
    return order.reference_dictionary(modes.named_records(text.parse(text.scan_records(lines))), ["line_no"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
