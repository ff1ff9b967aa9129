"""Alignment lines made from the driver's tables, the same text for Spark and for the SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.operators.order import numbered, with_coordinates
from strandwise.sources.files import scratch_path, sort_ranges

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

FIELDS_SQL = """SELECT line_no, l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln, CAST(l_quantity AS BIGINT) AS qty FROM {src}"""

VALUES_SQL = """SELECT *,
  CASE WHEN ok % 5 = 0 THEN 0 ELSE 1 + CASE WHEN ln % 2 = 0 THEN 64 ELSE 128 END + CASE WHEN qty % 2 = 0 THEN 32 ELSE 0 END END
  + CASE WHEN ln % 3 = 0 THEN 16 ELSE 0 END + CASE WHEN pk % 17 = 0 THEN 4 ELSE 0 END + CASE WHEN ok % 13 = 0 THEN 256 ELSE 0 END
  + CASE WHEN ok % 19 = 0 THEN 2048 ELSE 0 END + CASE WHEN ok % 29 = 0 THEN 1024 ELSE 0 END AS flag,
  CASE WHEN sk % 26 = 0 THEN '*' WHEN sk % 26 = 23 THEN 'chrX' WHEN sk % 26 = 24 THEN 'chrY' WHEN sk % 26 = 25 THEN 'chrM'
       ELSE concat('chr', CAST(sk % 26 AS VARCHAR(10))) END AS rname,
  CASE WHEN sk % 26 = 0 THEN 0 ELSE 1 + (pk % 40) * 997 END AS pos,
  CASE WHEN ok % 5 = 0 THEN '*' WHEN ok % 7 = 0 THEN concat('chr', CAST(1 + ok % 22 AS VARCHAR(10))) ELSE '=' END AS rnext,
  CASE WHEN ok % 5 = 0 THEN 0 ELSE 1 + (pk % 40) * 997 + 300 * (ln % 2) END AS pnext,
  CASE WHEN pk % 31 = 0 THEN '*'
       ELSE substr('!"#$%&()*+,-./0123456789:;<=>?@ABCDEFGHIJ', CAST(1 + qty % 30 AS INT), CAST(1 + ln AS INT)) END AS qual FROM {src}"""

LINES_SQL = """SELECT line_no, concat_ws(chr(9), concat('q', CAST(ok AS VARCHAR(20))), CAST(flag AS VARCHAR(10)), rname, CAST(pos AS VARCHAR(20)),
  '60', '100M', rnext, CAST(pnext AS VARCHAR(20)), '0', 'ACGT', qual) AS line FROM {src}"""

_NO = "CAST(line_no AS VARCHAR(20))"
#: The same lines with headers, blank lines, short records, odd numbers and carriage returns put in.
DIRTY_SQL = f"""SELECT line_no, CASE WHEN line_no < 3 THEN concat('@HD', chr(9), 'VN:', {_NO})
  WHEN line_no % 97 = 0 THEN concat_ws(chr(9), '@CO', 'a', 'b', {_NO})
  WHEN line_no % 89 = 1 THEN ''
  WHEN line_no % 83 = 2 THEN concat_ws(chr(9), 'q', '0', 'chr1', {_NO})
  WHEN line_no % 79 = 3 THEN concat_ws(chr(9), 'q', '0099', 'chr2', '+5', '60', '1M', '=', '7', '0', 'A', 'II')
  WHEN line_no % 73 = 4 THEN concat(line, chr(13))
  WHEN line_no % 71 = 5 THEN concat_ws(chr(9), 'q', 'x', 'chr2', '-7', '60', '1M', 'chr3', 'y', '0', 'A', '', 'NM:i:0')
  WHEN line_no % 67 = 6 THEN concat_ws(chr(9), 'q', '70000', 'chr4', 'x', '60', '1M', '=', '7', '0', 'A', '')
  ELSE line END AS line FROM {{src}}"""

CHROMS = [*(f"chr{k}" for k in range(1, 23)), "chrX", "chrY"]
CHROM_LENGTH = 40_000
TARGET = 20_000

REGION_LINES = [
    "# chr start end", "chr1\t1\t10000", "chr1 10001 20000 more columns", "  chr2\t\t5000   30000  ", "", "chr10 1 40000", "chrX\t1\t999", "chrX\t1500\t40000", "   # nothing", "chrM 1 40000",
]
#: A line of a region list for each order: regions of 100 bases that do not overlap, written in all the ways a list allows.
LIST_SQL = """SELECT CAST(ok AS BIGINT) AS line_no, CASE WHEN ok % 11 = 0 THEN concat('  # order ', ok) WHEN ok % 13 = 0 THEN '' WHEN ok % 5 = 0 THEN concat_ws(chr(9), c, s, e)
  WHEN ok % 5 = 1 THEN concat('  ', c, chr(9), chr(9), s, '   ', e, '  ') WHEN ok % 5 = 2 THEN concat_ws(' ', c, s, e, 'more', 'columns') WHEN ok % 5 = 3 THEN concat(c, ' +', s, ' ', e, chr(13)) ELSE concat_ws(' ', c, s, e) END AS line
  FROM (SELECT ok, concat('chr', CAST(1 + ok % 22 AS VARCHAR(20))) AS c, CAST(1 + 100 * ok AS VARCHAR(20)) AS s, CAST(100 * (ok + 1) AS VARCHAR(20)) AS e FROM (SELECT DISTINCT o_orderkey AS ok FROM {src}) t) u"""

#: A name of a region file for each order, a third of them names that declare no region.
NAMES_SQL = """SELECT CAST(ok AS BIGINT) AS line_no, CASE ok % 10 WHEN 0 THEN concat('chr', k, '_1_', k, '.sam') WHEN 1 THEN concat('chr', k, '_1_', k, '_7.sam.sorted.sam') WHEN 2 THEN concat('chr', k, '_alt_1_10.sam') WHEN 3 THEN concat('x', k, '.sam')
  WHEN 4 THEN concat('chr', k, '_0_5.sam') WHEN 5 THEN concat('chr', k, '_5_4.sam') WHEN 6 THEN concat('chr2_5_', CAST(5 + ok % 7 AS VARCHAR(20)), '.sam') WHEN 7 THEN concat('chr', k, '_1_10') WHEN 8 THEN concat('chrX_1_', k, 'x.sam')
  ELSE concat(repeat('n', 130), '_+3_', k, '3.sam') END AS line FROM (SELECT ok, CAST(ok AS VARCHAR(20)) AS k FROM (SELECT DISTINCT o_orderkey AS ok FROM {src}) t) u"""


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """Lines are an input, so they are written once for a session and folder, and read as one."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch_path(spark, name)
        make().write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


_NUMBERED: dict[tuple[str, str], DataFrame] = {}


def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, line), numbered by the unique order of lineitem; what lines are made of is written once, with its numbers."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _NUMBERED:
        items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*ORDER, "l_quantity")
        _NUMBERED[key] = numbered(items, ORDER, "line_no", [*ORDER[:4], "l_quantity"])
    rows = _NUMBERED[key]
    for text in (FIELDS_SQL, VALUES_SQL, LINES_SQL):
        rows = spark.sql(text.format(src="{rows}"), rows=rows)
    return rows


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "dirty", lambda: spark.sql(DIRTY_SQL.format(src="{rows}"), rows=sam_lines(spark, sf_dir)))


SAM_SQL = f"""b0 AS (SELECT CAST(row_number() OVER (ORDER BY {", ".join(ORDER)}) - 1 AS BIGINT) AS line_no, * FROM lineitem),
b1 AS ({FIELDS_SQL.format(src="b0")}), b2 AS ({VALUES_SQL.format(src="b1")}), sam AS ({LINES_SQL.format(src="b2")}), dirty AS ({DIRTY_SQL.format(src="sam")})"""


def chroms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, CHROM_LENGTH, k) for k, n in enumerate(CHROMS)], "name string, length long, ord long")


CHROMS_SQL = "chroms(name, length, ord) AS (VALUES " + ", ".join(f"('{n}', {CHROM_LENGTH}::BIGINT, {k}::BIGINT)" for k, n in enumerate(CHROMS)) + ")"


def _values(name: str, rows: list[str]) -> str:
    quoted = (r.replace("\t", "' || chr(9) || '") for r in rows)
    return f"{name}(line_no, line) AS (VALUES " + ", ".join(f"({k}::BIGINT, '{r}')" for k, r in enumerate(quoted)) + ")"


REGION_LINES_SQL = _values("region_lines", REGION_LINES)
REGION_NAMES_SQL = f"region_names(line_no, line) AS ({NAMES_SQL.format(src='orders')})"
LONG_LIST_SQL = f"region_lines(line_no, line) AS ({LIST_SQL.format(src='orders')})"


def constant_lines(spark: SparkSession, rows: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(rows)), "line_no long, line string")


def order_lines(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Lines of LIST_SQL or NAMES_SQL."""
    return spark.sql(sql.format(src="{orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"))


def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, line): a name line for each document, some with blanks before the name, then its text's lines."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = F.concat(F.when(F.col("doc_id") % 3 == 0, "> \tchr").otherwise(">chr"), F.col("doc_id").cast("string"), F.lit(" "), F.coalesce("lang", F.lit("")))
    lines = docs.select("doc_id", F.posexplode(F.concat(F.array(name), F.split(F.coalesce("text", F.lit("")), "\n"))).alias("k", "line"))
    return numbered(lines, ["doc_id", "k"], "line_no").select("line_no", "line")


FASTA_SQL = """fl0 AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS k FROM (SELECT doc_id, list_concat([CASE WHEN doc_id % 3 = 0 THEN '> ' || chr(9) || 'chr' ELSE '>chr' END || doc_id || ' ' || coalesce(lang, '')], string_split(coalesce(text, ''), chr(10))) AS ls FROM documents)),
fasta AS (SELECT row_number() OVER (ORDER BY doc_id, k) - 1 AS line_no, line FROM fl0)"""

#: Reads by their place, some in the wrong file; what has no place is in the first file, headers are in a file of their own.
FILES_SQL = """SELECT CASE WHEN line LIKE '@%' THEN 'chr9_1_5.sam' WHEN rname IS NULL OR rname = '*' THEN 'chr1_1_10000.sam'
  ELSE concat(CASE WHEN line_no % 103 = 0 THEN 'chr1' ELSE rname END, '_', CAST(1 + 10000 * k AS VARCHAR(20)), '_', CAST(10000 * (k + 1) AS VARCHAR(20)), '.sam') END AS file, line_no, line FROM (
  SELECT line_no, line, rname, CAST(FLOOR((pos - 1) / 10000) AS BIGINT) + CASE WHEN line_no % 101 = 0 THEN 1 ELSE 0 END AS k FROM {src}) t"""


def region_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line_no, line): dirty lines in files of 10 000 bases."""

    def make() -> DataFrame:
        named = with_coordinates(dirty_lines(spark, sf_dir), headers_first=True).select("line_no", "line", "rname", "pos")
        return spark.sql(FILES_SQL.format(src="{rows}"), rows=named)

    return _once(spark, sf_dir, "region-files", make)


TEXT_LINES = 10_000  # lines of a text file


def text_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of text files `file_no=k/part-*.txt` with the dirty lines, TEXT_LINES in each file."""
    key = (spark.sparkContext.applicationId, sf_dir, "text")
    if key not in _WRITTEN:
        path = scratch_path(spark, "text")
        rows = dirty_lines(spark, sf_dir).withColumn("file_no", F.floor(F.col("line_no") / TEXT_LINES))
        rows.repartition(sort_ranges(spark, rows.count()), "file_no").sortWithinPartitions("file_no", "line_no").select("file_no", "line").write.partitionBy("file_no").text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]
