"""Column expressions over one alignment line; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandwise import schema as S

INTEGER = r"^-?[0-9]+\z"
LEADING_INTEGER = r"^[ \t\n\x0B\f\r]*([+-]?[0-9]+)"


def parts(line: Column, most: int = 12) -> Column:
    """The first `most` - 1 tab-separated fields and the rest."""
    return F.split(line, "\t", most)


def part(line: Column, k: int) -> Column:
    """Field k from 0; null beyond the last one."""
    return F.get(F.split(line, "\t", k + 2), F.lit(k))


def n_fields(line: Column) -> Column:
    """Number of fields; an empty one at the very end does not count."""
    n = F.length(line) - F.length(F.replace(line, F.lit("\t"), F.lit(""))) + 1
    return (n - F.when((line == "") | line.endswith("\t"), 1).otherwise(0)).cast("long")


def strict_integer(text: Column) -> Column:
    """-?[0-9]+ as a long; null for all else, also beyond the range of a long."""
    return F.when(text.rlike(INTEGER), text.try_cast("long"))


def loose_integer(text: Column) -> Column:
    """The integer at the start, after blanks; 0 where there is none."""
    return F.coalesce(F.regexp_extract(F.coalesce(text, F.lit("")), LEADING_INTEGER, 1).try_cast("long"), F.lit(0).cast("long"))


def is_header(line: Column) -> Column:
    return line.startswith("@")


def without_cr(line: Column) -> Column:
    return F.regexp_replace(line, r"\r+\z", "")


def line_kind(line: Column) -> Column:
    """header, blank, malformed (fewer than 11 fields) or record."""
    body = without_cr(line)
    return F.when(is_header(line), "header").when(body == "", "blank").when(n_fields(body) < S.MIN_FIELDS, "malformed").otherwise("record")


def flag_value(text: Column) -> Column:
    """FLAG as an unsigned 16-bit number."""
    return loose_integer(text).bitwiseAND(F.lit(0xFFFF))


def quality_score(qual: Column) -> Column:
    """Sum over QUAL of the Phred value clamped to 0..15, at most 65535.

    Each character counts 15, less what each of the few characters below the cap lacks: no object for each base."""
    n = F.length(qual)
    times = lambda c: n - F.length(F.replace(qual, F.lit(c), F.lit("")))
    none = "".join(map(chr, range(1, S.QUALITY_BASE)))  # control characters and the blank count nothing
    lacking = S.QUALITY_CAP * (n - F.length(F.translate(qual, none + chr(0), "")))
    for q in range(S.QUALITY_CAP):
        lacking = lacking + (S.QUALITY_CAP - q) * times(chr(S.QUALITY_BASE + q))
    return F.least((S.QUALITY_CAP * n - lacking).cast("long"), F.lit(S.SCORE_CAP).cast("long"))


def orientation(flag: Column) -> Column:
    """0 for unpaired reads; else bit 0: reverse, bit 1: mate reverse."""
    bit = lambda mask, value: F.when(flag.bitwiseAND(F.lit(mask)) != 0, value).otherwise(0)
    return F.when(flag.bitwiseAND(F.lit(S.FLAG_PAIRED)) != 0, bit(S.FLAG_REVERSE, 1) + bit(S.FLAG_MATE_REVERSE, 2)).otherwise(0).cast("long")


def mate_name(rname: Column, rnext: Column) -> Column:
    """The mate's reference name: '=' is the read's own."""
    return F.when(rnext == S.SAME, rname).otherwise(rnext)


def rewritten(line: Column, flag: Column) -> Column:
    """The line with its FLAG field as the decimal number `flag`."""
    cut = F.split(line, "\t", 3)
    return F.concat_ws("\t", F.get(cut, F.lit(0)), flag.cast("string"), F.get(cut, F.lit(2)))


def wanted_weighted(name: Column) -> Column:
    """Chromosomes kept by weighted regions: chrX, chrY, chr1..chr22, leading zeros allowed."""
    return name.rlike(r"^chr(X|Y|0*([1-9]|1[0-9]|2[0-2]))\z")


def wanted_tiled(name: Column) -> Column:
    """Chromosomes kept by tiles: as above, and a plus sign before the number."""
    return name.rlike(r"^chr(X|Y|\+?0*([1-9]|1[0-9]|2[0-2]))\z")


def line_bytes(line: Column) -> Column:
    """Bytes with the line end."""
    return (F.octet_length(line) + 1).cast("long")


def stem(name: Column) -> Column:
    """What stands before the first '.sam'."""
    return F.substring_index(name, ".sam", 1)


def has_suffix(name: Column, suffix: str) -> Column:
    """Whether a name ends with `suffix`; a shorter name does not."""
    return name.endswith(suffix)


SUFFIXES = {"sort": ".sorted.sam", "markdup": ".markdup.sam", "all": ".sorted.markdup.sam"}


def output_name(name: Column, mode: str) -> Column:
    """Name of the processed file; the stem is cut at 127 bytes, inside a character if need be."""
    return F.concat(F.substring(stem(name).cast("binary"), 1, 127).cast("string"), F.lit(SUFFIXES.get(mode, ".processed.sam")))


def region_path(folder: Column, chrom: Column, start: Column, end: Column, rid: Column | None = None) -> Column:
    tail = [] if rid is None else [rid.cast("string")]
    return F.concat(folder, F.lit("/"), F.concat_ws("_", chrom, start.cast("string"), end.cast("string"), *tail), F.lit(".sam"))
