"""Schemas, flag bits and constants of alignment text."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the alignment text format.
FLAG_PAIRED = 1
FLAG_UNMAPPED = 4
FLAG_REVERSE = 16
FLAG_MATE_REVERSE = 32
FLAG_SECONDARY = 256
FLAG_DUPLICATE = 1024
FLAG_SUPPLEMENTARY = 2048
NOT_PRIMARY = FLAG_UNMAPPED | FLAG_SECONDARY | FLAG_SUPPLEMENTARY  # 2308
UNSET = "*"
SAME = "="
MIN_FIELDS = 11

BIN_WIDTH = 1000
TARGET_BYTES = 64 << 20
TILES = 6144
MAX_LISTED_REGIONS = 2999
MAX_NAMES = 256
MAX_MESSAGES = 10
QUALITY_BASE, QUALITY_CAP, SCORE_CAP = 33, 15, 65535

COMPAT, STRICT = "compat", "strict"

LINES = T.StructType([T.StructField("file", T.StringType()), T.StructField("line_no", T.LongType()), T.StructField("line", T.StringType())])
REGIONS = T.StructType([T.StructField("chr", T.StringType()), T.StructField("region_start", T.LongType()), T.StructField("region_end", T.LongType())])
CHROMS = T.StructType([T.StructField("name", T.StringType()), T.StructField("length", T.LongType()), T.StructField("ord", T.LongType())])
