"""Genomic regions: weighted cuts, equal tiles, assignment of reads."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.operators.order import last_known, numbered, with_coordinates
from strandwise.sources.files import BROADCAST_ROWS, materialize, small


def placed_reads(lines: DataFrame, chroms: DataFrame) -> DataFrame:
    """All lines with rname, pos, the chromosome's length (null where it is not among `chroms`) and `used`: whether the line
    is a read on one of them with a position inside it. Columns of these names are replaced."""
    rows = with_coordinates(lines.drop("rname", "pos", "length", "used"), headers_first=True).drop("valid")
    sizes = chroms.select(F.col("name").alias("rname"), "length")
    return rows.join(small(sizes), "rname", "left").withColumn("used", F.coalesce(F.col("pos").between(1, F.col("length")), F.lit(False)))


def used_reads(lines: DataFrame, chroms: DataFrame) -> DataFrame:
    """Reads on the given chromosomes with a position inside them, with the chromosome's length.

    Columns rname, pos and length of `lines` are replaced."""
    rows = with_coordinates(lines.drop("rname", "pos", "length"), headers_first=True).where("valid").drop("valid")
    sizes = chroms.select(F.col("name").alias("rname"), "length")
    return rows.join(small(sizes), "rname").where(F.col("pos").between(1, F.col("length")))


def bin_weights(reads: DataFrame, width: int = S.BIN_WIDTH) -> DataFrame:
    """(rname, bin, weight): bytes of the lines that start in each bin."""
    last = F.greatest(F.ceil(F.col("length") / width) - 1, F.lit(0))
    place = F.least(F.floor((F.col("pos") - 1) / width), last).cast("long")
    return reads.groupBy("rname", place.alias("bin")).agg(F.sum(X.line_bytes(F.col("line"))).alias("weight"))


def _cuts(bins: np.ndarray, weights: np.ndarray, target: int, carry: bool) -> list[int]:
    """Bins that close a region. Plain: the running weight starts again at 0; carry: it keeps what is over."""
    total = np.cumsum(weights)
    closed, base = [], 0
    while True:
        at = int(np.searchsorted(total, base + target, "left"))
        if at >= len(total):
            return closed
        closed.append(int(bins[at]))
        base = base + target if carry else int(total[at])


def greedy_regions(bins: DataFrame, chroms: DataFrame, target: int = S.TARGET_BYTES, width: int = S.BIN_WIDTH, carry: bool = False) -> DataFrame:
    """(chr, region_start, region_end): per chromosome, a region ends with the bin that brings its bytes to `target`.

    What is left is the last region; a chromosome without reads is one region; one of length 0 has none. `carry` keeps
    the bytes beyond the target, so a heavy bin may close several regions, which can be empty (start > end). A group
    has as many rows as the chromosome has bins in use."""
    sizes = chroms.select(F.col("name").alias("rname"), F.col("length").cast("long").alias("length"))
    rows = sizes.join(bins, "rname", "left").select("rname", "length", "bin", "weight")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        name, length = pdf["rname"].iloc[0], int(pdf["length"].iloc[0])
        used = pdf.dropna(subset=["bin"]).sort_values("bin")
        used = used[used["weight"] > 0]
        start, out = 1, []
        for b in _cuts(used["bin"].to_numpy(np.int64), used["weight"].to_numpy(np.int64), target, carry):
            end = min((b + 1) * width, length)
            out.append((name, start, end))
            start = end + 1
        if start <= length:
            out.append((name, start, length))
        return pd.DataFrame(out, columns=["chr", "region_start", "region_end"])

    return rows.groupBy("rname").applyInPandas(fold, S.REGIONS)


def _running(bins: DataFrame) -> DataFrame:
    """(rname, bin, total): bytes up to each bin in use. Sums inside blocks of 65 536 bins, then over a row a block."""
    rows = numbered(bins.where("weight > 0").select("rname", "bin", "weight"), ["rname", "bin"], "__no").withColumn("__b", F.shiftright("__no", 16))
    blocks = rows.groupBy("rname", "__b").agg(F.sum("weight").alias("__w"))
    before = F.sum("__w").over(Window.partitionBy("rname").orderBy("__b")) - F.col("__w")
    inside = F.sum("weight").over(Window.partitionBy("rname", "__b").orderBy("__no"))
    summed = rows.withColumn("__i", inside).join(blocks.select("rname", "__b", before.alias("__s")), ["rname", "__b"])
    return summed.select("rname", "bin", (F.col("__i") + F.col("__s")).cast("long").alias("total"))


def _first_reaching(sums: DataFrame, asked: DataFrame) -> DataFrame:
    """`asked` (rname, bytes and more) with `next`, the first bin up to which there are so many bytes; others go.

    Sums and questions are put in one order, the largest first; the last sum carried on to a question is its answer."""
    more = [c for c in asked.columns if c not in ("rname", "bytes")]
    rows = asked.select("rname", (-F.col("bytes")).alias("__v"), F.lit(1).alias("__kind"), *more).unionByName(
        sums.select("rname", (-F.col("total")).alias("__v"), F.lit(0).alias("__kind"), F.struct("rname", "bin").alias("__hit")), allowMissingColumns=True
    )
    found = last_known(numbered(rows, ["rname", "__v", "__kind"], "__no"), "__no", "__hit", "__next").where("__kind = 1 and __next.rname = rname")
    return found.select("rname", *more, F.col("__next.bin").alias("next"))


def greedy_by_pointers(bins: DataFrame, chroms: DataFrame, target: int = S.TARGET_BYTES, width: int = S.BIN_WIDTH, carry: bool = False) -> DataFrame:
    """What greedy_regions gives, with no group a chromosome: for assemblies whose chromosomes have very many bins in use.

    Each bin points to the one that closes the next region after it; the bins met from the start are marked by doubling
    the pointers, in as many rounds as the logarithm of the most regions of a chromosome. With `carry` the k-th region
    closes where k times `target` is reached, without pointers."""
    sums = materialize(_running(bins), "sums")
    if carry:
        tops = sums.groupBy("rname").agg(F.max("total").alias("top")).where(F.col("top") >= target)
        asked = tops.select("rname", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("top") / target))).alias("k"))
        cuts = _first_reaching(sums, asked.withColumn("bytes", F.col("k") * target)).select("rname", F.col("next").alias("bin"), "k")
    else:
        starts = sums.select("rname").distinct().select("rname", F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("total"))
        asked = sums.unionByName(starts).select("rname", "bin", (F.col("total") + target).alias("bytes"))
        hop = materialize(_first_reaching(sums, asked), "pointers")
        marked = materialize(starts.select("rname", "bin"), "marked")
        while True:
            met = materialize(marked.join(hop, ["rname", "bin"]).select("rname", F.col("next").alias("bin")), "met")
            if met.isEmpty():
                break
            marked = materialize(marked.unionByName(met).distinct(), "marked")
            hop = materialize(hop.join(hop.select("rname", F.col("bin").alias("next"), F.col("next").alias("later")), ["rname", "next"]).select("rname", "bin", F.col("later").alias("next")), "pointers")
        cuts = marked.where("bin >= 0").withColumn("k", F.lit(0).cast("long"))
    sizes = chroms.select(F.col("name").alias("rname"), F.col("length").cast("long").alias("length"))
    ends = cuts.join(small(sizes), "rname").select("rname", "bin", "k", F.least((F.col("bin") + 1) * width, F.col("length")).alias("region_end"))
    ends = materialize(ends, "ends")  # a row a region
    closed = ends.select(F.col("rname").alias("chr"), (F.coalesce(F.lag("region_end").over(Window.partitionBy("rname").orderBy("bin", "k")), F.lit(0)) + 1).alias("region_start"), "region_end")
    last = ends.groupBy("rname").agg(F.max("region_end").alias("at"))
    rest = sizes.join(last, "rname", "left").select(F.col("rname").alias("chr"), (F.coalesce("at", F.lit(0)) + 1).cast("long").alias("region_start"), F.col("length").alias("region_end"))
    return closed.unionByName(rest.where("region_start <= region_end"))


def overlaps(regions: DataFrame) -> DataFrame:
    """Regions that begin before the one before them on the chromosome ends."""
    before = F.max("region_end").over(Window.partitionBy("chr").orderBy("region_start", "region_end").rowsBetween(Window.unboundedPreceding, -1))
    return regions.withColumn("before", before).where("region_start <= before").drop("before")


REGION = ["chr", "region_start", "region_end"]


def sweep(points: DataFrame, regions: DataFrame, how: str = "inner", within: tuple[str, str] = ("region_start", "region_end")) -> DataFrame:
    """What `assign` gives, for lists too long to broadcast: points and regions are put in one order of (chromosome,
    position), a region before the points at its start, and the last region is carried on to the points behind it.

    Rows are numbered by a range exchange and carried over blocks of numbers, so neither a pile of points at one position
    nor a region that holds most points is in one task."""
    low, high = within
    point = F.struct(*(F.col(c) for c in points.columns))
    region = F.struct(*(F.col(c) for c in REGION), F.col(high).alias("__high"))
    rows = points.select(F.col("rname").alias("__chr"), F.col("pos").alias("__pos"), F.lit(1).alias("__kind"), point.alias("__point")).unionByName(
        regions.select(F.col("chr").alias("__chr"), F.col(low).alias("__pos"), F.lit(0).alias("__kind"), region.alias("__region")), allowMissingColumns=True
    )
    rows = last_known(numbered(rows, ["__chr", "__pos", "__kind"], "__no"), "__no", "__region", "__hit").where("__kind = 1")
    held = (F.col("__hit.chr") == F.col("__chr")) & (F.col("__pos") <= F.col("__hit.__high"))
    found = rows.withColumn("__hit", F.when(held, F.col("__hit")))
    found = found if how == "left" else found.where("__hit is not null")
    return found.select(*(F.col("__point")[c].alias(c) for c in points.columns if c not in REGION), *(F.col("__hit")[c].alias(c) for c in REGION))


def assign(points: DataFrame, regions: DataFrame, how: str = "inner", within: tuple[str, str] = ("region_start", "region_end"), most: int = BROADCAST_ROWS) -> DataFrame:
    """Join points (rname, pos) with the region (chr, region_start, region_end) that holds them.

    Regions are spread over tiles about as wide as the mean region, so that a point meets a few regions however many
    there are: the join is an equality on (chromosome, tile) with a range check. The spans `within` (the regions' own
    columns, else further ones) must not overlap. Columns of `points` that are named like a region's are replaced. A list
    whose tiles are more than `most` is swept instead."""
    low, high = within
    regions = materialize(regions.select(*REGION, F.col(low).alias("__low"), F.col(high).alias("__high")), "regions")
    span = regions.agg(F.max("__high"), F.count(F.lit(1)), F.count_distinct("chr")).first()
    tiled = 2 * span[1] + span[2]  # a region meets two tiles on average
    if tiled > most:
        return sweep(points, regions, how, ("__low", "__high"))
    width = max(1, math.ceil((span[0] or 1) * max(span[2], 1) / max(span[1], 1)))
    tiles = regions.withColumn("__tile", F.explode(F.sequence(F.floor(F.col("__low") / width), F.floor(F.col("__high") / width))))
    left = points.drop(*REGION).withColumn("__point", F.floor(F.col("pos") / width))
    match = (F.col("rname") == F.col("chr")) & (F.col("__point") == F.col("__tile")) & F.col("pos").between(F.col("__low"), F.col("__high"))
    return left.join(F.broadcast(tiles), match, how).drop("__tile", "__point", "__low", "__high")


def probed(regions: DataFrame, most: int = S.MAX_LISTED_REGIONS) -> DataFrame:
    """(chr, region_start, region_end, low, high): disjoint spans in which a binary search over the chromosome's regions,
    sorted by (start, end), hits a region; as many as regions at most. Overlapping regions win by the order of the search.

    The list is short: more than `most` regions raise."""
    rows = regions.select(*REGION).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} regions")
    lists: dict[str, list[tuple[int, int]]] = {}
    for name, start, end in sorted(map(tuple, rows)):
        lists.setdefault(name, []).append((start, end))
    found = []
    for name, spans in lists.items():
        open_ = [(0, len(spans), spans[0][0], max(e for _, e in spans))]  # (from, to) of the list, and the positions that get there
        while open_:
            first, last, low, high = open_.pop()
            if first < last and low <= high:
                middle = (first + last - 1) // 2
                start, end = spans[middle]
                if max(low, start) <= min(high, end):
                    found.append((name, start, end, max(low, start), min(high, end)))
                open_ += [(first, middle, low, min(high, start - 1)), (middle + 1, last, max(low, end + 1), high)]
    return regions.sparkSession.createDataFrame(found, "chr string, region_start long, region_end long, low long, high long")


def split_by_list(lines: DataFrame, regions: DataFrame, policy: str = S.STRICT) -> DataFrame:
    """Mapped reads (position above 0) with the listed region that holds them; others are dropped.

    strict: overlapping lists raise; compat: the hit of a binary search."""
    reads = with_coordinates(lines.drop("rname", "pos"), headers_first=True).where("valid and pos > 0").drop("valid")
    if policy == S.COMPAT:
        return assign(reads, probed(regions), within=("low", "high"))
    if not overlaps(regions).isEmpty():
        raise ValueError("regions overlap")
    return assign(reads, regions)


def fates(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """All lines with rname, pos, the listed region that holds them and their `fate`: header, blank, malformed (no position
    parses), unplaced (no reference name, or a position below 1), other_chr (a name without regions), gap (between the
    regions of its chromosome) or placed. One pass over the lines. Overlapping regions raise."""
    if not overlaps(regions).isEmpty():
        raise ValueError("regions overlap")
    rows = with_coordinates(lines.drop("rname", "pos", "valid", "fate", "__known"), headers_first=True)
    known = regions.select(F.col("chr").alias("rname")).distinct().withColumn("__known", F.lit(True))
    rows = assign(rows.join(small(known), "rname", "left"), regions, "left")
    fate = (
        F.when(X.is_header(F.col("line")), "header").when(X.without_cr(F.col("line")) == "", "blank").when(~F.col("valid"), "malformed")
        .when((F.col("rname") == S.UNSET) | (F.col("pos") < 1), "unplaced").when(F.col("__known").isNull(), "other_chr").when(F.col("region_start").isNull(), "gap").otherwise("placed")
    )
    return rows.withColumn("fate", fate).drop("valid", "__known")


def split_stats(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """(total, assigned): lines that are no header and not blank, and those that a listed region holds; one scan."""
    return fates(lines, regions).agg(F.count_if(~F.col("fate").isin("header", "blank")).alias("total"), F.count_if(F.col("fate") == "placed").alias("assigned"))


def offsets(chroms: DataFrame) -> DataFrame:
    """(name, length, ord, offset): bases before each chromosome, in the order of `ord`; a row a chromosome."""
    before = F.sum("length").over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    return chroms.select("name", "length", "ord", F.coalesce(before, F.lit(0)).cast("long").alias("offset"))


def tile_width(chroms: DataFrame, tiles: int = S.TILES) -> tuple[int, int]:
    """(bases in all, bases a tile, rounded up)."""
    total = int(chroms.agg(F.sum("length")).first()[0] or 0)
    if not total:
        raise ValueError("no chromosome has any length")
    return total, -(-total // tiles)


def static_regions(chroms: DataFrame, tiles: int = S.TILES) -> DataFrame:
    """(rid, chr, region_start, region_end) of equal tiles over all chromosomes in a row.

    A tile that crosses a chromosome's end is named by its first chromosome, to that one's end; tiles beyond the end
    stand for the last base. Each chromosome gives the numbers of the tiles that begin on it, so nothing is joined."""
    total, width = tile_width(chroms, tiles)
    start, end = F.col("offset"), F.col("offset") + F.col("length")
    last = F.when(end == total, tiles - 1).otherwise(F.least(F.floor((end - 1) / width), F.lit(tiles - 1))).cast("long")
    low = F.ceil(start / width).cast("long")
    rids = F.when(low <= last, F.sequence(low, last))  # else no tile begins on the chromosome
    spread = offsets(chroms).where("length > 0").withColumn("rid", F.explode(rids))
    first = F.least(F.col("rid") * width, F.lit(total - 1))
    to = F.least((F.col("rid") + 1) * width, F.lit(total)) - start
    return spread.select("rid", F.col("name").alias("chr"), (first - start + 1).alias("region_start"), F.least(to, F.col("length")).alias("region_end"))


def loose_reads(lines: DataFrame) -> DataFrame:
    """Lines that are no header with rname and pos by the loose parse; fewer than four fields give nulls."""
    f = F.split("line", "\t", 5)
    rows = lines.where(~X.is_header(F.col("line")) & (X.without_cr(F.col("line")) != ""))
    full = F.size(f) >= 4
    return rows.withColumn("rname", F.when(full, F.get(f, F.lit(2)))).withColumn("pos", F.when(full, X.loose_integer(F.get(f, F.lit(3)))))


def static_assign(lines: DataFrame, chroms: DataFrame, tiles: int = S.TILES) -> DataFrame:
    """Add g (global coordinate from 0) and rid to reads, in place of columns of these names; null where unmapped or on another chromosome.

    A position beyond a chromosome's end runs into the next one's tile."""
    _, width = tile_width(chroms, tiles)
    at = offsets(chroms).select(F.col("name").alias("rname"), "offset")
    reads = loose_reads(lines.drop("rname", "pos", "g", "rid", "offset")).join(small(at), "rname", "left")
    mapped = (F.col("rname") != S.UNSET) & (F.col("pos") > 0)
    g = F.when(mapped, F.col("offset") + F.col("pos") - 1)
    return reads.withColumn("g", g).withColumn("rid", F.when(F.col("g").isNotNull(), F.least(F.floor(F.col("g") / width), F.lit(tiles - 1))).cast("long")).drop("offset")
