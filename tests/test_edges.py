"""Procedural emulations and hand-written edge cases."""

import os
import random
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as C
from strandwise.operators import checks, duplicates, order, regions
from strandwise.plans import modes, report
from strandwise.sources import files, named, text
from strandwise.streaming import files as streams
from strandwise.streaming.files import running_counts, stream_lines


def lines_of(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no long, line string")


def rec(q, flag, rname, pos, rnext="*", pnext=0, qual="II"):
    return f"{q}\t{flag}\t{rname}\t{pos}\t60\t1M\t{rnext}\t{pnext}\t0\tA\t{qual}"


def atoi(s):
    s, n = s.lstrip(" \t\n\v\f\r"), ""
    for k, ch in enumerate(s):
        if ch.isdigit() or (k == 0 and ch in "+-"):
            n += ch
        else:
            break
    return int(n) if n.strip("+-") else 0


def emulate(rows, policy):
    """line_no -> is_dup, by walking the groups in order."""
    groups = {}
    for k, line in enumerate(rows):
        line = line.rstrip("\r")
        if not line or line.startswith("@"):
            continue
        f = line.split("\t")
        if len(f) - (f[-1] == "") < 11:
            continue
        flag = atoi(f[1]) & 0xFFFF
        score = min(65535, sum(max(0, min(15, ord(c) - 33)) for c in f[10]))
        mate = f[2] if f[6] == "=" else f[6]
        ori = ((flag & 16 > 0) + 2 * (flag & 32 > 0)) if flag & 1 else 0
        groups.setdefault((f[2], atoi(f[3]), mate, atoi(f[7]), ori), []).append((k, flag, score))
    dup = {}
    for members in groups.values():
        started, best = False, None
        for k, flag, score in members:
            dup[k] = False
            excluded = flag & 2308
            if policy == S.STRICT and excluded:
                continue
            if not started:
                if excluded:
                    continue
                started, best = True, (k, score)
                continue
            if score > best[1]:
                dup[best[0]], best = True, (k, score)
            else:
                dup[k] = True
    return dup


def random_lines(seed, n=400):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        x = rng.random()
        if x < 0.05:
            out.append(rng.choice(["", "\r", "@CO\tx\ty\t12", "short\t0\tchr1", "a\tb\tc\td\te\tf\tg\th\ti\tj\t"]))
        else:
            flag = rng.choice(["0", "16", "1", "17", "33", "49", "4", "256", "2048", "1024", "0099", "abc", "70000"])
            out.append(rec(f"q{k}", flag, rng.choice(["chr1", "chr2", "chr10", "*"]), rng.choice(["1", "2", "+3", "x", "-1"]), rng.choice(["=", "*", "chr2"]), rng.choice(["0", "5"]), rng.choice(["II", "*", "5", "!!!", "IIII"])) + rng.choice(["", "\r", "\tNM:i:0"]))
    return out


@pytest.mark.parametrize("policy", [S.COMPAT, S.STRICT])
@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates_follow_the_walk(spark, seed, policy):
    rows = random_lines(seed)
    marked = modes.mark_lines(lines_of(spark, rows), policy).select("line_no", "is_dup", "flag_out", "line_out").collect()
    want = emulate(rows, policy)
    assert {r.line_no: r.is_dup for r in marked} == want
    for r in marked:
        f = rows[r.line_no].rstrip("\r").split("\t")
        assert r.flag_out == (atoi(f[1]) & 0xFFFF) | (1024 if r.is_dup else 0)
        assert r.line_out == "\t".join([f[0], str(r.flag_out), *f[2:]])


def test_duplicates_do_not_depend_on_partitions(spark):
    lines = lines_of(spark, random_lines(3))
    one = modes.mark_lines(lines.coalesce(1)).select("line_no", "is_dup").collect()
    many = modes.mark_lines(lines.repartition(7, F.xxhash64("line_no"))).select("line_no", "is_dup").collect()
    assert sorted(one) == sorted(many)


def test_sort_is_a_permutation_in_order(spark):
    rows = random_lines(4)
    out = [r.line_no for r in order.coordinate_sort(lines_of(spark, rows)).collect()]

    def key(k):
        f = rows[k].split("\t")
        digits = f[3][1:] if len(f) > 3 and f[3].startswith("-") else (f[3] if len(f) > 3 else "")
        ok = digits.isdigit()
        return (1, f[2], int(f[3]), k) if ok else (0, "", 0, k)

    assert out == sorted(range(len(rows)), key=key)


def test_header_with_integer_field_sorts_as_record_unless_strict(spark):
    rows = ["@HD", "@CO\ta\tchr1\t5", rec("a", 0, "chr1", 4), rec("b", 0, "chr1", 9)]
    compat = [r.line_no for r in order.coordinate_sort(lines_of(spark, rows)).collect()]
    strict = [r.line_no for r in order.coordinate_sort(lines_of(spark, rows), S.STRICT).collect()]
    assert compat == [0, 2, 1, 3] and strict == [0, 1, 2, 3]
    head = [r.line_no for r in modes.mark_file(lines_of(spark, rows), presorted=True).where("section = 0").collect()]
    assert len(head) == 1  # the moved header line is no longer in the block
    assert duplicates.header_block(lines_of(spark, [""] + rows)).count() == 0


def test_scores_orientation_and_names(spark):
    values = spark.createDataFrame([("*",), ("I" * 5000,), ("",), ("!J",)], "q string").select(C.quality_score(F.col("q"))).collect()
    assert [v[0] for v in values] == [9, 65535, 0, 15]
    flags = spark.createDataFrame([(0,), (16,), (1,), (17,), (33,), (49,)], "f long").select(C.orientation(F.col("f"))).collect()
    assert [v[0] for v in flags] == [0, 0, 0, 1, 2, 3]
    names = spark.createDataFrame([("a.sam",), ("x" * 200 + ".sam",), ("b.sam.sorted.sam",)], "n string").select(C.output_name(F.col("n"), "all")).collect()
    assert [v[0] for v in names] == ["a.sorted.markdup.sam", "x" * 127 + ".sorted.markdup.sam", "b.sorted.markdup.sam"]


def test_dictionary_counts_malformed_lines_and_caps(spark):
    rows = [rec("a", 0, "chr2", 1, "chr9", 1), "m\t0\tchr7\t1", rec("b", 0, "chr1", 1, "=", 1), rec("c", 0, "*", 0)]
    parsed = text.parse(lines_of(spark, rows))
    got = {r.name: r.tid for r in order.reference_dictionary(parsed, ["line_no"]).collect()}
    assert got == {"chr2": 0, "chr9": 1, "chr7": 2, "chr1": 3}
    capped = {r.name: r.tid for r in order.reference_dictionary(parsed, ["line_no"], 2).collect()}
    assert capped == {"chr2": 0, "chr9": 1, "chr7": -1, "chr1": -1}
    many = [rec(f"r{k}", 0, f"n{k:04d}", 5) for k in range(S.MAX_NAMES + 2)]
    marked = modes.mark_lines(lines_of(spark, many), most_names=S.MAX_NAMES)
    assert marked.where("is_dup").count() == 1  # the two names beyond the cap count as '*'
    assert modes.mark_lines(lines_of(spark, many)).where("is_dup").count() == 0


def greedy(bins, length, target, width=1000):
    acc, start, out = 0, 1, []
    for b in range(-(-length // width)):
        w = bins.get(b, 0)
        if acc + w >= target:
            end = min((b + 1) * width, length)
            out.append((start, end))
            start, acc = end + 1, 0
        else:
            acc += w
    if start <= length:
        out.append((start, length))
    return out


def test_greedy_cut_follows_the_walk(spark):
    rng = random.Random(5)
    chroms, bins = [], []
    for k, length in enumerate([0, 1, 999, 1000, 1001, 40_000, 77_777, 5_000]):
        chroms.append((f"c{k}", length, k))
        used = {b: rng.choice([1, 5, 30, 500]) for b in range(-(-length // 1000)) if rng.random() < 0.6 and k != 7}
        bins += [(f"c{k}", b, w) for b, w in used.items()]
    table = spark.createDataFrame(chroms, "name string, length long, ord long")
    got = regions.greedy_regions(spark.createDataFrame(bins, "rname string, bin long, weight long"), table, 100).collect()
    for name, length, _ in chroms:
        mine = sorted((r.region_start, r.region_end) for r in got if r.chr == name)
        assert mine == greedy({b: w for n, b, w in bins if n == name}, length, 100)
    for carry in (False, True):
        plain, pointers = (sorted(map(tuple, f(spark.createDataFrame(bins, "rname string, bin long, weight long"), table, 100, carry=carry).collect())) for f in (regions.greedy_regions, regions.greedy_by_pointers))
        assert pointers == plain
    assert len(regions.greedy_by_pointers(spark.createDataFrame([], "rname string, bin long, weight long"), table).collect()) == 7
    heavy = spark.createDataFrame([("c5", 3, 1000)], "rname string, bin long, weight long")
    carried = regions.greedy_regions(heavy, table.where("name = 'c5'"), 400, carry=True)
    assert sorted((r.region_start, r.region_end) for r in carried.collect()) == [(1, 4000), (4001, 4000), (4001, 40000)]


def test_region_lists(spark):
    good = text.parse_region_list(lines_of(spark, ["# x", "", " chr1\t1  10 extra", "chr2 5 5"]))
    assert [(r.chr, r.region_start, r.region_end) for r in good.orderBy("line_no").collect()] == [("chr1", 1, 10), ("chr2", 5, 5)]
    for bad in ("chr1 1", "chr1 0 5", "chr1 6 5", "chr1 1x 5"):
        with pytest.raises(ValueError):
            text.parse_region_list(lines_of(spark, ["chr1 1 2", bad]))
    with pytest.raises(ValueError):
        text.parse_region_list(lines_of(spark, [f"c {k + 1} {k + 1}" for k in range(3000)]))


def test_overlapping_list_raises_or_probes(spark):
    reads = lines_of(spark, [rec("a", 0, "chr1", 7), rec("b", 0, "chr1", 25), rec("c", 0, "chr1", 99)])
    listed = spark.createDataFrame([("chr1", 1, 30), ("chr1", 5, 10), ("chr1", 20, 40)], S.REGIONS)
    with pytest.raises(ValueError):
        regions.split_by_list(reads, listed)
    got = {r.line_no: (r.region_start, r.region_end) for r in regions.split_by_list(reads, listed, S.COMPAT).collect()}
    assert got == {0: (5, 10), 1: (20, 40)}


def test_tiles_spill_over_the_end(spark):
    chroms = spark.createDataFrame([("chr1", 10, 0), ("chr2", 10, 1)], "name string, length long, ord long")
    tiles = [tuple(r) for r in regions.static_regions(chroms, 8).orderBy("rid").collect()]
    assert tiles[:4] == [(0, "chr1", 1, 3), (1, "chr1", 4, 6), (2, "chr1", 7, 9), (3, "chr1", 10, 10)] and tiles[7] == (7, "chr2", 10, 10)
    rows = [rec("a", 0, "chr1", 12), rec("b", 0, "chr2", "500"), rec("c", 0, "*", 0), "x\ty"]
    got = {r.line_no: (r.g, r.rid) for r in regions.static_assign(lines_of(spark, rows), chroms, 8).collect()}
    assert got == {0: (11, 3), 1: (509, 7), 2: (None, None), 3: (None, None)}


def test_fasta_lengths(spark):
    rows = ["ACGT", ">chr1 first", "AC GT", "", "ac\r", ">other x", "AAAA", ">chr1 again", "A\tC"]
    plain = {r.name: r.length for r in text.fasta_lengths(lines_of(spark, rows)).collect()}
    inner = {r.name: r.length for r in text.fasta_lengths(lines_of(spark, rows), C.wanted_tiled(F.col("name")), blanks=True).collect()}
    assert plain == {"chr1": 8, "other": 4} and inner == {"chr1": 10}


def test_files_are_numbered_split_and_checked(spark, tmp_path):
    rows = ["@HD\tVN:1", rec("a", 0, "chr1", 5), "", rec("b", 0, "chr1", 15) + "\r", rec("c", 0, "chr2", 5)]
    for name in ("one.sam", "two.sam"):
        (tmp_path / name).write_bytes("\n".join(rows).encode())
    lines = text.read_lines(spark, str(tmp_path))
    for name in ("one.sam", "two.sam"):
        got = lines.where(F.col("file").endswith(name)).orderBy("line_no").collect()
        assert [r.line_no for r in got] == [0, 1, 2, 3, 4] and [r.line for r in got] == rows
    assert text.read_lines(spark, str(tmp_path), max_file_bytes=1).count() == 0
    listed = spark.createDataFrame([("chr1", 1, 10), ("chr1", 11, 20), ("chr2", 1, 10)], S.REGIONS)
    one = lines.where(F.col("file").endswith("one.sam")).drop("file")
    head = one.where(C.is_header(F.col("line")))
    out = str(tmp_path / "regions")
    files.write_region_files(regions.split_by_list(one, listed), head, out, ["chr", "region_start", "region_end"], layout="folders")
    back = spark.read.option("lineSep", "\n").text(out)
    assert back.groupBy("region").count().orderBy("region").collect() == [("chr1_11_20", 2), ("chr1_1_10", 2), ("chr2_1_10", 2)]
    named = back.select(F.concat("region", F.lit(".sam")).alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
    assert checks.region_check(named).where("not ok").isEmpty()
    wrong = named.withColumn("file", F.lit("chr1_1_10.sam"))
    got = checks.region_check(wrong).first()
    assert (got.total, got.checked, got.bad_chr, got.bad_range, got.ok) == (3, 3, 1, 1, False)


def test_blocks_of_a_split_file_are_numbered(spark, tmp_path):
    rows = [f"line {k}" for k in range(500)]
    (tmp_path / "a.sam").write_text("\n".join(rows) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = text.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in got] == rows and [r.line_no for r in got] == list(range(500))


def test_stream_of_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.sam").write_text("@HD\n" + rec("a", 0, "chr1", k + 1) + "\n")
    counts = running_counts(stream_lines(spark, str(tmp_path), 1)).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    counts.awaitTermination(60)
    assert [(r.rname, r.n) for r in spark.table("counts").collect()] == [("chr1", 3)]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "line_no long, line string")
    assert modes.mark_lines(empty).count() == 0 and order.coordinate_sort(empty).count() == 0


@pytest.mark.parametrize("policy", [S.COMPAT, S.STRICT])
def test_keys_of_very_many_records_are_not_dealt_by_key(spark, policy):
    rows = random_lines(7, 300) + [rec(f"u{k}", 4, "*", 0, qual="I" * (k % 5)) for k in range(300)] + [rec(f"h{k}", 256 if k % 3 else 0, "chr5", 9, qual="I" * (k % 7)) for k in range(200)]
    records = duplicates.records(text.parse(text.scan_records(lines_of(spark, rows))))
    marked = duplicates.mark_duplicates(records, policy, hot_rows=50)
    assert {r.line_no: r.is_dup for r in marked.collect()} == emulate(rows, policy)
    assert duplicates.mark_duplicates(records.where("false"), policy).count() == 0


def probe(spans, pos):
    low, high = 0, len(spans) - 1
    while low <= high:
        middle = (low + high) // 2
        if pos < spans[middle][0]:
            high = middle - 1
        elif pos > spans[middle][1]:
            low = middle + 1
        else:
            return spans[middle]
    return None


@pytest.mark.parametrize("seed", range(3))
def test_probed_spans_are_what_the_search_hits(spark, seed):
    rng = random.Random(seed)
    spans = sorted((a, a + rng.randrange(1, 40)) for a in (rng.randrange(1, 100) for _ in range(rng.randrange(1, 15))))
    listed = spark.createDataFrame([("chr1", a, b) for a, b in spans], S.REGIONS)
    rows = [rec("a", 0, "chr1", k) for k in range(1, 150)] + [rec("b", 0, "chr2", 5)]
    got = {r.line_no + 1: (r.region_start, r.region_end) for r in regions.split_by_list(lines_of(spark, rows), listed, S.COMPAT).collect()}
    assert got == {k: hit for k in range(1, 150) if (hit := probe(spans, k))}
    with pytest.raises(ValueError):
        regions.probed(listed, most=0)


def test_columns_with_the_engine_s_names(spark):
    names = ("rname", "pos", "length", "chr", "region_start", "tile", "sub", "f", "valid", "g", "rid", "offset")
    lines = lines_of(spark, [rec("a", 0, "chr1", 7), rec("b", 0, "chr1", 17)]).withColumns({c: F.lit("own") for c in names})
    chroms = spark.createDataFrame([("chr1", 20, 0)], "name string, length long, ord long")
    listed = spark.createDataFrame([("chr1", 1, 10), ("chr1", 11, 20)], S.REGIONS)
    used = regions.used_reads(lines, chroms)
    assert {(r.line_no, r.pos, r.length, r.tile) for r in used.collect()} == {(0, 7, 20, "own"), (1, 17, 20, "own")}
    assert {(r.line_no, r.region_start, r.chr, r.tile) for r in regions.split_by_list(lines, listed).collect()} == {(0, 1, "chr1", "own"), (1, 11, "chr1", "own")}
    assert {(r.line_no, r.g, r.sub) for r in regions.static_assign(lines, chroms, 4).collect()} == {(0, 6, "own"), (1, 16, "own")}


def test_lines_are_not_shuffled_by_reading(spark, tmp_path):
    (tmp_path / "a.sam").write_text("x\ny\n")
    plan = text.read_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_outputs_of_files(spark, tmp_path):
    lines = lines_of(spark, ["@HD", rec("a", 0, "chr2", 5), rec("b", 0, "chr1", 5), rec("c", 0, "chr1", 5, qual="!!")])
    one, two = (lines.withColumn("file", F.lit(f"in/{n}")) for n in ("x.sam", "y.sam.bak"))
    for mode, name, flag in (("sort", "x.sorted.sam", "0"), ("all", "x.sorted.markdup.sam", "1024"), ("markdup", "x.markdup.sam", "1024")):
        out = str(tmp_path / mode)
        got = modes.process_files(one.unionByName(two), out, mode).collect()
        assert {(r.file, r.n_lines) for r in got} == {("in/x.sam", 4), ("in/y.sam.bak", 4)}
        back = [r.line for r in text.read_lines(spark, f"{out}/{name}").orderBy("line_no").collect()]
        assert sorted(n for n in os.listdir(out) if n[0] not in "._") == sorted([name, name.replace("x", "y", 1)])
        assert [x.split("\t")[0] for x in back] == (["@HD", "a", "b", "c"] if mode == "markdup" else ["@HD", "b", "c", "a"])
        assert [x.split("\t")[1] for x in back if x[0] == "c"] == [flag]
    with pytest.raises(ValueError, match="x.sorted.sam"):
        modes.process_files(one.unionByName(lines.withColumn("file", F.lit("other/x.sam"))), str(tmp_path / "no"), "sort")
    long = spark.createDataFrame([("é" * 100 + ".sam",)], "n string").select(C.output_name(F.col("n"), "sort").cast("binary").alias("n")).first().n
    assert len(long) == 127 + len(".sorted.sam")


def test_tiles_and_region_folders(spark, tmp_path):
    chroms = spark.createDataFrame([("chr1", 10, 0), ("chr2", 10, 1)], "name string, length long, ord long")
    rows = [rec("a", 0, "chr1", 2), rec("b", 0, "chrM", 3), rec("c", 0, "chr2", 9)]
    modes.write_tiles(lines_of(spark, rows), chroms, str(tmp_path / "t"), 4)
    written = {p.name: p.read_text() for p in (tmp_path / "t/files").iterdir()}
    assert written == {"chr1_1_5_0.sam": rows[0] + "\n", "chr1_6_10_1.sam": "", "chr2_1_5_2.sam": "", "chr2_6_10_3.sam": rows[2] + "\n"}
    assert [r.line for r in text.read_lines(spark, str(tmp_path / "t/list")).orderBy("line_no").collect()] == ["chr1 1 5", "chr1 6 10", "chr2 1 5", "chr2 6 10"]
    head = spark.createDataFrame([(0, "@HD")], "line_no long, line string")
    listed = spark.createDataFrame([("chr1", 1, 10), ("chr2", 1, 10), ("chr3", 1, 10)], S.REGIONS)
    files.write_region_files(regions.split_by_list(lines_of(spark, rows), listed), head, str(tmp_path / "r"), regions.REGION, every=listed, layout="folders")
    counts = {r.region: r["count"] for r in spark.read.text(str(tmp_path / "r")).groupBy("region").count().collect()}
    assert counts == {"chr1_1_10": 2, "chr2_1_10": 2, "chr3_1_10": 1}
    for name, body in (("chr1_1_10.sam.bak", "@HD\n"), ("chr1_1_10_2.sam", "@HD\n" + rows[0] + "\n"), ("notes.txt", "x\n")):
        (tmp_path / name).write_text(body)
    got = {r.file: (r.total, r.ok) for r in checks.region_check(text.read_region_files(spark, str(tmp_path))).collect()}
    assert got == {"chr1_1_10.sam.bak": (0, True), "chr1_1_10_2.sam": (1, True)}
    assert checks.region_check(text.read_region_files(spark, str(tmp_path)).where("false")).count() == 0


def test_names_of_fasta_may_follow_blanks(spark):
    got = {r.name: r.length for r in text.fasta_lengths(lines_of(spark, ["> chr1 x", "AC", ">\tchr2\ty", "A", ">"])).collect()}
    assert got == {"chr1": 2, "chr2": 1, "": 0}
    assert text.fasta_lengths(lines_of(spark, [])).count() == 0


def test_typed_fields(spark):
    rows = [rec("q", "x", "chr1", 5) + "\tNM:i:0\tXX:Z:a", "@HD"]
    got = text.typed(lines_of(spark, rows)).orderBy("line_no").collect()
    assert (got[0].flag, got[0].pos, got[0].tags, got[0].kind, got[1].tags, got[1].kind) == (None, 5, ["NM:i:0", "XX:Z:a"], "record", [], "header")


def test_typed_numbers_beyond_their_type_are_null(spark):
    row = text.typed(lines_of(spark, [rec("q", 99999999999, "chr1", 5)])).first()
    assert row.flag is None and row.pos == 5


@pytest.mark.parametrize("tiles", [1, 3, 8, 50])
def test_tiles_are_those_of_a_walk_over_all_bases(spark, tiles):
    sizes = [("chr1", 7), ("chr2", 0), ("chr3", 1), ("chr4", 13), ("chr5", 0)]
    bases = [(name, k + 1) for name, n in sizes for k in range(n)]
    ends, width = dict(sizes), -(-len(bases) // tiles)
    want = []
    for rid in range(tiles):
        name, start = bases[min(rid * width, len(bases) - 1)]
        last = bases[min((rid + 1) * width, len(bases)) - 1]
        want.append((rid, name, start, last[1] if last[0] == name else ends[name]))
    chroms = spark.createDataFrame([(n, length, k) for k, (n, length) in enumerate(sizes)], S.CHROMS)
    found = regions.static_regions(chroms, tiles)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == want


def test_lines_and_numbers_do_not_depend_on_later_splits(spark, tmp_path):
    rows = [f"line {k}" for k in range(20_000)]
    (tmp_path / "a.sam").write_text("\n".join(rows) + "\n")
    (tmp_path / "b.sam").write_text("\n".join(rows[:77]))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "50000")
        first, planned = text.read_lines(spark, str(tmp_path)), named.read_ranges(spark, str(tmp_path), range_bytes=30_000)
        for size in ("7000", "90000", before):
            spark.conf.set(setting, size)
            for lines in (first, planned):
                got = lines.where(F.col("file").endswith("a.sam")).orderBy("line_no").collect()
                assert [r.line for r in got] == rows and [r.line_no for r in got] == list(range(len(rows)))
                assert lines.count() == len(rows) + 77
    finally:
        spark.conf.set(setting, before)
    (tmp_path / "b.sam").write_text("longer than it was planned\n" * 99)
    with pytest.raises(Exception, match="has changed"):
        planned.count()


@pytest.mark.parametrize("range_bytes", [40, 300, 1 << 20])
def test_ranges_cut_lines_anywhere(spark, tmp_path, range_bytes):
    rng, want = random.Random(3), {}
    for k in range(5):
        rows = ["".join(rng.choice("aé\t\r x") for _ in range(rng.choice([0, 1, 5, 40, 300]))) for _ in range([0, 1, 2, 60, 30][k])]
        body = "\n".join(rows) + ("\n" if k % 2 else "")
        (tmp_path / f"f{k}.sam").write_bytes(body.encode())
        want[f"f{k}.sam"] = body.split("\n")[: -1 if body.endswith("\n") or not body else None]
    (tmp_path / "_hidden.sam").write_text("x\n")
    (tmp_path / "notes.txt").write_text("x\n")
    got = named.read_ranges(spark, str(tmp_path), ".sam", range_bytes).collect()
    for name, rows in want.items():
        assert sorted((r.line_no, r.line) for r in got if r.file.endswith(name)) == list(enumerate(rows))
    assert len(got) == sum(map(len, want.values()))
    assert named.read_ranges(spark, str(tmp_path), ".none").count() == 0
    with pytest.raises(FileNotFoundError):
        named.read_ranges(spark, str(tmp_path / "nowhere"))


def test_named_files_of_hot_and_empty_names(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot.sam").otherwise(F.concat(F.lit("n"), F.col("id") % 7, F.lit(".sam"))).alias("to"), (-F.col("id")).alias("at"), F.concat(F.lit("é "), "id").alias("line"))
    every = spark.createDataFrame([("empty.sam",), ("hot.sam",)], "to string")
    out, want = tmp_path / "out", {"empty.sam": []}
    for r in sorted(rows.collect(), key=lambda r: r["at"]):
        want.setdefault(r.to, []).append(r.line + "\n")
    got = {r.name: (r.bytes, r.lines) for r in named.write_named_files(rows, str(out), "to", ["at"], every=every, range_bytes=2000).collect()}
    assert {p.name: p.read_text() for p in out.iterdir()} == {n: "".join(x) for n, x in want.items()}
    assert got == {n: (len("".join(x).encode()), len(x)) for n, x in want.items()}
    with pytest.raises(Exception, match="has files"):
        named.write_named_files(rows, str(out), "to", ["at"])
    one = rows.where("to = 'hot.sam' and at > -10")
    named.write_named_files(one.withColumn("to", F.lit("more.sam")), str(out), "to", ["at"], "append")
    assert {p.name for p in out.iterdir()} == {*want, "more.sam"}
    named.write_named_files(one, str(out), "to", ["at"], "overwrite")
    assert {p.name: p.read_text() for p in out.iterdir()} == {"hot.sam": "é 9\né 6\né 3\né 0\n"}
    with pytest.raises(Exception, match="no name for a file"):
        named.write_named_files(one.withColumn("to", F.lit("a/b")), str(tmp_path / "bad"), "to", ["at"])
    assert not (tmp_path / "bad").exists() or list((tmp_path / "bad").iterdir()) == []
    assert named.write_named_files(rows.where("false"), str(tmp_path / "none"), "to", ["at"]).count() == 0


def test_a_killed_task_leaves_whole_files(tmp_path):
    """The first attempt of a writing task dies in the middle of its rows."""
    code = """
    import os, sys, time
    from pyspark.sql import SparkSession, functions as F
    from strandwise.sources import named
    base = sys.argv[1]
    spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", f"file://{base}/shared").getOrCreate()
    rows = spark.range(40_000).select(F.concat(F.lit("f"), F.col("id") % 3, F.lit(".sam")).alias("name"), F.col("id").alias("at"), F.col("id").cast("string").alias("line"))
    plain = named.NamedWriter.write
    def dying(self, batches):
        def some():
            for k, b in enumerate(batches):
                yield b
                try:
                    os.close(os.open(f"{base}/died", os.O_CREAT | os.O_EXCL))
                except FileExistsError:
                    continue
                os._exit(7)
        return plain(self, some())
    named.NamedWriter.write = dying
    import cloudpickle
    from pyspark import cloudpickle as own
    own.register_pickle_by_value(named)
    named.write_named_files(rows, f"{base}/out", "name", ["at"], range_bytes=60_000)
    spark.stop()
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "kill.py"
    script.write_text(textwrap.dedent(code).replace("    import cloudpickle\n", "").replace("import cloudpickle\n", ""))
    done = subprocess.run([sys.executable, str(script), str(tmp_path)], env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert (tmp_path / "died").exists()
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {f"f{k}.sam": "".join(f"{n}\n" for n in range(k, 40_000, 3)) for k in range(3)}


def test_empty_and_large_files_are_counted(spark, tmp_path):
    chr1 = rec("a", 0, "chr1", 5) + "\n"
    for name, body in (("chr1_1_10.sam", chr1), ("chr1_11_20.sam", ""), ("chr2_1_10 +é.sam", chr1), ("chr2_1_10.sam", chr1), ("chr3_1_10.sam", chr1 * 50), ("x.sam", chr1), ("y.txt", "x")):
        (tmp_path / name).write_text(body)
    checked, outcomes = modes.check_folder(spark, str(tmp_path), 500)
    assert {r.file: (r.total, r.ok) for r in checked.collect()} == {"chr1_1_10.sam": (1, True), "chr1_11_20.sam": (0, True), "chr2_1_10.sam": (1, False)}
    want = {"chr1_1_10.sam": "read", "chr1_11_20.sam": "empty", "chr2_1_10 +é.sam": "unnamed", "chr2_1_10.sam": "failed", "chr3_1_10.sam": "skipped", "x.sam": "unnamed"}
    assert {r.name: r.outcome for r in outcomes.collect()} == want


def test_files_of_any_size_are_checked_unless_a_limit_is_given(spark, tmp_path):
    good, bad = rec("q" * 1_000_000, 0, "chr1", 5) + "\n", rec("b", 0, "chr1", 11) + "\n"
    with open(tmp_path / "chr1_1_10.sam", "w") as out:
        out.writelines([good] * 105 + [bad])
    assert (tmp_path / "chr1_1_10.sam").stat().st_size > 100 << 20
    (tmp_path / "chr1_11_20.sam").write_text(bad)
    checked, outcomes = modes.check_folder(spark, str(tmp_path))
    assert {r.file: (r.total, r.checked, r.bad_range, r.ok) for r in checked.collect()} == {"chr1_1_10.sam": (106, 106, 1, False), "chr1_11_20.sam": (1, 1, 0, True)}
    assert {r.name: r.outcome for r in outcomes.collect()} == {"chr1_1_10.sam": "failed", "chr1_11_20.sam": "read"}
    assert {r.state for r in text.file_catalog(spark, str(tmp_path)).collect()} == {"readable"}


def test_names_are_parsed_by_file(spark):
    lines = spark.createDataFrame([("chr1_1_10.sam", 0, rec("a", 0, "chr1", 5))], S.LINES)
    plan = checks.region_check(lines)._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.splitlines() if "RLIKE" in x and "file" in x.split("RLIKE")[0][-60:]]
    assert not any("line" in x for x in scans), scans


def test_fates_add_up(spark):
    listed = spark.createDataFrame([("chr1", 1, 10), ("chr1", 21, 30)], S.REGIONS)
    rows = ["@HD", "", "\r", "x\ty", rec("a", 4, "*", 0), rec("b", 0, "chr1", 0), rec("c", 0, "chr2", 5), rec("d", 0, "chr1", 15), rec("e", 0, "chr1", 25), rec("f", 0, "chr1", 99)]
    got = regions.fates(lines_of(spark, rows).withColumn("fate", F.lit("own")), listed)
    assert [r.fate for r in got.orderBy("line_no").collect()] == ["header", "blank", "blank", "malformed", "unplaced", "unplaced", "other_chr", "gap", "placed", "gap"]
    assert tuple(regions.split_stats(lines_of(spark, rows), listed).first()) == (7, 1)


@pytest.mark.parametrize("digit", [1, 2, 16])
def test_last_known_values_are_carried_over_blocks(spark, monkeypatch, digit):
    monkeypatch.setattr(order, "_DIGIT", digit)
    rng = random.Random(digit)
    n = 1 << min(3 * digit, 7)  # what three levels hold
    rows = [(k, f"v{k}" if rng.random() < 0.1 else None) for k in range(3, n)]
    got = order.last_known(spark.createDataFrame(rows, "at long, v string").repartition(3), "at", "v", "known")
    want, last = {}, None
    for k, v in rows:
        last = v or last
        want[k] = last
    assert {r["at"]: r.known for r in got.collect()} == want
    assert order.last_known(spark.createDataFrame([], "at long, v string"), "at", "v", "known").count() == 0


def test_fasta_has_no_single_task(spark):
    plan = text.fasta_lengths(lines_of(spark, [">a", "AC"]))
    plan.collect()
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_sweep_is_the_tiled_join(spark, how):
    rng, spans = random.Random(6), []
    for name in ("chr1", "chr2", "chr9"):
        at = 1
        while at < 3000:
            size = rng.choice([1, 5, 40, 700])
            spans.append((name, at, at + size - 1))
            at += size + rng.choice([0, 0, 3, 100])
    listed = spark.createDataFrame(spans, S.REGIONS)
    points = [(k, rng.choice(["chr1", "chr2", "chr3", None]), rng.choice([rng.randrange(-3, 3200), 50, None])) for k in range(2000)]
    points = spark.createDataFrame(points, "line_no long, rname string, pos long").withColumn("chr", F.lit("own"))
    tiled = sorted(map(tuple, regions.assign(points, listed, how).collect()), key=repr)
    assert sorted(map(tuple, regions.sweep(points, listed, how).collect()), key=repr) == tiled
    assert sorted(map(tuple, regions.assign(points, listed, how, most=10).collect()), key=repr) == tiled
    assert regions.sweep(points.where("false"), listed).count() == 0 and regions.sweep(points, listed.where("false")).count() == 0


def test_numbers_inside_groups(spark):
    rows = [("a" if k % 3 else "b", -k, k) for k in range(500)]
    got = order.numbered_in(spark.createDataFrame(rows, "g string, o long, k long").repartition(5), ["g"], ["o"], "no").collect()
    for g in "ab":
        mine = sorted((r.o, r.no) for r in got if r.g == g)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_a_stream_that_starts_again_writes_each_file_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    os.mkdir(source)

    def add(*names):
        for k, n in enumerate(names):
            with open(f"{source}/{n}.sam", "w") as f:
                f.write("@HD\n" + rec("b", 0, "chr2", k + 1) + "\n" + rec("a", 0, "chr1", 9) + "\n")

    def run():
        query = streams.process_stream(spark, source, out, "sort", checkpoint, files=2)
        query.awaitTermination(120)
        assert query.exception() is None

    add("one", "two", "three")
    run()
    written = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*.sam")}
    assert set(written) == {f"{n}.sorted.sam" for n in ("one", "two", "three")}
    run()  # nothing new
    # a batch whose end never reached the checkpoint comes again under its number
    for commit in (tmp_path / "check/commits").iterdir():
        if commit.name.strip(".").startswith("1"):
            commit.unlink()
    run()
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("*.sam")} == written
    add("four")
    run()
    done = sorted((r.batch, r.name, r.n_lines) for r in streams.batches_done(spark, out).collect())
    assert [n for _, n, _ in sorted(done, key=lambda r: r[1])] == [f"{n}.sorted.sam" for n in ("four", "one", "three", "two")]
    assert all(n == 3 for _, _, n in done) and len({b for b, _, _ in done}) == 3
    assert (tmp_path / "out/four.sorted.sam").read_text().split("\n")[1].startswith("a\t")


def test_a_batch_without_manifest_is_done_again(spark, tmp_path):
    (tmp_path / "x.sam").write_text(rec("a", 0, "chr1", 9) + "\n")
    out, batch = str(tmp_path / "out"), spark.createDataFrame([(f"file://{tmp_path}/x.sam",)], "file string")
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")
    kept = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    streams.process_batch(batch, 0, out, "sort")
    assert {n for n in os.listdir(shared) if not n.startswith(".")} <= kept  # a batch leaves no intermediate table
    manifest = next((tmp_path / "out/_batches/000000000").glob("_SUCCESS"))
    manifest.unlink()  # as if the driver had died before the batch's end
    (tmp_path / "out/x.sorted.sam").write_text("half")
    streams.process_batch(batch, 0, out, "sort")
    assert (tmp_path / "out/x.sorted.sam").read_text() == rec("a", 0, "chr1", 9) + "\n"
    assert [tuple(r)[2:] for r in streams.batches_done(spark, out).collect()] == [("x.sorted.sam", 1)]


def test_reports_count_in_the_writing_pass(spark):
    rows = ["@HD", "", "short\t0", rec("a", 0, "chr1", 5), rec("b", 0, "chr1", 5), "@CO"]
    run = report.Report()
    with run.step("mark"):
        got = {r.metric: r.value for r in report.run_counters(lines_of(spark, rows)).collect()}
    assert got == {"lines": 6, "headers": 2, "dropped": 1, "records": 2, "duplicates": 1}
    with run.step("write"), run.step("mark"):
        run.counted(lines_of(spark, rows), n=F.count(F.lit(1))).write.format("noop").mode("overwrite").save()
    times = run.times(spark).collect()
    assert [r.step for r in times] == ["mark", "write"] and abs(sum(r.percent for r in times) - 100) < 1e-6 and run.counters() == {"n": 6}
    assert {r.metric: r.value for r in report.run_counters(lines_of(spark, [])).collect()} == dict.fromkeys(got, 0)


def test_counters_take_one_scan(spark, tmp_path):
    lines_of(spark, ["@HD", rec("a", 0, "chr1", 5)]).write.parquet(str(tmp_path / "l"))
    lines = spark.read.parquet(str(tmp_path / "l"))
    chroms = spark.createDataFrame([("chr1", 10, 0)], "name string, length long, ord long")
    listed = spark.createDataFrame([("chr1", 1, 10)], S.REGIONS)
    for df in (checks.load_stats(lines, chroms), regions.split_stats(lines, listed)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("line#") and str(df._jdf.queryExecution().executedPlan()).count(f"{tmp_path}/l") == 1
        assert tuple(df.first()) == (1, 1)


def test_lines_written_by_fate(spark, tmp_path):
    listed = spark.createDataFrame([("chr1", 1, 10)], S.REGIONS)
    lines = lines_of(spark, ["@HD", "x", rec("a", 0, "chr1", 5), rec("b", 0, "chr2", 5)])
    got = {r.fate: r.n for r in modes.write_fates(lines, listed, str(tmp_path / "f")).collect()}
    assert got == {"header": 1, "malformed": 1, "placed": 1, "other_chr": 1}
    with pytest.raises(ValueError, match="1 malformed"):
        modes.write_fates(lines, listed, str(tmp_path / "g"), S.STRICT)
    assert [r.region for r in spark.read.parquet(str(tmp_path / "g")).where("fate = 'placed'").collect()] == ["chr1_1_10"]
    assert modes.write_fates(lines.where("line_no <> 1"), listed, str(tmp_path / "h"), S.STRICT).count() == 3
    with pytest.raises(ValueError, match="overlap"):
        regions.fates(lines, listed.union(listed))
    # regions of a chromosome in the order of start and end
    spans = [("chr1", 5, 9), ("chr1", 5, 7), ("chr1", 1, 4)]
    assert [tuple(r) for r in regions.overlaps(spark.createDataFrame(spans, S.REGIONS)).collect()] == [("chr1", 5, 9)]
