"""Every query of the catalogue against its SQL, and hand tables for rules that the views lack."""

from __future__ import annotations

import math
import random
import zipfile

import duckdb
import pytest

from helixframe import catalog
from helixframe.functions import genomics as G
from helixframe.operators import alignments as A
from helixframe.operators import depth as D
from helixframe.operators import fastq as Q
from helixframe.operators import intervals as I
from helixframe.operators import variants as V
from helixframe.plans.views import view
from helixframe.sources import formats, sinks
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def rows(columns, values):
    """Rows that compare across engines: by column name, numbers to five places."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda x: None if x is None or x != x else round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted(repr([cell(r[i]) for i in order]) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("region", "orders", "lineitem", "part", "events"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(catalog.oracle_sql()[name])
    got = catalog.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_targets_are_all_orders(spark):
    assert view(spark, SF, "targets").count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_contig_that_fits_no_rule_is_an_error(spark):
    bed = spark.createDataFrame([("scaffold1", 0, 5)], "chrom string, start_pos long, end_pos long")
    with pytest.raises(Exception, match="cannot map contig"):
        I.rename_contigs(bed).collect()


def test_merge_over_bin_edges(spark):
    bed = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 12, 13), ("a", 20, 40), ("a", 42, 44), ("b", 5, 64), ("b", 8, 9), ("b", 63, 70)], "chrom string, start_pos long, end_pos long")
    got = {tuple(r) for r in I.merge_intervals(bed, size=8).collect()}
    assert got == {("a", 0, 40, 4), ("a", 42, 44, 1), ("b", 5, 70, 3)}


BED = "chrom string, start_pos long, end_pos long, name string"


def spread(rng, n, longest, contig=200_000):
    """Intervals of lengths over all magnitudes."""
    out = []
    for i in range(n):
        length = int(longest ** rng.random())
        start = rng.randrange(0, max(1, contig - length))
        out.append((rng.choice("ab"), start, start + length, f"i{i}"))
    return out


@pytest.mark.parametrize("longest", [2, 100, 200_000])
@pytest.mark.parametrize("measure", [("left", "right"), ("left",), ("right",)])
def test_interval_join_over_all_lengths(spark, longest, measure):
    rng = random.Random(longest)
    left = [*spread(rng, 300, 200_000), ("a", 0, 200_000, "whole"), ("a", 5, 5, "empty"), ("b", None, 7, "null"), ("a", 64, 128, "edge"), ("c", 0, 9, "alone")]
    right = [*spread(rng, 300, longest), ("b", 0, 200_000, "all"), ("a", 128, 192, "next"), ("a", 127, 128, "last"), ("a", 9, 3, "turned")]
    got = sorted((r["name"], r["r_name"]) for r in I.interval_join(spark.createDataFrame(left, BED), spark.createDataFrame(right, BED), measure).collect())
    ok = lambda x: x[1] is not None and x[2] is not None and x[1] < x[2]
    want = sorted((x[3], y[3]) for x in filter(ok, left) for y in filter(ok, right) if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got == want and ("whole", "last") in want


def test_placed_rows_are_never_broadcast(spark):
    """Spark takes a placed side for as small as it was, and would build it many times larger on the driver."""
    few = spark.createDataFrame([("a", 0, 10, "x"), ("a", 5, 900, "y")], BED)
    for measure in (("left", "right"), ("left",), ("right",)):
        plan = I.interval_join(few, few, measure)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("longest", [1, 64, 65, 128, 129, 300])
def test_interval_join_with_a_known_length(spark, longest):
    rng = random.Random(longest)
    left = [*spread(rng, 200, 200_000), ("a", 5, 5, "empty")]
    right = [*spread(rng, 300, longest), ("b", 64, 64 + longest, "longest"), ("a", 127, 127 + longest, "edge")]
    got = sorted((r["name"], r["r_name"]) for r in I.interval_join(spark.createDataFrame(left, BED), spark.createDataFrame(right, BED), ("left",), longest).collect())
    assert got == sorted((x[3], y[3]) for x in left for y in right if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and x[1] < x[2])


def test_depth_of_regions_short_and_long(spark):
    """Regions within a row of chunks, at its edges and beyond it, over runs with gaps, against every base."""
    rng = random.Random(4)
    runs, depth = [], {"a": [0] * 20_000, "b": [0] * 20_000}
    for c in "ab":
        at = rng.randrange(500)
        while at < 18_000:
            end, d = at + rng.choice([1, 3, 40, 1500]), rng.randrange(1, 30)
            runs.append((c, at, end, d))
            depth[c][at:end] = [d] * (end - at)
            at = end + rng.choice([0, 0, 2, 700])
    regions = [(*x[:3], f"{i}") for i, x in enumerate(spread(rng, 200, 9000, 19_000))] + [("a", 511, 1536, "edge"), ("a", 511, 1024, "fits"), ("a", 0, 1024, "whole"), ("a", 0, 1025, "over"), ("b", 19_000, 19_900, "none"), ("b", 100, 160, "x"), ("b", 100, 160, "y")]
    odd = [("a", 7, 7, "empty"), ("b", None, 9, "null"), ("c", 5, 9, "alone")]
    r, bed = spark.createDataFrame(runs, "chrom string, start_pos long, end_pos long, depth long"), spark.createDataFrame(regions, BED)
    both = bed.unionByName(spark.createDataFrame(odd, BED))
    of = {n: depth[c][s:e] for c, s, e, n in regions}
    mean, mid, least = ({x["name"]: x for x in df.collect()} for df in (D.region_depth(both, r), D.region_depth(both, r, median=True), D.region_thresholds(both, r, [1, 12])))
    every = {x["name"]: x for x in D.per_target_coverage(bed, r).collect()}
    assert len(mean) == len(mid) == len(least) == len(both.collect()) and set(every) == set(of)
    for n, d in of.items():
        m = sorted(d)[(len(d) + 1) // 2 - 1]
        assert mean[n]["depth"] == pytest.approx(sum(d) / len(d)) and mid[n]["depth"] == m
        assert (least[n]["ge_1"], least[n]["ge_12"]) == (sum(x >= 1 for x in d), sum(x >= 12 for x in d))
        assert [every[n][k] for k in ("mean", "min", "max", "median", "pct_0x")] == pytest.approx([sum(d) / len(d), min(d), max(d), m, d.count(0) / len(d)])
    assert all(x[n]["depth"] == 0 for x in (mean, mid) for n in ("empty", "null", "alone")) and all(least[n]["ge_1"] == 0 for n in ("empty", "null", "alone"))
    assert D.callable_in_bed(r, both, 12, size=1000).first()[0] == sum(x >= 12 for d in of.values() for x in d)


def test_regions_do_not_meet_their_runs_one_by_one(spark):
    """Short regions meet one row of chunks each, however many runs they hold."""
    r = spark.range(2000).selectExpr("'a' chrom", "id start_pos", "id + 1 end_pos", "id % 7 + 1 depth")
    bed = spark.range(500).selectExpr("'a' chrom", "id start_pos", "id + 200 end_pos")
    rows = []

    def made(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        todo = [plan]
        while todo:
            node = todo.pop()
            kids = node.children()
            todo += [kids.apply(i) for i in range(kids.size())]
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
            elif hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
                todo.append(node.plan())
            if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
                rows.append(node.metrics().apply("numOutputRows").value())
        return max(rows)

    assert made(D.region_depth(bed, r)) <= 2000


def test_values_in_lambdas_and_orders_are_computed_once(spark):
    """Qualities and blocks are not taken apart for each place, nor names in each comparison."""
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    reads = spark.createDataFrame([("x", 3, "a", 1, 60, "4M", "ACGT", "IIII")], "qname string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string")
    assert text(reads.select(Q.sliding_cut(F.col("qual")).alias("x"))).count("split(") == 1
    assert text(A.with_mate_overlaps(reads)).count("transform(array(aggregate(zip_with(regexp_extract_all(") == 2
    order = next(x for x in text(A.sort_alignments(reads, "name")).splitlines() if "Sort [" in x)
    assert "regexp_extract_all" not in order


@pytest.mark.parametrize("width", [1, 3, 4])
def test_sliding_cut_against_every_window(spark, width):
    rng = random.Random(width)
    quals = ["", "I", "III", "####", "IIII"] + ["".join(rng.choice("#+5?I") for _ in range(rng.randrange(30))) for _ in range(200)]
    for r in spark.createDataFrame([(q,) for q in quals], "q string").select("q", Q.sliding_cut(F.col("q"), width, 20).alias("n")).collect():
        low = [i for i in range(len(r["q"]) - width + 1) if sum(ord(c) - 33 for c in r["q"][i : i + width]) < 20 * width]
        assert r["n"] == (low[0] if low else len(r["q"]))





def test_interval_join_work_follows_its_pairs(spark):
    """Dense reads and targets with one interval as long as the contig on each side."""
    rng = random.Random(5)
    read = lambda i, n: (lambda s: ("a", s, s + n, str(i)))(rng.randrange(100_000))
    left = spark.createDataFrame([*(read(i, rng.randint(50, 100)) for i in range(4000)), ("a", 0, 100_000, "whole")], BED)
    right = spark.createDataFrame([*(read(i, rng.randint(20, 200)) for i in range(4000)), ("a", 0, 100_000, "whole")], BED)
    r = right.select("chrom", *[F.col(c).alias(f"r_{c}") for c in ("start_pos", "end_pos", "name")])
    pairs, candidates = I.interval_join(left, right).count(), I._candidates(left, r, ("left", "right"))
    assert pairs > 30_000 and candidates.count() <= 3 * pairs
    assert candidates.where("name = 'whole'").select("__bin").distinct().count() < 20


def test_points_in_targets(spark):
    rng = random.Random(3)
    targets = [*spread(rng, 40, 50_000), ("c", 10, 20, "t"), ("c", 20, 30, "u"), ("c", 15, 16, "v")]
    points = [(c, p) for c in "ab" for p in rng.sample(range(1, 200_000), 400)] + [("c", p) for p in (10, 11, 20, 21, 30, 31, 31)] + [("d", 5), ("a", None)]
    got = sorted((r["chrom"], r["pos"]) for r in I.restrict_to_targets(spark.createDataFrame(points, "chrom string, pos long"), spark.createDataFrame(targets, BED)).collect())
    assert got == sorted((c, p) for c, p in points if p is not None and any(t[0] == c and t[1] < p <= t[2] for t in targets))
    assert I.restrict_to_targets(spark.createDataFrame(points, "chrom string, pos long"), spark.createDataFrame([], BED)).count() == 0


def test_variant_types_and_multiallelic(spark):
    v = spark.createDataFrame([("A", "T"), ("A", "AT"), ("AT", "A"), ("AT", "GC"), ("A", "T,C")], "ref string, alt string")
    assert [r[0] for r in V.typed(v).select("type").collect()] == ["SNV", "INSERTION", "DELETION", "COMPLEX", "INSERTION"]
    assert V.typed(v, split_alts=True).where("type = 'SNV'").count() == 3


def test_vcf_with_missing_fields(spark):
    lines = ["c\t5\t.\tA\tT\t.\tPASS\t.\tGT:AD:DP\t0/1:7:.\t1/1:1,2:3", "c\t6\t.\tA\tT\tx\tPASS\tDP=1;DB;DP=2", "short\tline"]
    v = formats.parse_vcf(spark.createDataFrame([(x,) for x in lines], "value string"), F.array(F.lit("s1"), F.lit("s2"))).orderBy("pos").collect()
    assert len(v) == 2 and v[0]["qual"] is None and v[1]["info"] == {"DP": "1", "DB": ""} and v[1]["samples"] == []
    parsed = formats.parse_vcf(spark.createDataFrame([(lines[0],)], "value string"), F.array(F.lit("s1"), F.lit("s2")))
    assert V.sample_fields(parsed).select("dp", "ad_ref", "ad_alt").first() == (0, 0, 0)
    assert V.sample_fields(parsed, "s2").select("dp", "ad_ref", "ad_alt").first() == (3, 1, 2)


def test_cigar_blocks(spark):
    df = spark.createDataFrame([(11, "3S4M2D5M1I6M2N1M4H")], "pos long, cigar string")
    assert [tuple(b) for b in df.select(G.cigar_blocks(F.col("pos"), F.col("cigar"))).first()[0]] == [(10, 14, 3), (16, 21, 7), (21, 27, 13), (29, 30, 19)]


def test_contig_that_is_not_listed_is_an_error(spark):
    bed = spark.createDataFrame([("a", 1, 5), ("zz", 1, 5)], "chrom string, start_pos long, end_pos long")
    contigs = spark.createDataFrame([("a", 6)], "chrom string, length long")
    for f in (lambda b: I.slop(b, contigs, 3), lambda b: I.bed_to_interval_list(b, contigs)):
        with pytest.raises(Exception, match="contig is not listed: zz"):
            f(bed).collect()
    assert I.slop(bed.where("chrom = 'a'"), contigs, 3).collect() == [("a", 0, 6)]


@pytest.mark.parametrize(
    "effect, coding, changes",
    [("synonymous_variant", True, False), ("missense", True, True), ("stop_gained", True, True), ("frameshift_variant", True, True), ("inframe_insertion", True, True), ("inframe_deletion", True, True), ("stop_lost", False, False), ("splice_region_variant", False, False), (None, False, False)],
)
def test_effects(spark, effect, coding, changes):
    df = spark.createDataFrame([(effect,)], "e string")
    assert df.select(G.is_coding(F.col("e")), G.is_nonsynonymous(F.col("e"))).first() == (coding, changes)


def test_every_part_of_a_written_vcf_has_its_header(spark, tmp_path):
    v = formats.parse_vcf(view(spark, SF, "vcf_lines"), F.array(F.lit("s1")))
    sinks.write_vcf(v.repartition(5), f"{tmp_path}/v", ["s1"])
    sinks.write_vcf(v.limit(0), f"{tmp_path}/none", ["s1"])
    lines = spark.read.text(f"{tmp_path}/v").select("value", F.col("_metadata.file_path").alias("f"))
    assert lines.where("value like '#CHROM%'").groupBy("f").count().count() == lines.select("f").distinct().count()
    assert spark.read.text(f"{tmp_path}/none").where("value like '#CHROM%'").count() == 1 and formats.read_vcf(spark, f"{tmp_path}/none").count() == 0


def test_lines_are_numbered_over_the_blocks_of_files(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 1), ("c", 1200)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(n)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        got = formats.numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert got.where("value <> concat(substr(value, 1, 1), line) or path not like concat('%/', substr(value, 1, 1), '.txt')").count() == 0 and got.count() == 4201
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fastqc_reports(spark, tmp_path):
    for i, status in enumerate(("PASS", "FAIL")):
        with zipfile.ZipFile(tmp_path / f"r{i}.zip", "w") as z:
            z.writestr("x_fastqc/summary.txt", f"{status}\tPer base sequence quality\tf\nWARN\tAdapter Content\tf\nbroken\n")
            z.writestr("x_fastqc/fastqc_data.txt", f">>Basic Statistics\tpass\nTotal Sequences\t{i + 5}\nSequence length\t30-76\n%GC\t4{i}\n>>END_MODULE\n>>Other\tpass\nTotal Sequences\t99\n>>END_MODULE\n")
    got = sorted((tuple(r)[1:] for r in formats.read_fastqc(spark, f"{tmp_path}/*.zip").collect()), key=lambda r: r[1])
    assert [r[1:] for r in got] == [(5, "30-76", 40.0), (6, "30-76", 41.0)]
    assert [r[0] for r in got] == [{"per_base_sequence_quality": s, "adapter_content": "WARN"} for s in ("PASS", "FAIL")]


READ = "sample string, qname string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string"


def test_single_reads_lose_to_pairs(spark):
    row = lambda q, flag, pos, qual="I": ("s", q, flag, "c", pos, 60, "4M", "ACGT", qual * 4)
    reads = spark.createDataFrame([row("p", 1 | 64, 10), row("p", 1 | 128 | 16, 50), row("q", 1 | 64, 10, "5"), row("q", 1 | 128 | 16, 50, "5"), row("a", 0, 10, "J"), row("b", 16, 50, "J"), row("x", 0, 90, "5"), row("y", 0, 90), row("z", 4, 90)], READ)
    got = {(r["qname"], r["pos"]) for r in A.mark_duplicates(reads).where("flag & 1024 <> 0").collect()}
    assert got == {("q", 10), ("q", 50), ("a", 10), ("b", 50), ("x", 90)}
    assert A.mark_duplicates(reads, remove=True).count() == 4


def test_reads_of_one_name_and_end_are_no_pair(spark):
    """Two first ends with one name are fragments by themselves, as they are in the SQL of mark_duplicates."""
    end = lambda q, flag, pos: (q, "n", flag, "a", pos, 60, "4M", "ACGT", "IIII")
    rows = [end("p", 65, 10), end("p", 65, 10), end("q", 65, 10), end("u", 65, 50), end("u", 81, 80), end("v", 65, 50), end("w", 65, 200), end("w", 129, 300), end("x", 65, 200), end("x", 129, 300), end("y", 69, 10)]
    reads = spark.createDataFrame(rows, "qname string, sample string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string")
    marked = A.mark_duplicates(reads)
    got = sorted((r["qname"], r["pos"], r["flag"] & 1024 > 0) for r in marked.collect())
    assert got == sorted([("p", 10, False), ("p", 10, True), ("q", 10, True), ("u", 50, False), ("u", 80, False), ("v", 50, True), ("w", 200, False), ("w", 300, False), ("x", 200, True), ("x", 300, True), ("y", 10, False)])


def test_optical_duplicates(spark):
    row = lambda q, flag, pos, qual="I": ("s", q, flag, "c", pos, 60, "4M", "ACGT", qual * 4)
    names = {"m:1:f:1:7:1000:1000": "J", "m:1:f:1:7:1100:950": "I", "m:1:f:1:7:1101:1000": "I", "m:1:f:1:8:1000:1000": "I", "plain": "I"}
    reads = spark.createDataFrame([row(q, f, p, x) for q, x in names.items() for f, p in ((1 | 64, 10), (1 | 128 | 16, 50))], READ)
    marked = A.mark_duplicates(reads, optical_distance=100)
    # The third is 101 from the first, but near the second: chains belong together.
    assert {(r["qname"], r["optical"]) for r in marked.where("flag & 1024 <> 0").collect()} == {(q, q.endswith(("1100:950", "1101:1000"))) for q in list(names)[1:]}
    m = A.duplication_metrics(marked).first()
    assert (m["pairs_examined"], m["pair_duplicates"], m["optical_duplicates"]) == (5, 4, 2)
    assert A.mark_duplicates(reads).columns == reads.columns


def test_optical_groups_against_a_plain_version(spark):
    """Clusters of a dense tile, in groups by all pairs; a group without the read that stays keeps its best."""
    rng, d = random.Random(11), 10
    rows, spots = [], {}
    for i in range(150):
        tile, x, y, score = rng.choice("12"), rng.randrange(-40, 160), rng.randrange(160), rng.choice("?@ABC")
        q = f"m:f:{tile}:{x}:{y}" if rng.random() < 0.95 else f"plain{i}"
        if q not in spots:
            spots[q] = (tile, x, y, ord(score)) if q[0] == "m" else None
            rows += [("s", q, f, "c", p, 60, "4M", "ACGT", score * 4) for f, p in ((1 | 64, 10), (1 | 128 | 16, 50))]
    best = min(spots, key=lambda q: (-ord(rows[[r[1] for r in rows].index(q)][8][0]), q))
    group = {q: {q} for q, s in spots.items() if s}
    for a in list(group):
        for b in list(group):
            (t, x, y, _), (u, v, w, _) = spots[a], spots[b]
            if t == u and abs(x - v) <= d and abs(y - w) <= d and group[a] is not group[b]:
                group[a] |= group[b]
                for q in group[a]:
                    group[q] = group[a]
    want = {q for q, g in group.items() if q != min(g, key=lambda q: (q != best, -spots[q][3], q))}
    marked = A.mark_duplicates(spark.createDataFrame(rows, READ), optical_distance=d)
    assert {r["qname"] for r in marked.where("optical").collect()} == want and 20 < len(want) < len(spots) - 5
    assert marked.where("optical and flag & 1024 = 0").count() == 0


def test_connected_groups(spark):
    from helixframe.operators.graph import connected_groups

    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(100, 140)] + [("zz", "b"), ("b", "zz"), ("c", "c")]
    got = {r["node"]: r["group"] for r in connected_groups(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {**{f"{i:03}": "100" for i in range(100, 141)}, "zz": "b", "b": "b"}
    assert connected_groups(spark.createDataFrame([], "u string, v string")).count() == 0


def test_incremental_runs_touch_only_changed_files(spark, tmp_path):
    from helixframe.plans.incremental import run_incremental

    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for name in "abcd":
        (source / f"{name}.txt").write_text(f"{name}1\n{name}2\n")
    asked = []

    def compute(paths):
        asked.append(sorted(p[-5:] for p in paths))
        return spark.read.text(paths).where("value <> 'skipped'").select("value", F.col("_metadata.file_path").alias("file"))

    run = lambda: {(r["path"][-5:], r["reason"]) for r in run_incremental(spark, f"file://{source}", f"file://{target}", compute).collect()}
    files = lambda: {p: p.stat().st_mtime_ns for p in target.glob("rows/*/*.parquet")}
    values = lambda: sorted(r["value"] for r in spark.read.parquet(f"{target}/rows").collect())
    assert len(run()) == 4 and len(values()) == 8
    first = files()
    (source / "a.txt").write_text("new\n")
    (source / "b.txt").unlink()
    (source / "c.txt").write_text("skipped\n")
    assert run() == {("a.txt", "does not match"), ("b.txt", "missing"), ("c.txt", "does not match")} and asked[-1] == ["a.txt", "c.txt"]
    assert values() == ["d1", "d2", "new"] and len(files().items() & first.items()) == 1
    assert run() == set() and len(asked) == 2


def test_mates_count_once(spark):
    row = lambda q, flag, pos, cigar, seq, qual: ("s", q, flag, "c", pos, 60, cigar, seq, qual)
    reads = [row("p", 67, 10, "4M", "AAAA", "5555"), row("p", 131, 12, "1M1D3M", "CCCC", "5I55"), row("q", 67, 10, "4M", "GGGG", "IIII"), row("x", 0, 12, "2M", "TT", "55")]
    got = {r["pos"]: (r["depth"], r["a"], r["c"], r["g"], r["t"]) for r in A.pileup(spark.createDataFrame(reads, READ), remove_overlaps=True).collect()}
    # Place 12: equal qualities, the first of the pair; 13: the second has a gap; 14: the second alone.
    assert got == {10: (2, 1, 0, 1, 0), 11: (2, 1, 0, 1, 0), 12: (3, 1, 0, 1, 1), 13: (3, 1, 0, 1, 1), 14: (1, 0, 1, 0, 0), 15: (1, 0, 1, 0, 0), 16: (1, 0, 1, 0, 0)}


def test_reference_chunks_at_their_edges(spark):
    from helixframe.operators import reference as X

    seq = "".join(random.Random(2).choice("ACGTacgtN") for _ in range(101))
    lines = spark.createDataFrame([("c", i, seq[i : i + 7]) for i in range(0, 101, 7)] + [("d", 0, "ACGT")], "chrom string, offset long, seq string")
    chunks = X.reference_chunks(lines, 10)
    assert {(r["chunk"], r["first"], r["seq"]) for r in chunks.where("chrom = 'c'").collect()} == {(k, max(0, 10 * k - 1), seq[max(0, 10 * k - 1) : 10 * k + 11].upper()) for k in range(11)}
    points = spark.createDataFrame([("c", p) for p in range(1, 104)] + [("e", 1)], "chrom string, pos long")
    assert {r["pos"]: r["ref"] for r in X.reference_at(points, chunks, 10).collect()} == {i + 1: b.upper() for i, b in enumerate(seq)}
    blocks = spark.createDataFrame([("c", 0, 25), ("c", 95, 101), ("d", 0, 4)], "chrom string, s long, e long")
    parts = sorted((r["chrom"], r["__s"], r["__e"], r["ref"]) for r in X.reference_of(blocks, chunks, "s", "e", 1, 10).collect())
    around = lambda s, e: "".join(seq[i].upper() if 0 <= i < 101 else " " for i in range(s - 1, e + 1))
    assert parts == [("c", 0, 10, around(0, 10)), ("c", 10, 20, around(10, 20)), ("c", 20, 25, around(20, 25)), ("c", 95, 100, around(95, 100)), ("c", 100, 101, around(100, 101)), ("d", 0, 4, " ACGT ")]
    sites = spark.createDataFrame([("c", p) for p in (1, 10, 11, 20, 20, 101)] + [("c", None)], "chrom string, pos long")
    masked = {r["pos"]: r["ref"] for r in X.reference_at(points, X.mask_sites(chunks, sites, 10), 10).collect()}
    assert [p for p, b in sorted(masked.items()) if b == "*"] == [1, 10, 11, 20, 101]
    assert all("*" in r["seq"] for r in X.mask_sites(chunks, sites, 10).where("chrom = 'c' and chunk in (0, 1, 2, 9, 10)").collect())


def test_hardy_weinberg_by_hand(spark):
    """Values of the exact test from enumeration with whole numbers."""
    def exact(het, hom, other):
        n, rare = het + hom + other, 2 * hom + het
        ways = {h: math.factorial(n) * 2**h // (math.factorial(h) * math.factorial((rare - h) // 2) * math.factorial(n - h - (rare - h) // 2)) for h in range(rare % 2, min(rare, 2 * n - rare) + 1, 2)}
        all_ = sum(ways.values())
        return sum(w for w in ways.values() if w <= ways[het]) / all_, sum(w for h, w in ways.items() if h >= het) / all_

    for het, hom, other in ((57, 14, 50), (0, 5, 5), (10, 0, 0), (3, 20, 2), (0, 0, 9), (500, 100, 900)):
        gts = ["0/1"] * het + ["1/1"] * hom + ["0/0"] * other + ["./.", "0/."]
        row = [("c", 1, "A", "T", {"X": "y"}, [("s", {"GT": g}) for g in gts])]
        v = spark.createDataFrame(row, "chrom string, pos long, ref string, alt string, info map<string,string>, samples array<struct<name:string,fmt:map<string,string>>>")
        info = V.fill_tags(v, ["HWE", "ExcHet", "AC_Het", "F_MISSING"]).first()["info"]
        assert [float(info[k]) for k in ("HWE", "ExcHet")] == pytest.approx(exact(het, hom, other), abs=1e-6) and info["AC_Het"] == str(het) and info["X"] == "y"
    with pytest.raises(ValueError, match="unknown tag"):
        V.fill_tags(v, ["AC", "XX"])
    none = v.withColumn("samples", F.array().cast(v.schema["samples"].dataType))
    assert V.fill_tags(none, list(V.TAGS)).first()["info"]["HWE"] == "1.0"


def test_library_size(spark):
    reads = [("s", f"r{i}", 1 | 64 | (1024 if i % 4 == 0 else 0), "c", i, 60, "4M", "ACGT", "IIII") for i in range(4000)]
    m = A.duplication_metrics(spark.createDataFrame(reads, READ)).first()
    pairs, distinct, x = m["pairs_examined"], m["pairs_examined"] - m["pair_duplicates"], m["library_size"]
    assert (pairs, distinct) == (2000, 1500) and abs(distinct / x - (1 - math.exp(-pairs / x))) < 1e-3
    assert A.duplication_metrics(spark.createDataFrame(reads[1:4], READ)).first()["library_size"] is None


def test_rates_are_zero_without_a_total(spark):
    one = spark.range(1).select(*[f(F.lit(3), F.lit(0)) for f in (G.mapping_rate, G.duplicate_rate, G.proper_pair_rate, G.covered_rate)]).first()
    assert tuple(one) == (0.0,) * 4 and spark.range(1).select(G.mapping_rate(F.lit(3), F.lit(4))).first()[0] == 75.0


def test_recalibration_of_a_preprocessed_read(spark):
    reads = spark.createDataFrame([("s", f"r{i}", 0, "c", 10 + i, 60, "4M", "ACGT", "IIII") for i in range(50)], READ)
    reference = F.expr("substr('ACGT', cast((pos * 7) % 4 + 1 as int), 1)")
    plain, moved = A.preprocess_reads(reads), A.preprocess_reads(reads, reference)
    assert [r["pos"] for r in moved.collect()] == sorted(r["pos"] for r in plain.collect()) and {r["qual"] for r in plain.collect()} == {"IIII"}
    assert all(r["qual"] != "IIII" and len(r["qual"]) == 4 for r in moved.collect())


def test_an_empty_header_ends_its_file_only(spark, tmp_path):
    """Records after an empty header line are left out, also where a sequence line is empty, and not in other files."""
    record = lambda k: f"@r{k}\nAC{'G' * k}\n+\nII{'I' * k}\n"
    (tmp_path / "a.fastq").write_text(record(1) + "@e\n\n+\n\n" + record(2) + "\nAC\n+\nII\n" + record(3))
    (tmp_path / "b.fastq").write_text(record(4) + record(5))
    got = sorted((r["path"][-7:], r["rec"], r["header"], r["seq"]) for r in formats.read_fastq(spark, str(tmp_path)).collect())
    assert got == [("a.fastq", 0, "@r1", "ACG"), ("a.fastq", 1, "@e", ""), ("a.fastq", 2, "@r2", "ACGG"), ("b.fastq", 0, "@r4", "ACGGGG"), ("b.fastq", 1, "@r5", "ACGGGGG")]
