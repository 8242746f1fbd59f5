"""All queries of the library and their SQL. The SQL is written in another way than the plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import genomics as G
from .operators import alignments as A
from .operators import calling as C
from .operators import depth as D
from .operators import fastq as Q
from .operators import intervals as I
from .operators import reference as X
from .operators import report as R
from .operators import variants as V
from .plans import roundtrips
from .plans.views import view, with_views
from .sources import formats

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: A reference base for every position, in place of a FASTA file.
REFERENCE = "substr('ACGT', cast(pos*7 % 4 + 1 as int), 1)"


def query(sql: str | None = None, name: str | None = None, recursive: bool = False):
    """Register a function of views; ``sql`` gives the same rows."""

    def add(f):
        key = name or f.__name__
        _QUERIES[key] = f
        if sql is not None:
            _SQL[key] = with_views(sql, recursive)
        return f

    return add


def r6(df: DataFrame, *names: str) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


def _good(s, d):
    return D.read_filter(view(s, d, "alignments")).select("sample", "chrom", "start_pos", "end_pos")


def _variants(s, d):
    return view(s, d, "variants").withColumnRenamed("filt", "filter")


def _parsed(s, d):
    return formats.parse_vcf(view(s, d, "vcf_lines"), F.array(F.lit("s1")))


EVENTS = """, ev as (select chrom, pos, sum(c) c from (select chrom, start_pos pos, 1 c from alignments where flag & 1796 = 0 union all select chrom, end_pos, -1 from alignments where flag & 1796 = 0) t group by 1, 2 having sum(c) <> 0),
runs as (select chrom, pos start_pos, lead(pos) over (partition by chrom order by pos) end_pos, cast(sum(c) over (partition by chrom order by pos) as bigint) depth from ev),
pos_runs as (select * from runs where depth > 0),
zev as (select chrom, pos, max(k) k, sum(c) c from (select chrom, pos, 0 k, c from ev union all select chrom, 0, 1, 0 from contigs) t group by 1, 2),
zruns0 as (select chrom, pos start_pos, lead(pos) over (partition by chrom order by pos) e, cast(sum(c) over (partition by chrom order by pos) as bigint) depth from zev),
zruns as (select z.chrom, start_pos, coalesce(e, length) end_pos, depth from zruns0 z join contigs c on z.chrom = c.chrom where start_pos < coalesce(e, length))
"""


def runs_sql(body: str) -> str:
    """SQL after the definitions of depth runs (they follow the views)."""
    return EVENTS + body


MERGED = """, f as (select *, max(end_pos) over (partition by chrom order by start_pos, end_pos rows between unbounded preceding and 1 preceding) m from targets),
g as (select *, sum(case when start_pos <= m + {d} then 0 else 1 end) over (partition by chrom order by start_pos, end_pos rows unbounded preceding) k from f),
merged as (select chrom, min(start_pos) start_pos, max(end_pos) end_pos, count(*) n from g group by chrom, k)
"""

# --- intervals ---------------------------------------------------------------


def placed(df: DataFrame, *groups: str) -> DataFrame:
    """``df`` in the order that it has, with the place of each row within its group."""
    numbered = df.withColumn("__id", F.monotonically_increasing_id())
    keys = [F.expr(g) for g in groups]
    return numbered.select(*df.columns, F.row_number().over(Window.partitionBy(*keys).orderBy("__id")).alias("place"))


@query("select chrom, start_pos, end_pos, name, cast(row_number() over (partition by chrom, start_pos // 512 order by start_pos, end_pos, name) as int) place from targets")
def sort_bed(s, d):
    return placed(I.sort_bed(view(s, d, "targets").repartition(7)), "chrom", "start_pos div 512")


@query("select case when chrom = 'chr5' then 'MT' when name like '%7' then 'GL456210.1' else substr(chrom, 4) end chrom, start_pos, end_pos, name from targets")
def rename_contigs(s, d):
    t = view(s, d, "targets")
    odd = F.when((F.col("chrom") != "chr5") & F.col("name").like("%7"), "chr1_GL456210_random").otherwise(F.col("chrom"))
    return I.rename_contigs(t.withColumn("chrom", odd), {"chr5": "MT"})


@query("select t.chrom, greatest(start_pos - 1500, 0) start_pos, least(end_pos + 1500, length) end_pos, name from targets t join contigs c on t.chrom = c.chrom")
def slop(s, d):
    return I.slop(view(s, d, "targets"), view(s, d, "contigs"), 1500)


@query("select t.chrom, start_pos, least(end_pos + cast(floor((end_pos - start_pos) * 0.5) as bigint), length) end_pos, name from targets t join contigs c on t.chrom = c.chrom")
def slop_fraction(s, d):
    return I.slop(view(s, d, "targets"), view(s, d, "contigs"), left=0, right=0.5, fraction=True)


@query(MERGED.format(d=0) + "select chrom, start_pos, end_pos, cast(n as bigint) n from merged")
def merge_intervals(s, d):
    return I.merge_intervals(view(s, d, "targets"), size=8192)


@query(MERGED.format(d=100) + "select chrom, start_pos, end_pos, cast(n as bigint) n from merged")
def mergesort_distance(s, d):
    return I.mergesort(view(s, d, "targets"), 100)


@query(MERGED.replace("from targets", "from (select t.chrom, greatest(start_pos - 100, 0) start_pos, least(end_pos + 100, length) end_pos from targets t join contigs c on t.chrom = c.chrom) p").format(d=0) + "select chrom, start_pos, end_pos from merged")
def pad(s, d):
    return I.pad(view(s, d, "targets"), view(s, d, "contigs"))


@query(MERGED.replace("from targets", "from (select chrom, start_pos, end_pos from targets union all select chrom, start_pos + 50, end_pos + 90 from targets) p").format(d=0) + "select chrom, start_pos, end_pos from merged")
def merge_beds(s, d):
    t = view(s, d, "targets")
    return I.merge_beds([t, t.withColumns({"start_pos": F.col("start_pos") + 50, "end_pos": F.col("end_pos") + 90})])


@query("select chrom, start_pos + 1 start_pos, end_pos, name from targets")
def bed_to_interval_list(s, d):
    return I.bed_to_interval_list(view(s, d, "targets"), view(s, d, "contigs"))


@query("select * from variants v where exists (select 1 from targets t where t.chrom = v.chrom and v.pos - 1 >= t.start_pos and v.pos - 1 < t.end_pos)")
def restrict_to_targets(s, d):
    return I.restrict_to_targets(view(s, d, "variants"), view(s, d, "targets"))


@query("select a.qname, a.chrom, a.start_pos, a.end_pos, t.name r_name from alignments a join targets t on a.chrom = t.chrom and a.start_pos < t.end_pos and t.start_pos < a.end_pos where a.flag & 1796 = 0")
def interval_join(s, d):
    return I.interval_join(D.read_filter(view(s, d, "alignments")), view(s, d, "targets")).select("qname", "chrom", "start_pos", "end_pos", "r_name")


# --- depth -------------------------------------------------------------------


@query("select * from alignments where flag & 1796 = 0 and flag & 2 = 2 and mapq >= 20 and chrom = 'chr2'")
def read_filter(s, d):
    return D.read_filter(view(s, d, "alignments"), include=2, mapq=20, chrom="chr2")


@query("select sample, qname, flag, tlen from sam where flag & 4 = 0 and abs(case when flag & 16 = 16 then -tlen else tlen end) between 200 and 350 and case flag & 65 when 65 then 'first' else 'second' end = 'first'")
def read_filter_of_templates(s, d):
    """Lengths of templates, of either sign, and read groups."""
    first = F.when(F.col("flag").bitwiseAND(F.lit(65)) == 65, "first").otherwise("second")
    reads = view(s, d, "sam").withColumns({"tlen": F.when(F.col("flag").bitwiseAND(F.lit(16)) == 16, -F.col("tlen")).otherwise(F.col("tlen")), "read_group": first})
    return D.read_filter(reads, skip=4, length=(200, 350), read_groups=["first", "other"]).select("sample", "qname", "flag", F.abs("tlen").alias("tlen"))


@query(runs_sql("select chrom, start_pos, end_pos, depth from pos_runs"))
def per_base_depth(s, d):
    return D.per_base_depth(_good(s, d), size=16_384)


@query(runs_sql("select chrom, start_pos, end_pos, depth from zruns"))
def per_base_depth_with_zero(s, d):
    return D.per_base_depth(_good(s, d), view(s, d, "contigs"), size=16_384)


@query(runs_sql(""", q as (select *, case when depth >= 50 then '50:inf' when depth >= 10 then '10:50' when depth >= 1 then '1:10' else '0:1' end k from zruns),
h as (select *, case when lag(k) over (partition by chrom order by start_pos) = k then 0 else 1 end n from q), i as (select *, sum(n) over (partition by chrom order by start_pos) g from h)
select chrom, k as class, min(start_pos) start_pos, max(end_pos) end_pos from i group by chrom, k, g"""))
def quantize_depth(s, d):
    return D.quantize_depth(D.per_base_depth(_good(s, d), view(s, d, "contigs")), [0, 1, 10, 50]).select("chrom", "class", "start_pos", "end_pos")


@query(""", x as (select chrom, substr(qname, 1, position('_' in qname) - 1) qname, start_pos, end_pos from alignments),
f as (select *, max(end_pos) over (partition by chrom, qname order by start_pos, end_pos rows between unbounded preceding and 1 preceding) m from x),
g as (select *, sum(case when start_pos <= m then 0 else 1 end) over (partition by chrom, qname order by start_pos, end_pos rows unbounded preceding) k from f)
select chrom, qname, min(start_pos) start_pos, max(end_pos) end_pos from g group by chrom, qname, k""")
def mate_overlap_correct(s, d):
    return D.mate_overlap_correct(view(s, d, "alignments").select("chrom", F.substring_index("qname", "_", 1).alias("qname"), "start_pos", "end_pos"))


@query(runs_sql("select cast(sum(case when depth >= 10 then end_pos - start_pos else 0 end) as bigint) callable_bases, round(sum(case when depth >= 10 then end_pos - start_pos else 0 end) / 1e6, 6) callable_mb from zruns"))
def callable_bases(s, d):
    return r6(D.callable_bases(D.per_base_depth(_good(s, d), view(s, d, "contigs")), 10), "callable_mb")


DEPTH_SUMMARY = """, ds as (select chrom, cast(sum(end_pos - start_pos) as bigint) length, cast(sum((end_pos - start_pos) * depth) as bigint) bases, min(depth) "min", max(depth) "max" from zruns group by chrom
union all select 'total', cast(sum(end_pos - start_pos) as bigint), cast(sum((end_pos - start_pos) * depth) as bigint), min(depth), max(depth) from zruns) """


@query(runs_sql(DEPTH_SUMMARY + 'select chrom, length, bases, round(bases / length, 6) mean, "min", "max" from ds'))
def depth_summary(s, d):
    return r6(D.depth_summary(D.per_base_depth(_good(s, d), view(s, d, "contigs"))), "mean")


@query(MERGED.format(d=0) + runs_sql(DEPTH_SUMMARY + """, gm as (select m.chrom, least(m.end_pos, r.end_pos) - greatest(m.start_pos, r.start_pos) n, depth from merged m join zruns r on m.chrom = r.chrom and m.start_pos < r.end_pos and r.start_pos < m.end_pos),
rs as (select chrom, cast(sum(n) as bigint) length, cast(sum(n * depth) as bigint) bases, min(depth) "min", max(depth) "max" from gm group by chrom union all select 'total', cast(sum(n) as bigint), cast(sum(n * depth) as bigint), min(depth), max(depth) from gm)
select chrom, length, bases, round(bases / length, 6) mean, "min", "max" from ds union all select concat(chrom, '_region'), length, bases, round(bases / length, 6), "min", "max" from rs"""))
def depth_summary_regions(s, d):
    return r6(D.depth_summary(D.per_base_depth(_good(s, d), view(s, d, "contigs")), view(s, d, "targets")), "mean")


@query(runs_sql(DEPTH_SUMMARY + """, b as (select max(case when chrom = 'total' then length end) t, sum(case when chrom <> 'total' and bases / length >= 5 then bases else 0 end) c from ds)
select cast(t as bigint) total_bases, cast(c as bigint) callable_bases, round(c / 1e6, 2) callable_mb, round(100.0 * c / t, 2) callable_pct from b"""))
def callable_summary(s, d):
    return D.callable_summary(D.depth_summary(D.per_base_depth(_good(s, d), view(s, d, "contigs"))), 5)


@query(runs_sql(DEPTH_SUMMARY + """, b as (select (select max(length) from ds where chrom = 'total') t, (select sum(case when depth >= 5 then end_pos - start_pos else 0 end) from zruns) c)
select cast(t as bigint) total_bases, cast(c as bigint) callable_bases, round(c / 1e6, 2) callable_mb, round(100.0 * c / t, 2) callable_pct from b"""))
def callable_summary_by_bases(s, d):
    """The number of callable bases itself, instead of contigs by their mean."""
    depth = D.per_base_depth(_good(s, d), view(s, d, "contigs"))
    return D.callable_summary(D.depth_summary(depth), 5, D.callable_bases(depth, 5))


@query(runs_sql("select cast(coalesce(sum(least(t.end_pos, r.end_pos) - greatest(t.start_pos, r.start_pos)), 0) as bigint) callable_bases from targets t join pos_runs r on t.chrom = r.chrom and t.start_pos < r.end_pos and r.start_pos < t.end_pos where depth >= 10"))
def callable_in_bed(s, d):
    return D.callable_in_bed(D.per_base_depth(_good(s, d)), view(s, d, "targets"))


@query(""", m as (select distinct chrom, p from (select chrom, unnest(range(start_pos, end_pos)) p from targets) t),
a as (select m.chrom, m.p, count(x.chrom) n, count(case when x.mapq >= 20 then 1 end) g from m left join alignments x on x.chrom = m.chrom and x.start_pos <= m.p and m.p < x.end_pos and x.flag & 1796 = 0 group by 1, 2),
c as (select chrom, p, case when n = 0 then 'NO_COVERAGE' when g < 0.5 * n then 'POOR_MAPPING_QUALITY' when g < 5 then 'LOW_COVERAGE' else 'CALLABLE' end k from a)
select k as state, cast(count(*) as bigint) n from c group by k""")
def callable_loci(s, d):
    reads = D.read_filter(view(s, d, "alignments")).select("chrom", "start_pos", "end_pos", "mapq")
    return D.loci_counts(D.callable_loci(reads, F.col("mapq") >= 20, view(s, d, "targets"), min_depth=5, size=16_384))


@query(runs_sql("""select 'CALLABLE' state, cast(sum(case when depth >= 5 then end_pos - start_pos else 0 end) as bigint) bases, round(sum(case when depth >= 5 then end_pos - start_pos else 0 end) / 1e6, 6) mb from zruns"""))
def loci_summary_value(s, d):
    n = D.callable_bases(D.per_base_depth(_good(s, d), view(s, d, "contigs")), 5)
    lines = n.select(F.explode(F.array(F.lit("state n"), F.concat(F.lit("  CALLABLE   "), "callable_bases"), F.lit("NO_COVERAGE 1"))).alias("value"))
    return r6(D.loci_summary_value(lines), "mb").select(F.lit("CALLABLE").alias("state"), "bases", "mb")


@query(runs_sql(""", h as (select chrom, depth, sum(end_pos - start_pos) n from zruns group by 1, 2 union all select 'total', depth, sum(end_pos - start_pos) from zruns group by 2)
select a.chrom, a.depth, round(sum(b.n) / (select sum(c.n) from h c where c.chrom = a.chrom), 6) share from h a join h b on a.chrom = b.chrom and b.depth >= a.depth group by 1, 2"""))
def depth_distribution(s, d):
    return r6(D.depth_distribution(D.per_base_depth(_good(s, d), view(s, d, "contigs"))), "share")


REGION = """, o as (select t.chrom, t.start_pos, t.end_pos, t.name, depth, least(t.end_pos, r.end_pos) - greatest(t.start_pos, r.start_pos) n from targets t join zruns r on t.chrom = r.chrom and t.start_pos < r.end_pos and r.start_pos < t.end_pos) """


@query(runs_sql(REGION + "select chrom, start_pos, end_pos, name, round(sum(depth * n) / (end_pos - start_pos), 6) depth from o group by 1, 2, 3, 4"))
def region_depth(s, d):
    return r6(D.region_depth(view(s, d, "targets"), D.per_base_depth(_good(s, d))), "depth")


@query(runs_sql(REGION + ", p as (select *, sum(n) over (partition by chrom, start_pos, end_pos, name order by depth) u from (select chrom, start_pos, end_pos, name, depth, sum(n) n from o group by 1, 2, 3, 4, 5) t) select chrom, start_pos, end_pos, name, cast(min(case when 2 * u >= end_pos - start_pos then depth end) as double) depth from p group by 1, 2, 3, 4"))
def region_median_depth(s, d):
    return D.region_depth(view(s, d, "targets"), D.per_base_depth(_good(s, d)), median=True)


@query(runs_sql(", w as (select chrom, length, unnest(range(0, length, 7000)) s from contigs), o as (select w.chrom, s, least(s + 7000, length) e, depth, least(least(s + 7000, length), r.end_pos) - greatest(s, r.start_pos) n from w join zruns r on w.chrom = r.chrom and s < r.end_pos and r.start_pos < least(s + 7000, length)) select chrom, cast(s as bigint) start_pos, cast(e as bigint) end_pos, round(sum(depth * n) / (e - s), 6) depth from o group by 1, 2, 3, e, s"))
def window_depth(s, d):
    return r6(D.window_depth(view(s, d, "contigs"), D.per_base_depth(_good(s, d)), 7000), "depth")


@query(runs_sql(REGION + "select chrom, start_pos, end_pos, name, cast(sum(case when depth >= 1 then n else 0 end) as bigint) ge_1, cast(sum(case when depth >= 8 then n else 0 end) as bigint) ge_8 from o group by 1, 2, 3, 4"))
def region_thresholds(s, d):
    return D.region_thresholds(view(s, d, "targets"), D.per_base_depth(_good(s, d)), [1, 8])


# --- variants ----------------------------------------------------------------

TYPE = "case when length(ref) = 1 and length(alt) = 1 then 'SNV' when length(ref) < length(alt) then 'INSERTION' when length(ref) > length(alt) then 'DELETION' else 'COMPLEX' end"
CSQ = "case " + " ".join(f"when pos % 9 = {i} then '{e}'" for i, e in enumerate(("missense_variant", "stop_gained", "frameshift_variant", "synonymous_variant", "splice_region_variant", "intron_variant", "intergenic_variant", "inframe_insertion", "inframe_deletion"))) + " end"


@query(f"select chrom, pos, ref, alt, {TYPE} \"type\" from variants")
def variant_type(s, d):
    return V.typed(_variants(s, d)).select("chrom", "pos", "ref", "alt", "type")


@query("select chrom, pos, ref, alt, cast(50 as double) qual, filt as filter, cast(dp as int) dp, cast(dp - ad_alt as int) ad_ref, cast(ad_alt as int) ad_alt from variants")
def genotype_fields(s, d):
    return V.sample_fields(_parsed(s, d), "s1").select("chrom", "pos", "ref", "alt", "qual", "filter", "dp", "ad_ref", "ad_alt")


@query("select chrom, pos, alt, round(case when dp = 0 then 0.0 else ad_alt * 1.0 / dp end, 6) vaf from variants")
def vaf(s, d):
    return r6(view(s, d, "variants").withColumn("vaf", G.vaf(F.col("ad_alt"), F.col("dp"))).select("chrom", "pos", "alt", "vaf"), "vaf")


@query(f"select chrom, pos, filt = 'PASS' is_pass, pos % 9 in (0, 1, 2, 3, 7, 8) is_coding, pos % 9 in (0, 1, 2, 7, 8) is_nonsynonymous, {CSQ} effect from variants")
def effect_flags(s, d):
    e = G.csq_effect(F.col("info")["CSQ"])
    return _parsed(s, d).select("chrom", "pos", (F.col("filter") == "PASS").alias("is_pass"), G.is_coding(e).alias("is_coding"), G.is_nonsynonymous(e).alias("is_nonsynonymous"), e.alias("effect"))


@query("select chrom, pos, ref, alt from variants where filt = 'PASS' and length(alt) <> length(ref) and exists (select 1 from targets t where t.chrom = variants.chrom and pos - 1 >= t.start_pos and pos - 1 < t.end_pos)")
def view_variants(s, d):
    return V.view_variants(_parsed(s, d), view(s, d, "targets"), True, True, ["s1"], "indels").select("chrom", "pos", "ref", "alt")


@query("select chrom, pos, alt from variants where filt = 'PASS'")
def filter_pass(s, d):
    return V.filter_pass(_variants(s, d)).select("chrom", "pos", "alt")


@query("select chrom, pos, alt from variants where not (pos % 3 = 0)")
def filter_biallelic(s, d):
    v = _variants(s, d).withColumn("alt2", F.when(F.col("pos") % 3 == 0, F.concat("alt", F.lit(",T"))).otherwise(F.col("alt")))
    return V.filter_biallelic(v.drop("alt").withColumnRenamed("alt2", "alt")).select("chrom", "pos", "alt")


@query("select chrom, pos, case when pos % 2 = 0 then 1 else 0 end n from variants")
def select_samples(s, d):
    v = _parsed(s, d).withColumn("samples", F.transform("samples", lambda x: F.struct(F.when(F.col("pos") % 2 == 0, "a").otherwise("b").alias("name"), x["fmt"].alias("fmt"))))
    return V.select_samples(v, ["a", "z"]).select("chrom", "pos", F.size("samples").alias("n"))


@query("select chrom, pos, case when pos % 3 = 2 then 's9' else 's1,s9' end names from variants")
def select_samples_of_several(s, d):
    """Three samples a row, whose names differ from row to row."""
    n = F.col("pos") % 3
    three = F.transform(F.array(F.concat(F.lit("s"), n), F.concat(F.lit("s"), n + 1), F.lit("s9")), lambda x: F.struct(x.alias("name"), F.col("samples")[0]["fmt"].alias("fmt")))
    return V.select_samples(_parsed(s, d).withColumn("samples", three), ["s9", "s1", "s7"]).select("chrom", "pos", F.array_join("samples.name", ",").alias("names"))


@query(f"select chrom, pos, alt from variants where {TYPE} = 'SNV'")
def filter_variant_type(s, d):
    return V.filter_variant_type(_variants(s, d), "snps").select("chrom", "pos", "alt")


@query(f"select chrom, pos, ref, alt from (select chrom, pos, case when pos % 4 = 0 then concat(ref, 'A') else ref end ref, case when pos % 4 = 0 then concat(alt, 'T') else alt end alt from variants) v where {TYPE} in ('COMPLEX', 'INSERTION', 'DELETION')")
def filter_variant_kinds(s, d):
    """Several kinds at once, with substitutions of two bases among the variants."""
    longer = F.col("pos") % 4 == 0
    v = _variants(s, d).withColumns({"ref": F.when(longer, F.concat("ref", F.lit("A"))).otherwise(F.col("ref")), "alt": F.when(longer, F.concat("alt", F.lit("T"))).otherwise(F.col("alt"))})
    return V.filter_variant_type(v, "indels, mnps").select("chrom", "pos", "ref", "alt")


@query("select chrom, pos, dp from variants where not (dp < 20 or ad_alt < 2)")
def filter_expr(s, d):
    return V.filter_expr(_variants(s, d), exclude="dp < 20 or ad_alt < 2").select("chrom", "pos", "dp")


@query("select chrom, pos, dp from variants where dp >= 20 and (ad_alt % 2 = 1 or filt <> 'PASS')")
def filter_expr_include(s, d):
    return V.filter_expr(_variants(s, d), include="dp >= 20 and (ad_alt % 2 = 1 or filter <> 'PASS')").select("chrom", "pos", "dp")


@query(f"select chrom, pos, ref, alt, dp, ad_alt from variants where filt = 'PASS' and {TYPE} in ('SNV', 'INSERTION', 'DELETION') and dp >= 10 and ad_alt >= 3 and ad_alt * 1.0 / dp >= 0.05")
def hard_filter(s, d):
    return V.hard_filter(_parsed(s, d), sample="s1").select("chrom", "pos", "ref", "alt", "dp", "ad_alt")


@query(f"select chrom, pos, ref, alt, dp, ad_alt from variants v where filt = 'PASS' and {TYPE} in ('SNV', 'INSERTION', 'DELETION') and dp >= 20 and ad_alt >= 5 and ad_alt * 1.0 / dp >= 0.1 and exists (select 1 from targets t where t.chrom = v.chrom and v.pos - 1 >= t.start_pos and v.pos - 1 < t.end_pos)")
def hard_filter_on_targets(s, d):
    """Own thresholds, and only what lies in a target."""
    thresholds = V.HardFilterThresholds(min_dp=20, min_ad=5, min_vaf=0.1)
    return V.hard_filter(_parsed(s, d), view(s, d, "targets"), "s1", thresholds).select("chrom", "pos", "ref", "alt", "dp", "ad_alt")


@query("select chrom, pos, alt, dp, ad_alt from variants where filt = 'PASS' and dp >= 10 and ad_alt >= 3 and ad_alt * 1.0 / dp >= 0.2")
def filter_quality(s, d):
    return V.filter_quality(_variants(s, d), min_vaf=0.2).select("chrom", "pos", "alt", "dp", "ad_alt")


@query(f"select filt as filter, cast(count(*) as bigint) n_total, cast(sum(case when {TYPE} = 'SNV' then 1 else 0 end) as bigint) n_snv, cast(sum(case when {TYPE} in ('INSERTION', 'DELETION') then 1 else 0 end) as bigint) n_indel from variants group by 1")
def variant_counts(s, d):
    return V.variant_counts(_variants(s, d), ("filter",))


_EFF = ", ".join(f"cast(sum(case when pos % 9 = {i} then 1 else 0 end) as bigint) {n}" for i, n in enumerate(V.EFFECTS))


@query(f"select cast(count(*) + sum(case when pos % 50 = 0 then 1 else 0 end) as bigint) total, cast(sum(case when pos % 9 <= 3 then 1 else 0 end) as bigint) coding, cast(sum(case when pos % 9 <= 2 then 1 else 0 end) as bigint) nonsynonymous, {_EFF} from variants")
def effect_counts(s, d):
    """Lines as in a file, with a header and short lines among them."""
    lines = view(s, d, "vcf_lines")
    short = view(s, d, "variants").where("pos % 50 = 0").select(F.concat_ws("\t", "chrom", "pos").alias("value"))
    lines = lines.unionByName(short).unionByName(lines.limit(1).select(F.lit("##header").alias("value")))
    return V.effect_counts(formats.consequence_lines(lines), csq=F.col("csq"))


@query(f", e as (select filt as sample, cast(count(*) as bigint) total, cast(sum(case when pos % 9 <= 3 then 1 else 0 end) as bigint) coding, cast(sum(case when pos % 9 <= 2 then 1 else 0 end) as bigint) nonsynonymous, {_EFF} from variants group by 1) " + " union all ".join(f"select sample, '{n}' metric, {n} as value from e" for n in ("total", "coding", "nonsynonymous", *V.EFFECTS)))
def variant_summary(s, d):
    return V.variant_summary(_parsed(s, d).withColumnRenamed("filter", "sample"))


@query(f""", c as (select chrom, cast(count(*) as bigint) n_total, cast(sum(case when {TYPE} = 'SNV' then 1 else 0 end) as bigint) n_snv, cast(sum(case when {TYPE} in ('INSERTION', 'DELETION') then 1 else 0 end) as bigint) n_indel from variants group by 1)
select c.chrom, n_total, n_snv, n_indel, round(length / 1e6, 6) callable_mb, round(n_total / (length / 1e6), 6) load, round(n_snv / (length / 1e6), 6) snv_load, round(n_indel / (length / 1e6), 6) indel_load from c join contigs on c.chrom = contigs.chrom""")
def mutational_load(s, d):
    mb = view(s, d, "contigs").select("chrom", (F.col("length") / 1e6).alias("callable_mb"))
    return r6(V.mutational_load(V.variant_counts(_variants(s, d), ("chrom",)), mb, "chrom"), "callable_mb", "load", "snv_load", "indel_load")


@query("select chrom, pos, '2' an, '1' ac, '0.5' af, '1' ns from variants")
def fill_tags(s, d):
    v = V.fill_tags(_parsed(s, d), ["AN", "AC", "AF", "NS"])
    return v.select("chrom", "pos", *[F.col("info")[t].alias(t.lower()) for t in ("AN", "AC", "AF", "NS")])


_GENOTYPES = "case when (pos * 7 + j * (pos % 5 + 1) * 13) % 11 < 3 then '0/0' when (pos * 7 + j * (pos % 5 + 1) * 13) % 11 < 6 then '0|1' when (pos * 7 + j * (pos % 5 + 1) * 13) % 11 < 8 then '1/1' when (pos * 7 + j * (pos % 5 + 1) * 13) % 11 = 8 then '1/2' when (pos * 7 + j * (pos % 5 + 1) * 13) % 11 = 9 then './.' else '1' end"


def _tags_sql() -> str:
    """Of 30 samples and two alternatives; probabilities by factorials of all counts."""
    n = lambda *g: " + ".join(f"len(list_filter(g, lambda x: x = '{x}'))" for x in g)
    counts = f"select chrom, pos, alt, {n('0/0')} c00, {n('0|1')} c01, {n('1/1')} c11, {n('1/2')} c12, {n('./.')} miss, {n('1')} hemi from (select chrom, pos, alt, list_transform(range(1, 31), lambda j: {_GENOTYPES}) g from variants)"
    one = lambda i, het, hom, other: f"{het} het{i}, {hom} hom{i}, {other} oth{i}, 2 * least({hom}, {other}) + {het} rare{i}"
    law = lambda i, h: f"exp(lgamma(n + 1) - lgamma(({'rare' + i} - {h}) // 2 + 1) - lgamma({h} + 1) - lgamma(n - {h} - ({'rare' + i} - {h}) // 2 + 1) + {h} * ln(2) + lgamma({'rare' + i} + 1) + lgamma(2 * n - {'rare' + i} + 1) - lgamma(2 * n + 1))"
    p = lambda i: f"list_transform(range(rare{i} % 2, rare{i} + 1, 2), lambda h: {law(i, 'h')})"
    out = ", ".join(f"list_sum(list_filter({p(i)}, lambda x: x <= {law(i, 'het' + i)} * (1 + 1e-9))) hwe{i}, list_sum(list_transform(range(het{i}, rare{i} + 1, 2), lambda h: {law(i, 'h')})) exc{i}" for i in "12")
    return f""", gc as ({counts}), gd as (select *, c00 + c01 + c11 + c12 n, 2 * (c00 + c01 + c11 + c12) + hemi an, 2 * c11 + c01 + c12 + hemi ac1, c12 ac2, 2 * c00 + c01 ac0, {one('1', 'c01 + c12', 'c11', 'c00')}, {one('2', 'c12', '0', '(c00 + c01 + c11)')} from gc),
gp as (select *, {out} from gd) select chrom, pos, alt, cast(an as string) an, cast(30 - miss as string) ns, concat(ac1, ',', ac2) ac, concat(het1, ',', het2) ac_het, concat(2 * hom1, ',', 2 * hom2) ac_hom, concat(hemi, ',0') ac_hemi, round(list_sort([ac0, ac1, ac2], 'desc')[2] / an, 6) maf,
round(miss / 30, 6) f_missing, round(ac1 / an, 6) af1, round(ac2 / an, 6) af2, round(hwe1, 6) hwe1, round(hwe2, 6) hwe2, round(exc1, 6) exc1, round(exc2, 6) exc2 from gp"""


@query(_tags_sql())
def fill_tags_cohort(s, d):
    """Genotypes of 30 samples, with two alternatives, missing and haploid calls."""
    samples = F.expr(f"transform(sequence(1, 30), j -> named_struct('name', cast(j as string), 'fmt', map('GT', {_GENOTYPES})))")
    v = _parsed(s, d).withColumn("own", F.col("alt")).withColumns({"samples": samples, "alt": F.concat("alt", F.lit(",T"))})
    v = V.fill_tags(v, list(V.TAGS))
    part = lambda t, i: F.get(F.split(F.col("info")[t], ","), i).cast("double")
    return v.select(
        "chrom", "pos", F.col("own").alias("alt"), *[F.col("info")[t].alias(t.lower()) for t in ("AN", "NS", "AC", "AC_Het", "AC_Hom", "AC_Hemi")], part("MAF", 0).alias("maf"), part("F_MISSING", 0).alias("f_missing"),
        *[part(t, i).alias(f"{n}{i + 1}") for t, n in (("AF", "af"), ("HWE", "hwe"), ("ExcHet", "exc")) for i in (0, 1)],
    )


@query("select * from variants v where not exists (select 1 from variants k where k.filt = 'germline' and k.chrom = v.chrom and k.pos = v.pos)")
def known_sites_anti(s, d):
    v = view(s, d, "variants")
    return V.known_sites_anti(v, v.where("filt = 'germline'"))


@query("""select v.chrom, v.pos, v.ref, v.alt, coalesce(case when v.pos % 2 = 0 then concat('G', cast(v.pos % 50 as string)) end, min(t.name)) gene,
case when v.pos % 2 = 0 then 'known' when min(t.name) is not null then 'within_gene' end effect from (select distinct chrom, pos, ref, alt from variants) v left join targets t on t.chrom = v.chrom and v.pos - 1 >= t.start_pos and v.pos - 1 < t.end_pos group by 1, 2, 3, 4""")
def annotation_join(s, d):
    v = view(s, d, "variants").select("chrom", "pos", "ref", "alt").distinct()
    known = v.where("pos % 2 = 0").select("*", F.concat(F.lit("G"), (F.col("pos") % 50).cast("string")).alias("gene"), F.lit("known").alias("effect"))
    return V.annotation_join(v, known, view(s, d, "targets")).select("chrom", "pos", "ref", "alt", "gene", "effect")


# --- reads before alignment --------------------------------------------------


@query("select rec, substr(split_part(split_part(header, ' ', 1), '/', 1), 2) id from fastq")
def read_id(s, d):
    return view(s, d, "fastq").select("rec", G.read_id(F.col("header")).alias("id"))


_ERRORS = "concat_ws('|', case when header not like '@%' then concat('record ', cast(rec + 1 as string), ': header does not start with @') end, case when plus not like '+%' then concat('record ', cast(rec + 1 as string), ': separator does not start with +') end, case when length(seq) <> length(qual) then concat('record ', cast(rec + 1 as string), ': sequence and quality differ in length') end)"


@query(f"select rec, {_ERRORS} errors from (select rec, case when rec % 61 = 0 then substr(header, 2) else header end header, seq, plus, qual from fastq2) f where {_ERRORS} <> ''")
def fastq_validate(s, d):
    f = view(s, d, "fastq2").withColumn("header", F.expr("case when rec % 61 = 0 then substr(header, 2) else header end"))
    return Q.with_errors(f).select("rec", F.array_join("errors", "|").alias("errors")).where("errors <> ''")


@query("select rec, header from fastq where rec < 500")
def head_records(s, d):
    return Q.head_records(view(s, d, "fastq"), 500).select("rec", "header")


@query("select rec, concat('q', cast(rec as string)) id1, concat('x', cast(rec as string)) id2 from fastq where rec % 101 = 0")
def pair_reads(s, d):
    return Q.pair_reads(view(s, d, "fastq"), view(s, d, "fastq2")).where("id1 <> id2")


@query(""", m as (select count(*) c from fastq where rec % 101 = 0 and rec < 10000), e as (select count(*) c from fastq2 where rec < 10000 and (plus not like '+%' or length(seq) <> length(qual)))
select case when e.c = 0 then 'PASS' else 'FAIL' end status, cast((select count(*) from fastq where rec < 10000) as bigint) records_checked, e.c = 0 format_ok, m.c = 0 ids_match, cast(m.c as bigint) mismatches,
(select string_agg(x, '|' order by rec) from (select rec, """ + _ERRORS + """ x from fastq2 where rec < 10000 and """ + _ERRORS + """ <> '' order by rec limit 20) t) errors,
(select string_agg(concat('ID mismatch at record ', cast(rec + 1 as string), ': q', cast(rec as string), ' != x', cast(rec as string)), '|' order by rec) from (select rec from fastq where rec % 101 = 0 and rec < 10000 order by rec limit 5) t) warnings from m, e""")
def fastq_check(s, d):
    return Q.fastq_check(view(s, d, "fastq"), view(s, d, "fastq2")).withColumns({c: F.array_join(c, "|") for c in ("errors", "warnings")})


CLEAN = """, c as (select rec, seq, qual, length(seq) - length(replace(seq, 'N', '')) n, length(qual) - length(regexp_replace(qual, '[!-/]', '', 'g')) bad from fastq),
k as (select *, case when 100 * bad > 40 * length(qual) then 'low_quality' when n > 2 then 'too_many_N' else 'passed' end reason from c) """


@query(CLEAN + "select reason, cast(count(*) as bigint) n from k group by 1")
def read_clean(s, d):
    return Q.filter_reasons(Q.read_clean(view(s, d, "fastq"), n_limit=2, poly_g=0))


_ADAPTER, _POLY = "ACGTACGT", 3
#: The rules one after the other: adapter, quality window, poly-G, the four limits, copies.
CLEAN_ALL = f""", a as (select rec, seq, qual, case when position('{_ADAPTER}' in seq) > 0 then position('{_ADAPTER}' in seq) - 1
{" ".join(f"when right(seq, {k}) = '{_ADAPTER[:k]}' then length(seq) - {k}" for k in range(len(_ADAPTER) - 1, 3, -1))} else length(seq) end e1 from fastq),
w as (select rec, min(i) k from (select rec, i from fastq, range(1, 30) r(i) where (select sum(ascii(substr(qual, cast(i + j as int), 1)) - 33) from range(0, 4) x(j)) < 4 * 12) t group by rec),
c1 as (select a.rec, substr(seq, 1, cast(least(e1, coalesce(k - 1, length(qual))) as int)) seq, substr(qual, 1, cast(least(e1, coalesce(k - 1, length(qual))) as int)) qual from a left join w on a.rec = w.rec),
c2 as (select rec, regexp_replace(seq, 'G{{{_POLY},}}$', '') seq, substr(qual, 1, length(regexp_replace(seq, 'G{{{_POLY},}}$', ''))) qual from c1),
c3 as (select rec, seq, qual, case when 100 * (length(qual) - length(regexp_replace(qual, '[!-/]', '', 'g'))) > 40 * length(qual) then 'low_quality' when length(seq) - length(replace(seq, 'N', '')) > 2 then 'too_many_N' when length(seq) < 6 then 'too_short' else 'passed' end reason from c2),
c4 as (select rec, seq, qual, case when reason = 'passed' and row_number() over (partition by seq, reason order by rec) > 1 then 'duplicated' else reason end reason from c3) """


@query(CLEAN_ALL + "select rec, seq, qual, reason from c4")
def read_clean_all_rules(s, d):
    return Q.read_clean(view(s, d, "fastq"), adapter=_ADAPTER, poly_g=_POLY, cut_window=4, cut_mean=12, n_limit=2, min_length=6, dedup=True).select("rec", "seq", "qual", "reason")


_TOTALS = "cast(count(*) as bigint) \"reads\", cast(sum(length(seq)) as bigint) bases, cast(sum(length(regexp_replace(qual, '[!-4]', '', 'g'))) as bigint) q20_bases, cast(sum(length(regexp_replace(qual, '[!->]', '', 'g'))) as bigint) q30_bases, cast(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) as bigint) gc_bases"


@query(CLEAN + f", t as (select 'before' stage, {_TOTALS} from k union all select 'after', {_TOTALS} from k where reason = 'passed') select *, round(q20_bases / bases, 6) q20_rate, round(q30_bases / bases, 6) q30_rate, round(gc_bases / bases, 6) gc_rate from t")
def read_qc(s, d):
    return r6(Q.read_qc(view(s, d, "fastq"), n_limit=2, poly_g=0), "q20_rate", "q30_rate", "gc_rate")


@query("select cast(count(*) as bigint) \"reads\", cast(count(distinct seq) as bigint) \"distinct\", round(1 - count(distinct seq) / count(*), 6) rate from fastq")
def duplication_rate(s, d):
    return r6(Q.duplication_rate(view(s, d, "fastq")), "rate")


@query(", e as (select i as cycle, ascii(substr(qual, cast(i as int), 1)) - 33 q from fastq, range(1, 33) r(i)) select cast(cycle as int) cycle, round(avg(q), 6) mean, cast(quantile_disc(q, 0.25) as int) lower_quartile, cast(quantile_disc(q, 0.5) as int) median, cast(quantile_disc(q, 0.75) as int) upper_quartile from e group by 1")
def per_cycle_quality(s, d):
    return r6(Q.per_cycle_quality(view(s, d, "fastq")), "mean").select("cycle", "mean", "lower_quartile", "median", "upper_quartile")


@query(", e as (select rec, sum(ascii(substr(qual, cast(i as int), 1)) - 33) q from fastq, range(1, 33) r(i) group by 1) select cast(floor(q / 32) as int) quality, cast(count(*) as bigint) n from e group by 1")
def mean_quality_histogram(s, d):
    return Q.mean_quality_histogram(view(s, d, "fastq"))


@query(""", e as (select i as cycle, rec, substr(seq, cast(i as int), 1) b, ascii(substr(qual, cast(i as int), 1)) - 33 q from fastq, range(1, 33) r(i)),
q as (select min(lo) lo, min(mid) mid from (select quantile_disc(q, 0.25) lo, quantile_disc(q, 0.5) mid from e group by cycle) t),
m as (select k from (select floor(q / 32) k, count(*) n from (select rec, sum(q) q from e group by rec) t group by 1 order by n desc, k limit 1) t),
c as (select sum(case when b = 'A' then 1 else 0 end) a, sum(case when b = 'C' then 1 else 0 end) c, sum(case when b = 'G' then 1 else 0 end) g, sum(case when b = 'T' then 1 else 0 end) t, sum(case when b = 'N' then 1 else 0 end) n from e group by cycle),
x as (select max(greatest(abs(a - t), abs(g - c)) / (a + c + g + t)) gap, max(n / (a + c + g + t + n)) n from c), d as (select 1 - count(distinct seq) / count(*) rate, min(length(seq)) lo, max(length(seq)) hi, sum(case when position('ACGTAC' in seq) > 0 then 1 else 0 end) / count(*) ad from fastq)
select 'per_base_sequence_quality' "module", case when lo < 5 or mid < 20 then 'FAIL' when lo < 10 or mid < 25 then 'WARN' else 'PASS' end status from q
union all select 'per_sequence_quality_scores', case when k < 20 then 'FAIL' when k < 27 then 'WARN' else 'PASS' end from m
union all select 'per_base_sequence_content', case when gap > 0.2 then 'FAIL' when gap > 0.1 then 'WARN' else 'PASS' end from x
union all select 'per_base_n_content', case when n > 0.2 then 'FAIL' when n > 0.05 then 'WARN' else 'PASS' end from x
union all select 'sequence_duplication_levels', case when rate > 0.5 then 'FAIL' when rate > 0.2 then 'WARN' else 'PASS' end from d
union all select 'sequence_length_distribution', case when lo = 0 then 'FAIL' when lo < hi then 'WARN' else 'PASS' end from d
union all select 'adapter_content_x', case when ad > 0.1 then 'FAIL' when ad > 0.05 then 'WARN' else 'PASS' end from d""")
def fastqc_modules(s, d):
    return Q.fastqc_modules(view(s, d, "fastq"), {"x": "ACGTAC"})


@query(CLEAN_ALL + f""", r as (select reason, count(*) n from c4 group by 1) select 'reason' section, reason item, cast(n as bigint) n from r union all select 'adapter', 'trimmed_reads', cast(sum(case when e1 < length(seq) then 1 else 0 end) as bigint) from a
union all select 'adapter', 'trimmed_bases', cast(sum(length(seq) - e1) as bigint) from a""")
def cleaning_counts(s, d):
    return Q.cleaning_counts(view(s, d, "fastq"), _ADAPTER, poly_g=_POLY, cut_window=4, cut_mean=12, n_limit=2, min_length=6, dedup=True)


_OVER = ", f5 as (select substr(seq, 1, {k}) sequence, count(*) n from fastq where length(seq) > 0 group by 1), over5 as (select sequence, n, 100 * n / (select sum(n) from f5) percent from f5) "


@query(_OVER.format(k=5) + "select sequence, cast(n as bigint) n, round(percent, 6) percent from over5 where percent > 0.1")
def overrepresented_sequences(s, d):
    """By their first five bases, of which some are rarer than the limit."""
    return r6(Q.overrepresented_sequences(view(s, d, "fastq"), first=5), "percent")


@query("select cast(round(100 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq)) as int) gc, cast(count(*) as bigint) n from fastq group by 1")
def gc_per_sequence(s, d):
    return Q.gc_per_sequence(view(s, d, "fastq"))


_GC_FIT = """, h0 as (select cast(round(100 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq)) as int) gc, count(*) n from fastq group by 1), h as (select i gc, coalesce(n, 0) n from range(0, 101) r(i) left join h0 on gc = i),
mo as (select gc m, n x from h order by n desc, gc limit 1), lo as (select coalesce(max(gc), -1) + 1 v from h, mo where gc < m and 10 * n <= 9 * x), hi as (select coalesce(min(gc), 101) - 1 v from h, mo where gc > m and 10 * n <= 9 * x),
ce as (select case when lo.v = 0 or hi.v = 100 then cast(m as double) else (lo.v + hi.v) / 2 end c from lo, hi, mo), sd as (select sqrt(sum(n * (gc - c) * (gc - c)) / (sum(n) - 1)) s, sum(n) t from h, ce),
fit as (select any_value(c) centre, any_value(s) sd, 100 * sum(abs(n - t * exp(-(gc - c) * (gc - c) / (2 * s * s)) / (s * sqrt(2 * pi())))) / any_value(t) deviation from h, ce, sd) """


@query(_GC_FIT + "select round(centre, 6) centre, round(sd, 6) sd, round(deviation, 6) deviation, case when deviation > 30 then 'FAIL' when deviation > 15 then 'WARN' else 'PASS' end status from fit")
def gc_fit(s, d):
    return r6(Q.gc_fit(view(s, d, "fastq")), "centre", "sd", "deviation")


_ADAPTERS = {"x": "ACGTA", "y": "GGC"}
_BEGUN = ", bg as (" + " union all ".join(f"select '{k}' adapter, position('{v}' in seq) p from fastq" for k, v in _ADAPTERS.items()) + "), ac as (select a.adapter, a.p as cycle, 100 * (select count(*) from bg b where b.adapter = a.adapter and b.p > 0 and b.p <= a.p) / (select count(*) from fastq) percent from (select distinct adapter, p from bg where p > 0) a) "


@query(_BEGUN + "select adapter, cast(cycle as int) as cycle, round(percent, 6) percent from ac")
def adapter_content(s, d):
    return r6(Q.adapter_content(view(s, d, "fastq"), _ADAPTERS), "percent")


@query(_OVER.format(k=4) + _GC_FIT + _BEGUN + """select 'overrepresented_sequences' "module", case when max(percent) > 1 then 'FAIL' when max(percent) > 0.1 then 'WARN' else 'PASS' end status from over5
union all select 'per_sequence_gc_content', case when deviation > 30 then 'FAIL' when deviation > 15 then 'WARN' else 'PASS' end from fit union all select 'adapter_content', case when max(percent) > 10 then 'FAIL' when max(percent) > 5 then 'WARN' else 'PASS' end from ac""")
def fastqc_sequence_modules(s, d):
    return Q.fastqc_sequence_modules(view(s, d, "fastq"), _ADAPTERS, first=4)


# --- alignments --------------------------------------------------------------


_ORDER = "split_part(substr(qname, 2), '_', 1)"


@query(f"select qname, flag, cast(row_number() over (partition by cast({_ORDER} as bigint) // 8 order by cast({_ORDER} as bigint), cast(split_part(qname, '_', 2) as bigint), cast(split_part(qname, '_', 3) as bigint), flag) as int) place from sam")
def sort_alignments(s, d):
    return placed(A.sort_alignments(view(s, d, "sam").repartition(7), "name").select("qname", "flag"), "cast(substring_index(substr(qname, 2), '_', 1) as bigint) div 8")


@query("select qname, chrom, pos, flag, cast(row_number() over (partition by chrom, pos // 4 order by pos, qname, flag) as int) place from sam")
def sort_alignments_by_coordinate(s, d):
    return placed(A.sort_alignments(view(s, d, "sam").repartition(7)).select("qname", "chrom", "pos", "flag"), "chrom", "pos div 4")


@query("select qname, mapq, chrom, pos, flag, cast(row_number() over (partition by mapq, chrom, pos // 16 order by pos, qname, flag) as int) place from sam")
def sort_alignments_by_tag(s, d):
    return placed(A.sort_alignments(view(s, d, "sam").repartition(7), tag="mapq").select("qname", "mapq", "chrom", "pos", "flag"), "mapq", "chrom", "pos div 16")


@query("select qname, flag, cast(row_number() over (partition by substr(qname, 1, 5) order by qname, flag) as int) place from sam")
def sort_alignments_by_ascii_name(s, d):
    return placed(A.sort_alignments(view(s, d, "sam").repartition(7), "ascii").select("qname", "flag"), "substr(qname, 1, 5)")


@query(""", b as (select * from sam where cigar = '32M' union all select * from sam where cigar <> '32M'), x as (
select qname, pos - 1 s, pos - 1 + 32 e, 0 q from b where cigar = '32M' union all select qname, pos - 1, pos - 1 + 27, 5 from b where cigar = '5S27M' union all select qname, pos - 1, pos + 9, 0 from b where cigar = '10M2D20M2S'
union all select qname, pos + 11, pos + 31, 10 from b where cigar = '10M2D20M2S' union all select qname, pos - 1, pos + 11, 0 from b where cigar = '12M3I17M' union all select qname, pos + 11, pos + 28, 15 from b where cigar = '12M3I17M')
select qname, cast(s as bigint) s, cast(e as bigint) e, cast(q as int) q from x""")
def cigar_blocks(s, d):
    return view(s, d, "sam").select("qname", F.explode(G.cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("qname", "b.*")


_FS = ", ".join(f"cast(sum(case when {t} then 1 else 0 end) as bigint) {n}" for n, t in {
    "total": "true", "secondary": "flag & 256 <> 0", "supplementary": "flag & 2048 <> 0", "duplicates": "flag & 1024 <> 0", "paired": "flag & 1 <> 0", "read1": "flag & 64 <> 0", "read2": "flag & 128 <> 0",
    "mapped": "flag & 4 = 0", "properly_paired": "flag & 1 = 1 and flag & 2 = 2 and flag & 4 = 0", "singletons": "flag & 1 = 1 and flag & 4 = 0 and flag & 8 = 8"}.items())


@query(f"select sample, {_FS} from alignments group by 1")
def flagstat(s, d):
    return A.flagstat(view(s, d, "alignments"))


@query("""select sample, 'SN' section, 'raw_total_sequences' bin, cast(count(*) as bigint) n from sam group by 1 union all select sample, 'SN', 'reads_mapped', cast(count(*) as bigint) from sam where flag & 4 = 0 group by 1
union all select sample, 'SN', 'reads_duplicated', cast(0 as bigint) from sam group by 1 union all select sample, 'SN', 'reads_MQ0', cast(count(*) as bigint) from sam where flag & 4 = 0 and mapq = 0 group by 1
union all select sample, 'SN', 'total_length', cast(sum(length(seq)) as bigint) from sam group by 1 union all select sample, 'SN', 'bases_mapped', cast(sum(length(seq)) as bigint) from sam where flag & 4 = 0 group by 1
union all select sample, 'RL', cast(length(seq) as string), cast(count(*) as bigint) from sam group by 1, 3 union all select sample, 'IS', cast(tlen as string), cast(count(*) as bigint) from sam group by 1, 3
union all select sample, 'BQ', cast(ascii(substr(qual, cast(i as int), 1)) - 33 as string), cast(count(*) as bigint) from sam, range(1, 33) r(i) group by 1, 3
union all select sample, 'GC', cast(cast(floor(100 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq)) as bigint) as string), cast(count(*) as bigint) from sam group by 1, 3
union all select sample, 'COV', cast(least(n, 1000) as string), cast(count(*) as bigint) from (select sample, chrom, p, count(*) n from (
select sample, chrom, unnest(range(pos - 1, pos - 1 + case cigar when '32M' then 32 when '5S27M' then 27 when '10M2D20M2S' then 10 else 29 end)) p from sam where flag & 4 = 0
union all select sample, chrom, unnest(range(pos + 11, pos + 31)) from sam where cigar = '10M2D20M2S' and flag & 4 = 0) b group by 1, 2, 3) t group by 1, 3""")
def read_stats(s, d):
    return A.read_stats(view(s, d, "sam"))


@query("""select sample, category, cast(count(*) as bigint) "reads", cast(sum(al) as bigint) aligned, round(sum(al) / count(*), 6) pct_aligned, round(avg(len), 6) mean_read_length, round(sum(nm) / sum(case when al = 1 then len end), 6) mismatch_rate from (
select sample, case when flag & 64 <> 0 then 'FIRST_OF_PAIR' else 'SECOND_OF_PAIR' end category, case when flag & 4 = 0 then 1 else 0 end al, length(seq) len, mapq % 3 nm from sam
union all select sample, 'PAIR', case when flag & 4 = 0 then 1 else 0 end, length(seq), mapq % 3 from sam) t group by 1, 2""")
def alignment_summary(s, d):
    return r6(A.alignment_summary(view(s, d, "sam").withColumn("nm", F.col("mapq") % 3)), "pct_aligned", "mean_read_length", "mismatch_rate")


@query("""select sample, case when flag & 16 <> 0 then 'RF' else 'FR' end orientation, round(median(tlen), 6) median, round(avg(tlen), 6) mean, round(stddev_samp(tlen), 6) sd, cast(min(tlen) as bigint) "min", cast(max(tlen) as bigint) "max", cast(count(*) as bigint) pairs
from sam where flag & 4 = 0 group by 1, 2""")
def insert_size_metrics(s, d):
    return r6(A.insert_size_metrics(view(s, d, "sam")), "median", "mean", "sd")


_HS = MERGED.format(d=0) + runs_sql(""", gm as (select m.chrom, greatest(m.start_pos, r.start_pos) a, least(m.end_pos, r.end_pos) b, depth from merged m join pos_runs r on m.chrom = r.chrom and m.start_pos < r.end_pos and r.start_pos < m.end_pos),
hd as (select depth, sum(b - a) n from gm group by 1), te as (select sum(end_pos - start_pos) t from merged), ze as (select (select t from te) - (select sum(n) from hd) z),
up as (select depth, n, (select z from ze) + sum(n) over (order by depth) u from hd), st as (select sum(depth * n) / (select t from te) mean, coalesce(min(case when 10 * u >= 2 * (select t from te) and 10 * (select z from ze) < 2 * (select t from te) then depth end), 0) p20,
sum(case when depth >= 10 then n else 0 end) / (select t from te) x10, sum(case when depth >= 20 then n else 0 end) / (select t from te) x20, sum(case when depth >= 30 then n else 0 end) / (select t from te) x30 from up),
tg as (select distinct chrom, start_pos, end_pos from targets), hit as (select count(*) n from tg where exists (select 1 from pos_runs r where r.chrom = tg.chrom and tg.start_pos < r.end_pos and r.start_pos < tg.end_pos)) """)


@query(_HS + """select cast((select t from te) as bigint) target_territory, round((select sum(depth * n) from hd) / (select sum(depth * (end_pos - start_pos)) from pos_runs), 6) pct_selected_bases, round(mean, 6) mean_target_coverage, round(mean / nullif(p20, 0), 6) fold_80_base_penalty,
round(1 - (select n from hit) / (select count(*) from tg), 6) zero_cvg_targets_pct, round(x10, 6) pct_target_bases_10x, round(x20, 6) pct_target_bases_20x, round(x30, 6) pct_target_bases_30x from st""")
def hs_metrics(s, d):
    h = A.hs_metrics(_good(s, d), view(s, d, "targets"))
    return r6(h, *[c for c in h.columns if c != "target_territory"])


def _fragments(s, d):
    """Reads with few keys, so that fragments have rivals."""
    sam = view(s, d, "sam").withColumn("qname", F.concat_ws("_", "qname", "chrom", "pos", "mapq"))
    return sam.withColumn("pos", F.col("pos") % 200 + 1)


_DUP = """, r as (select *, pos % 200 + 1 p, case when flag & 16 <> 0 then (pos % 200 + 1) + (case cigar when '32M' then 32 when '5S27M' then 27 when '10M2D20M2S' then 32 else 29 end) - 1 + case cigar when '10M2D20M2S' then 2 else 0 end
else (pos % 200 + 1) - case cigar when '5S27M' then 5 else 0 end end u, (select sum(case when ascii(substr(qual, cast(i as int), 1)) - 33 >= 15 then ascii(substr(qual, cast(i as int), 1)) - 33 else 0 end) from range(1, 33) t(i)) score from sam),
f as (select *, row_number() over (partition by sample, chrom, u, flag & 16 order by score desc, concat_ws('_', qname, chrom, cast(pos as string), cast(mapq as string))) k from r where flag & 4 = 0) """


@query(_DUP + "select sample, cast(count(*) as bigint) n, cast(sum(case when k > 1 then 1 else 0 end) as bigint) duplicates from f group by 1")
def mark_duplicates(s, d):
    m = A.mark_duplicates(_fragments(s, d)).where("flag & 4 = 0")
    return m.groupBy("sample").agg(F.count("*").alias("n"), F.sum(F.when(G.has_flag(F.col("flag"), 1024), 1).otherwise(0)).alias("duplicates"))


@query(_DUP + """, c as (select sample, count(*) n, sum(case when k > 1 then 1 else 0 end) dup from f group by 1) select sample, cast(0 as bigint) unpaired_examined, cast(floor(n / 2) as bigint) pairs_examined, cast(0 as bigint) unpaired_duplicates,
cast(floor(dup / 2) as bigint) pair_duplicates, round(2 * floor(dup / 2) / (2 * floor(n / 2)), 6) percent_duplication from c""")
def duplication_metrics(s, d):
    return r6(A.duplication_metrics(A.mark_duplicates(_fragments(s, d))), "percent_duplication").drop("library_size")


BASES = """, blk as (select *, pos - 1 s, 0 q, case cigar when '32M' then 32 when '10M2D20M2S' then 10 when '12M3I17M' then 12 else 0 end len from sam where cigar <> '5S27M' union all select *, pos - 1, 5, 27 from sam where cigar = '5S27M'
union all select *, pos + 11, 10, 20 from sam where cigar = '10M2D20M2S' union all select *, pos + 11, 15, 17 from sam where cigar = '12M3I17M'),
bs as (select sample, chrom, flag, s + i + 1 as pos, substr(seq, cast(q + i + 1 as int), 1) base, ascii(substr(qual, cast(q + i + 1 as int), 1)) - 33 quality, cast(q + i + 1 as int) cycle, case when q + i > 0 and position('N' in substr(seq, cast(q + i as int), 2)) = 0 then substr(seq, cast(q + i as int), 2) end context from blk, range(0, 32) r(i) where i < len and flag & 1796 = 0),
refd as (select *, substr('ACGT', cast(pos*7 % 4 + 1 as int), 1) ref from bs) """


@query(BASES + "select sample, chrom, cast(pos as bigint) pos, cast(count(*) as bigint) depth, " + ", ".join(f"cast(sum(case when base = '{b}' then 1 else 0 end) as bigint) {b.lower()}" for b in "ACGT") + ", cast(sum(case when base = 'N' then 1 else 0 end) as bigint) other from bs where quality >= 10 group by 1, 2, 3")
def pileup(s, d):
    return A.pileup(view(s, d, "sam"), min_base_quality=10)


def _sites(s, d):
    return view(s, d, "variants").where("length(alt) = 1").select("chrom", ((F.col("pos") % 2000) + 1).alias("pos"), F.expr("substr('ACGT', cast(((pos % 2000) + 1)*7 % 4 + 1 as int), 1)").alias("ref"), F.lit("A").alias("alt"), F.lit(0.25).alias("af")).distinct().where("ref <> 'A'")


_AT = "(pos % 2000) + 1"
SITES = BASES + f""", sites as (select distinct chrom, {_AT} pos, substr('ACGT', cast(({_AT})*7 % 4 + 1 as int), 1) ref, 'A' alt, cast(0.25 as double) af from variants where length(alt) = 1 and substr('ACGT', cast(({_AT})*7 % 4 + 1 as int), 1) <> 'A'),
ps as (select b.sample, b.chrom, b.pos, s.ref, s.alt, s.af, cast(sum(case when base = s.ref then 1 else 0 end) as bigint) ref_count, cast(sum(case when base = s.alt then 1 else 0 end) as bigint) alt_count, cast(sum(case when base not in (s.ref, s.alt) then 1 else 0 end) as bigint) other_count
from bs b join sites s on b.chrom = s.chrom and b.pos = s.pos group by 1, 2, 3, 4, 5, 6) """


@query(SITES + "select sample, chrom, cast(pos as bigint) pos, ref, alt, af, ref_count, alt_count, other_count from ps")
def pileup_summaries(s, d):
    return A.pileup_summaries(view(s, d, "sam"), _sites(s, d))


@query(BASES + """, g as (select sample, quality, cycle, context, count(*) o, sum(case when base <> ref then 1 else 0 end) e from refd where base <> 'N' group by 1, 2, 3, 4), a as (select sample, quality, cycle, null context, sum(o) o, sum(e) e from g group by 1, 2, 3
union all select sample, quality, null, context, sum(o), sum(e) from g where context is not null group by 1, 2, 4 union all select sample, quality, null, null, sum(o), sum(e) from g group by 1, 2 union all select sample, null, null, null, sum(o), sum(e) from g group by 1)
select sample, cast(quality as int) quality, cast(cycle as int) cycle, context, cast(o as bigint) observations, cast(e as bigint) errors, round(-10 * log10((e + 1) / (o + 2)), 6) empirical from a""")
def recal_table(s, d):
    return r6(A.recal_table(view(s, d, "sam"), F.expr(REFERENCE)), "empirical")


_MOVED = BASES + """, g as (select sample, quality, cycle, count(*) o, sum(case when base <> ref then 1 else 0 end) e from refd where base <> 'N' group by 1, 2, 3),
gx as (select sample, quality, context, count(*) o, sum(case when base <> ref then 1 else 0 end) e from refd where base <> 'N' and context is not null group by 1, 2, 3),
eq as (select sample, quality, -10 * log10((sum(e) + 1) / (sum(o) + 2)) v from g group by 1, 2), ex as (select g.sample, g.quality, g.context, -10 * log10((e + 1) / (o + 2)) - v shift from gx g join eq on g.sample = eq.sample and g.quality = eq.quality), ec as (select g.sample, g.quality, g.cycle, -10 * log10((e + 1) / (o + 2)) - v shift from g join eq on g.sample = eq.sample and g.quality = eq.quality),
nq as (select s.rid, s.qname, s.seq, i, greatest(1, least(60, cast(round(coalesce(v, ascii(substr(s.qual, cast(i as int), 1)) - 33) + coalesce(ec.shift, 0) + coalesce(ex.shift, 0)) as int))) q from (select *, unnest(range(1, 33)) i from (select *, row_number() over () rid from sam) x) s
left join eq on eq.sample = s.sample and eq.quality = ascii(substr(s.qual, cast(i as int), 1)) - 33 left join ec on ec.sample = s.sample and ec.quality = ascii(substr(s.qual, cast(i as int), 1)) - 33 and ec.cycle = i
left join ex on ex.sample = s.sample and ex.quality = ascii(substr(s.qual, cast(i as int), 1)) - 33 and i > 1 and ex.context = substr(s.seq, cast(i - 1 as int), 2)) """


@query(_MOVED + "select qname, seq, string_agg(chr(q + 33), '' order by i) qual from nq group by rid, qname, seq")
def apply_recal(s, d):
    sam = view(s, d, "sam")
    return A.apply_recal(sam, A.recal_table(sam, F.expr(REFERENCE))).select("qname", "seq", "qual")


@query(_DUP + """select qname, chrom, p pos, case when flag & 4 <> 0 then flag when k > 1 then flag | 1024 else flag end flag, cast(row_number() over (partition by chrom, p // 4 order by p, concat_ws('_', qname, chrom, cast(pos as string), cast(mapq as string))) as int) place
from (select qname, chrom, p, pos, mapq, flag, k from f union all select qname, chrom, p, pos, mapq, flag, null from r where flag & 4 <> 0) t""")
def preprocess_reads(s, d):
    out = A.preprocess_reads(_fragments(s, d).repartition(7)).select("qname", "chrom", "pos", "flag")
    return placed(out, "chrom", "pos div 4").withColumn("qname", F.regexp_extract("qname", "^(p[0-9]+_[0-9]+_[0-9]+)_", 1))


@query(BASES + """select sample, ref, base alt, cast(sum(case when (flag & 64 <> 0) <> (flag & 16 <> 0) then 1 else 0 end) as bigint) f1r2, cast(sum(case when (flag & 64 <> 0) = (flag & 16 <> 0) then 1 else 0 end) as bigint) f2r1,
round(abs(sum(case when (flag & 64 <> 0) <> (flag & 16 <> 0) then 1 else -1 end)) / count(*), 6) artifact from refd where base <> 'N' and base <> ref group by 1, 2, 3""")
def orientation_counts(s, d):
    return r6(A.orientation_counts(view(s, d, "sam"), F.expr(REFERENCE)), "artifact")


@query(BASES + """select sample, concat(substr('ACGT', cast((pos - 1)*7 % 4 + 1 as int), 1), ref, substr('ACGT', cast((pos + 1)*7 % 4 + 1 as int), 1)) context, ref, base alt, cast(sum(case when (flag & 64 <> 0) <> (flag & 16 <> 0) then 1 else 0 end) as bigint) f1r2, cast(sum(case when (flag & 64 <> 0) = (flag & 16 <> 0) then 1 else 0 end) as bigint) f2r1,
round(abs(sum(case when (flag & 64 <> 0) <> (flag & 16 <> 0) then 1 else -1 end)) / count(*), 6) artifact from refd where base <> 'N' and base <> ref group by 1, 2, 3, 4""")
def orientation_counts_by_context(s, d):
    return r6(A.orientation_counts(view(s, d, "sam"), F.expr(REFERENCE), context=True), "artifact")


_CALLS = BASES + """, p as (select sample, chrom, pos, ref, base, count(*) n from refd group by 1, 2, 3, 4, 5), dp as (select sample, chrom, pos, sum(n) d from p group by 1, 2, 3),
cand as (select p.chrom, p.pos, p.ref, p.base alt, dp.d t_depth, p.n t_alt, coalesce((select d from dp x where x.sample = 'normal' and x.chrom = p.chrom and x.pos = p.pos), 0) n_depth, coalesce((select n from p y where y.sample = 'normal' and y.chrom = p.chrom and y.pos = p.pos and y.base = p.base), 0) n_alt
from p join dp on p.sample = dp.sample and p.chrom = dp.chrom and p.pos = dp.pos where p.sample = 'tumor' and p.base <> 'N' and p.base <> p.ref and p.n >= 3 and p.n >= 0.05 * dp.d) """


@query(_CALLS + "select chrom, cast(pos as bigint) pos, ref, alt, cast(t_depth as bigint) t_depth, cast(t_alt as bigint) t_alt, cast(n_depth as bigint) n_depth, cast(n_alt as bigint) n_alt from cand where n_alt <= 1")
def somatic_candidates(s, d):
    sam = view(s, d, "sam")
    return C.somatic_candidates(sam.where("sample = 'tumor'"), sam.where("sample = 'normal'"), F.expr(REFERENCE), most_normal_alt=1)


@query("select chrom, pos, ref, alt, cast(count(distinct filt) as bigint) n_samples from (select chrom, pos % 50 as pos, ref, alt, filt from variants) v group by 1, 2, 3, 4 having count(distinct filt) >= 2")
def panel_of_normals(s, d):
    return V.panel_of_normals(view(s, d, "variants").withColumn("pos", F.col("pos") % 50).withColumnRenamed("filt", "sample"))


_CONT = """, hom as (select chrom, pos from ps where sample = 'normal' and ref_count + alt_count + other_count >= {least} and alt_count >= {hom} * (ref_count + alt_count + other_count)),
cont as (select least(1.0, coalesce(sum(ref_count) / sum((ref_count + alt_count + other_count) * (1 - af)), 0)) c, count(*) n from ps join hom on ps.chrom = hom.chrom and ps.pos = hom.pos where sample = 'tumor') """


@query(SITES + _CONT.format(least=3, hom=0.4) + "select round(c, 6) contamination, cast(n as bigint) n_sites from cont")
def contamination(s, d):
    sam = view(s, d, "sam")
    sums = lambda k: A.pileup_summaries(sam.where(F.col("sample") == k), _sites(s, d), ())
    return r6(C.contamination(sums("tumor"), sums("normal"), 3, 0.4), "contamination")


_FILTERED = SITES + _CONT + """, orient as (select ref, base, abs(sum(case when (flag & 64 <> 0) <> (flag & 16 <> 0) then 1 else -1 end)) / count(*) a from refd where sample = 'tumor' and base <> 'N' and base <> ref group by 1, 2),
p as (select sample, chrom, pos, ref, base, count(*) n from refd group by 1, 2, 3, 4, 5), dp as (select sample, chrom, pos, sum(n) d from p group by 1, 2, 3),
cand as (select p.chrom, p.pos, p.ref, p.base alt, dp.d t_depth, p.n t_alt, coalesce(nd.d, 0) n_depth, coalesce(nn.n, 0) n_alt from p join dp on p.sample = dp.sample and p.chrom = dp.chrom and p.pos = dp.pos
left join dp nd on nd.sample = 'normal' and nd.chrom = p.chrom and nd.pos = p.pos left join p nn on nn.sample = 'normal' and nn.chrom = p.chrom and nn.pos = p.pos and nn.base = p.base
where p.sample = 'tumor' and p.base <> 'N' and p.base <> p.ref and p.n >= {called} and p.n >= 0.05 * dp.d),
judged as (select c.chrom, cast(c.pos as bigint) pos, c.ref, c.alt, cast(t_depth as bigint) t_depth, cast(t_alt as bigint) t_alt, cast(n_depth as bigint) n_depth, cast(n_alt as bigint) n_alt, concat_ws(';', case when t_alt < {weak} then 'weak_evidence' end, case when t_alt / t_depth < {low} then 'low_allele_frac' end,
case when s.chrom is not null then 'germline' end, case when {pon} then 'panel_of_normals' end, case when a >= {artifact} then 'orientation' end, case when t_alt / t_depth <= (select c from cont) then 'contamination' end) f
from cand c left join sites s on s.chrom = c.chrom and s.pos = c.pos and s.ref = c.ref and s.alt = c.alt left join orient o on o.ref = c.ref and o.base = c.alt where n_alt <= {normal})
select chrom, pos, ref, alt, t_depth, t_alt, n_depth, n_alt, case when f = '' then 'PASS' else f end as "filter" from judged """


@query(_FILTERED.format(least=5, hom=0.8, called=3, weak=3, low=0.05, pon="false", artifact=0.9, normal=0))
def somatic_pipeline(s, d):
    sam = view(s, d, "sam")
    return C.somatic_pipeline(sam.where("sample = 'tumor'"), sam.where("sample = 'normal'"), F.expr(REFERENCE), sites=_sites(s, d))


@query(_FILTERED.format(least=3, hom=0.4, called=2, weak=4, low=0.3, pon="c.pos % 3 = 0", artifact=0.05, normal=50))
def filter_calls(s, d):
    """Every reason against a call occurs."""
    sam, sites = view(s, d, "sam"), _sites(s, d)
    tumor, normal = sam.where("sample = 'tumor'"), sam.where("sample = 'normal'")
    calls = C.somatic_candidates(tumor, normal, F.expr(REFERENCE), min_alt=2, most_normal_alt=50)
    share = C.contamination(A.pileup_summaries(tumor, sites, ()), A.pileup_summaries(normal, sites, ()), 3, 0.4)
    return C.filter_calls(calls, share, A.orientation_counts(tumor, F.expr(REFERENCE), ()), sites, calls.where("pos % 3 = 0"), min_alt=4, min_vaf=0.3, most_artifact=0.05)


def _segments_sql(rounds: int, width: int, least: int, gain: float, only: str = "true") -> str:
    """Definitions up to ``segs``, a round after the other."""
    out = f""", sf as (select sample, chrom, pos, 1000 * least(ref_count, alt_count) // (ref_count + alt_count) m from ps where ref_count + alt_count >= 2 and {only}),
s0 as (select sample, chrom, (pos - 1) // {width} bin, count(*) n, sum(m) s, min(pos) first_pos, max(pos) last_pos, cast(-1 as bigint) segment from sf group by 1, 2, 3)"""
    sq = lambda x, n: f"cast({x} as double) * cast({x} as double) / cast({n} as double)"
    for k in range(rounds):
        out += f""", a{k} as (select *, sum(n) over (partition by sample, chrom, segment order by bin) n1, sum(s) over (partition by sample, chrom, segment order by bin) s1, sum(n) over (partition by sample, chrom, segment) nn, sum(s) over (partition by sample, chrom, segment) ss from s{k}),
b{k} as (select sample, chrom, segment, bin cut from (select *, ({sq('s1', 'n1')} + {sq('(ss - s1)', '(nn - n1)')} - {sq('ss', 'nn')}) / 1e6 g from a{k} where n1 >= {least} and nn - n1 >= {least}) t where g >= {gain} qualify row_number() over (partition by sample, chrom, segment order by g desc, bin) = 1),
s{k + 1} as (select s.sample, s.chrom, s.bin, n, s, first_pos, last_pos, case when s.bin > cut then cut else s.segment end segment from s{k} s left join b{k} b on b.sample = s.sample and b.chrom = s.chrom and b.segment = s.segment)"""
    return out + f", segs as (select sample, chrom, min(first_pos) - 1 start_pos, max(last_pos) end_pos, sum(n) sites, sum(s) / sum(n) / 1000 minor_fraction from s{rounds} group by sample, chrom, segment) "


@query(SITES + _segments_sql(4, 20, 2, 0.02) + "select sample, chrom, cast(start_pos as bigint) start_pos, cast(end_pos as bigint) end_pos, cast(sites as bigint) sites, round(minor_fraction, 6) minor_fraction from segs")
def tumor_segmentation(s, d):
    return r6(C.tumor_segmentation(A.pileup_summaries(view(s, d, "sam"), _sites(s, d)), ("sample",), 20, 2, 2, 0.02, 4), "minor_fraction")


@query(_FILTERED.format(least=3, hom=0.4, called=2, weak=4, low=0.3, pon="c.pos % 3 = 0", artifact=0.05, normal=50).replace("judged as (", _segments_sql(3, 50, 2, 0.02, "sample = 'tumor'").lstrip(", ") + ", judged as (").replace("case when s.chrom is not null then", "case when s.chrom is not null and least(abs(t_alt / t_depth - coalesce(g.minor_fraction, 0.5)), abs(t_alt / t_depth - (1 - coalesce(g.minor_fraction, 0.5)))) <= 0.1 then").replace("left join orient o", "left join segs g on g.chrom = c.chrom and c.pos - 1 >= g.start_pos and c.pos <= g.end_pos left join orient o"))
def filter_calls_with_segments(s, d):
    """Germline alleles count only where their share is that of the segment."""
    sam, sites = view(s, d, "sam"), _sites(s, d)
    tumor, normal = sam.where("sample = 'tumor'"), sam.where("sample = 'normal'")
    calls = C.somatic_candidates(tumor, normal, F.expr(REFERENCE), min_alt=2, most_normal_alt=50)
    seen = A.pileup_summaries(tumor, sites, ())
    share = C.contamination(seen, A.pileup_summaries(normal, sites, ()), 3, 0.4)
    return C.filter_calls(calls, share, A.orientation_counts(tumor, F.expr(REFERENCE), ()), sites, calls.where("pos % 3 = 0"), 4, 0.3, 0.05, C.tumor_segmentation(seen, (), 50, 2, 2, 0.02, 3))


_AS = """select sample, category, cast(count(*) as double) n, cast(sum(al) as double) aligned, sum(al) / count(*) pct, avg(len) len from (select sample, case when flag & 64 <> 0 then 'FIRST_OF_PAIR' else 'SECOND_OF_PAIR' end category, case when flag & 4 = 0 then 1 else 0 end al, length(seq) len from sam
union all select sample, 'PAIR', case when flag & 4 = 0 then 1 else 0 end, length(seq) from sam) t group by 1, 2"""
_IS = """select sample, case when flag & 16 <> 0 then 'RF' else 'FR' end orientation, median(tlen) median, avg(tlen) mean, stddev_samp(tlen) sd, min(tlen) lo, max(tlen) hi, count(*) n from sam where flag & 4 = 0 group by 1, 2"""
_LONG = " union all ".join(
    [f"select sample, 'alignment' section, category item, '{n}' metric, round(cast({c} as double), 6) as value from al" for n, c in (("reads", "n"), ("aligned", "aligned"), ("pct_aligned", "pct"), ("mean_read_length", "len"), ("mismatch_rate", "null"))]
    + [f"select sample, 'insert_size', orientation, '{n}', round(cast({c} as double), 6) from ins" for n, c in (("median", "median"), ("mean", "mean"), ("sd", "sd"), ("min", "lo"), ("max", "hi"), ("pairs", "n"))]
    + [f"select null, 'coverage', chrom, '{n}', round(cast({c} as double), 6) from cs" for n, c in (("length", "length"), ("bases", "bases"), ("mean", "bases / length"), ("min", "lo"), ("max", "hi"))]
)


@query(BASES + f""", al as ({_AS}), ins as ({_IS}), pd as (select chrom, pos - 1 p, count(*) d from bs group by 1, 2), tg as (select distinct chrom, p from (select chrom, unnest(range(start_pos, end_pos)) p from targets) t),
td as (select tg.chrom, d from pd join tg on tg.chrom = pd.chrom and tg.p = pd.p), cs as (select chrom, count(*) length, sum(d) bases, min(d) lo, max(d) hi from pd group by 1 union all select 'total', count(*), sum(d), min(d), max(d) from pd
union all select concat(chrom, '_region'), count(*), sum(d), min(d), max(d) from td group by chrom union all select 'total_region', count(*), sum(d), min(d), max(d) from td) {_LONG}""")
def comprehensive_qc(s, d):
    """Coverage is that of the covered positions."""
    return r6(A.comprehensive_qc(view(s, d, "sam"), view(s, d, "targets")), "value")


# --- against a reference file ------------------------------------------------


def same_as(name: str, sql: Callable[[str], str] = lambda x: x):
    """Register a function that must give what another query's SQL gives."""

    def add(f):
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql(_SQL[name])
        return f

    return add


def _fasta(s, d):
    return roundtrips.reference(s, d, REFERENCE)


@same_as("recal_table")
def recal_table_fasta(s, d):
    return r6(A.recal_table(view(s, d, "sam"), _fasta(s, d)), "empirical")


@same_as("recal_table", lambda x: x.replace("substr('ACGT', cast(pos*7 % 4 + 1 as int), 1) ref from bs)", "substr('ACGT', cast(pos*7 % 4 + 1 as int), 1) ref from bs where not exists (select 1 from variants v where v.chrom = bs.chrom and v.pos % 2000 + 1 = bs.pos))"))
def recal_table_known_sites(s, d):
    known = view(s, d, "variants").select("chrom", (F.col("pos") % 2000 + 1).alias("pos"))
    return r6(A.recal_table(view(s, d, "sam"), _fasta(s, d), known), "empirical")


@same_as("orientation_counts_by_context", lambda x: x.replace("from refd where base", "from refd where pos > 1 and base"))
def orientation_counts_fasta(s, d):
    return r6(A.orientation_counts(view(s, d, "sam"), _fasta(s, d), context=True), "artifact")


@same_as("somatic_candidates")
def somatic_candidates_fasta(s, d):
    sam = view(s, d, "sam")
    return C.somatic_candidates(sam.where("sample = 'tumor'"), sam.where("sample = 'normal'"), _fasta(s, d), most_normal_alt=1)


@query(_CALLS.replace("sam where", "(select * from sam where sample = 'normal' union all select * replace (case when flag & 64 <> 0 then 't1' else 't2' end as sample) from sam where sample = 'tumor') s where").replace("p.sample = 'tumor'", "p.sample <> 'normal'").replace("select p.chrom, p.pos, p.ref", "select p.sample, p.chrom, p.pos, p.ref")
    + "select sample, chrom, cast(pos as bigint) pos, ref, alt, cast(t_depth as bigint) t_depth, cast(t_alt as bigint) t_alt, cast(n_depth as bigint) n_depth, cast(n_alt as bigint) n_alt from cand where n_alt <= 1 and exists (select 1 from targets t where t.chrom = cand.chrom and cand.pos - 1 >= t.start_pos and cand.pos - 1 < t.end_pos)")
def somatic_candidates_by_tumor(s, d):
    """A row for each of two tumours that has the allele, within the targets."""
    sam = view(s, d, "sam")
    tumors = sam.where("sample = 'tumor'").withColumn("sample", F.when(G.has_flag(F.col("flag"), 64), "t1").otherwise("t2"))
    return C.somatic_candidates(tumors, sam.where("sample = 'normal'"), _fasta(s, d), view(s, d, "targets"), most_normal_alt=1, keys=("sample",))


@query(BASES + """, m as (select sample, case when flag & 64 <> 0 then 'FIRST_OF_PAIR' else 'SECOND_OF_PAIR' end category, case when base <> 'N' and base <> ref then 1 else 0 end x from refd), m2 as (select sample, category, sum(x) / count(*) rate from (select * from m union all select sample, 'PAIR', x from m) t group by 1, 2)
select t.sample, t.category, cast(count(*) as bigint) "reads", cast(sum(al) as bigint) aligned, round(sum(al) / count(*), 6) pct_aligned, round(avg(len), 6) mean_read_length, round(any_value(rate), 6) mismatch_rate from (
select sample, case when flag & 64 <> 0 then 'FIRST_OF_PAIR' else 'SECOND_OF_PAIR' end category, case when flag & 4 = 0 then 1 else 0 end al, length(seq) len from sam
union all select sample, 'PAIR', case when flag & 4 = 0 then 1 else 0 end, length(seq) from sam) t join m2 on m2.sample = t.sample and m2.category = t.category group by 1, 2""")
def alignment_summary_fasta(s, d):
    """Mismatches counted against the reference."""
    return r6(A.alignment_summary(view(s, d, "sam"), reference=_fasta(s, d)), "pct_aligned", "mean_read_length", "mismatch_rate")


#: A reference whose share of G changes every 3,000 bases.
PATCHES = "case when pos*7 % 10 < cast(floor(pos / 3000) as bigint) % 7 then 'G' else 'A' end"


@query(runs_sql(f""", ps as (select chrom, length, unnest(range(1, length + 1)) pos from contigs), gw as (select chrom, (pos - 1) // 3000 w, cast(round(100 * sum(case when {PATCHES} = 'G' then 1 else 0 end) / count(*)) as int) gc, count(*) size from ps group by 1, 2),
dw as (select gw.chrom, w, gc, sum(depth * (least(r.end_pos, w * 3000 + size) - greatest(r.start_pos, w * 3000))) / any_value(size) depth from gw join zruns r on r.chrom = gw.chrom and r.start_pos < w * 3000 + size and r.end_pos > w * 3000 group by 1, 2, 3),
u as (select *, count(*) over (partition by gc order by depth) upto, count(*) over (partition by gc) n from dw),
g as (select gc, any_value(n) windows, {", ".join(f"min(case when 100 * upto >= {a} * n then depth end) p{a}" for a in (10, 25, 50, 75, 90))} from u group by gc)
select gc, cast(windows as bigint) windows, round(100 * sum(windows) over (order by gc) / sum(windows) over (), 6) share, {", ".join(f"round(p{a}, 6) p{a}" for a in (10, 25, 50, 75, 90))} from g"""))
def gc_depth(s, d):
    """Percentiles of depth of windows by their GC."""
    return r6(X.gc_depth(D.per_base_depth(_good(s, d)), roundtrips.reference(s, d, PATCHES), view(s, d, "contigs"), 3000), "share", "p10", "p25", "p50", "p75", "p90")


def _gs(x: str) -> str:
    """The number of C and G from the first base to base ``x`` of the reference."""
    return f"(2 * (({x}) // 4) + case ({x}) % 4 when 2 then 1 when 3 then 2 else 0 end)"


@query(runs_sql(REGION + f""", hh as (select chrom, start_pos, end_pos, name, depth, sum(n) n from o group by 1, 2, 3, 4, 5), q as (select *, sum(n) over (partition by chrom, start_pos, end_pos, name order by depth) u from hh)
select chrom, start_pos, end_pos, name, round(sum(depth * n) / (end_pos - start_pos), 6) mean, min(depth) "min", max(depth) "max", min(case when 2 * u >= end_pos - start_pos then depth end) median,
round(sum(case when depth = 0 then n else 0 end) / (end_pos - start_pos), 6) pct_0x, round(({_gs('end_pos')} - {_gs('start_pos')}) / (end_pos - start_pos), 6) gc from q group by 1, 2, 3, 4"""))
def per_target_coverage(s, d):
    return r6(D.per_target_coverage(view(s, d, "targets"), D.per_base_depth(_good(s, d)), _fasta(s, d)), "mean", "pct_0x", "gc")


@query(_HS + """, bt as (select chrom, greatest(start_pos - 30, 0) start_pos, end_pos + 40 end_pos from targets), bf as (select *, max(end_pos) over (partition by chrom order by start_pos, end_pos rows between unbounded preceding and 1 preceding) m from bt),
bg as (select *, sum(case when start_pos <= m then 0 else 1 end) over (partition by chrom order by start_pos, end_pos rows unbounded preceding) k from bf), bm as (select chrom, min(start_pos) start_pos, max(end_pos) end_pos from bg group by chrom, k),
ob as (select sum(depth * (least(m.end_pos, r.end_pos) - greatest(m.start_pos, r.start_pos))) x from bm m join pos_runs r on m.chrom = r.chrom and m.start_pos < r.end_pos and r.start_pos < m.end_pos)
select cast((select t from te) as bigint) target_territory, round((select x from ob) / (select sum(depth * (end_pos - start_pos)) from pos_runs), 6) pct_selected_bases, round(mean, 6) mean_target_coverage, round(mean / nullif(p20, 0), 6) fold_80_base_penalty,
round(1 - (select n from hit) / (select count(*) from tg), 6) zero_cvg_targets_pct, round(x10, 6) pct_target_bases_10x, round(x20, 6) pct_target_bases_20x, round(x30, 6) pct_target_bases_30x from st""")
def hs_metrics_with_baits(s, d):
    t = view(s, d, "targets")
    baits = t.withColumns({"start_pos": F.greatest(F.col("start_pos") - 30, F.lit(0)), "end_pos": F.col("end_pos") + 40})
    h = A.hs_metrics(_good(s, d), t, baits)
    return r6(h, *[c for c in h.columns if c != "target_territory"])


# --- pairs -------------------------------------------------------------------

PAIR_BASES = """, blk as (select *, pos - 1 s, 0 q, 32 len from pairs_sam where cigar = '32M' union all select *, pos - 1, 5, 27 from pairs_sam where cigar = '5S27M'
union all select *, pos - 1, 0, 10 from pairs_sam where cigar = '10M2D20M2S' union all select *, pos + 11, 10, 20 from pairs_sam where cigar = '10M2D20M2S'),
bs as (select sample, chrom, qname, flag, s + i + 1 as pos, substr(seq, cast(q + i + 1 as int), 1) base, ascii(substr(qual, cast(q + i + 1 as int), 1)) - 33 quality from blk, range(0, 32) r(i) where i < len),
once as (select * from (select *, row_number() over (partition by sample, chrom, qname, pos order by quality desc, flag & 128) k from bs) t where k = 1) """


@query(PAIR_BASES + "select sample, chrom, cast(pos as bigint) pos, cast(count(*) as bigint) depth, " + ", ".join(f"cast(sum(case when base = '{b}' then 1 else 0 end) as bigint) {b.lower()}" for b in "ACGT") + ", cast(sum(case when base = 'N' then 1 else 0 end) as bigint) other from once where quality >= 10 group by 1, 2, 3")
def pileup_without_overlaps(s, d):
    """Places that both mates cover count once."""
    return A.pileup(view(s, d, "pairs_sam"), min_base_quality=10, remove_overlaps=True)


@query(PAIR_BASES + """, dp as (select sample, chrom, pos, count(distinct qname) n from bs group by 1, 2, 3) select sample, 'COV' section, cast(greatest(3, least(3 + cast(floor((n - 3) / 4) as bigint) * 4, 20)) as string) bin, cast(count(*) as bigint) n from dp group by 1, 3
union all select sample, 'SN', 'raw_total_sequences', cast(count(*) as bigint) from pairs_sam group by 1""")
def read_stats_without_overlaps(s, d):
    """Depth with mates counted once, in steps of four from 3 to 20."""
    return A.read_stats(view(s, d, "pairs_sam"), remove_overlaps=True, least_depth=3, step=4, most_depth=20).where("section = 'COV' or bin = 'raw_total_sequences'")


PAIR_DUPS = """, r as (select *, case when flag & 16 <> 0 then pos + case cigar when '5S27M' then 27 else 32 end - 1 + case cigar when '10M2D20M2S' then 2 else 0 end else pos - case cigar when '5S27M' then 5 else 0 end end u,
(select sum(case when ascii(substr(qual, cast(i as int), 1)) - 33 >= 15 then ascii(substr(qual, cast(i as int), 1)) - 33 else 0 end) from range(1, 33) t(i)) score from pairs_sam),
fr as (select sample, chrom, qname, count(*) n, sum(score) score, min(case when flag & 16 = 0 then u end) uf, min(case when flag & 16 <> 0 then u end) ur from r group by 1, 2, 3),
du as (select f.*, row_number() over (partition by sample, chrom, n, uf, ur order by score desc, qname) > 1 or (n = 1 and exists (select 1 from fr g where g.n = 2 and g.sample = f.sample and g.chrom = f.chrom and (g.uf = f.uf or g.ur = f.ur))) dup from fr f),
marked as (select r.sample, r.qname, case when dup then flag | 1024 else flag end flag from r join du on du.sample = r.sample and du.qname = r.qname) """


@query(PAIR_DUPS + "select sample, qname, flag from marked")
def mark_duplicate_pairs(s, d):
    """Pairs, and single reads that lose to them."""
    return A.mark_duplicates(view(s, d, "pairs_sam")).select("sample", "qname", "flag")


@query(PAIR_DUPS + """, n as (select sample, cast(floor(count(*) / 2) as bigint) p, cast(floor(sum(case when flag & 1024 <> 0 then 1 else 0 end) / 2) as bigint) d from marked group by 1),
h as (select sample, 0 k, cast(p - d as double) lo, cast(p as double) * p / greatest(d, 1) + p hi from n union all
select h.sample, k + 1, case when (p - d) / ((lo + hi) / 2) < 1 - exp(-p / ((lo + hi) / 2)) then lo else (lo + hi) / 2 end, case when (p - d) / ((lo + hi) / 2) < 1 - exp(-p / ((lo + hi) / 2)) then (lo + hi) / 2 else hi end from h join n on n.sample = h.sample where k < 60)
select n.sample, cast(0 as bigint) unpaired_examined, p pairs_examined, cast(0 as bigint) unpaired_duplicates, d pair_duplicates, round(d / p, 6) percent_duplication, case when d > 0 then cast(round((lo + hi) / 2) as bigint) end library_size from n join h on h.sample = n.sample and k = 60""", recursive=True)
def duplication_metrics_of_pairs(s, d):
    return r6(A.duplication_metrics(A.mark_duplicates(view(s, d, "pairs_sam"))), "percent_duplication")


# --- reports -----------------------------------------------------------------


@query("select distinct sample, split_part(sample, '_', 1) || '_' || split_part(sample, '_', 2) mouse_id, case when sample like '%Kidney%' then 'Kidney' else 'SCC' end tissue from qc_long")
def sample_fields(s, d):
    return R.with_sample_fields(view(s, d, "qc_long").select("sample").distinct())


def _loads(s, d):
    return view(s, d, "loads").withColumn("load", F.try_divide(F.col("n_total").cast("double"), F.col("callable_mb")))


def _quality(s, d):
    q = view(s, d, "qc_long").groupBy("sample").agg(F.avg("value").alias("mean_target_coverage"), (F.max("value") / 100).alias("percent_duplication"), F.min("value").alias("pct_target_bases_20x"))
    return q


@query(""", q as (select sample, avg(value) c, max(value) / 100 d, min(value) p from qc_long group by 1)
select split_part(l.sample, '_', 1) || '_' || split_part(l.sample, '_', 2) mouse_id, l.sample, normal, 'SCC' tissue, n_total, n_snv, n_indel, callable_mb, round(n_total / callable_mb, 6) load, round(d, 6) percent_duplication, round(c, 6) mean_target_coverage, round(p, 6) pct_target_bases_20x
from pairs join loads l on l.sample = tumor left join q on q.sample = l.sample""")
def mutational_load_report(s, d):
    q = _quality(s, d)
    out = R.mutational_load_report(view(s, d, "pairs"), _loads(s, d), q.select("sample", "percent_duplication"), q.select("sample", "mean_target_coverage", "pct_target_bases_20x"))
    return r6(out, "load", "percent_duplication", "mean_target_coverage", "pct_target_bases_20x")


@query("select l.sample, n_total, n_snv, case when l.sample like '%SCC%' then cast(-1 as bigint) else n_indel end n_indel, callable_mb, case when l.sample like '%SCC%' then 'x' end note from loads l")
def join_qc_to_load(s, d):
    loads = view(s, d, "loads")
    qc = loads.where("sample like '%SCC%'").select("sample", F.lit(-1).cast("long").alias("n_indel"), F.lit("x").alias("note"))
    return R.join_qc_to_load(loads, qc)


@query("""select cast(count(distinct sample) as bigint) n_tumors, round(avg(n_total / callable_mb), 6) mean_load, round(min(n_total / callable_mb), 6) min_load, round(max(n_total / callable_mb), 6) max_load, cast((select count(distinct sample) from qc_long) as bigint) n_samples,
round((select avg(m) from (select max(value) m from qc_long group by sample) t), 6) mean_depth from loads where sample like '%SCC%'""")
def cohort_summary(s, d):
    qc = view(s, d, "qc_long").groupBy("sample").agg(F.max("value").alias("depth"))
    return r6(R.cohort_summary(_loads(s, d).where("sample like '%SCC%'"), qc), "mean_load", "min_load", "max_load", "mean_depth")


@query(""", t as (select case when sample like '%Kidney%' then 'Kidney' else 'SCC' end tissue, n_total / callable_mb l from loads)
select tissue, case when tissue = 'Kidney' then 0 else 1 end place, cast(count(*) as bigint) n, round(min(l), 6) "min", round(quantile_cont(l, 0.25), 6) q1, round(median(l), 6) median, round(quantile_cont(l, 0.75), 6) q3, round(max(l), 6) "max" from t group by 1""")
def load_by_tissue(s, d):
    return r6(R.load_by_tissue(_loads(s, d)), "min", "q1", "median", "q3", "max")


@query("select split_part(sample, '_', 1) || '_' || split_part(sample, '_', 2) mouse_id, round(median(n_total / callable_mb), 6) median_load from loads group by 1")
def load_by_mouse(s, d):
    return r6(R.load_by_mouse(_loads(s, d)), "median_load")


@query(f", k as (select sample, {_FS} from alignments group by 1) select sample, round(100.0 * mapped / total, 6) mapping, round(100.0 * duplicates / mapped, 6) duplication, round(100.0 * properly_paired / paired, 6) proper_pair, true zero_is_zero from k")
def named_rates(s, d):
    """Percentages of reads, and 0 without a total."""
    c = F.col
    k = A.flagstat(view(s, d, "alignments"))
    out = k.select("sample", G.mapping_rate(c("mapped"), c("total")).alias("mapping"), G.duplicate_rate(c("duplicates"), c("mapped")).alias("duplication"), G.proper_pair_rate(c("properly_paired"), c("paired")).alias("proper_pair"), (G.mapping_rate(c("mapped"), F.lit(0)) == 0).alias("zero_is_zero"))
    return r6(out, "mapping", "duplication", "proper_pair")


@query(runs_sql(REGION + ", t as (select " + ", ".join(f"sum(case when depth >= {x} then n else 0 end) c{x}" for x in (1, 10, 20, 30)) + ", sum(n) n from o) select " + ", ".join(f"round(100.0 * c{x} / n, 6) {'pct_covered' if x == 1 else f'pct_{x}x'}" for x in (1, 10, 20, 30)) + " from t"))
def coverage_rates(s, d):
    """Percent of target bases that are covered at all, and at 10, 20 and 30 reads."""
    at = (1, 10, 20, 30)
    t = D.region_thresholds(view(s, d, "targets"), D.per_base_depth(_good(s, d)), list(at))
    one = t.agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("n"), *[F.sum(f"ge_{x}").alias(f"c{x}") for x in at])
    names = {x: "pct_covered" if x == 1 else f"pct_{x}x" for x in at}
    return r6(one.select(*[G.covered_rate(F.col(f"c{x}"), F.col("n")).alias(v) for x, v in names.items()]), *names.values())


_STATES = "case when {x} % 3 = 0 then 'PASS' when {x} % 3 = 1 then 'FAIL' else 'WARN' end"


@query(f", m as (select rec, {_STATES.format(x='rec')} a, {_STATES.format(x='rec // 3')} b, {_STATES.format(x='rec // 9')} c from fastq) select rec, case when a = 'PASS' and b = 'PASS' and c = 'PASS' then 'PASS' when a = 'FAIL' or b = 'FAIL' then 'FAIL' else 'WARN' end overall from m")
def fastqc_overall(s, d):
    """All combinations of three modules."""
    m = view(s, d, "fastq").select("rec", *[F.expr(_STATES.format(x=x)).alias(n) for n, x in (("a", "rec"), ("b", "(rec div 3)"), ("c", "(rec div 9)"))])
    return m.select("rec", G.fastqc_overall(F.col("a"), F.col("b"), F.col("c")).alias("overall"))


@query("select sample, cast(count(*) as bigint) n, round(coalesce(100.0 * sum(case when value > 50 then 1 else 0 end) / nullif(count(*), 0), 0), 6) rate, case when min(value) < 0 then 'FAIL' when avg(value) > 50 then 'PASS' else 'WARN' end overall from qc_long group by 1")
def rates(s, d):
    q = view(s, d, "qc_long").groupBy("sample").agg(F.count("*").alias("n"), F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("k"), F.when(F.min("value") < 0, "FAIL").when(F.avg("value") > 50, "PASS").otherwise("WARN").alias("m"))
    return r6(q.select("sample", "n", G.rate(F.col("k"), F.col("n")).alias("rate"), G.fastqc_overall(F.col("m"), F.col("m"), F.col("m")).alias("overall")), "rate")


@query("""select sample, 'fastp_n_total' metric, cast(n_total as string) as value from loads union all select sample, 'fastp_n_snv', cast(n_snv as string) from loads union all select sample, 'fastqc_raw_r1_gc', 'PASS' from loads""")
def qc_summary_long(s, d):
    loads = view(s, d, "loads")
    modules = loads.select("sample", F.lit("raw").alias("label"), F.lit("r1").alias("read"), F.lit("gc").alias("module"), F.lit("PASS").alias("status"))
    return R.qc_summary_long(loads.select("sample", "n_total", "n_snv"), modules)


@query("""select case when sample = 'PRLC_0_SCC_0' then 'first' else sample end sample, cast(count(*) as string) "a.n", cast(max(user_n) as string) "b.m" from (select sample, count(*) over (partition by sample) user_n from qc_long where sample not like '%\\_2' escape '\\') t group by 1""")
def multi_qc(s, d):
    n = view(s, d, "qc_long").groupBy("sample").agg(F.count("*").cast("string").alias("value"))
    tables = {"a": n.select("sample", F.lit("n").alias("metric"), "value"), "b": n.select("sample", F.lit("m").alias("metric"), "value"), "c": n.select("sample", F.lit("z").alias("metric"), "value")}
    return R.multi_qc(tables, exclude=["c"], ignore_samples=["*_2"], rename={"PRLC_0_SCC_0": "first"}, metrics=["a.n", "b.m"])


@query(PAIR_DUPS.replace(", r as", MERGED.format(d=0) + ", r as") + PAIR_BASES.split("once as")[0].rstrip().rstrip(",") + f""", k as (select sample, {_FS} from pairs_sam group by 1), l as (select sample, avg(length(seq)) len from pairs_sam group by 1), m as (select sample, cast(floor(sum(case when flag & 1024 <> 0 then 1 else 0 end) / 2) as bigint) dup from marked group by 1),
dp as (select sample, chrom, pos, count(*) n from bs group by 1, 2, 3), cv as (select sample, count(*) x1, sum(case when dp.n >= 10 then 1 else 0 end) x10, sum(dp.n) bases from dp join merged g on g.chrom = dp.chrom and dp.pos - 1 >= g.start_pos and dp.pos - 1 < g.end_pos group by 1)
select k.sample, cast(total as double) "flagstat.total", cast(properly_paired as double) "flagstat.properly_paired", round(len, 6) "alignment.PAIR.mean_read_length", cast(dup as double) "duplication.pair_duplicates", cast(x1 as double) "coverage.bases_1x", cast(x10 as double) "coverage.bases_10x", cast(bases as double) "coverage.bases"
from k join l on l.sample = k.sample join m on m.sample = k.sample join cv on cv.sample = k.sample""")
def multi_qc_of_tools(s, d):
    """One row for each sample with metrics of all tools over its aligned reads."""
    names = ["flagstat.total", "flagstat.properly_paired", "alignment.PAIR.mean_read_length", "duplication.pair_duplicates", "coverage.bases_1x", "coverage.bases_10x", "coverage.bases"]
    out = R.multi_qc(R.qc_tables(view(s, d, "pairs_sam"), view(s, d, "targets")), metrics=names)
    return out.select("sample", *[F.round(F.col(f"`{n}`").cast("double"), 6).alias(n) for n in names])


@query(""", q as (select sample, avg(value) c, max(value) / 100 d, min(value) p from qc_long group by 1) select q.sample, round(c, 6) coverage, round(d, 6) duplication, case when q.sample like '%SCC%' then n_total end n_total, case when q.sample like '%SCC%' then round(n_total / callable_mb, 6) end "load" from q left join loads l on l.sample = q.sample""")
def sample_report(s, d):
    """The numbers in the JSON of each sample."""
    r = R.sample_report(_quality(s, d), _loads(s, d).where("sample like '%SCC%'"))
    get = lambda path, kind: F.get_json_object("report", f"$.{path}").cast(kind)
    out = r.select(get("sample", "string").alias("sample"), get("qc.mean_target_coverage", "double").alias("coverage"), get("qc.percent_duplication", "double").alias("duplication"), get("load.n_total", "long").alias("n_total"), get("load.load", "double").alias("load"))
    return r6(out, "coverage", "duplication", "load")


@query("select metric path, cast(count(distinct sample) as bigint) n_keys, string_agg(distinct sample, ',' order by sample) keys from qc_long group by 1 having count(distinct sample) > 1")
def output_conflicts(s, d):
    claims = view(s, d, "qc_long").select(F.col("metric").alias("path"), F.col("sample").alias("key"))
    return R.output_conflicts(claims).withColumn("keys", F.array_join("keys", ","))


@query("select sample path, case when n_total % 3 = 0 then 'First run' when n_total % 3 = 1 then 'missing' else 'does not match' end reason from loads")
def stale_inputs(s, d):
    loads = view(s, d, "loads").select(F.col("sample").alias("path"), "n_total", F.md5("sample").alias("signature"))
    return R.stale_inputs(loads.where("n_total % 3 <> 0").drop("n_total"), loads.where("n_total % 3 <> 1").withColumn("signature", F.concat("signature", F.lit("x"))).drop("n_total"))


# --- files -------------------------------------------------------------------

for _name, (_f, _sql) in roundtrips.ROUNDTRIPS.items():
    query(_sql, _name)(_f)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL by name."""
    return dict(_SQL)
