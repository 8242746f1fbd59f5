"""Variants: filters, typing, counts and tags.

A variant table has ``chrom, pos, id, ref, alt, qual, filter, info`` (a map) and
``samples``, an array of struct(name, fmt) whose ``fmt`` maps FORMAT keys to text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genomics import csq_effect, effect_class, genotype_fields, vaf, variant_type
from .intervals import interval_join, restrict_to_targets


@dataclass(frozen=True)
class HardFilterThresholds:
    """Least depth, alternative reads and their share. Fixed values."""

    min_dp: int = 10
    min_ad: int = 3
    min_vaf: float = 0.05


def sample_fields(variants: DataFrame, sample: str | None = None) -> DataFrame:
    """``variants`` with dp, ad_ref and ad_alt of the named sample, or of the first."""
    own = F.get(F.filter("samples", lambda s: s["name"] == sample), 0) if sample else F.get("samples", 0)
    g = genotype_fields(own["fmt"])
    return variants.withColumn("__g", g).withColumns({n: F.coalesce(F.col(f"__g.{n}"), F.lit(0)) for n in ("dp", "ad_ref", "ad_alt")}).drop("__g")


def typed(variants: DataFrame, split_alts: bool = False) -> DataFrame:
    """``variants`` with ``type``; with ``split_alts`` one row for each alternative allele."""
    v = variants.withColumn("alt", F.explode(F.split("alt", ","))) if split_alts else variants
    return v.withColumn("type", variant_type(F.col("ref"), F.col("alt")))


def filter_pass(variants: DataFrame) -> DataFrame:
    return variants.where(F.col("filter") == "PASS")


def filter_biallelic(variants: DataFrame) -> DataFrame:
    """Variants with one alternative allele."""
    return variants.where((F.size(F.split("alt", ",")) == 1) & (F.col("alt") != "."))


def select_samples(variants: DataFrame, names: list[str]) -> DataFrame:
    """Only the listed samples, in the order of the table."""
    return variants.withColumn("samples", F.filter("samples", lambda s: s["name"].isin(names)))


def _kind(kinds: str | list[str]) -> Column:
    kinds = kinds.split(",") if isinstance(kinds, str) else list(kinds)
    t = variant_type(F.col("ref"), F.col("alt"))
    tests = {"snps": t == "SNV", "indels": t.isin("INSERTION", "DELETION"), "mnps": (t == "COMPLEX")}
    out = F.lit(False)
    for k in kinds:
        out = out | tests[k.strip()]
    return out


def filter_variant_type(variants: DataFrame, kinds: str | list[str]) -> DataFrame:
    """Variants of the given kinds: snps, indels, mnps."""
    return variants.where(_kind(kinds))


def filter_expr(variants: DataFrame, include: Column | str | None = None, exclude: Column | str | None = None) -> DataFrame:
    """Rows for which ``include`` holds, or for which ``exclude`` does not hold."""
    if (include is None) == (exclude is None):
        raise ValueError("give either include or exclude")
    as_column = lambda x: F.expr(x) if isinstance(x, str) else x
    return variants.where(as_column(include)) if include is not None else variants.where(~F.coalesce(as_column(exclude), F.lit(False)))


def view_variants(variants: DataFrame, targets: DataFrame | None = None, pass_only: bool = False, biallelic: bool = False, samples: list[str] | None = None, kinds: str | list[str] | None = None) -> DataFrame:
    """Any of the filters above in one call; cheap ones stand before the join with targets."""
    v = filter_pass(variants) if pass_only else variants
    v = filter_biallelic(v) if biallelic else v
    v = filter_variant_type(v, kinds) if kinds else v
    v = select_samples(v, samples) if samples else v
    return restrict_to_targets(v, targets) if targets is not None else v


def hard_filter(variants: DataFrame, targets: DataFrame | None = None, sample: str | None = None, thresholds: HardFilterThresholds = HardFilterThresholds()) -> DataFrame:
    """Passing biallelic SNVs and indels with enough depth, alternative reads and share."""
    v = view_variants(variants, targets, True, True, [sample] if sample else None, "snps,indels")
    if "samples" in variants.columns:
        v = sample_fields(v, sample)
    t = thresholds
    return v.where((F.col("dp") >= t.min_dp) & (F.col("ad_alt") >= t.min_ad) & (vaf(F.col("ad_alt"), F.col("dp")) >= t.min_vaf))


def filter_quality(variants: DataFrame, min_dp: int = 10, min_ad: int = 3, min_vaf: float = 0.0, pass_only: bool = True) -> DataFrame:
    """Passing variants with enough depth, alternative reads and share; terms at 0 are left out."""
    terms = [F.col("filter") == "PASS"] if pass_only else []
    terms += [F.col("dp") >= min_dp] if min_dp > 0 else []
    terms += [F.col("ad_alt") >= min_ad] if min_ad > 0 else []
    terms += [vaf(F.col("ad_alt"), F.col("dp")) >= min_vaf] if min_vaf > 0 else []
    for t in terms:
        variants = variants.where(t)
    return variants


def variant_counts(variants: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """n_total, n_snv and n_indel."""
    t = variant_type(F.col("ref"), F.col("alt"))
    n = lambda *k: F.coalesce(F.sum(F.when(t.isin(*k), 1).otherwise(0)), F.lit(0)).cast("long")
    return variants.groupBy(*keys).agg(F.count("*").alias("n_total"), n("SNV").alias("n_snv"), n("INSERTION", "DELETION").alias("n_indel"))


# The classes of effects.
EFFECTS = ("missense", "nonsense", "frameshift", "synonymous", "splice", "intronic", "intergenic")


def effect_counts(variants: DataFrame, keys: tuple[str, ...] = (), csq: Column | None = None) -> DataFrame:
    """Ten counters of the first consequence of each variant; total counts every row.

    For lines of a file take :func:`sources.formats.consequence_lines`, which keeps short ones, and ``csq``.
    """
    c = effect_class(csq_effect(F.try_element_at("info", F.lit("CSQ")) if csq is None else csq))
    n = lambda *k: F.coalesce(F.sum(F.when(c.isin(*k), 1).otherwise(0)), F.lit(0)).cast("long")
    return variants.groupBy(*keys).agg(
        F.count("*").alias("total"), n("missense", "nonsense", "frameshift", "synonymous").alias("coding"), n("missense", "nonsense", "frameshift").alias("nonsynonymous"), *[n(e).alias(e) for e in EFFECTS]
    )


def variant_summary(variants: DataFrame, keys: tuple[str, ...] = ("sample",), csq: Column | None = None) -> DataFrame:
    """Effect counts as rows: keys, metric, value."""
    c = effect_counts(variants, keys, csq)
    names = [n for n in c.columns if n not in keys]
    return c.select(*keys, F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])).alias("metric", "value"))


def mutational_load(counts: DataFrame, callable_mb: DataFrame, key: str = "sample") -> DataFrame:
    """Counts with callable_mb and the loads per callable megabase; null where nothing is callable."""
    j = counts.join(callable_mb, key)
    per = lambda c: F.try_divide(F.col(c).cast("double"), F.col("callable_mb"))
    return j.withColumns({"load": per("n_total"), "snv_load": per("n_snv"), "indel_load": per("n_indel")})


#: The tags that :func:`fill_tags` knows. Those of the second group have a value for each alternative.
TAGS = ("AN", "NS", "MAF", "F_MISSING", "AC", "AF", "AC_Het", "AC_Hom", "AC_Hemi", "HWE", "ExcHet")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, as expressions within lambdas are not shared."""
    return F.get(F.transform(F.array(value), body), 0)


def _hardy_weinberg(het: Column, hom: Column, other: Column, which: int) -> Column:
    """The exact test of genotype counts (0), or that of too many heterozygotes (1); 1 where there are no genotypes.

    Given the alleles, the numbers of heterozygotes that are possible go in steps of two; the probability of each follows
    from that of the one before. Logarithms keep large cohorts in range.
    """
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def logs(c: Column) -> Column:
        ratio = lambda h: F.ln(4 * ((c["rare"] - h) / 2) * (c["n"] - h - (c["rare"] - h) / 2) / ((h + 2) * (h + 1)))
        steps = F.sequence(c["rare"] % 2, c["rare"], F.lit(2))
        return F.aggregate(F.slice(steps, F.lit(1), F.size(steps) - 1), F.array(F.lit(0.0)), lambda a, h: F.concat(a, F.array(F.element_at(a, -1) + ratio(h))))

    def share(p: Column, at: Column) -> Column:
        # Equal probabilities may differ in their last digits.
        if which == 0:
            return _let(F.get(p, at), lambda own: total(F.filter(p, lambda x: x <= own * (1 + 1e-9)))) / total(p)
        return total(F.slice(p, at + 1, F.size(p))) / total(p)

    counts = F.struct((het + hom + other).alias("n"), (2 * F.least(hom, other) + het).alias("rare"), het.alias("het"))
    scaled = lambda l: _let(F.array_max(l), lambda most: F.transform(l, lambda x: F.exp(x - most)))
    test = lambda c: _let(_let(logs(c), scaled), lambda p: share(p, ((c["het"] - c["rare"] % 2) / 2).cast("int")))
    return _let(counts, lambda c: F.when(c["n"] > 0, F.least(test(c), F.lit(1.0))).otherwise(1.0))


def fill_tags(variants: DataFrame, tags: list[str]) -> DataFrame:
    """``info`` with tags of the genotypes of all samples: any of ``TAGS``, others are an error.

    AN counts called alleles and NS samples with one; MAF is the share of the second commonest allele,
    F_MISSING that of samples without a call. For each alternative: AC and AF its number and share, AC_Het, AC_Hom and
    AC_Hemi its number in heterozygous, homozygous and haploid genotypes, HWE and ExcHet the
    exact Hardy-Weinberg test and that of an excess of heterozygotes, over diploid genotypes without missing alleles.
    """
    if not tags:
        raise ValueError("give the tags to fill")
    unknown = sorted(set(tags) - set(TAGS))
    if unknown:
        raise ValueError(f"unknown tags: {', '.join(unknown)}; known are {', '.join(TAGS)}")
    gt = lambda s: F.coalesce(F.try_element_at(s["fmt"], F.lit("GT")), F.lit(""))
    calls = F.transform("samples", lambda s: F.split(gt(s), "[/|]"))
    v = variants.withColumn("__g", calls).withColumn("__a", F.filter(F.flatten("__g"), lambda x: x.rlike("^\\d+$")))
    known = lambda g: F.forall(g, lambda x: x.rlike("^\\d+$"))
    v = v.withColumn("__two", F.filter("__g", lambda g: (F.size(g) == 2) & known(g))).withColumn("__one", F.filter("__g", lambda g: (F.size(g) == 1) & known(g)))
    an, each = F.size("__a"), F.sequence(F.lit(1), F.size(F.split("alt", ",")))
    share = lambda x, of: F.coalesce(F.try_divide(x.cast("double"), of.cast("double")), F.lit(0.0))
    text = lambda x: F.round(x, 6).cast("string")
    count = lambda i: F.size(F.filter("__a", lambda x: x == i.cast("string")))
    has = lambda g, i: F.size(F.filter(g, lambda x: x == i.cast("string")))
    hets = lambda i: F.size(F.filter("__two", lambda g: has(g, i) == 1))
    homs = lambda i: F.size(F.filter("__two", lambda g: has(g, i) == 2))
    others = lambda i: F.size("__two") - hets(i) - homs(i)
    called = F.size(F.filter("__g", lambda g: F.exists(g, lambda x: x.rlike("^\\d+$"))))
    counts = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(F.split("alt", ","))), count), asc=False)
    exact = lambda i, k: _hardy_weinberg(hets(i), homs(i), others(i), k)
    listed = lambda f: F.array_join(F.transform(each, f), ",")
    values = {
        "AN": lambda: an.cast("string"), "NS": lambda: called.cast("string"), "MAF": lambda: text(share(F.get(counts, 1), an)), "F_MISSING": lambda: text(share(F.size("__g") - called, F.size("__g"))),
        "AC": lambda: listed(lambda i: count(i).cast("string")), "AF": lambda: listed(lambda i: text(share(count(i), an))), "AC_Het": lambda: listed(lambda i: hets(i).cast("string")),
        "AC_Hom": lambda: listed(lambda i: (2 * homs(i)).cast("string")), "AC_Hemi": lambda: listed(lambda i: F.size(F.filter("__one", lambda g: has(g, i) == 1)).cast("string")),
        "HWE": lambda: listed(lambda i: text(exact(i, 0))), "ExcHet": lambda: listed(lambda i: text(exact(i, 1))),
    }
    new = F.create_map(*[x for t in tags for x in (F.lit(t), values[t]())])
    old = F.map_filter(F.coalesce("info", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(tags))
    return v.withColumn("info", F.map_concat(old, new)).drop("__a", "__g", "__two", "__one")


def known_sites_anti(variants: DataFrame, known: DataFrame, alleles: bool = False) -> DataFrame:
    """Variants that are not among the known sites, or not with the same alleles."""
    keys = ["chrom", "pos", *(["ref", "alt"] if alleles else [])]
    return variants.join(known.select(*keys), keys, "left_anti")


def annotation_join(variants: DataFrame, consequences: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """``variants`` with gene and effect of a table of consequences by alleles; where it has none, genes by place."""
    keys = ["chrom", "pos", "ref", "alt"]
    out = variants.join(consequences.select(*keys, F.col("gene").alias("__g"), F.col("effect").alias("__e")), keys, "left")
    if genes is None:
        return out.withColumnsRenamed({"__g": "gene", "__e": "effect"})
    points = variants.select("chrom", "pos").distinct().select("chrom", (F.col("pos") - 1).alias("start_pos"), F.col("pos").alias("end_pos"))
    by_place = interval_join(points, genes.select("chrom", "start_pos", "end_pos", "name")).groupBy("chrom", F.col("end_pos").alias("pos")).agg(F.min("r_name").alias("__n"))
    out = out.join(by_place, ["chrom", "pos"], "left")
    return out.withColumn("gene", F.coalesce("__g", "__n")).withColumn("effect", F.coalesce("__e", F.when(F.col("__n").isNotNull(), "within_gene"))).drop("__g", "__e", "__n")


def panel_of_normals(calls: DataFrame, least: int = 2) -> DataFrame:
    """Sites called in at least so many samples."""
    return calls.groupBy("chrom", "pos", "ref", "alt").agg(F.countDistinct("sample").alias("n_samples")).where(F.col("n_samples") >= least)
