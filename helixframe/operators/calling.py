"""Somatic candidates from pileups, and what is known against them.

These are set-based estimates with the inputs and outputs of a somatic caller;
they assemble nothing and fit no likelihood model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .alignments import orientation_counts, pileup, pileup_summaries, with_reference
from .intervals import interval_join, restrict_to_targets
from .variants import known_sites_anti


def alleles(piles: DataFrame, reference: DataFrame | Column, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """keys, chrom, pos, ref, alt, depth, ref_count, alt_count: a row for each base seen beside the reference."""
    p = with_reference(piles, reference)
    counts = F.array(*[F.struct(F.lit(x).alias("alt"), F.col(x.lower()).alias("n")) for x in "ACGT"])
    own = F.coalesce(*[F.when(F.col("ref") == x, F.col(x.lower())) for x in "ACGT"], F.lit(0))
    e = p.withColumn("ref_count", own).withColumn("x", F.explode(F.filter(counts, lambda x: x["n"] > 0))).where("x.alt <> ref")
    return e.select(*keys, "chrom", "pos", "ref", F.col("x.alt").alias("alt"), "depth", "ref_count", F.col("x.n").alias("alt_count"))


def somatic_candidates(
    tumors: DataFrame, normals: DataFrame, reference: DataFrame | Column, targets: DataFrame | None = None, germline: DataFrame | None = None,
    pon: DataFrame | None = None, min_alt: int = 3, min_vaf: float = 0.05, most_normal_alt: int = 0, keys: tuple[str, ...] = (), **filters,
) -> DataFrame:
    """keys, chrom, pos, ref, alt with depths and counts in tumours and normals.

    Reads of several normals are taken together, and those of several tumours too, unless
    ``keys`` (the sample) asks for a row for each tumour that has the allele. An allele needs
    support in the tumour, next to none in the normal, and no place in the
    germline resource or the panel of normals.
    """
    t = alleles(pileup(tumors, keys, **filters), reference, keys)
    if targets is not None:
        t = restrict_to_targets(t, targets)
    t = t.where((F.col("alt_count") >= min_alt) & (F.col("alt_count") >= min_vaf * F.col("depth")))
    t = t.select(*keys, "chrom", "pos", "ref", "alt", F.col("depth").alias("t_depth"), F.col("alt_count").alias("t_alt"))
    for known in (germline, pon):
        if known is not None:
            t = known_sites_anti(t, known, {"ref", "alt"} <= set(known.columns))
    piles = pileup(normals, (), **filters)
    of = F.coalesce(*[F.when(F.col("alt") == x, F.col(x.lower())) for x in "ACGT"], F.lit(0))
    j = t.join(piles, ["chrom", "pos"], "left").select(*t.columns, F.coalesce("depth", F.lit(0)).cast("long").alias("n_depth"), F.coalesce(of, F.lit(0)).cast("long").alias("n_alt"))
    return j.where(F.col("n_alt") <= most_normal_alt)


def contamination(tumor_sites: DataFrame, normal_sites: DataFrame | None = None, min_depth: int = 5, hom: float = 0.8) -> DataFrame:
    """One row: contamination, from reference reads at sites where the sample is homozygous alternative.

    The sites are chosen in the matched normal if there is one. Of foreign reads a
    share ``1 - af`` shows the reference.
    """
    chosen = normal_sites if normal_sites is not None else tumor_sites
    total = F.col("ref_count") + F.col("alt_count") + F.col("other_count")
    sites = chosen.where((total >= min_depth) & (F.col("alt_count") >= hom * total)).select("chrom", "pos").distinct()
    s = tumor_sites.join(sites, ["chrom", "pos"], "left_semi")
    est = F.try_divide(F.sum("ref_count").cast("double"), F.sum(total * (1 - F.col("af"))))
    return s.agg(F.least(F.lit(1.0), F.coalesce(est, F.lit(0.0))).alias("contamination"), F.count("*").alias("n_sites"))


def tumor_segmentation(sites: DataFrame, keys: tuple[str, ...] = (), width: int = 100_000, min_depth: int = 5, min_sites: int = 2, min_gain: float = 0.05, rounds: int = 6) -> DataFrame:
    """keys, chrom, start_pos, end_pos, sites, minor_fraction: parts of contigs whose minor allele fraction is level.

    ``sites`` have chrom, pos, ref_count and alt_count. The fractions, in thousandths, are
    summed in bins of ``width`` bases; each round splits every segment after the bin
    where that lowers the sum of squares most, if by ``min_gain`` (in squared fractions), with ``min_sites`` on
    both sides. A window holds the bins of one contig, however many sites they have.
    """
    total = F.col("ref_count") + F.col("alt_count")
    s = sites.where(total >= max(min_depth, 1)).select(*keys, "chrom", "pos", F.floor(1000 * F.least("ref_count", "alt_count") / total).alias("m"))
    b = s.groupBy(*keys, "chrom", F.floor((F.col("pos") - 1) / width).alias("bin")).agg(F.count("*").alias("n"), F.sum("m").alias("s"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    b = b.withColumn("segment", F.lit(-1).cast("long"))
    square = lambda x, n: F.try_divide(x.cast("double") * x.cast("double"), n.cast("double"))
    for _ in range(rounds):
        w = Window.partitionBy(*keys, "chrom", "segment")
        upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        b = b.withColumns({"n1": F.sum("n").over(upto), "s1": F.sum("s").over(upto), "all_n": F.sum("n").over(w), "all_s": F.sum("s").over(w)})
        n2, s2 = F.col("all_n") - F.col("n1"), F.col("all_s") - F.col("s1")
        gain = (square(F.col("s1"), F.col("n1")) + square(s2, n2) - square(F.col("all_s"), F.col("all_n"))) / 1e6
        ok = (F.col("n1") >= min_sites) & (n2 >= min_sites)
        b = b.withColumn("split", F.max(F.when(ok & (gain >= min_gain), F.struct(gain.alias("gain"), (-F.col("bin")).alias("bin")))).over(w))
        beyond = F.coalesce(F.col("bin") > -F.col("split.bin"), F.lit(False))
        b = b.withColumn("segment", F.when(beyond, -F.col("split.bin")).otherwise(F.col("segment"))).drop("n1", "s1", "all_n", "all_s", "split")
    out = b.groupBy(*keys, "chrom", "segment").agg((F.min("first") - 1).alias("start_pos"), F.max("last").alias("end_pos"), F.sum("n").alias("sites"), (F.sum("s") / F.sum("n") / 1000).alias("minor_fraction"))
    return out.drop("segment")


def filter_calls(calls: DataFrame, contaminated: DataFrame | None = None, orientation: DataFrame | None = None, germline: DataFrame | None = None, pon: DataFrame | None = None, min_alt: int = 3, min_vaf: float = 0.05, most_artifact: float = 0.9, segments: DataFrame | None = None, tolerance: float = 0.1) -> DataFrame:
    """``calls`` with ``filter``: PASS, or the reasons against a call joined by semicolons.

    With the ``segments`` of :func:`tumor_segmentation`, a call at a germline allele is
    germline only if its share is as near as ``tolerance`` to the minor or the major
    fraction of its segment (a half where there is none), as that of a heterozygous site would be.
    """
    c = calls
    share = F.coalesce(F.try_divide(F.col("t_alt").cast("double"), F.col("t_depth").cast("double")), F.lit(0.0))
    reasons = [F.when(F.col("t_alt") < min_alt, "weak_evidence"), F.when(share < min_vaf, "low_allele_frac")]
    keys, as_heterozygous = ["chrom", "pos", "ref", "alt"], F.lit(True)
    if segments is not None:
        points = c.select("chrom", "pos").distinct().select("chrom", (F.col("pos") - 1).alias("start_pos"), F.col("pos").alias("end_pos"))
        within = interval_join(points, segments.select("chrom", "start_pos", "end_pos", "minor_fraction")).groupBy("chrom", F.col("end_pos").alias("pos")).agg(F.min("r_minor_fraction").alias("__minor"))
        c = c.join(within, ["chrom", "pos"], "left")
        minor = F.coalesce("__minor", F.lit(0.5))
        as_heterozygous = F.least(F.abs(share - minor), F.abs(share - (1 - minor))) <= tolerance
    for name, known in (("germline", germline), ("panel_of_normals", pon)):
        if known is not None:
            on = [k for k in keys if k in known.columns]
            c = c.join(known.select(*on).distinct().withColumn(f"__{name}", F.lit(True)), on, "left")
            reasons.append(F.when(F.col(f"__{name}") & (as_heterozygous if name == "germline" else F.lit(True)), name))
    if orientation is not None:
        o = orientation.groupBy("ref", "alt").agg(F.max("artifact").alias("__artifact"))
        c = c.join(F.broadcast(o), ["ref", "alt"], "left")  # at most twelve rows
        reasons.append(F.when(F.col("__artifact") >= most_artifact, "orientation"))
    if contaminated is not None:
        c = c.crossJoin(F.broadcast(contaminated.select(F.col("contamination").alias("__cont"))))  # one row
        reasons.append(F.when(share <= F.col("__cont"), "contamination"))
    found = F.array_compact(F.array(*reasons))
    return c.withColumn("filter", F.when(F.size(found) == 0, "PASS").otherwise(F.array_join(found, ";"))).select(*calls.columns, "filter")


def somatic_pipeline(tumors: DataFrame, normals: DataFrame, reference: DataFrame | Column, targets: DataFrame | None = None, sites: DataFrame | None = None, pon: DataFrame | None = None, **filters) -> DataFrame:
    """Call, count orientations, estimate contamination if there are ``sites`` (chrom, pos, ref, alt, af), and filter."""
    calls = somatic_candidates(tumors, normals, reference, targets, pon=pon, **filters)
    turned = orientation_counts(tumors, reference, (), **filters)
    share = None
    if sites is not None:
        share = contamination(pileup_summaries(tumors, sites, (), **filters), pileup_summaries(normals, sites, (), **filters))
    return filter_calls(calls, share, turned, sites, pon)
