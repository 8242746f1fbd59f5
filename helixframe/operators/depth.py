"""Depth along contigs and what is called from it.

A run table has ``chrom, start_pos, end_pos, depth`` and optional leading keys,
such as the sample. Runs are maximal: neighbours differ in depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genomics import SKIP_FLAGS, cigar_blocks
from .intervals import SCAN_BIN, carry, interval_join, merge_intervals, windows
from .reference import CHUNK, cut_at_chunks, region_gc

#: Bases of a chunk of depths, as a power of two; a row holds those of the chunk after it too.
DEPTH_CHUNK = 9


def read_filter(reads: DataFrame, skip: int = SKIP_FLAGS, include: int = 0, mapq: int = 0, length: tuple[int, int] | None = None, read_groups: list[str] | None = None, chrom: str | None = None) -> DataFrame:
    """Reads without skipped flags, with included ones, and within the other limits.

    Terms that are not asked for are not part of the plan.
    """
    out = reads.where(F.col("flag").bitwiseAND(F.lit(skip)) == 0) if skip else reads
    if include:
        out = out.where(F.col("flag").bitwiseAND(F.lit(include)) == include)
    if mapq:
        out = out.where(F.col("mapq") >= mapq)
    if length:
        out = out.where(F.abs("tlen").between(*length))
    if read_groups:
        out = out.where(F.col("read_group").isin(read_groups))
    return out.where(F.col("chrom") == chrom) if chrom else out


def aligned_blocks(reads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each aligned block: chrom, start_pos, end_pos and the columns to keep."""
    b = reads.select("chrom", *keep, F.explode(cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b"))
    return b.select("chrom", *keep, F.col("b.s").alias("start_pos"), F.col("b.e").alias("end_pos"))


def mate_overlap_correct(blocks: DataFrame, keys: tuple[str, ...] = ("chrom", "qname")) -> DataFrame:
    """Blocks of a read and its mate as one where they overlap, so that no base counts twice."""
    w = Window.partitionBy(*keys).orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = blocks.withColumn("new", F.when(F.col("start_pos") <= reach, 0).otherwise(1))
    part = new.withColumn("part", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return part.groupBy(*keys, "part").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("part")


def per_base_depth(blocks: DataFrame, contigs: DataFrame | None = None, keys: tuple[str, ...] = (), size: int = SCAN_BIN) -> DataFrame:
    """Maximal runs of equal depth; with ``contigs`` also the runs of depth 0 up to their ends.

    Starts and ends become +1 and -1 at their places, summed before anything is
    ordered. Running sums stay within a bin; the depth at its start, and the next
    change after it, come from the table of bins.
    """
    keys = [*keys, "chrom"]
    ends = F.array(F.struct(F.col("start_pos").alias("pos"), F.lit(1).alias("change")), F.struct(F.col("end_pos").alias("pos"), F.lit(-1).alias("change")))
    events = blocks.where("start_pos < end_pos").select(*keys, F.inline(ends))
    events = events.groupBy(*keys, "pos").agg(F.sum("change").alias("change")).where("change <> 0")
    if contigs is not None:
        first = contigs.select("chrom", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("change"))
        if len(keys) > 1:
            first = first.crossJoin(blocks.select(*keys[:-1]).distinct())  # contigs times samples: both are small lists
        events = events.unionByName(first.select(*keys, "pos", "change")).groupBy(*keys, "pos").agg(F.sum("change").alias("change"))
    events = events.withColumn("bin", F.floor(F.col("pos") / size))
    per_bin = events.groupBy(*keys, "bin").agg(F.sum("change").alias("sum"), F.min("pos").alias("first"))
    w = Window.partitionBy(*keys).orderBy("bin")
    per_bin = per_bin.select(*keys, "bin", F.sum("sum").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.lead("first").over(w).alias("after"))
    w = Window.partitionBy(*keys, "bin").orderBy("pos")
    runs = events.join(per_bin, [*keys, "bin"]).select(
        *keys,
        F.col("pos").alias("start_pos"),
        F.coalesce(F.lead("pos").over(w), "after").alias("end_pos"),
        (F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("before", F.lit(0))).cast("long").alias("depth"),
    )
    if contigs is None:
        return runs.where("depth > 0")
    ended = runs.join(contigs.select("chrom", "length"), "chrom", "left")
    end = F.coalesce("end_pos", "length")
    return ended.select(*keys, "start_pos", end.alias("end_pos"), "depth").where(F.col("start_pos") < end)


def quantize_depth(runs: DataFrame, edges: list[int], labels: list[str] | None = None, keys: tuple[str, ...] = (), size: int = SCAN_BIN) -> DataFrame:
    """Neighbouring runs of one depth class as one. Class i has depth from edges[i] to below edges[i+1]; the last is open."""
    keys = [*keys, "chrom"]
    labels = labels or [f"{a}:{b}" for a, b in zip(edges, [*map(str, edges[1:]), "inf"])]
    kind = None
    for low, label in zip(edges, labels, strict=True):
        test = F.col("depth") >= low
        kind = F.when(test, label) if kind is None else F.when(test, label).otherwise(kind)
    return merge_classes(runs.withColumn("class", kind).where(F.col("class").isNotNull()), keys, size)


def merge_classes(runs: DataFrame, keys: list[str], size: int = SCAN_BIN) -> DataFrame:
    """Touching runs of equal ``class`` as one."""
    return merge_intervals(runs, 0, (*keys, "class"), size).drop("n")


def callable_bases(runs: DataFrame, min_depth: int = 10, keys: tuple[str, ...] = ()) -> DataFrame:
    """callable_bases and callable_mb: bases with at least ``min_depth``."""
    size = F.when(F.col("depth") >= min_depth, F.col("end_pos") - F.col("start_pos")).otherwise(0)
    out = runs.groupBy(*keys).agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("callable_bases"))
    return out.withColumn("callable_mb", F.col("callable_bases") / 1e6)


def callable_summary(summary: DataFrame, min_depth: float = 10, region_bases: DataFrame | None = None) -> DataFrame:
    """total_bases, callable_bases, callable_mb, callable_pct from a depth summary (chrom, length, bases, mean).

    The ``total`` row gives the total; contigs count by their mean depth, unless
    ``region_bases`` (callable_bases) gives the number.
    """
    total = F.max(F.when(F.col("chrom") == "total", F.col("length")))
    own = F.sum(F.when((F.col("chrom") != "total") & (F.col("mean") >= min_depth), F.col("bases")).otherwise(0))
    out = summary.agg(total.cast("long").alias("total_bases"), own.cast("long").alias("callable_bases"))
    if region_bases is not None:
        out = out.drop("callable_bases").crossJoin(region_bases.select("callable_bases"))  # one row each
    pct = F.coalesce(F.try_divide(100.0 * F.col("callable_bases"), F.col("total_bases").cast("double")), F.lit(0.0))
    return out.withColumn("callable_mb", F.round(F.col("callable_bases") / 1e6, 2)).withColumn("callable_pct", F.round(pct, 2))


def callable_in_bed(runs: DataFrame, bed: DataFrame, min_depth: int = 10, size: int = SCAN_BIN) -> DataFrame:
    """Bases of the rows of ``bed`` with enough depth; bases of two rows count twice.

    One sweep counts the rows that cover each place, so rows and runs are never paired.
    """
    swept = _sweep([(runs.where(F.col("depth") >= min_depth), {"good_n": F.lit(1)}), (bed, {"in_n": F.lit(1)})], size)
    size_in = F.when(F.col("good_n") > 0, (F.col("end_pos") - F.col("start_pos")) * F.col("in_n"))
    return swept.where("end_pos is not null").agg(F.coalesce(F.sum(size_in), F.lit(0)).cast("long").alias("callable_bases"))


def _sweep(tables: list[tuple[DataFrame, dict[str, Column]]], size: int) -> DataFrame:
    """chrom, start_pos, end_pos and counts between neighbouring changes: for each name the sum of its column over all intervals that cover the place."""
    names = list(dict.fromkeys(n for _, counts in tables for n in counts))

    def events(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
        side = lambda pos, v: F.struct(F.col(pos).alias("pos"), *[(v * counts.get(n, F.lit(0))).cast("long").alias(n) for n in names])
        return df.where("start_pos < end_pos").select("chrom", F.inline(F.array(side("start_pos", 1), side("end_pos", -1))))

    e = None
    for table in tables:
        e = events(*table) if e is None else e.unionByName(events(*table))
    e = e.groupBy("chrom", "pos").agg(*[F.sum(n).alias(n) for n in names]).withColumn("bin", F.floor(F.col("pos") / size))
    per_bin = e.groupBy("chrom", "bin").agg(*[F.sum(n).alias(n) for n in names], F.min("pos").alias("first"))
    w = Window.partitionBy("chrom").orderBy("bin")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.select("chrom", "bin", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names], F.lead("first").over(w).alias("after"))
    w = Window.partitionBy("chrom", "bin").orderBy("pos")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return e.join(per_bin, ["chrom", "bin"]).select(
        "chrom", F.col("pos").alias("start_pos"), F.coalesce(F.lead("pos").over(w), "after").alias("end_pos"), *[(F.sum(n).over(upto) + F.col(f"{n}_before")).alias(n) for n in names]
    )


def callable_loci(blocks: DataFrame, good: Column, targets: DataFrame, min_depth: int = 10, max_poor: float = 0.5, max_depth: int | None = None, size: int = SCAN_BIN) -> DataFrame:
    """Runs of one state in the targets: chrom, start_pos, end_pos, state.

    ``good`` says which blocks are well mapped. Both depth tracks are summed in one
    sweep over one scan: each event changes the number of all blocks, of good ones, or
    of targets that cover the place.
    """
    runs = _sweep([(blocks, {"all_n": F.lit(1), "good_n": F.when(good, 1).otherwise(0)}), (targets, {"in_n": F.lit(1)})], size)
    state = F.when(F.col("all_n") == 0, "NO_COVERAGE").when(F.col("good_n") < (1 - max_poor) * F.col("all_n"), "POOR_MAPPING_QUALITY").when(F.col("good_n") < min_depth, "LOW_COVERAGE")
    if max_depth:
        state = state.when(F.col("all_n") > max_depth, "EXCESSIVE_COVERAGE")
    runs = runs.where("in_n > 0 and end_pos is not null").withColumn("class", state.otherwise("CALLABLE"))
    return merge_classes(runs, ["chrom"], size).withColumnRenamed("class", "state")


def loci_counts(loci: DataFrame) -> DataFrame:
    """Bases in each state."""
    return loci.groupBy("state").agg(F.sum(F.col("end_pos") - F.col("start_pos")).cast("long").alias("n"))


def loci_summary_value(lines: DataFrame, state: str = "CALLABLE") -> DataFrame:
    """(bases, mb) of one state, from text lines ``STATE n``."""
    parts = F.split(F.trim("value"), "\\s+")
    hit = lines.where(F.get(parts, 0) == state).select(F.get(parts, 1).try_cast("long").alias("bases"))
    return hit.withColumn("mb", F.col("bases") / 1e6)


def depth_summary(runs: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """chrom, length, bases, mean, min, max of each contig and in total; with ``regions`` also of their bases, as ``<chrom>_region``."""
    if regions is not None:
        inside = _covered(merge_intervals(regions).drop("n"), runs).groupBy("chrom", "depth").agg(F.sum("n").alias("end_pos")).withColumn("start_pos", F.lit(0))
        own = depth_summary(inside)
        return depth_summary(runs).unionByName(own.withColumn("chrom", F.concat("chrom", F.lit("_region"))))
    size = F.col("end_pos") - F.col("start_pos")
    s = runs.rollup("chrom").agg(F.sum(size).cast("long").alias("length"), F.sum(size * F.col("depth")).cast("long").alias("bases"), F.min("depth").cast("long").alias("min"), F.max("depth").cast("long").alias("max"))
    return s.select(F.coalesce("chrom", F.lit("total")).alias("chrom"), "length", "bases", (F.col("bases") / F.col("length")).alias("mean"), "min", "max")


def depth_distribution(runs: DataFrame) -> DataFrame:
    """chrom, depth, share: the part of a contig, and of all, with at least this depth."""
    size = F.col("end_pos") - F.col("start_pos")
    h = runs.groupBy("chrom", "depth").agg(F.sum(size).alias("n"))
    h = h.unionByName(h.groupBy("depth").agg(F.sum("n").alias("n")).select(F.lit("total").alias("chrom"), "depth", "n"))
    w = Window.partitionBy("chrom")
    above = F.sum("n").over(w.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0))
    return h.select("chrom", F.col("depth").cast("long").alias("depth"), (above / F.sum("n").over(w)).alias("share"))


def _covered(regions: DataFrame, runs: DataFrame) -> DataFrame:
    """Parts of the distinct regions that runs cover: region, depth, bases n; runs are cut at chunks, so that regions are placed for few lengths."""
    cut = cut_at_chunks(runs, "start_pos", "end_pos").select("chrom", F.col("__s").alias("start_pos"), F.col("__e").alias("end_pos"), "depth")
    pairs = interval_join(regions.select("chrom", "start_pos", "end_pos").distinct(), cut, ("left",), CHUNK)
    size = (F.least("end_pos", "r_end_pos") - F.greatest("start_pos", "r_start_pos")).alias("n")
    return pairs.select("chrom", "start_pos", "end_pos", F.col("r_depth").alias("depth"), size)


def _depth_chunks(runs: DataFrame, bits: int) -> DataFrame:
    """(chrom, __chunk, __depths): the depth at each base of a chunk and of the next one, where either is covered."""
    width = 1 << bits
    r = runs.where("depth > 0 and start_pos < end_pos")
    near = F.sequence(F.call_function("shiftright", F.col("start_pos"), F.lit(bits)) - 1, F.call_function("shiftright", F.col("end_pos") - 1, F.lit(bits)))
    r = r.select("chrom", "start_pos", "end_pos", F.col("depth").cast("long").alias("depth"), F.explode(near).alias("__chunk"))
    at = lambda p: p - F.col("__chunk") * width
    part = F.struct(F.greatest(at(F.col("start_pos")), F.lit(0)).cast("int").alias("a"), F.least(at(F.col("end_pos")), F.lit(2 * width)).cast("int").alias("e"), "depth")
    c = r.groupBy("chrom", "__chunk").agg(F.sort_array(F.collect_list(part)).alias("p"))  # at most as many as there are bases
    zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n)
    upto = lambda i: F.when(i > 0, F.get("p", i - 1)["e"]).otherwise(0)
    filled = F.flatten(F.transform("p", lambda x, i: F.concat(zeros(x["a"] - upto(i)), F.array_repeat(x["depth"], x["e"] - x["a"]))))
    return c.select("chrom", "__chunk", F.concat(filled, zeros(F.lit(2 * width) - F.element_at("p", -1)["e"])).alias("__depths"))


def _by_length(regions: DataFrame, runs: DataFrame, short: list[Column], long, bits: int = DEPTH_CHUNK) -> DataFrame:
    """``regions`` with columns ``short`` of ``__d``, the depths at all their bases, null where none is covered.

    A region meets the one row of chunks that holds it, so its runs are not joined one by one. Those that reach beyond it,
    and so have more bases than a row may hold, get the same columns by ``long`` (a function of regions and runs).
    """
    chunk = F.call_function("shiftright", F.col("start_pos"), F.lit(bits))
    fits = F.coalesce(F.col("end_pos") <= (chunk + 2) * (1 << bits), F.lit(True))
    r = regions.where(fits).withColumn("__chunk", chunk)
    # Merged at every size: a row of chunks is many times larger than the runs that it is made of.
    j = r.join(_depth_chunks(runs, bits).hint("merge"), ["chrom", "__chunk"], "left")
    size = F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(0)).cast("int")
    j = j.withColumn("__d", F.slice("__depths", (F.col("start_pos") - F.col("__chunk") * (1 << bits) + 1).cast("int"), size))
    return j.select(*regions.columns, *short).unionByName(long(regions.where(~fits), runs))


def _total(d: str) -> Column:
    return F.aggregate(d, F.lit(0).cast("long"), lambda a, x: a + x)


def _middle(d: str) -> Column:
    """The value in the lower middle."""
    return F.get(F.sort_array(d), F.floor((F.array_size(d) - 1) / 2).cast("int"))


def _at_least(d: str, least: int) -> Column:
    return F.array_size(F.filter(d, lambda x: x >= least))


def region_depth(regions: DataFrame, runs: DataFrame, median: bool = False) -> DataFrame:
    """``regions`` with their mean or median depth; bases that no run covers have depth 0."""
    keys = ["chrom", "start_pos", "end_pos"]
    length = F.col("end_pos") - F.col("start_pos")

    def long(regions: DataFrame, runs: DataFrame) -> DataFrame:
        c = _covered(regions, runs).where("depth > 0")
        if not median:
            d = c.groupBy(*keys).agg(F.sum(F.col("depth") * F.col("n")).alias("bases")).select(*keys, (F.col("bases") / length).alias("depth"))
        else:
            h = c.groupBy(*keys, "depth").agg(F.sum("n").alias("n"))
            w = Window.partitionBy(*keys)
            h = h.withColumn("zero", length - F.sum("n").over(w)).withColumn("upto", F.col("zero") + F.sum("n").over(w.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)))
            # The value in the lower middle of all bases of the region.
            mid = F.min(F.when(2 * F.col("upto") >= length, F.col("depth")))
            d = h.groupBy(*keys, "zero").agg(mid.alias("m")).select(*keys, F.when(2 * F.col("zero") >= length, 0).otherwise(F.col("m")).cast("double").alias("depth"))
        return regions.join(d, keys, "left").withColumn("depth", F.coalesce("depth", F.lit(0.0)))

    own = _middle("__d").cast("double") if median else F.try_divide(_total("__d").cast("double"), length.cast("double"))
    return _by_length(regions, runs, [F.coalesce(own, F.lit(0.0)).alias("depth")], long)


def per_target_coverage(targets: DataFrame, runs: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """``targets`` with mean, min, max and median depth, pct_0x, and with the chunks of a ``reference`` gc, the share of known bases.

    Bases that no run covers have depth 0; the median is the value in the lower middle. All
    follows from the depths of each target's bases, or for a long one from their histogram. gc is null where the reference has no known base.
    """
    keys = ["chrom", "start_pos", "end_pos"]
    length = F.col("end_pos") - F.col("start_pos")

    def long(targets: DataFrame, runs: DataFrame) -> DataFrame:
        h = _covered(targets, runs).where("depth > 0").groupBy(*keys, "depth").agg(F.sum("n").alias("n"))
        a = h.groupBy(*keys).agg(F.sum("n").alias("__n"), F.sum(F.col("depth") * F.col("n")).alias("__bases"), F.min("depth").alias("__low"), F.max("depth").alias("__high"), F.sort_array(F.collect_list(F.struct("depth", "n"))).alias("__h"))
        none = length - F.coalesce("__n", F.lit(0))
        start = F.struct(none.alias("upto"), F.when(2 * none >= length, F.lit(0).cast("long")).alias("m"))
        step = lambda s, x: F.struct((s["upto"] + x["n"]).alias("upto"), F.coalesce(s["m"], F.when(2 * (s["upto"] + x["n"]) >= length, x["depth"])).alias("m"))
        return targets.join(a, keys, "left").select(
            *[F.col(c) for c in targets.columns], (F.coalesce("__bases", F.lit(0)) / length).alias("mean"), F.when(none > 0, 0).otherwise(F.col("__low")).cast("long").alias("min"), F.coalesce("__high", F.lit(0)).cast("long").alias("max"),
            F.coalesce(F.aggregate("__h", start, step, lambda s: s["m"]), F.lit(0)).cast("long").alias("median"), (none / length).alias("pct_0x"),
        )

    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    short = [
        (number(_total("__d")) / length).alias("mean"), number(F.array_min("__d")).alias("min"), number(F.array_max("__d")).alias("max"), number(_middle("__d")).alias("median"),
        ((length - number(_at_least("__d", 1))) / length).alias("pct_0x"),
    ]
    out = _by_length(targets, runs, short, long)
    if reference is None:
        return out
    g = region_gc(targets, reference).select(*keys, F.try_divide(F.col("gc").cast("double"), F.col("acgt").cast("double")).alias("gc"))
    return out.join(g, keys, "left").select(*out.columns, "gc")


def window_depth(contigs: DataFrame, runs: DataFrame, width: int, median: bool = False) -> DataFrame:
    """Depth in windows of one width."""
    return region_depth(windows(contigs, width), runs, median)


def region_thresholds(regions: DataFrame, runs: DataFrame, at: list[int]) -> DataFrame:
    """``regions`` with the number of bases that reach each depth (from 1), as ``ge_<depth>``."""
    keys = ["chrom", "start_pos", "end_pos"]

    def long(regions: DataFrame, runs: DataFrame) -> DataFrame:
        c = _covered(regions, runs).groupBy(*keys).agg(*[F.sum(F.when(F.col("depth") >= t, F.col("n")).otherwise(0)).cast("long").alias(f"ge_{t}") for t in at])
        return regions.join(c, keys, "left").na.fill(0, [f"ge_{t}" for t in at])

    short = [F.coalesce(_at_least("__d", t), F.lit(0)).cast("long").alias(f"ge_{t}") for t in at]
    return _by_length(regions, runs.where(F.col("depth") >= min(at)), short, long)
