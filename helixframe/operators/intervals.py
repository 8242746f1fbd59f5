"""Genomic intervals: sort, pad, merge, overlap joins.

Tables have ``chrom, start_pos, end_pos`` (0-based, half-open) and any other
columns. Chromosomes are few and uneven, so nothing is keyed by them alone: joins
are on (chrom, bin) with bins as wide as the intervals that meet in them, and running
sums and maxima are taken within bins, with what earlier bins pass on held in a
table of one row for each bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins of the narrowest level are 64 bases wide (2 ** 6), those of each further level four times as wide.
NARROWEST, LEVELS = 6, 13
SCAN_BIN = 1 << 20


def rename_contigs(bed: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Contig names of one naming scheme in another; a name that fits no rule is an error.

    A name in ``mapping`` becomes its value; of a ``_random`` name the second
    part stays, with ``.1``; otherwise a leading ``chr`` goes.
    """
    c = F.col("chrom")
    rule = (
        F.when(F.contains(c, F.lit("_random")), F.concat(F.get(F.split(c, "_"), 1), F.lit(".1")))
        .when(F.startswith(c, F.lit("chr")), F.substring(c, 4, 1 << 30))
        .otherwise(F.raise_error(F.concat(F.lit("cannot map contig "), c)))
    )
    known = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c] if mapping else None
    return bed.withColumn("chrom", F.coalesce(known, rule) if mapping else rule)


def _known(bed: DataFrame, contigs: DataFrame, *columns: Column) -> DataFrame:
    """``bed`` with columns of its contig; a contig that the list lacks is an error."""
    listed = contigs.select("chrom", *columns, F.lit(True).alias("__listed"))
    joined = bed.join(listed, "chrom", "left")
    return joined.where(F.coalesce("__listed", F.raise_error(F.concat(F.lit("contig is not listed: "), F.coalesce("chrom", F.lit("null")))).cast("boolean"))).drop("__listed")


def slop(bed: DataFrame, contigs: DataFrame, both: float = 0, left: float | None = None, right: float | None = None, fraction: bool = False) -> DataFrame:
    """Intervals extended by base pairs, or by a fraction of their length, within their contig.

    A contig without a length is an error.
    """
    names = bed.columns
    size = (F.col("end_pos") - F.col("start_pos")) if fraction else F.lit(1)
    ext = lambda x: F.floor(size * F.lit(both if x is None else x)).cast("long")
    joined = _known(bed, contigs, F.col("length").alias("__length"))
    start = F.greatest(F.col("start_pos") - ext(left), F.lit(0))
    end = F.least(F.col("end_pos") + ext(right), F.col("__length"))
    return joined.select(*[start.alias(c) if c == "start_pos" else end.alias(c) if c == "end_pos" else F.col(c) for c in names])


def sort_bed(bed: DataFrame) -> DataFrame:
    """By contig and place; a range partition followed by local sorts."""
    return bed.orderBy("chrom", "start_pos", "end_pos", *[c for c in bed.columns if c not in ("chrom", "start_pos", "end_pos")])


def bed_to_interval_list(bed: DataFrame, contigs: DataFrame) -> DataFrame:
    """1-based closed intervals; a contig that the dictionary lacks is an error."""
    return _known(bed, contigs).select("chrom", (F.col("start_pos") + 1).alias("start_pos"), F.col("end_pos"), *[c for c in bed.columns if c not in ("chrom", "start_pos", "end_pos")])


def _level(start: str, end: str) -> Column:
    """The first level at which an interval is at most two bins long, so that it touches three at most."""
    bits = F.length(F.bin(F.col(end) - F.col(start) - 1))
    return F.least(F.greatest(F.call_function("shiftright", bits - NARROWEST, F.lit(1)), F.lit(0)), F.lit(LEVELS - 1))


def _levels(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row: the levels that occur, at most ``LEVELS`` numbers."""
    return df.where(F.col(start) < F.col(end)).agg(F.collect_set(_level(start, end)).alias("__levels"))


def _placed(df: DataFrame, start: str, end: str, others: DataFrame | int | None, first: bool) -> DataFrame:
    """One row for each place, ``__bin``, where an interval can meet one of the other side.

    Two intervals meet at the wider of their two levels, in a bin that says which side is
    the wider one (0: the second or both, 1: the first), so intervals that are both
    narrow never meet in a wide bin. Of the levels above its own, an interval goes to
    those that the other side has (all of them where ``others`` is None, those of intervals
    up to a length where it is a number).
    """
    rows = df.where(F.col(start) < F.col(end))
    if others is None or isinstance(others, int):
        most = LEVELS if others is None else min(max((others - 1).bit_length() - NARROWEST, 0) // 2 + 1, LEVELS)
        rows = rows.withColumn("__levels", F.array(*[F.lit(k) for k in range(most)]))
    else:
        rows = rows.crossJoin(F.broadcast(others))  # one row
    rows = rows.withColumn("__own", _level(start, end))
    own, wider = F.col("__own"), 0 if first else 1

    def bins(level: Column, owner: int) -> Column:
        width = F.lit(NARROWEST) + 2 * level
        touched = F.sequence(F.call_function("shiftright", F.col(start), width), F.call_function("shiftright", F.col(end) - 1, width))
        return F.transform(touched, lambda b: b * 32 + level * 2 + owner)

    at_least = (lambda m: m >= own) if first else (lambda m: m > own)
    narrower = (lambda m: m < own) if first else (lambda m: m <= own)
    above = F.flatten(F.transform(F.filter("__levels", at_least), lambda m: bins(m, wider)))
    here = F.when(F.exists("__levels", narrower), bins(own, 1 - wider)).otherwise(F.array().cast("array<bigint>"))
    return rows.select(*df.columns, F.explode(F.concat(above, here)).alias("__bin"))


def _candidates(left: DataFrame, right: DataFrame, measure: tuple[str, ...], longest: int | None = None) -> DataFrame:
    """Pairs that share a bin; ``right`` has its columns with the prefix already.

    They are merged at every size: Spark takes a side for as large as it is before it is
    placed, and would send one that is many times larger through the driver.
    """
    of_left = _levels(left, "start_pos", "end_pos") if "left" in measure else None
    of_right = _levels(right, "r_start_pos", "r_end_pos") if "right" in measure else longest
    return _placed(left, "start_pos", "end_pos", of_right, True).hint("merge").join(_placed(right, "r_start_pos", "r_end_pos", of_left, False), ["chrom", "__bin"])


def interval_join(left: DataFrame, right: DataFrame, measure: tuple[str, ...] = ("left", "right"), longest: int | None = None) -> DataFrame:
    """Pairs of overlapping intervals; columns of ``right`` but chrom get the prefix ``r_``.

    Intervals meet in bins about as wide as the wider of the two, so the work follows the
    pairs that overlap, at any density and mix of lengths, and a long interval is in
    three bins, not in all that it covers. Each pair is kept only in the bin of the
    larger start, so no distinct is needed. Which lengths occur is read from the sides in
    ``measure``, by one small aggregate each; name only one where the other is costly to
    compute, and the rows of the named side are placed for all lengths, or for those up to ``longest``
    where no interval of ``right`` is longer. Empty intervals and those without a start or an end overlap nothing.
    """
    r = right.select("chrom", *[F.col(c).alias(f"r_{c}") for c in right.columns if c != "chrom"])
    pairs = _candidates(left, r, measure, longest).where("start_pos < r_end_pos and r_start_pos < end_pos")
    width = F.lit(NARROWEST) + F.call_function("shiftright", F.col("__bin"), F.lit(1)).bitwiseAND(F.lit(15)).cast("int") * 2
    later = F.call_function("shiftright", F.greatest("start_pos", "r_start_pos"), width)
    return pairs.where(later == F.call_function("shiftright", F.col("__bin"), F.lit(5))).drop("__bin")


def restrict_to_targets(points: DataFrame, targets: DataFrame, pos: str = "pos") -> DataFrame:
    """Rows at 1-based positions inside any target.

    Targets are merged first, so that a row is in one at most and needs no distinct.
    """
    t = merge_intervals(targets.select("chrom", "start_pos", "end_pos")).select(F.col("chrom").alias("__chrom"), F.col("start_pos").alias("__start"), F.col("end_pos").alias("__end"))
    p = points.withColumn("__p", F.col(pos) - 1).withColumn("__q", F.col(pos))
    p = _placed(p, "__p", "__q", _levels(t, "__start", "__end"), True)
    one = t.limit(0).agg(F.array(F.lit(0)).alias("__levels"))  # points are of the narrowest level
    t = _placed(t, "__start", "__end", one, False).withColumnRenamed("__bin", "__t_bin")
    on = (F.col("chrom") == F.col("__chrom")) & (F.col("__bin") == F.col("__t_bin")) & (F.col("__p") >= F.col("__start")) & (F.col("__p") < F.col("__end"))
    return p.join(t, on, "left_semi").select(*points.columns)


def carry(df: DataFrame, keys: list[str], bin_name: str, value: Column, name: str) -> DataFrame:
    """``df`` with what aggregate ``value`` gives over all earlier bins of the same keys.

    ``value`` is a sum or a max; the table of bins has one row for each bin.
    """
    per_bin = df.groupBy(*keys, bin_name).agg(value.alias("__v"))
    kind = F.max if name.startswith("max") else F.sum
    w = Window.partitionBy(*keys).orderBy(bin_name).rowsBetween(Window.unboundedPreceding, -1)
    before = per_bin.select(*keys, bin_name, kind("__v").over(w).alias(name))
    return df.join(before, [*keys, bin_name])


def merge_intervals(bed: DataFrame, distance: int = 0, keys: tuple[str, ...] = ("chrom",), size: int = SCAN_BIN) -> DataFrame:
    """Overlapping, touching or close intervals as one: keys, start_pos, end_pos, n.

    Within a bin, an interval begins an island if it starts beyond the largest end
    before it; ends from earlier bins, and the number of islands there, are carried in.
    """
    keys = list(keys)
    # Intervals of equal start are one from the beginning, by a partial aggregate, so that a deep place is not a long sort.
    b = bed.groupBy(*keys, "start_pos").agg(F.max("end_pos").alias("end_pos"), F.count("*").alias("n")).withColumn("bin", F.floor(F.col("start_pos") / size))
    b = carry(b, keys, "bin", F.max("end_pos"), "max_before")
    w = Window.partitionBy(*keys, "bin").orderBy("start_pos")
    reach = F.greatest(F.max("end_pos").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("max_before"))
    b = b.withColumn("new", F.when(F.col("start_pos") <= reach + distance, 0).otherwise(1))
    b = carry(b, keys, "bin", F.sum("new"), "islands_before")
    b = b.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("islands_before", F.lit(0)))
    out = b.groupBy(*keys, "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.sum("n").alias("n"))
    return out.drop("island")


def mergesort(bed: DataFrame, distance: int = 0) -> DataFrame:
    """Merged and in order."""
    return sort_bed(merge_intervals(bed, distance))


def pad(bed: DataFrame, contigs: DataFrame, by: int = 100) -> DataFrame:
    """Padded within contigs, merged and in order."""
    return mergesort(slop(bed, contigs, by)).drop("n")


def merge_beds(beds: list[DataFrame], in_order: bool = True) -> DataFrame:
    """All intervals of several tables, merged; in order unless not wanted."""
    every = beds[0].select("chrom", "start_pos", "end_pos")
    for b in beds[1:]:
        every = every.unionByName(b.select("chrom", "start_pos", "end_pos"))
    merged = merge_intervals(every).drop("n")
    return sort_bed(merged) if in_order else merged


def windows(contigs: DataFrame, width: int) -> DataFrame:
    """Contigs cut into windows of one width; the last may be shorter."""
    cut = contigs.select("chrom", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(width))).alias("start_pos"))
    return cut.select("chrom", F.col("start_pos").cast("long").alias("start_pos"), F.least(F.col("start_pos") + width, "length").cast("long").alias("end_pos"))
