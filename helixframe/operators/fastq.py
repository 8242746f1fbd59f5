"""Reads before alignment: checks, cleaning, quality metrics.

A read table has ``rec`` (number from 0), ``header, seq, plus, qual`` and may have ``mate``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genomics import bound, count_from, fastq_errors, gc_count, qualities, read_id


def head_records(reads: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records, by number, so that no order has to be made."""
    return reads.where(F.col("rec") < n)


def with_errors(reads: DataFrame) -> DataFrame:
    """``reads`` with an array of messages."""
    c = F.col
    return reads.withColumn("errors", fastq_errors(c("rec") + 1, c("header"), c("seq"), c("plus"), c("qual")))


def pair_reads(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """(rec, id1, id2) of records with the same number in both files."""
    a = r1.select("rec", read_id(F.col("header")).alias("id1"))
    return a.join(r2.select("rec", read_id(F.col("header")).alias("id2")), "rec")


def pairing_mismatches(r1: DataFrame, r2: DataFrame, examples: int = 5) -> DataFrame:
    """One row: mismatches and the first few of them as text."""
    bad = pair_reads(r1, r2).where("id1 <> id2")
    text = F.format_string("record %d: %s != %s", F.col("rec") + 1, "id1", "id2")
    few = bad.orderBy("rec").limit(examples).agg(F.sort_array(F.collect_list(F.struct("rec", text.alias("t")))).alias("few"))
    return bad.agg(F.count("*").alias("mismatches")).crossJoin(few.select(F.transform("few", lambda x: x["t"]).alias("examples")))  # one row each


def fastq_check(r1: DataFrame, r2: DataFrame | None = None, n_records: int = 10_000, most_errors: int = 20) -> DataFrame:
    """One row: status, records_checked, format_ok, ids_match, mismatches, errors, warnings.

    Only the first records are looked at. A mismatch of ids warns and never fails.
    """
    sides = [head_records(r, n_records) for r in (r1, r2) if r is not None]
    checked = None
    for i, r in enumerate(sides):
        e = with_errors(r).select(F.lit(i).alias("side"), "rec", "errors")
        checked = e if checked is None else checked.unionByName(e)
    bad = checked.where(F.size("errors") > 0).orderBy("side", "rec").limit(most_errors)
    errors = bad.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("side", "rec", "errors"))), lambda x: x["errors"])).alias("errors"))
    total = checked.agg(F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("records_checked"), F.sum(F.when(F.size("errors") > 0, 1).otherwise(0)).alias("bad"))
    if r2 is not None:
        pairs = pairing_mismatches(*sides)
    else:
        pairs = total.select(F.lit(0).cast("long").alias("mismatches"), F.array().cast("array<string>").alias("examples"))
    one = total.crossJoin(errors).crossJoin(pairs)  # one row each
    ok = F.coalesce(F.col("bad"), F.lit(0)) == 0
    return one.select(
        F.when(ok, "PASS").otherwise("FAIL").alias("status"), F.coalesce("records_checked", F.lit(0)).cast("long").alias("records_checked"), ok.alias("format_ok"),
        (F.col("mismatches") == 0).alias("ids_match"), F.col("mismatches").cast("long").alias("mismatches"), "errors",
        F.transform("examples", lambda x: F.concat(F.lit("ID mismatch at "), x)).alias("warnings"),
    )


def trim_adapter(seq: Column, adapter: str, least: int = 4) -> Column:
    """The length of a read up to the adapter, or to a prefix of it at the end."""
    whole = F.locate(adapter, seq)
    tail = F.coalesce(*[F.when(F.endswith(seq, F.lit(adapter[:k])), F.length(seq) - k) for k in range(len(adapter) - 1, least - 1, -1)], F.length(seq))
    return F.when(whole > 0, whole - 1).otherwise(tail)


def sliding_cut(qual: Column, width: int = 4, mean: int = 20) -> Column:
    """The place of the first window whose mean quality is too low, or the length."""
    low = lambda q: lambda i: sum((F.get(q, i + k) for k in range(1, width)), F.get(q, i)) < mean * width
    first = bound(qualities(qual), lambda q: F.get(F.filter(F.sequence(F.lit(0), F.array_size(q) - width), low(q)), 0))
    return F.when(F.length(qual) < width, F.length(qual)).otherwise(F.coalesce(first, F.length(qual))).cast("int")


def read_clean(
    reads: DataFrame, adapter: str | None = None, poly_g: int = 10, cut_window: int = 0, cut_mean: int = 20, qualified: int = 15,
    unqualified_percent: int = 40, n_limit: int = 5, min_length: int = 15, dedup: bool = False,
) -> DataFrame:
    """``reads`` trimmed, with ``reason``: passed, low_quality, too_many_N, too_short or duplicated."""
    end = F.length("seq")
    if adapter:
        end = F.least(end, trim_adapter(F.col("seq"), adapter))
    if cut_window:
        end = F.least(end, sliding_cut(F.col("qual"), cut_window, cut_mean))
    out = reads.withColumn("__end", end)
    for c in ("seq", "qual"):
        out = out.withColumn(c, F.substring(c, F.lit(1), F.col("__end")))
    if poly_g:
        kept = F.length(F.regexp_replace("seq", f"G{{{poly_g},}}$", ""))
        out = out.withColumn("__end", kept)
        for c in ("seq", "qual"):
            out = out.withColumn(c, F.substring(c, F.lit(1), F.col("__end")))
    bad = F.length("qual") - count_from(F.col("qual"), qualified)
    n = F.length("seq") - F.length(F.translate("seq", "N", ""))
    reason = F.when(100 * bad > unqualified_percent * F.length("qual"), "low_quality").when(n > n_limit, "too_many_N").when(F.length("seq") < min_length, "too_short").otherwise("passed")
    out = out.withColumn("reason", reason).drop("__end")
    if dedup:
        # Equal sequences: the first record stays. Its number is found by a partial aggregate.
        first = out.where("reason = 'passed'").groupBy("seq").agg(F.min("rec").alias("__first"))
        out = out.join(first, "seq", "left").withColumn("reason", F.when((F.col("reason") == "passed") & (F.col("rec") > F.col("__first")), "duplicated").otherwise(F.col("reason"))).drop("__first")
    return out


def filter_reasons(cleaned: DataFrame) -> DataFrame:
    """Reads for each reason."""
    return cleaned.groupBy("reason").agg(F.count("*").alias("n"))


def read_totals(reads: DataFrame, stage: str) -> DataFrame:
    """One row: stage, reads, bases, q20_bases, q30_bases, gc_bases and their rates."""
    s = reads.agg(
        F.count("*").alias("reads"), *[F.coalesce(F.sum(x), F.lit(0)).cast("long").alias(n) for n, x in (
            ("bases", F.length("seq")), ("q20_bases", count_from(F.col("qual"), 20)), ("q30_bases", count_from(F.col("qual"), 30)), ("gc_bases", gc_count(F.col("seq"))))]
    )
    share = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("bases").cast("double")), F.lit(0.0))
    return s.select(F.lit(stage).alias("stage"), "*", share("q20_bases").alias("q20_rate"), share("q30_bases").alias("q30_rate"), share("gc_bases").alias("gc_rate"))


def read_qc(reads: DataFrame, **cleaning) -> DataFrame:
    """Totals before and after cleaning."""
    cleaned = read_clean(reads, **cleaning).where("reason = 'passed'")
    return read_totals(reads, "before").unionByName(read_totals(cleaned, "after"))


def cleaning_counts(reads: DataFrame, adapter: str | None = None, **cleaning) -> DataFrame:
    """section, item, n: reads for each reason, and reads and bases that the adapter's removal cuts."""
    reasons = filter_reasons(read_clean(reads, adapter=adapter, **cleaning)).select(F.lit("reason").alias("section"), F.col("reason").alias("item"), F.col("n").cast("long").alias("n"))
    if not adapter:
        return reasons
    cut = F.length("seq") - F.least(F.length("seq"), trim_adapter(F.col("seq"), adapter))
    one = reads.agg(F.coalesce(F.sum(F.when(cut > 0, 1)), F.lit(0)).cast("long").alias("reads"), F.coalesce(F.sum(cut), F.lit(0)).cast("long").alias("bases"))
    return reasons.unionByName(one.select(F.lit("adapter").alias("section"), F.explode(F.create_map(F.lit("trimmed_reads"), "reads", F.lit("trimmed_bases"), "bases")).alias("item", "n")))


def overrepresented_sequences(reads: DataFrame, percent: float = 0.1, first: int = 50) -> DataFrame:
    """sequence, n, percent: sequences, by their first bases, that are more than so many percent of all reads.

    A summary of frequent items, merged from all tasks, names every sequence that may be
    so frequent, at most 150 / ``percent`` of them; only those are then counted exactly. Empty reads are none.
    """
    share = percent / 100
    if not 1e-5 <= share <= 1:
        raise ValueError("percent is from 0.001 to 100")
    s = reads.select(F.substring("seq", 1, first).alias("sequence")).where("sequence <> ''")
    # The summary's error is below a third of the share, so none of the sequences is lost.
    top = s.agg(F.expr(f"approx_top_k(sequence, {math.ceil(1.5 / share)}, {math.ceil(10 / share)})").alias("top"))
    named = top.select(F.explode("top.item").alias("sequence"))
    counts = s.join(F.broadcast(named), "sequence", "left_semi").groupBy("sequence").agg(F.count("*").alias("n"))
    total = s.agg(F.count("*").alias("__all"))
    out = counts.crossJoin(F.broadcast(total))  # one row
    return out.select("sequence", "n", (100 * F.col("n") / F.col("__all")).alias("percent")).where(F.col("percent") > percent)


def gc_per_sequence(reads: DataFrame) -> DataFrame:
    """gc, n: reads by their share of G and C in whole percent."""
    return reads.where(F.length("seq") > 0).groupBy(F.round(100 * gc_count(F.col("seq")) / F.length("seq")).cast("int").alias("gc")).agg(F.count("*").alias("n"))


def gc_fit(reads: DataFrame) -> DataFrame:
    """One row: centre, sd, deviation and status of the GC of reads against a normal curve.

    The centre is the middle of the neighbours of the commonest value that reach nine
    tenths of it (that value itself if they reach 0 or 100), sd is around the
    centre, and deviation the sum of all differences from the curve in percent of the reads.
    More than 15 warns and more than 30 fails. One value alone does not deviate.
    """
    h = gc_per_sequence(reads).agg(F.map_from_entries(F.collect_list(F.struct("gc", "n"))).alias("m"))  # 101 numbers
    h = h.select(F.transform(F.sequence(F.lit(0), F.lit(100)), lambda i: F.coalesce(F.try_element_at("m", i.cast("int")), F.lit(0).cast("long"))).alias("n")).where("exists(n, x -> x > 0)")
    h = h.withColumns({"whole": F.expr("aggregate(n, 0L, (a, x) -> a + x)"), "mode": F.array_position("n", F.array_max("n")) - 1, "most": F.array_max("n")})
    low = F.expr("array_max(concat(array(-1L), filter(transform(n, (x, i) -> if(10 * x <= 9 * most and i < mode, cast(i as bigint), -1L)), i -> i >= 0))) + 1")
    high = F.expr("array_min(concat(array(101L), filter(transform(n, (x, i) -> if(10 * x <= 9 * most and i > mode, cast(i as bigint), 101L)), i -> i <= 100))) - 1")
    h = h.withColumns({"low": low, "high": high})
    h = h.withColumn("centre", F.when((F.col("low") == 0) | (F.col("high") == 100), F.col("mode").cast("double")).otherwise((F.col("low") + F.col("high")) / 2))
    h = h.withColumn("sd", F.expr("sqrt(aggregate(transform(n, (x, i) -> x * (i - centre) * (i - centre)), 0D, (a, x) -> a + x) / greatest(whole - 1, 1))"))
    gap = F.expr("100 * aggregate(transform(n, (x, i) -> abs(x - whole * exp(-(i - centre) * (i - centre) / (2 * sd * sd)) / (sd * sqrt(2 * pi())))), 0D, (a, x) -> a + x) / whole")
    h = h.withColumn("deviation", F.when(F.col("sd") > 0, gap).otherwise(0.0))
    return h.select("centre", "sd", "deviation", F.when(F.col("deviation") > 30, "FAIL").when(F.col("deviation") > 15, "WARN").otherwise("PASS").alias("status"))


def adapter_content(reads: DataFrame, adapters: dict[str, str]) -> DataFrame:
    """adapter, cycle, percent: reads in which an adapter has begun by a cycle, for the cycles at which it begins in any."""
    found = F.array(*[F.struct(F.lit(k).alias("adapter"), F.locate(v, F.col("seq")).alias("cycle")) for k, v in adapters.items()])
    h = reads.select(F.inline(found)).groupBy("adapter", "cycle").agg(F.count("*").alias("n"))
    w = Window.partitionBy("adapter")  # a row for each cycle
    h = h.withColumns({"__all": F.sum("n").over(w)}).where("cycle > 0")
    return h.select("adapter", "cycle", (100 * F.sum("n").over(w.orderBy("cycle")) / F.col("__all")).alias("percent"))


def fastqc_sequence_modules(reads: DataFrame, adapters: dict[str, str] | None = None, first: int = 50) -> DataFrame:
    """(module, status) of overrepresented sequences, of GC per sequence, and of adapters by cycle."""
    status = lambda bad, odd: F.when(bad, "FAIL").when(odd, "WARN").otherwise("PASS").alias("status")
    most = overrepresented_sequences(reads, 0.1, first).agg(F.max("percent").alias("p"))
    out = most.select(F.lit("overrepresented_sequences").alias("module"), status(F.col("p") > 1, F.col("p") > 0.1))
    out = out.unionByName(gc_fit(reads).select(F.lit("per_sequence_gc_content").alias("module"), "status"))
    if adapters:
        a = adapter_content(reads, adapters).agg(F.max("percent").alias("p"))
        out = out.unionByName(a.select(F.lit("adapter_content").alias("module"), status(F.col("p") > 10, F.col("p") > 5)))
    return out


def duplication_rate(reads: DataFrame) -> DataFrame:
    """One row: reads, distinct, rate."""
    d = reads.groupBy("seq").agg(F.count("*").alias("n")).agg(F.sum("n").alias("reads"), F.count("*").alias("distinct"))
    return d.select(F.coalesce("reads", F.lit(0)).cast("long").alias("reads"), F.col("distinct").cast("long").alias("distinct"), F.coalesce(1 - F.try_divide(F.col("distinct").cast("double"), F.col("reads").cast("double")), F.lit(0.0)).alias("rate"))


def cycle_qualities(reads: DataFrame) -> DataFrame:
    """cycle, quality, n: the histogram from which all quantiles of a cycle follow."""
    e = reads.select(F.posexplode(qualities(F.col("qual"))).alias("cycle", "quality"))
    return e.groupBy((F.col("cycle") + 1).alias("cycle"), "quality").agg(F.count("*").alias("n"))


def per_cycle_quality(reads: DataFrame) -> DataFrame:
    """cycle, mean, q10, lower_quartile, median, upper_quartile, q90, from histograms."""
    w = Window.partitionBy("cycle")
    h = cycle_qualities(reads).withColumn("upto", F.sum("n").over(w.orderBy("quality").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(w))
    at = lambda p: F.min(F.when(100 * F.col("upto") >= p * F.col("all"), F.col("quality"))).cast("int")
    return h.groupBy("cycle").agg((F.sum(F.col("quality") * F.col("n")) / F.sum("n")).alias("mean"), at(10).alias("q10"), at(25).alias("lower_quartile"), at(50).alias("median"), at(75).alias("upper_quartile"), at(90).alias("q90"))


def mean_quality_histogram(reads: DataFrame) -> DataFrame:
    """quality, n: reads by their mean quality, rounded down."""
    q = F.floor(F.aggregate(qualities(F.col("qual")), F.lit(0), lambda a, x: a + x) / F.length("qual"))
    return reads.where(F.length("qual") > 0).groupBy(q.cast("int").alias("quality")).agg(F.count("*").alias("n"))


def cycle_content(reads: DataFrame) -> DataFrame:
    """cycle, a, c, g, t, n: bases of each cycle."""
    e = reads.select(F.posexplode(F.split("seq", "")).alias("cycle", "base"))
    n = lambda b: F.sum(F.when(F.col("base") == b, 1).otherwise(0)).cast("long").alias(b.lower())
    return e.groupBy((F.col("cycle") + 1).alias("cycle")).agg(n("A"), n("C"), n("G"), n("T"), n("N"))


def fastqc_modules(reads: DataFrame, adapters: dict[str, str] | None = None) -> DataFrame:
    """(module, status): PASS, WARN or FAIL of each module, by its usual limits."""
    q = per_cycle_quality(reads).agg(F.min("lower_quartile").alias("low"), F.min("median").alias("mid"))
    base = q.select(F.lit("per_base_sequence_quality").alias("module"), F.when((F.col("low") < 5) | (F.col("mid") < 20), "FAIL").when((F.col("low") < 10) | (F.col("mid") < 25), "WARN").otherwise("PASS").alias("status"))
    top = mean_quality_histogram(reads).agg(F.max_by("quality", F.struct("n", -F.col("quality"))).alias("mode"))
    seq = top.select(F.lit("per_sequence_quality_scores").alias("module"), F.when(F.col("mode") < 20, "FAIL").when(F.col("mode") < 27, "WARN").otherwise("PASS").alias("status"))
    c = cycle_content(reads)
    total = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    gap = F.greatest(F.abs(F.col("a") - F.col("t")), F.abs(F.col("g") - F.col("c"))) / total
    content = c.agg(F.max(gap).alias("gap"), F.max(F.col("n") / (total + F.col("n"))).alias("n"))
    mix = content.select(F.lit("per_base_sequence_content").alias("module"), F.when(F.col("gap") > 0.2, "FAIL").when(F.col("gap") > 0.1, "WARN").otherwise("PASS").alias("status"))
    ns = content.select(F.lit("per_base_n_content").alias("module"), F.when(F.col("n") > 0.2, "FAIL").when(F.col("n") > 0.05, "WARN").otherwise("PASS").alias("status"))
    d = duplication_rate(reads).select(F.lit("sequence_duplication_levels").alias("module"), F.when(F.col("rate") > 0.5, "FAIL").when(F.col("rate") > 0.2, "WARN").otherwise("PASS").alias("status"))
    length = reads.agg(F.min(F.length("seq")).alias("a"), F.max(F.length("seq")).alias("b")).select(F.lit("sequence_length_distribution").alias("module"), F.when(F.col("a") == 0, "FAIL").when(F.col("a") < F.col("b"), "WARN").otherwise("PASS").alias("status"))
    out = base.unionByName(seq).unionByName(mix).unionByName(ns).unionByName(d).unionByName(length)
    for name, adapter in (adapters or {}).items():
        share = reads.agg((F.sum(F.when(F.contains("seq", F.lit(adapter)), 1).otherwise(0)) / F.count("*")).alias("s"))
        out = out.unionByName(share.select(F.lit(f"adapter_content_{name}").alias("module"), F.when(F.col("s") > 0.1, "FAIL").when(F.col("s") > 0.05, "WARN").otherwise("PASS").alias("status")))
    return out
