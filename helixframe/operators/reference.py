"""The reference sequence as chunks of equal width, met by (chrom, chunk) and never base by base.

``reference_chunks`` makes them of the lines of a FASTA file (``sources.formats.fasta_chunks``).
A row is ``chrom, chunk, first, seq``: the bases of one chunk with one base more on either side,
in upper case; ``first`` is the 0-based place of the first. Blocks of reads and regions are cut at
the edges of chunks, so each part meets one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genomics import gc_count
from .intervals import windows

#: Bases of a chunk.
CHUNK = 4096

#: What stands for a base that is not to be looked at.
MASK = "*"


def reference_chunks(lines: DataFrame, width: int = CHUNK) -> DataFrame:
    """Chunks of the sequence lines (chrom, offset, seq); lines are cut where chunks end."""
    end = F.col("offset") + F.length("seq")
    near = F.sequence(F.greatest(F.floor((F.col("offset") - 1) / width), F.lit(0)), F.floor(end / width))
    p = lines.where(F.length("seq") > 0).select("chrom", "offset", "seq", end.alias("end"), F.explode(near).alias("chunk"))
    low, high = F.greatest(F.col("offset"), F.col("chunk") * width - 1), F.least(F.col("end"), (F.col("chunk") + 1) * width + 1)
    p = p.select("chrom", "chunk", low.alias("first"), F.upper(F.substring("seq", (low - F.col("offset") + 1).cast("int"), (high - low).cast("int"))).alias("seq")).where("seq <> ''")
    parts = F.array_sort(F.collect_list(F.struct("first", "seq")))
    whole = p.groupBy("chrom", "chunk").agg(parts.alias("parts"))  # at most width + 2 bases
    # A chunk that has only the base after the one before it holds nothing of its own.
    out = whole.select("chrom", "chunk", F.get("parts", 0)["first"].alias("first"), F.array_join(F.col("parts.seq"), "").alias("seq"))
    return out.where(F.col("first") + F.length("seq") > F.col("chunk") * width)


def mask_sites(chunks: DataFrame, sites: DataFrame, width: int = CHUNK) -> DataFrame:
    """``chunks`` in which the bases at 1-based ``sites`` (chrom, pos) are masked."""
    at = F.col("pos") - 1
    near = F.array_distinct(F.array(F.floor((at - 1) / width), F.floor(at / width), F.floor((at + 1) / width)))
    s = sites.where("pos is not null").select("chrom", at.alias("at"), F.explode(near).alias("chunk")).distinct()
    s = s.groupBy("chrom", "chunk").agg(F.collect_list("at").alias("__sites"))  # at most width + 2
    place = lambda p: (p - F.col("first") + 1).cast("int")
    inside = F.filter("__sites", lambda p: place(p).between(1, F.length("seq")))
    masked = F.aggregate(inside, F.col("seq"), lambda a, p: F.overlay(a, F.lit(MASK), place(p), F.lit(1)))
    return chunks.join(s, ["chrom", "chunk"], "left").select("chrom", "chunk", "first", F.when(F.col("__sites").isNull(), F.col("seq")).otherwise(masked).alias("seq"))


def reference_at(points: DataFrame, chunks: DataFrame, width: int = CHUNK) -> DataFrame:
    """``points`` with the base ``ref`` at their 1-based ``pos``; those that the reference does not reach are left out."""
    c = chunks.select("chrom", F.col("chunk").alias("__chunk"), F.col("first").alias("__first"), F.col("seq").alias("__ref"))
    p = points.withColumn("__chunk", F.floor((F.col("pos") - 1) / width))
    ref = F.substring("__ref", (F.col("pos") - F.col("__first")).cast("int"), F.lit(1))
    return p.join(c, ["chrom", "__chunk"]).select(*[F.col(x) for x in points.columns], ref.alias("ref")).where("ref <> ''")


def cut_at_chunks(blocks: DataFrame, start: str, end: str, width: int = CHUNK) -> DataFrame:
    """``blocks`` with ``__chunk``, ``__s`` and ``__e``: one row for the part of a block in each chunk."""
    b = blocks.where(F.col(start) < F.col(end)).withColumn("__chunk", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    return b.withColumns({"__s": F.greatest(F.col(start), F.col("__chunk") * width), "__e": F.least(F.col(end), (F.col("__chunk") + 1) * width)})


def reference_of(blocks: DataFrame, chunks: DataFrame, start: str, end: str, around: int = 0, width: int = CHUNK) -> DataFrame:
    """Parts of ``blocks`` (``__s``, ``__e``) with ``ref``, their reference sequence; with ``around`` = 1 also a base on either side.

    Bases beyond a contig are spaces; parts in chunks that the reference lacks are left out.
    """
    c = chunks.select("chrom", F.col("chunk").alias("__chunk"), F.col("first").alias("__first"), F.col("seq").alias("__ref"))
    j = cut_at_chunks(blocks, start, end, width).join(c, ["chrom", "__chunk"])
    low, n = F.col("__s") - around - F.col("__first"), (F.col("__e") - F.col("__s") + 2 * around).cast("int")
    before = F.repeat(F.lit(" "), F.greatest(-low, F.lit(0)).cast("int"))
    ref = F.concat(before, F.substring("__ref", (F.greatest(low, F.lit(0)) + 1).cast("int"), n + F.least(low, F.lit(0)).cast("int")))
    return j.select(*[F.col(x) for x in blocks.columns], "__s", "__e", F.rpad(ref, n, F.lit(" ")).alias("ref"))


def region_gc(regions: DataFrame, chunks: DataFrame, width: int = CHUNK) -> DataFrame:
    """(chrom, start_pos, end_pos, gc, acgt): bases of G or C, and those that are known, of the distinct regions; 0 where the reference has none."""
    keys = ["chrom", "start_pos", "end_pos"]
    r = regions.select(*keys).distinct()
    p = reference_of(r, chunks, "start_pos", "end_pos", width=width)
    known = F.length("ref") - F.length(F.translate("ref", "ACGT", ""))
    g = p.groupBy(*keys).agg(F.sum(gc_count(F.col("ref"))).cast("long").alias("gc"), F.sum(known).cast("long").alias("acgt"))
    return r.join(g, keys, "left").na.fill(0, ["gc", "acgt"])


def gc_depth(runs: DataFrame, chunks: DataFrame, contigs: DataFrame, width: int = 20_000, keys: tuple[str, ...] = (), at: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    """keys, gc, windows, share, p10, ...: percentiles of mean depth of the windows of equal GC, in whole percent.

    Contigs are cut into windows of one width. ``share`` is the percentage of windows with this much GC or
    less. A percentile is the least depth that so many of a hundred windows do not exceed. Windows
    without a known base are left out. All follows from a histogram of (gc, depth).
    """
    w = windows(contigs, width)
    g = region_gc(w, chunks).where("acgt > 0").select("chrom", F.floor(F.col("start_pos") / width).alias("window"), (F.col("end_pos") - F.col("start_pos")).alias("size"), F.round(100 * F.col("gc") / F.col("acgt")).cast("int").alias("gc"))
    if keys:
        g = g.crossJoin(F.broadcast(runs.select(*keys).distinct()))  # windows for each sample, of which there are few
    cut = cut_at_chunks(runs.where("depth > 0"), "start_pos", "end_pos", width)
    d = cut.groupBy(*keys, "chrom", F.col("__chunk").alias("window")).agg(F.sum(F.col("depth") * (F.col("__e") - F.col("__s"))).alias("bases"))
    d = g.join(d, [*keys, "chrom", "window"], "left").withColumn("depth", F.coalesce("bases", F.lit(0)) / F.col("size"))
    h = d.groupBy(*keys, "gc", "depth").agg(F.count("*").alias("n"))
    p = _percentiles(h, [*keys, "gc"], "depth", at)
    by = ", ".join(keys)
    over = f"(partition by {by} order by gc)" if keys else "(order by gc)"  # at most 101 rows
    whole = f"(partition by {by})" if keys else "()"
    return p.withColumn("share", F.expr(f"100 * sum(windows) over {over} / sum(windows) over {whole}")).select(*keys, "gc", "windows", "share", *[f"p{a}" for a in at])


def _percentiles(h: DataFrame, keys: list[str], value: str, at: tuple[int, ...]) -> DataFrame:
    """keys, windows, p<a>: from a histogram (keys, value, n)."""
    upto = F.expr(f"sum(n) over (partition by {', '.join(keys)} order by {value})")
    whole = F.expr(f"sum(n) over (partition by {', '.join(keys)})")
    c = h.withColumns({"__upto": upto, "__all": whole})
    return c.groupBy(*keys).agg(F.sum("n").cast("long").alias("windows"), *[F.min(F.when(100 * F.col("__upto") >= a * F.col("__all"), F.col(value))).alias(f"p{a}") for a in at])


def mismatches(seq: Column, ref: Column) -> Column:
    """The number of places where two sequences of equal length have different known bases."""
    differ = F.zip_with(F.split(seq, ""), F.split(ref, ""), lambda a, b: (a != b) & a.isin(*"ACGT") & b.isin(*"ACGT"))
    return F.size(F.filter(differ, lambda x: x))
