"""Tables of quality and load for samples and cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genomics import mouse_id, tissue

# The columns of the report.
REPORT_COLUMNS = ("mouse_id", "sample", "normal", "tissue", "n_total", "n_snv", "n_indel", "callable_mb", "load", "percent_duplication", "mean_target_coverage", "pct_target_bases_20x")


def with_sample_fields(df: DataFrame, sample: str = "sample") -> DataFrame:
    """``df`` with mouse_id and tissue."""
    return df.withColumns({"mouse_id": mouse_id(F.col(sample)), "tissue": tissue(F.col(sample))})


def tumor_normal_pairs(pairs: DataFrame, counts: DataFrame, duplication: DataFrame | None = None, coverage: DataFrame | None = None) -> DataFrame:
    """Pairs (tumor, normal) with the counts of the tumour; pairs without counts are left out."""
    out = pairs.withColumnRenamed("tumor", "sample").join(counts, "sample")
    for more in (duplication, coverage):
        if more is not None:
            out = out.join(more, "sample", "left")
    return out


def mutational_load_report(pairs: DataFrame, loads: DataFrame, duplication: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row for each tumour with counts, in the columns of the report."""
    out = with_sample_fields(tumor_normal_pairs(pairs, loads, duplication, coverage))
    return out.select(*REPORT_COLUMNS)


def join_qc_to_load(loads: DataFrame, qc: DataFrame, key: str = "sample") -> DataFrame:
    """``loads`` with the columns of ``qc``; where both have one, a value of ``qc`` counts."""
    q = qc.select(key, *[F.col(c).alias(f"__{c}") for c in qc.columns if c != key])
    j = loads.join(q, key, "left")
    own = [F.coalesce(f"__{c}", c).alias(c) if c in qc.columns and c != key else F.col(c) for c in loads.columns]
    return j.select(*own, *[F.col(f"__{c}").alias(c) for c in qc.columns if c not in loads.columns])


def cohort_summary(loads: DataFrame, qc: DataFrame) -> DataFrame:
    """One row: samples, tumours, mean, least and largest load, mean mapping, duplication and coverage."""
    a = loads.agg(F.countDistinct("sample").alias("n_tumors"), F.avg("load").alias("mean_load"), F.min("load").alias("min_load"), F.max("load").alias("max_load"))
    b = qc.agg(F.countDistinct("sample").alias("n_samples"), *[F.avg(c).alias(f"mean_{c}") for c in qc.columns if c != "sample"])
    return a.crossJoin(b)  # one row each


TISSUES = ("Kidney", "SCC", "Other")


def load_by_tissue(loads: DataFrame) -> DataFrame:
    """tissue, place, n and the quartiles of the load, in the order of the plot; null loads are left out."""
    v = with_sample_fields(loads).where(F.col("load").isNotNull())
    place = F.coalesce(*[F.when(F.col("tissue") == t, F.lit(i)) for i, t in enumerate(TISSUES)])
    q = lambda p: F.percentile("load", F.lit(p))
    return v.groupBy("tissue", place.alias("place")).agg(F.count("*").alias("n"), F.min("load").alias("min"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("load").alias("max"))


def load_by_mouse(loads: DataFrame) -> DataFrame:
    """mouse_id, median_load; of an even number the mean of the middle two."""
    return with_sample_fields(loads).where(F.col("load").isNotNull()).groupBy("mouse_id").agg(F.median("load").alias("median_load"))


def to_long(wide: DataFrame, key: str = "sample", prefix: str = "") -> DataFrame:
    """sample, metric, value: a row for each column that has a value, as text."""
    names = [c for c in wide.columns if c != key]
    m = F.create_map(*[x for c in names for x in (F.lit(prefix + c), F.col(c).cast("string"))])
    return wide.select(key, F.explode(m).alias("metric", "value")).where(F.col("value").isNotNull())


def qc_summary_long(fastp: DataFrame, fastqc: DataFrame, check: DataFrame | None = None) -> DataFrame:
    """Rows of a sample from cleaning (wide) and from modules (sample, label, read, module, status)."""
    m = fastqc.select("sample", F.concat_ws("_", F.lit("fastqc"), "label", "read", "module").alias("metric"), F.col("status").alias("value"))
    out = to_long(fastp, prefix="fastp_").unionByName(m)
    return out.unionByName(to_long(check, prefix="check_")) if check is not None else out


def glob(name: Column, pattern: str) -> Column:
    """Whether a name fits a pattern of ``*`` and ``?``."""
    import re

    return name.rlike("^" + re.escape(pattern).replace(r"\*", ".*").replace(r"\?", ".") + "$")


def multi_qc(tables: dict[str, DataFrame], include: list[str] | None = None, exclude: list[str] = (), ignore_samples: list[str] = (), only_samples: list[str] = (), rename: dict[str, str] | None = None, metrics: list[str] | None = None) -> DataFrame:
    """One row for each sample with the metrics of all modules, from long tables (sample, metric, value).

    Give ``metrics`` to spare the pass that finds their names.
    """
    out = None
    for name, t in tables.items():
        if name in exclude or include is not None and name not in include:
            continue
        own = t.select("sample", F.concat_ws(".", F.lit(name), "metric").alias("metric"), "value")
        out = own if out is None else out.unionByName(own)
    for p in ignore_samples:
        out = out.where(~glob(F.col("sample"), p))
    if only_samples:
        test = F.lit(False)
        for p in only_samples:
            test = test | glob(F.col("sample"), p)
        out = out.where(test)
    if rename:
        out = out.withColumn("sample", F.coalesce(F.create_map(*[F.lit(x) for kv in rename.items() for x in kv])[F.col("sample")], "sample"))
    return out.groupBy("sample").pivot("metric", metrics).agg(F.min("value"))


def qc_tables(reads: DataFrame, targets: DataFrame | None = None) -> dict[str, DataFrame]:
    """Long tables (sample, metric, value) of the metrics of aligned reads, by tool, as :func:`multi_qc` takes them.

    ``flagstat``, ``alignment`` and ``insert_size`` (with the category or orientation before the metric),
    ``duplication``, of reads whose duplicates are marked here, and ``coverage``: callable bases
    at a depth of 1, 10 and 20 in all contigs, or in the merged ``targets``.
    """
    from . import alignments as A
    from . import depth as D
    from .intervals import interval_join, merge_intervals

    def by(df: DataFrame, item: str) -> DataFrame:
        names = [c for c in df.columns if c not in ("sample", item)]
        m = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))])
        long = df.select("sample", item, F.explode(m).alias("metric", "value")).where(F.col("value").isNotNull())
        return long.select("sample", F.concat_ws(".", item, "metric").alias("metric"), "value")

    out = {"flagstat": to_long(A.flagstat(reads)), "alignment": by(A.alignment_summary(reads), "category"), "duplication": to_long(A.duplication_metrics(A.mark_duplicates(reads)))}
    if "tlen" in reads.columns:
        out["insert_size"] = by(A.insert_size_metrics(reads), "orientation")
    runs = D.per_base_depth(D.aligned_blocks(D.read_filter(reads), ("sample",)), keys=("sample",))
    if targets is not None:
        pairs = interval_join(runs, merge_intervals(targets).drop("n"), ("right",))
        runs = pairs.select("sample", "chrom", F.greatest("start_pos", "r_start_pos").alias("start_pos"), F.least("end_pos", "r_end_pos").alias("end_pos"), "depth")
    size = F.col("end_pos") - F.col("start_pos")
    out["coverage"] = to_long(runs.groupBy("sample").agg(*[F.sum(F.when(F.col("depth") >= d, size).otherwise(0)).cast("long").alias(f"bases_{d}x") for d in (1, 10, 20)], F.sum(size * F.col("depth")).cast("long").alias("bases")))
    return out


def sample_report(qc: DataFrame, loads: DataFrame) -> DataFrame:
    """(sample, report): JSON of a sample's quality, and of its load if it is a tumour."""
    j = qc.select("sample", F.struct(*[c for c in qc.columns if c != "sample"]).alias("qc")).join(loads.select("sample", F.struct(*[c for c in loads.columns if c != "sample"]).alias("load")), "sample", "left")
    return j.select("sample", F.to_json(F.struct("sample", "qc", "load")).alias("report"))


def output_conflicts(claims: DataFrame) -> DataFrame:
    """Paths that more than one key claims: path, n_keys, keys."""
    return claims.groupBy("path").agg(F.countDistinct("key").alias("n_keys"), F.array_sort(F.collect_set("key")).alias("keys")).where("n_keys > 1")


def stale_inputs(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, reason) of inputs that are new, changed or missing; all are new on a first run."""
    j = before.select("path", F.col("signature").alias("a")).join(now.select("path", F.col("signature").alias("b")), "path", "full_outer")
    reason = F.when(F.col("a").isNull(), "First run").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "does not match")
    return j.select("path", reason.alias("reason")).where(F.col("reason").isNotNull())
