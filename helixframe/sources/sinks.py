"""Writers of sequencing text formats and reports. Each takes a DataFrame and a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report_tsv(df: DataFrame, path: str, columns: list[str]) -> None:
    """A header and the given columns; nulls are empty."""
    df.select(*columns).write.csv(path, sep="\t", header=True, nullValue="", emptyValue="", mode="overwrite")


def load_columns(df: DataFrame, primary: list[str]) -> DataFrame:
    """Primary columns first; fractions as text with four places."""
    order = [c for c in primary if c in df.columns] + [c for c in df.columns if c not in primary]
    kinds = dict(df.dtypes)
    return df.select(*[F.format_string("%.4f", c).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in order])


def write_load_tsv(df: DataFrame, path: str, primary: list[str]) -> None:
    write_report_tsv(load_columns(df, primary), path, load_columns(df, primary).columns)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path, mode="overwrite", ignoreNullFields=False)


def bed_lines(bed: DataFrame, rest: bool = True) -> DataFrame:
    """BED lines in order of place within partitions."""
    more = [c for c in bed.columns if c not in ("chrom", "start_pos", "end_pos")] if rest else []
    return bed.sortWithinPartitions("chrom", "start_pos").select(F.concat_ws("\t", "chrom", "start_pos", "end_pos", *more).alias("value"))


def write_bed(bed: DataFrame, path: str) -> None:
    bed_lines(bed).write.mode("overwrite").text(path)


def interval_list_lines(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """Dictionary lines and 1-based intervals in the order of the dictionary; one total order."""
    head = contigs.select(F.lit(0).alias("k"), F.col("chrom").alias("c"), F.lit(0).cast("long").alias("s"), F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "chrom"), F.concat(F.lit("LN:"), "length")).alias("value"))
    body = intervals.select(F.lit(1).alias("k"), F.col("chrom").alias("c"), F.col("start_pos").alias("s"), F.concat_ws("\t", "chrom", "start_pos", "end_pos", F.lit("+"), F.coalesce("name", F.lit(".")) if "name" in intervals.columns else F.lit(".")).alias("value"))
    return head.unionByName(body).orderBy("k", "c", "s", "value").select("value")


def write_interval_list(intervals: DataFrame, contigs: DataFrame, path: str) -> None:
    interval_list_lines(intervals, contigs).write.mode("overwrite").text(path)


def vcf_lines(variants: DataFrame) -> DataFrame:
    """VCF lines of variants with info and samples."""
    entry = lambda k, v: F.when(v == "", k).otherwise(F.concat(k, F.lit("="), v))
    info = F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda e: entry(e["key"], e["value"])), ";")
    keys = F.array_sort(F.map_keys(F.get("samples", 0)["fmt"]))
    fmt = F.array_sort(keys, lambda a, b: F.when(a == b, 0).when(a == "GT", -1).when(b == "GT", 1).when(a < b, -1).otherwise(1))
    samples = F.transform("samples", lambda s: F.array_join(F.transform(fmt, lambda k: F.coalesce(F.try_element_at(s["fmt"], k), F.lit("."))), ":"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    qual = F.when(F.col("qual") == F.floor("qual"), F.col("qual").cast("long").cast("string")).otherwise(F.col("qual").cast("string"))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), text("id"), "ref", "alt", F.coalesce(qual, F.lit(".")), text("filter"), F.when(F.size("info") > 0, info).otherwise("."), F.when(F.size("samples") > 0, F.concat_ws("\t", F.array_join(fmt, ":"), F.array_join(samples, "\t"))))
    return variants.select("chrom", "pos", line.alias("value"))


def write_vcf(variants: DataFrame, path: str, samples: list[str] = ()) -> None:
    """Gzipped lines in order; the first line of every part stands under a header, so each part is whole."""
    columns = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *samples] if samples else [])])
    head = f"##fileformat=VCFv4.2\n{columns}"
    # The low bits of this number count the rows of a part.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    body = vcf_lines(variants).orderBy("chrom", "pos", "value").select(F.when(first, F.concat(F.lit(head + "\n"), "value")).otherwise(F.col("value")).alias("value"))
    body.write.mode("overwrite").text(path, compression="gzip")
    if variants.sparkSession.read.text(path).isEmpty():  # what was written is read, not the plan again
        variants.sparkSession.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(path, compression="gzip")


def check_lines(check: DataFrame, sample: str = "sample", pairing: str = "pairing") -> DataFrame:
    """(sample, value): the result of a check of reads as text."""
    c = F.col
    shown = lambda name: F.concat(F.lit(f"  {name}: "), F.coalesce(F.when(c(name).cast("string") == "true", "True").when(c(name).cast("string") == "false", "False").otherwise(c(name).cast("string")), F.lit("None")))
    listed = lambda title, name: F.when(F.size(name) > 0, F.concat(F.array(F.lit(""), F.lit(f"{title}:")), F.transform(name, lambda x: F.concat(F.lit("  - "), x)))).otherwise(F.array().cast("array<string>"))
    head = F.array(F.concat(F.lit("FASTQ Input Check for "), c(sample)), F.lit("=" * 60), F.lit(""), F.concat(F.lit("Status: "), "status"), F.concat(F.lit("Pairing: "), c(pairing)), F.lit(""), F.lit("Checks:"))
    checks = F.array(*[shown(x) for x in ("records_checked", "format_ok", "ids_match", "mismatches")])
    lines = F.concat(head, checks, listed("Errors", "errors"), listed("Warnings", "warnings"))
    return check.select(c(sample).alias("sample"), F.array_join(lines, "\n").alias("value"))


def write_check(check: DataFrame, path: str, sample: str = "sample", pairing: str = "pairing") -> None:
    """The text of each check; a folder for each sample."""
    check_lines(check, sample, pairing).write.mode("overwrite").partitionBy("sample").text(path)


def write_fastq(reads: DataFrame, path: str) -> None:
    """Four lines for each record, in order of number."""
    reads.orderBy("rec").select(F.concat_ws("\n", "header", "seq", "plus", "qual").alias("value")).write.mode("overwrite").text(path)
