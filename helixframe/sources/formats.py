"""Readers of sequencing text formats. Each gives a DataFrame; files may be gzipped."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.genomics import as_double, reverse_complement
from ..operators.intervals import interval_join
from ..operators.reference import CHUNK, cut_at_chunks


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, line, value): lines with their number in their file, from 0.

    A scan reads the lines of one block of a file in a row, so the running number of
    its rows orders them; lines of earlier blocks come from one count for each block.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value"
    )
    blocks = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("path", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(starts, ["path", "block"]).select("path", (F.col("id") + F.col("shift")).alias("line"), "value")


def fastq_records(lines: DataFrame) -> DataFrame:
    """(path, rec, header, seq, plus, qual) from numbered lines; an empty header line ends a file."""
    rec, part = F.floor(F.col("line") / 4), F.col("line") % 4
    at = lambda k: F.max(F.when(part == k, F.col("value")))
    r = lines.groupBy("path", rec.alias("rec")).agg(at(0).alias("header"), at(1).alias("seq"), at(2).alias("plus"), at(3).alias("qual"))
    # From the lines, so that records are grouped once. A row for each file that has such a line, of the paths that the driver lists.
    ends = lines.where((part == 0) & (F.col("value") == "")).groupBy("path").agg(F.min(rec).alias("__end"))
    r = r.join(F.broadcast(ends), "path", "left").where("__end is null or rec < __end").drop("__end")
    return r.select("path", "rec", "header", *[F.coalesce(c, F.lit("")).alias(c) for c in ("seq", "plus", "qual")])


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of FASTQ files with their number."""
    return fastq_records(numbered_lines(spark, path))


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chrom, start_pos, end_pos, rest) of BED lines; comments, track and browser lines are skipped."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").rlike("^(#|track|browser)")).where(F.size(parts) >= 3)
    return lines.select(F.get(parts, 0).alias("chrom"), F.get(parts, 1).cast("long").alias("start_pos"), F.get(parts, 2).cast("long").alias("end_pos"), F.slice(parts, 4, 1 << 20).alias("rest"))


def parse_vcf(lines: DataFrame, names: Column | None = None) -> DataFrame:
    """Variants from VCF lines in column ``value``; ``names`` is an array of sample names.

    Short lines and header lines are skipped; a quality that is no number is null.
    """
    v = lines.where(~F.startswith("value", F.lit("#"))).withColumn("__p", F.split("value", "\t")).where(F.size("__p") >= 8)
    at = lambda i: F.get("__p", i)
    entries = F.transform(F.split(at(7), ";"), lambda x: F.struct(F.get(F.split(x, "=", 2), 0).alias("key"), F.coalesce(F.get(F.split(x, "=", 2), 1), F.lit("")).alias("value")))
    distinct = F.filter(entries, lambda x, i: F.array_position(F.transform(entries, lambda y: y["key"]), x["key"]) == i + 1)
    info = F.when(at(7) == ".", F.create_map().cast("map<string,string>")).otherwise(F.map_from_entries(distinct))
    columns = F.slice("__p", 10, 1 << 20)
    keys = F.split(at(8), ":")
    values = lambda s: F.split(s, ":")
    fmt = lambda s: F.map_from_arrays(F.slice(keys, 1, F.least(F.size(keys), F.size(values(s)))), F.slice(values(s), 1, F.least(F.size(keys), F.size(values(s)))))
    named = F.zip_with(columns, F.coalesce(names, F.array().cast("array<string>")) if names is not None else F.array().cast("array<string>"), lambda s, n: F.struct(n.alias("name"), s.alias("s")))
    samples = F.transform(F.filter(named, lambda x: x["s"].isNotNull()), lambda x: F.struct(x["name"].alias("name"), fmt(x["s"]).alias("fmt")))
    return v.select(
        at(0).alias("chrom"), at(1).cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), at(4).alias("alt"), as_double(at(5)).alias("qual"), at(6).alias("filter"), info.alias("info"),
        F.when(F.size("__p") >= 10, samples).otherwise(F.array().cast("array<struct<name:string,fmt:map<string,string>>>")).alias("samples"),
    )


def read_vcf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Variants of VCF files. Sample names come from the header of each file; a part file without one has those of its folder."""
    file = F.col("_metadata.file_path")
    lines = spark.read.text(path).select("value", file.alias("file"), F.regexp_replace(file, "/[^/]*$", "").alias("folder"))
    heads = lines.where(F.startswith("value", F.lit("#CHROM"))).select("folder", "file", F.slice(F.split("value", "\t"), 10, 1 << 20).alias("names"))
    # A row for each file, and for each folder; Spark broadcasts them only if they are small.
    by_file, by_folder = heads.groupBy("file").agg(F.first("names").alias("own")), heads.groupBy("folder").agg(F.min_by("names", "file").alias("shared"))
    joined = lines.where(~F.startswith("value", F.lit("#"))).join(by_file, "file", "left").join(by_folder, "folder", "left")
    return parse_vcf(joined, F.coalesce("own", "shared"))


def consequence_lines(lines: DataFrame) -> DataFrame:
    """(csq): the consequences of each line of a VCF file that is no header; null for short lines and those without."""
    parts = F.split("value", "\t")
    info = F.when(F.size(parts) >= 8, F.get(parts, 7))
    own = F.get(F.filter(F.split(info, ";"), lambda x: F.startswith(x, F.lit("CSQ="))), 0)
    return lines.where(~F.startswith("value", F.lit("#"))).select(F.substring(own, 5, 1 << 30).alias("csq"))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments from SAM lines in column ``value``."""
    p = F.split("value", "\t")
    at = lambda i: F.get(p, i)
    tags = F.filter(F.slice(p, 12, 1 << 20), lambda x: x.rlike("^(RG|NM):"))
    tag = lambda k: F.get(F.transform(F.filter(tags, lambda x: F.startswith(x, F.lit(k))), lambda x: F.get(F.split(x, ":", 3), 2)), 0)
    return lines.where(~F.startswith("value", F.lit("@"))).where(F.size(p) >= 11).select(
        at(0).alias("qname"), at(1).cast("int").alias("flag"), at(2).alias("chrom"), at(3).cast("long").alias("pos"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(6).alias("rnext"),
        at(7).cast("long").alias("pnext"), at(8).cast("long").alias("tlen"), at(9).alias("seq"), at(10).alias("qual"), tag("RG").alias("read_group"), tag("NM").try_cast("int").alias("nm"),
    )


def read_sam_table(spark: SparkSession, path: str | list[str], sample: str | None = None) -> DataFrame:
    """Alignments of SAM text, or of Parquet with the same columns."""
    first = path if isinstance(path, str) else path[0]
    df = spark.read.parquet(path) if first.rstrip("/").endswith(".parquet") else parse_sam(spark.read.text(path))
    return df.withColumn("sample", F.lit(sample)) if sample is not None else df


FASTP = (
    "summary struct<before_filtering:struct<total_reads:bigint,total_bases:bigint,q20_rate:double,q30_rate:double,gc_content:double>,"
    "after_filtering:struct<total_reads:bigint,total_bases:bigint,q20_rate:double,q30_rate:double,gc_content:double>>,"
    "duplication struct<rate:double>, adapter_cutting struct<adapter_trimmed_reads:bigint,adapter_trimmed_bases:bigint>,"
    "filtering_result struct<passed_filter_reads:bigint,low_quality_reads:bigint,too_many_N_reads:bigint,too_short_reads:bigint>"
)


def read_fastp_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row for each report: file and its metrics; null where the section is absent, 0 where only the value is."""
    raw = spark.read.schema(FASTP).option("multiLine", True).json(path).select("*", F.col("_metadata.file_path").alias("file"))
    out = [F.col("file")]
    for stage in ("before", "after"):
        for k in ("total_reads", "total_bases", "q20_rate", "q30_rate", "gc_content"):
            section = F.col(f"summary.{stage}_filtering")
            out.append(F.when(section.isNotNull(), F.coalesce(section[k], F.lit(0))).alias(f"{stage}_{k}"))
    for section, keys in (("duplication", ["rate"]), ("adapter_cutting", ["adapter_trimmed_reads", "adapter_trimmed_bases"]), ("filtering_result", ["passed_filter_reads", "low_quality_reads", "too_many_N_reads"])):
        out += [F.when(F.col(section).isNotNull(), F.coalesce(F.col(section)[k], F.lit(0))).alias("duplication_rate" if k == "rate" else k) for k in keys]
    return raw.select(*out)


def read_fastqc(spark: SparkSession, path: str) -> DataFrame:
    """(file, modules, total_sequences, sequence_length, gc_percent) of zipped reports."""
    return parse_fastqc(spark.read.format("binaryFile").load(path).select("path", "content"))


def parse_fastqc(files: DataFrame) -> DataFrame:
    """The result of :func:`read_fastqc` from (path, content).

    Zip archives need Python to open; everything after that is SQL.
    """
    def unzip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for p, c in zip(f.path, f.content, strict=True):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    for name in z.namelist():
                        kind = name.rsplit("/", 1)[-1]
                        if kind in ("summary.txt", "fastqc_data.txt"):
                            rows += [(p, kind, i, x) for i, x in enumerate(z.read(name).decode().splitlines())]
            yield pd.DataFrame(rows, columns=["file", "kind", "line", "value"])

    lines = files.select("path", "content").mapInPandas(unzip, "file string, kind string, line int, value string")
    p = F.split("value", "\t")
    name = F.replace(F.lower(F.get(p, 1)), F.lit(" "), F.lit("_"))
    modules = lines.where("kind = 'summary.txt'").where(F.size(p) >= 2).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct(name, F.get(p, 0)))).alias("modules"))
    data = lines.where("kind = 'fastqc_data.txt'")
    w = Window.partitionBy("file").orderBy("line")
    section = F.last(F.when(F.startswith("value", F.lit(">>")), F.col("value")), ignorenulls=True).over(w)
    basic = data.withColumn("section", section).where(F.startswith("section", F.lit(">>Basic Statistics")))
    value = lambda k: F.max(F.when(F.get(p, 0) == k, F.get(p, 1)))
    stats = basic.groupBy("file").agg(value("Total Sequences").try_cast("long").alias("total_sequences"), value("Sequence length").alias("sequence_length"), value("%GC").try_cast("double").alias("gc_percent"))
    return modules.join(stats, "file", "left")


def picard_rows(lines: DataFrame, required: list[str]) -> DataFrame:
    """(path, metrics): the first row of equal width under the header that has the required columns."""
    l = lines.where((F.trim("value") != "") & ~F.startswith("value", F.lit("#"))).select("path", "line", F.split("value", "\t").alias("p"))
    has = F.lit(True)
    for r in required:
        has = has & F.array_contains("p", r)
    heads = l.where(has).groupBy("path").agg(F.min_by("p", "line").alias("names"), F.min("line").alias("h"))
    body = l.join(heads, "path").where((F.col("line") > F.col("h")) & (F.size("p") == F.size("names")))
    first = body.groupBy("path").agg(F.min_by(F.struct("names", "p"), "line").alias("r"))
    return first.select("path", F.map_from_arrays("r.names", "r.p").alias("metrics"))


def read_picard_metrics(spark: SparkSession, path: str | list[str], required: list[str]) -> DataFrame:
    """Metrics files as maps; use ``try_cast`` on what is a number."""
    return picard_rows(numbered_lines(spark, path), required)


def read_depth(spark: SparkSession, path: str | list[str], kind: str = "int") -> DataFrame:
    """(chrom, start_pos, end_pos, depth) of per-base or region files."""
    return spark.read.csv(path, sep="\t", comment="#", schema=f"chrom string, start_pos long, end_pos long, depth {kind}")


def read_mosdepth_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chrom, length, bases, mean, min, max) of a depth summary."""
    return spark.read.csv(path, sep="\t", header=True, schema="chrom string, length long, bases long, mean double, min long, max long")


def read_kv_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(key, value, number): two columns; ``number`` is null where the value is none."""
    raw = spark.read.csv(path, sep="\t", schema="key string, value string").where("value is not null")
    return raw.withColumn("number", as_double(F.col("value")))


def read_contigs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(chrom, length): the first two columns of an index or a sizes file."""
    p = F.split("value", "\t")
    return spark.read.text(path).where(F.size(p) >= 2).select(F.get(p, 0).alias("chrom"), F.get(p, 1).cast("long").alias("length"))


def fasta_chunks(lines: DataFrame, block: int = 10_000) -> DataFrame:
    """(path, chrom, offset, seq): sequence lines with their place in their contig.

    The contig of a line is the last header before it, and its place the length of
    lines since; both are carried over blocks of lines, not over a whole file.
    """
    head = F.startswith("value", F.lit(">"))
    l = lines.withColumn("b", F.floor(F.col("line") / block)).withColumn("name", F.when(head, F.get(F.split(F.substring("value", 2, 1 << 30), "\\s+"), 0)))
    l = l.withColumn("len", F.when(head, 0).otherwise(F.length(F.trim("value"))))
    w = Window.partitionBy("path", "b").orderBy("line")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    l = l.withColumn("sum", F.sum("len").over(upto)).withColumn("mark", F.last(F.when(head, F.struct("name", F.col("sum").alias("base"))), ignorenulls=True).over(upto))
    ends = l.groupBy("path", "b").agg(F.sum("len").alias("total"), F.max_by("mark", "line").alias("last"))
    wb = Window.partitionBy("path").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("before", F.coalesce(F.sum("total").over(wb), F.lit(0)))
    ends = ends.withColumn("carried", F.last(F.when(F.col("last").isNotNull(), F.struct(F.col("last.name").alias("name"), (F.col("last.base") + F.col("before")).alias("base"))), ignorenulls=True).over(wb))
    j = l.join(ends.select("path", "b", "before", "carried"), ["path", "b"])
    name, base = F.coalesce("mark.name", "carried.name"), F.coalesce(F.col("mark.base") + F.col("before"), "carried.base")
    return j.where(~head & (F.col("len") > 0)).select("path", name.alias("chrom"), (F.col("before") + F.col("sum") - F.col("len") - base).cast("long").alias("offset"), F.trim("value").alias("seq"))


def contig_lengths(chunks: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """(chrom, length) of FASTA chunks; with ``canonical`` only the contigs listed there."""
    out = chunks.groupBy("chrom").agg(F.sum(F.length("seq")).cast("long").alias("length"))
    return out.join(canonical.select("chrom"), "chrom", "left_semi") if canonical is not None else out


def fasta_regions(chunks: DataFrame, regions: DataFrame, reverse: bool = False, width: int = 0, mark_strand: str | None = None) -> DataFrame:
    """(chrom, start_pos, end_pos, seq) of regions; each is put together from the lines that it overlaps.

    With a ``width`` the sequence is cut into lines of that many bases. With ``mark_strand`` there is also ``name``,
    ``chrom:start-end`` from 1: ``no`` adds nothing, ``rc`` adds /rc to reversed sequences, ``sign`` adds (+) or (-).
    """
    marks = {"no": ("", ""), "rc": ("", "/rc"), "sign": ("(+)", "(-)")}
    if mark_strand is not None and mark_strand not in marks:
        raise ValueError(f"mark_strand is one of {', '.join(marks)}")
    # Lines are cut at chunks of the reference, so that regions are placed for few lengths.
    c = cut_at_chunks(chunks.select("chrom", "offset", (F.col("offset") + F.length("seq")).alias("end"), "seq"), "offset", "end")
    own = F.substring("seq", (F.col("__s") - F.col("offset") + 1).cast("int"), (F.col("__e") - F.col("__s")).cast("int"))
    c = c.select("chrom", F.col("__s").alias("start_pos"), F.col("__e").alias("end_pos"), own.alias("seq"))
    j = interval_join(regions.select("chrom", "start_pos", "end_pos").distinct(), c, ("left",), CHUNK)
    a, e = F.greatest("start_pos", "r_start_pos"), F.least("end_pos", "r_end_pos")
    piece = F.substring("r_seq", (a - F.col("r_start_pos") + 1).cast("int"), (e - a).cast("int"))
    out = j.groupBy("chrom", "start_pos", "end_pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("r_start_pos").alias("o"), piece.alias("s")))), lambda x: x["s"]), "").alias("seq"))
    out = out.withColumn("seq", reverse_complement(F.col("seq"))) if reverse else out
    out = out.withColumn("seq", F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")) if width else out
    if mark_strand is None:
        return out
    name = F.concat("chrom", F.lit(":"), F.col("start_pos") + 1, F.lit("-"), "end_pos", F.lit(marks[mark_strand][reverse]))
    return out.withColumn("name", name)


def input_manifest(spark: SparkSession, path: str | list[str], content: bool = False) -> DataFrame:
    """(path, modified, length, signature) of files; with ``content`` also md5. Without it no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    out = files.select("path", F.unix_micros("modificationTime").alias("modified"), "length", *([F.md5("content").alias("md5")] if content else []))
    return out.withColumn("signature", F.sha2(F.to_json(F.struct("length", "modified", "path")), 256))
