"""Queries over files: views are written in a format, read back and compared with the view."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import formats, sinks
from ..sources.scratch import folder
from .views import view


def read_fastq(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    sinks.write_fastq(view(s, d, "fastq"), path)
    return formats.read_fastq(s, path).select("header", "seq", "plus", "qual")


def read_bed(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    sinks.write_bed(view(s, d, "targets"), path)
    s.range(1).select(F.explode(F.array(F.lit("track name=x"), F.lit("# note"), F.lit("browser y"))).alias("value")).write.mode("append").text(path)
    return formats.read_bed(s, path).select("chrom", "start_pos", "end_pos", F.get("rest", 0).alias("name"))


def read_vcf(s: SparkSession, d: str) -> DataFrame:
    """Many parts, of which one has the header that names the samples."""
    path = folder(s)
    head = s.range(1).select(F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1"), F.lit("short\tline"))).alias("value"))
    head.coalesce(1).write.text(path, compression="gzip")
    view(s, d, "vcf_lines").write.mode("append").text(path, compression="gzip")
    v = formats.read_vcf(s, path)
    return v.select("chrom", "pos", "ref", "alt", F.get("samples", 0)["name"].alias("sample"), F.get("samples", 0)["fmt"]["AD"].alias("ad"), F.col("info")["DP"].alias("dp"))


def write_vcf(s: SparkSession, d: str) -> DataFrame:
    """Read back file by file, so that each needs its own header."""
    path = folder(s)
    sinks.write_vcf(formats.parse_vcf(view(s, d, "vcf_lines"), F.array(F.lit("s1"))), path, ["s1"])
    v = formats.read_vcf(s, path)
    return v.select("chrom", "pos", "ref", "alt", "filter", F.get("samples", 0)["name"].alias("sample"), F.get("samples", 0)["fmt"]["DP"].alias("dp"))


def read_sam_table(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    sam = view(s, d, "sam")
    sam.select(F.concat_ws("\t", "qname", "flag", "chrom", "pos", "mapq", "cigar", F.lit("="), F.lit("0"), "tlen", "seq", "qual", F.concat(F.lit("RG:Z:"), "sample"), F.lit("NM:i:1")).alias("value")).write.text(path)
    s.range(1).select(F.lit("@HD\tVN:1.6").alias("value")).write.mode("append").text(path)
    return formats.read_sam_table(s, path).select("qname", "flag", "chrom", "pos", "mapq", "cigar", "tlen", "seq", "qual", F.col("read_group").alias("sample"), "nm")


def read_depth(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    view(s, d, "targets").select("chrom", "start_pos", "end_pos", F.length("name")).write.csv(path, sep="\t", compression="gzip")
    return formats.read_depth(s, path)


def read_contigs(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    view(s, d, "fastq").select(F.concat_ws("\t", F.concat(F.lit("c"), "rec"), F.col("rec") % 1000 + 1, F.lit("0"), F.lit("60")).alias("value")).write.text(path)
    return formats.read_contigs(s, path)


def read_kv_summary(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    view(s, d, "loads").select("sample", F.when(F.col("n_total") % 2 == 0, F.col("n_total").cast("string")).otherwise("n/a")).write.csv(path, sep="\t")
    return formats.read_kv_summary(s, path)


def read_mosdepth_summary(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    view(s, d, "fastq").select(F.concat(F.lit("c"), "rec").alias("chrom"), F.col("rec").alias("length"), (F.col("rec") * 2).alias("bases"), F.lit(2.0).alias("mean"), F.lit(0).alias("min"), F.lit(9).alias("max")).write.csv(path, sep="\t", header=True)
    return formats.read_mosdepth_summary(s, path)


def read_fastp_json(s: SparkSession, d: str) -> DataFrame:
    """A report for each sample, a file each; some lack a section, some a value."""
    path = folder(s)
    c, even = F.col, F.col("n_total") % 2 == 0
    stage = lambda k: F.struct((c("n_total") * k).alias("total_reads"), (c("n_snv") * k).alias("total_bases"), (c("callable_mb") / k).alias("q20_rate"), F.when(even, F.lit(0.5 / k)).alias("q30_rate"), F.lit(0.25).alias("gc_content"))
    loads = view(s, d, "loads").select(
        "sample", F.struct(stage(2).alias("before_filtering"), F.when(even, stage(1)).alias("after_filtering")).alias("summary"), F.when(even, F.struct(c("callable_mb").alias("rate"))).alias("duplication"),
        F.struct(c("n_indel").alias("adapter_trimmed_reads")).alias("adapter_cutting"), F.struct(c("n_total").alias("passed_filter_reads"), c("n_snv").alias("low_quality_reads"), F.lit(3).alias("too_many_N_reads"), F.lit(4).alias("too_short_reads")).alias("filtering_result"),
    )
    loads.repartition("sample").write.partitionBy("sample").json(path)
    r = formats.read_fastp_json(s, path)
    return r.select(F.regexp_extract("file", "sample=([^/]+)", 1).alias("sample"), *[F.round(F.col(x).cast("double"), 6).alias(x) for x in r.columns if x != "file"])


def read_fastqc(s: SparkSession, d: str) -> DataFrame:
    """A zipped report for each sample, with a statistic outside its section and a line that is too short."""

    def zipped(frames):
        for f in frames:
            out = []
            for sample, n, snv in zip(f["sample"], f["n_total"], f["n_snv"], strict=True):
                file = io.BytesIO()
                with zipfile.ZipFile(file, "w") as z:
                    z.writestr("r_fastqc/summary.txt", f"{('PASS', 'WARN', 'FAIL')[n % 3]}\tPer base sequence quality\tf\n{('PASS', 'FAIL')[snv % 2]}\tAdapter Content\tf\nshort\n")
                    z.writestr("r_fastqc/fastqc_data.txt", f">>Basic Statistics\tpass\nTotal Sequences\t{n}\nSequence length\t{snv}-{n}\n%GC\t{n % 100}.5\n>>END_MODULE\n>>Other\tpass\n%GC\t7\n>>END_MODULE\n")
                out.append((sample, file.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    files = view(s, d, "loads").select("sample", "n_total", "n_snv").mapInPandas(zipped, "path string, content binary")
    m = F.col("modules")
    return formats.parse_fastqc(files).select(F.col("file").alias("sample"), m["per_base_sequence_quality"].alias("quality"), m["adapter_content"].alias("adapter"), "total_sequences", "sequence_length", "gc_percent")


def read_picard_metrics(s: SparkSession, d: str) -> DataFrame:
    """A file for each sample."""
    path = folder(s)
    text = F.concat_ws("\n", F.lit("# comment"), F.lit(""), F.lit("OTHER\tX"), F.lit("LIBRARY\tREADS\tRATE"), F.lit("short"), F.concat(F.lit("lib\t"), "n_total", F.lit("\tx")), F.lit("lib2\t1\t2"))
    view(s, d, "loads").select("sample", text.alias("value")).repartition("sample").write.partitionBy("sample").text(path)
    m = formats.read_picard_metrics(s, path, ["LIBRARY", "READS"])
    return m.select(F.regexp_extract("path", "sample=([^/]+)", 1).alias("sample"), F.col("metrics")["READS"].try_cast("long").alias("reads"), F.col("metrics")["RATE"].try_cast("double").alias("rate"))


def _fasta(s: SparkSession, d: str, second: str) -> DataFrame:
    """Chunks of FASTA files in which each read is a contig of two lines."""
    path = folder(s)
    view(s, d, "fastq").select(F.concat_ws("\n", F.concat(F.lit(">c"), "rec", F.lit(" x")), "seq", F.expr(second)).alias("value")).write.text(path)
    return formats.fasta_chunks(formats.numbered_lines(s, path), 100)


def reference(s: SparkSession, d: str, base: str) -> DataFrame:
    """The chunks of a FASTA file of all contigs, written in lines of 60, every other one in small letters; ``base`` is SQL of the base at ``pos``."""
    from ..operators.intervals import windows
    from ..operators.reference import reference_chunks

    path, c = folder(s), view(s, d, "contigs")
    line = F.array_join(F.expr(f"transform(sequence(start_pos + 1, end_pos), pos -> {base})"), "")
    lines = windows(c, 60).select("chrom", "start_pos", F.when(F.col("start_pos") % 120 == 0, F.lower(line)).otherwise(line).alias("value"))
    heads = c.select("chrom", F.lit(-1).cast("long").alias("start_pos"), F.concat(F.lit(">"), "chrom", F.lit(" from a table")).alias("value"))
    lines.unionByName(heads).repartition("chrom").sortWithinPartitions("chrom", "start_pos").select("value").write.text(path)
    return reference_chunks(formats.fasta_chunks(formats.numbered_lines(s, path)))


def contig_lengths(s: SparkSession, d: str) -> DataFrame:
    """Of the contigs that a list has."""
    canonical = view(s, d, "fastq").where("rec % 3 <> 0").select(F.concat(F.lit("c"), "rec").alias("chrom"))
    return formats.contig_lengths(_fasta(s, d, "qual"), canonical)


def fasta_regions(s: SparkSession, d: str) -> DataFrame:
    """Regions over both lines of a contig, reversed, in lines of 12."""
    regions = view(s, d, "fastq").select(F.concat(F.lit("c"), "rec").alias("chrom"), (F.col("rec") % 20 + 5).alias("start_pos"), (F.col("rec") % 20 + 35).alias("end_pos"))
    return formats.fasta_regions(_fasta(s, d, "reverse(seq)"), regions, reverse=True, width=12)


def fasta_regions_named(s: SparkSession, d: str) -> DataFrame:
    """Both strands of a region with their names."""
    regions = view(s, d, "fastq").select(F.concat(F.lit("c"), "rec").alias("chrom"), (F.col("rec") % 20 + 5).alias("start_pos"), (F.col("rec") % 20 + 15).alias("end_pos"))
    chunks = _fasta(s, d, "reverse(seq)")
    both = [formats.fasta_regions(chunks, regions, k, mark_strand=m) for k, m in ((False, "sign"), (True, "rc"), (True, "no"))]
    return both[0].unionByName(both[1]).unionByName(both[2]).select("name", "seq")


def input_manifest(s: SparkSession, d: str) -> DataFrame:
    """Sixteen files of known lines; the signature changes with what it is made of."""
    path = folder(s)
    lines = view(s, d, "fastq").select((F.col("rec") % 16).alias("part"), "rec", F.col("header").alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "rec").select("part", "value").write.partitionBy("part").text(path)
    m = formats.input_manifest(s, path, content=True)
    same = F.col("signature") == F.sha2(F.concat(F.lit('{"length":'), "length", F.lit(',"modified":'), "modified", F.lit(',"path":"'), "path", F.lit('"}')), 256)
    return m.select(F.regexp_extract("path", "part=([^/]+)", 1).cast("long").alias("part"), "length", "md5", same.alias("signed"))


def run_incremental(s: SparkSession, d: str) -> DataFrame:
    """Three runs over a file for each sample: all files, then after two were changed and one is gone, then as they are. How often each reason came, and the rows."""
    from ..sources.scratch import delete
    from .incremental import run_incremental as run

    source, target = folder(s), folder(s)
    loads = view(s, d, "loads").select("sample", "n_total")
    loads.repartition("sample").write.partitionBy("sample").json(source)

    def compute(paths: list[str]) -> DataFrame:
        return s.read.schema("n_total long").json(paths).select("n_total", F.col("_metadata.file_path").alias("file"))

    seen = [run(s, source, target, compute).select(F.lit(1).alias("run"), "reason")]
    ends = loads.agg(F.min("sample").alias("least"), F.max("sample").alias("most"), F.max(F.when(F.col("sample").like("PRLC_1_%"), F.col("sample"))).alias("other")).first()
    for sample in (ends["least"], ends["other"]):
        loads.where(F.col("sample") == sample).select(F.col("n_total") + 1000).toDF("n_total").write.mode("overwrite").json(f"{source}/sample={sample}")
    delete(s, f"{source}/sample={ends['most']}")
    for k in (2, 3):
        seen.append(run(s, source, target, compute).select(F.lit(k).alias("run"), "reason"))
    reasons = seen[0].unionByName(seen[1]).unionByName(seen[2]).groupBy("run", "reason").agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("total"))
    rows = s.read.parquet(f"{target}/rows").agg(F.lit(0).alias("run"), F.lit("rows").alias("reason"), F.count("*").alias("n"), F.sum("n_total").alias("total"))
    return reasons.unionByName(rows)


def write_check(s: SparkSession, d: str) -> DataFrame:
    """The text of a check, for each sample."""
    from ..operators.fastq import fastq_check

    path = folder(s)
    check = fastq_check(view(s, d, "fastq"), view(s, d, "fastq2"), 2000, 3).crossJoin(view(s, d, "loads").select("sample"))  # one row and a list of samples
    sinks.write_check(check.withColumn("pairing", F.lit("paired")), path)
    lines = formats.numbered_lines(s, path)
    return lines.select(F.regexp_extract("path", "sample=([^/]+)", 1).alias("sample"), "line", "value")


def write_report_tsv(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    loads = view(s, d, "loads").withColumn("note", F.when(F.col("n_total") % 2 == 0, "even"))
    sinks.write_report_tsv(loads, path, ["sample", "note", "n_total"])
    return s.read.csv(path, sep="\t", header=True, schema="sample string, note string, n_total long")


def write_load_tsv(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    sinks.write_load_tsv(view(s, d, "loads"), path, ["callable_mb", "sample"])
    return s.read.csv(path, sep="\t", header=True, schema="callable_mb string, sample string, n_total long, n_snv long, n_indel long")


def write_interval_list(s: SparkSession, d: str) -> DataFrame:
    from ..operators.intervals import bed_to_interval_list

    path = folder(s)
    c = view(s, d, "contigs")
    sinks.write_interval_list(bed_to_interval_list(view(s, d, "targets"), c), c, path)
    return s.read.text(path)


def write_json(s: SparkSession, d: str) -> DataFrame:
    path = folder(s)
    sinks.write_json(view(s, d, "loads"), path)
    return s.read.schema("sample string, n_total long, n_snv long, n_indel long, callable_mb double").json(path)


_REV = "translate(reverse(substr(concat(seq, reverse(seq)), cast(rec % 20 + 6 as int), 30)), 'ACGT', 'TGCA')"

_EVEN = "case when n_total % 2 = 0 then {} end"
_FASTP = (
    "select sample, cast(n_total * 2 as double) before_total_reads, cast(n_snv * 2 as double) before_total_bases, callable_mb / 2 before_q20_rate, cast(case when n_total % 2 = 0 then 0.25 else 0 end as double) before_q30_rate, cast(0.25 as double) before_gc_content, "
    + ", ".join(f"{_EVEN.format(f'cast({v} as double)')} after_{k}" for k, v in (("total_reads", "n_total"), ("total_bases", "n_snv"), ("q20_rate", "callable_mb"), ("q30_rate", "0.5"), ("gc_content", "0.25")))
    + f", {_EVEN.format('callable_mb')} duplication_rate, cast(n_indel as double) adapter_trimmed_reads, cast(0 as double) adapter_trimmed_bases, cast(n_total as double) passed_filter_reads, cast(n_snv as double) low_quality_reads, cast(3 as double) \"too_many_N_reads\" from loads"
)
_CHECK = """, m as (select rec from fastq where rec % 101 = 0 and rec < 2000), bad as (select rec, concat_ws('|', case when plus not like '+%' then concat('record ', cast(rec + 1 as string), ': separator does not start with +') end, case when length(seq) <> length(qual) then concat('record ', cast(rec + 1 as string), ': sequence and quality differ in length') end) x from fastq2 where rec < 2000),
er as (select string_agg(x, '|' order by rec) x from (select * from bad where x <> '' order by rec limit 3) t), wa as (select string_agg(concat('ID mismatch at record ', cast(rec + 1 as string), ': q', cast(rec as string), ' != x', cast(rec as string)), '|' order by rec) x from (select * from m order by rec limit 5) t),
tx as (select sample, string_split(concat_ws('|', concat('FASTQ Input Check for ', sample), repeat('=', 60), '', 'Status: ' || case when er.x is null then 'PASS' else 'FAIL' end, 'Pairing: paired', '', 'Checks:', concat('  records_checked: ', cast((select count(*) from fastq where rec < 2000) as string)),
concat('  format_ok: ', case when er.x is null then 'True' else 'False' end), concat('  ids_match: ', case when wa.x is null then 'True' else 'False' end), concat('  mismatches: ', cast((select count(*) from m) as string)),
case when er.x is not null then '' end, case when er.x is not null then 'Errors:' end, '  - ' || replace(er.x, '|', '|  - '), case when wa.x is not null then '' end, case when wa.x is not null then 'Warnings:' end, '  - ' || replace(wa.x, '|', '|  - ')), '|') l from loads, er, wa)
select sample, unnest(range(0, len(l))) line, unnest(l) as "value" from tx"""

ROUNDTRIPS = {
    "read_fastq": (read_fastq, "select header, seq, plus, qual from fastq"),
    "read_bed": (read_bed, "select chrom, start_pos, end_pos, name from targets"),
    "read_vcf": (read_vcf, "select chrom, pos, ref, alt, 's1' sample, concat(cast(dp - ad_alt as string), ',', cast(ad_alt as string)) ad, cast(dp as string) dp from variants"),
    "write_vcf": (write_vcf, "select chrom, pos, ref, alt, filt as filter, 's1' sample, cast(dp as string) dp from variants"),
    "read_sam_table": (read_sam_table, "select qname, flag, chrom, pos, mapq, cigar, cast(tlen as bigint) tlen, seq, qual, sample, 1 nm from sam"),
    "read_depth": (read_depth, "select chrom, start_pos, end_pos, cast(length(name) as int) depth from targets"),
    "read_contigs": (read_contigs, "select concat('c', cast(rec as string)) chrom, rec % 1000 + 1 length from fastq"),
    "read_kv_summary": (read_kv_summary, "select sample as \"key\", case when n_total % 2 = 0 then cast(n_total as string) else 'n/a' end as \"value\", case when n_total % 2 = 0 then cast(n_total as double) end as number from loads"),
    "read_mosdepth_summary": (read_mosdepth_summary, "select concat('c', cast(rec as string)) chrom, rec length, rec * 2 bases, cast(2 as double) mean, cast(0 as bigint) \"min\", cast(9 as bigint) \"max\" from fastq"),
    "read_fastp_json": (read_fastp_json, _FASTP),
    "read_fastqc": (read_fastqc, "select sample, case n_total % 3 when 0 then 'PASS' when 1 then 'WARN' else 'FAIL' end quality, case n_snv % 2 when 0 then 'PASS' else 'FAIL' end adapter, n_total total_sequences, concat(cast(n_snv as string), '-', cast(n_total as string)) sequence_length, cast(n_total % 100 + 0.5 as double) gc_percent from loads"),
    "read_picard_metrics": (read_picard_metrics, "select sample, n_total \"reads\", cast(null as double) rate from loads"),
    "contig_lengths": (contig_lengths, "select concat('c', cast(rec as string)) chrom, cast(64 as bigint) length from fastq where rec % 3 <> 0"),
    "fasta_regions": (fasta_regions, f"select concat('c', cast(rec as string)) chrom, rec % 20 + 5 start_pos, rec % 20 + 35 end_pos, concat_ws(chr(10), substr({_REV}, 1, 12), substr({_REV}, 13, 12), substr({_REV}, 25, 6)) seq from fastq"),
    "fasta_regions_named": (fasta_regions_named, """, r as (select concat('c', cast(rec as string), ':', cast(rec % 20 + 6 as string), '-', cast(rec % 20 + 15 as string)) n, substr(concat(seq, reverse(seq)), cast(rec % 20 + 6 as int), 10) q from fastq)
select n || '(+)' as "name", q as seq from r union all select n || '/rc', translate(reverse(q), 'ACGT', 'TGCA') from r union all select n, translate(reverse(q), 'ACGT', 'TGCA') from r"""),
    "input_manifest": (input_manifest, "select rec % 16 part, cast(sum(length(header) + 1) as bigint) length, md5(concat(string_agg(header, chr(10) order by rec), chr(10))) md5, true signed from fastq group by 1"),
    "run_incremental": (run_incremental, """, e as (select min(sample) a, max(sample) z, max(case when sample like 'PRLC_1_%' then sample end) o from loads) select 1 run, 'First run' reason, cast(count(*) as bigint) n, cast(null as bigint) total from loads union all select 2, 'First run', cast(2 as bigint), null
union all select 2, 'missing', cast(3 as bigint), null union all select 0, 'rows', cast(count(*) as bigint), cast(sum(n_total + case when sample in (a, o) then 1000 else 0 end) as bigint) from loads, e where sample <> z"""),
    "write_check": (write_check, _CHECK),
    "write_report_tsv": (write_report_tsv, "select sample, case when n_total % 2 = 0 then 'even' end note, n_total from loads"),
    "write_load_tsv": (write_load_tsv, "select printf('%.4f', callable_mb) callable_mb, sample, n_total, n_snv, n_indel from loads"),
    "write_interval_list": (write_interval_list, "select concat_ws(chr(9), '@SQ', concat('SN:', chrom), concat('LN:', cast(length as string))) as \"value\" from contigs union all select concat_ws(chr(9), chrom, cast(start_pos + 1 as string), cast(end_pos as string), '+', name) from targets"),
    "write_json": (write_json, "select sample, n_total, n_snv, n_indel, callable_mb from loads"),
}
