"""Column functions of reads, alignments and variants. All are built-in SQL expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Effects that count as coding, and as nonsynonymous.
CODING = ("synonymous", "missense", "nonsense", "frameshift", "inframe_insertion", "inframe_deletion")
NONSYNONYMOUS = ("missense", "nonsense", "frameshift", "inframe_insertion", "inframe_deletion")

#: Flags of unmapped, secondary, failed and duplicate reads.
SKIP_FLAGS = 1796


def as_double(c: Column) -> Column:
    """A number, or null where it cannot be parsed."""
    return c.try_cast("double")


def variant_type(ref: Column, alt: Column) -> Column:
    """SNV, INSERTION, DELETION or COMPLEX by the lengths of the alleles as they stand."""
    return (
        F.when((F.length(ref) == 1) & (F.length(alt) == 1), "SNV")
        .when(F.length(ref) < F.length(alt), "INSERTION")
        .when(F.length(ref) > F.length(alt), "DELETION")
        .otherwise("COMPLEX")
    )


def whole(c: Column) -> Column:
    """A whole number, 0 where it cannot be parsed."""
    return F.coalesce(c.try_cast("int"), F.lit(0))


def genotype_fields(sample: Column) -> Column:
    """struct(dp, ad_ref, ad_alt) of a sample's map of FORMAT fields; 0 where unparsable."""
    ad = F.split(F.try_element_at(sample, F.lit("AD")), ",")
    two = F.size(ad) >= 2
    return F.struct(
        whole(F.try_element_at(sample, F.lit("DP"))).alias("dp"),
        F.when(two, whole(F.get(ad, 0))).otherwise(F.lit(0)).alias("ad_ref"),
        F.when(two, whole(F.get(ad, 1))).otherwise(F.lit(0)).alias("ad_alt"),
    )


def vaf(alt: Column, depth: Column) -> Column:
    """The share of reads with the alternative allele, 0 at no depth."""
    return F.coalesce(F.try_divide(alt.cast("double"), depth.cast("double")), F.lit(0.0))


def plain_effect(effect: Column) -> Column:
    """The effect that a consequence term stands for: ``missense_variant`` is missense, ``stop_gained`` nonsense."""
    return F.when(effect == "stop_gained", "nonsense").otherwise(F.regexp_replace(effect, "_variant$", ""))


def is_coding(effect: Column) -> Column:
    return F.coalesce(plain_effect(effect).isin(*CODING), F.lit(False))


def is_nonsynonymous(effect: Column) -> Column:
    return F.coalesce(plain_effect(effect).isin(*NONSYNONYMOUS), F.lit(False))


def csq_effect(csq: Column) -> Column:
    """The effect of the first consequence of a CSQ field, in lower case."""
    return F.lower(F.get(F.split(F.get(F.split(csq, ","), 0), "\\|"), 1))


def effect_class(effect: Column) -> Column:
    """The first class whose word occurs in the effect."""
    has = lambda *words: F.coalesce(F.greatest(*[F.contains(effect, F.lit(w)) for w in words], F.lit(False)), F.lit(False))
    return (
        F.when(has("missense"), "missense").when(has("nonsense", "stop_gained"), "nonsense").when(has("frameshift"), "frameshift")
        .when(has("synonymous"), "synonymous").when(has("splice"), "splice").when(has("intron"), "intronic").when(has("intergenic"), "intergenic")
    )


def rate(part: Column, total: Column, scale: float = 100.0) -> Column:
    """``scale * part / total``, 0 where there is no total."""
    return F.coalesce(scale * F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0))


def mapping_rate(mapped: Column, total: Column) -> Column:
    """Percent of reads that are mapped."""
    return rate(mapped, total)


def duplicate_rate(duplicates: Column, mapped: Column) -> Column:
    """Percent of mapped reads that are duplicates."""
    return rate(duplicates, mapped)


def proper_pair_rate(properly_paired: Column, paired: Column) -> Column:
    """Percent of paired reads that are paired properly."""
    return rate(properly_paired, paired)


def covered_rate(covered: Column, target: Column) -> Column:
    """Percent of target bases that are covered, at all or to some depth."""
    return rate(covered, target)


def fastqc_overall(per_base: Column, per_sequence: Column, content: Column) -> Column:
    """PASS if all three modules pass, FAIL if one of the quality modules fails, else WARN."""
    return (
        F.when((per_base == "PASS") & (per_sequence == "PASS") & (content == "PASS"), "PASS")
        .when((per_base == "FAIL") | (per_sequence == "FAIL"), "FAIL")
        .otherwise("WARN")
    )


def mouse_id(sample: Column) -> Column:
    """The first two parts of a sample's name, or all of it."""
    return F.array_join(F.slice(F.split(sample, "_"), 1, 2), "_")


def tissue(sample: Column) -> Column:
    return F.when(F.contains(sample, F.lit("Kidney")), "Kidney").when(F.contains(sample, F.lit("SCC")), "SCC").otherwise("Other")


def read_id(header: Column) -> Column:
    """The first word of a header without its mark, before any slash."""
    return F.get(F.split(F.get(F.split(F.substring(header, 2, 1 << 30), "\\s+"), 0), "/"), 0)


def fastq_errors(record: Column, header: Column, seq: Column, plus: Column, qual: Column) -> Column:
    """Messages about a record; ``record`` is its number from 1."""
    at = F.concat(F.lit("record "), record.cast("string"))
    return F.array_compact(
        F.array(
            F.when(~F.startswith(header, F.lit("@")), F.concat(at, F.lit(": header does not start with @"))),
            F.when(~F.startswith(plus, F.lit("+")), F.concat(at, F.lit(": separator does not start with +"))),
            F.when(F.length(seq) != F.length(qual), F.concat(at, F.lit(": sequence and quality differ in length"))),
        )
    )


def qualities(qual: Column) -> Column:
    """Phred values of a quality string as an array."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, where ``f`` has it in a lambda; there Spark would compute its expression for each element."""
    return F.get(F.transform(F.array(value), f), 0)


def count_from(qual: Column, least: int) -> Column:
    """How many bases have at least this quality, without leaving string functions."""
    high = "".join(chr(33 + q) for q in range(least, 94))
    return F.length(qual) - F.length(F.translate(qual, high, ""))


def gc_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(seq, "GCgc", ""))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def cigar_ops(cigar: Column) -> Column:
    """Array of struct(n, op)."""
    n = F.regexp_extract_all(cigar, F.lit("(\\d+)[MIDNSHP=X]"), 1)
    op = F.regexp_extract_all(cigar, F.lit("\\d+([MIDNSHP=X])"), 1)
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("int").alias("n"), b.alias("op")))


_BLOCKS = "array<struct<s:bigint,e:bigint,q:int>>"


def cigar_blocks(pos: Column, cigar: Column) -> Column:
    """Aligned blocks of a read: array of struct(s, e, q).

    ``pos`` is 1-based; s and e are 0-based and half-open; q is the offset of the
    block in the read. M, = and X align; D and N skip reference; I and S skip read.
    """
    start = F.struct((pos.cast("long") - 1).alias("r"), F.lit(0).alias("q"), F.array().cast(_BLOCKS).alias("b"))

    def step(a: Column, x: Column) -> Column:
        n, op = x["n"], x["op"]
        block = F.array(F.struct(a["r"].alias("s"), (a["r"] + n).alias("e"), a["q"].alias("q")))
        return F.struct(
            (a["r"] + F.when(op.isin("M", "=", "X", "D", "N"), n).otherwise(0)).alias("r"),
            (a["q"] + F.when(op.isin("M", "=", "X", "I", "S"), n).otherwise(0)).alias("q"),
            F.when(op.isin("M", "=", "X"), F.concat(a["b"], block)).otherwise(a["b"]).alias("b"),
        )

    return F.aggregate(cigar_ops(cigar), start, step, lambda a: a["b"])


def reference_length(cigar: Column) -> Column:
    return F.aggregate(cigar_ops(cigar), F.lit(0), lambda a, x: a + F.when(x["op"].isin("M", "=", "X", "D", "N"), x["n"]).otherwise(0))


def has_flag(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def unclipped_5prime(flag: Column, pos: Column, cigar: Column) -> Column:
    """The 1-based place where a read's first base would lie without clipping."""
    ops = cigar_ops(cigar)
    clip = lambda o: F.when(o["op"].isin("S", "H"), o["n"]).otherwise(0)
    lead = F.coalesce(clip(F.get(ops, 0)), F.lit(0))
    trail = F.coalesce(clip(F.get(ops, F.size(ops) - 1)), F.lit(0))
    return F.when(has_flag(flag, 16), pos + reference_length(cigar) - 1 + trail).otherwise(pos - lead).cast("long")


def natural_key(name: Column) -> Column:
    """A sort key in which groups of digits order as numbers."""
    return F.array_join(
        F.transform(F.regexp_extract_all(name, F.lit("(\\d+|\\D+)"), 1), lambda x: F.when(x.rlike("^\\d"), F.concat(F.lit("0"), F.lpad(x, 20, "0"))).otherwise(x)), ""
    )
