"""Quality rules whose thresholds follow the data.

Every document gets word and line statistics from built-in SQL functions. A
histogram of each ratio with fixed bins is the quantile sketch, whole numbers at
first and steps of a thousandth or less of the value beyond: sketches
of two groups merge by adding the counts of equal bins, so one pass gives them
for each (language, source), each language and the whole corpus. A document is
judged by the finest group that has ``min_docs`` documents, and goes if a ratio
lies beyond ``q90 + fence * (q90 - q50)`` of that group, ``slack`` at least.

Defined cases: a null text has no words; null languages and sources are groups
of their own; repeated rows are judged alike; rows keep their order of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Ratios judged, in thousandths, and the least distance above q90 that counts as far.
SLACK = {"symbol_ratio": 150, "dup_line_ratio": 200, "repeat_ratio": 150, "word_length": 3000}
#: Up to here a bin of a sketch holds one value; from here on, values with the same eleven leading bits.
EXACT_BINS = 20_000


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that a text has at least twice."""
    # A let-binding: each stage of the work is evaluated once.
    let = lambda value, body: F.transform(F.array(value), body)[0]
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            hit = F.filter(s, lambda p, k: F.coalesce(p["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(p["h"] == F.get(s, k + 1)["h"], F.lit(False)))
            return F.sort_array(F.transform(hit, lambda p: p["i"]))

        at = let(pairs, twice)
        first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end"))
        return F.aggregate(at, first, lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    )


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines, all long.

    The generator keeps later filters from being pushed below the statistics, which would compute them again.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def row(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(raw) - F.length(F.translate(raw, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    lines = F.filter(F.split(raw, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    pair = F.array(F.struct(words_of(F.col(text)).alias("w"), lines.alias("l")))
    stats = F.transform(pair, lambda p: row(p["w"], p["l"]))[0]
    kept = docs.columns
    return docs.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(stats)).alias(*[prefix + n for n in names]))


def ratios(prefix: str = "") -> dict[str, Column]:
    """The judged ratios in thousandths, as whole numbers."""
    div = lambda a, b: F.expr(f"case when `{prefix}{b}` > 0 then (1000 * `{prefix}{a}`) div `{prefix}{b}` else 0L end")
    return {
        "symbol_ratio": div("n_symbols", "word_chars"),
        "dup_line_ratio": div("n_dup_lines", "n_lines"),
        "repeat_ratio": div("n_repeat_words", "n_words"),
        "word_length": div("word_chars", "n_words"),
    }


def base_failed(prefix: str = "") -> Column:
    """The fixed base rule: under 20 words, or over 30 of 100 words in repeated windows."""
    return (F.col(prefix + "n_words") < 20) | (100 * F.col(prefix + "n_repeat_words") > 30 * F.col(prefix + "n_words"))


def _bin(v: Column) -> Column:
    """The largest value of the bin of ``v``; there is no last bin."""
    low_bits = (F.length(F.bin(v)) - 11).cast("int")
    return F.when(v < EXACT_BINS, v).otherwise(F.call_function("shiftleft", F.call_function("shiftright", v, low_bits) + F.lit(1), low_bits) - F.lit(1))


def sketches(stats: DataFrame, lang: str, source: str) -> DataFrame:
    """Mergeable sketches: (lang, source, level, metric, bin, n) for every grouping level."""
    bins = F.explode(F.create_map(*[x for k, v in ratios().items() for x in (F.lit(k), _bin(v))])).alias("metric", "bin")
    # Bins of base failures stay out: what already fails should not move the fences.
    flat = stats.where(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), bins)
    fine = flat.groupBy("lang", "source", "metric", "bin").agg(F.count("*").alias("n"))
    return (
        fine.rollup("metric", "bin", "lang", "source")
        .agg(F.sum("n").alias("n"), F.grouping("lang").alias("g_lang"), F.grouping("source").alias("g_source"), F.grouping("bin").alias("g_bin"))
        .where("g_bin = 0")
        .select("lang", "source", (F.col("g_lang") + F.col("g_source")).alias("level"), "metric", "bin", "n")
    )


def thresholds(sketch: DataFrame, fence: int = 3) -> DataFrame:
    """(lang, source, level, docs, <metric>_max ...): the fences of each group."""
    from pyspark.sql import Window

    keys = ["lang", "source", "level", "metric"]
    w = Window.partitionBy(*keys)
    run = sketch.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("docs", F.sum("n").over(w))
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("docs"), F.col("bin")))
    marks = run.groupBy(*keys, "docs").agg(at(50).alias("q50"), at(90).alias("q90"))
    slack = F.coalesce(*[F.when(F.col("metric") == k, F.lit(v)) for k, v in SLACK.items()])
    marks = marks.withColumn("most", F.col("q90") + F.greatest(fence * (F.col("q90") - F.col("q50")), slack))
    return marks.groupBy("lang", "source", "level").agg(
        F.max("docs").alias("docs"), *[F.max(F.when(F.col("metric") == k, F.col("most"))).alias(f"{k}_max") for k in SLACK]
    )


def _verdict(stats: DataFrame, fences: DataFrame, lang: str, source: str, min_docs: int) -> DataFrame:
    """``stats`` with ``kept``: each row joined with the finest group that is large enough."""
    most = [f"{k}_max" for k in SLACK]
    pick = lambda level, tag: fences.where((F.col("level") == level) & (F.col("docs") >= (min_docs if level < 2 else 0))).select(
        F.col("lang").alias(f"__l{tag}"), F.col("source").alias(f"__s{tag}"), F.struct(*most).alias(f"__f{tag}")
    )
    out = stats.join(pick(0, 0), F.col(lang).eqNullSafe(F.col("__l0")) & F.col(source).eqNullSafe(F.col("__s0")), "left")
    out = out.join(pick(1, 1).drop("__s1"), F.col(lang).eqNullSafe(F.col("__l1")), "left")
    out = out.join(F.broadcast(pick(2, 2).select("__f2")), F.lit(True), "left")  # a single row
    fence = F.coalesce("__f0", "__f1", "__f2")
    inside = F.lit(True)
    for k, v in ratios().items():
        inside = inside & F.coalesce(v <= fence[f"{k}_max"], F.lit(True))
    return out.withColumn("kept", ~base_failed() & inside).withColumn("base_failed", base_failed())


def quality_verdicts(
    docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    fence: int = 3, min_docs: int = 100,
) -> DataFrame:
    """One row per document: the statistics, ``base_failed`` and ``kept``."""
    slim = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    with scratch.temporary() as own:
        stats = own.save(text_statistics(slim).drop("text"))
        fences = own.save(thresholds(sketches(stats, "lang", "source"), fence))
        verdicts = _verdict(stats, fences, "lang", "source", min_docs)
        return scratch.save(verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *ratios_columns()))


def ratios_columns() -> list[Column]:
    """The judged ratios as columns of a result."""
    return [v.alias(k) for k, v in ratios().items()]


def quality_filter(
    docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", source: str = "source", fence: int = 3, min_docs: int = 100
) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Each text is read and hashed once: rows are written with their statistics beside
    them, the sketches read only the statistics, and fences, not texts, are joined.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")).select(
        "__row", F.col(f"__row.`{text}`").alias("text"), F.col(f"__row.`{lang}`").cast("string").alias("lang"), F.col(f"__row.`{source}`").cast("string").alias("source")
    )
    stats = scratch.save(text_statistics(row).drop("text"))
    fences = scratch.save(thresholds(sketches(stats, "lang", "source"), fence))
    return _verdict(stats, fences, "lang", "source", min_docs).where("kept").select("__row.*")
