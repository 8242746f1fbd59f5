"""Line dedup: lines that many documents hold stay in one document only.

The hashes of lines live in levelled sorted runs: tables in buckets of the hash, sorted by it,
one row for each hash with the number of documents seen and the document that keeps the line. A
new batch is merged with every run; hashes that no run has (an anti join) get their keeper from
the batch, others only add to the count, and the batch becomes a run of level 0. When a level
is full its runs are merged into one of the next. Batches come in falling order of doc_id, so a
line's keeper is the largest doc_id that holds it.

A key is a line without spaces (``[\\x20\\x09-\\x0D]``) at its ends, with A-Z in lower case. Null and
empty texts have one empty line. Rows of equal doc_id are one document; a null doc_id is one that is smaller
than all others. Hashes have 128 bits. Extra columns, of any name, stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batch, fresh_name, map_arrow

SPACE = " \t\n\x0b\x0c\r"
_HASH = ["h1", "h2"]


def line_hash(line: str, min_chars: int) -> bytes | None:
    """The hash of a line's key, or None where the key is too short to be judged."""
    key = line.strip(SPACE)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def line_keys(docs: DataFrame, min_chars: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h1, h2): the distinct hashes of the long enough lines of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])
        for b in batches:
            hashes, counts = [], []
            for t in b.column(1).to_pylist():
                own = {line_hash(line, min_chars) for line in t.split("\n")} if t else set()
                own.discard(None)
                hashes += own
                counts.append(len(own))
            pairs = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            rows = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "doc_id long, h1 long, h2 long")


class LineRuns:
    """Levelled sorted runs of (h1, h2, docs, keeper); ``levels`` holds the tables of each level.

    A list of levels of an earlier object goes on where that one ended.
    """

    def __init__(self, scratch: Scratch, fanout: int = 4, levels: list[list[DataFrame]] | None = None):
        self.scratch, self.fanout, self.levels = scratch, fanout, levels or [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in (h1, h2, doc_id), distinct rows; the new run, whose rows with a keeper are new hashes."""
        keys = batch.groupBy(*_HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
        unseen = F.lit(True)
        for i, run in enumerate(self.runs()):
            keys = keys.join(run.select(*_HASH, F.lit(True).alias(f"seen{i}")), _HASH, "left")
            unseen = unseen & F.col(f"seen{i}").isNull()
        run = self._save(keys.select(*_HASH, "docs", F.when(unseen, F.col("keeper")).alias("keeper")))
        self.levels[0].append(run)
        for k, level in enumerate(self.levels):
            if len(level) < self.fanout:
                break
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(self._save(self._merge(level)))
            self.scratch.drop(*level)
            level.clear()
        return run

    def merged(self) -> DataFrame:
        """All runs as one: (h1, h2, docs, keeper). Not in buckets, so that joins with hot hashes are split."""
        runs = self.runs()
        return self._merge(runs) if len(runs) > 1 else self.scratch.plain(runs[0])

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        every = [self.scratch.plain(run) for run in runs]
        for run in every[1:]:
            every[0] = every[0].unionByName(run)
        return every[0].groupBy(*_HASH).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def _save(self, run: DataFrame) -> DataFrame:
        return self.scratch.save_by(run, *_HASH, in_order=True)


def _batches(docs: DataFrame, key: str, batches: int) -> F.Column:
    """The batch of each row: ranges of doc_id of about equal size, the largest first, null last."""
    share = [k / batches for k in range(1, batches)]
    bounds = docs.agg(F.percentile_approx(F.col(key).cast("long"), share, 1000)).first()[0] if share else None
    bounds = sorted(set(bounds or []))
    below = [F.when(F.coalesce(F.col("doc_id") >= F.lit(b), F.lit(False)), 0).otherwise(1) for b in bounds]
    return sum(below, F.lit(0)), len(bounds) + 1


def repeated_lines(docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, drops): for each document that loses lines, the hashes (h1, h2) of them."""
    batch, n = _batches(docs, key, batches)
    lines = scratch.save(line_keys(docs, min_chars, key, text).withColumn("batch", batch))
    # Rows of one doc_id count once; other rows are distinct already, so their counts need no shuffle of their own.
    ids = docs.groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    again = scratch.save(ids.where("n > 1").select(F.col("doc_id").alias("again")))
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    once, more = lines.join(again, same, "left_anti"), lines.join(again, same, "left_semi").distinct()
    distinct, runs = once.unionByName(more), LineRuns(scratch, fanout)
    for i in range(n):
        runs.add(distinct.where(F.col("batch") == i).drop("batch"))
    common = runs.merged().where(F.col("docs") >= min_docs).select(*_HASH, "keeper")
    gone = lines.join(common, _HASH).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct(*_HASH)).alias("drops"))


def _sets(column: pa.Array) -> list[set[bytes] | None]:
    """The hashes of each row of a column of drops."""
    flat = column.flatten()
    raw = np.stack([flat.field(0).to_numpy(), flat.field(1).to_numpy()], 1).astype("<i8").tobytes() if len(flat) else b""
    ends = np.cumsum([len(x) if x.is_valid else 0 for x in column])
    return [{raw[16 * j : 16 * j + 16] for j in range(e - len(x), e)} if x.is_valid else None for x, e in zip(column, ends, strict=True)]


def _kept(text: str | None, drops: set[bytes] | None, min_chars: int) -> tuple[str, int, int]:
    """The text that stays, its number of lines before, and how many go."""
    text = text or ""
    if not drops:
        return text, text.count("\n") + 1, 0
    lines = text.split("\n")
    stay = [line for line in lines if line_hash(line, min_chars) not in drops]
    return "\n".join(stay), len(lines), len(lines) - len(stay)


def dedup_lines(docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` whose texts have lost the lines that at least ``min_docs`` documents hold, but for the document of the largest id. Null texts stay null."""
    drops, name = repeated_lines(docs, scratch, min_chars, min_docs, key=key, text=text, **how), fresh_name("drops", docs)
    drops = drops.select(F.col("doc_id").alias(f"{name}_id"), F.col("drops").alias(name))
    joined = docs.join(drops, F.col(key).cast("long").eqNullSafe(F.col(f"{name}_id")), "left").select(*docs.columns, name)
    i, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns)
            new = [None if t is None else _kept(t, s, min_chars)[0] for t, s in zip(cols[i].to_pylist(), _sets(cols.pop()), strict=True)]
            cols[i] = pa.array(new, cols[i].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_arrow(joined, run, docs.schema)


def line_digests(docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    drops = repeated_lines(docs, scratch, min_chars, min_docs, key=key, text=text, **how).withColumnRenamed("doc_id", "id")
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    joined = slim.join(drops, F.col("doc_id").eqNullSafe(F.col("id")), "left").select("doc_id", "text", "drops")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
        for b in batches:
            out = [_kept(t, s, min_chars) for t, s in zip(b.column(1).to_pylist(), _sets(b.column(2)), strict=True)]
            yield arrow_batch(schema, b.column(0), [x[1] for x in out], [x[2] for x in out], [hashlib.sha256(x[0].encode()).hexdigest() for x in out])

    return map_arrow(joined, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
