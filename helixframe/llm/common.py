"""Shared pieces of the text operators: scratch tables, word hashes, components."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MASK = (1 << 64) - 1
_MUL = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_R = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_R_INV = pow(_R, -1, 1 << 64)

#: Edges that a task of :func:`components` writes, so that few edges don't become many files.
EDGES = 50_000


class Scratch:
    """Tables written to the folder in ``spark.checkpoint.dir``, which all executors share.

    Every table is plain Parquet, so a lost executor never costs a recomputation
    of what came before it. Where the setting is absent and all of Spark is one
    process (master ``local`` or ``local[n]``), a temporary folder stands in;
    elsewhere its absence is an error.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
            spark.conf.set("spark.checkpoint.dir", base)
        self.base = f"{base.rstrip('/')}/helixframe"
        self.tables: list[tuple[str, str | None]] = []

    @contextlib.contextmanager
    def temporary(self) -> Iterator["Scratch"]:
        """Scratch whose tables are deleted at the end, also after a failure."""
        own = Scratch(self.spark)
        try:
            yield own
        finally:
            own._delete(own.tables)

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the table read back."""
        path = f"{self.base}/{uuid.uuid4().hex}"
        self.tables.append((path, None))
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_table = (path, None)
        return out

    def save_by(self, df: DataFrame, *keys: str, in_order: bool = False) -> DataFrame:
        """Write ``df`` in buckets of ``keys``, so that joins on them need not shuffle it again; in their order within a bucket if asked for."""
        name = f"helixframe_{uuid.uuid4().hex}"
        path, buckets = f"{self.base}/{name}", int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables.append((path, name))
        out = df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, *keys)
        (out.sortBy(*keys) if in_order else out).saveAsTable(name)
        out = self.spark.table(name)
        out._scratch_table = (path, name)
        return out

    def plain(self, table: DataFrame) -> DataFrame:
        """A table of :meth:`save_by` read as plain files. A union of bucketed scans (Spark 4.1) is taken for one
        that is in buckets too, which gives wrong groups; unions take this instead."""
        return self.spark.read.schema(table.schema).parquet(table._scratch_table[0])

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables made by :meth:`save` and :meth:`save_by` that nothing will read again."""
        self._delete([df._scratch_table for df in tables])

    def _delete(self, tables: list[tuple[str, str | None]]) -> None:
        for path, name in list(tables):
            if name:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            if (path, name) in self.tables:
                self.tables.remove((path, name))


def fresh_name(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores before it until no table has a column of that name."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hashed_sample(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Of the distinct rows (group, key), up to ``most`` of each group: those whose key has the least hash.

    Repeated rows are one from the beginning, by a partial aggregate. Rows whose hash is
    too large by far for the number of distinct keys of their group are left out before any
    are compared, so that a large group is never sorted in one task.
    """
    distinct = rows.groupBy(group, key).agg(F.lit(1).alias("one"))
    counts = distinct.groupBy(group).agg(F.count("*").alias("keys"))
    place = (F.xxhash64(key) / F.lit(2.0**63) + 1) / 2  # from 0 to 1
    near = distinct.join(counts, group).where(place * F.col("keys") <= most + 8 * math.sqrt(most) + 16).select(group, key)
    w = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return near.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).select(group, key)


def map_arrow(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    batch_bytes: int = 8 << 20,
) -> DataFrame:
    """``mapInArrow`` whose batches are bounded in bytes, as single texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    return df.mapInArrow(fn, schema)


def arrow_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch of the given columns, numpy arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each string of a column."""
    return column.cast(pa.large_binary()).to_pylist()


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ztext): texts compressed before they are shuffled, null texts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            out = [z.compress(t or b"") for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(out, pa.binary())], names=[key, "ztext"])

    return map_arrow(docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)), run, f"{key} long, ztext binary")


def unpack(z: bytes) -> bytes:
    """The text of one value of :func:`packed`."""
    return zstandard.ZstdDecompressor().decompress(z)


@F.arrow_udf(T.BinaryType())
def pack_text(text: pa.Array) -> pa.Array:
    """Strings compressed, where whole rows are shuffled; nulls stay."""
    z = zstandard.ZstdCompressor(level=3)
    return pa.array([None if t is None else z.compress(t) for t in utf8(text)], pa.binary())


@F.arrow_udf(T.StringType())
def unpack_text(packed: pa.Array) -> pa.Array:
    """The strings of :func:`pack_text`."""
    z = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else z.decompress(t) for t in packed.to_pylist()], pa.binary()).cast(pa.string())


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; one random order of the values for each seed."""
    with np.errstate(over="ignore"):
        x = x + _MUL * np.uint64(2 * seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Powers:
    """Powers of a multiplier and of its inverse, for hashes of word sequences."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up, self.up * np.uint64(pow(_R, k, 1 << 64))])
                self.down = np.concatenate([self.down, self.down * np.uint64(pow(_R_INV, k, 1 << 64))])

    def windows(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hashes of all runs of ``k`` consecutive values of ``h``."""
        n = len(h)
        if n < k:
            return np.empty(0, np.uint64)
        self.grow(n + 1)
        with np.errstate(over="ignore"):
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[:n], dtype=np.uint64)])
            return mix((c[k:] - c[:-k]) * self.down[: n - k + 1])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v) reaches.

    Alternating large-star and small-star steps as joins and aggregates. Nothing
    is gathered by a hub: a hub's smallest neighbour is a partial aggregate, and
    the join back to its edges is one that adaptive execution can split.
    """
    cur = scratch.save(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        state = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        tasks = -(-state[0] // EDGES)
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large.coalesce(tasks))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = scratch.save(small.coalesce(tasks))
        scratch.drop(cur, large)
        cur = after
    ends = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
