"""Best-fit packing by length patterns.

Texts become tokens and an end mark; longer ones are cut so that only the first
piece may be short. Full pieces fill a sequence each. For the rest, the
histogram of lengths (at most 1023 numbers, whatever the corpus) is all that
the driver sees: it enumerates patterns of two to four lengths that fill a
sequence exactly, fits repeat counts to the histogram by non-negative least
squares, rounds them down to what the histogram holds, and packs what is left by
best fit over whole length classes. The plan says, for ranges of ranks within a
length, which sequences and offsets they get; ranks are found from counts per
partition, so no length gathers in one task.

A tokenizer file of byte-level BPE whose merges stand in the order of their ids is
run by tiktoken, which gives the ids of ``tokenizers`` in less time; other files, and texts
with very long white space, are left to ``tokenizers``. Strings of special tokens
in a text are those tokens, as ``tokenizers`` has it.

Defined cases: a null text is the end mark alone; an empty one too; repeated rows
are packed each; rows with a null key are packed like others; a text of any length
is cut, never dropped; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_batch, map_arrow

# Fixed value: the pattern of words that byte-level pre-tokenizers use.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space from which on tiktoken's pattern needs too much memory.
_LONG_SPACE = re.compile(r"\s{10000}")
#: Parts whose counts are summed together before the sums are.
PARTS = 1024

_encoders: dict[str, "TextEncoder"] = {}


def byte_of_char() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def rank_encoder(path: str) -> tiktoken.Encoding | None:
    """tiktoken's form of a tokenizer file, if it gives the same ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, words = spec["model"], spec["pre_tokenizer"] or {}
    flags = any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space")
    if not plain or not level or flags or spec["normalizer"] or spec["truncation"] or spec["padding"]:
        return None
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    made = [vocabulary["".join(x)] for x in pairs]
    chars = byte_of_char()
    if any(a >= b for a, b in zip(made, made[1:])) or len(set(made)) + len(chars) != len(vocabulary) or not chars.keys() <= vocabulary.keys():
        return None
    ranks = {bytes(map(chars.__getitem__, k)): v for k, v in vocabulary.items()}
    return tiktoken.Encoding(os.path.basename(path), pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


class TextEncoder:
    """Token ids of texts by a tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.ranked = Tokenizer.from_file(path), rank_encoder(path)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if self.ranked is None or _LONG_SPACE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(x in text for x in self.ranked.special_tokens_set):
            return np.array(self.ranked.encode(text, allowed_special="all"), "<u4").tobytes()
        return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()


def encoder(path: str) -> TextEncoder:
    """The encoder of a tokenizer file, one for each process."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def cut_documents(docs: DataFrame, path: str, size: int = 1024, end: int = 2, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] part and rank.

    ``part`` is the partition and ``rank`` the piece's number among those of its
    length there; both hold only once the table is written.
    """
    tail = np.array([end], "<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for b in batches:
            rows: list[tuple] = []
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = enc.encode(x or "") + tail
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    length = n - at if n <= size else (n - at) % size or size
                    own = ids[4 * at : 4 * (at + length)]
                    rows.append((k, piece, at, length, zlib.crc32(own), part, seen[length], *([own] if with_ids else [])))
                    seen[length] += 1
                    at, piece = at + length, piece + 1
            if rows:
                yield arrow_batch(pa.schema(fields), *map(list, zip(*rows)))

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long" + ", ids binary" * with_ids
    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, kinds)


def patterns(counts: np.ndarray, size: int, most: int = 4096, seeds: int = 256) -> list[tuple[int, ...]]:
    """Few-document length patterns that fill a sequence exactly, the best supplied first.

    All pairs are tried, and triples and quadruples that begin with two of the ``seeds``
    commonest lengths, up to ``most`` patterns. Pieces that no pattern takes are packed by best fit.
    """
    have = [int(x) for x in np.flatnonzero(counts)]
    pairs = [(size - a, a) for a in have if 2 * a <= size and counts[size - a] and (2 * a < size or counts[a] > 1)]
    by_count = sorted(have, key=lambda a: (-counts[a], a))
    scored = []
    for i, a in enumerate(by_count[:seeds]):
        for b in by_count[i:seeds]:
            c = size - a - b
            if 0 < c <= size and counts[c]:
                scored.append((-min(counts[a], counts[b], counts[c]), tuple(sorted((a, b, c), reverse=True))))
            d, odd = divmod(size - a - b, 2)
            if d > 0 and not odd and counts[d] > 1:
                scored.append((-min(counts[a], counts[b], counts[d] // 2), tuple(sorted((a, b, d, d), reverse=True))))
    triples = [p for _, p in sorted(set(scored))]
    return pairs + triples[: max(0, most - len(pairs))]


def nnls(counts: np.ndarray, found: list[tuple[int, ...]], rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that bring sum(pattern * x) close to ``counts``, by multiplicative updates."""
    if not found:
        return np.zeros(0)
    who = np.concatenate([np.full(len(p), i) for i, p in enumerate(found)])
    what = np.concatenate(found)
    target = counts.astype(np.float64)
    x = np.array([min(counts[list(p)]) for p in found], np.float64) / 8 + 1e-9
    up = np.bincount(who, target[what], len(found))
    for _ in range(rounds):
        x *= up / np.maximum(np.bincount(who, np.bincount(what, x[who], len(counts))[what], len(found)), 1e-12)
    return x


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of all sequences, for the given number of pieces of each length."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(p: tuple[int, ...], n: int) -> None:
        lengths, need = np.unique(p, return_counts=True)
        n = min(n, *(left[lengths] // need).tolist())
        if n > 0:
            left[lengths] -= need * n
            out.append((p, int(n)))

    if left[size]:
        take((size,), int(left[size]))
    found = patterns(left, size)
    x = np.floor(nnls(left, found))
    for i in np.argsort(-x, kind="stable"):
        take(found[i], int(x[i]))
    # Best fit, longest first, over groups of equal sequences: bins[r] holds those with r tokens free.
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    free = np.zeros(size + 1, np.int64)
    for length in range(size, 0, -1):
        while left[length]:
            room = np.flatnonzero(free[length:])
            if len(room):
                r = int(room[0]) + length
                p, n = bins[r].pop()
                k = min(n, int(left[length]))
                if k < n:
                    bins[r].append((p, n - k))
            else:
                r, p = size, ()
                each = size // length
                k = max(1, int(left[length]) // each)
                if each > 1 and left[length] >= each:
                    p = (length,) * (each - 1)
                    left[length] -= k * (each - 1)
                    r = size - length * (each - 1)
                free[r] += k
            free[r] -= k
            left[length] -= k
            free[r - length] += k
            bins.setdefault(r - length, []).append((p + (length,), k))
    return out + [g for groups in bins.values() for g in groups]


def segments(groups: list[tuple[tuple[int, ...], int]], size: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset) in order of rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks, sequence = np.zeros(size + 1, np.int64), 0
    for p, n in groups:
        at = 0
        for length in p:
            out.setdefault(length, []).append((int(ranks[length]), sequence, at))
            ranks[length] += n
            at += length
        sequence += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _starts(per_part: DataFrame) -> DataFrame:
    """(part, length, before): pieces of a length in earlier parts, by sums over blocks of parts and then within them."""
    block = per_part.withColumn("block", F.expr(f"part div {PARTS}"))
    earlier = lambda *keys: F.coalesce(F.sum("n").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = block.groupBy("length", "block").agg(F.sum("n").alias("n")).select("length", "block", earlier("length", "block").alias("blocks"))
    within = block.select("part", "length", "block", earlier("length", "block", "part").alias("within"))
    return within.join(blocks, ["length", "block"]).select("part", "length", (F.col("within") + F.col("blocks")).alias("before"))


def pack(docs: DataFrame, scratch: Scratch, path: str, size: int = 1024, end: int = 2, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    pieces = scratch.save(cut_documents(docs, path, size, end, key, text, with_ids))
    per_part = scratch.save(pieces.groupBy("part", "length").agg((F.max("rank") + 1).alias("n")))
    totals = per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``size`` rows
    counts = np.zeros(size + 1, np.int64)
    for r in totals:
        counts[r["length"]] = r["n"]
    where = docs.sparkSession.sparkContext.broadcast(segments(plan(counts, size), size))
    ranked = pieces.join(_starts(per_part), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part")
    names = [c for c in ranked.columns if c != "rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                own, s = length == k, where.value[int(k)]
                i = np.searchsorted(s[:, 0], rank[own], side="right") - 1
                sequence[own], offset[own] = s[i, 1] + rank[own] - s[i, 0], s[i, 2]
            cols = [b.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    out = map_arrow(ranked, place, f"{kinds}, sequence_id long, offset long")
    first = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*first, *["ids"] * with_ids)
