"""Byte-level BPE by merge replay over a vocabulary of words.

Each task gathers the distinct words of some megabytes of text, keeps an
inverted index from token pair to the positions where the pair stands, and
applies merges in rank order to all words at once; only the neighbours of a
merged position get new pairs. Texts are then written down from the encoded
words. Words seen before come from a bounded cache. Nothing is shuffled.

Defined cases: a null text is empty and has no ids; invalid ids cannot arise;
repeated rows are encoded alike; a word may be as long as its text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, map_arrow

_NONE = np.int64(1 << 40)
#: Encoded pieces kept in each of two generations, in entries and in characters; texts encoded together, in characters.
CACHE, CACHE_CHARS, TOGETHER = 300_000, 16 << 20, 12 << 20
_SPLIT = re.compile(r" (?=\S)")
#: Below this character ``isalpha`` and the pattern's letters are the same in all Unicode versions.
_LATIN_END = "\u0250"
_models: dict[str, "MergeReplay"] = {}


def _distinct(at: np.ndarray) -> np.ndarray:
    at = np.sort(at)
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens and ranks of a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceCache:
    """Texts encoded piece by piece, as no match runs on over a space that begins a word.

    ``learn`` encodes pieces. A piece is kept without the space that begins it;
    the piece that begins a text is kept apart. When the cache is full, by number or
    by length, it becomes the old generation, from which pieces that are used again move on.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes]]):
        self.learn = learn
        self.heads: dict[str, bytes] = {}
        self.rest: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}
        self.head_chars = self.rest_chars = 0

    def _know(self, heads: set[str], rest: set[str]) -> None:
        if len(self.heads) > CACHE // 10 or self.head_chars > CACHE_CHARS:
            self.heads, self.head_chars = {}, 0
        heads = list(heads - self.heads.keys())
        self.head_chars += sum(map(len, heads))
        self.heads.update(zip(heads, self.learn(heads), strict=True))
        missing = rest - self.rest.keys()
        if len(self.rest) + len(missing) > CACHE or self.rest_chars > CACHE_CHARS:
            self.old, self.rest, missing, self.rest_chars = self.rest, {}, rest, 0
        self.rest_chars += sum(map(len, missing))
        again = missing & self.old.keys()
        self.rest.update((p, self.old[p]) for p in again)
        # An empty piece, or one that begins with white space, shows that its text must be cut with more care.
        odd = {p for p in missing if p == "" or p[0].isspace()}
        self.rest.update(dict.fromkeys(odd))
        fresh = list(missing - again - odd)
        self.rest.update(zip(fresh, self.learn([" " + p for p in fresh]), strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        parts = [t.split(" ") for t in texts]
        rest = set().union(*parts)
        if any("  " in t or t.endswith(" ") for t in texts):
            rest.add("")
        self._know({p[0] for p in parts}, rest)
        for i, (head, *tail) in enumerate(parts):
            try:
                yield self.heads[head] + b"".join(map(self.rest.__getitem__, tail))
            except TypeError:
                yield self._with_care(texts[i])

    def _with_care(self, text: str) -> bytes:
        head, *tail = _SPLIT.split(text)
        ids = dict(zip(tail, self.learn([" " + p for p in tail]), strict=True))
        return self.learn([head])[0] + b"".join(map(ids.__getitem__, tail))


class MergeReplay:
    """Encodes many words together by the ranks of ``ranks``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.first = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        keys, values, self.unsafe = [], [], set()
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    values.append(r)
                # A merge whose result joins into a token of lower rank must be followed up first.
                self.unsafe.update(x for x in (a, b) if x is not None and x > r)
        order = np.argsort(keys)
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.pattern = regex.compile(pattern)
        self.pieces = PieceCache(self.encode_pieces)

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or no rank."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(words) else 0
        if not n:
            return [b""] * len(words)
        tok = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        nxt, prv, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        nxt[ends[sizes > 0] - 1] = -1
        prv[(ends - sizes)[sizes > 0]] = -1
        pair = np.full(n, _NONE)
        has = np.flatnonzero(nxt >= 0)
        pair[has] = self.ranks_of(tok[has], tok[has + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(at: np.ndarray) -> None:
            r = pair[at]
            at, r = at[r < _NONE], r[r < _NONE]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            cuts = [0, *cuts.tolist(), len(at)]
            for i, j in zip(cuts, cuts[1:]):
                k, part = int(r[i]), at[i:j]
                if k in index:
                    index[k].append(part)
                else:
                    index[k] = [part]
                    heapq.heappush(heap, k)

        enter(has)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = _distinct(np.concatenate(parts) if len(parts) > 1 else parts[0])
            at = at[alive[at] & (pair[at] == r)]
            if not len(at):
                continue
            if r in self.unsafe:
                lead = np.concatenate([[True], np.diff(word[at]) > 0])
                if not lead.all():
                    index[r] = [at[~lead]]
                    heapq.heappush(heap, r)
                at = at[lead]
            elif len(at) > 1 and (touch := nxt[at[:-1]] == at[1:]).any():
                # Of overlapping pairs the leftmost merges, then every other one.
                i = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~touch]), i, 0))
                at = at[(i - begin) % 2 == 0]
            gone = nxt[at]
            after = nxt[gone]
            tok[at], nxt[at], alive[gone] = r, after, False
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            near = _distinct(np.concatenate([at, before[before >= 0]]))
            nn = nxt[near]
            fresh = np.where(nn >= 0, self.ranks_of(tok[near], tok[np.maximum(nn, 0)]), _NONE)
            changed = near[fresh != pair[near]]
            pair[near] = fresh
            enter(changed)
        kept = np.flatnonzero(alive)
        flat = tok[kept].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(word[kept], np.arange(len(words) + 1))).tolist()
        return [flat[i:j] for i, j in zip(cuts, cuts[1:])]

    def split(self, piece: str) -> list[str]:
        """The matches of the pattern in a piece; plain words need no pattern."""
        bare = piece[1:] if piece[:1] == " " else piece
        if bare.isalpha() and max(bare) < _LATIN_END:
            return [piece]
        if bare[-1:] in (",", ".") and bare[:-1].isalpha() and max(bare) < _LATIN_END:
            return [piece[:-1], piece[-1]]
        return self.pattern.findall(piece)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces of text, each match of the pattern separately."""
        split = [self.split(p) for p in pieces]
        new = list({w for s in split for w in s})
        ids = dict(zip(new, self.replay([w.encode() for w in new]), strict=True))
        return [ids[s[0]] if len(s) == 1 else b"".join([ids[w] for w in s]) for s in split]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        return self.pieces.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def model(path: str, pattern: str) -> MergeReplay:
    """The encoder of a rank file, one for each process."""
    if path not in _models:
        _models[path] = MergeReplay(read_ranks(path), pattern)
    return _models[path]


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of some batches together, for a fuller vocabulary."""
    keys, texts, size = [], [], 0
    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            keys.append(k)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= TOGETHER:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every text, as binary of little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
        for keys, texts in grouped(batches):
            yield arrow_batch(schema, keys, list(m.encode(texts)))

    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from the result of :func:`encode_documents`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
        for b in batches:
            yield arrow_batch(schema, b.column(0).to_pylist(), [m.decode(x).decode("utf-8", "replace") for x in b.column(1).to_pylist()])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def encoding_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, pattern)
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        for keys, texts in grouped(batches):
            n, a, b = [], [], []
            for ids in m.encode(texts):
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(m.decode(ids)).hexdigest())
            yield arrow_batch(schema, keys, n, a, b)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
