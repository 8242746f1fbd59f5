"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams, which do
not cross white space. Embeddings and softmax are trained together by mini-batch
stochastic gradient descent in numpy, on at most ``per_lang`` labelled documents
of each language, chosen by a hash of doc_id. A part of them is held back to fit
the temperature and the confidence under which a prediction is rejected.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows without a language are never learned from; without any labelled row every
text is ``und``; repeated rows get equal answers and are one document to
learn from; rows with a null key are answered, not learned from; an empty table gives
an empty one; other columns are not read. Whole texts are read, of any length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, hashed_sample, map_arrow

BITS, DIM, ORDERS = 14, 16, (1, 2, 3, 4)
_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    if not _table:
        t = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                t[i] = ord(c.lower()[0])
        # Combining marks stay, as they are part of words in many scripts.
        for i in range(0x300, 0x1B00):
            if unicodedata.category(chr(i)) in ("Mn", "Mc"):
                t[i] = i
        _table.append(t)
    return _table[0]


def ngrams(text: str) -> tuple[np.ndarray, bool]:
    """Buckets of all subwords of a text, with repeats, and whether it has a letter."""
    c = letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letter = c != 32
    if not letter.any():
        return np.empty(0, np.int64), False
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    space = c == 32
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(c), np.uint32)
        inside = np.ones(len(c), bool)
        for n in range(1, max(ORDERS) + 1):
            # h[i]: hash of c[i : i + n]; inside[i]: no space but at the ends
            h = (h[: len(c) - n + 1] * np.uint32(0x01000193)) ^ (c[n - 1 :] * np.uint32(0x9E3779B1))
            if n > 2:
                inside = inside[: len(c) - n + 1] & ~space[n - 2 : len(c) - 1]
            ok = inside[: len(h)] & ~(space[: len(h)] & space[n - 1 :])
            if n in ORDERS:
                x = (h[ok] ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
                out.append(x >> np.uint32(32 - BITS))
    return np.concatenate(out).astype(np.int64), True


@dataclass
class LanguageModel:
    """A trained classifier; ``table`` holds each bucket's share of every language's logit."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability."""
        at, any_letter = ngrams(text or "")
        if not any_letter or not self.langs:
            return "und", 0.0
        n = np.bincount(at, minlength=1 << BITS)
        z = (n @ self.table / len(at) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 12, rate: float = 20.0, seed: int = 7) -> LanguageModel:
    """Fit by SGD; rows are (language, buckets, shares that sum to 1)."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return LanguageModel([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(r[0]) for r in rows])
    E = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    W, b = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    order = rng.permutation(len(rows))
    held, fit = order[: len(rows) // 6], order[len(rows) // 6 :]

    def dense(batch: np.ndarray) -> np.ndarray:
        x = np.zeros((len(batch), 1 << BITS), np.float32)
        for i, k in enumerate(batch):
            x[i, rows[k][1]] = rows[k][2]
        return x

    steps = max(1, epochs * -(-len(fit) // 32))
    done = 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for i in range(0, len(fit), 32):
            batch = fit[i : i + 32]
            x, step = dense(batch), rate * (1 - done / steps)
            h = x @ E
            z = h @ W + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), y[batch]] -= 1
            p /= len(batch)
            gh = p @ W.T
            W -= step / 4 * np.clip(h.T @ p, -1, 1)
            b -= step / 40 * p.sum(0)
            used = np.flatnonzero(x.any(0))
            E[used] -= step * (x[:, used].T @ gh)
            done += 1
    table = (E @ W).astype(np.float64)
    model = LanguageModel(langs, table, b.astype(np.float64), 1.0, 0.0)
    if len(held):
        z = np.stack([rows[k][2] @ table[rows[k][1]] + b for k in held])

        def loss(t: float) -> float:
            s = z / t
            return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(held)), y[held]]))

        model.temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        s = z / model.temperature
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        right, conf = p.argmax(1) == y[held], p.max(1)
        # The least confidence from which on held-back documents are right 99 times in 100.
        at = np.argsort(-conf)
        good = np.flatnonzero(np.cumsum(right[at]) / np.arange(1, len(at) + 1) >= 0.99)
        model.reject = float(conf[at[good[-1]]]) if len(good) else 1.0
    return model


def fit(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 800) -> LanguageModel:
    """Train on up to ``per_lang`` documents of each language among those where ``learn`` holds.

    Documents are chosen by their ids alone, so no text is sorted or shuffled;
    the chosen ids, a bounded number, are broadcast to the scan of the texts. Repeated
    rows of one language and id are one document, that of the least text, so what is learnt from is bounded too.
    """
    slim = docs.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    ids = hashed_sample(slim.select("lang", "key"), "lang", "key", per_lang)
    chosen = slim.join(F.broadcast(ids), ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("at", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])
        for b in batches:
            langs, ats, shares = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, ok = ngrams(t or "")
                if ok:
                    u, n = np.unique(at, return_counts=True)
                    langs.append(k)
                    ats.append(u.astype(np.int32))
                    shares.append((n / len(at)).astype(np.float32))
            yield arrow_batch(schema, langs, ats, shares)

    got = map_arrow(chosen, run, "lang string, at array<int>, share array<float>").toArrow()
    rows = sorted(
        ((k, np.asarray(a.values), np.asarray(s.values)) for k, a, s in zip(got["lang"].to_pylist(), got["at"], got["share"], strict=True)),
        key=lambda r: (r[0], len(r[1]), float(r[2][0]), int(r[1].sum())),
    )
    return train(rows)


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every text; a map over rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most buckets x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column(1).to_pylist()]
            yield arrow_batch(schema, b.column(0).to_pylist(), [g[0] for g in got], [g[1] for g in got], [g[0] != "und" and g[1] >= m.reject for g in got])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "doc_id long, lang_pred string, score double, accepted boolean")
