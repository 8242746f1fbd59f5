"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features say whether a hashed character n-gram occurs in a text. Document counts
of each n-gram and class, taken over a sample of labelled documents, give the
log-count ratio that scales the feature; the ``n_features`` n-grams whose ratio
is best supported are kept, and a logistic regression is trained on them in
numpy. At most ``per_class`` documents of each label are learned from, chosen by
a hash of doc_id.

Defined cases: null and empty texts hold no n-gram and get the score of the
intercept; labels other than 0 and 1, and those of ids with both, are not learned
from; without labels of both classes every score is the share of label 1; repeated
rows score alike and are one document to learn from; rows with a null key
are scored, not learned from; an empty table gives an empty one; other columns are
not read. Whole texts are read, of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batch, hashed_sample, map_arrow
from .language_id import letters

BITS, ORDERS = 22, (3, 4, 5, 6)


def ngrams(text: str) -> np.ndarray:
    """Buckets of the n-grams of a text, white space included as one space, with repeats."""
    c = letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(c), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if n > len(c):
                break
            h = (h[: len(c) - n + 1] * np.uint32(0x01000193)) ^ (c[n - 1 :] * np.uint32(0x9E3779B1))
            if n in ORDERS:
                x = (h ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35)
                out.append((x ^ (x >> np.uint32(15))) & np.uint32((1 << BITS) - 1))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


@dataclass
class ToxicityModel:
    """Weights of buckets, sorted by bucket, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def lookup(self) -> np.ndarray:
        """For each bucket its feature's number plus one, or zero."""
        t = np.zeros(1 << BITS, np.uint16)
        t[self.buckets] = np.arange(1, len(self.buckets) + 1)
        return t

    def score(self, text: str | None, table: np.ndarray) -> float:
        """The probability of label 1."""
        f = table[ngrams(text or "")]
        seen = np.zeros(len(self.weights) + 1, bool)
        seen[f] = True
        z = self.bias + float(self.weights[seen[1:]].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _pairs(chosen: DataFrame, table: np.ndarray | None) -> DataFrame:
    """(label, at): the distinct buckets, or the numbers of features, of each text."""
    shared = chosen.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.int32()), ("at", pa.list_(pa.int32()))])
        t = shared.value
        for b in batches:
            at = [np.unique(ngrams(x or "")) for x in b.column(1).to_pylist()]
            if t is not None:
                at = [(u := np.unique(t[a]))[u > 0] for a in at]
            yield arrow_batch(schema, b.column(0).to_pylist(), [a.astype(np.int32) for a in at])

    return map_arrow(chosen, run, "label int, at array<int>")


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, scratch: Scratch, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = 4000, n_features: int = 2048, min_docs: int = 3,
) -> ToxicityModel:
    """Train on labelled documents for which ``learn``, a condition on doc_id, holds.

    Ids with both labels teach nothing. Repeated rows of one id are one document, that of
    the least text, so at most ``per_class`` documents of a label reach the driver.
    """
    marked = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    marked = marked.groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("label", "key")
    # At most 2 x per_class ids are broadcast to the scan; no text is shuffled.
    ids = hashed_sample(marked, "label", "key", per_class)
    slim = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    with scratch.temporary() as own:
        return _fitted(own.save(slim.join(F.broadcast(ids), "key").groupBy("label", "key").agg(F.min("text").alias("text")).select("label", "text")), n_features, min_docs)


def _fitted(chosen: DataFrame, n_features: int, min_docs: int) -> ToxicityModel:
    """The model of a table (label, text)."""
    n = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), float(np.log(share / (1 - share))))
    counts = _pairs(chosen, None).select("label", F.explode("at").alias("at")).groupBy("at").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    # Document frequencies in smoothed shares, their log ratio, and its standard error.
    p, q = (F.col("p") + 1) / (n1 + 2), (F.col("q") + 1) / (n0 + 2)
    ratio = F.log(p / q)
    error = F.sqrt((1 - p) / (F.col("p") + 1) + (1 - q) / (F.col("q") + 1))
    top = (
        counts.where(F.col("p") + F.col("q") >= min_docs).select("at", ratio.alias("r"), F.abs(ratio / error).alias("z"))
        .orderBy(F.desc("z"), "at").limit(n_features).toArrow()
    )
    at, r = np.asarray(top["at"]).astype(np.int64), np.asarray(top["r"])
    order = np.argsort(at)
    at, r = at[order], r[order]
    model = ToxicityModel(at, np.zeros(len(at)), 0.0)
    got = _pairs(chosen, model.lookup()).toArrow()
    rows = sorted(zip(got["label"].to_pylist(), (np.asarray(a.values) - 1 for a in got["at"]), strict=True), key=lambda x: (x[0], len(x[1]), x[1].tolist()))
    model.weights, model.bias = _logistic(rows, r)
    return model


def _logistic(rows: list[tuple[int, np.ndarray]], r: np.ndarray, epochs: int = 40, decay: float = 1e-3, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights on unscaled features, and the intercept, by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    y = np.array([k for k, _ in rows], np.float32)
    x = np.zeros((len(rows), len(r)), bool)
    for i, (_, a) in enumerate(rows):
        x[i, a] = True
    scale = r.astype(np.float32)
    # The rarer label counts more, by the root of the classes' proportion.
    cost = np.where(y == 1, np.sqrt(max(1.0, (y == 0).sum() / max(1, (y == 1).sum()))), 1).astype(np.float32)
    w, m, v = (np.zeros(len(r) + 1, np.float32) for _ in range(3))
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), 256):
            k = order[i : i + 256]
            f = x[k] * scale
            p = 1 / (1 + np.exp(-np.clip(f @ w[:-1] + w[-1], -60, 60)))
            e = (p - y[k]) * cost[k] / len(k)
            g = np.concatenate([f.T @ e + decay * w[:-1], [e.sum()]])
            t += 1
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            w = w - 0.02 * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return (w[:-1] * scale).astype(np.float64), float(w[-1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every text; a map over rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n_features numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
        m = shared.value
        table = m.lookup()
        for b in batches:
            s = [m.score(t, table) for t in b.column(1).to_pylist()]
            yield arrow_batch(schema, b.column(0).to_pylist(), s, [int(x >= 0.5) for x in s])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(slim, run, "doc_id long, score double, predicted int")
