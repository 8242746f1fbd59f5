"""The training of the classifiers against plain counts and plain descent."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import language_id, toxicity
from helixframe.llm.common import Scratch


def test_toxicity_features_are_log_count_ratios(spark, monkeypatch):
    """Every n-gram in three documents or more is a feature, scaled by the ratio that plain counts of strings give."""
    rng = random.Random(3)
    words = {0: ["garden", "river", "paper", "window", "the"], 1: ["rotten", "stupid", "window", "the", "paper"]}
    texts = {i: (i % 3 == 0, " ".join(rng.choices(words[int(i % 3 == 0)], k=rng.randint(1, 12)))) for i in range(90)}
    docs = spark.createDataFrame([(i, t) for i, (_, t) in texts.items()], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(y)) for i, (y, _) in texts.items()], "doc_id long, toxic int")
    seen, train = {}, toxicity._logistic

    def record(rows, r):
        seen.update(rows=rows, r=r)
        return train(rows, r)

    monkeypatch.setattr(toxicity, "_logistic", record)
    model = toxicity.fit(docs, marks, F.lit(True), Scratch(spark), n_features=60_000)

    grams = {i: {f" {t} "[a : a + n] for n in (3, 4, 5, 6) for a in range(len(t) + 3 - n)} for i, (_, t) in texts.items()}
    toxic, clean = (Counter(g for i in texts if texts[i][0] == y for g in grams[i]) for y in (True, False))
    n1 = sum(y for y, _ in texts.values())
    n0 = len(texts) - n1
    want = sorted(math.log((toxic[g] + 1) / (n1 + 2) / ((clean[g] + 1) / (n0 + 2))) for g in toxic | clean if toxic[g] + clean[g] >= 3)
    assert np.allclose(sorted(seen["r"]), want)
    often = {g for g in toxic | clean if toxic[g] + clean[g] >= 3}
    assert sorted((y, len(a)) for y, a in seen["rows"]) == sorted((int(texts[i][0]), len(grams[i] & often)) for i in texts)

    x = np.zeros((len(texts), len(want)))
    for k, (_, a) in enumerate(seen["rows"]):
        x[k, a] = 1
    y = np.array([k for k, _ in seen["rows"]], float)
    cost, f = np.where(y == 1, math.sqrt(n0 / n1), 1.0), x * seen["r"]

    def loss(w: np.ndarray, b: float) -> float:
        z = f @ w + b
        return float(np.mean(cost * (np.logaddexp(0, z) - y * z)) + 0.0005 * w @ w)

    w, b = np.zeros(f.shape[1]), 0.0
    rate = 4 / (np.linalg.norm(f, 2) ** 2 / len(y) * cost.max() + 1)
    for _ in range(4000):
        e = (1 / (1 + np.exp(-(f @ w + b))) - y) * cost / len(y)
        w, b = w - rate * (f.T @ e + 0.001 * w), b - rate * e.sum()
    fitted = np.divide(model.weights, seen["r"], out=np.zeros_like(model.weights), where=np.abs(seen["r"]) > 1e-9)
    # Small steps of few epochs come near the least loss, and far from that of no weights.
    assert loss(fitted, model.bias) - loss(w, b) < 0.1 * (loss(np.zeros_like(w), 0.0) - loss(w, b))


def _rows(rng: np.random.Generator, n: int, langs: int, own: bool) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Documents of 20 buckets: each language's own, or those of all."""
    out = []
    for i in range(n):
        k = int(rng.integers(langs))
        at = np.sort(rng.choice(200, 20, replace=False)) + (200 * k if own else 0)
        out.append((f"l{k}", at, np.full(20, 0.05)))
    return out


@pytest.mark.parametrize("own", [True, False])
def test_language_training_and_calibration(own):
    """Languages with their own buckets are told apart with confidence; labels that mean nothing give shares near chance, and most are rejected."""
    rng = np.random.default_rng(6)
    model = language_id.train(_rows(rng, 900, 3, own))
    fresh = _rows(rng, 400, 3, own)
    z = np.stack([s @ model.table[at] + model.bias for _, at, s in fresh]) / model.temperature
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    right = np.array([model.langs[k] == lang for k, (lang, _, _) in zip(p.argmax(1), fresh, strict=True)])
    if own:
        assert right.all() and p.max(1).mean() > 0.95 and (p.max(1) >= model.reject).mean() > 0.9
    else:
        assert right.mean() < 0.45 and abs(p.max(1).mean() - right.mean()) < 0.15 and (p.max(1) >= model.reject).mean() < 0.2
