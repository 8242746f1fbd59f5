"""The pipeline against the plain versions, stage by stage."""

from __future__ import annotations

import corpus_pipeline
from helixframe.llm.common import Scratch

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, scratch, names = spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark), None
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        names = docs.columns
        docs = scratch.save(stage(spark, docs, SF))
        after = {r["doc_id"]: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert docs.columns == names and set(after) <= {d for d, _ in before}
        if name == "quality_rules":
            failed = {d for d, t in before if brute.quality(t)[5]}
            assert not failed & set(after) and len(after) >= 0.8 * (len(before) - len(failed))
        elif name == "ngram_jaccard":
            assert set(after) == {d for d, (_, c) in brute.similar(before).items() if d == c}
        elif name == "substring_dedup":
            want = brute.repeats(before)
            assert all(brute.WORD.findall(after[d]["text"]) == w[3] for d, w in want.items())
        elif name == "secret_scan":
            assert not any(brute.base_secrets(r["text"]) for r in after.values())
        else:
            assert set(after) == {d for d, _ in before}
