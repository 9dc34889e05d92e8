"""The pipeline against brute force, stage by stage, and the registered queries."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import __spark_entry__ as entry
from tabforge.llm import quality, toxicity
from tabforge.llm.common import table, written
from .test_pairs_and_shards import brute_components, brute_fingerprint
from .test_texts import brute_quality

SECRET = re.compile(r'\bAKIA[0-9A-Z]{16}\b|(?i:password)=[0-9a-fA-F]{18}|(?i:token) = "[0-9a-fA-F]{40}"')


def test_stages_match_brute_force(spark, small):
    docs = table(spark, small, "documents")
    columns, after = docs.columns, {}
    grammar = toxicity.fit(toxicity.sample(docs, table(spark, small, "labels")))
    want = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, small), f"test-{name}")
        assert docs.columns == columns
        after[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(after[name])
        if name == "toxicity":
            want = {i: t for i, t in want.items() if grammar.score(t) < 0.5}
        elif name == "quality_rules":
            kept = {r.doc_id: r.cleaned for r in quality.judged(spark.createDataFrame(list(want.items()), "doc_id long, text string")).collect()}
            want = {i: kept[i] for i, t in want.items() if brute_quality(t)[-1]}
        elif name == "near_dedup":
            fps = {i: brute_fingerprint(t) for i, t in want.items()}
            want = {i: want[i] for group in brute_components(set(fps.values())) for i in [min(j for j, f in fps.items() if f in group)]}
        else:
            want = {i: SECRET.sub("[SECRET]", t) for i, t in want.items()}
        assert after[name] == want, name
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    pieces = pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {p.doc_id for p in pieces} == set(want)
    assert all(sum(p.length for p in pieces if p.doc_id == i) == max(p.doc_tokens for p in pieces if p.doc_id == i) for i in want)


def test_stages_on_edge_rows(spark, edge_docs, small):
    mine = {c: "mine" for c in ("predicted", "n_words", "kept", "cleaned", "_key", "_nth", "_c", "_l", "row", "base_failed", "_id", "fp")}
    docs = edge_docs.withColumns({c: F.lit(v) for c, v in mine.items()})   # ``score`` among them: names that operators use
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert len(rows) <= docs.count() and all(r.asDict().items() >= mine.items() and r.score in ("x", "y", None) for r in rows)
    kept = pipeline.near_dedup(spark, docs, small)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7]
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
