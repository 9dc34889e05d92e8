"""The word-level language model: exact inference, code-switched words, held-out accuracy."""

import itertools
import zlib

import numpy as np

from tabforge.llm import langid
from tabforge.llm.common import table


def tiny(labels=3, seed=2):
    rng = np.random.default_rng(seed)
    return langid.Crf([f"l{i}" for i in range(labels)], rng.normal(0, 0.6, (langid.SLOTS, labels)), rng.normal(0, 1, labels), rng.normal(0, 1, (labels, labels)))


def enumerated(model, words):
    """Marginals by summing over every labelling."""
    z = np.array([model.weights[langid.features(w)].sum(0, dtype=float) for w in words])
    out = np.zeros((len(words), len(model.labels)))
    for path in itertools.product(range(len(model.labels)), repeat=len(words)):
        score = model.start[path[0]] + sum(z[i, y] for i, y in enumerate(path)) + sum(model.change[a, b] for a, b in zip(path, path[1:]))
        for i, y in enumerate(path):
            out[i, y] += np.exp(score)
    return out / out.sum(1, keepdims=True)


def test_posteriors_equal_enumeration_across_blocks(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 3)
    model, words = tiny(), "eins zwei drei quatre cinq six seven acht neuf".split()
    texts = [words[:n] for n in (7, 1, 0, 3, 9, 6)] + [words[::-1][:4]]
    got = model.posteriors(texts)
    want = np.concatenate([enumerated(model, t) for t in texts if t])
    assert np.allclose(got, want, atol=1e-6)


def test_gradient_moves_to_observed_counts():
    rows = [("a", ["aba abb baa bab"]), ("b", ["xyx yyx xxy yxy"])] * 30
    model = langid.fit(rows, rounds=80)
    assert model.labels == ["a", "b"]
    got = model.posteriors(["aba bab xyx yxy".split()]).argmax(1)
    assert got.tolist() == [0, 0, 1, 1]


def learnt(spark, small):
    docs = table(spark, small, "documents")
    return langid.fit([(r.lang, r.spans) for r in langid.sample(docs).orderBy("key", "lang").collect()])


def test_held_out_documents_and_switched_words(spark, small):
    rows = {r.doc_id: r for r in table(spark, small, "documents").collect()}
    got = langid.query(spark, small).collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) >= 0.97 * len(held)
    model = learnt(spark, small)
    texts = {lang: langid.words_of(next(rows[r.doc_id].text for r in held if rows[r.doc_id].lang == lang))[:30] for lang in ("en", "de", "fr", "es")}
    mixed = [w for t in texts.values() for w in t]
    want = np.repeat([model.labels.index(lang) for lang in texts], [len(t) for t in texts.values()])
    assert (model.posteriors([mixed]).argmax(1) == want).mean() > 0.85


def test_batching_does_not_change_predictions(spark, small):
    model = learnt(spark, small)
    texts = [r.text for r in table(spark, small, "documents").limit(40).collect()]
    langs, scores = model.documents(texts)
    single = [model.documents([t]) for t in texts]
    assert langs == [s[0][0] for s in single] and np.allclose(scores, [s[1][0] for s in single])


def test_edge_rows(spark, edge_docs, small):
    model = learnt(spark, small)
    got = langid.predicted(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert langid.predicted(edge_docs.limit(0), model).count() == 0
    assert langid.sample(edge_docs.limit(0)).count() == 0
    empty = langid.predicted(edge_docs, langid.fit([]))
    assert {r.lang_pred for r in empty.collect()} == {"und"}
    copies = spark.createDataFrame([(0, "ein Wort", "de")] * 500, "doc_id long, text string, lang string")
    assert langid.sample(copies, 3).count() == 1
