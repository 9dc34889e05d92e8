"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

from tabforge.llm import periodic
from tabforge.llm.common import table


def brute_runs(words, least=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 3 * q):
                found.setdefault((s, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [w.encode() for w in periodic_words(text)]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_random_words_of_few_letters():
    rng = random.Random(3)
    texts = []
    for _ in range(300):
        words, kinds = [], rng.choice([1, 2, 3, 30])
        while len(words) < rng.randint(0, 260):
            part = [str(rng.randrange(kinds)).encode() for _ in range(rng.choice([1, 2, 5, 9, 17, 40]))]
            words += part * rng.choice([1, 1, 2, 3, 4, 9])
            words += words[: rng.choice([0, 0, 3, 20])]
        texts.append(words)
    for least in (24, 3, 7):
        got = periodic.runs(texts, least)
        assert got == [brute_runs(t, least) for t in texts]
    assert sum(map(len, periodic.runs(texts))) > 100


def test_nested_and_highly_periodic_words():
    inner = [b"a", b"b"] * 14 + [b"c"]          # runs of period 2 within runs of period 29
    texts = [inner * 5 + [b"z"] + inner * 3, [b"x"] * 4000, ([b"x"] * 63 + [b"y"]) * 9, (([b"x"] * 9 + [b"y"]) * 6 + [b"w"]) * 4, [], [b"q"]]
    assert periodic.runs(texts) == [brute_runs(t) for t in texts]


def test_wavelet_against_lists():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 300):
        values = rng.permutation(n)
        tree = periodic.Wavelet(values)
        low = rng.integers(0, n, 200)
        high = low + 1 + rng.integers(0, n, 200) % (n - low)
        bound = rng.integers(0, 2 * n + 2, 200)
        below = tree.below(low, high, bound)
        assert below.tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(low, high, bound)]
        k = rng.integers(0, 1 << 30, 200) % (high - low)
        assert tree.nth(low, high, k).tolist() == [sorted(values[a:b])[i] for a, b, i in zip(low, high, k)]


def test_query_matches_brute_force(spark, small):
    docs = table(spark, small, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in periodic.query(spark, small).collect()}
    assert got == {r.doc_id: brute_row(r.doc_id, r.text) for r in docs}


def test_edge_rows(spark, edge_docs):
    got = sorted(map(tuple, periodic.periodic_runs(edge_docs).select("doc_id", "n_words").collect()), key=str)
    want = [(r.doc_id, len(periodic_words(r.text))) for r in edge_docs.collect()]
    assert got == sorted(want, key=str)
    rows = {r.doc_id: r for r in periodic.periodic_runs(edge_docs).collect()}
    assert rows[1].runs == [] and rows[1].collapsed == "" and rows[3].collapsed == ""
    assert [tuple(r) for r in rows[7].runs] == [(0, 120, 4)] and rows[7].collapsed == "ein Wörterbuch für späße."
    assert periodic.looped(edge_docs).count() == edge_docs.count()
    assert periodic.periodic_runs(edge_docs.limit(0)).count() == 0


def test_texts_of_a_batch_do_not_meet():
    texts = [[b"a", b"b", b"c"] * 20, [b"a"] * 30, [b"a"] * 23, [b"b"]]
    assert periodic.runs(texts) == [brute_runs(t) for t in texts] == [[(0, 60, 3)], [(0, 30, 1)], [], []]
