"""Top-k search, SimHash near-dedup and sharding against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabforge.llm import maxscore, sharding, simhash


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute_topk(rows, k=10):
    found = {}
    for qid, q in rows:
        if qid % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), vid) for vid, v in rows if vid != qid)[:k]
        found[qid] = [(vid, -s) for s, vid in scores]
    return found


@pytest.mark.parametrize("shard_rows,query_block", [(64, 2), (10_000, 512)])
def test_topk_matches_brute_force(spark, small, shard_rows, query_block):
    vectors = maxscore.quantise(spark.read.parquet(f"{small}/embeddings.parquet")).cache()
    got = defaultdict(dict)
    for r in maxscore.topk(vectors, vectors.where("vec_id % 100 = 0"), 10, shard_rows, query_block).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    want = brute_topk([(r.vec_id, list(r.q)) for r in vectors.collect()])
    assert {q: [v[i] for i in sorted(v)] for q, v in got.items()} == want


def test_topk_edges(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (5, [], 1), (6, [0.5], 1),
            (7, [-1.0, -0.5], 1), (8, [0.5, 0.0], 1), (None, [9.0, 9.0], 1), (100, [0.0, 0.0], None), (200, [1e9, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    vectors = maxscore.quantise(df)
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 5, 6, 7, 8, 100, 200]
    got = [(r.query_id, r["rank"], r.vec_id) for r in maxscore.topk(vectors, vectors.where("vec_id = 0"), 10).collect()]
    assert sorted(got) == [(0, 1, 200), (0, 2, 6), (0, 3, 8), (0, 4, 5), (0, 5, 100), (0, 6, 7)]  # ties 6 and 8, 5 and 100: smaller vec_id
    assert maxscore.topk(vectors.limit(0), vectors.limit(0)).count() == 0


def brute_fingerprint(text):
    import xxhash

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=2):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {frozenset(f for f in fps if find(f) == r) for r in {find(f) for f in fps}}


def test_fingerprint():
    for text in (None, "", " \t", "one", "Two Words", "A b C d É f", "x " * 5000):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("distance,limit", [(2, 64), (2, 0), (2, 3), (1, 64), (1, 0)])
def test_links_match_brute_force(spark, distance, limit):
    rng = np.random.default_rng(distance)
    fps = set()
    for base in rng.integers(0, 1 << 63, 12, dtype=np.uint64).tolist():
        for _ in range(25):  # chains and clusters of near fingerprints
            fps.add(base)
            for bit in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                base ^= 1 << bit
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = simhash.links(df, distance, limit)
    groups = defaultdict(set)
    for r in simhash.components(edges).collect():
        groups[r.root].add(r.node)
    got = {frozenset(g) for g in groups.values()}
    want = {frozenset(map(signed, g)) for g in brute_components(fps, distance) if len(g) > 1}
    assert got == want


def test_near_duplicates_matches_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.select("doc_id", "text").collect()}
    least = {f: min(i for i, g in fps.items() if g in group) for group in brute_components(set(fps.values())) for f in group}
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.query(spark, small).collect()}
    assert got == {(i, f"{f:016x}", least[f]) for i, f in fps.items()}


def test_near_duplicates_edges(spark, edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    wordless = [r for r in rows if r.fp == 0]
    assert {r.doc_id for r in wordless} == {1, 2, 3} and {r.component_id for r in wordless} == {1}
    assert [r.component_id for r in rows if r.doc_id == 4] == [4, 4]
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0


def least_capacity(sizes, shards):
    def runs(c):
        n, room = 1, c
        for s in sizes:
            if s > c:
                return 1 << 60
            if s > room:
                n, room = n + 1, c
            room -= s
        return n

    return next(c for c in range(max(max(sizes), -(-sum(sizes) // shards)), sum(sizes) + 1) if runs(c) <= shards)


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_sharding_is_the_least_contiguous_partition(spark, small, shards):
    import xxhash

    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shard(docs, shards).collect()
    total, slots, placed, group = defaultdict(int), defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == __import__("zlib").crc32(raw)
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        placed[texts[r.doc_id]].add(r.shard)
        group[signed(xxhash.xxh64_intdigest(raw, 42))] += r["size"]
    assert len(rows) == len(texts) and set(total) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in placed.values())
    assert max(total.values()) == least_capacity([group[k] for k in sorted(group)], shards)


def test_sharding_edges(spark, edge_docs):
    rows = sharding.shard(edge_docs, 4).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.shard < 4 for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2)} == {8}
    assert sharding.shard(edge_docs.limit(0), 4).count() == 0
    same = spark.createDataFrame([(i, "one group") for i in range(50)], "doc_id long, text string")
    assert {r.shard for r in sharding.shard(same, 4).collect()} == {0}


@pytest.mark.parametrize("heavy", [(600,), (600, 270)])
def test_sharding_spreads_the_rest_beside_heavy_groups(spark, heavy):
    texts = [f"light {i:05d}" for i in range(1200)] + [f"heavy {k:05d}" for k, n in enumerate(heavy) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard(docs, 24).collect()
    total, placed = Counter(), defaultdict(set)
    for r in rows:
        total[r.shard] += r["size"]
        placed[texts[r.doc_id]].add(r.shard)
    assert len(rows) == len(texts) and set(total) == set(range(24)) and all(len(s) == 1 for s in placed.values())
    sizes = sorted(total.values(), reverse=True)
    apart = [n for n in heavy if n > len(texts) / 24]
    assert sizes[: len(apart)] == [19 * n for n in apart]
    fair = (sum(sizes) - sum(sizes[: len(apart)])) / (24 - len(apart))
    assert sizes[len(apart)] <= 1.2 * fair and sizes[-1] >= 0.7 * fair


def test_deduplicated_keeps_every_group(spark):
    one, two, three = ("alpha beta gamma delta " * 9).strip(), ("eins zwei drei vier " * 9).strip(), ("un deux trois quatre " * 9).strip()
    rows = [(5, one, "x"), (5, two, "y"), (3, two, "z"), (5, one, "x"), (7, one, "w"), (None, three, "v"), (9, None, "u"), (8, "", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.deduplicated(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(5, one, "x"), (3, two, "z"), (None, three, "v"), (8, "", "t")], key=str)
    assert simhash.deduplicated(df.limit(0)).count() == 0


def test_topk_refuses_scores_beyond_64_bits(spark):
    far = spark.createDataFrame([(0, [9 * 10**15, 1]), (1, [9 * 10**15, -1])], "vec_id long, q array<long>")
    with pytest.raises(ValueError):
        maxscore.topk(far, far)
    near = spark.createDataFrame([(0, [2 * 10**9, 7]), (1, [2 * 10**9, -1])], "vec_id long, q array<long>")
    assert {(r.query_id, r.vec_id): r.score for r in maxscore.topk(near, near).collect()} == {(0, 1): 4 * 10**18 - 7, (1, 0): 4 * 10**18 - 7}
