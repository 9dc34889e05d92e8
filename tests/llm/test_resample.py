"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from tabforge.llm import resample
from tabforge.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, target, longest=1, least=20):
    def features(text):
        words = brute_words(text)
        return [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = (Counter(b for text in side for b in features(text)) for side in ([x for _, x in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, len(brute_words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: 10 * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def multiset(rows):
    return Counter(map(tuple, rows))


def test_query_matches_brute_force_and_sql(spark, small):
    docs = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    target = [r.text for r in table(spark, small, "benchmark").collect()]
    got = multiset(resample.query(spark, small).collect())
    assert got == multiset(brute(docs, target))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    assert got == multiset(con.sql(resample.SQL).fetchall())


@pytest.mark.parametrize("longest", [1, 3])
def test_copies_of_one_row_are_spread_and_ranked(spark, longest):
    text = "alpha beta gamma " * 8
    rows = [(7, text)] * 3000 + [(i, text + f"w{i % 50}") for i in range(100, 4000)] + [(None, text)] * 20 + [(5, "too short"), (6, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([("alpha w3 w4", 1), (None, 2)], "text string, n int")
    got = resample.resample(docs, target, longest=longest, part_rows=200)
    assert multiset(got.collect()) == multiset(brute(rows, ["alpha w3 w4", None], longest))


def test_parts_are_even_with_copies(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 1, id) AS doc_id", "if(id % 3 = 0, 5L, id % 11) AS score", "1L AS n_features", "true AS take", "0L AS weight")
    runs = resample.sorted_runs(rows.repartition(9), "take")
    placed = resample._segments(runs, resample.splitters(runs, 20_000, 20))
    sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1.3 * 1000


def test_edge_rows(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    target = spark.createDataFrame([("word1 tail2",)], "text string")
    assert multiset(resample.resample(edge_docs, target).collect()) == multiset(brute(docs, ["word1 tail2"]))
    assert resample.resample(edge_docs.limit(0), target).count() == 0
    assert resample.resample(edge_docs, target.limit(0)).count() == len(docs)
