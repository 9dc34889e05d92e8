"""Importance resampling towards a target distribution, without replacement.

Documents are weighted by hashed word features: one array of bucket counts for the corpus, one for
the target, and from them one array of integer gains.  A document's weight is the sum of the gains
at its buckets; adding Gumbel noise drawn from its id makes the highest scores a weighted sample.

The draw needs exact ranks over all documents, found by parallel sorting by regular sampling:

1. every task sorts its rows and writes them, so each part of the written table is a sorted run;
2. rows at regular positions of all runs are sorted, and rows at regular positions of those become
   the splitters;
3. splitters cut every run into segments; segments are counted per part and the prefix sums of the
   counts say how many rows come before each part;
4. parts the draw reaches are exchanged, merged in order, and a row's rank is the prefix count plus
   its place in its part.  Rows of later parts stay where they are: their rank is past the draw.

Rows are compared by (score, tie, features, place in the runs), which no two rows share, so copies
of one row, however many, are spread over parts like any others.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, written

#: Byte for byte: A-Z become lower case, digits, a-z and bytes of other code points from U+0080 stay, the rest separates words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words whose bucket a process keeps, and their longest size; the others are hashed each time.
KEPT, KEPT_BYTES = 400_000, 64
#: Sampled rows per part: with r runs a part holds at most 1 + r / OVER times its share.
OVER = 64


class _Buckets(dict):
    """Bucket of a feature by the CRC-32 of its bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.buckets
        if len(self) < KEPT and len(word) <= KEPT_BYTES:
            self[word] = bucket
        return bucket


def _features(raw: bytes | None, buckets: _Buckets, longest: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words."""
    words = (raw or b"").translate(LETTERS).split()
    parts = [np.fromiter(map(buckets.__getitem__, words), np.int32, len(words))]
    for n in range(2, min(longest, len(words)) + 1):
        runs = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        parts.append(np.fromiter(map(buckets.__getitem__, runs), np.int32, len(runs)))
    return len(words), np.concatenate(parts)


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column("text").cast(pa.binary()))


def bucket_counts(docs: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features per bucket over all texts: every task adds up an array, then arrays are summed by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, memo = np.zeros(buckets, np.int64), _Buckets(buckets)
        for batch in batches:
            for raw in _texts(batch):
                total += np.bincount(_features(raw, memo, longest)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    found = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) per bucket, with one count added to every bucket of both sides."""
    a, b = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratio = lambda s, t: math.floor(1000 * math.log((t + 1.0) * a / ((s + 1.0) * b)))
    return np.array([ratio(float(s), float(t)) for s, t in zip(corpus, target, strict=True)], np.int64)


def scored(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Buckets(len(gain))
        for batch in batches:
            rows = [(n, len(at), int(gain[at].sum())) for n, at in (_features(raw, memo, longest) for raw in _texts(batch))]
            words, features, weight = (pa.array([r[i] for r in rows], pa.int64()) for i in range(3))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), words, features, weight], ["doc_id", "n_words", "n_features", "weight"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = ids.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return found.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long"))


#: Ascending order of the total order: high scores first; rows that agree on all but ``at`` are alike.
ORDER = ["down", "tie", "n_features", "at"]


def sorted_runs(rows: DataFrame, take: str) -> DataFrame:
    """``rows`` written as sorted runs; ``at`` is the run (high bits) and the place in it, rows with ``take`` come first."""
    rows = rows.withColumns({"down": -F.col("score"), "tie": F.coalesce("doc_id", F.lit((1 << 63) - 1))})
    rows = rows.sortWithinPartitions(F.col(take).desc(), "down", "tie", "n_features")
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "resample-runs")


def splitters(runs: DataFrame, rows: int, parts: int) -> pd.DataFrame:
    """``parts`` - 1 rows that cut the runs into parts of about equal size.

    Rows at regular places of each run reach the driver: about ``OVER`` for each part, and one for
    each run, however many rows there are.
    """
    step = max(1, rows // (parts * OVER))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    samples = runs.where(place % step == 0).select(*ORDER).toPandas().sort_values(ORDER, ignore_index=True)
    chosen = np.unique(np.arange(1, parts) * len(samples) // parts)
    return samples.iloc[chosen].drop_duplicates() if len(samples) else samples


def _segments(runs: DataFrame, cuts: pd.DataFrame) -> DataFrame:
    """``runs`` with the part of each row: how many splitters are at or before it."""
    edges = [cuts[c].to_numpy(np.int64) for c in ORDER]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.concatenate([e, batch.column(c).to_numpy()]) for c, e in zip(ORDER, edges, strict=True)]
            order = np.lexsort(columns[::-1])  # stable: a splitter goes before the row it was taken from
            passed = np.cumsum(order < len(cuts))
            part = np.empty(len(order), np.int32)
            part[order] = passed
            yield batch.append_column("part", pa.array(part[len(cuts) :], pa.int32()))

    names = ["doc_id", "n_features", "weight", "score", "down", "tie", "at"]
    return runs.select(*names).mapInArrow(place, "doc_id long, n_features long, weight long, score long, down long, tie long, at long, part int")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10_000,
             longest: int = 1, seed: int = 2024, part_rows: int = 250_000) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs`` (doc_id, text).

    Of the rows with at least ``least_words`` words, floor(``percent`` %) of the highest scores are
    drawn and ranked from 1; ``rank`` is null for the others.  Null and empty texts have no features
    and weight 0.  Ties go to the smaller doc_id, null doc_ids last; rows repeated with one doc_id
    are drawn like different ones.  Other columns are not looked at.  An empty table gives none.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    rows = scored(docs, gain, longest, seed).withColumn("take", F.col("n_words") >= least_words)
    runs = sorted_runs(rows, "take")
    able = runs.where("take")
    n = able.count()
    draw = percent * n // 100
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / part_rows))
    placed = written(_segments(able, splitters(able, n, parts)), "resample-segments")
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):  # one entry per part
        before.append((p, total))
        total += sizes[p]
    reached = [b for b in before if b[1] < draw]
    prefix = docs.sparkSession.createDataFrame(reached, "part int, before long")
    last = max((p for p, _ in reached), default=-1)
    within = F.row_number().over(Window.partitionBy("part").orderBy(*ORDER))
    merged = placed.where(F.col("part") <= last).withColumn("within", within).join(F.broadcast(prefix), "part")  # prefix: a row per part
    rank = (F.col("before") + F.col("within")).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    return (merged.select(*out, F.when(rank <= draw, rank).alias("rank"))
            .unionAll(placed.where(F.col("part") > last).select(*out, undrawn))
            .unionAll(runs.where(~F.col("take")).select(*out, undrawn)))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: draw a tenth of the documents towards the words of the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 is not in the dialect: the table of 256 remainders is computed by its rule, then applied byte by byte.
SQL = r"""
WITH steps AS (
  SELECT k, list_reduce(list_concat([k], range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256))::BIGINT AS k)),
remainders AS (SELECT list(v ORDER BY k) AS t FROM steps),
lowered AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS (SELECT side, r, id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lowered),
bytes AS (SELECT w, list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS b FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words)),
bucketed AS (
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, remainders),
counts AS (SELECT bucket, sum((side = 'd')::INT)::DOUBLE AS s, sum((side = 'b')::INT)::DOUBLE AS t FROM words JOIN bucketed USING (w) GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS g FROM counts, totals),
weighed AS (
  SELECT r, count(*) AS n_features, sum(g)::BIGINT AS weight FROM words JOIN bucketed USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM lowered LEFT JOIN weighed USING (r) WHERE side = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""
