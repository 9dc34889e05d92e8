"""Packing token sequences into windows by non-negative least squares on the length histogram.

A document's full windows stand alone; what is left of it is its tail.  The histogram of tail
lengths (at most window - 1 counts, whatever the number of documents) is all the planning sees:

1. enumerate shallow combinations, up to four tails of at most two lengths, that fill a window;
2. solve min |A x - h| with x >= 0 for how often each combination repeats;
3. round x and keep what the histogram still has;
4. greedily pack the residual tails, longest first, cutting a tail where a window ends.

A document is then placed by its rank among the tails of its length: an arithmetic lookup, so no
sequence is ever built in one place and no length, however common, meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches, written
from tabforge.llm.tokens import byte_bpe, forget, vocabulary

DEPTH = 4
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
DIGESTS = PIECES.replace("ids binary", "ids_crc32 long")


def tokenised(docs: DataFrame, vocabulary_path: str, end_id: int, window: int) -> DataFrame:
    """One row per row of ``docs``, written to the shared folder.

    ``bucket`` and ``k`` (task, row within it) name the row; ``tail`` is what its full windows
    leave, ``j`` the row's place among equal tails of the bucket, ``full`` the bucket's full
    windows before it.  Ids are little-endian unsigned 16-bit integers if the vocabulary allows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, bucket = byte_bpe(vocabulary_path), TaskContext.get().partitionId()
        seen, k, full = np.zeros(window, np.int64), 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            ids = [x + end for x in bpe.encode_batch(list(b["text"]))]
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            tail = n % window
            j = np.zeros(len(n), np.int64)
            for i, t in enumerate(tail):
                j[i] = seen[t]
                seen[t] += 1
            before = full + np.concatenate([[0], np.cumsum(n // window)])
            yield pd.DataFrame({"bucket": bucket, "k": np.arange(k, k + len(n)), "doc_id": b["doc_id"].astype("Int64"), "n": n, "tail": tail, "j": j,
                                "full": before[:-1], "ids": [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]})
            k, full = k + len(n), before[-1]

    text_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(docs.mapInPandas(run, "bucket int, k long, doc_id long, n long, tail int, j long, full long, ids binary"), "packing-ids")


class Plan:
    """Where the r-th tail of each length goes."""

    def __init__(self, counts: dict[int, int], window: int):
        self.window = window
        have = np.zeros(window + 1, np.int64)
        for length, n in counts.items():
            have[length] = n
        a, m, b, w = _combinations(window)
        x = _nnls(a, m, b, w, have[:window].astype(float))
        runs, used, sequence = [], np.zeros(window + 1, np.int64), 0
        for p in np.argsort(-x, kind="stable"):
            la, ma, lb, mb = int(a[p]), int(m[p]), int(b[p]), int(w[p])
            times = int(min(round(x[p]), (have[la] - used[la]) // ma, (have[lb] - used[lb]) // mb if mb else have[la]))
            if times <= 0:
                continue
            runs.append((la, used[la], sequence, ma, 0))
            used[la] += times * ma
            if mb:
                runs.append((lb, used[lb], sequence, mb, ma * la))
                used[lb] += times * mb
            sequence += times
        self.windows = sequence  # filled by combinations
        rest = have - used
        rest[0] = 0
        tokens = rest * np.arange(window + 1)
        before = np.concatenate([np.cumsum(tokens[::-1])[::-1][1:], [0]])  # tokens of longer residual tails
        self.residual = -(-int(tokens.sum()) // window)  # windows filled by the residual tails
        # A run: length, first rank, first sequence, tails per sequence, offset of the first; residual runs have 0 tails per sequence.
        runs += [(length, used[length], before[length], 0, 0) for length in range(window + 1)]
        self.runs = np.array(sorted(runs), np.int64).reshape(-1, 5)
        self._keys = self.runs[:, 0] * (1 << 40) + self.runs[:, 1]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and tokens before a cut (the length if uncut) of each tail."""
        run = self.runs[np.searchsorted(self._keys, length * (1 << 40) + rank, side="right") - 1]
        nth, each = rank - run[:, 1], np.maximum(run[:, 3], 1)
        packed = run[:, 3] > 0
        at = run[:, 2] + nth * length  # a residual tail's place in the run of residual tokens
        sequence = np.where(packed, run[:, 2] + nth // each, self.windows + at // self.window)
        offset = np.where(packed, run[:, 4] + nth % each * length, at % self.window)
        return sequence, offset, np.minimum(length, self.window - offset)


def _combinations(window: int) -> tuple[np.ndarray, ...]:
    """Lengths and how many of each: m * a + w * b = window with a < b, or m * a alone (w = 0)."""
    found = [(window // m, m, window // m, 0) for m in range(2, DEPTH + 1) if window % m == 0]
    for m in range(1, DEPTH):
        for w in range(1, DEPTH + 1 - m):
            a = np.arange(1, window // m + 1)
            b, left = np.divmod(window - m * a, w)
            ok = (left == 0) & (b > 0) & (b < window) & ((a < b) | (a != b) & (m != w))
            found += [(x, m, y, w) for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True)]
    return tuple(np.array(v, np.int64) for v in zip(*dict.fromkeys(found), strict=True))


def _nnls(a: np.ndarray, m: np.ndarray, b: np.ndarray, w: np.ndarray, h: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Least squares with x >= 0 by accelerated projected gradient; A has m and w in rows a and b."""
    used = (h[a] > 0) & ((w == 0) | (h[b] > 0))  # others would need a length that does not occur
    aa, mm, bb, ww = a[used], m[used].astype(float), b[used], w[used].astype(float)
    x = np.zeros(len(a))
    if not used.any():
        return x
    product = lambda v: np.bincount(aa, mm * v, len(h)) + np.bincount(bb, ww * v, len(h))
    ones = product(np.ones(len(aa)))
    step = 1.0 / max(1e-9, float(np.max(mm * ones[aa] + ww * ones[bb])))  # no greater than 1 over the largest eigenvalue of A'A
    y = z = np.zeros(len(aa))
    t = 1.0
    for _ in range(rounds):
        gap = product(z) - h
        new = np.maximum(0.0, z - step * (mm * gap[aa] + ww * gap[bb]))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        z = new + (before - 1) / t * (new - y)
        y = new
    x[used] = y
    return x


def _crc32(ids: bytes) -> int:
    """Of 16-bit ids as unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes())


def pack(docs: DataFrame, vocabulary_path: str, end_id: int, window: int = 2048, digest: bool = False) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text; other columns ignored) with their ids, sequence and offset.

    With ``digest`` a piece has ``ids_crc32`` (of its ids as unsigned 32-bit integers) in place of
    the ids.  Null and empty texts are the end id alone.  Repeated rows and rows without doc_id are rows
    like any other.  An empty table gives no pieces.  ``ids`` holds unsigned 16-bit integers.
    """
    rows = tokenised(docs, vocabulary_path, end_id, window)
    counts = written(rows.groupBy("bucket", F.col("tail").alias("length")).agg(F.count(F.lit(1)).alias("n"))
                     .unionByName(rows.groupBy("bucket").agg(F.sum(F.floor(F.col("n") / window)).cast("long").alias("n")).select("bucket", F.lit(window).alias("length"), "n")), "packing-counts")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    plan = Plan({length: n for length, n in total.items() if 0 < length < window}, window)
    alone = plan.windows + plan.residual  # the first sequence of a full window
    order = Window.partitionBy("length").orderBy("bucket")
    before = counts.select("bucket", "length", (F.sum("n").over(order) - F.col("n")).alias("before"))
    light = rows.select("bucket", "k", "n", "tail", "j", "full")
    light = light.join(before.withColumnRenamed("length", "tail").withColumnRenamed("before", "tails_before"), ["bucket", "tail"])
    light = light.join(before.where(F.col("length") == window).select("bucket", F.col("before").alias("full_before")), "bucket")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tail = b["tail"].to_numpy(np.int64)
            sequence, offset, first = plan.place(tail, (b["tails_before"] + b["j"]).to_numpy(np.int64))
            yield pd.DataFrame({"bucket": b["bucket"], "k": b["k"], "alone": alone + b["full_before"] + b["full"], "sequence": sequence, "offset": offset, "first": first})

    placed = light.mapInPandas(place, "bucket int, k long, alone long, sequence long, offset long, first long")

    shown, schema = ("ids_crc32", DIGESTS) if digest else ("ids", PIECES)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for b in batches:
            out = []
            for doc, n, alone_, sequence, offset, first, ids in zip(b["doc_id"], b["n"], b["alone"], b["sequence"], b["offset"], b["first"], b["ids"], strict=True):
                full = n // window
                parts = [(i * window, window, alone_ + i, 0) for i in range(full)]
                if left := n - full * window:
                    parts.append((full * window, first, sequence, offset))
                    if left > first:
                        parts.append((full * window + first, left - first, sequence + 1, 0))
                pieces = [(ids[2 * s : 2 * (s + size)], s, size, seq, o) for s, size, seq, o in parts]
                out += [(doc, s, size, _crc32(x) if digest else x, n, seq, o) for x, s, size, seq, o in pieces]
            got = pd.DataFrame(out, columns=["doc_id", "start", "length", shown, "doc_tokens", "sequence_id", "offset"])
            yield got.astype({"doc_id": "Int64"})

    return rows.select("bucket", "k", "doc_id", "n", "ids").join(placed, ["bucket", "k"]).mapInPandas(cut, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all documents, each ended by id 1, in sequences of 2048."""
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 1, 2048, digest=True)
