"""Maximal periodic runs in the word sequences of texts, by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are identical), at least ``least``
words and three periods long, that cannot be extended.

Suffixes of a batch of texts are sorted by prefix doubling.  After round k the suffixes that share
their first 2^k words are an interval of the order, so every dyadic block (aligned, 2^k words) has
its interval in the suffix array for free.  A wavelet matrix over the suffix array then answers
range successor queries: the next occurrence of a block at or after a place.

* For a block of b words and a period q of b to 2b - 1, a run of three periods holds an aligned
  block together with its copy q words on.  So the occurrences that start b to 2b - 1 words after
  each block are looked up.  They lie in a window shorter than two blocks and so form one arithmetic
  progression: one or two are candidate periods themselves; of three or more, whose difference r
  is the block's own period, only those two can be a period that line up the left or the right
  ends of the stretches of period r around the block and around the occurrences.
* Periods below the smallest block are the distance from a block to its next occurrence; ``least``
  words are enough for such a block.

Candidates are confirmed by extending the match both ways; equal stretches keep the least period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import table

#: Words worked on together; a longer text is a batch by itself.
AT_ONCE = 200_000


class Wavelet:
    """A wavelet matrix over distinct numbers below ``2 ** bits``: counts and range successors, many at a time."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length()) if self.n else 1
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64)]))
            self.zeros.append(int(self.n - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        """Ones before each place of a level."""
        word, inside = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at places ``low`` to ``high`` - 1 are less than ``bound``."""
        total = np.where(bound >= 1 << self.bits, high - low, 0)
        low, high = np.where(bound >= 1 << self.bits, 0, low), np.where(bound >= 1 << self.bits, 0, high)
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            one = (bound >> (self.bits - 1 - level) & 1).astype(bool)
            total += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, self.zeros[level] + a, low - a), np.where(one, self.zeros[level] + b, high - b)
        return total

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The value of rank ``n`` (from 0) among places ``low`` to ``high`` - 1, which must hold it."""
        value = np.zeros(len(low), np.int64)
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            zeros = (high - b) - (low - a)
            one = n >= zeros
            n = np.where(one, n - zeros, n)
            value = value << 1 | one
            low, high = np.where(one, self.zeros[level] + a, low - a), np.where(one, self.zeros[level] + b, high - b)
        return value


def _sorted_suffixes(names: np.ndarray, longest: int, first: int) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Suffixes by their first words, up to blocks of ``longest`` words, and per level the intervals of its aligned blocks.

    ``names`` are dense from 0 and ascending by text, so no name is shared by two texts.  Level k
    lists, for the blocks at multiples of 2^k, where their interval starts and ends.  Only
    suffixes that still share an interval are sorted again.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.searchsorted(names[order], names).astype(np.int64)  # first place of the interval
    blocks, size = {}, 1
    level = 0
    while True:
        if level >= first:
            starts = np.arange(0, n - size + 1, size)
            ends = np.bincount(rank, minlength=n)
            blocks[level] = (rank[starts], rank[starts] + ends[rank[starts]])
        if size * 2 > longest:
            return order, blocks
        shared = np.flatnonzero(np.bincount(rank, minlength=n)[rank[order]] > 1)  # places of suffixes not yet alone
        if len(shared):
            who = order[shared]
            after = np.full(len(who), -1, np.int64)
            inside = who + size < n
            after[inside] = rank[who[inside] + size]
            key = rank[who] * (n + 1) + after + 1
            by = np.argsort(key, kind="stable")
            who, key = who[by], key[by]
            order[shared] = who
            new = np.concatenate([[True], key[1:] != key[:-1]])
            rank[who] = shared[np.flatnonzero(new)][np.cumsum(new) - 1]
        size, level = size * 2, level + 1


def _alike(names: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words agree going from (i, j) by ``step``, i before j, up to ``most`` words or an end."""
    room = np.minimum(most, len(names) - j if step > 0 else i + 1)
    room = np.maximum(room, 0)
    found = np.zeros(len(i), np.int64)
    open_ = np.flatnonzero(room > 0)
    width = 16
    while len(open_):
        kept = []
        for at in range(0, len(open_), max(1, (1 << 20) // width)):
            part = open_[at : at + max(1, (1 << 20) // width)]
            span = np.arange(width)
            ahead = found[part, None] + span
            fits = ahead < room[part, None]
            a = np.where(fits, i[part, None] + step * ahead, 0)
            b = np.where(fits, j[part, None] + step * ahead, 0)
            same = fits & (names[a] == names[b])
            run = np.where(same.all(1), width, same.argmin(1))
            found[part] += run
            kept.append(part[(run == width) & (found[part] < room[part])])
        open_, width = np.concatenate(kept), min(width * 4, 4096)
    return found


def _candidates(names: np.ndarray, limit: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, period, block) for which the block at the place agrees with the one a period later.

    ``limit`` is the end of the text that a place lies in.
    """
    first = max(0, (max(least, 2) // 3).bit_length() - 1)  # the largest block b with 3b <= least
    longest = max(1 << first, int(np.diff(np.unique(limit), prepend=0).max()) // 3)
    order, blocks = _sorted_suffixes(names, longest, first)
    tree = Wavelet(order.astype(np.int64))
    out = []
    for level, (low, high) in blocks.items():
        b = 1 << level
        p = np.arange(len(low), dtype=np.int64) * b
        use = (high - low > 1) & (p + b <= limit[p])
        p, low, high = p[use], low[use], high[use]
        if not len(p):
            continue
        if level == first:  # periods of 1 to b: the next occurrence
            k = tree.below(low, high, p + 1)
            more = k < high - low
            nxt = tree.nth(low[more], high[more], k[more])
            near = nxt - p[more] <= b
            out.append((p[more][near], nxt[near] - p[more][near], np.full(near.sum(), b)))
        start, end = tree.below(low, high, p + b), tree.below(low, high, p + 2 * b)
        many = end - start
        some = many > 0
        p, low, high, start, many = p[some], low[some], high[some], start[some], many[some]
        if not len(p):
            continue
        f = tree.nth(low, high, start)
        few = many <= 2
        out.append((p[few], f[few] - p[few], np.full(few.sum(), b)))
        two = many == 2
        second = tree.nth(low[two], high[two], start[two] + 1)
        out.append((p[two], second - p[two], np.full(two.sum(), b)))
        lots = many > 2
        if lots.any():
            p, low, high, start, many, f = (x[lots] for x in (p, low, high, start, many, f))
            r = tree.nth(low, high, start + 1) - f
            last = f + (many - 1) * r
            most = np.full(len(p), 5 * b)
            # Ends of the stretches of period r: how far words agree r apart, right and left of both places.
            right_p, right_f = p + r + _alike(names, p, p + r, most, 1), f + r + _alike(names, f, f + r, most, 1)
            left_p, left_f = p - _alike(names, p - 1, p - 1 + r, most, -1), f - _alike(names, f - 1, f - 1 + r, most, -1)
            for d in (right_f - right_p, left_f - left_p):
                ok = (p + d >= f) & (p + d <= last) & ((p + d - f) % r == 0)
                out.append((p[ok], d[ok], np.full(ok.sum(), b)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))


def runs(texts: list[list[bytes]], least: int = 24) -> list[list[tuple[int, int, int]]]:
    """Per word list its runs (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if sizes.sum() < least:
        return out
    names = np.zeros(int(sizes.sum()), np.int64)
    at = used = 0
    for words in texts:  # names ascend by text
        known: dict[bytes, int] = {}
        names[at : at + len(words)] = [known.setdefault(w, used + len(known)) for w in words]
        at, used = at + len(words), used + len(known)
    ends = np.cumsum(sizes)
    limit = np.repeat(ends, sizes)
    p, d, b = _candidates(names, limit, least)
    if not len(p):
        return out
    # Blocks that follow one another with one period lie in one stretch: extend each chain once.
    by = np.lexsort((p, b, d))
    p, d, b = p[by], d[by], b[by]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (b[1:] != b[:-1]) | (p[1:] > p[:-1] + b[1:])])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(p)]]) - 1
    d, b, far = d[head], b[head], p[tail]
    p = p[head]
    whole = np.full(len(p), len(names))
    right = far + d + _alike(names, far, far + d, whole, 1)
    left = p - _alike(names, p - 1, p - 1 + d, whole, -1)
    long = right - left >= np.maximum(least, 3 * d)
    found: dict[tuple[int, int], int] = {}
    for s, e, q in zip(left[long].tolist(), right[long].tolist(), d[long].tolist(), strict=True):
        found[s, e] = min(q, found.get((s, e), q))
    begins = ends - sizes
    for (s, e), q in found.items():
        t = int(np.searchsorted(ends, s, "right"))
        out[t].append((s - int(begins[t]), e - s, q))
    for found_in in out:
        found_in.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains past its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for s, length, q in found:
        depth[s + q] += 1
        depth[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


COLUMNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, least: int = 24) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs`` (doc_id, text).

    Words are stretches without space, tab, line feed, vertical tab, form feed and carriage return;
    ``runs`` is ordered by start, then period, and ``collapsed`` holds the words left when every run
    is cut to its first period.  Null and empty texts have no words, no runs and an empty
    ``collapsed``.  Rows are independent, so repeated rows and null doc_ids are rows like any other,
    and other columns are not looked at.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws, part, size, begin = batch.column("doc_id"), batch.column("text").cast(pa.binary()), [], 0, 0
            for i in range(len(raws)):
                part.append((raws[i].as_py() or b"").split())
                size += len(part[-1])
                if size >= AT_ONCE or i + 1 == len(raws):
                    found = runs(part, least)
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(begin, len(part)), pa.array([len(w) for w in part], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found], pa.list_(KIND)),
                        pa.array([b" ".join(collapse(w, f)).decode() for w, f in zip(part, found, strict=True)], pa.string()),
                    ], ["doc_id", "n_words", "runs", "collapsed"])
                    part, size, begin = [], 0, i + 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, COLUMNS)


KIND = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which every tenth document by the CRC-32 of its id repeats a stretch of its own words to its end.

    Null doc_ids have no CRC-32: such rows are left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    n, g = F.size("_words"), F.floor(h / 10)
    picked = docs.select("doc_id", "text", F.when((h % 10 == 0) & F.col("text").isNotNull(), words).alias("_words"))
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    period = (F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))) + 1).cast("int")
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at("_words", F.when(i < a, i).otherwise(a + (i - a) % period).cast("int") + 1))
    return picked.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: runs of every document, every tenth of which is made to repeat itself; the strongest run by exact length / period."""
    better = "CASE WHEN m IS NULL OR r.length * m.period > m.length * r.period THEN r ELSE m END"  # runs come by start, then period
    best = F.expr(f"aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (m, r) -> {better})")
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "")
    found = periodic_runs(looped(table(spark, sf_dir, "documents"))).withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
