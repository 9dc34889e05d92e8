"""Sharding by minimax contiguous partition, in DataFrame operations only.

Rows are ordered by the hash of their text, so equal texts are neighbours and form one atomic
group.  The ordered groups are cut into at most ``shards`` runs so that the largest run is as
small as it can be: a binary search over the capacity, each capacity checked greedily (fill a
run up to the capacity, start the next).

The search never needs all groups at once.  Hash space is split into cells with their sizes;
treating a cell as divisible gives a capacity no smaller one can beat, treating it as one piece
gives one that suffices.  Only cells in which a cut may fall between those two are split again,
until every such cell is a single group.  What reaches the driver is a few thousand cell sums
per round, whatever the number of rows.

Where one group sets the capacity it has a run to itself in any such partition.  It is then set
apart, and what lies between groups set apart is partitioned again with the shards left, so one
heavy group does not leave the other shards uneven.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, written

FIRST_BITS, NEXT_BITS = 12, 6


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, key``: size is the text's UTF-8 bytes (null: none) plus 8.

    The key is XXH64 of the text, the same for equal texts; null texts are one group of their own.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.xxhash64("text").alias("key"))


Cell = tuple[int, int, int, bool]  # first and last key, size, whether it is a single group


def _greedy(cells: list[Cell], capacity: int, divisible: bool, alone: frozenset[int] = frozenset()) -> list[int]:
    """Index of the cell in which each run ends (its last cell, or the one it cuts).

    A cell of a single group is never cut, and one whose key is in ``alone`` is a run by itself.
    With ``divisible`` any other cell may be cut anywhere, else cells stay whole; a cell larger
    than the capacity then ends the check.
    """
    ends, room, closed = [], capacity, False
    for i, (key, _, size, atomic) in enumerate(cells):
        if atomic and key in alone:
            if i:
                ends.append(i - 1)
            closed = True
            continue
        if closed:
            ends.append(i - 1)
            room, closed = capacity, False
        if size <= room:
            room -= size
            continue
        if divisible and not atomic:
            size -= room
            ends.append(i)
            while size > capacity:
                size -= capacity
                ends.append(i)
            room = capacity - size
        else:
            ends.append(i - 1)
            room = capacity - size
            if room < 0:
                return [len(cells)] * (len(cells) + 1)
    return ends


def _smallest(cells: list[Cell], shards: int, divisible: bool, alone: frozenset[int] = frozenset()) -> int:
    """The least capacity for which the greedy check needs no more than ``shards`` runs."""
    cells_left = [c for c in cells if not (c[3] and c[0] in alone)]
    total = sum(c[2] for c in cells_left)
    low, high = -(-total // max(1, shards - len(alone))), total
    low = max([low, *(c[2] for c in cells_left if c[3] or not divisible)])
    while low < high:
        mid = (low + high) // 2
        if len(_greedy(cells, mid, divisible, alone)) < shards:
            high = mid
        else:
            low = mid + 1
    return low


def cuts(items: DataFrame, shards: int) -> list[int]:
    """The last key of every shard but the last; shard s holds keys above cut s-1 up to cut s."""
    spread = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-(1 << 63))), 64 - FIRST_BITS)  # keeps signed order
    cells = items.groupBy(spread.alias("c")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("size").alias("size")).collect()
    return _partition(items, sorted((r["lo"], r["hi"], r["size"], r["lo"] == r["hi"]) for r in cells), shards)


def _partition(items: DataFrame, cells: list[Cell], shards: int) -> list[int]:
    """``cuts`` of the rows in ``cells``; with groups set apart, the shards of a stretch between two are chosen by cell sizes."""
    alone: frozenset[int] = frozenset()
    while True:
        rest = sum(c[2] for c in cells if not (c[3] and c[0] in alone))
        # Cells large beside a shard first: they may hide a heavy group, which makes the range of every cut wide.
        chosen = [i for i, c in enumerate(cells) if not c[3] and 4 * c[2] * max(1, shards - len(alone)) > rest]
        if not chosen:
            most = _smallest(cells, shards, False, alone)
            heavy = {c[0] for c in cells if c[3] and c[2] == most and c[0] not in alone}
            if heavy:  # no capacity is less than a group, so this is the least
                alone |= heavy
                continue
            if alone:
                break
            least = _smallest(cells, shards, True)
            # With a greater capacity every cut moves up, and a divisible cell lets it move furthest.
            low, last = _earliest(cells, least), _greedy(cells, most, True)
            open_cells = set()
            for s in range(shards - 1):
                a = low[s] if s < len(low) else len(cells) - 1
                b = last[s] if s < len(last) else len(cells) - 1
                open_cells.update(i for i in range(max(0, a), min(b, len(cells) - 1) + 1) if not cells[i][3])
            if not open_cells:
                break
            chosen = sorted(open_cells)
        cells = _split(items, cells, chosen)
    ends = _greedy(cells, most, False, alone)
    if not alone:
        return [cells[i][1] for i in ends]
    # Runs of cells between groups set apart, each with the shards it needs, then those left to the fullest.
    pieces: list[list[Cell]] = [[]]
    for c in cells:
        if c[3] and c[0] in alone:
            pieces += [[c], []]
        else:
            pieces[-1].append(c)
    pieces = [p for p in pieces if p]
    mixed = [p for p in pieces if not (p[0][3] and p[0][0] in alone)]
    share = [len(_greedy(p, most, False)) + 1 for p in mixed]
    for _ in range(shards - len(alone) - sum(share) if mixed else 0):
        fullest = max(range(len(mixed)), key=lambda k: sum(c[2] for c in mixed[k]) / share[k])
        share[fullest] += 1
    runs, at = [], iter(share)
    for p in pieces:
        if not (p[0][3] and p[0][0] in alone):
            runs += _partition(items, p, next(at))
        runs.append(p[-1][1])
    return runs[:-1]


def _earliest(cells: list[Cell], capacity: int) -> list[int]:
    """Earliest cell in which each cut can fall: whole cells only, one larger than the capacity is passed over as a run."""
    ends, room = [], capacity
    for i, (_, _, size, _) in enumerate(cells):
        if size <= room:
            room -= size
        else:
            ends.append(i - 1)
            room = max(0, capacity - size)
    return ends


def _split(items: DataFrame, cells: list[Cell], chosen: list[int]) -> list[Cell]:
    """``cells`` with the chosen ones split into parts of equal key range."""
    lows, highs = [cells[i][0] for i in chosen], [cells[i][1] for i in chosen]
    steps = [max(1, -(-(b - a + 1) // (1 << NEXT_BITS))) for a, b in zip(lows, highs, strict=True)]
    longs = lambda v: F.array(*(F.lit(x).cast("long") for x in v))
    at = _place(F.col("key"), lows)
    inside = items.withColumn("i", at).where((F.col("i") >= 1) & (F.col("key") <= F.element_at(longs(highs), F.greatest(F.col("i"), F.lit(1)))))
    # The distance from the cell's start may pass the range of a long: as decimal.
    gap = F.col("key").cast("decimal(20,0)") - F.element_at(longs(lows), F.col("i")).cast("decimal(20,0)")
    part = F.floor(gap / F.element_at(F.array(*(F.lit(str(s)).cast("decimal(20,0)") for s in steps)), F.col("i")))
    got = inside.groupBy("i", part.alias("p")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("size").alias("size")).collect()
    kept = [c for j, c in enumerate(cells) if j not in set(chosen)]
    return sorted([*kept, *((r["lo"], r["hi"], r["size"], r["lo"] == r["hi"]) for r in got)])


def _place(key, starts: list[int]):
    """How many of the ascending ``starts`` are at or below the key, by binary search in nested conditions."""
    def search(a: int, b: int):
        if a == b:
            return F.lit(a)
        mid = (a + b) // 2
        return F.when(key >= F.lit(starts[mid]).cast("long"), search(mid + 1, b)).otherwise(search(a, mid))

    return search(0, len(starts))


def shard(docs: DataFrame, shards: int = 24, slot_rows: int = 20_000) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs`` (doc_id, text; others ignored).

    Shards are 0 to ``shards`` - 1 in key order; a shard may be empty if groups are fewer or too
    large to fill the others.  ``slot`` numbers a shard's rows from 0 without gaps: rows are dealt by
    the hash of doc_id into parts of about ``slot_rows``, numbered within a part and shifted by
    the rows of the parts before, so no shard is ranked in one task however many copies it holds.
    Null doc_ids and repeated rows are rows like any other.
    """
    items = written(sized(docs), "sharding")
    rows = items.count()
    ends = cuts(items, shards)
    placed = items.withColumn("shard", _place(F.col("key"), [e + 1 for e in ends]).cast("int"))
    parts = max(8, math.ceil(rows / shards / slot_rows))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(parts)).cast("int"))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    ranked = placed.withColumn("r", F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id")))
    return ranked.join(before, ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("r") - 1).cast("long").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all documents into shards 0 to 23 of nearly equal size; equal texts stay together."""
    found = shard(table(spark, sf_dir, "documents"), 24)
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))
