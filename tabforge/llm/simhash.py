"""SimHash near-duplicate groups with pigeonring candidate filtering.

A document's fingerprint has bit b set if over half of its shingles' XXH64 values have it.
Documents are linked when fingerprints differ in at most ``max_distance`` bits, and groups are
the connected components.  The work runs on *distinct* fingerprints, so a group of exact copies
is one row however large it is.

Candidates: the 64 bits form a ring of m = max_distance + 1 segments.  If two fingerprints
differ in at most d bits in all, then from some segment on every chain of l consecutive segments
holds at most l * d / m differences (the pigeonring principle).  So the first segment agrees, the
first two differ in at most one bit, and one half of the second agrees as well: (start segment,
its bits, one half of the next) is the join key, every chain's budget is checked on the joined
pair, and only what passes gets the full Hamming check.

A key shared by very many distinct fingerprints is not paired.  Its fingerprints are linked
through *midpoints*: two fingerprints differ in at most two bits exactly if some 64-bit word
lies within one bit of both, so 65 words per fingerprint, grouped by word, give the same links
with at most 65 fingerprints in a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches, written

SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of a whole text; 0 for null or no words.

    A-Z are lower-cased, words are runs other than space and U+0009-U+000D; a text of fewer words
    than a shingle has its whole word sequence as the only shingle.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: both touch ASCII only
    if not words:
        return 0
    digest, n = xxhash.xxh64_intdigest, shingle_words
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False)) if len(words) >= n else [b" ".join(words)]
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long, and the long columns to ``carry``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fp": fps, **{c: b[c] for c in carry}})

    text_batches(docs.sparkSession)
    schema = ", ".join(["doc_id long, fp long", *(f"{c} long" for c in carry)])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry).mapInPandas(run, schema)


def ring(max_distance: int) -> list[tuple[int, int]]:
    """(offset, width) of the ring's segments."""
    m = max_distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _bits(fp: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def _keyed(fps: DataFrame, max_distance: int) -> DataFrame:
    """(fp, start, key): two keys per start segment, one for each half of the segment after it."""
    segments, m, fp = ring(max_distance), max_distance + 1, F.col("fp")
    keys = []
    for i, (at, width) in enumerate(segments):
        after, wide = segments[(i + 1) % m]
        half = wide // 2
        for j, (a, w) in enumerate(((after, half), (after + half, wide - half))):
            keys.append(F.struct(F.lit(i).alias("start"), F.lit(2 * i + j).alias("part"), _bits(fp, at, width).alias("seg"), _bits(fp, a, w).alias("half")))
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")


def _chains(x: Column, start: Column, max_distance: int) -> Column:
    """Every chain from the start segment stays within its share of the distance."""
    segments, m = ring(max_distance), max_distance + 1
    ok = F.lit(False)
    for i in range(m):
        total, within = F.lit(0), F.lit(True)
        for length in range(1, m + 1):
            at, width = segments[(i + length - 1) % m]
            total = total + F.bit_count(_bits(x, at, width))
            within = within & (total <= length * max_distance // m)
        ok = ok | ((start == i) & within)
    return ok


def links(fps: DataFrame, max_distance: int = 2, pair_limit: int = 64) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs within ``max_distance`` bits.

    ``fps`` holds distinct fingerprints.  Keys of up to ``pair_limit`` fingerprints are paired and
    filtered; fingerprints of any larger key are linked through midpoints, which loses no link.
    """
    if max_distance not in (1, 2):
        raise ValueError("max_distance must be 1 or 2")
    key = ["part", "seg", "half"]
    keyed = _keyed(fps, max_distance)
    hot = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > pair_limit).drop("n")
    hot = written(hot, "simhash-hot")
    rest = keyed.join(hot, key, "left_anti")
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        rest.withColumnRenamed("fp", "a").join(rest.withColumnRenamed("fp", "b").drop("start"), key)
        .where(F.col("a") < F.col("b"))
        .where(_chains(x, F.col("start"), max_distance))
        .where(F.bit_count(x) <= max_distance)
        .select("a", "b")
    )
    fp, bit = F.col("fp"), F.col("bit")
    one = F.expr("shiftleft(1L, bit)")
    if max_distance == 2:  # words within one bit
        word = F.struct(F.lit(0).alias("at"), F.when(bit < BITS, fp.bitwiseXOR(one)).otherwise(fp).alias("w"))
        spots = BITS
    else:  # fingerprints equal but for one named bit
        word, spots = F.struct(bit.alias("at"), fp.bitwiseAND(F.bitwise_not(one)).alias("w")), BITS - 1
    many = keyed.join(hot, key, "left_semi").select("fp").distinct()
    words = many.select("fp", F.explode(F.sequence(F.lit(0), F.lit(spots))).alias("bit")).select("fp", word.alias("p"))
    near = words.groupBy("p").agg(F.collect_set("fp").alias("f")).where(F.size("f") > 1)  # 65 at most
    stars = near.select(F.array_min("f").alias("a"), F.explode("f").alias("b")).where(F.col("a") < F.col("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: every node of an edge with the smallest node of its component.

    Alternating large-star and small-star steps; each round's edges are written to the shared
    folder, so lineage stays short and the number of rounds is logarithmic.
    """
    edges = written(edges, "components")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), F.col("b")).where(F.col("a") != F.col("b")).distinct()
        # every edge now runs from a smaller node a to a larger node b
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(down, "b")
        small = joined.select(F.col("m").alias("a"), "b").unionByName(joined.select(F.col("m").alias("a"), F.col("a").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        after = written(small, "components")
        if sum_of(after) == sum_of(edges):
            return after.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(after.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        edges = after


def sum_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``docs`` (columns doc_id and text; others ignored).

    Documents without words (null, empty, white space) have fingerprint 0 and are linked like any
    other.  Repeated rows stay repeated rows.  A row without doc_id gets its group's smallest
    doc_id, null if the group has none.
    """
    found = _grouped(fingerprints(docs, shingle_words), max_distance)
    return found.select("doc_id", "fp", "component_id")


def _grouped(prints: DataFrame, max_distance: int) -> DataFrame:
    """The rows with ``root``, one fingerprint that stands for the group, and ``component_id``."""
    docs = written(prints, "simhash-docs")
    fps = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(links(fps.select("fp"), max_distance))
    named = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(groups, "root").select("fp", "root", "component_id")
    return docs.join(named, "fp")


def deduplicated(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of every group of near copies, with all columns of ``docs`` (doc_id, text and any others).

    The row with the smallest doc_id stays, of several rows with that doc_id in one group the one
    with the smallest hash of its columns; rows with one doc_id in different groups do not touch
    each other.  A row without doc_id comes after those with one.  Texts without words are one group.
    """
    own = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), "__tag": F.xxhash64(*docs.columns)})
    found = _grouped(fingerprints(own.select(F.col("__id").alias("doc_id"), "text", "__tag"), shingle_words, ("__tag",)), max_distance)
    least = found.groupBy("root").agg(F.min(F.struct("doc_id", "__tag")).alias("m"))
    least = written(least.select(F.col("m.doc_id").alias("__id"), F.col("m.__tag").alias("__tag")), "simhash-least")
    kept = own.join(least, ["__id", "__tag"], "left_semi")
    if kept.select("__id", "__tag").groupBy("__id", "__tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return kept.select(*docs.columns)
    return kept.dropDuplicates(["__id", "__tag"]).select(*docs.columns)   # repeated rows: any of them


def query(spark, sf_dir: str) -> DataFrame:
    """op10: fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
