"""Exact quantiles of columns and groups of any size, without a value map per group.

A bounded sketch (``percentile_approx``) first brackets the wanted rank: its rank error is at most
rows / accuracy, so the true value lies between the sketch's values a little below and a little
above.  Then the rows below the bracket are counted and only the values inside it are counted one
by one; the wanted rank is found among them.  If a bracket still holds more than ``most`` different
values, the rows inside it are sketched again, so every round leaves a small share of the last
one.  Hot values cost one row per task (partial aggregation).

Positions and interpolation are those of ``percentile``: position p * (n - 1) among the non-null
values, linear between its two neighbours.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabforge.operators.lookup import checked_broadcast
from tabforge.session import cut_lineage

#: Accuracy of the sketch: it keeps a few times as many values per group.
ACCURACY = 1000
#: Different values of a bracket at most, before it is narrowed again.
MOST = 50_000


def _order(x: float) -> tuple[bool, float]:
    """NaN counts as the greatest value."""
    return (math.isnan(x), 0.0 if math.isnan(x) else x)


def _between(x: Column, lo: float, hi: float) -> Column:
    return (x >= F.lit(lo)) & (x <= F.lit(hi))


def _sketched(df: DataFrame, wanted: dict[int, tuple[Column, list[float]]], accuracy: int) -> dict[int, list[float]]:
    """Per key the approximate quantiles of its column, all in one aggregate."""
    if not wanted:
        return {}
    row = df.agg(*[F.percentile_approx(x, [min(1.0, max(0.0, p)) for p in ps], accuracy).alias(f"t{i}") for i, (x, ps) in wanted.items()]).first()
    return {i: row[f"t{i}"] for i in wanted}


def _two_valued(df: DataFrame, cols: list[str]) -> dict[str, tuple[int, int, int, int]]:
    """Of the whole-number columns those with at most two neighbouring values: (rows, least, greatest, rows of the greatest)."""
    whole = [c for c in cols if isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType))]
    if not whole:
        return {}
    ends = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(whole) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max), ("s", F.sum))]).first()
    told = {c: (ends[f"n{i}"], ends[f"lo{i}"], ends[f"hi{i}"], ends[f"s{i}"]) for i, c in enumerate(whole)}
    return {c: (n, lo, hi, s - n * lo) for c, (n, lo, hi, s) in told.items() if n and hi - lo <= 1}


def quantiles(df: DataFrame, cols, probs, accuracy: int = ACCURACY, most: int = MOST, lower: bool = False) -> dict[str, list[float | None]]:
    """Exact quantiles ``probs`` of every column over all rows; null where a column has no value.

    Two or three passes, each one aggregate over all columns at once.  What reaches the driver is
    a few numbers per column and the counts of at most ``most`` values per bracket.  Flags (whole
    numbers of two neighbouring values) are told from their sums, without a sketch.  With ``lower``
    a position between two values takes the lower one.
    """
    cols, probs = list(cols), list(probs)
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in cols}
    if not cols or not probs:
        return out
    place_of = (lambda p, n: float(math.floor(p * (n - 1)))) if lower else (lambda p, n: p * (n - 1))
    flags = _two_valued(df, cols)
    for c, (n, lo, hi, at_top) in flags.items():
        counted = [(float(lo), n - at_top), (float(hi), at_top)] if hi > lo else [(float(lo), n)]
        out[c] = [_pick(counted, 0, place_of(p, n)) for p in probs]
    cols = [c for c in cols if c not in flags]
    if not cols:
        return out
    df = df.select(*[F.col(c).cast("double").alias(f"c{j}") for j, c in enumerate(cols)])
    eps = 2.0 / accuracy
    first = df.agg(*[F.count(f"c{j}").alias(f"n{j}") for j in range(len(cols))],
                   *[F.percentile_approx(f"c{j}", [min(1.0, max(0.0, p + s * eps)) for p in probs for s in (-1, 1)], accuracy).alias(f"q{j}")
                     for j in range(len(cols))]).first()
    open_ = {}
    for j, c in enumerate(cols):
        n = first[f"n{j}"]
        for i, p in enumerate(probs):
            if n:
                place, lo, hi = place_of(p, n), first[f"q{j}"][2 * i], first[f"q{j}"][2 * i + 1]
                if lo == hi:   # one value at both ranks: nothing to count
                    out[c][i] = lo + 0.0
                    continue
                open_[len(probs) * j + i] = {"x": F.col(f"c{j}"), "c": c, "i": i, "place": place, "lo": lo, "hi": hi}
    while open_:
        # the rows below each bracket, and the counts of the values in it
        below = df.agg(*[F.count_if(t["x"] < F.lit(t["lo"])).alias(f"t{k}") for k, t in open_.items()]).first()
        inside = F.array_compact(F.array(*[F.when(_between(t["x"], t["lo"], t["hi"]), F.struct(F.lit(k).alias("t"), t["x"].alias("v"))) for k, t in open_.items()]))
        counts = df.select(F.explode(inside).alias("s")).groupBy("s.t", "s.v").agg(F.count(F.lit(1)).alias("n"))
        rows = counts.limit(most * len(open_) + 1).collect()
        if len(rows) <= most * len(open_):
            found: dict[int, list[tuple[float, int]]] = {}
            for r in rows:
                found.setdefault(r["t"], []).append((r["v"], r["n"]))
            for k, t in open_.items():
                out[t["c"]][t["i"]] = _pick(sorted(found[k], key=lambda s: _order(s[0])), below[f"t{k}"], t["place"])
            break
        open_ = _narrowed(df, open_, {k: below[f"t{k}"] for k in open_}, eps, accuracy)
    return out


def _pick(values: list[tuple[float, int]], below: int, place: float) -> float:
    """The value at a position, between the values of the two ranks beside it."""
    low, high = math.floor(place), math.ceil(place)
    at: dict[int, float] = {}
    total = below
    for v, n in values:
        for rank in (low, high):
            if total <= rank < total + n:
                at[rank] = v
        total += n
    a, b = at[low], at[high]
    return a if low == high or a == b else (high - place) * a + (place - low) * b


def _narrowed(df: DataFrame, open_: dict[int, dict], below: dict[int, int], eps: float, accuracy: int) -> dict[int, dict]:
    """Smaller brackets around the same positions, from a sketch of the rows inside each; halved where that is no help."""
    sizes = df.agg(*[F.count_if(_between(t["x"], t["lo"], t["hi"])).alias(f"t{k}") for k, t in open_.items()]).first()
    wanted = {}
    for k, t in open_.items():
        share = [(math.floor(t["place"]) - below[k]) / sizes[f"t{k}"] - eps, (math.ceil(t["place"]) + 1 - below[k]) / sizes[f"t{k}"] + eps]
        wanted[k] = (F.when(_between(t["x"], t["lo"], t["hi"]), t["x"]), share)
    new = _sketched(df, wanted, accuracy)
    same = {k: t for k, t in open_.items() if new[k] == [t["lo"], t["hi"]] and t["lo"] < t["hi"]}
    if same:
        mid = {k: t["lo"] / 2 + t["hi"] / 2 for k, t in same.items()}
        upto = df.agg(*[F.count_if(t["x"] <= F.lit(mid[k])).alias(f"t{k}") for k, t in same.items()]).first()
        for k, t in same.items():
            if math.ceil(t["place"]) < upto[f"t{k}"]:
                new[k][1] = mid[k]
            elif math.floor(t["place"]) >= upto[f"t{k}"]:
                new[k][0] = math.nextafter(mid[k], math.inf)
            else:  # the two ranks lie on both sides: the values next to the middle
                got = df.agg(F.max(F.when(t["x"] <= F.lit(mid[k]), t["x"])).alias("a"), F.min(F.when(t["x"] > F.lit(mid[k]), t["x"])).alias("b")).first()
                new[k] = [got["a"], got["b"]]
    return {k: t | {"lo": new[k][0], "hi": new[k][1]} for k, t in open_.items()}


def group_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float], accuracy: int = ACCURACY, most: int = MOST) -> DataFrame:
    """Exact quantiles of ``value`` per group: ``keys`` and a column for each of ``probs``.

    Null keys are groups; a group without values gives nulls.  The brackets are a table with a row
    per group and quantile, joined on the keys; no group is held or sorted whole, only the
    different values of its brackets are.
    """
    keys = list(keys)
    groups = [f"__g{i}" for i in range(len(keys))]
    names = [*groups, "__p"]
    src = df.select(*[F.col(k).alias(n) for k, n in zip(keys, groups, strict=True)], F.col(value).cast("double").alias("__x"))
    eps, ps = 2.0 / accuracy, list(probs.values())
    ends = [min(1.0, max(0.0, p + s * eps)) for p in ps for s in (-1, 1)]
    brackets = src.groupBy(*groups).agg(F.count("__x").alias("n"), F.percentile_approx("__x", ends, accuracy).alias("q"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("__p"), (F.lit(p) * (F.col("n") - 1)).alias("place"), F.col("q")[2 * i].alias("lo"), F.col("q")[2 * i + 1].alias("hi"))
                               for i, p in enumerate(ps)])).alias("s")
    brackets = cut_lineage(brackets.select(*groups, each).select(*groups, "s.*"))

    def beside(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
        """A null-safe join on ``on`` that keeps the left side's keys."""
        same = reduce(and_, (F.col(n).eqNullSafe(F.col(f"__k{n}")) for n in on), F.lit(True))
        return left.join(right.withColumnsRenamed({n: f"__k{n}" for n in on}), same, how).drop(*[f"__k{n}" for n in on])

    inside = (F.col("__x") >= F.col("lo")) & (F.col("__x") <= F.col("hi"))
    while True:
        rows = beside(src, checked_broadcast(brackets), groups)
        # one row per value of a bracket, and one (null) for all rows below it
        counts = rows.where(F.col("__x") <= F.col("hi")).groupBy(*names, "place", F.when(inside, F.col("__x")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        counts = cut_lineage(counts)
        size = counts.groupBy(*names).agg(F.count("v").alias("m")).agg(F.max("m")).first()[0] or 0
        if size <= most:
            break
        inner = beside(rows.where(inside), counts.where(F.col("v").isNull()).select(*names, F.col("n").alias("below")), names, "left")
        inner = inner.withColumn("below", F.coalesce("below", F.lit(0))).groupBy(*names, "place", "below").agg(
            F.count(F.lit(1)).alias("m"), F.percentile_approx("__x", [i / accuracy for i in range(accuracy + 1)], accuracy).alias("q"))
        a = F.floor((F.floor("place") - F.col("below")) / F.col("m") * accuracy).cast("int") - 1
        b = F.ceil((F.ceil("place") + 1 - F.col("below")) / F.col("m") * accuracy).cast("int") + 3
        narrowed = inner.select(*names, "place", F.element_at("q", F.greatest(a, F.lit(1))).alias("lo"), F.element_at("q", F.least(b, F.lit(accuracy + 1))).alias("hi"))
        empty = brackets.where(F.col("lo").isNull()).select(*names, "place", "lo", "hi")
        before, brackets = brackets, cut_lineage(narrowed.unionByName(empty))
        if brackets.exceptAll(before.select(*brackets.columns)).isEmpty():  # as narrow as the sketch can make it
            break
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).where(F.col("v").isNotNull())
    found = ranked.groupBy(*names, "place").agg(
        F.min(F.when(F.col("upto") > F.floor("place"), F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > F.ceil("place"), F.col("v"))).alias("b"))
    low, high = F.floor("place"), F.ceil("place")
    at = F.when((low == high) | (F.col("a") == F.col("b")), F.col("a")).otherwise((high - F.col("place")) * F.col("a") + (F.col("place") - low) * F.col("b"))
    none = brackets.where(F.col("lo").isNull()).select(*names, F.lit(None).cast("double").alias("at"))
    both = found.select(*names, at.alias("at")).unionByName(none)
    wide = both.groupBy(*groups).agg(*[F.max(F.when(F.col("__p") == i, F.col("at"))).alias(o) for i, o in enumerate(probs)])
    return wide.withColumnsRenamed(dict(zip(groups, keys, strict=True)))


def group_quantile(df: DataFrame, keys, value: str, p: float = 0.5, out: str = "quantile", accuracy: int = ACCURACY, most: int = MOST) -> DataFrame:
    """One quantile per group, see :func:`group_quantiles`."""
    return group_quantiles(df, keys, value, {out: p}, accuracy, most)
