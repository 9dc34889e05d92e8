"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer turns the words of a clause into symbols: insult, threat, target, negation,
report, other.  Pattern transducers then rewrite insults and threats: negated within three words
after a negation, reported after a verb of speech, targeted within four words of a target.  They
are composed into one machine, run over matched clauses only, and the document's score is a
logistic function of how often each outcome occurs and with what lexical weight.

The lexicon starts from a short seed list and is completed from labelled documents: word stems
(a stem matches longer words) and whole words that toxic documents hold far more often than
clean ones, chosen greedily until every toxic document holds a few matches.  The outcome weights
are fitted on the same documents.  Rows whose crc32 of the doc_id leaves 0 by 5 are never learnt from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches, written

#: Labelled documents to learn from at most, those with the smallest hash of doc_id.
TRAINING_ROWS = 16_000

# Seed words.
INSULTS = ("idiot", "moron", "stupid", "loser", "worthless", "trash", "scum", "pathetic", "clown", "disgusting", "imbecile", "vermin", "dumb")
THREATS = ("kill", "hurt", "destroy", "beat", "smash", "shoot", "stab")
TARGETS = ("you", "your", "yours", "they", "them", "he", "she", "people", "du", "dich", "ihr", "euch", "tu", "toi", "vous", "tú", "usted", "ustedes")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "wrote", "called", "quoted", "reported", "sagte", "schrieb", "nannte", "dit", "écrit", "appelé", "dijo", "escribió", "llamó")

CLAUSE_END = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
STEM = (3, 9)  # letters in a learnt stem
OUTCOMES = ("plain", "targeted", "negated", "reported")


class Transducer:
    """A deterministic finite-state transducer: ``step(state, symbol) -> (state, symbol)``."""

    def __init__(self, start, step):
        self.start, self._step, self._seen = start, step, {}

    def step(self, state, symbol):
        if (state, symbol) not in self._seen:
            self._seen[state, symbol] = self._step(state, symbol)
        return self._seen[state, symbol]

    def run(self, symbols: Iterable) -> list:
        state, out = self.start, []
        for s in symbols:
            state, s = self.step(state, s)
            out.append(s)
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    def step(state, symbol):
        a, middle = first.step(state[0], symbol)
        b, out = second.step(state[1], middle)
        return (a, b), out

    return Transducer((first.start, second.start), step)


def _within(trigger: str, words: int, mark: str) -> Transducer:
    """Marks insults and threats that follow the trigger within so many words."""
    def step(left, symbol):
        kind, marks = symbol
        if kind == trigger:
            return words, symbol
        if kind in "IT" and left:
            symbol = (kind, marks | {mark})
        return max(0, left - 1), symbol

    return Transducer(0, step)


FORWARD = compose(compose(_within("N", 3, "negated"), _within("R", 1 << 20, "reported")), _within("Y", 4, "targeted"))
BACKWARD = _within("Y", 4, "targeted")


def outcomes(kinds: list[str]) -> list[tuple[str, str]]:
    """(kind, outcome) per word of a clause; reported goes before negated, negated before targeted."""
    symbols = FORWARD.run((k, frozenset()) for k in kinds)
    symbols = BACKWARD.run(reversed(symbols))[::-1]
    return [(k, next((o for o in ("reported", "negated", "targeted") if o in marks), "plain")) for k, marks in symbols]


@dataclass
class Grammar:
    """Stems and words with weights, and the fitted outcome weights."""

    stems: dict[str, float]   # a word longer than the stem
    words: dict[str, float]   # the word itself
    beta: np.ndarray | None = None

    def __post_init__(self):
        self._machine = None

    def __getstate__(self):
        return {"stems": self.stems, "words": self.words, "beta": self.beta}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._machine = None

    def machine(self):
        """Finds where any stem, word or threat may start."""
        if self._machine is None:
            import ahocorasick

            self._machine = ahocorasick.Automaton()
            for w in {*self.stems, *self.words, *THREATS}:
                self._machine.add_word(w, len(w))
            self._machine.make_automaton()
        return self._machine

    def weight(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in range(STEM[0], min(STEM[1], len(word) - 1) + 1):
            found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def features(self, text: str | None) -> np.ndarray:
        """Per outcome the number of insults and their weights; threats at a target; all matches, and per root of words."""
        out = np.zeros(2 * len(OUTCOMES) + 4)
        text = (text or "").lower()
        starts = {e - n + 1 for e, n in self.machine().iter(text)} if len(self.machine()) else set()
        starts = sorted(s for s in starts if s == 0 or not (text[s - 1].isalnum()))
        seen, at = 0, -1
        for s in starts:
            if s < at:
                continue
            begin = max((m for m in (text.rfind(c, 0, s) for c in ".!?;:\n")), default=-1) + 1
            end = CLAUSE_END.search(text, s)
            at = end.start() if end else len(text)
            words = WORD.findall(text, begin, at)
            weights = [self.weight(w) for w in words]
            kinds = ["I" if x > 0 else "T" if w in THREATS else "Y" if w in TARGETS else "N" if w in NEGATIONS else "R" if w in REPORTS else "O" for w, x in zip(words, weights, strict=True)]
            for (kind, outcome), x in zip(outcomes(kinds), weights, strict=True):
                if kind == "I":
                    i = OUTCOMES.index(outcome)
                    out[2 * i] += 1
                    out[2 * i + 1] += x
                    seen += 1
                elif kind == "T" and outcome == "targeted":
                    out[-4] += 1
        bare = out[0] + out[2]  # neither negated nor reported
        out[-3], out[-2], out[-1] = min(bare, 1), min(max(bare - 1, 0), 1), seen / math.sqrt(1 + len(text) / 6)
        out[: -3] = np.minimum(out[: -3], 30)
        return out

    def score(self, text: str | None) -> float:
        z = float(self.beta[0] + self.features(text) @ self.beta[1:])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _units(text: str | None) -> Counter:
    """How often each candidate stem (``abc*``) and word (``abc``) matches in a text."""
    found: Counter = Counter()
    for w, n in Counter(WORD.findall((text or "").lower())).items():
        if len(w) >= STEM[0] and not w.isdigit():
            found[w] += n
            for k in range(STEM[0], min(STEM[1], len(w) - 1) + 1):
                found[w[:k] + "*"] += n
    return found


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``text, toxic`` of labelled training rows, each text once."""
    labels = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(labels, "doc_id")
    return written(found.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-sample")


def fit(training: DataFrame, cover: int = 3, least_odds: float = 4.0) -> Grammar:
    """Learn a grammar from ``text, toxic`` rows (bounded by the caller, see :data:`TRAINING_ROWS`)."""
    n1, n0 = (training.where(F.col("toxic") == t).count() for t in (1, 0))
    seeds = dict.fromkeys(INSULTS, math.log(20.0))
    grammar = Grammar({}, dict(seeds))
    if not n1 or not n0:
        grammar.beta = np.zeros(2 * len(OUTCOMES) + 5)
        grammar.beta[0], grammar.beta[-3], grammar.beta[-2] = -3.0, 2.0, 3.0
        return grammar
    least = max(3, math.ceil(0.004 * n1))
    toxic = training.where(F.col("toxic") == 1).select("text")

    def units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                total.update(_units(t).keys())
        yield pd.DataFrame({"unit": list(total.keys()), "n": list(total.values())})

    often = toxic.mapInPandas(units, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    a = {r["unit"]: r["n"] for r in often.collect()}  # units of at least 0.4 % of the toxic rows: bounded by their mean number per row

    def among(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                total.update(a.keys() & _units(t).keys())
        yield pd.DataFrame({"unit": list(total.keys()), "n": list(total.values())})

    clean = training.where(F.col("toxic") == 0).select("text")
    b = {r["unit"]: r["n"] for r in clean.mapInPandas(among, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n")).collect()}
    odds = {u: (n + 0.5) / (n1 + 1) / ((b.get(u, 0) + 0.5) / (n0 + 1)) for u, n in a.items()}
    odds = {u: x for u, x in odds.items() if x >= least_odds}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [[(u, n) for u, n in _units(t).items() if u in odds] for t in part["text"]]
            yield pd.DataFrame({"units": [[u for u, _ in f] for f in found], "counts": [[n for _, n in f] for f in found]})

    held = [dict(zip(r["units"], r["counts"], strict=True)) for r in toxic.mapInPandas(rows, "units array<string>, counts array<long>").collect()]
    chosen = _greedy(held, odds, least, cover)
    grammar = Grammar({u[:-1]: math.log(odds[u]) for u in chosen if u[-1] == "*"}, seeds | {u: math.log(odds[u]) for u in chosen if u[-1] != "*"})

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"x": [grammar.features(t) for t in part["text"]], "toxic": part["toxic"]})

    got = training.mapInPandas(features, "x array<double>, toxic int").groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")).toPandas()
    grammar.beta = _logistic(np.stack(got["x"]), got["toxic"].to_numpy(float), got["n"].to_numpy(float))
    return grammar


def _greedy(held: list[dict[str, int]], odds: dict[str, float], least: int, cover: int) -> list[str]:
    """Units that give every row ``cover`` matches where they can, the most telling first."""
    where: dict[str, list[tuple[int, int]]] = {}
    for i, units in enumerate(held):
        for u, n in units.items():
            where.setdefault(u, []).append((i, n))
    need, chosen = np.full(len(held), cover), []
    gain = lambda u: sum(min(need[i], n) for i, n in where[u])
    value = lambda u: gain(u) * math.log(odds[u])
    best = {u: value(u) for u in where}
    while best:
        u = max(best, key=lambda x: (best[x], len(x), x))
        now = value(u)
        if now < best[u]:  # stale: gains only shrink
            best[u] = now
            if now <= 0:
                del best[u]
            continue
        del best[u]
        if sum(need[i] > 0 for i, _ in where[u]) < least:
            continue
        chosen.append(u)
        for i, n in where[u]:
            need[i] = max(0, need[i] - n)
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's method; the intercept comes first and is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[0] = 1e-6
    loss = lambda b: float((n * np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ b))).sum() + 0.5 * (pull * b * b).sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull), x.T @ (n * (p - y)) + pull * beta)
        size, before = 1.0, loss(beta)
        while loss(beta - size * step) > before and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return beta


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; only the text is looked at.

    Null and empty texts score as texts without matches.  Rows are independent, so repeated rows
    and null doc_ids need nothing special; columns of these names are replaced.
    """
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t) for t in text], dtype=float)

    text_batches(docs.sparkSession)
    return docs.withColumn("score", score(F.col("text"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: score of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    grammar = fit(sample(docs, table(spark, sf_dir, "labels")))
    return scored(docs.select("doc_id", "text"), grammar).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
