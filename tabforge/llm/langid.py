"""Language of every word of a text by a linear-chain conditional random field.

A word's features are its affixes, its character n-grams and itself (the lexicon), hashed into one
table of weights per language; a word of one language is followed by one of another with learnt
transition weights.  Forward-backward gives every word's posterior over languages in its context,
so a text that switches languages is labelled word by word.  A document gets the language with the
greatest expected number of words, and the mean posterior of that language as its score.

Training needs sequences whose labels change.  Labelled documents carry one language each, so
spans of them are joined into code-switched sequences: the span lengths are drawn, the labels
are those of the documents.  The conditional likelihood is maximised by full-batch gradient steps.

Weights of a word do not depend on its neighbours, so they are worked out once per distinct word.
Forward and backward passes over long texts are cut into blocks: the transfer matrices of all
blocks are multiplied side by side, chained per text, and the blocks are then walked together.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, written

#: Texts to learn from at most per language, those with the smallest hash.
TRAINING_ROWS = 400
#: Words of each training document that are used at most, in spans at places drawn over its whole text.
TRAINING_WORDS = 240
#: Hashed features.
SLOTS = 1 << 16
#: Words per training sequence and per block of a text.
STEPS, BLOCK = 24, 64
#: Words whose weights a process keeps; beyond that it starts anew.
KEPT = 400_000
#: Words worked on together; a longer text is a batch by itself.
AT_ONCE = 200_000

LETTER_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return LETTER_RUN.findall((text or "").lower())


def features(word: str) -> list[int]:
    """Slots of a word's affixes of up to four letters, its n-grams of two and three, and the word itself."""
    found = {f"w{word}"}
    for n in range(1, min(4, len(word)) + 1):
        found.add(f"p{word[:n]}")
        found.add(f"s{word[-n:]}")
    for n in (2, 3):
        found.update(f"g{word[i : i + n]}" for i in range(len(word) - n + 1))
    found.update(f"c{c}" for c in word if ord(c) > 127)
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS for f in found]


def passes(emission: np.ndarray, start: np.ndarray, change: np.ndarray, first: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors of many sequences of equal length, each row scaled to sum 1.

    ``emission`` is (sequences, steps, labels), ``start`` the vectors before each sequence already
    carried over by the transitions, ``first`` the backward vectors after it; steps not ``used``
    leave the vectors as they are.
    """
    rows, steps, labels = emission.shape
    forward, backward = np.empty_like(emission), np.empty_like(emission)
    into = start
    state = start
    for t in range(steps):
        new = into * emission[:, t]
        new /= new.sum(1, keepdims=True)
        state = np.where(used[:, t, None], new, state)
        forward[:, t] = state
        into = state @ change
    after = first
    for t in range(steps - 1, -1, -1):
        backward[:, t] = after
        new = (after * emission[:, t]) @ change.T
        new /= new.sum(1, keepdims=True)
        after = np.where(used[:, t, None], new, after)
    return forward, backward


class _Index(dict):
    """A number for every word, in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Crf:
    """Languages, feature weights (slot, language), start weights and transition weights."""

    def __init__(self, labels: list[str], weights: np.ndarray, start: np.ndarray, change: np.ndarray):
        self.__setstate__({"labels": labels, "weights": weights.astype(np.float32), "start": start, "change": change})

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("labels", "weights", "start", "change")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._index, self._factors = _Index(), np.zeros((0, len(self.labels)))

    def factors(self, words: list[str]) -> np.ndarray:
        """Each word's factor per language, at most 1."""
        if len(self._index) > KEPT:
            self._index, self._factors = _Index(), self._factors[:0]
        known = len(self._index)
        ids = np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))
        new = [features(w) for w in islice(self._index, known, None)]
        if new:
            starts = np.cumsum([0, *(len(f) for f in new[:-1])])
            z = np.add.reduceat(self.weights[np.concatenate(new)], starts, axis=0).astype(float)
            self._factors = np.concatenate([self._factors, np.exp(np.maximum(z - z.max(1, keepdims=True), -30.0))])
        return self._factors[ids]

    def posteriors(self, texts: list[list[str]]) -> np.ndarray:
        """Per word of all texts, one after another, its posterior over languages."""
        sizes = np.array([len(t) for t in texts], np.int64)
        labels = len(self.labels)
        total = int(sizes.sum())
        if not total:
            return np.zeros((0, labels))
        flat = self.factors([w for t in texts for w in t])
        change = np.exp(self.change - self.change.max())
        start = np.exp(self.start - self.start.max())
        # Blocks of each text: the last one of a text is padded.
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * BLOCK
        length = np.minimum(BLOCK, np.repeat(sizes, blocks) - nth * BLOCK)
        at = begin[:, None] + np.arange(BLOCK)
        used = np.arange(BLOCK) < length[:, None]
        emission = np.where(used[..., None], flat[np.minimum(at, total - 1)], 1.0)
        # Transfer matrix of a block: from the language of the word before it to that of its last word.
        transfer = np.broadcast_to(np.eye(labels), (len(owner), labels, labels)).copy()
        for t in range(BLOCK):
            new = (transfer @ change) * emission[:, t, None, :]
            new /= new.max((1, 2), keepdims=True)
            transfer = np.where(used[:, t, None, None], new, transfer)
        into, after = np.empty((len(owner), labels)), np.ones((len(owner), labels)) / labels
        into[nth == 0] = start
        count = blocks[owner]
        starts = np.cumsum(blocks) - blocks
        by_nth = np.argsort(nth, kind="stable")
        bounds = np.searchsorted(nth[by_nth], np.arange(int(blocks.max()) + 1))
        # The first block is entered by the start weights instead of a transition: its own pass gives its last vector.
        head = starts[sizes > 0]
        state = passes(emission[head], into[head], change, after[head], used[head])[0][:, -1]
        for k in range(1, int(blocks.max())):
            now = by_nth[bounds[k] : bounds[k + 1]]
            state = state[np.isin(head, now - k)]
            head = now - k
            into[now] = state @ change
            state = np.einsum("bi,bij->bj", state, transfer[now])
            state /= state.sum(1, keepdims=True)
        for k in range(int(blocks.max()) - 2, -1, -1):
            now = by_nth[bounds[k] : bounds[k + 1]]
            now = now[count[now] > k + 1]
            after[now] = np.einsum("bij,bj->bi", transfer[now + 1], after[now + 1])
            after[now] /= after[now].sum(1, keepdims=True)
        forward, backward = passes(emission, into, change, after, used)
        both = forward * backward
        return (both / both.sum(2, keepdims=True))[used]

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score per text; ``und`` and 0 for texts without letters."""
        split = [words_of(t) for t in texts]
        sizes = np.array([len(t) for t in split], np.int64)
        if not self.labels:
            return ["und"] * len(texts), [0.0] * len(texts)
        by_word = self.posteriors(split)
        owner = np.repeat(np.arange(len(texts)), sizes)
        mean = np.stack([np.bincount(owner, by_word[:, k], len(texts)) for k in range(len(self.labels))], 1).astype(float)
        mean /= np.maximum(sizes, 1)[:, None]
        best = mean.argmax(1)
        return [self.labels[b] if n else "und" for b, n in zip(best, sizes, strict=True)], np.clip(np.where(sizes > 0, mean.max(1), 0.0), 0, 1).tolist()


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id leaves 2 by 4; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """``lang, spans`` to learn from: up to ``rows`` texts of each language, from rows that are not held out.

    Per language those with the smallest hash of the text, each text once.  The hash below which
    they lie is estimated from the number of different texts, so only about that many rows are
    compared.  Spans hold at most ``TRAINING_WORDS`` words of a text, from places drawn over all of it.
    """
    key = F.xxhash64("text")
    able = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text", key.alias("key"))
    sizes = able.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()  # a row per language
    share = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(1 << 30)
    low = F.lit(False)
    for r in sorted(sizes):
        low = low | ((F.col("lang") == r["lang"]) & (share < min(1.0, 1.5 * rows / max(r["n"], 1))))
    once = able.where(low).groupBy("lang", "key").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    first = once.withColumn("place", place).where(F.col("place") <= rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[" ".join(s) for s in _spans(words_of(t), k)] for t, k in zip(batch.column("text").to_pylist(), batch.column("key").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("key"), pa.array(spans, pa.list_(pa.string()))], ["lang", "key", "spans"])

    return written(first.select("lang", "key", "text").mapInArrow(cut, "lang string, key long, spans array<string>"), "langid-sample")


def _spans(words: list[str], seed: int) -> list[list[str]]:
    """Spans at places drawn over the whole text, ``TRAINING_WORDS`` words in all at most."""
    places = range(0, len(words), STEPS)
    if len(words) > TRAINING_WORDS:
        places = np.sort(np.random.default_rng(seed & (1 << 62) - 1).integers(0, len(words) - STEPS + 1, TRAINING_WORDS // STEPS))
    return [words[p : p + STEPS] for p in places]


def switched(rows: list[tuple[str, list[str]]], seed: int = 7) -> list[list[tuple[str, str]]]:
    """Training sequences of (word, language): spans of labelled texts, half of them with their ends exchanged."""
    rng = np.random.default_rng(seed)
    spans = [[(w, lang) for w in words_of(s)[:STEPS]] for lang, found in rows for s in found]
    spans = [s for s in spans if s]
    order = rng.permutation(len(spans))
    out = []
    for i in range(0, len(order) - 1, 2):
        a, b = spans[order[i]], spans[order[i + 1]]
        if i % 4:
            out += [a, b]
        else:  # exchange the ends: both sequences change language in the middle, if the two differ
            x, y = int(rng.integers(0, len(a) + 1)), int(rng.integers(0, len(b) + 1))
            out += [s[:STEPS] for s in (a[:x] + b[y:], b[:y] + a[x:]) if s]
    if len(order) % 2:
        out.append(spans[order[-1]])
    return out


def fit(rows: list[tuple[str, list[str]]], rounds: int = 60, ridge: float = 1e-4, seed: int = 7) -> Crf:
    """Learn from (language, spans) rows, see :func:`sample`; no rows give a model without labels."""
    sequences = switched(rows, seed)
    names = sorted({lang for lang, _ in rows})
    labels = len(names)
    if not sequences:
        return Crf(names if labels == 1 else [], np.zeros((SLOTS, max(labels, 1))), np.zeros(max(labels, 1)), np.zeros((max(labels, 1),) * 2))
    index = {w: i for i, w in enumerate(sorted({w for s in sequences for w, _ in s}))}
    lists = [features(w) for w in index]
    slot, word = np.concatenate([np.array(f) for f in lists]), np.repeat(np.arange(len(index)), [len(f) for f in lists])
    starts = np.cumsum([0, *(len(f) for f in lists)])[:-1]
    live, slot = np.unique(slot, return_inverse=True)
    by_slot = np.argsort(slot, kind="stable")
    slot_starts = np.searchsorted(slot[by_slot], np.arange(len(live)))
    ids = np.zeros((len(sequences), STEPS), np.int64)
    gold = np.zeros((len(sequences), STEPS), np.int64)
    used = np.zeros((len(sequences), STEPS), bool)
    for i, s in enumerate(sequences):
        ids[i, : len(s)] = [index[w] for w, _ in s]
        gold[i, : len(s)] = [names.index(lang) for _, lang in s]
        used[i, : len(s)] = True
    # Observed counts of words, starts and changes.
    seen_word, seen_start, seen_change = np.zeros((len(index), labels)), np.zeros(labels), np.zeros((labels, labels))
    np.add.at(seen_word, (ids[used], gold[used]), 1.0)
    np.add.at(seen_start, gold[:, 0], 1.0)
    pair = used[:, 1:]
    np.add.at(seen_change, (gold[:, :-1][pair], gold[:, 1:][pair]), 1.0)
    total = used.sum()
    weights, start, change = np.zeros((len(live), labels)), np.zeros(labels), np.zeros((labels, labels))
    parts = [weights, start, change]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, rounds + 1):
        z = np.add.reduceat(weights[slot], starts, axis=0)
        factor = np.exp(np.maximum(z - z.max(1, keepdims=True), -30.0))
        e = np.where(used[..., None], factor[ids], 1.0)
        move = np.exp(change - change.max())
        ones = np.ones((len(ids), labels)) / labels
        forward, backward = passes(e, np.broadcast_to(np.exp(start - start.max()), ones.shape), move, ones, used)
        both = forward * backward
        both /= both.sum(2, keepdims=True)
        want_word = np.zeros((len(index), labels))
        for k in range(labels):
            want_word[:, k] = np.bincount(ids[used], both[..., k][used], len(index))
        ahead = backward[:, 1:] * e[:, 1:]
        norm = np.einsum("sti,ij,stj->st", forward[:, :-1], move, ahead)
        want_change = np.einsum("sti,stj->ij", forward[:, :-1] * (pair / norm)[..., None], ahead) * move
        gap = want_word - seen_word
        slopes = [np.add.reduceat(gap[word[by_slot]], slot_starts, axis=0) / total + ridge * weights,
                  (both[:, 0].sum(0) - seen_start) / total + ridge * start, (want_change - seen_change) / total + ridge * change]
        for p, g, m, v in zip(parts, slopes, mean, square, strict=True):  # Adam
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    full = np.zeros((SLOTS, labels))
    full[live] = weights
    return Crf(names, full, start, change)


def predicted(docs: DataFrame, model: Crf) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (doc_id, text); nothing else is looked at.

    Null texts, and texts without a letter, are ``und`` with score 0.  Whole texts are labelled,
    whatever their length.  Repeated rows and null doc_ids are rows like any other.
    """
    room = 6 * AT_ONCE * 16 // max(16, len(model.labels) ** 2)  # characters: transfer matrices take labels squared

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column, part, size, begin = batch.column("doc_id"), batch.column("text"), [], 0, 0
            for i in range(len(column)):
                part.append(column[i].as_py())
                size += len(part[-1] or "")
                if size >= room or i + 1 == len(column):
                    langs, scores = model.documents(part)
                    yield pa.RecordBatch.from_arrays([ids.slice(begin, len(part)), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])
                    part, size, begin = [], 0, i + 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(label, "doc_id long, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: language of every document, learnt from those whose crc32 of the id leaves no 2 by 4."""
    docs = table(spark, sf_dir, "documents")
    model = fit([(r["lang"], r["spans"]) for r in sample(docs).orderBy("key", "lang").collect()])
    return predicted(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
