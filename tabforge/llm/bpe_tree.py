"""BPE encoding by segment trees over adjacent pair ranks, and decoding.

A word's symbols stand in a row; the leaf of each symbol holds the merge rank of the pair it forms
with its right neighbour, inner nodes hold the least of their children.  The root is then the
lowest rank in the word, leftmost among equals, and its path leads to the pair.  A merge changes
the leaves of the merged symbol, its left neighbour and the symbol that goes, each a logarithmic
update, until no mergeable pair remains.

Words of one length class are worked on together: the trees are rows of an array, and each round
makes the next merge in every word that still has one.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches
from tabforge.llm.tokens import AT_ONCE, KEPT, _byte_letters, vocabulary

NONE = np.iinfo(np.int64).max  # no merge
PLACE_BITS = 24                # leaves of a tree: symbols in a word below 2^24


class Merges:
    """Rank and result of a pair of ids, by hashing into an open-addressed table."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]):
        self._bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self._bits
        self._key, self._rank, self._made = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for rank, ((a, b), c) in enumerate(zip(pairs, made, strict=True)):
            key = a << 24 | b
            at = int(self._home(np.array([key]))[0])
            while self._key[at] >= 0 and self._key[at] != key:
                at = (at + 1) % size
            if self._key[at] < 0:
                self._key[at], self._rank[at], self._made[at] = key, rank, c

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, result) per pair; rank -1 where either id is -1 or the pair has no merge."""
        key = np.where((left >= 0) & (right >= 0), left << 24 | right, -2)
        at = self._home(np.maximum(key, 0))
        held = self._key[at]
        while (miss := (held != key) & (held >= 0)).any():
            at = np.where(miss, (at + 1) & ((1 << self._bits) - 1), at)
            held = self._key[at]
        hit = held == key
        return np.where(hit, self._rank[at], -1), np.where(hit, self._made[at], -1)


def merge_words(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> list[bytes]:
    """The ids of each word, as unsigned 32-bit integers, after all merges, lowest rank first and leftmost among equals.

    ``symbols`` holds the words' first ids one word after another, ``lengths`` how many each has.
    """
    out: list[bytes] = [b""] * len(lengths)
    starts = np.cumsum(lengths) - lengths
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
    for k in np.unique(bits[lengths > 0]).tolist():
        width = 1 << k
        members = np.flatnonzero((bits == k) & (lengths > 0))
        rows = max(1, (1 << 20) >> k)  # words at a time: bounds the trees' memory
        for i in range(0, len(members), rows):
            part = members[i : i + rows]
            at = starts[part][:, None] + np.arange(width)
            inside = np.arange(width) < lengths[part][:, None]
            ids = _merge(np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], -1), merges)
            left = ids >= 0
            raw, ends = ids[left].astype("<u4").tobytes(), (4 * np.cumsum(left.sum(axis=1))).tolist()
            begin = 0
            for w, end in zip(part.tolist(), ends, strict=True):
                out[w] = raw[begin:end]
                begin = end
    return out


def _merge(ids: np.ndarray, merges: Merges) -> np.ndarray:
    """One word a row, -1 after its end; merged in place, with -1 where a symbol has gone."""
    count, width = ids.shape
    place = np.arange(width)
    after, before = np.tile(place + 1, (count, 1)), np.tile(place - 1, (count, 1))
    tree = np.full((count, 2 * width), NONE, np.int64)  # node 1 is the root, leaf p is node width + p
    rank, _ = merges.find(ids[:, :-1], ids[:, 1:])
    tree[:, width : 2 * width - 1] = np.where(rank >= 0, rank << PLACE_BITS | place[:-1], NONE)
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        level //= 2

    def update(r: np.ndarray, p: np.ndarray, value: np.ndarray) -> None:
        node = width + p
        tree[r, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

    def pair(r: np.ndarray, p: np.ndarray) -> np.ndarray:
        """What the leaf of p must hold: the rank of p with the symbol after it."""
        q = after[r, p]
        found, _ = merges.find(ids[r, p], np.where(q < width, ids[r, np.minimum(q, width - 1)], -1))
        return np.where(found >= 0, found << PLACE_BITS | p, NONE)

    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        p = tree[rows, 1] & ((1 << PLACE_BITS) - 1)
        q = after[rows, p]
        _, made = merges.find(ids[rows, p], ids[rows, q])
        ids[rows, p], ids[rows, q] = made, -1
        nxt = after[rows, q]
        after[rows, p] = nxt
        inside = nxt < width
        before[rows[inside], nxt[inside]] = p[inside]
        update(rows, q, np.full(len(rows), NONE))
        update(rows, p, pair(rows, p))
        o = before[rows, p]
        left = o >= 0
        if left.any():
            update(rows[left], o[left], pair(rows[left], o[left]))
        rows = rows[tree[rows, 1] < NONE]
    return ids


class WordBpe:
    """The word-level BPE vocabulary: lower case, white space dropped, the last symbol of a word marked.

    Words are what the file's pre-tokenizer keeps; a special token's string in a text is that token.
    """

    # The file's pattern for words, with {W} white space, {L} letters and {N} numbers, and white space (fixed values).
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{W}{L}{N}]+"
    WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    END = "</w>"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        self._merges = Merges([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        letter, number = _letters_and_numbers(path)
        self._find = re.compile(self.WORDS.replace("{W}", self.WHITE).replace("{L}", letter).replace("{N}", number)).findall
        letters = _byte_letters()
        self._byte = np.array([vocab[c] for c in letters], np.int64)
        self._last = np.array([vocab[c + self.END] for c in letters], np.int64)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = special
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self._rare = re.compile("[\x1c-\x1f]").search  # white space to Python only
        self._white = re.compile(f"[{self.WHITE}]+").split
        self.token = [""] * (max(max(vocab.values()), *special.values()) + 1)
        for t, i in [*vocab.items(), *special.items()]:
            self.token[i] = t
        self._normal = Tokenizer.from_file(path).normalizer.normalize_str
        self._ids: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        out, part, size = [], [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size >= AT_ONCE:
                out += self._encode(part)
                part, size = [], 0
        return out + self._encode(part)

    def _chunks(self, text: str) -> list[str]:
        if "<|" in text and len(parts := self._split.split(text)) > 1:
            return [c for i, p in enumerate(parts) for c in ([p] if i % 2 else self._chunks(p))]
        return [c for c in self._white(text) if c] if self._rare(text) else text.split()

    def _encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        chunks = [self._chunks(t) for t in texts]
        known = self._known({c for row in chunks for c in row})
        ids = [b"".join(map(known.__getitem__, row)) for row in chunks]
        return [(i, self.decode(np.frombuffer(i, "<u4"))) for i in ids]

    def _known(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of each chunk, new ones encoded together."""
        new = chunks.difference(self._ids)
        if len(self._ids) + len(new) > KEPT:  # start over with what is needed now: bounds memory, changes no result
            self._ids, new = {}, chunks
        words: dict[str, int] = {}
        parts, special = [], self._special
        for c in new:
            if c in special:
                parts.append(None)
            else:
                parts.append([words.setdefault(w, len(words)) for w in self._find(c.lower() if c.isascii() else self._normal(c))])
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        octets = np.frombuffer(b"".join(raw), np.uint8)
        symbols, last = self._byte[octets], np.cumsum(lengths) - 1
        symbols[last] = self._last[octets[last]]
        made = merge_words(symbols, lengths, self._merges)
        for c, p in zip(new, parts, strict=True):
            self._ids[c] = np.array([special[c]], "<u4").tobytes() if p is None else made[p[0]] if len(p) == 1 else b"".join([made[i] for i in p])
        return self._ids

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces, as the library does for a file without a decoder."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


def _letters_and_numbers(path: str) -> tuple[str, str]:
    """Letters and numbers as ranges of a character class, as the file's own pre-tokenizer tells them from other characters.

    Which code points are assigned depends on the Unicode version a library was built with, so each
    candidate is probed with a full stop after it: only a letter or number is split off.
    """
    import regex
    from tokenizers import Tokenizer

    number = regex.compile(r"\p{N}").fullmatch
    chars = regex.findall(r"[\p{L}\p{N}]", "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000))
    pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str("".join(c + ". " for c in chars))
    alone = {a // 3 for _, (a, b) in pieces if a % 3 == 0 and b == a + 1}
    found: dict[str, list[list[str]]] = {"L": [], "N": []}
    for i in sorted(alone):
        c, ranges = chars[i], found["N" if number(chars[i]) else "L"]
        if ranges and ord(ranges[-1][1]) == ord(c) - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return tuple("".join(f"{a}-{b}" for a, b in r) for r in found.values())


@cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encoded(docs: DataFrame, vocabulary_path: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per row; with ``digests`` the SHA-256 of both instead.

    Null and empty texts have no ids and decode to the empty text.  Rows are independent, so
    repeated rows and null doc_ids need nothing special.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = word_bpe(vocabulary_path)
        for b in batches:
            done = bpe.encode_batch(list(b["text"]))
            out = {"doc_id": b["doc_id"].astype("Int64"), "n_tokens": [len(i) // 4 for i, _ in done]}
            if digests:
                out |= {"ids_sha256": [hashlib.sha256(i).hexdigest() for i, _ in done], "decoded_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for _, t in done]}
            else:
                out |= {"ids": [np.frombuffer(i, "<u4").astype(np.int64) for i, _ in done], "decoded": [t for _, t in done]}
            yield pd.DataFrame(out)

    text_batches(docs.sparkSession)
    columns = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<long>, decoded string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, f"doc_id long, n_tokens long, {columns}")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: ids and decoded text of every document."""
    return encoded(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), digests=True)
