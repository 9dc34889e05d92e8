"""Token ids as compressed binary files: an adaptive context-mixing range coder.

A block holds a run of ids, cut into parallel lanes that share one model.  Each step codes one id
per lane.  The id's probability is a mixture of three predictions: the id last seen after the two
ids before it (order 2), the id last seen after the one before it (order 1), and an adaptive
frequency table over all ids (order 0).  The mixture weights depend on how often each prediction
has been confirmed in its context and adapt with every step; the result drives a range coder with
carry.  All state starts anew with each block, and each block carries a CRC-32 of its ids and bytes, so
a block can be read, checked or lost on its own.

A file is a header (magic, version, vocabulary size), its blocks, and an empty block that counts
them.  Files are written under a temporary name and moved into place, so a repeated task leaves
the same file and never half of one.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import table, text_batches, written
from tabforge.llm.tokens import byte_bpe, vocabulary
from tabforge.session import scratch_path

MAGIC, VERSION = b"TFID", 2
BLOCK = 1 << 21          # ids in a block
LANES, LEAST = 2048, 64  # lanes of a block at most; ids in a lane at least
MIX = 12                 # bits of the mixture weights
SCALE = 18               # bits of the order-0 frequencies
RENEW = (1 << 11, 1 << 16)  # ids until order-0 frequencies are recomputed: an eighth of those counted, within these bounds
SLOTS = 18               # bits of the order-2 table
TOP, LOW = np.uint64(1 << 48), np.uint64(1 << 32)
_U = np.uint64


class Model:
    """Predictions and weights, the same in encoder and decoder after every step."""

    def __init__(self, vocab: int):
        if vocab >= 1 << 16:
            raise ValueError("ids must be below 65,536")
        self.vocab = vocab
        # A prediction is an id with a confidence of 0 to 3 packed above it; id `vocab` predicts nothing.
        self.one = np.full(vocab + 1, vocab, np.uint32)
        self.two = np.full(1 << SLOTS, vocab, np.uint32)
        self.hits = np.ones((64, 3), np.float64)  # by context: order 2 right, else order 1 right, else neither
        self.counts = np.zeros(vocab, np.int64)
        self.seen: list[np.ndarray] = []  # ids not counted yet
        self._renew()

    def _renew(self) -> None:
        """Frequencies with sum 2^SCALE, each at least 1, from the counts so far."""
        if self.seen:
            self.counts += np.bincount(np.concatenate(self.seen), minlength=self.vocab)
            self.seen = []
        total, room = int(self.counts.sum()), (1 << SCALE) - self.vocab
        freq = 1 + (self.counts * room // total if total else np.zeros(self.vocab, np.int64))
        freq[int(freq.argmax())] += (1 << SCALE) - int(freq.sum())
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self._symbol = None
        self.since, self.until = 0, min(max(total // 8, RENEW[0]), RENEW[1])

    def symbol(self) -> np.ndarray:
        """The id at each of the 2^SCALE places of the frequency table."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(self.vocab, dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def predict(self, before: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """Order-2 and order-1 entries, the weights' context, ends of the order-2 and order-1 share, order-2 slots."""
        slot = ((before * np.uint32(0x9E3779B1)) ^ (last * np.uint32(0x85EBCA6B))) >> np.uint32(32 - SLOTS)
        two, one = self.two[slot], self.one[last]
        differ = two ^ one
        context = ((two >> 16) << 2) | (one >> 16) | ((differ & 0xFFFF == 0).astype(np.uint32) << 4) | ((two & 0xFFFF == self.vocab).astype(np.uint32) << 5)
        weight = self.hits / self.hits.sum(axis=1, keepdims=True)
        points = 1 + (weight * ((1 << MIX) - 3)).astype(np.uint64)  # each of the three at least 1
        return two, one, context, points[:, 0][context], (points[:, 0] + points[:, 1])[context], slot

    def learn(self, ids, last, two, one, context, slot, hit2, hit1) -> None:
        self.hits += np.bincount(context * np.uint32(3) + np.uint32(2) - (hit2.view(np.uint8) << 1) - hit1, minlength=192).reshape(64, 3)
        if self.hits[:, 2].max() > 1 << 14:
            self.hits *= 0.5
            np.maximum(self.hits, 0.02, out=self.hits)
        for held, key, entry, right in ((self.two, slot, two, hit2), (self.one, last, one, one & 0xFFFF == ids)):
            up = entry + ((entry < 0x30000).astype(np.uint32) << 16)
            held[key] = np.where(right, up, np.where(entry >= 0x10000, entry - np.uint32(0x10000), ids))
        self.seen.append(ids)
        self.since += len(ids)
        if self.since >= self.until:
            self._renew()


def _shape(n: int) -> tuple[int, int]:
    """(lanes, steps) for n ids: lane l holds ids l * steps to (l + 1) * steps."""
    lanes = max(1, min(LANES, n // LEAST))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """``ids`` (below ``vocab``) as one block."""
    n = len(ids)
    lanes, steps = _shape(n)
    padded = np.full(lanes * steps, 0, np.uint32)
    padded[:n] = ids
    grid = padded.reshape(lanes, steps).T.copy()
    live = np.minimum(np.maximum(n - np.arange(lanes) * steps, 0), steps)  # ids in each lane
    model = Model(vocab)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, TOP - _U(1), np.uint64)
    width = 2 * steps + 8
    out, base = np.zeros(lanes * width, np.uint32), np.arange(lanes) * width
    at = base.copy()
    before, last = np.full(lanes, vocab, np.uint32), np.full(lanes, vocab, np.uint32)
    for step in range(steps):
        on = None if live.min() > step else np.flatnonzero(live > step)  # None: all lanes
        x, l_, s_, a_, b, p = (v if on is None else v[on] for v in (grid[step], low, span, at, before, last))
        two, one, context, end2, end1, slot = model.predict(b, p)
        hit2 = two & 0xFFFF == x
        hit1 = (one & 0xFFFF == x) & ~hit2
        hit = hit2 | hit1
        unit = s_ >> _U(MIX)
        rest = (unit * (_U(1 << MIX) - end1)) >> _U(SCALE)
        l_ = l_ + np.where(hit, unit * (end2 * hit1), unit * end1 + rest * model.cum[x])
        s_ = np.where(hit, unit * np.where(hit2, end2, end1 - end2), rest * model.freq[x])
        over = l_ >= TOP
        if over.any():
            l_[over] -= TOP
            _carry(out, a_[over] - 1)
        small = s_ < LOW
        while small.any():
            out[a_] = l_ >> _U(32)  # stays only where the place moves on
            a_ = a_ + small
            shift = small.astype(np.uint64) << _U(4)
            l_ = (l_ << shift) & (TOP - _U(1))
            s_ = s_ << shift
            small = s_ < LOW
        if on is None:
            low, span, at, before, last = l_, s_, a_, last, x
        else:
            low[on], span[on], at[on], before[on], last[on] = l_, s_, a_, p, x
        model.learn(x, p, two, one, context, slot, hit2, hit1)
    for _ in range(3):  # the rest of low
        out[at] = low >> _U(32)
        at = at + 1
        low = (low << _U(16)) & (TOP - _U(1))
    words = np.concatenate([out[i:j] for i, j in zip(base, at, strict=True)])
    payload = (at - base).astype("<u4").tobytes() + words.astype("<u2").tobytes()
    return struct.pack("<III", n, len(payload), zlib.crc32(payload, zlib.crc32(ids.astype("<u4").tobytes()))) + payload


def _carry(out: np.ndarray, place: np.ndarray) -> None:
    """Add one to the words at these places, and on to the word before where one overflows."""
    while len(place):
        out[place] += 1
        place = place[out[place] > 0xFFFF]
        out[place] = 0
        place = place - 1


def decode_block(raw: bytes, vocab: int) -> np.ndarray:
    """The ids of a block; raises if their checksum differs."""
    n, size, crc = struct.unpack_from("<III", raw)
    lanes, steps = _shape(n)
    sizes = np.frombuffer(raw, "<u4", lanes, 12).astype(np.int64)
    words = np.concatenate([np.frombuffer(raw, "<u2", (size - 4 * lanes) // 2, 12 + 4 * lanes).astype(np.uint64), np.zeros(4, np.uint64)])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if lanes else np.zeros(0, np.int64)
    live = np.minimum(np.maximum(n - np.arange(lanes) * steps, 0), steps)
    model = Model(vocab)
    code = (words[at] << _U(32)) | (words[at + 1] << _U(16)) | words[at + 2]
    at = at + 3
    span = np.full(lanes, TOP - _U(1), np.uint64)
    before, last = np.full(lanes, vocab, np.uint32), np.full(lanes, vocab, np.uint32)
    grid = np.zeros((steps, lanes), np.uint32)
    for step in range(steps):
        on = None if live.min() > step else np.flatnonzero(live > step)
        c_, s_, a_, b, p = (v if on is None else v[on] for v in (code, span, at, before, last))
        two, one, context, end2, end1, slot = model.predict(b, p)
        unit = s_ >> _U(MIX)
        edge2, edge1 = unit * end2, unit * end1
        hit2, hit = c_ < edge2, c_ < edge1
        hit1 = hit & ~hit2
        rest = (unit * (_U(1 << MIX) - end1)) >> _U(SCALE)
        # Both sides are below 2^53 and the quotient below 2^18 + 1, so the float quotient floors to the exact one.
        place = np.minimum(np.where(hit, _U(0), c_ - edge1) / rest, (1 << SCALE) - 1).astype(np.int64)
        x = model.symbol()[place]
        c_ = c_ - np.where(hit, edge2 * hit1, edge1 + rest * model.cum[x])
        s_ = np.where(hit, np.where(hit2, edge2, edge1 - edge2), rest * model.freq[x])
        x = np.where(hit, np.where(hit2, two, one) & 0xFFFF, x)
        small = s_ < LOW
        while small.any():
            shift = small.astype(np.uint64) << _U(4)
            c_ = (c_ << shift) | words[a_] * small
            s_ = s_ << shift
            a_ = a_ + small
            small = s_ < LOW
        if on is None:
            code, span, at, before, last = c_, s_, a_, last, x
            grid[step] = x
        else:
            code[on], span[on], at[on], before[on], last[on] = c_, s_, a_, p, x
            grid[step, on] = x
        model.learn(x, p, two, one, context, slot, hit2, hit1)
    ids = grid.T.reshape(-1)[:n]
    if zlib.crc32(raw[12 : 12 + size], zlib.crc32(ids.astype("<u4").tobytes())) != crc:
        raise ValueError("block checksum differs")
    return ids


class Writer:
    """One file of consecutive documents."""

    def __init__(self, folder: str, name: str, vocab: int):
        from pyarrow import fs

        self._fs, root = fs.FileSystem.from_uri(folder)
        self._path, self._draft = f"{root}/{name}.ids", f"{root}/.{name}-{uuid.uuid4().hex}"
        self._fs.create_dir(root, recursive=True)
        self._out = self._fs.open_output_stream(self._draft)
        self._vocab, self._held, self._waiting, self._blocks = vocab, [], 0, 0
        self._out.write(struct.pack("<4sII", MAGIC, VERSION, vocab))

    def add(self, ids: np.ndarray) -> None:
        self._held.append(ids)
        self._waiting += len(ids)
        if self._waiting >= BLOCK:
            joined = np.concatenate(self._held)
            whole = len(joined) // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._block(joined[i : i + BLOCK])
            self._held, self._waiting = [joined[whole:]], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        self._out.write(encode_block(ids, self._vocab))
        self._blocks += 1

    def close(self) -> str:
        if self._waiting:
            self._block(np.concatenate(self._held))
        self._out.write(struct.pack("<III", 0, 0, self._blocks))  # an empty block ends the file
        self._out.close()
        self._fs.move(self._draft, self._path)
        return self._path


def read(folder: str, name: str) -> Iterator[np.ndarray]:
    """The ids of a file, block by block."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{name}.ids") as f:
        magic, version, vocab = struct.unpack("<4sII", f.read(12))
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not an id file")
        blocks = 0
        while True:
            head = f.read(12)
            n, size, check = struct.unpack("<III", head)
            if not n:
                if check != blocks:
                    raise ValueError("blocks are missing")
                return
            yield decode_block(head + f.read(size), vocab)
            blocks += 1


def write(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = 0, file_bytes: int = 32 << 20) -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text; others ignored) in ascending doc_id order.

    Returns the catalogue, one row per document in the files: ``file`` (files in doc_id order),
    ``k`` (place in the file), ``doc_id``, ``n``.  Null and empty texts are the end id alone; rows
    without doc_id come first; rows with the same doc_id follow one another by the hash of their
    text.  An empty table gives no file.  A file takes about ``file_bytes`` of text.
    """
    text_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(files, "doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, file, out, k = byte_bpe(vocabulary_path), TaskContext.get().partitionId(), None, 0
        vocab, end = bpe.tokenizer.get_vocab_size(), np.array([end_id], np.uint32)
        for b in batches:
            out = out or Writer(folder, f"{file:07d}", vocab)
            sizes = []
            for raw in bpe.encode_batch(list(b["text"])):
                ids = np.concatenate([np.frombuffer(raw, "<u4"), end])
                out.add(ids)
                sizes.append(len(ids))
            yield pd.DataFrame({"file": file, "k": np.arange(k, k + len(b)), "doc_id": b["doc_id"].astype("Int64"), "n": sizes})
            k += len(b)
        if out is not None:
            out.close()

    return written(ordered.mapInPandas(run, "file int, k long, doc_id long, n long"), "ids-catalogue")


def documents(catalogue: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` per document, read back from the files."""
    sizes = catalogue.groupBy("file").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("docs"))
    before = sizes.withColumn("before", F.sum("total").over(Window.orderBy("file")) - F.col("total"))  # a row per file
    # A file is read by one task, to which its catalogue rows go; as many partitions as files, so no task gets many.
    files = (catalogue.agg(F.max("file")).first()[0] or 0) + 1
    listed = catalogue.join(before.select("file", "before"), "file").repartition(files, "file").sortWithinPartitions("file", "k")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, source, held, at = None, iter(()), np.zeros(0, np.uint32), 0
        for b in batches:
            out = []
            for f, doc, n, start in zip(b["file"], b["doc_id"], b["n"], b["before"], strict=True):
                if f != file:
                    if len(held) or next(source, None) is not None:
                        raise ValueError(f"file {file} holds more ids than its documents")
                    file, source, at = f, read(folder, f"{f:07d}"), int(start)
                while len(held) < n:
                    held = np.concatenate([held, next(source)])
                out.append((doc, at, n, held[:n].astype("<u4").tobytes()))
                held, at = held[n:], at + n
            yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids"]).astype({"doc_id": "Int64"})
        if len(held) or next(source, None) is not None:
            raise ValueError(f"file {file} holds more ids than its documents")

    return listed.select("file", "k", "doc_id", "n", "before").mapInPandas(run, "doc_id long, start long, n_tokens long, ids binary")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document's place and checksum, from the files."""
    folder = scratch_path(spark, "ids")
    catalogue = write(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"))
    return documents(catalogue, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
