"""Whole texts to ids of the byte-level BPE vocabulary, with the tokenizers library.

The library's pre-tokenizer always starts a new piece at a space that is followed by anything but
white space.  So a text may be cut at such spaces and the pieces' ids joined, and a piece met
before need not be encoded again.  Texts with other spacing, or that spell a special token, are
encoded in one call.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from functools import cache

import numpy as np

#: Pieces kept per process; further ones are encoded again each time.  A bound on memory, not on the text.
KEPT = 800_000
#: Characters of text cut into pieces at a time.
AT_ONCE = 1 << 20


class ByteBpe:
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._whole = re.compile("|".join([r" (?=\s|\Z)", *special])).search  # these texts are not cut
        self._spaced: dict[str, bytes] = {}
        self._starts = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self._starts[[i for piece, i in self.tokenizer.get_vocab().items() if piece.startswith(_byte_letters()[32])]] = True

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        out, part, size = [], [], 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size >= AT_ONCE:
                out += self._encode(part)
                part, size = [], 0
        return out + self._encode(part)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [None if self._whole(t) else t.split(" ") for t in texts]
        first = [parts and self._first(parts.pop(0)) for parts in cut]
        spaced, passing = self._pieces(set().union(*filter(None, cut)))
        out = []
        for text, parts, start in zip(texts, cut, first, strict=True):
            if parts is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(start + b"".join(map(spaced.__getitem__, parts)))
        for chunk in passing:
            del spaced[chunk]
        return out

    def _first(self, chunk: str) -> bytes:
        """Ids of a text's first chunk, which has no space before it."""
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _pieces(self, chunks: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """Ids of each chunk with a space before it: a dict that holds ``chunks`` and those kept, and what is not to be kept.

        New chunks are encoded as one text: each starts with its space, and no other piece does.
        """
        new = list(chunks.difference(self._spaced))
        if not new:
            return self._spaced, []
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        starts = (np.flatnonzero(self._starts[ids]) * 4).tolist()
        raw = ids.tobytes()
        room = KEPT - len(self._spaced)
        self._spaced.update(zip(new, map(raw.__getitem__, map(slice, starts, [*starts[1:], len(raw)])), strict=True))
        return self._spaced, new[max(0, room) :]


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


@cache
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per process and vocabulary file."""
    return ByteBpe(path)


def forget() -> None:
    """Give back what the process keeps for encoding, for a later stage that runs in the same process."""
    if byte_bpe.cache_info().currsize:
        byte_bpe.cache_clear()
        gc.collect()
        with contextlib.suppress(AttributeError, OSError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
