"""Byte-level BPE over many texts: each distinct piece of text is encoded once and kept.

A text is cut before single spaces and line ends between two characters that aren't white space, and between a letter and a mark (but for
apostrophes): the tokenizer's own pre-tokens always begin there, so the ids of the pieces in a row are those of the whole text. Where the neighbours might be white space of any kind no
cut is made, which costs time only. No cut is made in or beside the text of an added token that the tokenizer takes as one. Pieces are found and hashed on the Arrow buffers; what a worker hasn't met yet goes to the
tokenizers library, and a table of bounded size keeps the ids.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from glyphmill.llm import _words
from glyphmill.llm._words import flat

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

KEPT_PIECES = 500_000
KEPT_IDS = 3_000_000

_PLAIN = np.zeros(256, bool)
_PLAIN[33:127] = True
_TWO = np.zeros(256, bool)
_TWO[0xC3:0xE0] = True
_THREE = np.zeros(256, bool)
_THREE[0xE4:0xED] = True
_BEGINS = _PLAIN | _TWO | _THREE
_BEGINS[0xF0:0xF5] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = _PLAIN & ~_LETTER
_MARK[48:58] = _MARK[39] = False
_BREAK = np.zeros(256, bool)
_BREAK[[10, 32]] = True


def cuts(buf: np.ndarray, at: np.ndarray, whole: tuple[bytes, ...] = ()) -> np.ndarray:
    """Where pieces begin, row starts included; at: where rows begin, and the end; whole: texts that stay whole."""
    i = np.flatnonzero(_BREAK[buf])
    row = np.searchsorted(at, i, "right") - 1
    i = i[(i > at[row]) & (i + 1 < at[row + 1])]
    row = np.searchsorted(at, i, "right") - 1
    good = _PLAIN[buf[i - 1]]
    back = buf[i - 1] >= 0x80
    good |= back & (i - 2 >= at[row]) & _TWO[buf[np.maximum(i - 2, 0)]]
    good |= back & (i - 3 >= at[row]) & _THREE[buf[np.maximum(i - 3, 0)]] & (buf[np.maximum(i - 2, 0)] >= 0x80)
    edge = np.zeros(len(buf) + 1, bool)
    edge[i[good & _BEGINS[buf[i + 1]]]] = True
    if len(buf):
        edge[1:-1] |= _LETTER[buf[:-1]] & _MARK[buf[1:]]
        raw = buf.tobytes() if whole else b""
        for x in whole:
            k = raw.find(x)
            while k >= 0:
                edge[k : k + len(x) + 1] = False
                k = raw.find(x, k + 1)
        edge[at[:-1][np.diff(at) > 0]] = True
    return np.flatnonzero(edge[:-1])


class Encoder:
    """ids of texts, by the tokenizer in a file. added: the text of a special token gives that token's id, as the library does
    unless told otherwise; else it is text like any other."""

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.whole = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and (added or not t.special))
        self._forget()

    def _forget(self) -> None:
        # Kept pieces: their hashes in order with the number of each; by number, where its ids begin and how many they are.
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.count = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """hashes ascend and none of them is known."""
        k = len(self.known)
        if k + len(pieces) > len(self.begin):
            self.begin, self.count = (np.concatenate([x, np.zeros(max(len(x) // 2, len(pieces)), np.int32)]) for x in (self.begin, self.count))
        for lo in range(0, len(pieces), 1024):
            own = [e.ids for e in self.tokenizer.encode_batch_fast(pieces[lo : lo + 1024], add_special_tokens=False)]
            count = np.fromiter(map(len, own), np.int64, len(own))
            more = int(count.sum())
            if self.used + more > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids) // 2, more), np.uint32)])
            self.ids[self.used : self.used + more] = np.fromiter(chain.from_iterable(own), np.uint32, more)
            self.begin[k + lo : k + lo + len(own)] = self.used + np.cumsum(count) - count
            self.count[k + lo : k + lo + len(own)] = count
            self.used += more
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.number = np.insert(self.number, at, np.arange(k, k + len(hashes), dtype=np.int32))

    def _slots(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The kept piece of each piece in turn, and the first piece of each row with the end."""
        buf, at = flat(column)
        if len(self.known) > KEPT_PIECES or self.used > KEPT_IDS:
            self._forget()
        begin = cuts(buf, at, self.whole)
        end = np.r_[begin[1:], len(buf)]
        words = _words.Words.__new__(_words.Words)
        words.buf, words.start, words.end = buf, begin, end
        new, first, inverse = np.unique(words._hashes(), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, new)
        unseen = np.flatnonzero(self.known[np.minimum(place, len(self.known) - 1)] != new) if len(self.known) else np.arange(len(new))
        if len(unseen):
            raw = memoryview(buf)
            self._learn(new[unseen], [str(raw[begin[i] : end[i]], "utf-8") for i in first[unseen].tolist()])
            place = np.searchsorted(self.known, new)
        slots = self.number[place]
        return slots[inverse], np.searchsorted(begin, at)

    def counts(self, column: pa.Array) -> np.ndarray:
        """How many ids each row has."""
        slots, first = self._slots(column)
        total = np.r_[0, np.cumsum(self.count[slots])]
        return total[first[1:]] - total[first[:-1]]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, and where each row's begin with the end."""
        slots, first = self._slots(column)
        count = self.count[slots]
        total = np.r_[0, np.cumsum(count)]
        where = np.arange(total[-1]) + np.repeat(self.begin[slots] - total[:-1], count)
        return self.ids[where], total[first]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """This worker's encoder for a file."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]

