"""Words of whole texts as numbers of a vocabulary, in Arrow batches.

A word is a maximal run of ASCII digits, ASCII letters and characters beyond ASCII; only A-Z is lower-cased. In UTF-8 these are
runs of single byte values, so texts are cut as bytes. Words are hashed eight bytes at a time and a vocabulary's word is only
recognised after its bytes were compared, so numbers are exact. Null has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about so many bytes; a longer text takes several pieces.
PIECE_BYTES = 2_000_000
_WORD = np.zeros(256, np.int8)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 1
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-cased UTF-8 begin and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class _Bytes:
    """Eight bytes at any place of some data, zero beyond a word's end."""

    def __init__(self, data: bytes) -> None:
        whole = np.frombuffer(data + b"\0" * (16 - len(data) % 8), "<u8")
        self.low, self.size = whole, len(data)

    def at(self, place: np.ndarray, length: np.ndarray) -> np.ndarray:
        word, bit = place >> 3, ((place & 7) << 3).astype(np.uint64)
        out = self.low[word] >> bit
        # A shift by 64 is undefined, so the upper part goes in two steps.
        out |= (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - bit)
        return out & _KEEP[np.minimum(length, 8)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _FACTOR
    return x ^ (x >> np.uint64(29))


def _hashes(data: _Bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    length = ends - starts
    out = _mixed(data.at(starts, length) + length.astype(np.uint64) * np.uint64(2 * seed + 1))
    rest, k = np.flatnonzero(length > 8), 8
    while len(rest):
        out[rest] = _mixed(out[rest] + data.at(starts[rest] + k, length[rest] - k) * np.uint64(3))
        k += 8
        rest = rest[length[rest] > k]
    return out


class Vocabulary:
    """Distinct words with numbers from 0; `ids` gives the number of each word of some data, -1 for others."""

    def __init__(self, words: list[bytes]) -> None:
        self.data = b" ".join(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length + 1) - 1
        for self.seed in range(100):
            keys = _hashes(_Bytes(self.data), ends - length, ends, self.seed)
            order = np.argsort(keys)
            if len(np.unique(keys)) == len(keys):
                break
        else:
            raise ValueError("no hash tells these words apart")
        self.keys, self.number = keys[order], order
        self.starts, self.ends, self.size = ends - length, ends, len(words)
        self.shift = np.uint64(64 - max(12, min(22, len(words).bit_length() + 5)))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[keys >> self.shift] = True

    def ids(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.full(len(starts), -1, np.int32)
        if not self.size or not len(starts):
            return out
        text, own = _Bytes(data), _Bytes(self.data)
        keys = _hashes(text, starts, ends, self.seed)
        maybe = np.flatnonzero(self.seen[keys >> self.shift])
        place = np.minimum(np.searchsorted(self.keys, keys[maybe]), self.size - 1)
        same = self.keys[place] == keys[maybe]
        maybe, word = maybe[same], self.number[place[same]]
        at, to, length = starts[maybe], self.starts[word], ends[maybe] - starts[maybe]
        equal = length == self.ends[word] - to
        rest, k = np.flatnonzero(equal), 0
        while len(rest):  # every byte is compared
            wrong = text.at(at[rest] + k, length[rest] - k) != own.at(to[rest] + k, length[rest] - k)
            equal[rest[wrong]] = False
            k += 8
            rest = rest[~wrong & (length[rest] > k)]
        out[maybe[equal]] = word[equal]
        return out


class Read(NamedTuple):
    """Words of some texts: numbers, the text each is in (from 0), and how many words each text has."""

    first: int
    ids: np.ndarray
    text: np.ndarray
    counts: np.ndarray


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of about PIECE_BYTES that end where no word is cut."""
    at = 0
    while at < len(data):
        to = at + PIECE_BYTES
        while to < len(data) and _WORD[data[to]] and _WORD[data[to - 1]]:
            to += 1
        yield data[at:to]
        at = to


def read_words(texts: pa.Array | pa.ChunkedArray, vocabulary: Vocabulary) -> Iterator[Read]:
    """The words of all texts, some texts at a time."""
    plain = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    first = 0
    while first < len(plain):
        last, size = first, 0
        while last < len(plain) and (last == first or size + len(plain[last]) <= PIECE_BYTES):
            size += len(plain[last]) + 1
            last += 1
        data = b" ".join(plain[first:last]).lower()
        begins = np.cumsum([0, *(len(t) + 1 for t in plain[first : last - 1])])
        if last == first + 1:
            ids = [vocabulary.ids(p, *word_spans(p)) for p in _pieces(data)]
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            text = np.zeros(len(ids), np.int64)
        else:
            starts, ends = word_spans(data)
            ids, text = vocabulary.ids(data, starts, ends), np.searchsorted(begins, starts, "right") - 1
        yield Read(first, ids, text, np.bincount(text, minlength=last - first))
        first = last
