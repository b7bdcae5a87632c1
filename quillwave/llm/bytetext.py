"""Texts as one array of UTF-8 bytes, their words, and keyed hashes of words and word runs, in numpy."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  #: bytes of text worked on at once; a single longer text is worked on alone


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; a null text is empty."""
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may still own bytes
        null = np.asarray(column.is_null())
        if (np.diff(at)[null] > 0).any():
            return text_bytes(column.fill_null(""))
    return raw, at


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all others (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The hash of two parts in a row, from theirs."""
    return mixed(x * np.uint64(0x9E3779B97F4A7C15) ^ y)


LANES = 8  #: groups of eight bytes up to which a word is hashed in numpy; a longer one by BLAKE2
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the lowest n bytes


def new_key() -> int:
    """A key for one job's hashes.

    Drawn anew each time, so no text can be written beforehand to collide; all tasks of a
    job get the same one with their closure.
    """
    return secrets.randbits(64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int) -> np.ndarray:
    """64-bit keyed hashes of the words between ``start`` and ``end``.

    Eight bytes at a time go through a mixing step that is not linear, the word's length
    first, so words of up to eight bytes never collide with one of their length and others
    only by chance.
    """
    held = np.zeros(len(data) + 8, np.uint8)
    held[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", buffer=held, strides=(1,))
    n = end - start
    h = mixed((lanes[start] & _LOW[np.minimum(n, 8)]) ^ mixed(n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(key)))
    for k in range(1, LANES):
        more = np.flatnonzero(n > 8 * k)
        if not len(more):
            return h
        x = lanes[start[more] + 8 * k] & _LOW[np.minimum(n[more] - 8 * k, 8)]
        h[more] = joined(h[more], x)
    raw = data.tobytes() if (n > 8 * LANES).any() else b""
    for i in np.flatnonzero(n > 8 * LANES):
        digest = hashlib.blake2b(raw[start[i] : end[i]], digest_size=8, key=key.to_bytes(8, "big")).digest()
        h[i] = int.from_bytes(digest, "big")
    return h


@dataclass
class Words:
    """The words of some consecutive texts: bounds in bytes, 64-bit hashes, and each text's first word."""

    first: int  #: number of the first text
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  #: text of each word, from 0
    at: np.ndarray  #: n + 1 positions of the texts' first words
    cut: np.ndarray  #: n + 1 positions of the texts' first bytes
    _power: dict[int, np.ndarray] = field(default_factory=dict)

    def rehashed(self, key: int) -> Words:
        """The same words with hashes under another key."""
        return replace(self, hash=word_hashes(self.data, self.start, self.end, key), _power={})

    def power(self, k: int) -> np.ndarray:
        """Hash of the 2^k words from each word on, out of two halves' hashes."""
        if k == 0:
            return self.hash
        if k not in self._power:
            x = self.power(k - 1)
            half = 1 << (k - 1)
            self._power[k] = joined(x[:-half], x[half:]) if len(x) > half else x[:0]
        return self._power[k]

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and 64-bit hash of every run of ``size`` words inside one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        pos = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return pos, self.spans(pos, pos + size)

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """64-bit hash of the words from a to b - 1, for arrays of a and b.

        Of n words, that of the first and the last 2^k, with 2^k the largest power up to n:
        together they are all of the words, and spans of one length overlap alike.
        """
        n = b - a
        level = np.frexp(n)[1] - 1
        out = np.zeros(len(n), np.uint64)
        for k in np.unique(level):
            x, own = self.power(int(k)), np.flatnonzero(level == k)
            out[own] = joined(x[a[own]], x[b[own] - (1 << int(k))])
        return mixed(out + n.astype(np.uint64))


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text alone."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, b
        a = b


def words(data: np.ndarray, offsets: np.ndarray, key: int, lower: bool = False) -> Iterator[Words]:
    """Words of the texts, maximal runs of bytes other than 0x20 and 0x09-0x0D; ``lower`` folds A-Z."""
    for a, b in chunks(offsets):
        lo, hi = int(offsets[a]), int(offsets[b])
        x = data[lo:hi]
        if lower:
            x = np.where((x >= 65) & (x <= 90), x + np.uint8(32), x)
        blank = (x == 0x20) | ((x >= 0x09) & (x <= 0x0D))
        cut = np.zeros(len(x) + 1, bool)  # a text begins here
        cut[offsets[a : b + 1] - lo] = True
        begins = ~blank
        ends = ~blank
        if len(x):
            begins = begins & (np.concatenate(([True], blank[:-1])) | cut[:-1])
            ends = ends & (np.concatenate((blank[1:], [True])) | cut[1:])
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        h = word_hashes(x, start, end, key)
        at = np.searchsorted(start, offsets[a : b + 1] - lo)
        doc = np.repeat(np.arange(b - a), np.diff(at))
        yield Words(a, x, start, end, h, doc, at, offsets[a : b + 1] - lo)
