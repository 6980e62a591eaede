"""Hashes of words and word n-grams for whole batches of texts, as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BASE = 0x5851F42D4C957F2D
MAX = np.uint64(2**64 - 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * _B
    x = (x ^ (x >> np.uint64(32))) * _A
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """Word hashes of a batch, one text after the other; text i has words offsets[i] to offsets[i + 1]."""

    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.offsets[1:], np.diff(self.offsets)) - np.arange(len(self.hashes))

    @property
    def place(self) -> np.ndarray:
        """Words before each word in its text."""
        return np.arange(len(self.hashes)) - np.repeat(self.offsets[:-1], np.diff(self.offsets))

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def hashes_of(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of non-empty strings, from their bytes and places."""
    strings = strings.cast(pa.large_string())
    ends = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    starts = ends[:-1] - ends[0]
    spot = np.arange(len(data)) - np.repeat(starts, np.diff(ends))
    lanes = mix(data.astype(np.uint64) + spot.astype(np.uint64) * np.uint64(257), 1)
    return mix(np.add.reduceat(lanes, starts) if len(starts) else np.zeros(0, dtype=np.uint64), 2)


def words_of(texts: pa.Array) -> Words:
    """Words between ASCII white space, A-Z in lower case; null and blank texts have none."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    size = np.diff(lists.offsets.to_numpy())
    blank = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    dictionary = coded.dictionary
    filled = pc.if_else(pc.equal(dictionary, ""), "\x00", dictionary)
    hashes = hashes_of(filled)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, dtype=np.uint64)
    hashes = hashes[np.repeat(~blank, size)]
    size = np.where(blank, 0, size)
    return Words(hashes, np.concatenate([[0], np.cumsum(size)]))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in order; ``len(hashes) - k + 1`` of them, across texts too."""
    power = lambda n: np.uint64(pow(BASE, n, 2**64))
    out, length, part, size = None, 0, hashes, 1
    while size <= k and len(hashes) >= k:
        if k & size:
            if out is None:
                out = part
            else:
                n = len(part) - length
                out = out[:n] + power(length) * part[length:]
            length += size
        if size * 2 <= k:
            part = part[:-size] + power(size) * part[size:]
        size *= 2
    return np.zeros(0, dtype=np.uint64) if out is None else out[: len(hashes) - k + 1]


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each run of ``width`` values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    size = 1
    while size * 2 <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[:n], x[width - size : width - size + n]) if size < width else x


def minimisers(values: np.ndarray, fits: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least value of some run of ``width`` positions that starts where ``fits``."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    least = np.where(fits[: n - width + 1], sliding(np.minimum, values, width), np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.maximum, np.concatenate([pad, least, pad]), width) == values)
