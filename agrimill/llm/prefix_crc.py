"""CRC-32 of any substring from the running CRCs at its two ends, by shifting over GF(2)."""

from __future__ import annotations

import functools
from zlib import crc32

import numpy as np

# Fixed value: the reversed generator polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
# Lengths in bytes whose shift is one look-up in a table of its own; longer ones are put together from powers of two.
SHORT = 64


def _bits(columns: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values at the single bits, as four tables by byte."""
    tables = np.zeros((4, 256), np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    for j in range(4):
        for bit in range(8):
            tables[j] ^= np.where(byte >> bit & 1, columns[8 * j + bit], 0).astype(np.uint32)
    return tables


def _apply(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    return tables[0][values & 255] ^ tables[1][values >> 8 & 255] ^ tables[2][values >> 16 & 255] ^ tables[3][values >> 24]


@functools.lru_cache(maxsize=1)
def _zero_byte() -> np.ndarray:
    """What one zero byte does to the register, as four tables by byte."""
    columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        columns = np.where(columns & 1, columns >> 1 ^ np.uint32(POLYNOMIAL), columns >> 1).astype(np.uint32)
    return _bits(columns)


@functools.lru_cache(maxsize=1)
def _short_shifts() -> np.ndarray:
    """Tables of the shifts by 0 to SHORT - 1 bytes."""
    units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    out = np.empty((SHORT, 4, 256), np.uint32)
    for n in range(SHORT):
        out[n] = _bits(units)
        units = _apply(_zero_byte(), units)
    return out


@functools.lru_cache(maxsize=64)
def _power(k: int) -> np.ndarray:
    """Tables of the shift by 2 ** k bytes: each is the one before applied twice."""
    if not k:
        return _zero_byte()
    units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    half = _power(k - 1)
    return _bits(_apply(half, _apply(half, units)))


def shift(values: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRCs as they enter the CRC of a text that goes on for so many bytes."""
    tables = _short_shifts()
    near = n_bytes < SHORT
    n = np.where(near, n_bytes, 0)
    out = tables[n, 0, values & 255] ^ tables[n, 1, values >> 8 & 255] ^ tables[n, 2, values >> 16 & 255] ^ tables[n, 3, values >> 24]
    far = np.flatnonzero(~near)
    if len(far):
        v, left = values[far], n_bytes[far]
        for k in range(int(left.max()).bit_length()):
            on = np.flatnonzero(left >> k & 1)
            v[on] = _apply(_power(k), v[on])
        out[far] = v
    return out


class Running:
    """Running CRCs of words joined by single spaces, at the beginning and the end of every word."""

    def __init__(self, words: list[bytes], before: int = 0):
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        # The only pass over the bytes: each word goes on from the space after the word before it.
        crc = before
        ends = np.array([before] + [crc := crc32(word, crc32(b" ", crc)) for word in words], np.uint32)
        register = ends[:-1] ^ np.uint32(0xFFFFFFFF)
        self.begin = _apply(_zero_byte(), register ^ np.uint32(0x20)) ^ np.uint32(0xFFFFFFFF)
        self.end = ends[1:]
        self.upto = np.cumsum(size + 1)
        self.size = size

    def ngrams(self, n: int) -> np.ndarray:
        """CRC-32 of every run of `n` words, by the place of its first word."""
        if len(self.size) < n:
            return np.empty(0, np.uint32)
        last = len(self.size) - n + 1
        length = self.upto[n - 1:] - self.upto[:last] + self.size[:last]
        return self.end[n - 1:] ^ shift(self.begin[:last], length)
