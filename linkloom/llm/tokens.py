"""Words of Arrow text columns as 64-bit hashes, a slice of documents at a time.

Words are runs of bytes outside ``\\x20 \\x09-\\x0D`` with A-Z lower-cased. A word's hash is the
sum, over its bytes, of a pseudo-random number for each pair of place and byte (tabulation, drawn
from a key), mixed with its length: words that differ anywhere get unrelated sums, whatever
their pattern, and another key gives other collisions, if any. Two given words collide once in
2^64. Everything is numpy over whole slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
#: Places in a word whose numbers are looked up; those of later ones are computed.
PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _numbers(place_and_byte: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix((place_and_byte.astype(U) + U(1)) * _STEP) ^ mix(np.array([key + 1], U) * _STEP))


@lru_cache(maxsize=4)
def _table(key: int) -> np.ndarray:
    return _numbers(np.arange(PLACES)[:, None] << 8 | _LOWER[None, :].astype(np.int64), key).ravel()


def word_slices(texts: pa.Array, key: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, hashes of their words, where each row's words begin and end)."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + SLICE, "right")) - 1)
        yield a, b, *_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a], key)
        a = b


def _hashes(data: np.ndarray, at: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if n == 0:
        return np.zeros(0, U), np.zeros(len(at), np.int64)
    blank = _BLANK[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = blank[:-1], blank[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    long = ends - starts
    first = np.cumsum(long) - long
    inside = data[~blank]
    place = np.arange(len(inside)) - np.repeat(first, long)
    value = _table(key)[np.minimum(place, PLACES - 1) << 8 | inside]
    far = np.flatnonzero(place >= PLACES)
    if len(far):
        value[far] = _numbers(place[far] << 8 | _LOWER[inside[far]].astype(np.int64), key)
    total = np.zeros(len(inside) + 1, U)
    np.cumsum(value, out=total[1:])
    with np.errstate(over="ignore"):
        h = total[first + long] - total[first] + long.astype(U) * _STEP
    return mix(h), np.searchsorted(starts, at)
