"""Words of many texts at once: numpy over the bytes of a slice of a batch.

A slice is about a quarter megabyte (``common.slices``), so the arrays here stay small.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# Any odd multipliers do; 3 modulo 4 keeps neighbouring powers apart.
POWER = 0x9E3779B97F4A7C17
MASK = (1 << 64) - 1


def _ascii_mask(chars: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[[ord(c) for c in chars]] = True
    return mask


WHITE = _ascii_mask(" \t\n\x0b\x0c\r")
NOT_WORD = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(POWER))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, POWER, dtype=np.uint64)
    down = np.full(size, pow(POWER, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@dataclass
class Words:
    """``doc``, ``start``, ``end`` and ``hash`` of every word, in order; ``data`` is all bytes."""

    docs: int
    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text_starts: np.ndarray


def split(texts: list[str | None], separators: np.ndarray = WHITE) -> Words:
    """Maximal runs of bytes that are no separators; A-Z count as a-z in the hash."""
    coded = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    text_starts = np.cumsum([0] + [len(c) + 1 for c in coded])
    data = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
    gap = separators[data]
    gap[text_starts[1:] - 1] = True
    inside = ~gap
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside.size and inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    doc = np.searchsorted(text_starts, start, side="right") - 1
    low = data + np.uint8(32) * ((data >= 65) & (data <= 90)).astype(np.uint8)
    size = 1 << max(19, int(data.size).bit_length())
    up, down = _powers(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[low] * up[: data.size], dtype=np.uint64)])
    hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(len(texts), data, doc, start, end, hashes, text_starts)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of ``size`` words; a shorter text's words are one run."""
    counts = np.bincount(words.doc, minlength=words.docs)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(words.docs), runs)
    first = np.arange(doc.size) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(starts, runs)
    length = np.minimum(size, counts)[doc]
    value = length.astype(np.uint64)
    for step in range(size):
        here = step < length
        word = words.hash[np.minimum(first + step, max(words.hash.size - 1, 0))] if words.hash.size else value
        value = np.where(here, mix(value * np.uint64(POWER) + word), value)
    return doc, value


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, value, times) of the distinct values of each document, sorted by both."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(doc.size, dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, doc.size))
