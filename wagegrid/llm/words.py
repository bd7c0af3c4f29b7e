"""Words and shingles of many texts at once, as numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z.  Words get a 64-bit hash from prefix sums over
the bytes of a batch, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from wagegrid.llm.common import slices

#: Bytes of text worked on at a time (a longer text goes alone).
BATCH_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# An odd base has an inverse modulo 2**64, so a word's hash does not depend on its place.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, BATCH_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x + np.uint64((seed * 0xBF58476D1CE4E5B9 + 0x9E3779B97F4A7C15) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its texts (null: empty)."""
    plain = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = plain.buffers()
    at = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of texts ``first`` to ``last`` of a batch."""

    first: int
    last: int
    data: np.ndarray  #: lower-cased bytes of these texts
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  #: words of text ``first + i`` are bounds[i]:bounds[i + 1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers(_BASE, len(data)), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def each_words(texts: pa.Array) -> Iterator[Words]:
    """The words of a batch, about ``BATCH_BYTES`` of text at a time."""
    data, at = text_bytes(texts)
    for first, last in slices(np.diff(at).tolist(), BATCH_BYTES):
        part = _LOWER[data[at[first] : at[last]]]
        offsets = at[first : last + 1] - at[first]
        blank = _SPACE[part]
        edge = np.ones(len(part) + 1, bool)
        edge[1:-1] = blank[:-1]
        edge[offsets] = True
        starts = np.flatnonzero(~blank & edge[:-1])
        edge[:-1] = blank
        edge[offsets] = True
        ends = np.flatnonzero(~blank & edge[1:]) + 1
        yield Words(
            first, last, part, starts, ends, word_hashes(part, starts, ends),
            np.searchsorted(starts, offsets),
        )


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    n = min(size, len(hashes))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        total *= np.uint64(0xC2B2AE3D27D4EB4F)
        total += hashes[i : len(hashes) - n + 1 + i]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats."""
    ordered = np.sort(values)
    keep = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=keep[1:])
    return ordered[keep]


def each_set(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of every text, in order of the texts."""
    for words in each_words(texts):
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            yield distinct(shingle_hashes(words.hashes[a:b], size))
