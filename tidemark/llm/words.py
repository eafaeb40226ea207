"""Words of many texts as flat arrays, and hashes of word spans.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, which is what ``bytes.lower`` and
``bytes.split`` do on UTF-8.  Words are laid out joined by single blanks, so a run of words is one
contiguous span, and its polynomial hash is a difference of prefix sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: A random 64-bit value for each byte.
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _scale(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, factor in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


@dataclass
class FlatWords:
    """``counts`` words per text; word i lies at ``starts[i]:ends[i]`` of the joined bytes."""

    words: list[bytes]
    counts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    prefix: np.ndarray
    inverse: np.ndarray

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the spans from word ``first`` to word ``last``, both included."""
        start, end = self.starts[first], self.ends[last]
        return mix((self.prefix[end] - self.prefix[start]) * self.inverse[start])

    def hashes(self) -> np.ndarray:
        every = np.arange(len(self.words))
        return self.spans(every, every)


def flat_words(texts: list[str | None]) -> FlatWords:
    parts = [text.encode().lower().split() if text else [] for text in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    words = list(chain.from_iterable(parts))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    buffer = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    power, inverse = _scale(len(buffer) + 1)
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * power[: len(buffer)], out=prefix[1:])
    return FlatWords(words, counts, ends - lengths, ends, prefix, inverse)


def shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words.

    A text with fewer words gives one hash of all of them, a text without words none.
    """
    flat = flat_words(texts)
    out, at = [], 0
    for n in flat.counts.tolist():
        if n == 0:
            out.append(np.empty(0, np.uint64))
        elif n <= width:
            out.append(flat.spans(np.array([at]), np.array([at + n - 1])))
        else:
            first = np.arange(at, at + n - width + 1)
            out.append(np.unique(flat.spans(first, first + width - 1)))
        at += n
    return out
