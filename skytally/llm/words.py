"""Words of a text as 64-bit numbers, and numbers for runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words a worker remembers the number of.
CACHED = 400_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Number of each word, computed once; ``bytes.split()`` cuts at exactly the six ASCII white-space characters."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHED:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8))
#: Bytes whose numbers are computed at once.
BLOCK = 1 << 18


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of several texts, one after the other; where the words of each text begin, and where the last end.

    A word's number comes from the sum of numbers of its bytes at their places, so all words are looked at together.
    """
    data = np.frombuffer(b" ".join([b"", *texts, b""]), dtype=np.uint8)
    inside = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, end = edges[::2], edges[1::2]
    out = np.zeros(len(first), dtype=np.uint64)
    cuts = np.unique(np.r_[np.searchsorted(first, np.arange(0, len(data), BLOCK)), len(first)])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        part = slice(first[a], end[b - 1])
        sizes = end[a:b] - first[a:b]
        begin = np.cumsum(sizes) - sizes
        letters = data[part][inside[part]].astype(np.uint64)
        place = (np.arange(1, len(letters) + 1) - np.repeat(begin, sizes)).astype(np.uint64)
        out[a:b] = mix(np.add.reduceat(mix((letters + (place << np.uint64(8))) * ODD), begin))
    begins = np.cumsum([1, *(len(text) + 1 for text in texts)])
    return out, np.searchsorted(first, begins)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Number of every run of ``length`` consecutive words, by position of its first word.

    Runs double: the number of 2n words comes from those of its two halves, so a run costs O(log length).
    """
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, size, out, done = words, 1, None, 0
    rest = length
    while rest:
        if rest & 1:
            part = power[done : done + n]
            out = mix(part + np.uint64(int(ODD) * size % (1 << 64))) if out is None else mix(out * ODD + part)
            done += size
        rest >>= 1
        if rest:
            power = mix(power[:-size] * ODD + power[size:])
            size *= 2
    return out
