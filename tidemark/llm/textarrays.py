"""Whole texts as arrays: words, their hashes and shingles, many documents at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# An odd multiplier and its inverse modulo 2**64; byte values are first mapped to random numbers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0xC2B2AE3D27D4EB4F
CHUNK_BYTES = 1 << 21


def byte_values(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    """Distinct numbers in order; ``np.unique`` hashes them first, which takes longer."""
    x = np.sort(x)
    return x[_firsts(x)]


def _firsts(x: np.ndarray) -> np.ndarray:
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def distinct_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order and how often each occurs."""
    x = np.sort(x)
    first = np.flatnonzero(_firsts(x))
    return x[first], np.diff(np.append(first, len(x)))


def distinct_places(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order and where among them each is."""
    by = np.argsort(x)
    new = _firsts(x[by])
    place = np.empty(len(x), np.int64)
    place[by] = np.cumsum(new) - 1
    return x[by[new]], place


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near numbers are far apart."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int, of: int) -> np.ndarray:
    out = np.full(n, of, np.uint64)
    if n:
        out[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
    return out


def lower_ascii(text: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[text]


class WordHasher:
    """64-bit hashes of words of a byte array, equal for equal words wherever they stand."""

    def __init__(self):
        self.values = byte_values()
        self.up, self.down = powers(1, BASE), powers(1, INVERSE)

    def __call__(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of each run of bytes other than 0x20 and 0x09-0x0D."""
        n = len(text)
        if n + 1 > len(self.up):
            self.up, self.down = powers(n + n // 4 + 1, BASE), powers(n + n // 4 + 1, INVERSE)
        blank = (text == 0x20) | ((text >= 0x09) & (text <= 0x0D))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values[text] * self.up[:n], out=sums[1:])
            found = (sums[ends] - sums[starts]) * self.down[starts]
            return mixed(found + (ends - starts).astype(np.uint64) * np.uint64(STEP)), starts


def chunks(rows: Iterator[tuple], at: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray]]:
    """Rows whose field ``at`` is a text, grouped; the joined bytes and where each text starts.

    Texts are parted by a line break, so no word spans two of them.
    """
    held: list[tuple] = []
    size = 0

    def joined():
        texts = [r[at] or b"" for r in held]
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        return held, data, np.concatenate([[0], np.cumsum(lengths)])

    for row in rows:
        held.append(row)
        size += len(row[at] or b"") + 1
        if size >= limit:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def shingle_sets(data: np.ndarray, bounds: np.ndarray, hasher: WordHasher, words: int) -> list[np.ndarray]:
    """Per text of a chunk the sorted distinct hashes of its runs of ``words`` words.

    A text with fewer words has its whole sequence as the one shingle; one without words has none.
    """
    hashes, starts = hasher(lower_ascii(data))
    first = np.searchsorted(starts, bounds)
    out = []
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        factor = 1
        for j in range(words):
            runs += hashes[j : j + len(runs)] * np.uint64(factor)
            factor = factor * STEP % (1 << 64)
        runs = mixed(runs)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                out.append(distinct_sorted(runs[a : b - words + 1]))
            elif b > a:
                part = sum((int(h) * pow(STEP, j, 1 << 64) for j, h in enumerate(hashes[a:b])), b - a) % (1 << 64)
                out.append(mixed(np.array([part], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
