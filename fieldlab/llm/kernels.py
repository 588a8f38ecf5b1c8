"""Numpy kernels over concatenated texts: polynomial prefix hashes, words, n-gram hashes, sliding minima."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes up to which a word has a polynomial hash.
PLAIN = 32
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse's powers modulo 2**64, for i below n at least."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            table = np.full(size, b, U)
            table[0] = 1
            made.append(np.multiply.accumulate(table))
        _POWERS[base] = tuple(made)
    return _POWERS[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit hash."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


class Prefix:
    """Hashes of any byte ranges of a buffer in constant time each."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        up, down = powers(base, len(data) + 1)
        self.up = up
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * down[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.up[begin])


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are runs of anything but space and 9 to 13; they end where texts end.

    Begin and end of each word, and for each text the index of its first word (``len(at)`` entries).
    """
    full = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = full[:-1]
    begin = np.flatnonzero(full & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = full[1:]
    end = np.flatnonzero(full & (~after | first[1:])) + 1
    return begin, end, np.searchsorted(begin, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words`` and a 64-bit hash of each.

    A polynomial modulo 2**64 has long words that always collide, so words beyond ``PLAIN`` bytes get a hash of another kind.
    """
    begin, end, first = words(data, at)
    hashes = Prefix(data).of(begin, end)
    for i in np.flatnonzero(end - begin > PLAIN).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes())
    return begin, end, first, hashes


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive words; n - 1 fewer than words."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, U)
    for i in range(n):
        total = total * U(BASES[1]) + hashes[i : i + size]
    return mixed(total)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each ``width`` consecutive values."""
    size = len(values) - width + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    best, place, span = values, np.arange(len(values)), 1

    def joined(best, place, far):
        n = len(best) - far
        left = best[:n] <= best[far:]
        return np.where(left, best[:n], best[far:]), np.where(left, place[:n], place[far:])

    while span * 2 <= width:
        best, place = joined(best, place, span)
        span *= 2
    if span < width:
        best, place = joined(best, place, width - span)
    return place[:size]


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``begin[i], begin[i] + 1, ...`` for ``count[i]`` numbers each, one after the other."""
    total = int(count.sum())
    step = np.ones(total, np.int64)
    keep = count > 0
    begin, count = begin[keep], count[keep]
    if not total:
        return step
    step[0] = begin[0]
    heads = np.cumsum(count)[:-1]
    step[heads] = begin[1:] - begin[:-1] - count[:-1] + 1
    return np.cumsum(step)


def row_words(matrix: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian 64-bit tokens, padded by zeros, so that tokens compare as the bytes do."""
    rows, width = matrix.shape
    wide = -(-width // 8) * 8
    padded = np.zeros((rows, wide), np.uint8)
    padded[:, :width] = matrix
    return padded.view(">u8").astype(U)


def multikey_order(tokens: np.ndarray, cutoff: int = 4096) -> np.ndarray:
    """Order of rows of tokens by multikey quicksort: three parts around a pivot token; the middle goes on with the next token.

    Equal rows keep their order. Parts below the cutoff are sorted by their remaining tokens at once.
    """
    n, width = tokens.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == width:
            continue
        part = order[lo:hi]
        if hi - lo <= cutoff:
            rest = tokens[part, depth:]
            order[lo:hi] = part[np.lexsort(rest.T[::-1])]
            continue
        key = tokens[part, depth]
        pivot = np.sort(key[:: max(1, len(key) // 63)])[min(31, len(key) - 1)]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        order[lo:hi] = np.concatenate([part[less], part[same], part[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order
