"""Words of whole texts as numpy arrays, hashed without a Python step per word.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage
return. A text's bytes are read in slices of about one megabyte cut at white space, so memory
follows the slice and not the longest text.

Words are told apart by 64-bit hashes made of two polynomial hashes of their bytes and their length, each taken from
one running sum per slice: one modulo 2^64, one modulo the prime 2^31 - 1. The first alone has structured collisions
(any string built like the Thue-Morse sequence and its complement, from 1,024 bytes on, whatever the base); those are
none for a prime. Both are joined before the bits are mixed. What remains is chance, 2^-64 for a pair of words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WINDOW = 0xD6E8FEB86659FD93
_WINDOW_INVERSE = pow(_WINDOW, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits.
NOT_PLAIN = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of a base and of its inverse, extended when a longer slice asks for it."""

    def __init__(self, base: int, inverse: int) -> None:
        self.base, self.inverse, self.n = base, inverse, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            size = max(n, SLICE + 1)
            if size > 2 * SLICE:  # one very long word: not kept
                return _powers(self.base, size), _powers(self.inverse, size)
            self.up, self.down, self.n = _powers(self.base, size), _powers(self.inverse, size), size
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BASE, _BASE_INVERSE), _Powers(_WINDOW, _WINDOW_INVERSE)

_PRIME = (1 << 31) - 1
_PRIME_BASE = 1_000_003_297
_PRIME_INVERSE = pow(_PRIME_BASE, -1, _PRIME)
_JOIN = U64(0xC2B2AE3D27D4EB4F)


def _prime_powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo the prime, by doubling; products of two factors stay below 2^62."""
    out = np.ones(1, U64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * U64(step) % U64(_PRIME)])
        step = step * step % _PRIME
    return out[:n]


class _PrimePowers(_Powers):
    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            size = max(n, SLICE + 1)
            powers = tuple(_prime_powers(base, size).astype(np.uint32) for base in (self.base, self.inverse))
            if size > 2 * SLICE:
                return powers
            (self.up, self.down), self.n = powers, size
        return self.up[:n], self.down[:n]


_PRIMES = _PrimePowers(_PRIME_BASE, _PRIME_INVERSE)
#: Bytes as small numbers, so that a sum of 2^22 of their products with powers of the prime stays below 2^63.
_SMALL = np.arange(1, 257, dtype=np.uint16)
_SMALL_LOWER = _SMALL.copy()
_SMALL_LOWER[65:91] = _SMALL[97:123]


def _prime_hashes(small: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo the prime of the runs ``begin:stop``, wherever they stand."""
    up, down = _PRIMES.upto(len(small))
    total = np.multiply(small, up, dtype=U64)
    if len(total) > 1 << 22:
        total %= U64(_PRIME)
    np.cumsum(total, out=total)
    before = np.where(begin > 0, total[begin - 1], U64(0))
    return (total[stop - 1] - before) % U64(_PRIME) * down[begin] % U64(_PRIME)


@dataclass
class Words:
    """Words of a batch of texts: ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray      # bytes of all texts
    offsets: np.ndarray   # bytes of text d: offsets[d]:offsets[d + 1]
    starts: np.ndarray    # byte range of each word
    ends: np.ndarray
    hashes: np.ndarray    # uint64
    first: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start positions of all windows of ``n`` words inside one text, and their hashes."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(total)
        at = np.flatnonzero(left >= n)
        return at, self.window_hashes(at, n)

    def window_hashes(self, at: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the windows of ``n`` words that start at the word positions ``at``."""
        out = np.zeros(len(at), U64)
        power = _powers(_WINDOW, n)
        for k in range(n) if n <= 8 else ():
            out += self.hashes[at + k] * power[k]
        if n > 8:
            for low in range(0, len(self.hashes), SLICE):
                own = slice(*np.searchsorted(at, [low, low + SLICE]))
                part = self.hashes[low:low + SLICE + n]
                up, down = _WORDS.upto(len(part))
                total = np.concatenate([np.zeros(1, U64), np.cumsum(part * up, dtype=U64)])
                here = at[own] - low
                out[own] = (total[here + n] - total[here]) * down[here]
        return mix(out ^ U64(n))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its texts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> list[int]:
    """Ends of slices of about SLICE bytes that split no word."""
    ends, at, size = [], 0, len(data)
    while at < size:
        end = min(at + SLICE, size)
        if end < size:
            border = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            if border <= at:  # inside one long text: after its last white space
                spaces = np.flatnonzero(space[data[at:end]])
                if len(spaces):
                    border = at + int(spaces[-1]) + 1
                else:
                    stop = int(offsets[np.searchsorted(offsets, end, "left")])
                    spaces = np.flatnonzero(space[data[end:stop]])
                    border = end + int(spaces[0]) if len(spaces) else stop
            end = border
        ends.append(end)
        at = end
    return ends


def split_words(texts: pa.Array, lower: bool = False, space: np.ndarray = SPACE, places: bool = True) -> Words:
    """Words of every text; ``lower`` hashes A-Z as a-z (positions stay those of the text).

    ``space`` is the 256-entry mask of the bytes that part words. Without ``places`` the byte ranges of the
    words are not kept.
    """
    data, offsets = text_bytes(texts)
    values, small = (_BYTE_LOWER, _SMALL_LOWER) if lower else (_BYTE, _SMALL)
    starts, ends, hashes = [], [], []
    first = np.zeros(len(offsets), np.int64)
    at = known = 0
    for end in _cuts(data, offsets, space):
        part = data[at:end]
        word = ~space[part]
        borders = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        before = np.empty_like(word)
        before[0], before[1:] = False, word[:-1]
        before[borders] = False
        after = np.empty_like(word)
        after[-1], after[:-1] = False, word[1:]
        after[borders[borders > 0] - 1] = False
        begin, stop = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        up, down = _BYTES.upto(len(part))
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * up, out=total[1:])
        joined = (total[stop] - total[begin]) * down[begin] + (stop - begin).astype(U64)
        joined += mix(_prime_hashes(small[part], begin, stop)) * _JOIN
        hashes.append(mix(joined))
        here = slice(*np.searchsorted(offsets, [at, end]))
        first[here] = known + np.searchsorted(begin, offsets[here] - at)
        known += len(begin)
        if places:
            starts.append(begin + at)
            ends.append(stop + at)
        at = end
    first[np.searchsorted(offsets, at):] = known
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return Words(data, offsets, join(starts, np.int64), join(ends, np.int64), join(hashes, U64), first)


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each range ``first[d]:first[d + 1]``."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``n`` words starting at one of ``at``."""
    if not len(at):
        return np.zeros(total, bool)
    steps = np.bincount(at, minlength=total + 1) - np.bincount(at + n, minlength=total + 1)
    return np.cumsum(steps)[:total] > 0
