"""Words of many texts as arrays of hashes, so that tasks work on whole batches instead of single words.

A word is a run of bytes other than space and U+0009 to U+000D. Hashes are 64 bits and depend only on the bytes and a
seed; two seeds give 128 bits. A word is read eight bytes at a time; each eight are mixed with their number before they are
added. (Sums of bytes times powers of a base modulo 2**64 would not do: some long words have equal sums for every base.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_CHUNK = 1 << 20
_BASES = {0: 0x9E3779B97F4A7C15, 1: 0xD1342543DE82EF95}
#: Keeps the first 0 to 8 bytes of a little-endian number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_POWERS: dict[tuple[int, int], np.ndarray] = {}
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PUNCTUATION = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256))


def plain(text: str | None) -> bytes:
    """Lower case, ASCII punctuation as blanks; null counts as empty."""
    return (text or "").lower().encode().translate(_PUNCTUATION)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int, inverse: bool) -> np.ndarray:
    """The first ``n`` powers of a base (or of its inverse) modulo 2**64."""
    known = _POWERS.get((base, inverse))
    if known is None or len(known) < n:
        step = np.full(max(n, _CHUNK + 1), pow(base, -1, 2**64) if inverse else base, np.uint64)
        step[0] = 1
        known = np.cumprod(step, dtype=np.uint64)
        if len(known) <= 4 * _CHUNK:
            _POWERS[base, inverse] = known
    return known[:n]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of each ``values[start:end]`` from one running sum."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values), False), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _powers(base, len(values) + 1, True)[starts])


@dataclass
class Words:
    """Words of a batch of texts. Text ``i`` owns the words ``first[i]`` to ``first[i + 1]``; offsets count bytes of ``blob``."""

    blob: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, seed: int = 0) -> np.ndarray:
        """One hash per word, computed piecewise so that a very long text or word needs no array of its size."""
        sizes, out, base = self.ends - self.starts, np.zeros(len(self.starts), np.uint64), np.uint64(_BASES[seed])
        padded = self.blob + bytes(8)
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
        parts = -(-sizes // 8)
        done = np.cumsum(parts)
        with np.errstate(over="ignore"):
            for low in range(0, int(done[-1]) if len(done) else 0, _CHUNK >> 2):
                high = min(low + (_CHUNK >> 2), int(done[-1]))
                a, b = np.searchsorted(done, [low, high - 1], "right") + [0, 1]
                begin = done[a:b] - parts[a:b]
                held = np.minimum(done[a:b], high) - np.maximum(begin, low)
                number = np.arange(low, high) - np.repeat(begin, held)
                at = np.repeat(self.starts[a:b], held) + 8 * number
                kept = _FIRST_BYTES[np.minimum(np.repeat(self.ends[a:b], held) - at, 8)]
                mixed = mix((eight[at] & kept) + (number + 1).astype(np.uint64) * base)
                out[a:b] += np.add.reduceat(mixed, np.cumsum(held) - held)
            return mix(out + sizes.astype(np.uint64) * base)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """How many words each word's text has from it on, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def by_size(sizes: list[int], limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of a batch whose sizes add up to about ``limit``; an item above it is a range of its own."""
    low, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield low, i
            low, held = i, 0
        held += size + 1
    if low < len(sizes):
        yield low, len(sizes)


def words_of(texts: list[bytes]) -> Words:
    """Split a batch of UTF-8 texts."""
    blob = b"\n".join(texts)
    blank = np.ones(len(blob) + 2, bool)
    blank[1:-1] = _BLANK[np.frombuffer(blob, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return Words(blob, starts, ends, np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))


def window_hashes(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` words, also those that cross texts; element ``i`` starts at word ``i``."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, out = _BASES[seed], np.zeros(n, np.uint64)
    for low in range(0, n, _CHUNK):
        high = min(n, low + _CHUNK)
        at = np.arange(high - low)
        out[low:high] = _spans(hashes[low : high + length - 1], at, at + length, base)
    with np.errstate(over="ignore"):
        return mix(out + np.uint64(length))
