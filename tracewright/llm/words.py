"""Words of many texts at once, as arrays: the shared ground of the text operators.

A block of texts becomes one byte buffer, every text followed by a space. Words are runs of
bytes outside the separators, found and hashed without a Python loop over words. A hash is
64 bits: a polynomial over random byte values, mixed with the word's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: 0x09-0x0D and the space separate words.
BLANKS = bytes([9, 10, 11, 12, 13, 32])

_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[list(BLANKS)] = True
#: All ASCII but digits and letters separates words too.
_OUTSIDE = _SEPARATES.copy()
_OUTSIDE[:128] = [not chr(i).isalnum() for i in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD95)  # odd
GRAM_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def blobs(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's texts as UTF-8; a null is an empty text."""
    return [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]


@dataclass
class Words:
    """Words of a block: byte range, text number and hash of each, in order."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    texts: int

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.text, minlength=self.texts)

    def firsts(self) -> np.ndarray:
        """Number of the first word of each text, and the number of all words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts())))


def _hashes(buffer: np.ndarray, inside: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _STEP, dtype=np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    values = _VALUES[buffer[inside]] * powers[within]
    return mix(np.add.reduceat(values, first) ^ mix(lengths.astype(np.uint64)))


def find_words(
    texts: list[bytes], lower: bool = False, letters: bool = False, block: int = 1 << 20,
) -> Words:
    """Words between blanks, or runs of digits, letters and non-ASCII bytes if ``letters``;
    ``lower`` folds A-Z only. Hashing works on blocks of about
    ``block`` bytes, so that a very long text needs little besides its word hashes."""
    buffer = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    if lower:
        buffer = _LOWER[buffer]
    inside = ~(_OUTSIDE if letters else _SEPARATES)[buffer]
    turns = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = turns[::2], turns[1::2]
    limits = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
    owner = np.searchsorted(limits, starts, side="right").astype(np.int32)
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + block)))
        low, high = starts[at], ends[to - 1]
        own = np.flatnonzero(inside[low:high]) + low
        hashes[at:to] = _hashes(buffer, own, ends[at:to] - starts[at:to])
        at = to
    return Words(buffer, starts, ends, owner, hashes, len(texts))


def grams(hashes: np.ndarray, size: int, step: np.uint64 = GRAM_STEPS[0]) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values; empty where there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for shift in range(1, size):
        out *= step
        out += hashes[shift:shift + n]
    return mix(out)


def whole_grams(words: Words, size: int) -> np.ndarray:
    """Numbers of the words that start a run of ``size`` words inside one text."""
    n = len(words.text) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(words.text[:n] == words.text[size - 1:])


def prefix_hashes(words: Words, which: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of the chosen words; the whole of shorter ones."""
    out = np.zeros(len(which), dtype=np.uint64)
    starts, ends = words.starts[which], words.ends[which]
    power = 1
    for place in range(size):
        live = starts + place < ends
        out[live] += _VALUES[words.buffer[starts[live] + place]] * np.uint64(power)
        power = power * int(_STEP) % (1 << 64)
    return mix(out + np.uint64(size))
