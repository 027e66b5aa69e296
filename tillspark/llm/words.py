"""Words of a column of texts as numpy arrays over its UTF-8 bytes.

Both kinds of word in use here are runs of byte classes, because every byte of a character
outside ASCII is 0x80 or above. Splitting and hashing a whole Arrow batch therefore needs no
loop over words. A-Z is lower-cased, nothing else is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
BLOCK = 1 << 19  # bytes hashed at a time: bounds the 8-byte-per-byte work arrays

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for every byte outside the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


NOT_SPACE = _byte_class((0x20, 0x20), (0x09, 0x0D))
LETTERS_AND_DIGITS = _byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


@dataclass
class Words:
    """Words of a batch: byte range, text number and hash of each; first word of each text."""

    data: np.ndarray  # lower-cased bytes of the batch
    offsets: np.ndarray  # where each text begins, and the end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    @cached_property
    def hashes(self) -> np.ndarray:
        return _hashes(self.data, self.starts, self.ends)

    def prefixes(self, size: int) -> np.ndarray:
        """Hash of the first ``size`` bytes of every word (of all, where it has fewer)."""
        return _hashes(self.data, self.starts, np.minimum(self.starts + size, self.ends))

    def counts(self) -> np.ndarray:
        """Number of words of each text."""
        return np.diff(self.first)

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.first[text] : self.first[text + 1]]


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (and the last ends). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, values = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray) -> Words:
    """Words (runs of ``word_bytes``) of every text. A null or empty text has none."""
    raw, offsets = text_bytes(texts)
    data = LOWER[raw]
    inside = word_bytes[data]
    starts, ends = inside.copy(), inside.copy()
    if len(inside):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        begins = offsets[:-1][offsets[:-1] < len(inside)]
        starts[begins] = inside[begins]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        ends[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE), np.full(size, BASE_INVERSE)
    up[0] = down[0] = U64(1)
    return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte range, by differences of one running sum."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, low + BLOCK // 2)))
        size = int(ends[at:to].max() - low)
        up, down = _powers(BLOCK if size <= BLOCK else 1 << (size - 1).bit_length())
        total = np.zeros(size + 1, U64)
        np.cumsum((data[low : low + size].astype(U64) + U64(1)) * up[:size], out=total[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((total[e] - total[s]) * down[s])
        at = to
    return out


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words; all words as one window where there are fewer."""
    if len(hashes) == 0:
        return hashes
    width = min(width, len(hashes))
    size = len(hashes) - width + 1
    total = np.full(size, U64(width))
    for i in range(width):
        total = mix(total * BASE + hashes[i : i + size])
    return total
