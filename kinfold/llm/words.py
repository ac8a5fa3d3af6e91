"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes marked in a table of 256 flags, so every rule whose
separators are ASCII characters can be stated this way (bytes of other characters are
0x80 and above). Texts are taken in groups of a few megabytes: memory follows the group,
or the longest text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

GROUP_BYTES = 4 << 20
LONG_WORD = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def byte_table(separator) -> np.ndarray:
    """True for the bytes that belong to words: those 0x80 and above, and ASCII where ``separator(code)`` is false."""
    return np.array([code >= 0x80 or not separator(code) for code in range(256)])


# Words that white space ends, and words of ASCII letters, digits and all other characters.
SPACED = byte_table(lambda c: c == 0x20 or 0x09 <= c <= 0x0D)
ALPHANUMERIC = byte_table(lambda c: not chr(c).isalnum())
LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)], dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits; equal in, equal out."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a group of texts. ``first[i]:first[i + 1]`` are the words of text ``low + i``."""

    low: int
    high: int
    data: np.ndarray
    text_start: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        size = self.end - self.start
        h = size.astype(np.uint64) * _MULTIPLIER
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        active = np.flatnonzero(size <= LONG_WORD)
        step = 0
        while len(active):
            block = eights[self.start[active] + step] & _MASKS[np.minimum(size[active] - step, 8)]
            h[active] = mix(h[active] ^ block)
            step += 8
            active = active[size[active] > step]
        for i in np.flatnonzero(size > LONG_WORD):
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.start[i]:self.end[i]].tobytes())
        return h

    def owner(self) -> np.ndarray:
        """Place of each word's text within the group."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_groups(column: pa.Array, table: np.ndarray, lower: bool = False,
                group_bytes: int = GROUP_BYTES) -> Iterator[Words]:
    """The words of a column of texts, group by group, in order; every text is in exactly one group."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + group_bytes, "right")) - 1)
        part, bounds = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        if lower:
            part = LOWER[part]
        inside = table[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[bounds] = True
        before = np.concatenate([[False], inside[:-1]]) if len(part) else inside
        after = np.concatenate([inside[1:], [False]]) if len(part) else inside
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Words(low, high, part, bounds[:-1], start, end, np.searchsorted(start, bounds))
        low = high


def windows(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` entries; one entry per start, ``len(h) - length + 1`` in all."""
    n = len(h) - length + 1
    if n <= 0:
        return h[:0]
    out = h[:n].copy()
    for k in range(1, length):
        out = mix(out * _MULTIPLIER + h[k:k + n])
    return out
