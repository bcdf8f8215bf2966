"""Words and word hashes of whole Arrow text columns, by array operations.

Texts are walked as UTF-8 bytes: every separator is ASCII, and bytes of
multi-byte characters always belong to words, so byte classes give the same
words as code-point classes. Work proceeds in slices of a few MB, so memory
does not grow with the batch; a slice holds one text at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

# any byte but white space: the words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# digits, a-z and all bytes of non-ASCII characters, after lower-casing
ALNUM = np.zeros(256, dtype=bool)
ALNUM[ord("0"):ord("9") + 1] = True
ALNUM[ord("a"):ord("z") + 1] = True
ALNUM[128:] = True

# Scripts that are written without blanks, and full-width forms, as code points.
UNSPACED = ((0x0E00, 0x0EFF), (0x0F00, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xA4CF), (0xF900, 0xFAFF),
            (0xFE30, 0xFE4F), (0xFF00, 0xFFEF), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))
# Punctuation of theirs, a separator like ASCII punctuation.
UNSPACED_MARKS = ((0x3000, 0x3004), (0x3008, 0x3020), (0x3030, 0x3030), (0x30FB, 0x30FB), (0xFE30, 0xFE4F),
                  (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65), (0x0E2F, 0x0E2F),
                  (0x0E5A, 0x0E5B), (0x0F0B, 0x0F14), (0x104A, 0x104B), (0x17D4, 0x17DA))

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 256), _BASE, dtype=np.uint64)
        table[0] = 1
        _powers = np.cumprod(table, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of texts ``first`` … ``first + n - 1`` of a batch.

    ``hash``, ``start`` and ``end`` (byte offsets into ``data``) are per word;
    ``bounds`` has n + 1 entries: text i owns words bounds[i] … bounds[i+1].
    ``data`` is the lower-cased bytes of these texts, one after the other.
    """

    first: int
    n: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.bounds))


def slices(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE,
           slice_bytes: int = SLICE_BYTES, single: bool = False) -> Iterator[Words]:
    """Words of every text of a string column; null is the empty text.

    ``single``: a character of a script without blanks is a word, and that
    script's punctuation separates.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + slice_bytes, "right")) - 1)
        yield _words(at, raw[offsets[at]:offsets[stop]], offsets[at:stop + 1] - offsets[at],
                     word_bytes, single)
        at = stop


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of scripts without blanks: first byte, end, whether punctuation."""
    first = np.flatnonzero(data >= 0xE0)
    size = 3 + (data[first] >= 0xF0)
    byte = lambda j: (data[np.minimum(first + j, len(data) - 1)] & 0x3F).astype(np.int64)
    point = np.where(size == 3, ((data[first].astype(np.int64) & 0x0F) << 12) | (byte(1) << 6) | byte(2),
                     ((data[first].astype(np.int64) & 0x07) << 18) | (byte(1) << 12) | (byte(2) << 6) | byte(3))
    inside = lambda ranges: np.any([(point >= a) & (point <= b) for a, b in ranges], axis=0)
    has = inside(UNSPACED)
    return first[has], (first + size)[has], inside(UNSPACED_MARKS)[has]


def _words(first: int, raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray,
           single: bool = False) -> Words:
    data = _LOWER[raw]
    n = len(offsets) - 1
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(first, n, data, none, none, none.astype(np.uint64), np.zeros(n + 1, np.int64))
    inside = word_bytes[data]
    starts = ends = np.zeros(0, np.int64)
    if single and (data >= 0xE0).any():
        starts, ends, mark = _characters(data)
        at, size = starts[mark], (ends - starts)[mark]
        for j in range(4):
            inside[at[size > j] + j] = False
        starts, ends = starts[~mark], ends[~mark]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[starts] = True
    behind = ends[ends < len(data)]
    opens[behind] = inside[behind]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    opens[begin] = inside[begin]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    length = end - start
    hashes = np.zeros(len(start), np.uint64)
    if len(start):
        at = np.concatenate(([0], np.cumsum(length)[:-1]))
        within = np.arange(int(length.sum())) - np.repeat(at, length)
        value = (data[inside].astype(np.uint64) + np.uint64(1)) * \
            _power_table(int(length.max()))[within]
        hashes = mix(np.add.reduceat(value, at) + length.astype(np.uint64))
    bounds = np.searchsorted(start, offsets)
    return Words(first, n, data, start, end, hashes, bounds)


def shingles(words: Words, k: int, whole_if_short: bool = False):
    """Hashes of every run of ``k`` words, with their text.

    Returns ``(text, first_word, hash)`` arrays in order. With
    ``whole_if_short`` a text of 1 to k-1 words gives its whole sequence.
    """
    count = len(words.hash)
    text_of = words.text_of
    if count >= k:
        total = np.zeros(count - k + 1, np.uint64)
        for j in range(k):
            total = mix(total + words.hash[j:count - k + 1 + j])
        keep = text_of[:count - k + 1] == text_of[k - 1:]
        position = np.flatnonzero(keep)
        text, hashes = text_of[position], total[position]
    else:
        position = text = np.zeros(0, np.int64)
        hashes = np.zeros(0, np.uint64)
    if whole_if_short:
        sizes = np.diff(words.bounds)
        short = np.flatnonzero((sizes > 0) & (sizes < k))
        if len(short):
            first = words.bounds[short]
            total = np.zeros(len(short), np.uint64)
            for j in range(k - 1):
                has = sizes[short] > j
                total[has] = mix(total[has] + words.hash[first[has] + j])
            total = mix(total + sizes[short].astype(np.uint64))
            text = np.concatenate((text, short))
            position = np.concatenate((position, first))
            hashes = np.concatenate((hashes, total))
            order = np.argsort(text, kind="stable")
            text, position, hashes = text[order], position[order], hashes[order]
    return text, position, hashes
