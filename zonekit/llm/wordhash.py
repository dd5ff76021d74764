"""Vectorised words, lines and their 64-bit hashes over a block of UTF-8 texts (numpy).

A span is read in lanes of eight bytes; each lane is mixed, then mixed again
with its place, and the sum of all lanes and the length is mixed once more, so
a block costs a handful of array passes whatever its number of words, and
no structure of the text (such as a pattern and its complement) meets in the sum.
Spans are hashed in chunks, so memory stays near the block's own size
even for one very long text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CHUNK = 1 << 20
_PLACE = np.uint64(0x9E3779B97F4A7C15)
# keeps the first n bytes of a lane of eight
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits (wrapping uint64 arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_block(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(off), dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0, target: int = _CHUNK) -> np.ndarray:
    """Hash of each byte span; spans are ascending and do not overlap.

    Hashes of one span under different salts are independent of each other.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    whole = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    # eight bytes from every place on
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=whole.data, strides=(1,))
    seed = mix(np.array([salt + 1], dtype=np.uint64) * _PLACE)[0]
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + target, side="right")))
        a, size = starts[i:j], ends[i:j] - starts[i:j]
        count = np.maximum(1, (size + 7) >> 3)
        head = np.concatenate([[0], np.cumsum(count)[:-1]])
        place = np.arange(int(count.sum())) - np.repeat(head, count)
        at = np.repeat(a, count) + 8 * place
        held = lanes[at] & _FIRST[np.minimum(8, np.repeat(size, count) - 8 * place)]
        spread = mix(mix(held ^ seed) + (place.astype(np.uint64) + np.uint64(1)) * _PLACE)
        out[i:j] = np.add.reduceat(spread, head) + size.astype(np.uint64) * seed
        i = j
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word, a run of other than six white-space characters."""
    solid = ~IS_SPACE[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    # a text never continues the one before
    first = offsets[:-1][offsets[:-1] < len(data)]
    last = offsets[1:][offsets[1:] > 0] - 1
    opens[first], closes[last] = solid[first], solid[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every ``\\n``-split line; a text of n newlines has n + 1 lines."""
    breaks = np.flatnonzero(data == 0x0A)
    n = len(offsets) - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1])
    ends = np.concatenate([offsets[1:], breaks])
    end_doc = np.concatenate([np.arange(n), doc[n:]])
    by_start = np.lexsort((starts, doc))
    by_end = np.lexsort((ends, end_doc))
    return starts[by_start], ends[by_end], doc[by_start]


def window_hashes(hashes: np.ndarray, doc: np.ndarray, size: int, salt: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of ``size`` words inside one document."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    step = np.uint64(0xD6E8FEB86659FD93)
    total = np.full(n, salt, dtype=np.uint64)
    for j in range(size):
        total *= step
        total += hashes[j : j + n]
    return at, mix(total[at])


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    out = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def per_document(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum of ``weights`` (or the count) by document, as int64."""
    return np.bincount(doc, weights, minlength=n).astype(np.int64)[:n]


def span_numbers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same number for equal spans of a block, by their bytes; other numbers for others."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, sizes)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[place])])
    return whole.dictionary_encode().indices.to_numpy().astype(np.int64)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same number for equal pairs of numbers."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


def window_numbers(numbers: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, number) of every run of ``size`` words inside one document; equal runs only have one number."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    held, m = numbers, 1
    while 2 * m <= size:
        held, m = _pairs(held[:-m], held[m:]), 2 * m
    if m < size:  # two windows that overlap
        held = _pairs(held[: len(held) - (size - m)], held[size - m :])
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return at, held[at]
