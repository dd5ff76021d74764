"""Static 3-wise binary fuse filters with 8-bit fingerprints (numpy).

Built once from a set of 64-bit keys and never changed; a key of the set is
always reported, another one with probability 1/256.  Peeling runs in whole
layers: all slots that hold a single key are taken at once, so the work is
linear in the keys and vectorised.
"""

from __future__ import annotations

import math

import numpy as np

from zonekit.llm.wordhash import mix

_HEAD = np.dtype([("seed", "<u8"), ("segment", "<u8"), ("segments", "<u8")])


def _slots(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three slots of each key, in three neighbouring segments."""
    mask = np.uint64(segment - 1)
    first = ((hashes >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (hashes & mask)
    return np.stack([first, second, third], axis=1).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))).astype(np.uint8)


def _seeded(keys: np.ndarray, seed: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) + mix(np.array([seed + 1], dtype=np.uint64)))


def build(keys: np.ndarray) -> bytes:
    """The filter of ``keys`` (duplicates allowed) as bytes; empty for no keys."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    if not n:
        return b""
    log = math.log(max(n, 2))
    segment = 1 << max(2, int(math.floor(log / math.log(3.33) + 2.25)))
    room = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / log)) + 1
    segments = max(1, -(-room // segment) - 2)
    seed = 0
    while True:
        hashes = _seeded(keys, seed)
        slots = _slots(hashes, segment, segments)
        layers = _peel(slots, (segments + 2) * segment)
        if layers is not None:
            break
        seed += 1
        segments += seed > 8  # more room after many failures, so that this ends
    table = np.zeros((segments + 2) * segment, dtype=np.uint8)
    prints = _prints(hashes)
    for key, slot in reversed(layers):
        around = table[slots[key]]
        table[slot] = prints[key] ^ around[:, 0] ^ around[:, 1] ^ around[:, 2]
    return np.array([(seed, segment, segments)], dtype=_HEAD).tobytes() + table.tobytes()


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    n = len(slots)
    count = np.bincount(slots.ravel(), minlength=size)
    held = np.zeros(size, dtype=np.int64)
    for j in range(3):
        np.bitwise_xor.at(held, slots[:, j], np.arange(n))
    layers, done = [], 0
    single = np.flatnonzero(count == 1)
    while len(single):
        key, at = np.unique(held[single], return_index=True)
        layers.append((key, single[at]))
        done += len(key)
        touched = slots[key].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(held, touched, np.repeat(key, 3))
        single = np.unique(touched)
        single = single[count[single] == 1]
    return layers if done == n else None


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """True for every key of the set, and for about one other in 256."""
    if not filter_bytes:
        return np.zeros(len(keys), dtype=bool)
    seed, segment, segments = (int(x) for x in np.frombuffer(filter_bytes[: _HEAD.itemsize], dtype=_HEAD)[0])
    table = np.frombuffer(filter_bytes, dtype=np.uint8, offset=_HEAD.itemsize)
    hashes = _seeded(keys, seed)
    slots = _slots(hashes, segment, segments)
    return (table[slots[:, 0]] ^ table[slots[:, 1]] ^ table[slots[:, 2]]) == _prints(hashes)
