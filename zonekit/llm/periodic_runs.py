"""Periodic runs of words, found online by dyadic square catching.

Words are appended to a stream.  Every aligned block of ``m`` words
(``m`` a power of two) that is complete gets a catcher for the periods
``q`` of its level: the catcher compares the last ``m`` words appended with
its block whenever they lie ``q`` words behind it.  A repetition of length
``max(least, 2 * q)`` or more holds a complete block of its level together
with the block's repeat, so some catcher sees it.  A caught pair is extended
word by word to both sides; what touches the end of the stream stays open
and goes on with the words that follow.  A stretch is a square once it has
``2 * q`` words; the squares of one period merge into maximal runs, and of
runs over the same words the least period counts.

Suffix comparisons read window hashes that double from level to level (one
pass per level, all catchers at once); every extension compares words, so
hashes decide nothing.  Catchers inside a known run whose period divides
theirs would only find that run again and are passed over, which keeps a
text of one repeated word linear.

Texts are independent: each task appends its own documents, set apart by
words that occur once, and nothing is shuffled.

Edge cases: null and empty texts have no word and no run; a document without
id is never rewritten by ``planted``; repeated rows each come back; a very long
text is one stream, appended in pieces; an empty table gives an empty
result; further columns are left aside.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from zonekit.llm.common import documents, quoted, text_or_empty, text_slices
from zonekit.llm.wordhash import mix, span_numbers, text_block, words

#: words appended at once
PIECE = 1 << 16


@dataclass(frozen=True)
class Run:
    start: int
    length: int
    period: int


class SquareCatchers:
    """Catchers over a growing stream of word numbers; ``longest`` bounds the length of a run."""

    def __init__(self, least: int = 12, longest: int | None = None):
        self.least, self.longest = least, longest
        self.words = np.zeros(0, dtype=np.int64)
        self._hashes: dict[int, np.ndarray] = {}
        self._open: dict[tuple[int, int], int] = {}  # (start, period) -> end, of stretches that touch the end
        self._found: dict[tuple[int, int], int] = {}  # (start, end) -> least period

    def _levels(self) -> Iterator[tuple[int, int, int]]:
        """(block size, first period, last period) over all periods that lie within the stream."""
        low = 1
        while low < len(self.words) and (self.longest is None or 2 * low <= self.longest):
            m = self._block(low)
            high = 4 * m - 2 if 2 * low >= self.least else low  # as far as the block's size is the same
            while 2 * high < self.least and self._block(high + 1) == m:
                high += 1
            high = high if self.longest is None else min(high, self.longest // 2)
            yield m, low, high
            low = high + 1

    def _block(self, period: int) -> int:
        """The largest block that every run of ``period`` holds, aligned, along with its repeat."""
        reach = max(self.least, 2 * period) - period
        return 1 << (((reach + 1) // 2).bit_length() - 1)

    def _windows(self, m: int) -> np.ndarray:
        """Hashes of all complete windows of ``m`` words."""
        held = self._hashes.get(m, np.zeros(0, dtype=np.uint64))
        n = max(0, len(self.words) - m + 1)
        if len(held) < n:
            new = np.arange(len(held), n)
            if m == 1:
                fresh = mix(self.words[new].view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            else:
                half = self._windows(m // 2)
                first, second = half[len(held) : n], half[len(held) + m // 2 : n + m // 2]
                fresh = mix(first * np.uint64(0xD6E8FEB86659FD93) + second)
            held = self._hashes[m] = np.concatenate([held, fresh])
        return held

    def append(self, more: np.ndarray) -> None:
        """Append word numbers and advance every catcher over them."""
        before = len(self.words)
        self.words = np.concatenate([self.words, np.asarray(more, dtype=np.int64)])
        opened, self._open = self._open, {}
        for (start, period), end in opened.items():
            if self._found.get((start, end)) == period:
                del self._found[start, end]  # an open run that may grow
            self._keep(start, self._right(end, period), period)
        for m, low, high in self._levels():
            self._advance(m, low, high, max(0, before - m + 1))

    def _advance(self, m: int, low: int, high: int, seen: int) -> None:
        """Compare the windows from ``seen`` on with the blocks ``low`` to ``high`` words before them."""
        hashes = self._windows(m)
        n, width = len(hashes), high - low + 1
        first = max(0, seen - high) // m * m
        blocks = np.arange(first, max(0, n - low), m)
        if not len(blocks):
            return
        ahead = np.lib.stride_tricks.sliding_window_view(np.concatenate([hashes[first:], np.zeros(high + 1, dtype=np.uint64)]), width)[low::m]
        hits = []
        step = max(1, (1 << 20) // width)
        for i in range(0, len(blocks), step):
            b, j = np.nonzero(ahead[i : i + step][: len(blocks) - i] == hashes[blocks[i : i + step]][:, None])
            at, q = blocks[i + b], j + low
            fresh = (at + q >= seen) & (at + q < n)
            hits.append(np.stack([at[fresh], q[fresh]]))
        at, q = np.concatenate(hits, axis=1)
        if not len(at):
            return
        known = [(i, j, p) for (i, j), p in self._found.items() if j > first]
        at, q = self._passed_over(at, q, m, known)
        order = np.lexsort((at, q))
        at, q = at[order], q[order]
        cuts = np.append(np.flatnonzero(np.diff(q, prepend=-1)), len(q))
        fresh_runs: list[tuple[int, int, int]] = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            period, places = int(q[lo]), at[lo:hi]
            if fresh_runs:
                places, _ = self._passed_over(places, q[lo:hi], m, fresh_runs)
            reached = -1
            while len(places):
                place = int(places[0])
                end = self._right(place + period, period)
                if end >= place + period + m and end > reached:
                    start = self._left(place, period)
                    if self._keep(start, end, period):
                        fresh_runs.append((start, end, period))
                    reached = end
                # the blocks whose repeat lies in this stretch have been caught with it
                places = places[max(1, int(np.searchsorted(places, max(end, place + period + m) - period - m, side="right"))) :]

    def _passed_over(self, at: np.ndarray, q: np.ndarray, m: int, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Without the catches inside one of ``runs`` whose period divides theirs; ``at`` ascends."""
        drop = np.zeros(len(at), dtype=bool)
        for start, end, period in runs:
            lo, hi = np.searchsorted(at, [start, end])
            inside = slice(lo, hi)
            drop[inside] |= (at[inside] + q[inside] + m <= end) & (q[inside] % period == 0) & (q[inside] > period)
        return at[~drop], q[~drop]

    def _right(self, end: int, period: int) -> int:
        """How far from word ``end`` on every word equals the one ``period`` before."""
        step, n = 16, len(self.words)
        while end < n:
            stop = min(n, end + step)
            same = self.words[end:stop] == self.words[end - period : stop - period]
            if not same.all():
                return end + int(np.argmin(same))
            end, step = stop, 2 * step
        return end

    def _left(self, start: int, period: int) -> int:
        """The first word from which on up to ``start`` every word equals the one ``period`` after."""
        step = 16
        while start > 0:
            stop = max(0, start - step)
            same = (self.words[stop:start] == self.words[stop + period : start + period])[::-1]
            if not same.all():
                return start - int(np.argmin(same))
            start, step = stop, 2 * step
        return start

    def _keep(self, start: int, end: int, period: int) -> bool:
        """Report the stretch if it is a square, leave it open if it touches the end of the stream."""
        if end == len(self.words):
            self._open[start, period] = end
        if end - start < max(self.least, 2 * period):
            return False
        held = self._found.get((start, end))
        self._found[start, end] = min(period, held or period)
        return True

    def runs(self) -> list[Run]:
        """All runs so far, by start, then period."""
        return sorted((Run(i, j - i, p) for (i, j), p in self._found.items()), key=lambda r: (r.start, r.period))


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which original word each word of a document becomes; None if all stay (a fixed rule of the contract)."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def block_runs(numbers: list[np.ndarray], least: int = 12) -> list[list[Run]]:
    """The runs of several documents, each given as word numbers, appended to one stream."""
    sizes = [len(x) for x in numbers]
    catchers = SquareCatchers(least, max(sizes, default=0))
    begins, parts, at = [], [], 0
    for i, x in enumerate(numbers):
        begins.append(at)
        parts += [x, np.array([-1 - i])]  # no other document has this word
        at += len(x) + 1
    stream = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    for i in range(0, len(stream), PIECE):
        catchers.append(stream[i : i + PIECE])
    out: list[list[Run]] = [[] for _ in numbers]
    for run in catchers.runs():
        i = int(np.searchsorted(begins, run.start, side="right")) - 1
        out[i].append(Run(run.start - begins[i], run.length, run.period))
    return out


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """True for each of ``n`` words that no run holds after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for run in runs:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    return np.cumsum(edges[:-1]) == 0


FIELDS = [
    ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed_text", pa.string()),
]
SCHEMA = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed_text string"
)


def _described(joined: bytes, n: int, runs: list[Run]) -> dict:
    best = min(runs, key=lambda r: (-r.length, r.start, r.period), default=None)
    listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    return {
        "n_words": n,
        "n_runs": len(runs),
        "start": best and best.start,
        "length": best and best.length,
        "period": best and best.period,
        "exponent_milli": best and 1000 * best.length // best.period,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(joined).hexdigest(),
        "runs": [vars(r) for r in runs],
        "collapsed_text": joined,
    }


def collapse(texts: pa.Array, ids: list | None = None, least: int = 12) -> list[dict]:
    """``FIELDS`` of every text; ``ids`` plants repetitions by ``planted``."""
    data, off = text_block(texts)
    start, end, doc = words(data, off)
    numbers = span_numbers(data, start, end)
    cuts = np.searchsorted(doc, np.arange(len(off)))
    places = []
    for i in range(len(off) - 1):
        n = int(cuts[i + 1] - cuts[i])
        place = planted(n, ids[i]) if ids is not None else None
        places.append(np.arange(cuts[i], cuts[i + 1]) if place is None else cuts[i] + place)
    out = []
    raw = data.tobytes()
    for place, runs in zip(places, block_runs([numbers[x] for x in places], least), strict=True):
        kept = place[kept_words(len(place), runs)]
        joined = b" ".join([raw[a:b] for a, b in zip(start[kept].tolist(), end[kept].tolist(), strict=True)])
        out.append(_described(joined, len(place), runs))
    return out


def collapsed(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 12, plant: bool = False, texts: bool = True) -> DataFrame:
    """Per row: its id under ``key``'s name and ``SCHEMA``; ``texts`` false leaves out the runs and the text."""
    rows = docs.select(quoted(key).alias("key"), text_or_empty(text).alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    fields = FIELDS if texts else FIELDS[:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 2 << 20):
            made = collapse(batch.column("body"), batch.column("key").to_pylist() if plant else None, least)
            columns = [pa.array([x[name] for x in made], type=pa.binary() if name == "collapsed_text" else t) for name, t in fields]
            columns = [c.cast(t) for c, (_, t) in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names=["key", *[name for name, _ in fields]])

    schema = f"key {kind}, {SCHEMA if texts else SCHEMA.split(', runs array')[0]}"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document (contract of operator 13)."""
    return collapsed(documents(spark, sf_dir), plant=True, texts=False).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"
    )
