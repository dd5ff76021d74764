"""JSON-array snapshots larger than a task (S1): one file, many tasks.

Spark's reader takes a JSON array as one record.  Here a file is cut into ranges of
bytes.  A first pass counts, per range, the quotes and how far brackets open or close
(for a range that begins inside a string and for one that does not); one row per range
is added up per file, and tells every range where it begins.  A second pass then
picks the elements that begin in each range, and Spark parses them one by one with
``from_json``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.functions.scalar import date_from_name
from zonekit.sources import schemas

RANGE_BYTES = 64 << 20
#: more ranges than this share tasks
_TASKS = 100_000


def _open(path: str):
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _quotes(data: np.ndarray, before: bytes) -> np.ndarray:
    """True at every quote that opens or closes a string; ``before`` ends with the backslashes ahead of ``data``."""
    quote = data == ord('"')
    run = len(before) - len(before.rstrip(b"\\"))
    at = np.arange(len(data))
    other = np.where(data != ord("\\"), at, -1)
    last = np.maximum.accumulate(np.concatenate([[-1], other]))[:-1]  # the last byte ahead that is no backslash
    behind = at - 1 - last + np.where(last < 0, run, 0)
    return quote & (behind % 2 == 0)


def _depths(data: np.ndarray, quotes: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """(change of depth by each byte, whether it is in a string)."""
    held = (np.cumsum(quotes) - quotes + inside) % 2 == 1
    step = np.isin(data, (ord("["), ord("{"))).astype(np.int64) - np.isin(data, (ord("]"), ord("}")))
    return np.where(held, 0, step), held


def _lookback(source, start: int) -> bytes:
    size = 1024
    while start:
        size = min(size, start)
        source.seek(start - size)
        raw = source.read(size)
        if size == start or raw.strip(b"\\"):
            return raw
        size *= 2
    return b""


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
            with _open(path) as source:
                before = _lookback(source, start)
                source.seek(start)
                data = np.frombuffer(source.read(end - start), dtype=np.uint8)
            quotes = _quotes(data, before)
            out.append((path, start, end, int(quotes.sum()), *[int(_depths(data, quotes, x)[0].sum()) for x in (False, True)]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["path", "start", "end", "quotes", "plain", "held"])


def _begin(ranges: pd.DataFrame) -> pd.DataFrame:
    """Where every range of one file begins: in a string or not, and how deep."""
    ranges = ranges.sort_values("start")
    inside, depth, rows = False, 0, []
    for r in ranges.itertuples():
        rows.append((r.path, r.start, r.end, inside, depth))
        depth += r.held if inside else r.plain
        inside ^= bool(r.quotes % 2)
    return pd.DataFrame(rows, columns=["path", "start", "end", "inside", "depth"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, end, inside, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with _open(path) as source:
                before = _lookback(source, start)
                source.seek(start)
                raw, reach = source.read(end - start), end - start
                while True:
                    data = np.frombuffer(raw, dtype=np.uint8)
                    step, _ = _depths(data, _quotes(data, before), inside)
                    deep = depth + np.cumsum(step)
                    begins = np.flatnonzero((step > 0) & (deep == 2))
                    begins = begins[begins < reach]
                    ends = np.flatnonzero((step < 0) & (deep == 1))
                    if not len(begins) or (len(ends) and ends[-1] > begins[-1]):
                        break
                    more = source.read(RANGE_BYTES)  # the last element runs into the next range
                    if not more:
                        ends = np.append(ends, len(raw) - 1)  # a cut file: the element is as far as it goes
                        break
                    raw += more
            stops = ends[np.searchsorted(ends, begins)] + 1
            found = [raw[a:b].decode() for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
            for at in range(0, len(found), 10_000):
                part = found[at : at + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array(part)], names=["path", "value"])


def array_elements(spark: SparkSession, path: str, glob: str = "*.json", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, value): the text of every object in the JSON arrays below ``path``, read in ranges of bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes)))
    ranges = files.select("path", start.alias("start"), "length").filter("length > 0")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    # a range is a few bytes as a row but a task's work: dealt one by one, to a number of tasks that is not merged
    tasks = min(_TASKS, ranges.count()) or 1
    ranges = ranges.repartition(tasks)
    scanned = ranges.mapInArrow(_scan, "path string, start long, end long, quotes long, plain long, held long")
    # one row per range, so a group is a file's size over `range_bytes`
    begun = scanned.groupBy("path").applyInPandas(_begin, "path string, start long, end long, inside boolean, depth long")
    return begun.repartition(tasks).mapInArrow(_elements, "path string, value string")


def read_large_json_arrays(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.LISTING_SCHEMA,
    glob: str = "*.json",
    date_col: str = "date",
    strict_dates: bool = True,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """S1 for files larger than a task: the rows of ``readers.read_json_snapshots``.

    An element that cannot be read fails the query."""
    found = array_elements(spark, path, glob, range_bytes)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = found.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row"), date_from_name(name, strict=strict_dates).alias("__zk_date"))
    return rows.select("row.*", "__zk_date").withColumn(date_col, F.col("__zk_date")).drop("__zk_date")
