"""Packing along a space-filling curve: neighbours in content share training sequences.

A document's hashed bag of token ids is projected to a few dimensions and
put on a Hilbert curve.  Documents are range-sorted by their curve key and
laid end to end; every ``length`` tokens begin a new sequence, so a document
is cut where a sequence ends and only the last sequence needs padding.

Token ids are computed once and written to the shared folder.  The layout
is a distributed running total over narrow rows (key, id, number of ids),
ties included, so equal documents do not gather in one task; each document's
pieces then follow from its place alone.

Edge cases: a null or empty text has the end id only; repeated rows are
packed each by itself; null ids are packed too; an empty table gives no
piece; further columns are left aside.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm.common import documents, quoted, running_total, staged, text_or_empty, text_slices
from zonekit.llm.wordhash import mix, text_block


@dataclass(frozen=True)
class Packing:
    length: int = 2048
    vocabulary: str = "word_bpe_49k.json"
    end_id: int = 1
    buckets: int = 256
    dimensions: int = 4
    bits: int = 10
    #: a projected coordinate beyond this counts as this
    reach: float = 4.0


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points, shape (n, dimensions), ``bits`` bits each."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    # from axes to the transposed index: undo excess work from the highest bit down
    level = 1 << (bits - 1)
    while level > 1:
        mask = level - 1
        for i in range(dims):
            high = (x[i] & level) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & mask)
            x[0] = np.where(high, x[0] ^ mask, x[0] ^ swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[-1] & level) > 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros_like(flip)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(ids: np.ndarray, sizes: np.ndarray, how: Packing) -> np.ndarray:
    """The curve key of each document from its ids."""
    n = len(sizes)
    bucket = (mix(ids.astype(np.uint64) + np.uint64(5)) % np.uint64(how.buckets)).astype(np.int64)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * how.buckets + bucket, minlength=n * how.buckets).reshape(n, how.buckets)
    vectors = counts / np.sqrt((counts.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    plane = np.random.default_rng(20240611).standard_normal((how.buckets, how.dimensions))
    points = (vectors @ plane + how.reach) / (2 * how.reach)
    top = (1 << how.bits) - 1
    return hilbert_key(np.clip(points * (top + 1), 0, top).astype(np.int64), how.bits)


def tokenised(docs: DataFrame, how: Packing, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, curve, n_ids, ids) of every row, written once; ids are little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zonekit.llm.tokens import tokenizer

        coder = tokenizer(how.vocabulary, how.end_id)
        for batch in text_slices(batches, "body", 1 << 20):
            data, off = text_block(batch.column("body"))
            raw = data.tobytes()
            ids, sizes = coder.encode([raw[a:b] for a, b in zip(off[:-1], off[1:], strict=True)])
            ends = np.concatenate([[0], np.cumsum(sizes)]) * ids.itemsize
            blob = pa.py_buffer(ids.astype(ids.dtype.newbyteorder("<")).tobytes())
            packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), blob])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(curve_keys(ids, sizes, how)),
                    pa.array(sizes.astype(np.int64)),
                    packed.cast(pa.binary()),
                ],
                names=["doc_id", "curve", "n_ids", "ids"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(quoted(key).alias("doc_id"), text_or_empty(text).alias("body"))
    made = rows.mapInArrow(run, f"doc_id {kind}, curve long, n_ids long, ids binary")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "tokens")


def pack(docs: DataFrame, how: Packing | None = None, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit integers.
    """
    how = how or Packing()
    table = tokenised(docs, how, key, text)
    narrow = table.select("row", "doc_id", "curve", "n_ids")
    layout = running_total(narrow, ["curve", "doc_id", "row"], "n_ids", "place", "layout")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids", 4 << 20):
            which, start, length, crc, seq, offset, parts = [], [], [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("place", "n_ids", "ids"))
            for i, (place, n, blob) in enumerate(zip(*columns, strict=True)):
                ids = np.frombuffer(blob, dtype="<u2" if len(blob) == 2 * n else "<u4").astype("<u4")
                at = 0
                while at < n:
                    where = place + at
                    size = min(n - at, how.length - where % how.length)
                    part = ids[at : at + size].tobytes()
                    which.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    seq.append(where // how.length)
                    offset.append(where % how.length)
                    if with_ids:
                        parts.append(part)
                    at += size
            take = pa.array(which, pa.int64())
            arrays = [batch.column("doc_id").take(take)]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            arrays += [batch.column("n_ids").take(take), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays, names = [*arrays, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    placed = table.select("row", "doc_id", "n_ids", "ids").join(layout.select("row", "place"), "row")
    return placed.select("doc_id", "n_ids", "place", "ids").mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def sequences(pieces: DataFrame, how: Packing | None = None, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_ids, ids) from pieces with ids; a sequence has ``length`` ids at most.

    A sequence is padded to ``length`` unless its size is a power of two.
    """
    how = how or Packing()
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    pad = F.lit(int(pad_id).to_bytes(4, "little").hex())
    padded = F.concat(whole, F.unhex(F.repeat(pad, F.lit(how.length) - F.col("n_ids").cast("int"))))
    power = F.bit_count(F.col("n_ids")) == 1
    return rows.select("sequence_id", "n_ids", F.when(power, whole).otherwise(padded).alias("ids"))


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document (contract of operator 9)."""
    return pack(documents(spark, sf_dir).select("doc_id", "text"))
