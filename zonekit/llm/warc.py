"""WARC archives: from whole-file gzip to one gzip member per record, with an offset index.

``write_monolithic`` stores rows as WARC/1.1 records, many records to one
gzip stream (which nobody can seek in).  ``normalise`` inflates each such
file once, as a stream, writes every record as its own gzip member and
returns an index row per record; the same rows lie beside the archive as a
sidecar of JSON lines.  ``read_records`` fetches records by that index.

Archives live in the folder that ``spark.checkpoint.dir`` names and are
opened by ``pyarrow.fs`` (file, hdfs, s3 and gs addresses).  A task writes
under a name of its own and reports it only when the file is whole, so a
lost executor or a second attempt leaves at most a file that nothing lists.

Memory is bounded by one record's header and a chunk while normalising, and
by one record while reading.

Edge cases: a null html is an empty payload and a null url an empty address;
a null page_id is written as such and never a group's largest; rows that
repeat the largest page_id of a group are all responses; an empty table
makes no archive and an empty result; further columns are left aside.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm.common import shared_folder, staged

# Fixed values of the WARC/1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payload bytes after which a task begins another archive.
FILE_BYTES = 64 << 20
_CHUNK = 1 << 20
_DATE = "1970-01-01T00:00:00Z"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit without it."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", " ".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """(file, records) of the archives made from ``rows`` (page_id, url, payload, refers_to), staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        out, squeeze, name, held, count = None, None, "", 0, 0

        def close() -> None:
            out.write(squeeze.flush())
            out.close()
            done.append((name, count))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, held, count = f"whole-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    squeeze = zlib.compressobj(wbits=31)
                out.write(squeeze.compress(record(row["page_id"], row["url"], row["payload"], row["refers_to"])))
                held += len(row["payload"])
                count += 1
                if held >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        files, counts = [f for f, _ in done], [n for _, n in done]
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(counts, pa.int64())], names=["file", "records"])

    columns = rows.select("page_id", "url", "payload", "refers_to")
    return staged(columns.mapInArrow(run, "file string, records long"), "archives")


class _Inflated:
    """The decompressed bytes of a gzip file, member after member, read in chunks."""

    def __init__(self, source) -> None:
        self._source = source
        self._inflate = zlib.decompressobj(wbits=31)
        self._held = bytearray()
        self._ended = False

    def _more(self) -> bool:
        raw = self._inflate.unconsumed_tail or self._inflate.unused_data
        if self._inflate.eof:
            self._inflate = zlib.decompressobj(wbits=31)
        if not raw:
            raw = self._source.read(_CHUNK)
        if not raw:
            self._ended = True
            return False
        self._held += self._inflate.decompress(raw, _CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end."""
        seen = 0
        while (at := self._held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self._held)
            if not self._more():
                if self._held.strip():
                    raise ValueError("the archive ends within a record's header")
                return None
        out = bytes(self._held[: at + len(mark)])
        del self._held[: at + len(mark)]
        return out

    def exactly(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces."""
        while size:
            if not self._held and not self._more():
                raise ValueError("the archive ends within a record")
            piece = bytes(self._held[:size])
            del self._held[: len(piece)]
            size -= len(piece)
            if piece:
                yield piece


def normalise_stream(source, sink) -> Iterator[dict]:
    """Rewrite one archive from ``source`` to ``sink``, a member per record; yields index entries."""
    stream, offset = _Inflated(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        fields = header_fields(head)
        squeeze, length = zlib.compressobj(wbits=31), 0
        size = int(fields["content-length"])

        def put(piece: bytes) -> int:
            sink.write(piece)
            return len(piece)

        length += put(squeeze.compress(head))
        for piece in stream.exactly(size):
            length += put(squeeze.compress(piece))
        length += put(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
        yield {
            "offset": offset,
            "length": length,
            "record_id": fields.get("warc-record-id", ""),
            "type": fields.get("warc-type", ""),
            "target": fields.get("warc-target-uri", ""),
            "digest": fields.get("warc-payload-digest", ""),
        }
        offset += length
        for _ in stream.exactly(4):  # the two line ends after the block
            pass


_INDEX = "file string, offset long, length long, record_id string, type string, target string, digest string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """The index of the rewritten archives, staged; each also has a sidecar ``<file>.idx``."""
    names = ["file", "offset", "length", "record_id", "type", "target", "digest"]
    types = [pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                made = f"records-{uuid.uuid4().hex}.warc.gz"
                source = store.open_input_stream(f"{base}/{file}", compression=None)
                sink = store.open_output_stream(f"{base}/{made}", compression=None)
                side = store.open_output_stream(f"{base}/{made}.idx", compression=None)
                entries: list[dict] = []
                with source, sink, side:
                    for entry in normalise_stream(source, sink):
                        side.write((json.dumps(entry) + "\n").encode())
                        entries.append({"file": made, **entry})
                        if len(entries) == 10_000:
                            yield _batch(entries, names, types)
                            entries = []
                yield _batch(entries, names, types)

    parts = max(1, min(archives.count(), 100_000))
    return staged(archives.select("file").repartition(parts).mapInArrow(run, _INDEX), "index")


def _batch(rows: list[dict], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, file, offset[, payload]) by the index.

    A response's payload is hashed again and held against its header.
    """
    spark = index.sparkSession
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, offset long"
    if with_payload:
        names, types, schema = [*names, "payload"], [*types, pa.binary()], schema + ", payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, handle = None, None
        for batch in batches:
            rows, held = [], 0
            for entry in batch.to_pylist():
                if entry["file"] != name:
                    name, handle = entry["file"], store.open_input_file(f"{base}/{entry['file']}")
                handle.seek(entry["offset"])
                whole = zlib.decompress(handle.read(entry["length"]), wbits=31)
                rows.append({**_parsed(whole), "file": name, "offset": entry["offset"]})
                held += len(whole)
                if held >= 8 * _CHUNK and with_payload:
                    yield _batch(rows, names, types)
                    rows, held = [], 0
            yield _batch(rows, names, types)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    return placed.sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def _parsed(whole: bytes) -> dict:
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = header_fields(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload and digest differ in {fields['warc-record-id']}")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "payload_bytes": int(header_fields(b"\r\n" + http.partition(b"\r\n")[2])["content-length"]),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields["warc-refers-to"]) if revisit else None,
        "payload": payload,
    }


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads the largest page_id is stored, others refer to it."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    groups = (
        keyed.filter(F.col("size") >= least_bytes)
        .groupBy("sha1", "size")
        .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and top is not null")
        .drop("n")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))
    return keyed.join(groups, ["sha1", "size"], "left").select(
        "page_id", "url", "payload", F.when(later & F.col("top").isNotNull(), F.col("top")).alias("refers_to")
    )


def op6_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives, normalised and read back (contract of operator 6)."""
    folder = shared_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index = normalise(write_monolithic(with_revisits(pages), folder), folder)
    return read_records(index, folder).drop("file", "offset")
