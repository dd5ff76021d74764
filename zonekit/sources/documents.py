"""A document source behind Spark's data source interface.

``spark.read.format("zonekit_documents")`` reads collections of documents, a folder
with JSON-lines files per collection as a document store exports them, with the fields
asked for by ``schema``:

    register(spark)
    spark.read.format("zonekit_documents").schema("neigh_name string, info array<...>") \\
        .option("path", "hdfs://.../dump").option("collection", "income").load()

Files are cut into ranges of ``rangeBytes`` bytes, one partition each, so one large file is read by many
tasks.  Equality, list and presence filters on top-level fields are applied while
documents are read, before rows are made of them; all others stay with Spark.  A
line that is no document, or a value that does not fit its field, fails the read.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

FORMAT = "zonekit_documents"
_BATCH = 10_000


@dataclass
class Range(InputPartition):
    """Documents whose line begins in these bytes of a file."""

    path: str
    start: int
    end: int


class DocumentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema = schema
        self.path = options["path"].rstrip("/") + ("/" + options["collection"] if options.get("collection") else "")
        self.range_bytes = int(options.get("rangebytes", 64 << 20))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, IsNotNull)) and len(f.attribute) == 1 and _plain(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        files = [store.get_file_info(root)] if store.get_file_info(root).is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        named = sorted((f.path, f.size) for f in files if f.is_file and f.base_name.endswith((".json", ".jsonl")))
        return [Range(p, at, min(at + self.range_bytes, size)) for p, size in named for at in range(0, size, self.range_bytes)]

    def read(self, partition: Range) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        held: list[dict] = []
        for line in self._lines(partition):
            found = json.loads(line)
            if all(_passes(found.get(f.attribute[0]), f) for f in self.filters):
                held.append({name: found.get(name) for name in schema.names})
            if len(held) == _BATCH:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    def _lines(self, part: Range) -> Iterator[bytes]:
        """The lines that begin within the range, whole."""
        from pyarrow import fs

        store = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path else fs.LocalFileSystem()
        with store.open_input_file(part.path) as raw:
            begin = part.start
            if begin:  # the line that runs into the range belongs to the one before
                raw.seek(begin - 1)
            source = io.BufferedReader(raw, 1 << 20)
            at = begin
            if begin:
                at = begin - 1 + len(source.readline())
            while at < part.end:
                line = source.readline()
                if not line:
                    return
                at += len(line)
                if line.strip():
                    yield line


def _plain(f: Filter) -> bool:
    """Whether the filter's values are ones that JSON has itself."""
    values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else []
    return all(isinstance(v, (str, int, float, bool)) for v in values)


def _passes(value: object, f: Filter) -> bool:
    if value is None:
        return False
    if isinstance(f, IsNotNull):
        return True
    return value == f.value if isinstance(f, EqualTo) else value in f.value


class DocumentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("name the fields to read with .schema(...)")

    def reader(self, schema: StructType) -> DataSourceReader:
        return DocumentReader(schema, {k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with its filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentSource)
