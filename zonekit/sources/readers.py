"""Scans (S1-S9, F4, U1, P1/P2 at read time).

Every reader takes an explicit schema, so there is no inference pass over
the data and snapshots with drifting columns line up by name.  Many
snapshots are read by one multi-path scan (one file listing, one plan)
rather than a union of thousands of per-snapshot plans.

What cannot be read never disappears: by default a cut file, a bad line or
a value that does not fit its column fails the query that reads it
(``on_bad="fail"``).  ``on_bad="keep"`` adds the text of such records as the
column ``BAD``, and ``split_bad`` turns the frame into good rows and a report
of the bad ones with file and place; ``on_bad="null"`` is Spark's own lenient
reading.  JSON arrays are one record a file, so a file with a bad element is bad
as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.functions.scalar import date_from_name, parent_name
from zonekit.sources import schemas

#: column of ``on_bad="keep"``: the text of a record that could not be read, else null
BAD = "__zk_bad_record"

_MODES = {"fail": "FAILFAST", "null": "PERMISSIVE", "keep": "PERMISSIVE"}


def _lenient(reader: DataFrameReader, schema: T.StructType | None, on_bad: str) -> DataFrameReader:
    """``reader`` with ``schema`` and what is to happen to unreadable records."""
    reader = reader.option("mode", _MODES[on_bad])
    if on_bad == "keep":
        reader = reader.option("columnNameOfCorruptRecord", BAD)
        schema = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return reader if schema is None else reader.schema(schema)


def _read_whole(df: DataFrame, on_bad: str) -> DataFrame:
    """Keep every column in the scan of ``on_bad="keep"``: a column that is not read is not found bad either."""
    if on_bad != "keep":
        return df
    always = F.hash(*[F.col(f"`{c}`") for c in df.columns]) <= F.lit(2**31 - 1)
    return df.filter(always)


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad records) of a frame read with ``on_bad="keep"``.

    The report has one row per unreadable record: the file, the first byte of the block of
    the file it was found in, and its text (of a JSON array, the whole file).
    Every record is in one of the two frames.
    """
    good = df.filter(F.col(BAD).isNull()).drop(BAD)
    found = df.filter(F.col(BAD).isNotNull())
    where = F.col("_metadata")
    bad = found.select(where["file_path"].alias("file"), where["file_block_start"].alias("block_start"), F.col(BAD).alias("record"))
    return good, bad


def read_json_snapshots(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.LISTING_SCHEMA,
    glob: str = "*.json",
    date_col: str = "date",
    strict_dates: bool = True,
    on_bad: str = "fail",
) -> DataFrame:
    """S1 + F4 + P1/P2: directory of JSON-array files, one per date.

    Each array element is a row; an empty array gives no row.  The date
    comes from the start of the file name (``YYYY_MM_DD_...``); being an
    expression over ``_metadata.file_name`` only, a filter on it prunes
    whole files before they are opened.  One file is one task (a JSON array
    is not splittable), so many dated files read in parallel.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = _lenient(spark.read, schema, on_bad).option("multiLine", True).option("pathGlobFilter", glob).json(paths)
    df = _read_whole(df, on_bad)
    return df.withColumn(date_col, date_from_name(F.col("_metadata.file_name"), strict=strict_dates))


def read_parquet_snapshots(
    spark: SparkSession,
    root: str,
    schema: T.StructType = schemas.LISTING_SCHEMA,
    date_col: str = "date",
    strict_dates: bool = True,
    pattern: str = "*",
) -> DataFrame:
    """S4 + U1 + F3 + F4: one Parquet directory per date under ``root``.

    One scan over the directories ``root/<pattern>`` with the full schema: a
    snapshot lacking a column yields nulls there (then F1 drops such rows,
    which equals skipping the snapshot).  Only Parquet files are read, so
    loose files next to the snapshots (notes, a README) are not, and Spark
    itself skips ``_``/``.`` files such as ``_SUCCESS``.  The date comes from
    the directory name; a name without one fails unless ``strict_dates`` is
    off, and then gives a null date.
    """
    df = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{root.rstrip('/')}/{pattern}")
    return df.withColumn(date_col, date_from_name(parent_name(F.col("_metadata.file_path")), strict=strict_dates))


def read_drifting_snapshots(
    spark: SparkSession,
    root: str,
    schema: T.StructType = schemas.LISTING_SCHEMA,
    date_col: str = "date",
    strict_dates: bool = True,
) -> DataFrame:
    """S4 + U1 + F3 where a column's type differs between snapshots too.

    One footer per snapshot tells its columns; snapshots of equal columns are one
    scan, read as they were written and cast to ``schema`` (a value that does not
    fit is null, a missing column too), and the scans are united.  Plans grow with
    the number of different layouts, not of snapshots.
    """
    listed = list_files(spark, root.rstrip("/") + "/*", "*.parquet").select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"))
    groups: dict[str, list[str]] = {}
    for folder in sorted(r.folder for r in listed.distinct().collect()):  # names of snapshots, never rows
        groups.setdefault(spark.read.parquet(folder).schema.json(), []).append(folder)
    frames = []
    for layout, folders in groups.items():
        own = T.StructType.fromJson(json.loads(layout))
        df = spark.read.schema(own).parquet(*folders)
        names = set(own.names)
        cells = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        date = date_from_name(parent_name(F.col("_metadata.file_path")), strict=strict_dates)
        frames.append(df.select(*cells, date.alias("__zk_date")).withColumn(date_col, F.col("__zk_date")).drop("__zk_date"))
    return union_snapshots(frames)


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; columns missing from a frame are null."""
    if not frames:
        raise ValueError("no snapshot to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_dir(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    glob: str = "*.csv",
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    on_bad: str = "fail",
) -> DataFrame:
    """CSV files with a header that names the schema's columns in
    their order (quoted names with spaces are fine); a file whose header
    differs fails the read, so swapped columns never pass for each other.
    A UTF-8 byte-order mark at the start of a file is dropped by the reader."""
    paths = [path] if isinstance(path, str) else list(path)
    df = (
        _lenient(spark.read, schema, on_bad)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("pathGlobFilter", glob)
        .csv(paths)
    )
    return _read_whole(df, on_bad)


def read_income_csv(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """Yearly family-income tables."""
    return read_csv_dir(spark, path, schemas.INCOME_CSV_SCHEMA, on_bad=on_bad)


def read_occupancy_csv(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """Household occupancy table (UTF-8 with BOM)."""
    return read_csv_dir(spark, path, schemas.OCCUPANCY_CSV_SCHEMA, on_bad=on_bad)


def read_pair_lookup(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """S3 (scan part): (district, neighborhood) -> (district_id, neighborhood_id)."""
    return read_csv_dir(spark, path, schemas.PAIR_LOOKUP_SCHEMA, glob="*", on_bad=on_bad)


def read_json_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """JSON-lines file(s); splittable, so large files read in parallel.

    Without a schema it is inferred, from the readable lines where bad ones
    are kept or null."""
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None and on_bad == "keep":
        schema = spark.read.option("mode", "DROPMALFORMED").json(paths).schema
    return _read_whole(_lenient(spark.read, schema, on_bad).json(paths), on_bad)


def read_source(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Generic data-source read (``json``, ``parquet``, ``csv``, or a
    connector format available on the cluster)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File paths under ``path`` as a DataFrame (the file listing is done by
    Spark's data source; file contents are not read when not selected)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path")
    )


def register_json_tables(spark: SparkSession, path: str, ext: str = ".json") -> list[str]:
    """One temporary view per JSON-lines file; the file stem is the
    table name.  Only file *names* reach the driver (bounded by the number
    of files), never rows."""
    names = [r.path for r in list_files(spark, path, f"*{ext}").collect()]
    views = []
    for p in sorted(names):
        stem = p.rstrip("/").rsplit("/", 1)[-1][: -len(ext)]
        read_json_lines(spark, p).createOrReplaceTempView(stem)
        views.append(stem)
    return views


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views in the current catalog."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-read a KPI result written by ``sinks.write_single_csv``."""
    return read_csv_dir(spark, path, schema, glob="*.csv")
