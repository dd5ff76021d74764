"""Shared pieces: the shared working folder, staged tables, distributed running totals.

``staged`` cuts lineage by writing a Parquet table into the folder the
cluster names in ``spark.checkpoint.dir``; a lost executor then costs only
a re-read.  Nothing here writes to a machine-local folder on a cluster.
Within ``working_folder`` these tables have an owner, which removes them at the end.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words are maximal runs of characters other than these six (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


_work: ContextVar[str | None] = ContextVar("zonekit_work", default=None)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, in the ``working_folder`` if there is one.

    Only a ``local`` master (tests) may run without that setting; it then
    gets a temporary folder.
    """
    base = _work.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="zonekit-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def working_folder(spark: SparkSession) -> Iterator[str]:
    """Own the tables staged within: they lie in one folder, which is removed at the end.

    What is computed within reads these tables, so write or collect it before the end.
    """
    path = shared_folder(spark, "work")
    before = _work.set(path)
    try:
        yield path
    finally:
        _work.reset(before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` as a staged table, without the tables that it stages itself."""
    path = shared_folder(spark, name)
    with working_folder(spark):
        df = make()
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def row_key(key: Column, body: Column) -> Column:
    """A row's content key: its id and 128 bits of its text; equal for repeated rows only."""
    shown = F.coalesce(key.cast("string"), F.lit(""))
    return F.concat_ws(":", shown, F.xxhash64(body, F.lit(0)).cast("string"), F.xxhash64(body, F.lit(1)).cast("string"))


def keep_rows(df: DataFrame, keys: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` whose ``row_key`` is in ``keys`` (row), one of each, in its columns."""
    row = free_name(df, "row_key")
    marked = df.withColumn(row, row_key(quoted(key), text_or_empty(text)))
    return marked.join(keys.select(F.col("row").alias(row)), row, "left_semi").dropDuplicates([row]).drop(row)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, size in enumerate(sizes):
            if i > start and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str, name: str, parts: int | None = None) -> DataFrame:
    """``df`` with ``out`` = sum of ``value`` over all rows before this one in ``order``.

    Range-partitioned, so no task sees more than its share: the sorted rows
    are written once with the partition they fell into; one row per
    partition gives the offsets (a window over as many rows as there are
    partitions), and a window inside each partition does the rest.
    ``order`` must be total for a repeatable result.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, inner, base = (free_name(df, f"{out}_{x}") for x in ("part", "inner", "base"))
    cut = staged(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()), name)
    sums = cut.groupBy(part).agg(F.sum(value).alias("held"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(part, F.coalesce(F.sum("held").over(before), F.lit(0)).alias(base))
    # one row per partition: at most `parts` rows, whatever the input
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn(inner, F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(offsets), part)
        .withColumn(out, F.col(inner) + F.col(base))
        .drop(part, inner, base)
    )


def running_totals(df: DataFrame, order: Sequence[Column], values: dict[str, str], name: str) -> DataFrame:
    """``running_total`` of several columns in one pass: ``values`` maps each new column to the one it sums."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = free_name(df, "part")
    cut = staged(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()), name)
    sums = cut.groupBy(part).agg(*[F.sum(value).alias(out) for out, value in values.items()])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: at most `parts` rows, whatever the input
    offsets = sums.select(part, *[F.coalesce(F.sum(out).over(before), F.lit(0)).alias(f"{out}_base") for out in values])
    totals = cut.withColumns({out: F.coalesce(F.sum(value).over(within), F.lit(0)) for out, value in values.items()})
    joined = totals.join(F.broadcast(offsets), part).withColumns({out: F.col(out) + F.col(f"{out}_base") for out in values})
    return joined.drop(part, *[f"{out}_base" for out in values])
