"""Stored tables that change in part.

A keyed table is a catalog table, partitioned by a hash bucket of its key.
A put or a delete finds the buckets it touches, reads only these, and
replaces only these, by Spark's dynamic partition overwrite: rows are written
beside the table and moved in when the job commits, so a failed job leaves the
table as it was, and files of other buckets stay untouched.  A get reads the buckets
of its keys and no others.  One change of a table at a time is the caller's to ensure.

Batches of an appended table are partitions too: a batch that runs again
replaces itself.  A full refresh is written beside the old state and
published by replacing one view.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.operators.dedup import latest_by_key
from zonekit.operators.keyed import delete_keys, get_rows

BUCKET = "__zk_bucket"
BATCH = "__zk_batch"
_ORDER = "__zk_put"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def _properties(spark: SparkSession, name: str) -> tuple[str, int]:
    """(key, number of buckets) of a keyed table."""
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found["zonekit.key"], int(found["zonekit.buckets"])


def create_keyed(df: DataFrame, name: str, key: str, buckets: int = 64, mode: str = "errorifexists") -> None:
    """K9 create: ``df`` (one row per key) as a keyed table; a bucket is one sorted file.

    Choose ``buckets`` so that one of them is a good task: it is what a change rewrites.
    """
    rows = df.withColumn(BUCKET, _bucket(key, buckets)).repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, f"`{key}`")
    rows.write.mode(mode).partitionBy(BUCKET).format("parquet").saveAsTable(name)
    spark = df.sparkSession
    escaped = key.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('zonekit.key' = '{escaped}', 'zonekit.buckets' = '{buckets}')")


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int = 64, mode: str = "overwrite") -> None:
    """K8: ``df`` as a table bucketed and sorted by ``keys``; joins and groups of two such tables on the keys need no exchange."""
    rows = df.repartition(buckets, *[F.col(f"`{k}`") for k in keys])
    rows.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(name)


def read_keyed(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a keyed table."""
    return spark.table(name).drop(BUCKET)


def get_keyed(spark: SparkSession, name: str, keys: Sequence, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of some keys, from their buckets only."""
    key, buckets = _properties(spark, name)
    table = spark.table(name)
    named = [F.lit(k).cast(table.schema[key].dataType) for k in keys if k is not None]
    wanted = [F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int") for k in named]
    # expressions of literals: folded while planning, so that the scan is pruned
    rows = table.filter(F.col(BUCKET).isin(*wanted)) if wanted else table.limit(0)
    return get_rows(rows.drop(BUCKET), key, keys, columns)


def _touched(rows: DataFrame) -> list[int]:
    """Different buckets: at most as many numbers as the table has buckets."""
    return [r[0] for r in rows.select(BUCKET).distinct().collect()]


def _overwrite_parts(rows: DataFrame, name: str) -> None:
    """Replace the partitions of ``name`` that ``rows`` has, and no others."""
    conf, setting = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(setting)
    conf.set(setting, "dynamic")
    try:
        rows.select(*[F.col(f"`{c}`") for c in rows.sparkSession.table(name).columns]).write.mode("overwrite").insertInto(name)
    finally:
        conf.set(setting, before)


def _replace(merged: DataFrame, name: str, key: str, buckets: list[int]) -> None:
    """Put ``merged`` in the place of the table's rows in ``buckets``."""
    _overwrite_parts(merged.repartition(len(buckets), BUCKET).sortWithinPartitions(BUCKET, f"`{key}`"), name)


def put_rows(updates: DataFrame, name: str, order_by: Sequence[str] | None = None) -> int:
    """K9 put / A3: ``updates`` into a keyed table; returns how many buckets were rewritten.

    Of a key's rows, stored and new, the greatest by ``order_by``, then by the table's
    other columns, stays; without ``order_by`` the new one.  Columns are matched by
    name, missing ones become null.  A put that runs again changes nothing.
    """
    spark = updates.sparkSession
    key, buckets = _properties(spark, name)
    table = spark.table(name)
    new = updates.withColumn(BUCKET, _bucket(key, buckets))
    touched = _touched(new)
    if not touched:
        return 0
    stored = table.filter(F.col(BUCKET).isin(touched)).withColumn(_ORDER, F.lit(0))
    merged = stored.unionByName(new.withColumn(_ORDER, F.lit(1)), allowMissingColumns=True)
    rest = [c for c in table.columns if c not in (key, BUCKET)]
    order = [*order_by, *[c for c in rest if c not in order_by], _ORDER] if order_by else [_ORDER, *rest]
    latest = latest_by_key(merged.select(*table.columns, _ORDER), [key, BUCKET], order).drop(_ORDER)
    _replace(latest, name, key, touched)
    return len(touched)


def delete_rows(spark: SparkSession, name: str, keys: Sequence | DataFrame) -> int:
    """A keyed table without ``keys``; returns how many buckets were rewritten."""
    key, buckets = _properties(spark, name)
    table = spark.table(name)
    if isinstance(keys, DataFrame):
        named = keys.select(F.col(keys.columns[0]).cast(table.schema[key].dataType).alias(key))
    else:
        named = spark.createDataFrame([(k,) for k in keys], f"`{key}` {table.schema[key].dataType.simpleString()}")
    named = named.filter(F.col(f"`{key}`").isNotNull()).withColumn(BUCKET, _bucket(key, buckets))
    gone = table.join(named.distinct(), [key, BUCKET], "left_semi")
    touched = _touched(gone)
    if not touched:
        return 0
    left = delete_keys(table.filter(F.col(BUCKET).isin(touched)), key, named.select(key))
    kept = _touched(left)
    if kept:
        _replace(left, name, key, kept)
    for bucket in sorted(set(touched) - set(kept)):  # a bucket without rows is not written, so its old file goes here
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET} = {bucket})")
    return len(touched)


def append_batch(df: DataFrame, name: str, batch: str) -> None:
    """K6, repeatable: ``df`` as one batch of an appended table.

    A batch that runs again replaces what it wrote before; a failed one leaves
    the table as it was.
    """
    spark = df.sparkSession
    rows = df.withColumn(BATCH, F.lit(batch))
    if not spark.catalog.tableExists(name):
        rows.write.partitionBy(BATCH).format("parquet").saveAsTable(name)
        return
    if rows.isEmpty():
        escaped = batch.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BATCH} = '{escaped}')")
        return
    _overwrite_parts(rows, name)


def replace_all(df: DataFrame, name: str, folder: str, version: str) -> None:
    """K5, repeatable: ``df`` as the whole of ``name``, written to ``folder``/``version`` first.

    ``name`` is a view on one version and changes in one step after the write, so a
    reader sees the old state or the new, and a failed run leaves the old one.
    """
    if not re.fullmatch(r"[\w.-]+", version):
        raise ValueError(f"a version is letters, digits, dots and dashes: {version!r}")
    path = f"{folder.rstrip('/')}/{version}"
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
