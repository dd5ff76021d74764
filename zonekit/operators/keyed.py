"""Keyed-table access.

The wide-row store of the reference is re-aimed at a columnar table with
a key column.  Point gets, multi-gets, prefix scans and equality filters
are predicates Catalyst pushes into the Parquet scan (row-group skipping
via min/max statistics); projections prune columns and nested fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Literal key lists up to this size become an ``IN`` filter pushed to the
# scan; longer ones become a join.  The rows are the same.
PUSHED_KEYS = 1000


def scan(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full scan, or projected to the asked columns (column pruning)."""
    return df if columns is None else df.select(*columns)


def _key_frame(df: DataFrame, key: str, keys: Sequence | DataFrame) -> DataFrame:
    """The distinct non-null keys as a one-column frame."""
    if isinstance(keys, DataFrame):
        right = keys.select(F.col(keys.columns[0]).alias(key))
    else:
        kind = df.schema[key].dataType
        right = df.sparkSession.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(key, kind)]))
    return right.filter(F.col(key).isNotNull()).distinct()


def _short(keys: Sequence | DataFrame) -> bool:
    return not isinstance(keys, DataFrame) and len(keys) <= PUSHED_KEYS


def get_rows(
    df: DataFrame,
    key: str,
    keys: Sequence | DataFrame,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows for one key or a key list; absent keys give no row.

    A short literal list becomes ``key IN (...)`` (pushed to Parquet); a
    longer one, or a key DataFrame, is made distinct (partial aggregation
    before any shuffle) and becomes a left-semi join, with the same rows.
    """
    if _short(keys):
        out = df.filter(F.col(key).isin([k for k in keys if k is not None]))
    else:
        out = df.join(_key_frame(df, key, keys), key, "left_semi")
    return scan(out, columns)


def prefix_scan(df: DataFrame, key: str, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    """rows whose key starts with ``prefix`` (``StringStartsWith`` pushdown)."""
    return scan(df.filter(F.col(key).startswith(prefix)), columns)


def delete_keys(df: DataFrame, key: str, keys: Sequence | DataFrame) -> DataFrame:
    """the table without the given keys; write the result to a new path.

    Only named keys go: a row with a null key stays, and a null among the
    keys deletes nothing, whether the keys are a list or a DataFrame.
    """
    if _short(keys):
        named = F.col(key).isin([k for k in keys if k is not None])
        return df.filter(~F.coalesce(named, F.lit(False)))
    return df.join(_key_frame(df, key, keys), key, "left_anti")


def zone_equals(df: DataFrame, column: str, value, explain: bool = False) -> DataFrame:
    """equality filter; ``explain`` prints the plan (the pushed filter)."""
    out = df.filter(F.col(column) == F.lit(value))
    if explain:
        out.explain()
    return out
