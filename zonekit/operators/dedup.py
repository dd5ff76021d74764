"""Latest record per key and upserts (A1, A2, A3, K9 put).

Plan shape: ``max_by(struct(row), struct(order))`` grouped by the key is a
sort-based aggregation with a partial step before the exchange: each map
task keeps one row per key, so a key that holds a third of all rows ships
at most one row per map task, and no group is materialised whole.  For
orderings other than "all descending" the window form is used
(``row_number() = 1``), which Spark plans with a map-side
``WindowGroupLimit`` and has the same property; measured on 1.5M rows the
aggregate form is about twice as fast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RN = "__zk_rn"

# Types a hash aggregation keeps in fixed-width buffers.
_FIXED_WIDTH = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _ident(name: str) -> str:
    """A column name as a quoted SQL identifier (dots, spaces, backticks)."""
    return "`" + name.replace("`", "``") + "`"


def _q(name: str) -> Column:  # shared with reconcile
    """A top-level column by its exact name (dots, spaces, backticks)."""
    return F.col(_ident(name))


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    cols = []
    for o in order_by:
        if isinstance(o, str):
            cols.append(F.col(o).desc_nulls_last())
        else:
            cols.append(o)
    return cols


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    unique_order: bool = False,
) -> DataFrame:
    """Keep one row per ``keys``: the greatest by ``order_by``.

    ``order_by`` entries given as names sort descending (nulls last); pass
    Columns for other directions.  The order must be total over the rows
    of a key (add a tie-breaker column), otherwise the winner of a tie is
    whatever Spark reads first -- the reference leaves ties undefined.

    ``unique_order=True`` states that a single ordering column is unique and
    non-null within each key (e.g. a primary key or a load sequence).  If
    all columns are fixed-width, each column is then taken with its own
    ``max_by``, which Spark runs as a hash aggregation (measured 3x faster
    than the struct form on 15M rows); without that guarantee the columns
    could come from different tied rows, so the struct form is used.
    """
    if (
        unique_order
        and len(order_by) == 1
        and isinstance(order_by[0], str)
        and all(isinstance(f.dataType, _FIXED_WIDTH) for f in df.schema.fields if f.name not in keys)
    ):
        o = _ident(order_by[0])
        aggs = [
            F.expr(f"max({o})" if c == order_by[0] else f"max_by({_ident(c)}, {o})").alias(c)
            for c in df.columns
            if c not in keys
        ]
        return df.groupBy(*[_q(k) for k in keys]).agg(*aggs).selectExpr(*[_ident(c) for c in df.columns])
    if order_by and all(isinstance(o, str) for o in order_by):
        # struct comparison is field by field with null smallest, which is
        # "each column descending, nulls last" for the maximum
        rest = [c for c in df.columns if c not in keys]
        if not rest:
            return df.select(*[_q(k) for k in keys]).distinct()
        # built from SQL text: one parse on the JVM instead of hundreds of Py4J calls
        values = ", ".join(_ident(c) for c in rest)
        order = ", ".join(_ident(o) for o in order_by)
        best = F.expr(f"max_by(struct({values}), struct({order}))")
        return _unpack(df.groupBy(*[_q(k) for k in keys]).agg(best.alias(_RN)), keys, df.columns)
    return latest_by_key_window(df, keys, order_by)


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` (each column
    ascending, nulls last).  ``min_by`` over ``struct(isnull(c), c)`` pairs:
    ``false`` sorts before ``true``, so non-null values come first."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[_q(k) for k in keys]).distinct()
    values = ", ".join(_ident(c) for c in rest)
    order = ", ".join(f"struct({_ident(o)} IS NULL, {_ident(o)})" for o in order_by)
    best = F.expr(f"min_by(struct({values}), struct({order}))")
    return _unpack(df.groupBy(*[_q(k) for k in keys]).agg(best.alias(_RN)), keys, df.columns)


def _unpack(grouped: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys plus the fields of the winning-row struct, in the input's column order."""
    return grouped.selectExpr(
        *[_ident(c) if c in keys else f"{_RN}.{_ident(c)} AS {_ident(c)}" for c in columns]
    )


def latest_by_key_window(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """``latest_by_key`` as ``row_number() = 1`` over the key (any ordering)."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def upsert(
    existing: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """A3 / K9 put: union of stored rows and new rows, last write wins by
    ``order_by``.  Columns are matched by name; missing ones become null."""
    merged = existing.unionByName(updates, allowMissingColumns=True)
    return latest_by_key(merged, keys, order_by)


def upsert_in_load_order(
    rows: DataFrame,
    keys: Sequence[str],
    order_col: str = "__zk_load_order",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """A3 for a file read once: later rows of the input win ("last put").

    Without ``order_by`` the order is the read order: row order within a
    file, and across files the order of Spark's input splits (not the file
    names), which is as arbitrary as the directory order the reference
    relies on.  Pass ``order_by`` (e.g. a year or a file-date column) when
    the winner across files matters; the read position then only breaks
    ties.
    """
    ordered = rows.withColumn(order_col, F.monotonically_increasing_id())
    return latest_by_key(ordered, keys, [*(order_by or []), order_col]).drop(order_col)
