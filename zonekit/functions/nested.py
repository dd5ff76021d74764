"""Array / map / JSON helpers.

All are Catalyst higher-order or generator expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(c: str | Column, value_type: T.DataType = T.DoubleType()) -> Column:
    """Parse a JSON object text into ``map<string, value_type>``."""
    return F.from_json(_col(c), T.MapType(T.StringType(), value_type))


def json_field(c: str | Column, path: str) -> Column:
    """One field of a JSON text as a string (``$.a.b``)."""
    return F.get_json_object(_col(c), path)


def object_to_array(c: str | Column) -> Column:
    """Map -> array<struct<key, value>>."""
    return F.map_entries(_col(c))


def unwind(df: DataFrame, array_col: str, alias: str, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per array element; null, missing and empty arrays give
    no row (``explode``, not ``explode_outer``)."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != array_col]
    return df.select(*keep, F.explode(_col(array_col)).alias(alias))


def unwind_map(
    df: DataFrame,
    map_col: str | Column,
    keep: Sequence[str],
    key: str = "k",
    value: str = "v",
) -> DataFrame:
    """X1 + X2 on a map: one row per (key, value) entry."""
    return df.select(*keep, F.explode(_col(map_col)).alias(key, value))


def field(c: str | Column, path: str) -> Column:
    """Nested struct field by dotted path."""
    out = _col(c)
    for part in path.split("."):
        out = out.getField(part)
    return out


def latest_from_array(
    arr: str | Column,
    order_field: str = "year",
    value_field: str = "RFD",
) -> Column:
    """Value of the element with the greatest ``order_field``.

    ``array_max`` over ``struct(order, value)`` picks the latest element in
    one pass without sorting.  Tie rule: on equal order values the larger
    value wins.  Empty or null array -> null (the reference raises).
    """
    pairs = F.transform(
        _col(arr),
        lambda e: F.struct(e.getField(order_field).alias("o"), e.getField(value_field).alias("v")),
    )
    return F.array_max(pairs).getField("v")


def sorted_desc_first(arr: str | Column, order_field: str, value_field: str) -> Column:
    """O2 written as the reference does it (sort descending, take first);
    same result as ``latest_from_array`` but O(n log n) per array."""
    pairs = F.transform(
        _col(arr),
        lambda e: F.struct(e.getField(order_field).alias("o"), e.getField(value_field).alias("v")),
    )
    return F.try_element_at(F.sort_array(pairs, asc=False), F.lit(1)).getField("v")
