"""Correlation.

Pearson correlation is an algebraic aggregate in Spark (``corr`` keeps
n, means and co-moments), so one pass over the data computes every pair
with partial aggregation per task; nothing is collected per group.  Many
columns go through one vector-valued aggregate (``comoments``).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.operators.comoments import pair_correlations

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

#: columns up to which there is one expression per pair (faster for 3 columns, slower for 8; not tuned in between)
FEW_COLUMNS = 6


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over the rows where both values are present.

    Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when a column has
    no variance; here the same quantity, covariance over the square root of
    the variances (Spark's stable co-moment aggregates), goes through
    ``try_divide``, so that case gives null, as an undefined correlation.
    """
    x = F.col(a).try_cast("double") if isinstance(a, str) else a.try_cast("double")
    y = F.col(b).try_cast("double") if isinstance(b, str) else b.try_cast("double")
    x, y = F.when(~F.isnan(x), x), F.when(~F.isnan(y), y)  # not a number counts as missing
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def corr_pair(df: DataFrame, a: str, b: str, name: str = "r", by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of two columns (optionally per group)."""
    agg = pearson(a, b).alias(name)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns a correlation matrix uses; text columns are left out."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def corr_matrix(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    a_name: str = "a",
    b_name: str = "b",
    r_name: str = "r",
    full: bool = False,
) -> DataFrame:
    """Pairwise correlations in long form ``(a, b, r)``.

    All pairs are computed in one aggregation.  Up to ``FEW_COLUMNS`` columns it
    holds one expression per pair, and the single result row is turned
    into one row per pair with ``inline`` (no driver round-trip); for
    more columns it is one vector-valued aggregate (``comoments``), whose plan
    does not grow with the number of pairs.  The results are the same.
    With ``full`` the diagonal and both orders are emitted, like a square
    matrix; otherwise each unordered pair once, in column order.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    if len(cols) > FEW_COLUMNS:
        name = F.array(*[F.lit(c) for c in cols])
        # every pair has its row, in an empty table too
        each = F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1)))
        pairs = df.sparkSession.range(1).select(each.alias("a")).select("a", each.alias("b")).filter("true" if full else "a < b")
        found = pairs.join(pair_correlations(df, cols), ["a", "b"], "left")
        r = F.when(F.col("a") == F.col("b"), F.when(F.col("r").isNotNull(), F.lit(1.0))).otherwise(F.col("r"))
        return found.select(F.get(name, F.col("a")).alias(a_name), F.get(name, F.col("b")).alias(b_name), r.alias(r_name))
    pairs = list(combinations(cols, 2))
    aggs = [pearson(x, y).alias(f"__zk_c{i}") for i, (x, y) in enumerate(pairs)]
    if full:  # a column goes with itself, unless it does not vary
        aggs += [pearson(x, x).alias(f"__zk_d{i}") for i, x in enumerate(cols)]
    one = df.agg(*aggs) if aggs else df.limit(0).select(F.lit(None).cast("double").alias("__zk_none"))
    entries = []
    for i, (x, y) in enumerate(pairs):
        entries.append(F.struct(F.lit(x).alias(a_name), F.lit(y).alias(b_name), F.col(f"__zk_c{i}").alias(r_name)))
        if full:
            entries.append(F.struct(F.lit(y).alias(a_name), F.lit(x).alias(b_name), F.col(f"__zk_c{i}").alias(r_name)))
    if full:
        for i, x in enumerate(cols):
            itself = F.when(F.col(f"__zk_d{i}").isNotNull(), F.lit(1.0))
            entries.append(F.struct(F.lit(x).alias(a_name), F.lit(x).alias(b_name), itself.alias(r_name)))
    if not entries:
        schema = f"{a_name} string, {b_name} string, {r_name} double"
        return df.sparkSession.createDataFrame([], schema)
    return one.select(F.inline(F.array(*entries)))
