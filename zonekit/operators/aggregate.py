"""Grouped aggregates, ordering and top-k.

All aggregates are algebraic (count, sum, avg, min, max), so Spark plans
them as partial aggregation before the exchange and final aggregation
after it: a hot group key costs one partial row per map task, never a
whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.functions.scalar import natural_log, safe_ratio


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """A4 / A10: rows per group; a null group is kept (as ``$group`` does)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def daily_counts(
    df: DataFrame,
    date_col: str | Column = "date",
    date_name: str = "date",
    count_name: str = "listings_count",
    sort: bool = True,
) -> DataFrame:
    """A4 + O1: rows per calendar date, ascending by date.

    The sort is a range-partitioned global sort of the (small) aggregated
    result; write it with ``coalesce(1)`` only if one output file is wanted.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    out = df.groupBy(F.to_date(d).alias(date_name)).agg(F.count(F.lit(1)).alias(count_name))
    return out.orderBy(date_name) if sort else out


def mean_of(df: DataFrame, value: str, name: str) -> DataFrame:
    """A5: mean of a column over all rows (one row)."""
    return df.agg(F.avg(value).alias(name))


def per_calendar_day(df: DataFrame, date_col: str = "date", name: str = "per_day") -> DataFrame:
    """A6 + A14 + P13: rows / (max date - min date) in days; a single date
    gives a zero divisor and thus null (the reference raises)."""
    d = F.to_date(F.col(date_col))
    return df.agg(
        safe_ratio(F.count(F.lit(1)), F.datediff(F.max(d), F.min(d))).alias(name),
    )


def date_range(df: DataFrame, date_col: str = "date") -> DataFrame:
    """A14."""
    d = F.to_date(F.col(date_col))
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    """Mean per group (sum and count, nulls skipped); the sum of a
    decimal column is exact, so the mean then does not depend on row order."""
    return df.groupBy(*keys).agg(safe_ratio(F.sum(value).cast("double"), F.count(value)).alias(name))


def partial_mean(df: DataFrame, keys: Sequence[str | Column], value: str) -> DataFrame:
    """Sum and count per fine key -- the mergeable state of a mean.

    Aggregating to a fine key *before* a join shrinks the join input to one
    row per key (Catalyst does not push an ``avg`` below a join itself).
    """
    return df.groupBy(*keys).agg(
        F.sum(value).alias("__zk_sum"),
        F.count(value).alias("__zk_n"),
    )


def finish_mean(df: DataFrame, keys: Sequence[str | Column], name: str = "mean") -> DataFrame:
    """Combine ``partial_mean`` states per coarser key."""
    return df.groupBy(*keys).agg(safe_ratio(F.sum("__zk_sum").cast("double"), F.sum("__zk_n")).alias(name))


def mean_through(
    facts: DataFrame,
    fact_key: str,
    value: str,
    mapping: DataFrame,
    mapping_key: str,
    group: Sequence[str],
    name: str = "mean",
    fact_group: Sequence[str] = (),
) -> DataFrame:
    """Mean of ``value`` per ``group`` where the group comes from a mapping
    table joined on ``fact_key = mapping_key`` (e.g. order -> customer ->
    zone).  Facts are reduced to (key[, fact_group]) partial states first,
    so the join moves one row per key instead of every fact row."""
    states = partial_mean(facts, [fact_key, *fact_group], value)
    joined = states.join(mapping, states[fact_key] == mapping[mapping_key], "inner")
    return finish_mean(joined, [*group, *fact_group], name)


def ratio_by(
    df: DataFrame,
    keys: Sequence[str],
    numerator_mean_of: str,
    denominator: str,
    name: str = "ratio",
) -> DataFrame:
    """Mean of one column divided by a per-group constant (the income
    index of the zone and year); zero divisor -> null."""
    return df.groupBy(*keys).agg(
        safe_ratio(
            safe_ratio(F.sum(numerator_mean_of).cast("double"), F.count(numerator_mean_of)),
            F.first(denominator, ignorenulls=True),
        ).alias(name)
    )


def avg_nested(df: DataFrame, keys: Sequence[str], path: str | Column, name: str) -> DataFrame:
    """Average of a nested numeric field per group; non-numbers ignored."""
    v = F.col(path) if isinstance(path, str) else path
    return df.groupBy(*keys).agg(F.avg(v.try_cast("double")).alias(name))


def log_series(
    counts: DataFrame,
    date_col: str = "date",
    count_col: str = "listings_count",
    name: str = "listings_count_log",
) -> DataFrame:
    """P12 + A15: natural log of the daily count, summed per date."""
    return counts.groupBy(date_col).agg(F.sum(natural_log(count_col)).alias(name))


def peak(df: DataFrame, count_col: str, tie_col: str, n: int = 1) -> DataFrame:
    """row(s) with the largest count; ties go to the smallest ``tie_col``.
    Planned as ``TakeOrderedAndProject`` (per-task top-n, then merge)."""
    return df.orderBy(F.col(count_col).desc(), F.col(tie_col).asc()).limit(n)


def head(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """O3: first ``n`` rows in a stated order (a top-k, not a sample)."""
    return df.orderBy(*order_by).limit(n)


def table_counts(tables: dict[str, DataFrame], name_col: str = "t", count_col: str = "n") -> DataFrame:
    """One row (table, row count) per table, as one union plan; each
    branch is a partial + final count (reads no column data from Parquet)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(t).alias(name_col), count_col)
        for t, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def avg_map_values(df: DataFrame, keys: Sequence[str], map_col: str | Column, name: str = "avg") -> DataFrame:
    """Object -> array of entries (X1) -> one row per entry (X2) ->
    mean of the values per group.  Null and empty maps give no entry.
    Partial aggregation runs right after the explode, in the same task."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    entries = df.select(*keys, F.explode(F.map_entries(m)).alias("__zk_e"))
    return entries.groupBy(*keys).agg(F.avg(F.col("__zk_e.value")).alias(name))
