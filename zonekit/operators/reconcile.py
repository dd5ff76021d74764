"""Name reconciliation through lookup tables.

No side is broadcast by hint: Spark broadcasts a plain scan whose files are
below ``spark.sql.autoBroadcastJoinThreshold``, and AQE turns other joins
into broadcast joins from measured sizes.  Building a plan runs no job
(``strict_join`` alone does, as it says).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zonekit.operators.dedup import _q, first_by_key

def apply_lookup(
    df: DataFrame,
    lookup: DataFrame,
    raw: str | Sequence[str],
    reconciled: str,
    out: str,
    lookup_raw: str | Sequence[str] | None = None,
    keep_raw: bool = False,
) -> DataFrame:
    """J4 / J5 / J7 + P6: inner join on the raw name(s), then re-key on
    the reconciled name.  Rows without a lookup entry drop out (inner);
    null names never match (SQL equality).  ``keep_raw`` keeps the raw
    name column(s) next to the reconciled one."""
    raw_cols = [raw] if isinstance(raw, str) else list(raw)
    lk_cols = raw_cols if lookup_raw is None else ([lookup_raw] if isinstance(lookup_raw, str) else list(lookup_raw))
    right = lookup.select(
        *[_q(lc).alias(f"__zk_lk{i}") for i, lc in enumerate(lk_cols)],
        _q(reconciled).alias("__zk_re"),
    )
    cond = [_q(rc) == F.col(f"__zk_lk{i}") for i, rc in enumerate(raw_cols)]
    joined = df.join(right, cond, "inner")
    rest = [_q(c) for c in df.columns if (keep_raw or c not in raw_cols) and c != out]
    return joined.select(F.col("__zk_re").alias(out), *rest)


def link_lookups(
    left: DataFrame,
    right: DataFrame,
    ids: Sequence[str],
    right_order: Sequence[str] | None = None,
) -> DataFrame:
    """Pair each entry of ``left`` with the entry of ``right`` that has
    the same id pair.  If ``right`` holds several entries with one id
    pair, the first by ``right_order`` (ascending, nulls last) wins.
    Entries without a partner are left out (see ``unlinked``)."""
    order = list(right_order or [c for c in right.columns if c not in ids])
    first = first_by_key(right, list(ids), order)
    return left.join(first, list(ids), "inner")


def unlinked(
    left: DataFrame,
    right: DataFrame,
    ids: Sequence[str],
) -> DataFrame:
    """Entries of ``left`` with no partner in ``right`` (left anti)."""
    return left.join(right.select(*ids), list(ids), "left_anti")


def strict_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
) -> DataFrame:
    """J3 with ``strict``: inner join that fails when a row of ``df`` has
    no partner (the reference raises ``KeyError``).

    The check is a left-anti join stopped at the first miss (``limit(1)``),
    run before the join is returned.  A check inside the plan itself would
    not be reliable: filters inferred from later joins may drop the missing
    rows before the check sees them.  Call it on reduced inputs (e.g. one
    row per zone), as ``kpi2b`` does.
    """
    right = lookup
    miss = df.join(right.select(*on), list(on), "left_anti").limit(1).collect()
    if miss:
        raise KeyError(f"lookup has no entry for {miss[0].asDict()}")
    return df.join(right, list(on), "inner")


def audited_join(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> tuple[DataFrame, Observation]:
    """J2 + J3 + A13 in one pass: the inner join, and counts of what went into it.

    The observation holds ``rows`` and ``unmatched`` of ``df`` and ``matched``, the rows of the
    result, once the frame has been run; no job is added.  ``lookup`` has one row per key.
    Counts are taken before later filters, which do not move below them.
    """
    found = Observation()
    flag = "__zk_found"
    marked = df.join(lookup.withColumn(flag, F.lit(1)), list(on), "left")
    missing = F.count_if(F.col(flag).isNull())
    audited = marked.observe(found, F.count(F.lit(1)).alias("rows"), missing.alias("unmatched"), (F.count(F.lit(1)) - missing).alias("matched"))
    return audited.filter(F.col(flag).isNotNull()).drop(flag), found


def join_on_reconciled(left: DataFrame, right: DataFrame, key: str = "neighborhood") -> DataFrame:
    """Inner join of two per-zone results on the reconciled name.

    Both sides are per-zone aggregates; if several raw names reconcile to
    one name, the rows fan out (means are not re-combined), as in the
    reference.  The join is left to Catalyst/AQE: both sides are derived
    aggregates whose size is only known at runtime.
    """
    return left.join(right, key, "inner")
