"""Co-moments of all pairs of many columns in one vector-valued aggregate.

One expression per pair makes a plan that grows with the square of the
number of columns.  Here the whole matrix is the state of one aggregate:
every task reads the columns as Arrow batches and keeps, for each ordered pair
(a, b), the rows where both are present, the mean of a over them, the sum of
squares about it, the co-moment and the least and greatest value.  A batch's
share is a few matrix products; states merge pairwise, so nothing depends on
the size of the values.  Tasks send one row per column, which are
merged in two rounds of bounded groups.  Missing values (null, not a number)
only leave out the pairs they belong to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks whose states one group of the first round merges
_MERGED = 1024
# per ordered pair: rows, mean, squares about it, least and greatest, infinite values; per pair: co-moment
_N, _MEAN, _SQUARES, _LOW, _HIGH, _WILD, _CO = range(7)


def _batch_state(x: np.ndarray) -> np.ndarray:
    """The state of a block of rows (rows x columns, missing as not a number)."""
    there = ~np.isnan(x)
    wild = np.isinf(x)
    there_d = there.astype(np.float64)
    finite = there & ~wild
    count = np.maximum(finite.sum(axis=0), 1)
    shift = np.where(finite, x, 0.0).sum(axis=0) / count
    centred = np.where(finite, x - shift, 0.0)
    n = there_d.T @ there_d
    some = np.maximum(n, 1)
    total = centred.T @ there_d  # of a, where b is there
    out = np.empty((7, *n.shape))
    out[_N] = n
    out[_MEAN] = shift[:, None] + total / some
    out[_SQUARES] = np.maximum((centred**2).T @ there_d - total**2 / some, 0.0)
    out[_CO] = centred.T @ centred - total * total.T / some
    out[_WILD] = wild.astype(np.float64).T @ there_d if wild.any() else 0.0
    low, high = np.where(there, x, np.inf), np.where(there, x, -np.inf)
    out[_LOW], out[_HIGH] = low.min(axis=0)[:, None], high.max(axis=0)[:, None]
    for b in np.flatnonzero(~there.all(axis=0)):  # a full column asks for no rows of its own
        rows = there[:, b]
        out[_LOW, :, b] = low[rows].min(axis=0, initial=np.inf)
        out[_HIGH, :, b] = high[rows].max(axis=0, initial=-np.inf)
    return out


def _merged(s: np.ndarray, t: np.ndarray, mean_s: np.ndarray, mean_t: np.ndarray) -> np.ndarray:
    """Two states as one; ``mean_s`` and ``mean_t`` are the means of the other column of each pair."""
    n = s[_N] + t[_N]
    some = np.maximum(n, 1)
    step = np.where((s[_N] > 0) & (t[_N] > 0), t[_MEAN] - s[_MEAN], 0.0)
    other = np.where((s[_N] > 0) & (t[_N] > 0), mean_t - mean_s, 0.0)
    weight = s[_N] * t[_N] / some
    out = np.empty_like(s)
    out[_N] = n
    out[_MEAN] = np.where(s[_N] > 0, s[_MEAN] + step * t[_N] / some, t[_MEAN])
    out[_SQUARES] = s[_SQUARES] + t[_SQUARES] + step**2 * weight
    out[_CO] = s[_CO] + t[_CO] + step * other * weight
    out[_LOW], out[_HIGH] = np.minimum(s[_LOW], t[_LOW]), np.maximum(s[_HIGH], t[_HIGH])
    out[_WILD] = s[_WILD] + t[_WILD]
    return out


def _task_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = None
    for batch in batches:
        if batch.num_rows:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            new = _batch_state(x)
            state = new if state is None else _merged(state, new, state[_MEAN].T, new[_MEAN].T)
    if state is not None:
        # a row per column a: the state of (a, b), then of (b, a), for all b
        both = np.concatenate([state, state.transpose(0, 2, 1)]).transpose(1, 0, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(both)), type=pa.int32()), pa.array([x.ravel() for x in both], type=pa.list_(pa.float64()))], names=["a", "state"]
        )


def _merge_rows(rows: pd.DataFrame) -> np.ndarray:
    """(2, 7, columns): the merged states of one column's rows."""
    total = None
    for flat in rows["state"]:
        ab, ba = np.asarray(flat).reshape(2, 7, -1)
        if total is None:
            total = ab, ba
        else:
            total = _merged(total[0], ab, total[1][_MEAN], ba[_MEAN]), _merged(total[1], ba, total[0][_MEAN], ab[_MEAN])
    return np.stack(total)


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a int, b int, r double): Pearson correlation of every ordered pair of column numbers.

    Over the rows where both are present; null where one does not vary there.
    """
    values = [F.col("`" + c.replace("`", "``") + "`").try_cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    states = df.select(*values).mapInArrow(_task_states, "a int, state array<double>")
    states = states.withColumn("part", F.floor(F.spark_partition_id() / _MERGED))

    def partly(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": rows["a"].iloc[:1], "state": [_merge_rows(rows).ravel()]})

    def finally_(rows: pd.DataFrame) -> pd.DataFrame:
        ab, ba = _merge_rows(rows)
        flat = (ab[_LOW] >= ab[_HIGH]) | (ba[_LOW] >= ba[_HIGH])
        with np.errstate(all="ignore"):
            r = ab[_CO] / np.sqrt(ab[_SQUARES] * ba[_SQUARES])
        r = np.where(ab[_WILD] + ba[_WILD] > 0, np.nan, r)
        known = ~flat | (ab[_WILD] + ba[_WILD] > 0)
        a = int(rows["a"].iloc[0])
        return pd.DataFrame({"a": a, "b": np.arange(len(r)), "r": r, "known": known})

    merged = states.groupBy("a", "part").applyInPandas(partly, "a int, state array<double>")
    found = merged.groupBy("a").applyInPandas(finally_, "a int, b int, r double, known boolean")
    return found.select("a", "b", F.when(F.col("known"), F.col("r")).alias("r"))
