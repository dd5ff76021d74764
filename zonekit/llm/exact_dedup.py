"""Exact deduplication against immutable snapshots.

A snapshot holds each normalised text it has taken in once (its exact buckets) and
one static binary fuse filter for every bucket of digests.  An incoming batch is digested and grouped by itself; its distinct digests are
screened by the filters; only those that hit fetch their texts and are
compared, byte by byte, with the snapshot's exact buckets.  Digests that the
filter lets pass wrongly stay with the new batch.

Only digests and ids travel in the wide shuffles.  Copies are counted on the
map side first, so a group that holds a third of all rows is one row per
task; the join that returns the group to its rows has one row per digest on
the other side, which Spark splits where a digest is hot.

Edge cases: a null text is an empty one, and all empty texts are one group;
a null id sorts after every other; of rows that repeat both id and text one
is kept; an empty table gives an empty result; further columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm import fuse
from zonekit.llm.common import SPACE, documents, free_name, quoted, staged, text_or_empty

#: Keys of one filter: bounds what a task holds of it; the number of filters grows with the data.
KEYS_PER_FILTER = 1024


@dataclass(frozen=True)
class Snapshot:
    """An immutable set of texts: ``exact`` (digest, body) and ``filters`` (bucket, filter)."""

    exact: DataFrame
    filters: DataFrame
    buckets: int


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def digest(body: Column) -> Column:
    return F.sha2(body, 256)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(0)), F.lit(buckets)).cast("int")


def build_snapshot(bodies: DataFrame, digests: DataFrame, name: str) -> Snapshot:
    """A snapshot of ``bodies`` (digest, body), written into the shared folder, one body for each digest.

    ``digests`` are its distinct digests, one column.
    """
    exact = staged(bodies.select("digest", "body").dropDuplicates(["digest"]), f"{name}-exact")
    buckets = max(1, -(-digests.count() // KEYS_PER_FILTER))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        made = fuse.build(rows.column("key").to_numpy().view(np.uint64))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([made], pa.binary())})

    keys = digests.select(_bucket(buckets).alias("bucket"), F.xxhash64("digest").alias("key"))
    filters = keys.groupBy("bucket").applyInArrow(build, "bucket int, filter binary")
    return Snapshot(exact, staged(filters, f"{name}-filters"), buckets)


def screen(digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Those of ``digests`` (one distinct column) that the snapshot's filters report."""

    def probe(rows: pa.Table, made: pa.Table) -> pa.Table:
        out = rows.select(["digest"])
        if not made.num_rows:
            return out.slice(0, 0)
        hit = fuse.contains(made.column("filter")[0].as_py(), rows.column("key").to_numpy().view(np.uint64))
        return out.filter(pa.array(hit))

    keys = digests.select("digest", _bucket(snapshot.buckets).alias("bucket"), F.xxhash64("digest").alias("key"))
    return keys.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInArrow(probe, "digest string")


def confirmed(new: DataFrame, bodies: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests of ``new`` (digest, rep) whose text the snapshot holds, byte for byte.

    ``bodies`` (rep, digest, body) are the batch's rows; one row of each
    group that hit is compared.  Both sides are sorted and merged at every
    size: the hits grow with the batch, so they are never broadcast.
    """
    hits = staged(new.join(screen(new.select("digest"), snapshot), "digest"), "screened")
    reps = bodies.join(hits.hint("merge"), ["rep", "digest"]).dropDuplicates(["rep", "digest"])
    same = snapshot.exact.alias("s").join(reps.alias("n").hint("merge"), F.col("n.digest") == F.col("s.digest"))
    return same.filter(F.col("n.body") == F.col("s.body")).select(F.col("n.digest").alias("digest")).distinct()


def mark_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: (doc_id, digest, keep_id, group_size, kept).

    The rows arrive as two batches in id order: the lower half of the id
    range becomes the snapshot, the rest is screened against it, so that the
    snapshot's row always has the smallest id.
    """
    body = normalised(text_or_empty(text))
    low, high = docs.agg(F.min(quoted(key)), F.max(quoted(key))).first()
    old = F.lit(False) if low is None else F.coalesce(quoted(key) < F.lit(low + (high - low) // 2 + 1), F.lit(False))
    rows = docs.select(quoted(key).alias("doc_id"), old.alias("old"), body.alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    rows = rows.withColumn("rep", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))

    table = staged(
        rows.select("doc_id", "old", "digest").withColumn("row", F.monotonically_increasing_id()), "digests"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = staged(table.groupBy("old", "digest").agg(first, F.count(F.lit(1)).alias("n")), "groups")
    was, new = groups.filter("old").drop("old"), groups.filter("not old").drop("old")

    snapshot = build_snapshot(rows.filter("old"), was.select("digest"), "snapshot")
    reps = new.select("digest", F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias("rep"))
    met = staged(confirmed(reps, rows.filter("not old"), snapshot), "confirmed").withColumn("met", F.lit(True))

    again = new.join(met, "digest").select("digest", F.col("n").alias("more"))
    was = was.join(again, "digest", "left").select("digest", "first", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
    joined = new.join(met, "digest", "left").join(
        was.select("digest", F.col("first").alias("before"), F.col("n").alias("all")), "digest", "left"
    )
    fresh = joined.select(
        "digest",
        F.when(F.col("met"), F.col("before")).otherwise(F.col("first")).alias("first"),
        F.when(F.col("met"), F.col("all")).otherwise(F.col("n")).alias("n"),
    )
    final = was.withColumn("old", F.lit(True)).unionByName(fresh.withColumn("old", F.lit(False)))
    return table.join(final, ["old", "digest"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, in its columns."""
    stay = mark_copies(docs, key, text).filter("kept")
    row = free_name(docs, "row_key")

    def keyed(doc_id: Column, made: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), made)

    marked = docs.withColumn(row, keyed(quoted(key), digest(normalised(text_or_empty(text)))))
    stay = stay.select(keyed(F.col("doc_id"), F.col("digest")).alias(row))
    # rows that repeat id and text meet in one task, so that one of them is left
    return marked.join(stay, row, "left_semi").dropDuplicates([row]).drop(row)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for it (contract of operator 4)."""
    marked = mark_copies(documents(spark, sf_dir).select("doc_id", "text"))
    return marked.withColumnRenamed("digest", "text_sha256")
