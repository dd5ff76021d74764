"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A uniform permutation of all rows, cut into shards of given sizes, sends a
random number of rows from every partition to every shard.  These numbers
have a multivariate hypergeometric law, so they can be drawn first:

1. Permute locally: every input partition sorts its rows by a seeded hash
   and is written with its number and each row's place.
2. Draw the matrix (partitions x shards): going through the partitions, what
   each one sends is drawn without replacement from the places left in the shards.
   Rows sum to the partitions' sizes, columns to the shards' sizes, exactly.
3. Exchange: a row's place in its partition falls into the interval of one
   shard.
4. Permute again: a shard's rows are ordered by a second hash.

The draw runs in two steps, blocks of partitions first, then the partitions of each
block as a task of its own, so a task holds ``block`` partitions at most
(one number per input partition and shard overall).  Inside a shard rows are
dealt to buckets by their second hash, so a task sorts one bucket, not one shard;
the buckets' sizes give the slots.  Everything after step 1 is a function of the
written table and the seed: a lost executor repeats the same draws.

Shards differ by one row at most; the first ones take the rest.  The law is
``rows``: copies are rows like all others, so no group, however large, gathers
in a shard.

Edge cases: null and empty texts are rows of 16 bytes; null ids and
repeated rows take their own slots; fewer rows than shards leave shards
empty; an empty table gives an empty result; further columns pass through
(``shard`` and ``slot`` get a free name where they clash).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.llm.common import documents, free_name, quoted, staged, text_or_empty


@dataclass(frozen=True)
class Deal:
    shards: int = 40
    seed: int = 11
    #: partitions whose rows of the matrix one task draws
    block: int = 1024
    #: rows that one task puts in order, about
    bucket_rows: int = 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls, taken without replacement, are good; any size of numbers.

    The law's weights around its mode follow from their ratios; beyond twelve
    standard deviations on either side they are below what a double resolves.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1)))
    reach = int(12 * spread) + 40
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    summed = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(summed, rng.random() * summed[-1], side="right"))


def drawn_counts(rng: np.random.Generator, rows: int, places: list[int]) -> list[int]:
    """How many of ``rows`` rows go to each shard that has ``places`` left."""
    out, left = [], sum(places)
    for n in places:
        left -= n
        took = hypergeometric(rng, n, left, rows)
        out.append(took)
        rows -= took
    return out


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def matrix(counts: DataFrame, how: Deal) -> DataFrame:
    """(part, upto) from (part, n): how many of a partition's rows go to shard 0, to 0 and 1, and so on."""
    seed = how.seed
    blocks = counts.groupBy(F.floor(F.col("part") / how.block).alias("block")).agg(F.sum("n").alias("n"))

    def over(table: pd.DataFrame, column: str, places: list[int], rng: np.random.Generator) -> Iterator[list[int]]:
        for rows in table.sort_values(column)["n"].tolist():
            sent = drawn_counts(rng, int(rows), places)
            places = [p - s for p, s in zip(places, sent, strict=True)]
            yield sent

    # one row per `block` input partitions in this task
    def between(table: pd.DataFrame) -> pd.DataFrame:
        places = shard_sizes(int(table["n"].sum()), how.shards)
        table = table.sort_values("block")
        sent = list(over(table, "block", places, np.random.default_rng([seed, 0])))
        return pd.DataFrame({"block": table["block"], "places": sent})

    def within(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("part")
        rng = np.random.default_rng([seed, 1, int(table["block"].iloc[0])])
        sent = list(over(table, "part", [int(x) for x in table["places"].iloc[0]], rng))
        return pd.DataFrame({"part": table["part"], "upto": [np.cumsum(x).tolist() for x in sent]})

    each = blocks.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(between, "block long, places array<long>")
    parts = counts.withColumn("block", F.floor(F.col("part") / how.block)).join(each, "block")
    return parts.groupBy("block").applyInPandas(within, "part long, upto array<long>")


def sharded(df: DataFrame, how: Deal | None = None) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard), in uniform random order."""
    how = how or Deal()
    part, place, shard, slot, n, upto, key, bucket, base = (
        free_name(df, x) for x in ("part", "place", "shard", "slot", "n", "upto", "second_key", "bucket", "base")
    )
    hashed = [quoted(f.name) for f in df.schema.fields if not _holds_map(f.dataType)]
    number = F.monotonically_increasing_id()
    first = df.withColumn(key, F.xxhash64(F.lit(how.seed), *hashed)).sortWithinPartitions(key).drop(key)
    # the number of a row has its partition above bit 33 and its place in it below
    dealt = first.withColumn(part, F.shiftright(number, 33)).withColumn(place, number.bitwiseAND(F.lit((1 << 33) - 1)))
    dealt = staged(dealt, "dealt")

    counts = dealt.groupBy(F.col(part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    sent = staged(matrix(staged(counts, "counts"), how), "matrix").select(F.col("part").alias(part), F.col("upto").alias(upto))
    total = dealt.agg(F.count(F.lit(1))).first()[0]  # one number
    buckets = max(1, total // (how.shards * how.bucket_rows))
    placed = dealt.join(sent, part).withColumn(shard, F.size(F.filter(upto, lambda x: x <= F.col(place))))
    placed = placed.withColumn(key, F.xxhash64(F.lit(how.seed), F.lit("slot"), part, place))
    placed = placed.withColumn(bucket, F.pmod(F.shiftrightunsigned(key, 16), F.lit(buckets))).drop(upto)

    held = staged(placed.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(n)), "buckets")
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn(base, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    order = Window.partitionBy(shard, bucket).orderBy(key, part, place)
    ranked = placed.withColumn(slot, F.row_number().over(order).cast("long") - 1)
    out = ranked.join(offsets, [shard, bucket]).withColumn(slot, F.col(slot) + F.col(base))
    return out.select(*[quoted(c) for c in df.columns], shard, slot)


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def op11_shuffled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot (contract of operator 11, law ``rows``)."""
    body = text_or_empty("text")
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(body) + F.lit(16)).cast("long").alias("size"), F.crc32(body).alias("text_crc32")
    )
    return sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
