"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a hashed order, offered
``passes`` times over.  A document's virtual finish time is the number of
words its queue has given out up to and including it, divided by the queue's
target.  All documents are sorted by finish time, over all sources, and added
up; the document with which the total budget is reached ends the mix.  All that
finish by then are taken whole, a prefix of the global order, and at
any point of it each source has had its share.  The queues give out words side
by side, so a document that a queue has begun by that virtual time but not
finished is taken as far as it has come: a source's words differ from its
target by the share by which that time differs from 1, not by a document.

Running totals are range-partitioned (``common.running_total``), so neither
a source with a third of all rows nor the global order meets in one task.
Targets come from one row per source; the driver sees only scalars.

Edge cases: a null text has size 0 and is never taken; null is a source of
its own, after all others; equal hashed ranks are ordered by id and size, so
reruns agree; repeated rows queue one after the other; an empty table gives
an empty result; further columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm.common import (
    documents,
    free_name,
    quoted,
    row_key,
    running_total,
    staged,
    text_or_empty,
)

# The first character of a word: nothing or one of the six white-space characters before it.
_WORD_START = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)
    #: total budget as a share of all words
    share: float = 1.5
    #: how often a document may be taken
    passes: int = 2
    seed: int = 17


def word_count(text: Column) -> Column:
    """Words of a text, without building them."""
    return (F.length(text) - F.length(F.regexp_replace(text, _WORD_START, ""))).cast("long")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """``sources`` (source, source_size) with (sid, base, target).

    Weights follow the sources' order by code point.  No target is above
    ``passes`` times its source; what is cut off goes to the others by weight
    until none is above.
    """
    order = [F.col("source").asc_nulls_last()]
    ranked = running_total(sources.withColumn("one", F.lit(1)), order, "one", "sid", "source-rank").drop("one")
    ranked = running_total(ranked, order, "source_size", "base", "source-base")
    place = F.col("sid") % len(mix.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (place + 1).cast("int"))
    ranked = staged(ranked.withColumn("weight", weight), "sources")
    cap = (F.col("source_size") * mix.passes).cast("double")
    total = mix.share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:  # the rate only rises, so a capped source stays capped
        full = F.col("weight") * rate >= cap
        held, open_weight = ranked.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        new = (total - (held or 0.0)) / open_weight if open_weight else rate
        if new <= rate:
            break
        rate = new
    return ranked.withColumn("target", F.least(F.col("weight") * rate, cap))


def schedule(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every offer of a document: (row_key, row, doc_id, source, size, source_size, target, pass, finish, before, taken).

    ``before`` is the number of words of all that finish ahead of it; ``taken`` is
    the number of its words, from its start, that are given out when ``before``
    reaches the budget.
    """
    mix = mix or Mix()
    body = text_or_empty(text)
    sized = staged(
        docs.select(
            row_key(quoted(key), body).alias("row_key"),
            quoted(key).alias("doc_id"),
            quoted(source).alias("source"),
            word_count(body).alias("size"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "sized",
    )
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), mix)
    queues = sized.withColumn("rank", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("doc_id").cast("string")).cast("binary")))
    order = [F.col("source").asc_nulls_last(), "rank", "doc_id", "size", "row"]
    queues = running_total(queues, order, "size", "ahead", "queues")

    goal = goal.withColumnRenamed("source", "of")
    offers = queues.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    offers = offers.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(mix.passes - 1))))
    given = F.col("ahead") - F.col("base") + F.col("pass") * F.col("source_size")
    finish = F.coalesce(F.try_divide((given + F.col("size")).cast("double"), F.col("target")), F.lit(0.0))
    offers = offers.withColumn("given", given).withColumn("finish", finish)
    order = ["finish", "sid", "pass", "rank", "doc_id", "size", "row"]
    offers = running_total(offers, order, "size", "before", "mix")
    budget = goal.agg(F.sum("source_size") * F.lit(float(min(mix.share, mix.passes)))).scalar()
    end = offers.filter(F.col("before") + F.col("size") >= budget).agg(F.min("finish")).scalar()
    begun = F.greatest(F.least(F.floor(F.col("target") * end) - F.col("given"), F.col("size")), F.lit(0))
    return offers.withColumn("taken", F.when(F.col("finish") <= end, F.col("size")).otherwise(begun)).select(
        "row_key", "row", "doc_id", "source", "size", "source_size", "target", "pass", "finish", "before", "taken"
    )


def taken_words(offers: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    keys = ["row", "row_key", "doc_id", "size", "source_size", "target"]
    return offers.groupBy(*keys).agg(F.sum("taken").alias("taken"))


def mixed(
    docs: DataFrame,
    mix: Mix | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    length: str | None = None,
) -> DataFrame:
    """The mix itself in the columns of ``docs``: a row for each time a document is taken.

    The last document of a source may be cut; ``length`` names a column that
    then follows its length in characters.
    """
    row, parts, part = (free_name(docs, x) for x in ("row_key", "parts", "part"))
    chosen = schedule(docs, mix, key, text, source).filter("taken > 0")
    share = F.when(F.col("taken") < F.col("size"), F.col("taken"))  # null: whole
    chosen = chosen.groupBy(F.col("row_key").alias(row)).agg(F.collect_list(F.struct(share.alias("words"))).alias(parts))
    marked = docs.withColumn(row, row_key(quoted(key), text_or_empty(text)))
    found = marked.join(chosen, row).dropDuplicates([row]).withColumn(part, F.explode(parts))
    words = F.col(part)["words"]
    start = F.regexp_substr(quoted(text), F.concat(F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), words, F.lit("}+")))
    changed = {text: F.when(words.isNull(), quoted(text)).otherwise(start)}
    if length:
        changed[length] = F.when(words.isNull(), quoted(length)).otherwise(F.length(start).cast(docs.schema[length].dataType))
    return found.select(*[changed[c].alias(c) if c in changed else quoted(c) for c in docs.columns])


def op7_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document (contract of operator 7)."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return taken_words(schedule(docs)).drop("row", "row_key")
