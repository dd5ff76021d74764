"""Quotation linking: find what each quoted passage quotes, and order messages by reply.

Lines that begin with ``>`` are quoted, the number of ``>`` is their level;
a line that introduces a quotation ("... wrote:") goes with it.  A passage is
a run of lines of one level.  Passages and the unquoted text of all messages
are normalised (lower case, letters and digits only) and hashed as a whole, line by
line and sentence by sentence.  A passage joins the messages that say it, or
pieces of it, unquoted: the first one of its own conversation, earlier than the
quoting one, and the first one of any other conversation.  It belongs to a
message that says the whole passage; failing that, to the one that has most of
its sentences, then lines, half of either at least.  Pieces may be of any
length and in any script.

A message answers what its outermost quotations belong to, within its
conversation.  Following answers up gives the message that began the thread;
a conversation is put in order by thread, then by turn, so that answers
follow what they answer, and comes out without the quotations.

The joins have one row per hash on the side of the originals, so a
sentence that a third of all messages hold stays linear, and so are the lines
of a message.  All of it is DataFrame operations.

Edge cases: a null or empty text is a message without sentences; a null
conversation is one of its own, in which nothing is linked; null turns come
last and are never an original; rows that repeat all four columns are one
message, and each comes back; an empty table gives an empty result; further
columns are left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import running_total, staged

_PREFIX = r"^[ \t]*((?:>[ \t]?)++)"
# A line that introduces a quotation, in the four languages of the tables.
_LEAD = r"(?i)^[ \t]*(on|am|le|el)\b.{3,200}\b(wrote|schrieb|a écrit|escribió)[^\n:]{0,80}:[ \t]*$"
# After a mark that ends a sentence; the full-width ones need no space behind them.
_BETWEEN_SENTENCES = r"(?<=[.!?])[ \t\r\n]+|(?<=[\u3002\uFF01\uFF1F])"


@dataclass(frozen=True)
class Linking:
    min_share: float = 0.5


def messages(table: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, msg): ``msg`` names a message by its content."""
    body = F.coalesce(F.col("text"), F.lit(""))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("conv_id", "turn", "role")]
    msg = F.concat_ws(":", *parts, F.xxhash64(body).cast("string"))
    return table.select("conv_id", "turn", "role", body.alias("text"), msg.alias("msg"))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _PREFIX, 1), "[^>]", ""))


def parsed(rows: DataFrame) -> DataFrame:
    """``rows`` with their lines as structs (level, content); level -1 is a lead-in to a quotation."""
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _PREFIX, "").alias("content")),
    )
    split = rows.withColumn("lines", lines)
    led = F.transform(
        "lines",
        lambda x, i: F.when(
            (x["level"] == 0) & x["content"].rlike(_LEAD) & (F.get("lines", i + 1)["level"] > 0),
            F.struct(F.lit(-1).alias("level"), x["content"].alias("content")),
        ).otherwise(x),
    )
    quotes = F.exists("lines", lambda x: x["level"] > 0)
    return split.withColumn("lines", F.when(quotes, led).otherwise(F.col("lines")))


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def _hashes(pieces: Column) -> Column:
    """128 bits of each different piece of an array that has a letter or digit."""
    kept = F.array_distinct(F.filter(F.transform(pieces, normalised), lambda p: p != ""))
    return F.transform(kept, lambda p: F.struct(F.xxhash64(p, F.lit(0)).alias("h1"), F.xxhash64(p, F.lit(1)).alias("h2")))


def _tagged(hashes: str, kind: int) -> Column:
    return F.transform(hashes, lambda h: F.struct(F.lit(kind).alias("kind"), h["h1"].alias("h1"), h["h2"].alias("h2")))


def _own(lines: Column) -> Column:
    return F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"]), "\n")


def passages(rows: DataFrame) -> DataFrame:
    """(msg, conv_id, turn, passage, level, quoted): runs of quoted lines of one level, as lines."""
    held = rows.filter(F.exists("lines", lambda x: x["level"] > 0)).dropDuplicates(["msg"])
    lines = held.select("msg", "conv_id", "turn", F.posexplode("lines").alias("i", "x"))
    lines = lines.select("msg", "conv_id", "turn", "i", "x.level", "x.content")
    # a line that differs in level from the one before begins a passage
    order = Window.partitionBy("msg").orderBy("i")
    begins = F.coalesce((F.lag("level").over(order) != F.col("level")).cast("int"), F.lit(1))
    lines = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    quoted = F.transform(F.array_sort(F.collect_list(F.struct("i", "content"))), lambda x: x["content"]).alias("quoted")
    return lines.filter("level > 0").groupBy("msg", "conv_id", "turn", "passage", "level").agg(quoted)


def passage_links(rows: DataFrame, how: Linking) -> DataFrame:
    """(msg, passage, level, n_sentences, matched, to_conv, to_turn) of every passage that has its original.

    ``rows`` are parsed messages.
    """
    said = rows.dropDuplicates(["msg"]).filter("turn is not null").withColumn("own", _own(F.col("lines")))
    pieces = F.concat(F.array("own"), F.split("own", "\n"), F.split("own", _BETWEEN_SENTENCES))
    said = said.select("conv_id", "turn", F.explode(_hashes(pieces)).alias("s")).select("conv_id", "turn", "s.h1", "s.h2")
    here = staged(said.groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("here")), "said")
    # of each hash the first conversation, and the first of the others
    place = F.struct(F.col("conv_id").alias("conv"), F.col("here").alias("turn"))
    known = here.filter("conv_id is not null")
    least = staged(known.groupBy("h1", "h2").agg(F.min(place).alias("first")), "first-said")
    other = known.join(least.hint("merge"), ["h1", "h2"]).filter("conv_id <> first.conv")
    other = other.groupBy("h1", "h2").agg(F.min(place).alias("second"))
    anywhere = staged(least.join(other.hint("merge"), ["h1", "h2"], "left"), "first-said")

    whole = F.array_join("quoted", " ")
    found = passages(rows).withColumns(
        {"whole": _hashes(F.array(whole)), "by_line": _hashes(F.col("quoted")), "by_sentence": _hashes(F.split(whole, _BETWEEN_SENTENCES))}
    )
    kinds = [_tagged(name, k) for k, name in enumerate(("by_line", "by_sentence", "whole"))]
    keys = ["msg", "conv_id", "turn", "passage", "level", "n_lines", "n_sentences"]
    asked = found.withColumn("n_lines", F.size("by_line")).withColumn("n_sentences", F.size("by_sentence"))
    asked = staged(asked.select(*keys, F.explode(F.concat(*kinds)).alias("s")).select(*keys, "s.kind", "s.h1", "s.h2"), "quoted-pieces")
    met = asked.join(here, ["conv_id", "h1", "h2"], "left").join(anywhere, ["h1", "h2"], "left")
    foreign = F.when(F.col("first.conv").eqNullSafe(F.col("conv_id")), F.col("second")).otherwise(F.col("first"))
    inside = F.when(F.col("here") < F.col("turn"), F.struct(F.col("conv_id").alias("conv"), F.col("here").alias("turn")))
    outside = F.when(F.col("conv_id").isNotNull(), foreign)
    met = met.withColumn("to", F.coalesce(inside, outside)).filter("to is not null")
    counts = met.groupBy("msg", "passage", "level", "n_lines", "n_sentences", F.col("to.conv").alias("to_conv"), F.col("to.turn").alias("to_turn")).agg(
        *[F.count_if(F.col("kind") == k).alias(name) for k, name in enumerate(("lines", "sentences", "whole"))]
    )
    rank = F.struct("whole", "sentences", "lines", -F.col("to_conv"), -F.col("to_turn"))
    best = F.max_by(F.struct("whole", "sentences", "lines", "to_conv", "to_turn"), rank)
    chosen = counts.groupBy("msg", "passage", "level", "n_lines", "n_sentences").agg(best.alias("best"))
    part = (F.col("best.sentences") >= how.min_share * F.col("n_sentences")) | (F.col("best.lines") >= how.min_share * F.col("n_lines"))
    return chosen.filter((F.col("best.whole") > 0) | part).select(
        "msg", "passage", "level", "n_sentences", F.greatest("best.sentences", "best.lines", "best.whole").alias("matched"), "best.to_conv", "best.to_turn"
    )


def _threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, root): the turn that began the thread of each answering turn, by pointer doubling."""
    links = staged(answers.select("conv_id", "turn", F.col("to_turn").alias("root")), "answers")
    while True:
        up = links.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("higher"))
        links = staged(links.join(up, ["conv_id", "root"], "left"), "answers")
        if not links.filter("higher is not null").limit(1).count():
            return links.drop("higher")
        links = links.select("conv_id", "turn", F.coalesce("higher", "root").alias("root"))


def reply_ordered(table: DataFrame, how: Linking | None = None) -> DataFrame:
    """Every message without its quotations, in reply order.

    (conv_id, turn, role, text, n_quoted_lines, max_level, quote_conv,
    quote_turn, reply_to, thread_turn, position): ``quote_*`` is the original of
    its outermost quotations, ``reply_to`` the turn it answers in its own
    conversation, ``position`` its place there in reply order, from 0.
    """
    how = how or Linking()
    rows = parsed(messages(table))
    links = staged(passage_links(rows, how), "passage-links")
    # of the outermost passages the one with most sentences, then the later turn
    best = F.max_by(F.struct("to_conv", "to_turn"), F.struct(-F.col("level"), "matched", "to_turn", "to_conv"))
    quotes = links.groupBy("msg").agg(best.alias("to")).select("msg", "to.to_conv", "to.to_turn")

    level = F.transform("lines", lambda x: x["level"])
    plain = rows.select(
        "conv_id", "turn", "role", "msg", F.btrim(F.regexp_replace(_own(F.col("lines")), r"\n{3,}", "\n\n"), F.lit(" \t\r\n")).alias("own"),
        F.size(F.filter(level, lambda x: x > 0)).cast("long").alias("n_quoted_lines"),
        F.greatest(F.array_max(level), F.lit(0)).cast("long").alias("max_level"),
        "text",
    )
    plain = plain.withColumn("text", F.when(F.col("max_level") > 0, F.col("own")).otherwise(F.col("text"))).drop("own")
    linked = plain.join(quotes, "msg", "left")
    reply = F.when((F.col("to_conv") == F.col("conv_id")) & (F.col("to_turn") < F.col("turn")), F.col("to_turn"))
    linked = staged(linked.withColumn("reply_to", reply), "messages")

    answers = linked.filter("reply_to is not null").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("to_turn"))
    threads = _threads(answers)
    known = linked.join(threads.hint("merge"), ["conv_id", "turn"], "left")
    known = known.withColumn("thread_turn", F.coalesce("root", "turn")).withColumn("one", F.lit(1))
    order = ["conv_id", F.col("thread_turn").asc_nulls_last(), F.col("turn").asc_nulls_last(), "msg"]
    ranked = running_total(known.drop("root"), order, "one", "rank", "reply-order")
    first = ranked.groupBy(F.col("conv_id").alias("conv")).agg(F.min("rank").alias("base"))
    placed = ranked.join(first, F.col("conv_id").eqNullSafe(F.col("conv")))
    return placed.select(
        "conv_id", "turn", "role", "text", "n_quoted_lines", "max_level",
        F.col("to_conv").alias("quote_conv"), F.col("to_turn").alias("quote_turn"), "reply_to", "thread_turn",
        (F.col("rank") - F.col("base")).alias("position"),
    )


def op2_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotations."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return reply_ordered(table.select("conv_id", "turn", "role", "text"))
