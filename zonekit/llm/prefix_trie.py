"""Conversation prefixes as a z-fast trie, built in batches of joins.

A conversation is a string of turns (role, text).  The compacted trie over
all conversations has a node where conversations end or part; its edge
covers the depths ``top`` + 1 to ``depth``.  A node is stored under the hash of
its handle: the prefix whose length is the two-fattest number in
(``top``, ``depth``], the one divisible by the highest power of two.

Different conversations are inserted in batches.  One of a new batch finds
its exit node by fat binary search: it looks up its own prefix at the
two-fattest depth of the interval left, moves below the node on a match and
above that depth otherwise, so a conversation of n turns takes about log2(n)
lookups, each round one join for the whole batch.  Below the last node that it
matches wholly, its next turn names the edge it leaves on, and prefix hashes tell
the depth.  Then the batch is merged: edges are split where conversations leave
them, and nodes of the new parts are where the batch's own strings end or
part.

Prefix hashes are running sums of position-keyed hashes of turns (84 bits),
so a prefix is compared in one step and never kept as a list.  They are
taken over range partitions of all turns: neither the order of turns nor the
sums need a conversation in one task.  Equal conversations are one string with a
count, summed on the map side.

Totals of subtrees come from pairs of a node and the nodes above it, which
are the nodes on its own conversation's path (at most one a turn).  At the
end edges are expanded into a row for each depth.

The digest of the conversations that end at a node is a hash over one ordered
stream of ids, sequential by its definition; ids stream through one task per
node, sorted by Spark, with the hash's state as only memory.

Edge cases: a null role or text is empty; null turns come first; turns
of one number are ordered by role and text; rows without conversation belong
to none and are left aside; repeated rows are repeated turns; a conversation
without turns ends at the root; an empty table gives an empty result;
further columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import running_totals, staged

_HALF = (1 << 42) - 1


@dataclass(frozen=True)
class Trie:
    #: batches of different conversations
    batches: int = 2


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    return F.expr(f"{high} & shiftleft(-1L, length(bin({low} ^ {high})) - 1)")


def ordered_turns(table: DataFrame) -> DataFrame:
    """(conv, d, turn_hash, chars): every turn's place in its conversation, from 1, and a hash of role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat_ws(":", F.length(role), role, text), 256)
    rows = table.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"), said.alias("turn_hash"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("number"),
    )
    # repeated rows are told apart by their number only so that they can be dealt to several tasks
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("number")]
    ranked = running_totals(rows.withColumn("one", F.lit(1)), order, {"rank": "one"}, "turn-order")
    first = staged(ranked.groupBy("conv").agg(F.min("rank").alias("base")), "first-turns")
    return ranked.join(first, "conv").select("conv", (F.col("rank") - F.col("base") + 1).alias("d"), "turn_hash", "chars")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, d, turn_hash, chars) with ``hash`` of all turns up to each and their length ``upto``, staged."""
    halves = [F.xxhash64(F.col("d"), F.col("turn_hash"), F.lit(salt)).bitwiseAND(F.lit(_HALF)).cast("decimal(19,0)") for salt in (1, 2)]
    term = (halves[0] * F.lit(_HALF + 1).cast("decimal(14,0)") + halves[1]).cast("decimal(28,0)")
    rows = turns.withColumn("term", term)
    sums = running_totals(rows, [F.col("conv"), F.col("d")], {"hash": "term", "upto": "chars"}, "prefix-sums")
    first = staged(sums.filter("d = 1").select("conv", F.col("hash").alias("hash0"), F.col("upto").alias("upto0")), "first-sums")
    ahead = F.col("hash") - F.col("hash0") + F.col("term")
    joined = sums.join(first, "conv").select("conv", "d", ahead.cast("decimal(38,0)").alias("hash"), (F.col("upto") - F.col("upto0") + F.col("chars")).alias("upto"))
    return staged(joined, "prefixes")


def _at(prefix: DataFrame, conv: str, d: str, **names: str) -> DataFrame:
    """``prefix`` with its columns renamed for a join on (conv, d)."""
    return prefix.select(F.col("conv").alias(conv), F.col("d").alias(d), *[F.col(c).alias(name) for c, name in names.items()])


def exits(strings: DataFrame, prefix: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv, size, at, at_hash, node, node_hash): how deep the trie ``nodes`` holds each string.

    ``at`` is the depth, ``node`` and ``node_hash`` the node of the edge that
    the string leaves or ends on, null where it leaves or ends at a node.
    """
    below = nodes.filter("depth > 0")
    handle = _at(prefix, "rep", "f", hash="handle")
    handles = staged(below.withColumn("f", two_fattest("top", "depth")).join(handle, ["rep", "f"]).select("f", "handle", "top", "depth", "hash"), "handles")
    # the fat binary search; `low` is the depth of the last node matched wholly
    state = strings.select("conv", "size", F.lit(0).cast("long").alias("low"), F.col("size").alias("high"))
    done = state.filter("low >= high")
    state = staged(state.filter("low < high"), "search")
    while not state.isEmpty():
        asked = state.withColumn("f", two_fattest("low", "high")).join(_at(prefix, "conv", "f", hash="handle"), ["conv", "f"])
        met = asked.join(handles, ["f", "handle"], "left").select(
            "conv", "size", "low", "high", "f", "top", F.when(F.col("depth") <= F.col("size"), F.col("depth")).alias("d"), F.col("hash").alias("extent")
        )
        met = met.join(_at(prefix, "conv", "d", hash="own"), ["conv", "d"], "left")
        whole = F.col("own").eqNullSafe(F.col("extent")) & F.col("extent").isNotNull()
        low = F.when(F.col("top").isNull(), F.col("low")).when(whole, F.col("d")).otherwise(F.col("top"))
        high = F.when(F.col("top").isNull(), F.col("f") - 1).when(whole, F.col("high")).otherwise(F.col("top"))
        state = staged(met.select("conv", "size", low.alias("low"), high.alias("high")), "search")
        done = done.unionByName(state.filter("low >= high"))
        state = state.filter("low < high")
    done = done.select("conv", "size", "low", (F.col("low") + 1).alias("d"))

    # the edge that the next turn names, and how far the string goes along
    named = below.withColumn("d", F.col("top") + 1).join(_at(prefix, "rep", "d", hash="turn"), ["rep", "d"])
    named = named.select("d", "turn", "rep", F.col("depth").alias("node"), F.col("hash").alias("node_hash"))
    next_turn = done.join(_at(prefix, "conv", "d", hash="turn"), ["conv", "d"], "left")
    out = staged(next_turn.join(named, ["d", "turn"], "left").select("conv", "size", "low", "rep", "node", "node_hash"), "exits")
    along = out.filter("node is not null").select("conv", "rep", F.explode(F.expr("sequence(low + 1, least(node, size))")).alias("d"))
    along = along.join(_at(prefix, "conv", "d", hash="own"), ["conv", "d"]).join(_at(prefix, "rep", "d", hash="other"), ["rep", "d"])
    reached = along.filter("own = other").groupBy("conv").agg(F.max("d").alias("reached"))
    out = out.join(reached, "conv", "left").withColumn("at", F.coalesce("reached", "low"))
    out = out.join(_at(prefix, "conv", "at", hash="at_hash"), ["conv", "at"], "left")
    inside = F.col("at") > F.col("low")
    return staged(
        out.select(
            "conv", "size", "at", F.coalesce("at_hash", F.lit(0).cast("decimal(38,0)")).alias("at_hash"),
            F.when(inside, F.col("node")).alias("node"), F.when(inside, F.col("node_hash")).alias("node_hash"),
        ),
        "exits",
    )


def insert(nodes: DataFrame, strings: DataFrame, prefix: DataFrame, first: bool) -> DataFrame:
    """``nodes`` (top, top_hash, depth, hash, rep) after inserting ``strings`` (conv, size), all different."""
    if first:
        zero = F.lit(0).cast("long")
        left = strings.select("conv", "size", zero.alias("at"), zero.cast("decimal(38,0)").alias("at_hash"), F.lit(None).cast("long").alias("node"), F.lit(None).cast("decimal(38,0)").alias("node_hash"))
    else:
        left = exits(strings, prefix, nodes)

    # where edges are left, they are split: the pieces keep the conversation that stands for the edge
    splits = left.filter("node is not null").select(F.col("node").alias("depth"), F.col("node_hash").alias("hash"), "at", "at_hash").distinct()
    pieces = nodes.join(splits, ["depth", "hash"]).select("depth", "hash", "rep", "top", "top_hash", F.col("at").alias("end"), F.col("at_hash").alias("end_hash"))
    touched = staged(pieces, "splits")
    whole = touched.select("depth", "hash").distinct().join(nodes, ["depth", "hash"])
    touched = touched.unionByName(whole.select("depth", "hash", "rep", "top", "top_hash", F.col("depth").alias("end"), F.col("hash").alias("end_hash"))).distinct()
    along = Window.partitionBy("depth", "hash").orderBy("end")
    split = touched.select(
        F.coalesce(F.lag("end").over(along), "top").alias("top"), F.coalesce(F.lag("end_hash").over(along), "top_hash").alias("top_hash"),
        F.col("end").alias("depth"), F.col("end_hash").alias("hash"), "rep",
    )
    kept = nodes.join(touched.select("depth", "hash").distinct(), ["depth", "hash"], "left_anti").select(*split.columns)

    # new depths of the batch, as edges to the next prefix; a node is where strings end or more than one goes on
    path = staged(
        left.filter("at < size").select("conv", "size", "at", "at_hash").join(prefix, "conv").filter("d > at")
        .select("conv", "size", "at", "at_hash", "d", "hash"), "new-depths",
    )
    following = path.select("conv", (F.col("d") - 1).alias("d"), F.col("hash").alias("next"))
    steps = path.join(following, ["conv", "d"], "left").groupBy("d", "hash", "next").agg(F.min("conv").alias("rep"))
    marks = steps.groupBy("d", "hash").agg(F.count(F.lit(1)).alias("ways"), F.max(F.col("next").isNull()).alias("ends"), F.min("rep").alias("rep"))
    marks = staged(marks.filter("ends or ways > 1").select("d", "hash", "rep"), "marks")
    # the nodes on each string's new part, in order: each one's parent is the one before
    met = path.join(marks, ["d", "hash"])
    order = Window.partitionBy("conv").orderBy("d")
    new = met.select(
        "conv", "rep", F.coalesce(F.lag("d").over(order), "at").alias("top"), F.coalesce(F.lag("hash").over(order), "at_hash").alias("top_hash"),
        F.col("d").alias("depth"), "hash",
    ).filter("conv = rep")
    return staged(kept.unionByName(split).unionByName(new.select(*split.columns)), "nodes")


def _digests(members: DataFrame) -> DataFrame:
    """(depth, hash, digest) from (depth, hash, conv): SHA-256 over the ids, ascending, comma-joined."""
    parts = members.repartition("depth", "hash").sortWithinPartitions("depth", "hash", "conv")
    parts = parts.select("depth", F.col("hash").cast("string").alias("hash"), "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        out: list[tuple] = []
        for batch in batches:
            ids = batch.column("conv").cast(pa.string()).to_pylist()
            for *key, conv in zip(batch.column("depth").to_pylist(), batch.column("hash").to_pylist(), ids, strict=True):
                if key != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(conv.encode())
                else:
                    state.update(b"," + conv.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["depth", "hash", "digest"])
                out = []
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["depth", "hash", "digest"])

    made = parts.mapInArrow(run, "depth long, hash string, digest string")
    return made.withColumn("hash", F.col("hash").cast("decimal(38,0)"))


def prefix_nodes(conversations: DataFrame, turns: DataFrame, how: Trie | None = None) -> DataFrame:
    """One row per different prefix of the ``conversations`` (conv), whose ``turns`` are (conv, d, turn_hash, chars).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), the columns of the contract of operator 12.
    """
    how = how or Trie()
    prefix = prefixes(turns)
    zero = F.lit(0).cast("decimal(38,0)")
    # without a running total over each conversation: its last prefix is its deepest
    last = prefix.groupBy("conv").agg(F.max_by(F.struct("d", "hash"), "d").alias("last")).select("conv", "last.d", "last.hash")
    ends = conversations.join(last, "conv", "left").select("conv", F.coalesce("d", F.lit(0).cast("long")).alias("depth"), F.coalesce("hash", zero).alias("hash"))
    ends = staged(ends, "ends")
    strings = staged(ends.groupBy("depth", "hash").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")), "strings")

    # the root stands by itself; its conversation only matters by its id
    root = strings.agg(F.min("conv").alias("rep")).filter("rep is not null")
    nodes = staged(root.select(F.lit(-1).cast("long").alias("top"), zero.alias("top_hash"), F.lit(0).cast("long").alias("depth"), zero.alias("hash"), "rep"), "nodes")
    batch = F.pmod(F.xxhash64("hash", "depth"), F.lit(how.batches))
    for i in range(how.batches):
        part = strings.filter((batch == i) & (F.col("depth") > 0)).select("conv", F.col("depth").alias("size"))
        nodes = insert(nodes, part, prefix, first=i == 0)

    return _expanded(nodes, strings, ends, prefix)


def _expanded(nodes: DataFrame, strings: DataFrame, ends: DataFrame, prefix: DataFrame) -> DataFrame:
    """The rows of ``prefix_nodes`` from the compacted trie."""
    children = nodes.filter("depth > 0").groupBy(F.col("top").alias("depth"), F.col("top_hash").alias("hash")).agg(F.count(F.lit(1)).alias("ways"))
    upto = _at(prefix, "rep", "depth", upto="upto")
    start = _at(prefix, "rep", "top", upto="upto_top")
    full = (
        nodes.join(strings.select("depth", "hash", F.col("conv").alias("own"), "n"), ["depth", "hash"], "left")
        .join(children, ["depth", "hash"], "left")
        .join(upto, ["rep", "depth"], "left")
        .join(start, ["rep", "top"], "left")
    )
    length = F.coalesce(F.col("upto"), F.lit(0)) - F.coalesce(F.col("upto_top"), F.lit(0))
    full = staged(full.select("depth", "hash", "top", "top_hash", "rep", "own", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ways", F.lit(0)).alias("ways"), F.coalesce("upto", F.lit(0)).alias("upto"), length.alias("length")), "trie")

    # (node, node above or itself): the nodes on the path of the node's conversation
    on_path = full.select(F.col("rep").alias("conv"), "depth", "hash", "own", "n", (F.col("ways") == 0).cast("long").alias("leaf"), "length")
    known = full.select(F.col("depth").alias("u"), F.col("hash").alias("u_hash"))
    up = prefix.select("conv", F.col("d").alias("u"), F.col("hash").alias("u_hash")).join(known, ["u", "u_hash"])
    pairs = on_path.join(staged(up, "nodes-on-paths"), "conv").filter("u <= depth")
    at_root = on_path.withColumn("u", F.lit(0).cast("long")).withColumn("u_hash", F.lit(0).cast("decimal(38,0)"))
    pairs = staged(pairs.unionByName(at_root.select(*pairs.columns)), "paths")
    sums = pairs.groupBy("u", "u_hash").agg(F.sum("n").alias("n_convs"), F.min("own").alias("conv_id"), F.sum("leaf").alias("n_leaves"))
    sums = staged(sums.select(F.col("u").alias("depth"), F.col("u_hash").alias("hash"), "n_convs", "conv_id", "n_leaves"), "members")
    saved = full.join(sums, ["depth", "hash"]).select("depth", "hash", ((F.col("n_convs") - 1) * F.col("length")).alias("saved"))
    saved = pairs.select("depth", "hash", "u", "u_hash").join(staged(saved, "saved"), ["depth", "hash"])
    saved = saved.groupBy(F.col("u").alias("depth"), F.col("u_hash").alias("hash")).agg(F.sum("saved").alias("below"))

    parents = sums.select(F.col("depth").alias("top"), F.col("hash").alias("top_hash"), F.col("conv_id").alias("above"))
    trie = full.join(sums, ["depth", "hash"]).join(saved, ["depth", "hash"]).join(parents, ["top", "top_hash"], "left")
    trie = trie.join(_digests(ends), ["depth", "hash"], "left")
    every = trie.withColumn("d", F.explode(F.expr("sequence(greatest(top + 1, 0L), depth)")))
    before = prefix.select(F.col("conv").alias("rep"), (F.col("d") + 1).alias("d"), F.col("upto").alias("before"))
    every = every.join(before, ["rep", "d"], "left")
    last = F.col("d") == F.col("depth")
    # the edge's own part of `below` covers all its depths; a node counts those from its own on
    upper = (F.col("n_convs") - 1) * (F.coalesce("before", F.lit(0)) - F.col("upto") + F.col("length"))
    return every.select(
        "conv_id", F.col("d").alias("depth"), F.when(F.col("d") == F.col("top") + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("ways")).otherwise(1).alias("n_children"), "n_leaves", (F.col("below") - upper).alias("saved_tokens"),
        F.when(last & F.col("digest").isNotNull(), F.col("digest")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv) and their turns after each takes its opening from its hundred's first (a rule of the contract)."""
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(6))
    lead = F.col("conv") - F.col("conv") % 100
    convs = staged(turns.groupBy("conv").agg(F.max("d").alias("own")).withColumn("h", h).withColumn("lead", lead), "conversations")
    base = convs.select(F.col("conv").alias("lead"), F.col("own").alias("lead_turns"))
    convs = staged(convs.join(base, "lead", "left").withColumn("taken", F.least("h", F.coalesce("lead_turns", F.lit(0)))), "conversations")
    # at most 5 turns of a leader, for the 100 conversations that it leads
    opening = convs.select("conv", "lead", "taken").join(turns.filter("d <= 5").withColumnRenamed("conv", "lead"), "lead").filter("d <= taken")
    own = turns.join(convs.select("conv", "h", "taken"), "conv").filter("d > h").withColumn("d", F.col("d") - F.col("h") + F.col("taken"))
    columns = ["conv", "d", "turn_hash", "chars"]
    return convs.select("conv"), opening.select(*columns).unionByName(own.select(*columns))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations (contract of operator 12)."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    convs, turns = rebuilt(staged(ordered_turns(table), "turns"))
    return prefix_nodes(convs, turns)
