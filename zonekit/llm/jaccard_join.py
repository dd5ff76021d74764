"""Similarity self-join on word shingles: a MinHash LSH forest, then exact verification.

A text is the set of its runs of five words (its whole word sequence where
it has fewer).  Each of ``trees`` prefix tries orders the texts by a label of
``depth`` MinHash values: the labels are sorted over range partitions, and how
many values a label shares with the one before it is where its path leaves the trie.

Texts that meet below a trie node are candidates.  The matched prefix starts
at the full label and is shortened until a round has ``share`` of all meetings
to offer, so values that part few texts cost no round of their own.  Each round
joins the groups so far that meet at the shorter prefix.  It ends
when a pair exactly at the threshold meets in some tree with
probability ``recall``: the target is a guarantee for every pair, so no link
is given up for a good average.

All leaves below a node are tied to its first one, which is linear in
the texts, and connected components of these ties are the candidate groups.
A group is compared exactly, on its words by their bytes, as a product of its
shingle incidence matrix: large groups are cut into blocks by node hash, and
every pair of blocks is a task of bounded size that returns link counts and a
spanning forest, never the pairs.  Texts of equal word sequences are one node
with a weight (by two independent hashes, 128 bits).

Edge cases: a text without words (or null) has no shingle, is linked to
nothing and is a class of its own; a null id sorts after every other; rows
that repeat id and text count as copies; an empty table gives an empty
result; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import documents, keep_rows, quoted, row_key, staged, text_or_empty, text_slices
from zonekit.llm.components import components, members, stars
from zonekit.llm.wordhash import mix, span_hashes, span_numbers, text_block, window_hashes, window_numbers, words


@dataclass(frozen=True)
class Forest:
    shingle: int = 5
    threshold: float = 0.8
    trees: int = 16
    depth: int = 8
    recall: float = 0.9995
    share: float = 0.5
    #: texts and words of one block; two blocks are compared by one task
    block_texts: int = 256
    block_words: int = 1 << 20

    def matched(self) -> int:
        """The prefix length at which a pair at the threshold is met with probability ``recall``."""
        length = self.depth
        while length > 1 and 1 - (1 - self.threshold**length) ** self.trees < self.recall:
            length -= 1
        return length


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash) of every shingle in text order, and a 128-bit key of each word sequence."""
    data, off = text_block(texts)
    start, end, doc = words(data, off)
    hashes = span_hashes(data, start, end)
    n = len(off) - 1
    keys = np.stack([_sequence(hashes, doc, n), _sequence(span_hashes(data, start, end, 1), doc, n)], axis=1)
    at, runs = window_hashes(hashes, doc, size)
    owner = doc[at]
    n_words = np.bincount(doc, minlength=n)[:n]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    owner, runs = np.concatenate([owner, short]), np.concatenate([runs, mix(keys[short, 0] + np.uint64(3))])
    order = np.argsort(owner, kind="stable")
    return owner[order], runs[order], keys


def exact_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, number) of every shingle of a block; equal shingles, word by word and byte by byte, only have one number."""
    data, off = text_block(texts)
    start, end, doc = words(data, off)
    numbers = span_numbers(data, start, end)
    n_words = np.bincount(doc, minlength=len(off) - 1)
    owners, found = [], []
    for length in range(1, size + 1):
        at, runs = window_numbers(numbers, doc, length)
        owner = doc[at]
        wanted = n_words[owner] >= size if length == size else n_words[owner] == length
        owners.append(owner[wanted])
        found.append(runs[wanted] * size + length % size)
    return np.concatenate(owners), np.concatenate(found)


def _sequence(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """One hash per document over its words in order: words are spread by place, then added."""
    first = np.searchsorted(doc, np.arange(n + 1))
    place = (np.arange(len(doc)) - first[doc]).astype(np.uint64) if len(doc) else np.zeros(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes ^ mix(place + np.uint64(11))))])
    return mix(sums[first[1:]] - sums[first[:-1]] + (first[1:] - first[:-1]).astype(np.uint64))


def labels(owner: np.ndarray, hashes: np.ndarray, n: int, forest: Forest) -> np.ndarray:
    """MinHash values of each text, shape (n, trees, depth), 32 bits each."""
    rng = np.random.default_rng(20240517)
    factors = rng.integers(0, 1 << 63, size=(forest.trees, forest.depth), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((n, forest.trees, forest.depth), dtype=np.uint32)
    if not len(owner):
        return out
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    who = owner[heads]
    # blocks of whole texts that stay in the processor's cache
    cut = 0
    while cut < len(heads):
        stop = max(cut + 1, int(np.searchsorted(heads, heads[cut] + (1 << 15), side="right")) - 1)
        lo, hi = heads[cut], heads[stop] if stop < len(heads) else len(hashes)
        block, at = hashes[lo:hi], heads[cut:stop] - lo
        room = np.empty_like(block)
        for tree in range(forest.trees):
            for level in range(forest.depth):
                np.multiply(block, factors[tree, level], out=room)
                out[who[cut:stop], tree, level] = mix(np.minimum.reduceat(room, at)) >> np.uint64(32)
        cut = stop
    return out


def sign(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row, sequence, n_shingles, labels) of every row; a label is a tree's number and its values, in bytes that sort alike."""
    width = 2 + 4 * forest.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 2 << 20):
            owner, hashes, keys = shingles(batch.column("body"), forest.shingle)
            n = batch.num_rows
            values = labels(owner, hashes, n, forest).astype(">u4").view(np.uint8).reshape(n, forest.trees, width - 2)
            trees = np.broadcast_to(np.arange(forest.trees, dtype=">u2").view(np.uint8).reshape(1, forest.trees, 2), (n, forest.trees, 2))
            raw = np.ascontiguousarray(np.concatenate([trees, values], axis=2))
            flat = pa.Array.from_buffers(pa.binary(width), n * forest.trees, [None, pa.py_buffer(raw)]).cast(pa.binary())
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * forest.trees)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array(np.bincount(owner, minlength=n)[:n].astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["doc_id", "row", "sequence", "n_shingles", "labels"],
            )

    body = text_or_empty(text)
    rows = docs.select(quoted(key).alias("doc_id"), row_key(quoted(key), body).alias("row"), body.alias("body"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row string, sequence binary, n_shingles long, labels array<binary>")


def neighbours(nodes: DataFrame, forest: Forest) -> DataFrame:
    """(a, b, matched, across, heads): each leaf ``a``, the one before it in its tree's sorted labels, and how many values they share.

    ``heads`` has, for every prefix length, the first leaf below the same node as ``a``, of
    those in the same range partition; ``across``: the leaf before is in another one.
    """
    leaves = nodes.filter("n_shingles > 0").select(F.explode("labels").alias("label"), "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the node is part of the order, so that equal labels, however many, can be dealt
    cut = staged(leaves.repartitionByRange(parts, "label", "node").withColumn("part", F.spark_partition_id()), "leaves")
    order = Window.partitionBy("part").orderBy("label", "node")
    # a partition's first leaf follows the last one of the partition before: one row per partition
    last = cut.groupBy("part").agg(F.max(F.struct("label", "node")).alias("end"))
    last = last.select("part", F.lag("end").over(Window.orderBy("part")).alias("before"))
    pairs = cut.withColumn("ahead", F.lag(F.struct("label", "node")).over(order)).join(F.broadcast(last), "part")
    ahead = F.coalesce("ahead", "before")
    matched = F.lit(0)
    for k in range(1, forest.depth + 1):
        same = F.substring("label", 1, 2 + 4 * k) == F.substring(ahead["label"], 1, 2 + 4 * k)
        matched = F.when(same, F.lit(k)).otherwise(matched)
    met = pairs.select("part", "label", "node", ahead["node"].alias("b"), matched.alias("matched"), F.col("ahead").isNull().alias("across"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    begins = [F.col("across") | (F.col("matched") < k) for k in range(1, forest.depth + 1)]
    heads = F.array(*[F.last(F.when(x, F.col("node")), ignorenulls=True).over(so_far) for x in begins])
    return met.select(F.col("node").alias("a"), "b", "matched", "across", heads.alias("heads")).filter("matched > 0")


def candidate_groups(nodes: DataFrame, forest: Forest, shortest: int | None = None) -> DataFrame:
    """(node, root) of the texts that meet another below a trie node.

    The prefix is shortened until the recall is met, or down to ``shortest`` values.
    """
    shortest = shortest or forest.matched()
    ties = staged(neighbours(nodes, forest).filter(F.col("matched") >= shortest), "ties")
    at_length = {r.matched: r["count"] for r in ties.groupBy("matched").count().collect()}  # one number for each length
    groups, waiting = None, 0
    for length in range(forest.depth, shortest - 1, -1):
        waiting += at_length.get(length, 0)
        if waiting < forest.share * sum(at_length.values()) and length > shortest:
            continue
        meet, waiting = ties.filter(F.col("matched") >= length), 0
        met = meet.select("a", F.get("heads", F.lit(length - 1)).alias("b")).unionByName(meet.filter("across").select("a", "b"))
        if groups is not None:  # what a group holds stays together
            met = met.unionByName(groups.select(F.col("u").alias("a"), F.col("v").alias("b")))
        groups = stars(met, "a", "b")
    return members(groups) if groups is not None else nodes.select("node", F.col("node").alias("root")).limit(0)


def placed(wanted: DataFrame, forest: Forest) -> DataFrame:
    """``wanted`` (node, root, n_shingles, ...) with (block, blocks): its place in its group's blocks."""
    sizes = wanted.groupBy("root").agg(F.count(F.lit(1)).alias("texts"), F.sum("n_shingles").alias("total"))
    blocks = F.ceil(F.greatest(F.col("texts") / forest.block_texts, F.col("total") / forest.block_words)).cast("int")
    sized = wanted.join(sizes.select("root", F.greatest(blocks, F.lit(1)).alias("blocks")), "root")
    return sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def verified(members: DataFrame, forest: Forest) -> DataFrame:
    """(node, links, text_links, head) of every member, from exact comparison within its group.

    ``members``: (node, root, weight, block, blocks, body).  ``links`` counts
    rows, ``text_links`` different texts; ``head`` is the least node that the
    task found connected with the node.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = members.withColumn("other", other).select(
        # one key, so that rows dealt by group do not pass for dealt by unit
        F.struct("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).alias("unit"),
        "block", "node", "weight", "body",
    )

    def compare(key: tuple, unit: pa.Table) -> pa.Table:
        node = unit.column("node").to_numpy()
        linked = links_within(unit.column("body"), forest)
        block = unit.column("block").to_numpy()
        unit_key = key[0].as_py()
        if unit_key["low"] != unit_key["high"]:
            linked &= block[:, None] != block[None, :]
        weight = unit.column("weight").to_numpy()
        return pa.table(
            {
                "node": node,
                "links": linked @ weight,
                "text_links": linked.sum(axis=1),
                "head": _heads(linked, node),
            }
        )

    return units.groupBy("unit").applyInArrow(compare, "node long, links long, text_links long, head long")


def links_within(texts: pa.Array, forest: Forest) -> np.ndarray:
    """Which texts of a unit have a Jaccard similarity of the threshold or more (no text with itself)."""
    owner, hashes = exact_shingles(texts, forest.shingle)
    n = len(texts)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    owner, hashes = owner[fresh], hashes[fresh]
    size = np.bincount(owner, minlength=n)
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[which] > 1
    owner, which = owner[shared], np.unique(which[shared], return_inverse=True)[1]
    common = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    step = 2048
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, step):
        a, b = np.searchsorted(which, [lo, lo + step])
        part = np.zeros((n, step), dtype=np.float32)
        part[owner[a:b], which[a:b] - lo] = 1
        common += part @ part.T
    common = common.astype(np.float64)  # counts below 2**24 are exact in float32
    union = size[:, None] + size[None, :] - common
    linked = (common >= forest.threshold * union - 1e-9) & (union > 0)
    np.fill_diagonal(linked, False)
    return linked


def _heads(linked: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node connected with each node."""
    head = node.copy()
    big = np.iinfo(np.int64).max
    while True:
        near = np.where(linked, head[None, :], big).min(axis=1, initial=big)
        lower = np.minimum(head, near)
        if (lower == head).all():
            return head
        head = lower


def similar(docs: DataFrame, forest: Forest | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (doc_id, row, class_id, class_row, n_links, n_text_links).

    ``class_id`` is the least id among all rows connected by links,
    ``class_row`` the key of that row.
    """
    forest = forest or Forest()
    signed = staged(sign(docs, forest, key, text), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    nodes = signed.groupBy("sequence").agg(
        first,
        F.count(F.lit(1)).alias("weight"),
        F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("labels").alias("labels"),
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    groups = candidate_groups(nodes, forest)
    wanted = nodes.join(groups, "node").select("node", "root", "weight", "n_shingles", F.col("first.row").alias("row"))
    wanted = staged(placed(wanted, forest), "placed")
    body = text_or_empty(text)
    bodies = docs.select(row_key(quoted(key), body).alias("row"), body.alias("body"))
    bodies = staged(bodies.join(wanted.hint("merge"), "row").dropDuplicates(["row"]).drop("row"), "members")
    found = staged(verified(bodies, forest), "verified")

    links = found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    classes = components(found.select("node", "head"), "node", "head")
    named = nodes.select("node", "sequence", "first", "weight", "n_shingles").join(classes, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    named = named.join(heads, "root").join(links, "node", "left")
    copies = F.when(F.col("n_shingles") > 0, F.col("weight") - 1).otherwise(F.lit(0))
    result = named.select(
        "sequence",
        "head",
        (F.coalesce("links", F.lit(0)) + copies).alias("n_links"),
        F.coalesce("text_links", F.lit(0)).alias("n_text_links"),
    )
    alone = F.col("n_shingles") == 0
    return (
        signed.select("doc_id", "row", "sequence", "n_shingles")
        .join(result, "sequence")
        .select(
            "doc_id",
            "row",
            F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
            F.when(alone, F.col("row")).otherwise(F.col("head.row")).alias("class_row"),
            "n_links",
            "n_text_links",
        )
    )


def one_per_class(docs: DataFrame, forest: Forest | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that head their class, in its columns."""
    return keep_rows(docs, similar(docs, forest, key, text).filter("row = class_row").select("row"), key, text)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and its number of links."""
    return similar(documents(spark, sf_dir).select("doc_id", "text")).drop("row", "class_row")
