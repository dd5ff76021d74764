import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from zonekit.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(turns)] for c, turns in said.items()}
    out = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = said.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def trie(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
            for p, ids in members.items()
        ),
        key=repr,
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def hashed(spark, convs):
    """Conversations and turns as ``prefix_nodes`` takes them."""
    turns = [(c, d, f"{r}:{t}", len(t)) for c, w in convs.items() for d, (r, t) in enumerate(w, 1)]
    return (
        spark.createDataFrame([(c,) for c in convs], "conv long"),
        spark.createDataFrame(turns, "conv long, d long, turn_hash string, chars long"),
    )


def random_convs(seed):
    """Chains, copies, branches at every depth, one long conversation."""
    rng = random.Random(seed)
    out = {}
    for c in range(60):
        if out and rng.random() < 0.7:
            base = out[rng.choice(list(out))]
            out[c] = base[: rng.randint(0, len(base))] + [("u", "x" * rng.randint(0, 3)) for _ in range(rng.choice([0, 0, 1, 2, 9]))]
        else:
            out[c] = [("u", rng.choice("ab") * rng.randint(0, 2)) for _ in range(rng.choice([0, 1, 3, 8, 70]))]
    return out


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 2), (3, 3)])
def test_trie_equals_brute_force_in_any_number_of_batches(spark, seed, batches):
    convs = random_convs(seed)
    assert rows_of(T.prefix_nodes(*hashed(spark, convs), T.Trie(batches))) == trie(convs)


def test_nested_chain_is_split_edge_by_edge(spark):
    long = [("u", str(i)) for i in range(40)]
    convs = {100 - n: long[:n] for n in (0, 1, 2, 7, 8, 31, 32, 40)} | {200 + n: long[:n] + [("u", "off")] for n in (0, 3, 7, 32)}
    assert rows_of(T.prefix_nodes(*hashed(spark, convs), T.Trie(4))) == trie(convs)


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "low long, high long").withColumn("f", T.two_fattest("low", "high"))
    for r in got.collect():
        assert r.f == max(range(r.low + 1, r.high + 1), key=lambda x: x & -x)


EDGE = [
    (0, 1, "user", "a"), (0, None, "user", "first"), (0, 0, None, None), (0, 2, "user", ""), (0, 2, "user", ""),
    (1, 0, "user", "x"), (2, None, None, None), (101, 0, "user", "no leader"), (None, 0, "user", "left aside"),
    (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "user", "a"), (4, 1, "user", "long 🙂 " * 20_000), (-7, 0, "user", "é"),
]


def test_query_on_the_table_and_on_edges(spark, tmp_dir):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(T.op12_prefix_trie(spark, "/root/testdata/sf0.001")) == trie(rebuilt(rows))
    schema = "conv_id long, turn long, role string, text string"
    for name, some in (("edge", EDGE), ("empty", [])):
        extra = spark.createDataFrame(some, schema).withColumn("hash", F.lit("x")).withColumn("part", F.lit(1))
        extra.write.parquet(f"{tmp_dir}/{name}/conversations.parquet")
        assert rows_of(T.op12_prefix_trie(spark, f"{tmp_dir}/{name}")) == trie(rebuilt(some))
