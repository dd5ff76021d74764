import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from zonekit.llm import sharding as S


def law(good: int, bad: int, drawn: int) -> dict[int, float]:
    every = math.comb(good + bad, drawn)
    return {k: math.comb(good, k) * math.comb(bad, drawn - k) / every for k in range(max(0, drawn - bad), min(good, drawn) + 1)}


def far_off(seen: Counter, want: dict, n: int) -> float:
    """Chi square over its degrees of freedom."""
    return sum((seen[k] - n * p) ** 2 / (n * p) for k, p in want.items() if n * p > 1) / max(1, len(want) - 1)


@pytest.mark.parametrize("good, bad, drawn", [(5, 7, 4), (3, 1, 3), (20, 30, 25), (1, 999, 500), (400, 600, 30)])
def test_draws_follow_the_law(good, bad, drawn):
    rng = np.random.default_rng(3)
    n = 20_000
    seen = Counter(S.hypergeometric(rng, good, bad, drawn) for _ in range(n))
    want = law(good, bad, drawn)
    assert set(seen) <= set(want) and far_off(seen, want, n) < 2.5


def test_draws_of_large_numbers():
    rng = np.random.default_rng(4)
    draws = [S.hypergeometric(rng, 10**10, 39 * 10**10, 10**7) for _ in range(300)]
    sd = math.sqrt(10**7 / 40 * 39 / 40)
    assert abs(np.mean(draws) - 250_000) < 5 * sd / math.sqrt(300) and 0.8 < np.std(draws) / sd < 1.2


def test_matrix_has_exact_margins_and_the_joint_law(spark):
    counts = [(p, n) for p, n in enumerate([7, 0, 30, 1, 12, 50])]
    for block in (1, 2, 1024):
        how = S.Deal(shards=7, block=block)
        got = {r.part: np.diff([0, *r.upto]) for r in S.matrix(spark.createDataFrame(counts, "part long, n long"), how).collect()}
        assert {p: sum(x) for p, x in got.items()} == dict(counts)
        assert np.sum(list(got.values()), axis=0).tolist() == S.shard_sizes(100, 7)


def test_draws_of_several_shards_follow_the_joint_law():
    rng, n = np.random.default_rng(5), 20_000
    seen = Counter(tuple(S.drawn_counts(rng, 3, [2, 2, 1])) for _ in range(n))
    # all ways of taking 3 of 5 places
    ways = Counter(tuple(taken.count(s) for s in range(3)) for taken in itertools.combinations([0, 0, 1, 1, 2], 3))
    assert far_off(seen, {k: v / 10 for k, v in ways.items()}, n) < 3


def check_deal(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@pytest.mark.parametrize("bucket_rows", [1, 1 << 16])
def test_every_row_has_a_slot_and_columns_pass(spark, corpus, edge, bucket_rows):
    for docs in (corpus, edge, edge.withColumn("shard", edge.part).withColumn("m", S.F.create_map("lang", "text"))):
        how = S.Deal(shards=5, bucket_rows=bucket_rows)
        out = S.sharded(docs, how)
        shard, slot = out.columns[-2:]
        assert out.columns[:-2] == docs.columns and slot == "slot"
        check_deal(out.select(S.quoted(shard).alias("shard"), "slot").collect(), 5)
        assert sorted(map(repr, out.drop(shard, slot).collect())) == sorted(map(repr, docs.collect()))
    assert S.sharded(edge.limit(0)).count() == 0
    check_deal(S.sharded(edge.limit(3)).collect(), 40)


def test_query_columns(spark):
    rows = S.op11_shuffled_shards(spark, "/root/testdata/sf0.001").collect()
    check_deal(rows, 40)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert sorted(texts) == sorted(r.doc_id for r in rows)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    again = S.op11_shuffled_shards(spark, "/root/testdata/sf0.001").collect()
    assert sorted(rows) == sorted(again)


def test_rows_go_anywhere(spark):
    """Over many seeds each row of a small table is in each shard, and at each slot, equally often."""
    table = spark.range(12, numPartitions=3)
    n, where = 24, Counter()
    for seed in range(n):
        for r in S.sharded(table, S.Deal(shards=3, seed=seed)).collect():
            where[r.id, r.shard] += 1
    want = n / 3
    chi = sum((where[i, s] - want) ** 2 / want for i in range(12) for s in range(3))
    assert chi < 24 + 6 * math.sqrt(2 * 24)
