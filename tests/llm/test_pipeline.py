import hashlib
import math
import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm import brute
from zonekit.llm.common import staged, working_folder
from zonekit.llm.oracle import ORACLE_SQL
from zonekit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_the_columns_of_documents(spark, corpus):
    docs = corpus
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), "stage")
        assert docs.columns == corpus.columns, name
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "packing",
    ]


def test_pipeline_stages_equal_brute_force(spark, corpus):
    (_, quality), (_, exact), (_, near) = corpus_pipeline.STAGES[:3]
    first = staged(quality(spark, corpus, SF), "one")
    rows = [(r.doc_id, r.text) for r in first.collect()]
    second = staged(exact(spark, first, SF), "two")
    kept = {d: t for d, t in rows if brute.copies(rows)[d][0] == d}
    assert {r.doc_id: r.text for r in second.collect()} == kept
    third = near(spark, second, SF)
    classes = brute.similar(list(kept.items()))
    assert sorted(r.doc_id for r in third.collect()) == sorted(d for d in kept if classes[d][0] == d)


def test_pipeline_runs_whole_and_leaves_its_stages_only(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "ids"} <= set(out.columns)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left == {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES}


def test_a_working_folder_is_removed_whatever_happens(spark):
    with pytest.raises(ZeroDivisionError), working_folder(spark) as folder:
        assert staged(spark.range(3), "some").count() == 3 and os.listdir(folder.removeprefix("file://"))
        raise ZeroDivisionError
    assert not os.path.exists(folder.removeprefix("file://"))


def test_mixing_stage_equals_brute_force(spark, corpus):
    """Words of every document after the fourth stage: the prefix of the global order, and what each source had begun."""
    docs = staged(corpus, "mix-input")
    sizes, queues = defaultdict(int), defaultdict(list)
    for r in docs.collect():
        n = len(brute.words(r.text))
        sizes[r.source] += n
        queues[r.source].append((hashlib.md5(f"17:{r.doc_id}".encode()).hexdigest(), r.doc_id, n))
    target = brute.mix_targets(sizes)
    offers = []
    for sid, s in enumerate(sorted(queues)):
        given = 0
        for n_pass in (0, 1):
            for h, d, n in sorted(queues[s]):
                offers.append(((given + n) / target[s], sid, n_pass, h, d, n, s, given))
                given += n
    offers.sort(key=lambda x: x[:6])
    total, end = 0, 0.0
    for offer in offers:
        total += offer[5]
        end = offer[0]
        if total >= 1.5 * sum(sizes.values()):
            break
    want = Counter()
    for finish, _, _, _, d, n, s, given in offers:
        want[d] += n if finish <= end else max(0, min(n, math.floor(target[s] * end) - given))
    got = Counter()
    for r in dict(corpus_pipeline.STAGES)["mixing sources to target weights"](spark, docs, SF).collect():
        got[r.doc_id] += len(brute.words(r.text))
    assert +got == +want


def test_stages_on_edges(spark, edge):
    """Nulls, empty and very long texts, repeated rows and clashing columns through all stages, and an empty table."""
    for docs in (edge, edge.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert set(docs.columns) >= {"doc_id"}
            docs = staged(stage(spark, docs, SF), "edge")
    assert docs.count() == 0
    kept = edge
    for _, stage in corpus_pipeline.STAGES[1:]:  # without the rules, which reject all of these short texts
        kept = staged(stage(spark, kept, SF), "edge")
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 8, 9}


def test_every_operator_has_a_query():
    assert sorted({int(k[2:].split("_")[0]) for k in QUERIES}) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.sql(f"create view {name} as select * from read_parquet('{SF}/{name}.parquet')")
    for name, sql in ORACLE_SQL.items():
        want = con.sql(sql)
        columns = sorted(want.columns)
        got = QUERIES[name](spark, SF)
        assert sorted(got.columns) == columns, name
        left = sorted((tuple(r) for r in con.sql(f"select {', '.join(columns)} from want").fetchall()), key=repr)
        right = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
        assert left == right, name
