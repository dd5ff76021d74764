import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from zonekit.llm import components as connected
from zonekit.llm import exact_dedup, fuse, jaccard_join, quality, wordhash
from zonekit.llm.components import components


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 1 << 32))
def test_fuse_filter_has_no_false_negative(n, seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 1 << 63, size=n, dtype=np.uint64)
    made = fuse.build(keys)
    assert fuse.contains(made, keys).all()
    others = rng.integers(0, 1 << 63, size=2000, dtype=np.uint64)
    assert fuse.contains(made, others).mean() < 0.03


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\nü漢", max_size=30)), max_size=6))
def test_words_of_a_block(texts):
    data, off = wordhash.text_block(pa.array(texts, pa.string()))
    start, end, doc = wordhash.words(data, off)
    got = [(int(d), data[a:b].tobytes().decode()) for a, b, d in zip(start, end, doc)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in brute.words(t)]
    hashes = wordhash.span_hashes(data, start, end, target=5)
    seen = {}
    for (_, w), h in zip(got, hashes):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    a, b, d = wordhash.lines(data, off)
    assert [(int(k), data[x:y].tobytes().decode()) for x, y, k in zip(a, b, d)] == [
        (i, line) for i, t in enumerate(texts) for line in (t or "").split("\n")
    ]


def test_exact_copies_equal_brute_force(corpus, plain):
    got = {r.doc_id: (r.keep_id, r.group_size, r.digest) for r in exact_dedup.mark_copies(corpus).collect()}
    assert got == brute.copies(plain)


def test_exact_copies_edges(edge):
    rows = exact_dedup.mark_copies(edge).collect()
    assert len(rows) == edge.count()
    groups = {}
    for r in rows:
        groups.setdefault(r.digest, []).append(r)
    for members in groups.values():
        assert sum(r.kept for r in members) == 1 and {r.group_size for r in members} == {len(members)}
        ids = [r.doc_id for r in members if r.doc_id is not None]
        assert {r.keep_id for r in members} == {min(ids) if ids else None}
    kept = exact_dedup.drop_copies(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 8, 9]
    assert exact_dedup.mark_copies(edge.limit(0)).count() == 0
    assert exact_dedup.drop_copies(edge.limit(0)).count() == 0


def test_snapshot_screens_a_later_batch(spark):
    old = spark.createDataFrame([(f"d{i}", f"text {i}") for i in range(500)], "digest string, body string")
    made = exact_dedup.build_snapshot(old, old.select("digest"), "test")
    new = spark.createDataFrame([(f"d{i}",) for i in range(400, 900)], "digest string")
    hits = {r.digest for r in exact_dedup.screen(new, made).collect()}
    assert {f"d{i}" for i in range(400, 500)} <= hits and len(hits) < 130
    # a digest that is there with another text is no copy
    bodies = spark.createDataFrame([("1", "d450", "text 450"), ("2", "d460", "other")], "rep string, digest string, body string")
    reps = bodies.select("digest", "rep")
    assert [r.digest for r in exact_dedup.confirmed(reps, bodies, made).collect()] == ["d450"]


def test_similar_documents_equal_brute_force(corpus, plain):
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.similar(corpus).collect()}
    assert got == brute.similar(plain)


def test_similar_group_over_many_blocks(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: 56], f"x{i}", f"y{i}"])) for i in range(90)] + [(1000, "another text of its own, with no partner")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    forest = jaccard_join.Forest(block_texts=16)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.similar(docs, forest).collect()}
    assert got == brute.similar(rows) and got[5] == (0, 89)


def test_matched_prefix_reaches_the_recall():
    forest = jaccard_join.Forest()
    length = forest.matched()
    assert 1 - (1 - 0.8**length) ** forest.trees >= forest.recall
    assert 1 - (1 - 0.8 ** (length + 1)) ** forest.trees < forest.recall


def test_recall_grows_as_prefixes_are_shortened(spark):
    """Pairs around the threshold, against brute force: each round ties more, the last ones all but the target allows."""
    rng = random.Random(5)
    rows = []
    for i in range(160):
        w = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        rows.append((2 * i, " ".join(w)))
        for at in rng.sample(range(len(w)), rng.choice([0, 1, 1, 2, 2])):
            w[at] = "changed"
        rows.append((2 * i + 1, " ".join(w)))
    sets = [brute.shingle_set(t) for _, t in rows]
    near = [2 * i for i in range(160) if len(sets[2 * i] & sets[2 * i + 1]) >= 0.8 * len(sets[2 * i] | sets[2 * i + 1])]
    forest = jaccard_join.Forest()
    signed = jaccard_join.sign(spark.createDataFrame(rows, "doc_id long, text string"), forest).withColumnRenamed("doc_id", "node")
    recall = []
    for shortest in (8, 6, forest.matched()):
        root = {r.node: r.root for r in jaccard_join.candidate_groups(signed, forest, shortest).collect()}
        recall.append(sum(root.get(a, a) == root.get(a + 1, a + 1) for a in near) / len(near))
    assert len(near) > 100 and recall == sorted(recall) and recall[0] > 0.9 and recall[-1] >= 1 - 1 / len(near)


def test_neighbours_share_what_their_labels_share(spark):
    forest = jaccard_join.Forest(trees=2, depth=3)
    values = {1: (5, 6, 7), 2: (5, 6, 8), 3: (5, 9, 9), 4: (5, 6, 7), 5: (1, 1, 1)}
    rows = [(n, 1, [bytes([0, t]) + b"".join(x.to_bytes(4, "big") for x in (v if t else (n, n, n))) for t in (0, 1)]) for n, v in values.items()]
    nodes = spark.createDataFrame(rows, "node long, n_shingles long, labels array<binary>")
    got = {(r.a, r.b): r.matched for r in jaccard_join.neighbours(nodes, forest).collect()}
    assert got == {(4, 1): 3, (2, 4): 2, (3, 2): 1}


def test_hashes_tell_patterns_and_their_complements_apart(spark):
    """A Thue-Morse word and its complement: equal for any polynomial of their bytes modulo a power of two."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    data, off = wordhash.text_block(pa.array([a, b]))
    assert len(set(wordhash.span_hashes(data, off[:-1], off[1:]))) == len(set(wordhash.span_hashes(data, off[:-1], off[1:], 1))) == 2
    rows = [(1, f"{a} x y z w v"), (2, f"{b} x y z w v"), (3, a), (4, b)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.similar(rows)
    judged = quality.judge(pa.array([f"{a}\n{b}\n{a}"]), quality.Rules())
    assert judged["n_dup_lines"].tolist() == [1]


def test_exact_window_numbers():
    rng = np.random.default_rng(2)
    numbers, doc = rng.integers(0, 3, 400), np.sort(rng.integers(0, 9, 400))
    for size in (1, 2, 3, 5, 8, 11):
        at, got = wordhash.window_numbers(numbers, doc, size)
        runs = [(tuple(numbers[i : i + size])) for i in range(401 - size) if doc[i] == doc[i + size - 1]]
        assert len(at) == len(runs) and len(set(zip(got.tolist(), runs))) == len(set(runs)) == len(set(got.tolist()))


def test_similar_edges(edge):
    rows = jaccard_join.similar(edge).collect()
    assert len(rows) == edge.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].class_id == by_id[6].class_id == by_id[7].class_id == 5 and by_id[5].n_links == 3
    assert by_id[2].class_id == 2 and by_id[2].n_links == 0 and by_id[9].n_links == 1
    assert jaccard_join.similar(edge.limit(0)).count() == 0
    kept = jaccard_join.one_per_class(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(9) == 1 and ids.count(5) == 1 and 6 not in ids and 7 not in ids


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_random_edges(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(500, i) for i in range(501, 560)] + [(3, None)]
    least = list(range(560))

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in edges[:-1]:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    rows = components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert len({r.node for r in rows}) == len(rows)
    assert {r.node: r.root for r in rows} == {x: root(x) for a, b in edges[:-1] if a != b for x in (a, b)}


def test_components_write_few_tables(spark, monkeypatch):
    """Nodes tied to many heads, as by the trees of the join: each written table is a file for every partition."""
    written = []
    monkeypatch.setattr(connected, "staged", lambda df, name, f=connected.staged: written.append(name) or f(df, name))
    rng = random.Random(7)
    edges = [(i, rng.randrange(i // 50 * 50, i + 1)) for i in range(2000) for _ in range(16)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()}
    assert all(got[i] == i // 50 * 50 for i in got)
    assert len(written) <= 4
