import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm import brute
from zonekit.llm import periodic_runs as P


def runs_of(w: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: every period from 1 on, every stretch."""
    found: dict = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((i, j - i, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def rewritten(doc_id: int | None, w: list[str]) -> list[str]:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def row(doc_id: int | None, text: str | None) -> tuple:
    w = rewritten(doc_id, brute.words(text))
    runs = runs_of(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *[hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)])


def random_words(rng: random.Random) -> list[int]:
    n = rng.randint(0, 90)
    w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
    if n > 4 and rng.random() < 0.7:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        for i in range(a, rng.randint(a, n)):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("piece", [1, 3, 16, 64, 1 << 16])
def test_runs_equal_brute_force_however_words_are_appended(piece, monkeypatch):
    monkeypatch.setattr(P, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(200):
        docs = [random_words(rng) for _ in range(rng.randint(1, 4))]
        got = P.block_runs([np.array(w, dtype=np.int64) for w in docs])
        assert [[(r.start, r.length, r.period) for r in x] for x in got] == [runs_of(w) for w in docs]


def test_reports_while_words_are_appended():
    catchers = P.SquareCatchers()
    seen = []
    for i in range(40):
        catchers.append(np.array([i % 10 if i < 30 else 100 + i]))
        seen.append([(r.start, r.length, r.period) for r in catchers.runs()])
    assert seen[18] == [] and seen[19] == [(0, 20, 10)] and seen[29] == seen[39] == [(0, 30, 10)]


def test_periodic_words_of_any_length_are_linear():
    for w, want in ((np.zeros(300_000, dtype=np.int64), 1), (np.arange(300_000) % 700, 700)):
        assert [(r.start, r.length, r.period) for r in P.block_runs([w])[0]] == [(0, 300_000, want)]


def test_query_columns_equal_brute_force(corpus, edge, plain):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def rows(docs):
        return sorted((tuple(r) for r in P.collapsed(docs, plant=True, texts=False).select(columns).collect()), key=repr)

    small = [(d, t) for d, t in plain if len(brute.words(t)) < 1500]
    assert any(row(d, t)[1] for d, t in small)
    kept = corpus.filter(corpus.doc_id.isin([d for d, _ in small]))
    assert rows(kept) == sorted((row(d, t) for d, t in small), key=repr)
    short = edge.filter("coalesce(doc_id, 0) <> 9")
    assert rows(short) == sorted((row(r.doc_id, r.text) for r in short.select("doc_id", "text").collect()), key=repr)
    assert rows(edge.limit(0)) == []


def test_collapsed_texts(spark):
    rows = [(1, "a b c " * 5 + "end"), (2, "x y"), (None, None), (2, "x y"), (3, "Wörd🙂 " * 30_000)]
    got = {r.doc_id: r for r in P.collapsed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].collapsed_text == "a b c end" and [tuple(r) for r in got[1].runs] == [(0, 15, 3)]
    assert got[2].collapsed_text == "x y" and got[None].collapsed_text == "" and got[3].collapsed_text == "Wörd🙂"
    assert (got[3].n_words, got[3].start, got[3].length, got[3].period) == (30_000, 0, 30_000, 1)
