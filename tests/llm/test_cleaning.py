import itertools
import random

import pytest

from tests.llm import brute
from zonekit.llm import quality, substring_dedup
from zonekit.llm.queries import QUERIES

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(docs):
    out, name = quality.assess(docs.select("doc_id", "text"))
    return out.select("doc_id", "text", f"{name}.*").collect()


def test_base_counts_equal_brute_force(corpus, edge):
    rows = judged(corpus) + judged(edge)
    assert len(rows) > 200
    for r in rows:
        assert tuple(r[c] for c in BASE) == brute.quality_base(r.text), r.doc_id


def test_bad_lines_go_and_documents_that_lose_too_much(spark):
    prose = "This is a line of ordinary prose that says a few things about nothing at all.\n"
    cases = {
        1: (prose * 1 + "And here is another one, which differs from it by a few of its words.\nHome | News | Sports | Contact", True, 1),
        2: ("x*** y### z$$$ w%%% ***\n" * 2 + "a&& b|| c<< d>> e## f** g$$ h%% i&& j## k** l$$ m%% n&& o## p** q$$ r%% s&&", False, 3),
        3: (prose + "We use cookies.\nOne more line of prose to be long enough for the base rule here.", True, 1),
        4: ("short text", False, 0),
        5: (None, False, 0),
    }
    docs = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in judged(docs)}
    for k, (_, kept, bad) in cases.items():
        assert (got[k].kept, got[k].n_bad_lines) == (kept, bad), k
    left = {r.doc_id: r.text for r in quality.clean_lines_then_reject(docs).collect()}
    assert set(left) == {1, 3}
    assert "Home |" not in left[1] and "cookies" not in left[3] and left[3].startswith("This is")


def test_clean_documents_are_kept_and_junk_is_not(spark, corpus):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out, name = quality.assess(docs.select("doc_id", "text"), out="verdict")
    rows = out.join(labels, "doc_id").select("quality", f"{name}.kept", f"{name}.n_words").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 20]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.1 * len(junk)


def test_a_phrase_across_two_texts_is_no_boilerplate(spark):
    rows = [(1, "This is how our privacy "), (2, "policy was made in the end, by all of us who were there.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r.n_bad_lines for r in judged(docs)] == [0, 0]


def test_quality_keeps_extra_columns(edge):
    out = quality.clean_lines_then_reject(edge, length="n_chars")
    assert out.columns == edge.columns and out.schema == edge.schema
    assert quality.clean_lines_then_reject(edge.limit(0)).count() == 0
    out.collect()


def test_span_dedup_equals_brute_force(spark, corpus, plain):
    got = {r.doc_id: r for r in substring_dedup.removals(corpus).collect()}
    want = brute.without_repeats(plain)
    assert {d: (r.n_sentences, r.n_removed, r.clean_text) for d, r in got.items()} == want
    assert any(r.n_removed for r in got.values())
    texts = dict(plain)
    for d, r in got.items():
        rest = texts[d] or ""
        for span in reversed(r.removed):
            rest = rest[: span.start] + rest[span.end :]
        assert rest == r.clean_text


def test_long_shared_passage_stays_once(spark):
    passage = " ".join(f"word{i}" for i in range(55)) + "."  # one sentence of 55 words
    rows = [(i, f"Text number {i} begins so. {passage} It ends like {i * 7}.") for i in range(6)]
    got = {r.doc_id: r for r in substring_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0
    for i in range(1, 6):
        assert got[i].clean_text == f"Text number {i} begins so. It ends like {i * 7}."


def test_passages_at_any_word_offset_stay_once(spark):
    # windows of 51 words, whatever the cut: what is left of a text holds none that is there earlier
    rng = random.Random(5)
    fresh = (f"w{i}" for i in itertools.count())
    take = lambda n: list(itertools.islice(fresh, n))
    passages = [take(51) for _ in range(4)]
    texts = []
    for i in range(48):
        said = take(rng.randint(0, 60)) + passages[i % 4] + take(rng.randint(0, 60))
        stops = rng.random() < 0.5
        texts.append(" ".join(w + ("." if stops and int(w[1:]) % 29 == 0 else "") if w not in passages[i % 4] else w for w in said))
    rows = list(enumerate(texts)) + [(100, " ".join(take(300))), (101, "same " * 120), (None, " ".join(passages[0])), (0, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.content): r for r in substring_dedup.removals(docs).collect()}
    got = {d: r for (d, _), r in found.items()}
    seen = set()
    for d, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        spans = list(brute.WORD.finditer(text))
        gone = [any(x.start <= m.start() < x.end for x in got[d].removed) for m in spans]
        windows = [tuple(m.group() for m in spans[k : k + 51]) for k in range(len(spans) - 50)]
        for k, window in enumerate(windows):
            assert window not in seen or any(gone[k : k + 51]), d
            seen.add(window)
    for d in (0, 1, 2, 3, 100):
        assert not got[d].removed
    clean = {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()}
    assert clean == {d: r.clean_text for d, r in got.items()}


def test_span_dedup_edges(edge):
    rows = substring_dedup.removals(edge).collect()
    assert len(rows) == edge.count()
    repeated = {r.clean_text for r in rows if r.doc_id == 9}
    assert len(repeated) == 1  # the same document twice is treated alike
    same = substring_dedup.without_repeats(edge)
    assert same.columns == edge.columns and same.count() == edge.count()
    assert substring_dedup.removals(edge.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_sentence_span_dedup", "op10_quality_rules"])
def test_query_covers_every_document(spark, corpus, name):
    out = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in corpus.select("doc_id").collect())
