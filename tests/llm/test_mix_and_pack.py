import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from tests.llm import brute
from zonekit.llm import mixing, packing
from zonekit.llm.tokens import WordTokenizer


def offers(docs):
    return mixing.taken_words(mixing.schedule(docs)).collect()


def test_mix_meets_its_targets(corpus):
    rows = offers(corpus)
    source = {r.doc_id: r.source for r in corpus.select("doc_id", "source").collect()}
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = brute.mix_targets(size)
    # the mix ends at one virtual time, with the document that reaches the budget
    order = sorted(mixing.schedule(corpus).collect(), key=lambda r: r.before + r["size"])
    end = next(r.finish for r in order if r.before + r["size"] >= 1.5 * sum(size.values()))
    longest = max(r["size"] for r in rows)
    assert abs(end - 1) * 1.5 * sum(size.values()) <= len(size) * longest
    for s in size:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert abs(taken[s] - min(target[s] * end, 2 * size[s])) <= 1
    assert {(r.doc_id, r.taken) for r in offers(corpus.repartition(3))} == {(r.doc_id, r.taken) for r in rows}


def test_taken_documents_are_the_prefix_of_the_global_order(corpus):
    """By the method, in plain Python: sort by finish time, add up, stop at the budget."""
    rows = mixing.schedule(corpus).collect()
    queues, sizes = defaultdict(list), defaultdict(int)
    for r in corpus.select("doc_id", "source", "text").collect():
        n = len(brute.words(r.text))
        queues[r.source].append((hashlib.md5(f"17:{r.doc_id}".encode()).hexdigest(), r.doc_id, n))
        sizes[r.source] += n
    target = brute.mix_targets(sizes)
    order = []
    for sid, s in enumerate(sorted(queues, key=lambda s: (s is None, s))):
        given = 0
        for n_pass in (0, 1):
            for h, d, n in sorted(queues[s]):
                order.append(((given + n) / target[s], sid, n_pass, h, d, n))
                given += n
    order.sort()
    whole, total = set(), 0
    while total < 1.5 * sum(sizes.values()):
        _, _, n_pass, _, d, n = order[len(whole)]
        whole.add((d, n_pass))
        total += n
    assert {(r.doc_id, r["pass"]) for r in rows if r.taken == r["size"] > 0} >= {(d, k) for d, k in whole if (d, k) in {(x[4], x[2]) for x in order if x[5]}}
    part = [r for r in rows if r.taken and (r.doc_id, r["pass"]) not in whole]
    assert len(part) <= len(sizes) and len({r.source for r in part}) == len(part)
    assert [(r.doc_id, r["pass"]) for r in sorted(rows, key=lambda r: (r.before, r.finish)) if r["size"]] == [(x[4], x[2]) for x in order if x[5]]


def test_mix_is_interleaved(spark):
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(400)]
    got = mixing.schedule(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    ahead = got.filter("taken = size").orderBy("before").collect()
    half = ahead[: len(ahead) // 2]
    shares = {s: sum(r.taken for r in half if r.source == s) / sum(r.taken for r in ahead if r.source == s) for s in "ab"}
    assert all(0.4 < x < 0.6 for x in shares.values())
    assert [r.before for r in ahead] == list(np.cumsum([0] + [r.taken for r in ahead])[:-1])


def test_mix_edges(spark, edge):
    rows = offers(edge)
    assert len(rows) == edge.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    out = mixing.mixed(edge, length="n_chars")
    assert out.columns == edge.columns and out.count() > 0
    assert offers(edge.limit(0)) == [] and mixing.mixed(edge.limit(0)).count() == 0
    assert all(r.taken == 0 for r in offers(edge.filter("doc_id in (1, 2, 3)")))


def test_mixed_texts_have_the_words_taken(corpus):
    taken = {r.doc_id: r.taken for r in offers(corpus)}
    words = defaultdict(int)
    for r in mixing.mixed(corpus, length="n_chars").collect():
        words[r.doc_id] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert dict(words) == {d: n for d, n in taken.items() if n}


ODD = ["", "élan, straße. ÷x naïve; Ça ÿ! a.b ,. x.. don't’s ſ ﬁ",  "one two, three. four! éa\u0301",  "It's  DON'T", "á   İx ΑΣ ΑΣ. 12345 6", "<|endoftext|> <|ENDOFTEXT|> x", "tab\tnew\nline...end", "漢字🙂 wörd\x1cx"]


def test_word_tokenizer_equals_the_whole_text():
    plain = Tokenizer.from_file(path("word_bpe_49k.json"))
    coder = WordTokenizer("word_bpe_49k.json", 1)
    assert coder.encode([])[0].size == 0
    ids, sizes = coder.encode([t.encode() for t in ODD])
    want = [plain.encode(t, add_special_tokens=False).ids + [1] for t in ODD]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_hilbert_keys_walk_neighbouring_cells():
    bits, dims = 3, 3
    side = np.arange(1 << bits)
    cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = packing.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("table", ["corpus", "edge"])
def test_pieces_are_a_gapless_partition(request, table):
    docs = request.getfixturevalue(table)
    plain = Tokenizer.from_file(path("word_bpe_49k.json"))
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id].append(plain.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces = packing.pack(docs, with_ids=True)
    rows = pieces.collect()
    sequences = defaultdict(list)
    held = defaultdict(int)
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert any(len(w) == r.doc_tokens and w[r.start : r.start + r.length] == ids.tolist() for w in want[r.doc_id])
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        sequences[r.sequence_id].append((r.offset, r.length))
        held[r.doc_id] += r.length
    assert dict(held) == {d: sum(map(len, w)) for d, w in want.items()}
    for n, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or n == max(sequences)
    for s in packing.sequences(pieces).collect():
        assert len(s.ids) == 4 * (2048 if s.n_ids & (s.n_ids - 1) else s.n_ids)
    assert packing.pack(docs.limit(0)).count() == 0
