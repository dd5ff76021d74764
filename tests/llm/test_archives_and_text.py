import gzip
import io
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from zonekit.llm import language_id, pii, quote_links, warc
from zonekit.llm.common import shared_folder


def test_normaliser_round_trip():
    payloads = [b"", b"x" * 10, "ü漢\r\n\r\nWARC/1.1".encode() * 500, bytes(range(256)) * 9000]
    whole = gzip.compress(b"".join(warc.record(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads)))
    sink = io.BytesIO()
    entries = list(warc.normalise_stream(io.BytesIO(whole), sink))
    assert [e["record_id"] for e in entries] == [warc.record_id(i) for i in range(len(payloads))]
    for e, payload in zip(entries, payloads, strict=True):
        member = sink.getvalue()[e["offset"] : e["offset"] + e["length"]]
        assert zlib.decompress(member, wbits=31).partition(b"\r\n\r\n")[2].endswith(payload + b"\r\n\r\n")
        assert warc._parsed(zlib.decompress(member, wbits=31))["payload"] == payload
    # an archive that is normalised already comes out the same
    again = io.BytesIO()
    assert list(warc.normalise_stream(io.BytesIO(sink.getvalue()), again)) == entries
    with pytest.raises(ValueError):
        list(warc.normalise_stream(io.BytesIO(gzip.compress(warc.record(1, "u", b"abc", None)[:-9])), io.BytesIO()))


def test_archives_read_back(spark):
    big = "<p>" + "same " * 400
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (5, "http://a/5", big), (None, "u", big)]
    rows += [(7, "http://b", "small"), (8, "http://c", "small"), (9, "http://d", None), (10, "http://e", "é" * 5000)]
    folder = shared_folder(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.normalise(warc.write_monolithic(warc.with_revisits(pages), folder), folder)
    got = warc.read_records(index, folder, with_payload=True).collect()
    assert len(got) == len(rows)
    kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in got}
    size = len(big)
    assert kinds[1] == kinds[3] == kinds[None] == ("revisit", 5, size) and kinds[5] == ("response", None, size)
    assert kinds[7][0] == kinds[8][0] == kinds[9][0] == "response" and kinds[10][2] == 10_000
    for r in got:
        text = next(h for p, _, h in rows if p == r.page_id)
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (text or "")
    assert index.count() == spark.read.json(folder + "/*.idx").count()
    empty = warc.write_monolithic(warc.with_revisits(pages.limit(0)), folder + "-none")
    assert warc.read_records(warc.normalise(empty, folder + "-none"), folder + "-none").count() == 0


PII = [
    "mail a.b+c@x-y.example.org, or a@b.c_d@e.f @x.y a@b",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 5 4111111111111111",
    "+1 (743) 555-3824 +12 +123456789 +1234567890123456 +(1)",
    "🙂é a@b.cc 漢 +49 30 1234567",
    None,
    "",
]


def test_base_spans_equal_python(spark, corpus):
    rows = [(i, t) for i, t in enumerate(PII)] + [(100, "1 " * 20_000), (101, "a" * 50_000 + "@"), (102, "9" * 30_000), (103, "a@b.c " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(corpus.select((corpus.doc_id + 1000).alias("doc_id"), "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = pii.find(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.base_spans(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == want
        assert r.n_email == sum(s.startswith("email") for s in want)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="a1.@+- ()4", max_size=60), min_size=1, max_size=30))
def test_base_spans_of_any_text(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii._rows(docs, "doc_id", "text")
    found = pii.base_spans(rows).collect()
    by_row = {}
    for s in found:
        by_row.setdefault(int(s.row.split(":")[0]), []).append((s.kind, s.start, s.end))
    for i, t in enumerate(texts):
        got = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(by_row.get(i, []))]
        assert got == brute.base_spans(t), t


def test_terms_that_give_a_person_away(spark):
    rows = [(i, f"common words number{i} zanzibar said ann@example.org was here") for i in range(8)]
    rows += [(i, f"common words only number{i}") for i in range(8, 400)]
    rows += [(500, None), (501, "mail to bob@example.org once, with zanzibar")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row_key string")
    texts = dict(rows)
    how = pii.Disclosure(min_posterior=0.8, remove_at=0.95)
    terms = {}
    for r in pii.find(docs, how).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s.startswith("term")]
        terms[r.doc_id] = {texts[r.doc_id][int(a) : int(b)] for _, a, b in spans}
        assert r.n_term == len(spans)
    assert all(terms[i] == {"said", "was", "here", "zanzibar"} for i in range(8))
    assert not any(terms[i] for i in terms if i >= 8)
    clean = {r.doc_id: r for r in pii.sanitise(docs, how).collect()}
    assert pii.sanitise(docs, how).columns == docs.columns
    assert clean[0].text == "common words number0 [TERM]  [EMAIL]  " and clean[500].text is None
    assert clean[501].text == "mail to [EMAIL] once, with zanzibar"
    assert pii.find(docs.limit(0)).count() == 0


def disclosed(rows: list[tuple], how: pii.Disclosure) -> dict[int, list[str]]:
    """doc_id -> term spans, counted in plain Python over different texts (values are e-mail addresses)."""
    word, address = regex.compile(r"[\p{L}\p{N}]+"), brute.BASE[0][1]
    texts = {t or "" for _, t in rows}
    values = {t: {m.group().lower() for m in address.finditer(t)} for t in texts}
    terms = {t: set(word.findall(address.sub(" ", t).lower())) for t in texts}
    n_value = Counter(v for x in values.values() for v in x)
    n_term = Counter(w for x in terms.values() for w in x)
    both = Counter((v, w) for t in texts for v in values[t] for w in terms[t])
    known = {
        (v, w) for (v, w), n in both.items()
        if n >= how.min_support and n / n_term[w] >= how.min_posterior and math.log2(len(texts) * n / (n_term[w] * n_value[v])) >= how.min_bits
        and math.log2(len(texts) / n_value[v]) >= how.min_bits
    }
    out = {}
    for d, t in rows:
        found = {w for v, w in known if v in values[t or ""]}
        spans = [m.span() for m in address.finditer(t or "")]
        words = [m for m in word.finditer(t or "") if m.group().lower() in found]
        out[d] = [f"term:{m.start()}:{m.end()}" for m in words if not any(a < m.end() and m.start() < b for a, b in spans)]
    return out


def test_terms_equal_brute_force(spark):
    """Values in two to many texts, terms of any length and script, copies, against counts in plain Python."""
    rng = random.Random(8)
    rows: list[tuple] = [(900, "Kim x Lee 漢 only@once.org"), (901, None), (902, "")]
    for person in range(12):
        name = [rng.choice(["Kim", "Q", "quux", "漢字", "Ünal", "lee", "ab9"]) + str(person) * (person % 3 > 0), f"hint{person}"]
        for _ in range(rng.choice([1, 2, 2, 3, 6, 15])):
            filler = [rng.choice(["the", "a", "of", "to", "said", "word"]) + rng.choice(["", "s"]) for _ in range(6)]
            w = filler + [x for x in name if rng.random() < 0.9] + [f"p{person}@mail.org"] * rng.choice([1, 1, 2])
            rng.shuffle(w)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, f"the {rng.choice('abcdef')} of {rng.choice(['Kim', 'said', 'quux', 'hint3'])} {i}") for i in range(300)]
    rows += [(2000 + i, rows[5][1]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for how in (pii.Disclosure(), pii.Disclosure(min_posterior=0.5, min_bits=3.0)):
        want = disclosed(rows, how)
        got = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("term")] for r in pii.find(docs, how).collect()}
        assert got == want and sum(map(len, want.values())) > 40


def test_copies_change_no_disclosing_term(spark):
    rows = [(i, f"common words number{i} zanzibar said ann@example.org was here") for i in range(8)]
    rows += [(i, f"common words only number{i}") for i in range(8, 400)]
    rows += [(500, None), (501, "mail to bob@example.org once, with zanzibar")]

    def spans(table):
        docs = spark.createDataFrame(table, "doc_id long, text string")
        return {(r.doc_id % 1000, r.spans) for r in pii.find(docs).collect()}

    alone = spans(rows)
    assert sum("term" in s for _, s in alone) == 8
    # every text three times, and one of them in a third of all rows
    copied = rows + [(i + 1000 * k, t) for i, t in rows for k in (1, 2)] + [(3000 + 1000 * k, rows[0][1]) for k in range(600)]
    assert spans(copied) == alone


def parsed(text: str) -> list[tuple[int, str]]:
    """(level, content) of every line, level -1 for a lead-in."""
    prefix = re.compile(r"[ \t]*((?:>[ \t]?)+)")
    out = [(m.group(1).count(">") if (m := prefix.match(x)) else 0, x[m.end() :] if m else x) for x in text.split("\n")]
    lead = re.compile(r"(?i)^[ \t]*(on|am|le|el)\b.{3,200}\b(wrote|schrieb|a écrit|escribió)[^\n:]{0,80}:[ \t]*$")
    return [(-1, x) if n == 0 and lead.search(x) and i + 1 < len(out) and out[i + 1][0] > 0 else (n, x) for i, (n, x) in enumerate(out)]


def plain(text: str) -> str:
    return regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).strip()


def pieces(lines: list[str], joint: str) -> tuple[set, set, set]:
    whole = joint.join(lines)
    cut = re.split(r"(?<=[.!?])[ \t\r\n]+|(?<=[。！？])", whole)
    return {plain(x) for x in lines} - {""}, {plain(x) for x in cut} - {""}, {plain(whole)} - {""}


def links(rows: list[tuple]) -> dict[tuple, tuple]:
    """(conv, turn, passage number) -> (conv, turn) it quotes, by comparing with every message."""
    said = {(c, t): set().union(*pieces([x for n, x in parsed(text) if n == 0], "\n")) for c, t, _, text in rows}
    out = {}
    for c, t, _, text in rows:
        runs: list = []
        for n, x in parsed(text):
            if runs and runs[-1][0] == n:
                runs[-1][1].append(x)
            else:
                runs.append((n, [x]))
        for number, (n, content) in enumerate(runs, 1):
            if n <= 0:
                continue
            lines, sentences, whole = pieces(content, " ")
            score: dict = defaultdict(lambda: [0, 0, 0])
            for k, group in ((2, lines), (1, sentences), (0, whole)):
                for piece in group:
                    own = min((x for x in said if x[0] == c and x[1] < t and piece in said[x] and x[1] == min(y[1] for y in said if y[0] == c and piece in said[y])), default=None)
                    other = min((x for x in said if x[0] != c and piece in said[x]), default=None)
                    if own or other:
                        score[own or other][k] += 1
            if score:
                to, (w, s, m) = max(score.items(), key=lambda x: (*x[1], -x[0][0], -x[0][1]))
                if w or 2 * s >= len(sentences) or 2 * m >= len(lines):
                    out[c, t, number] = to
    return out


def test_links_equal_brute_force(spark):
    """Quotes of one word, without punctuation or spaces, re-wrapped, nested, across conversations."""
    rng = random.Random(3)
    words = ["yes", "No", "今日は良い天気です", "d'accord", "ok!", "Straße", "never ever", "one two three", "你好。再见！"]
    rows: list[tuple] = []
    for c in range(14):
        for t in range(rng.randint(2, 6)):
            body = [" ".join(rng.choice(words) + rng.choice(["", ".", "!", f" {rng.randrange(9)}"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3))]
            if rows and rng.random() < 0.7:
                source = rng.choice([r for r in rows if r[0] == c] or rows) if rng.random() < 0.6 else rng.choice(rows)
                quoted = source[3].split("\n")
                if rng.random() < 0.5:
                    quoted = quoted[: rng.randint(1, len(quoted))]
                if rng.random() < 0.4:
                    quoted = " ".join(quoted).split(" ")
                body = ["On Monday somebody wrote:"] * rng.randint(0, 1) + [("> " if not x.startswith(">") else ">") + x for x in quoted] + body
            rows.append((c, t, "x", "\n".join(body)))
    how = quote_links.Linking()
    table = quote_links.parsed(quote_links.messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {}
    for r in quote_links.passage_links(table, how).collect():
        c, t = r.msg.split(":")[:2]
        got[int(c), int(t), r.passage] = (r.to_conv, r.to_turn)
    assert got == links(rows) and len(got) > 25


def test_a_hundred_thousand_quoted_lines(spark):
    text = "\n".join(("> " if i % 2 else ">> ") + f"line {i}" for i in range(100_000))
    rows = [(1, 0, "a", "line 5\nline 7"), (1, 1, "b", text), (2, 0, "c", "line 8")]
    began = time.time()
    got = {r.turn: r for r in quote_links.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect() if r.conv_id == 1}
    assert got[1].reply_to == 0 and got[1].n_quoted_lines == 100_000 and got[1].text == "" and time.time() - began < 120


def test_quotes_link_to_their_originals(spark):
    rows = [
        (1, 0, "a", "Hello there my friend. This is the first message of mine.\nSecond line is here too."),
        (1, 1, "b", "On Monday Bob wrote:\n> Hello there my friend. This is the\n> first message of mine.\n\nYes I agree with that fully."),
        (1, 2, "c", "Something unrelated to say here now. Ok."),
        (1, 3, "a", ">> Hello there my friend.\n> Yes I agree, with that\n> FULLY.\nThanks for that answer my dear."),
        (1, 4, "a", "> Thanks for that answer my dear.\nYou are welcome to it all."),
        (2, 0, "x", "> Something unrelated to say here now.\nCross posting."),
        (2, 0, "x", "> Something unrelated to say here now.\nCross posting."),
        (2, 1, "x", "> Nobody ever said these words before.\nNo original."),
        (None, 0, "x", "> Something unrelated to say here now.\nnull"),
        (3, None, "x", None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quote_links.reply_ordered(table).collect()
    assert len(got) == len(rows)
    first = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in first] == [0, 1, 3, 4, 2] and [r.reply_to for r in first] == [None, 0, 1, 3, None]
    assert [r.text for r in first][1:4] == ["Yes I agree with that fully.", "Thanks for that answer my dear.", "You are welcome to it all."]
    assert [r.max_level for r in first] == [0, 1, 2, 1, 0]
    second = sorted((r for r in got if r.conv_id == 2), key=lambda r: r.position)
    assert [(r.quote_conv, r.quote_turn, r.reply_to) for r in second] == [(1, 2, None), (1, 2, None), (None, None, None)]
    assert [r.position for r in second] == [0, 1, 2]
    assert quote_links.reply_ordered(table.limit(0)).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.filter("doc_id % 2 = 0").selectExpr("doc_id id", "text", "false markup", "lang")
    rows = docs.filter("doc_id % 2 = 1").selectExpr("doc_id", "text", "false markup", "'' declared", "source host")
    rows = rows.fillna("", ["text", "host"])
    got = {r.doc_id: r.lang for r in language_id.identify(rows, train).collect()}
    truth = {r.doc_id: r.lang for r in docs.filter("doc_id % 2 = 1").collect()}
    assert sum(got[d] == truth[d] for d in truth) >= 0.98 * len(truth)


def test_a_rare_language_is_possible_at_any_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = docs.filter("lang = 'en'").selectExpr("doc_id id", "text", "false markup", "lang")
    rare = [(k, "saluton mondo kaj bonan tagon al vi chiuj karaj amikoj " * 5, False, "eo") for k in (100_001, 100_002)]
    train = train.unionByName(spark.createDataFrame(rare, train.schema))
    how = language_id.Fusion(train_rows=2)
    languages, logs = language_id.train(train, how)
    assert languages == ["en", "eo"] and logs.shape[0] == 2
    rows = spark.createDataFrame([(1, rare[0][1], False, "eo", "")], "k long, text string, markup boolean, declared string, host string")
    assert [(r.lang, r.declared) for r in language_id.identify(rows, train, how).collect()] == [("eo", "eo")]


def test_priors_decide_where_the_text_is_silent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = docs.selectExpr("doc_id id", "text", "false markup", "lang")
    french = [r.text for r in docs.filter("lang = 'fr'").limit(12).collect()]
    english = [r.text for r in docs.filter("lang = 'en'").limit(40).collect()]
    pages = [(i, f"http://www.a.example.fr/{i}", f'<html lang="fr"><p>{t}</p>') for i, t in enumerate(french)]
    pages += [(100 + i, f"http://b.example.com/{i}", f"<html lang=en><p>{t}</p>") for i, t in enumerate(english)]
    pages += [(200, "http://www.a.example.fr/x", "<p></p>"), (201, "http://new.other.com/", '<html lang="fr"></html>'), (202, None, None)]
    rows = language_id.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {r.page_id: r for r in language_id.identify(rows, train).collect()}
    assert len(got) == len(pages)
    assert got[200].lang == "fr" and got[201].lang == "fr" and got[0].lang == "fr" and got[110].lang == "en"
    none = language_id.identify(rows, train.filter("lang = 'none'")).collect()
    assert len(none) == len(pages) and {r.lang for r in none} == {None}
    assert language_id.identify(rows.limit(0), train).count() == 0


def test_visible_text():
    page = b"<p>a<script>if (x<y) z</script>b<!-- <p>no --><style>q</style >c<br>d"
    assert language_id.visible(page).split() == [b"a", b"b", b"c", b"d"]
    assert language_id.visible(b"<" * 50_000) == b"" and language_id.visible(b"x<script>never closed").split() == [b"x"]
