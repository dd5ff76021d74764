"""Substring dedup on sliding sentence spans.

A text is cut into sentences (at sentence marks and line ends; a sentence of
more than ``max_words`` words is cut every ``max_words`` words).  Spans are
runs of consecutive sentences: from every sentence on, and up to every
sentence, the shortest run of at least ``min_sentences`` sentences and
``min_words`` words.  Equal spans are found by a join over the whole table;
all occurrences but the first, by id and place, lose their sentences.

A repeated passage of ``max_words * (min_sentences + 1)`` words or more that
begins with a sentence is removed as a whole, since the runs up to its
sentences cover what the runs from them leave.

A passage that begins inside a long sentence is cut in another phase in each
text.  So what the spans leave is held against windows that know no cut: where
``passage_words`` contiguous words are still whole and occur earlier, by id and
place, in any text as it was, these words go too.  Candidates are anchors, the
windows of ``anchor_words`` words whose hash is the least of all that fit into
a passage's length; equal passages have equal anchors wherever they start.

Three passes: a count of 64-bit hashes of spans and anchors (partly summed on
the map side) keeps those that occur twice; a join keeps the spans and anchors
that have them; only these are compared on 128 bits and ordered.  Texts are
opened again only where an anchor outside the removed sentences is there
earlier.  A span that a third of all documents share is one row of the counts,
and its occurrences lie on the side of the joins that Spark splits.

Edge cases: null and empty texts have no sentence and come back unchanged;
a null id sorts after all others; rows that repeat both id and text are one
document, and its first occurrence stays in each; an empty table gives an
empty result; further columns are left aside by ``removals`` and pass
through ``without_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.llm.common import documents, free_name, quoted, staged, text_or_empty, text_slices
from zonekit.llm.wordhash import mix, span_hashes, text_block, words


@dataclass(frozen=True)
class Spans:
    min_sentences: int = 3
    min_words: int = 20
    max_words: int = 12
    passage_words: int = 51
    anchor_words: int = 20


# Last bytes of a word that end a sentence, also before a closing quote or bracket.
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in ".!?"]] = True
_CLOSERS = np.zeros(256, dtype=bool)
_CLOSERS[[ord(c) for c in "\"')]}"]] = True


def sentences(data: np.ndarray, off: np.ndarray, how: Spans, hashes: int = 1) -> dict[str, np.ndarray]:
    """Per sentence: its document, first byte, first word, number of words and 64-bit hashes of its words.

    Per word: ``word_doc``, ``word_start`` (its first byte) and ``word_hash``.  Each of the
    ``hashes`` (rows of ``hash`` and ``word_hash``) is independent of the others.
    """
    start, end, doc = words(data, off)
    n = len(start)
    if not n:
        none, no_hash = np.zeros(0, dtype=np.int64), np.zeros((hashes, 0), dtype=np.uint64)
        return {k: none for k in ("doc", "start", "head", "words", "word_doc", "word_start")} | {"hash": no_hash, "word_hash": no_hash}
    last = data[end - 1]
    before = data[np.maximum(end - 2, start)]
    stops = _MARKS[last] | (_CLOSERS[last] & _MARKS[before])
    lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
    first = np.ones(n, dtype=bool)
    first[1:] = stops[:-1] | (lines[start[1:]] > lines[end[:-1]]) | (doc[1:] != doc[:-1])
    place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    first |= place % how.max_words == 0
    heads = np.flatnonzero(first)
    place = (np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))).astype(np.uint64)
    said = np.array([span_hashes(data, start, end, salt) for salt in range(hashes)], dtype=np.uint64).reshape(hashes, n)
    at = mix(place + np.uint64(3))
    sizes = np.diff(np.append(heads, n))
    return {
        "doc": doc[heads],
        "start": start[heads],
        "head": heads,
        "words": sizes,
        "word_doc": doc,
        "word_start": start,
        "word_hash": said,
        "hash": mix(np.add.reduceat(mix(said ^ at), heads, axis=1) + sizes.astype(np.uint64)) if hashes else said[:, :0],
    }


def runs(found: dict[str, np.ndarray], how: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) sentence of every span, each span once."""
    doc, n = found["doc"], len(found["doc"])
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    total = np.concatenate([[0], np.cumsum(found["words"])])
    at = np.arange(n)
    on_to = np.maximum(at + how.min_sentences, np.searchsorted(total, total[:-1] + how.min_words)) - 1
    back_to = np.minimum(at - how.min_sentences + 1, np.searchsorted(total, total[1:] - how.min_words, side="right") - 1)
    good = on_to < n
    good[good] &= doc[on_to[good]] == doc[good]
    back = back_to >= 0
    back[back] &= doc[back_to[back]] == doc[back]
    both = np.concatenate([at[good] * (n + 1) + on_to[good], back_to[back] * (n + 1) + at[back]])
    both = np.unique(both)
    return both // (n + 1), both % (n + 1)


def run_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each run from its sentences' hashes in order."""
    base = (0xA0761D6478BD642F + 2 * salt) | 1
    n = len(hashes) + 1
    up, down = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    for powers, factor in ((up, base), (down, pow(base, -1, 1 << 64))):
        powers[0] = 1
        powers[1:] = np.uint64(factor)
        np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes + np.uint64(salt)) * up[:-1])])
    return mix((sums[last + 1] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def _over(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``size`` values in a row."""
    held = 1
    while held < size:
        step = min(held, size - held)
        values = pick(values[:-step], values[step:])
        held += step
    return values


def anchors(found: dict[str, np.ndarray], how: Spans) -> np.ndarray:
    """First words of the anchors: in every ``passage_words`` words the window with the least hash."""
    doc, n = found["word_doc"], len(found["word_doc"])
    if n < how.passage_words:
        return np.zeros(0, dtype=np.int64)
    at = np.arange(n - how.anchor_words + 1)
    hashes = run_hashes(found["word_hash"][0], at, at + how.anchor_words - 1, 3)
    fit = how.passage_words - how.anchor_words + 1
    least = _over(hashes, fit, np.minimum)
    least[doc[: len(least)] != doc[how.passage_words - 1 :]] = 0
    # a window is the least of a passage that holds it, if the highest of their least hashes is its own
    edge = np.zeros(fit - 1, dtype=np.uint64)
    return np.flatnonzero((hashes > 0) & (_over(np.concatenate([edge, least, edge]), fit, np.maximum) == hashes))


def _handled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, content, body): id and 64 bits of the text name a document."""
    body = text_or_empty(text)
    return docs.select(quoted(key).alias("doc_id"), F.xxhash64(body).alias("content"), body.alias("body"))


def span_table(rows: DataFrame, how: Spans, hashes_only: bool = False) -> DataFrame:
    """(h1) or (h1, h2, doc_id, content, first, last, word) of every span and anchor of ``rows``.

    ``first`` and ``last`` are sentences; ``word`` is an anchor's first word, -1 for a span.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 2 << 20):
            found = sentences(*text_block(batch.column("body")), how, 1 if hashes_only else 2)
            first, last = runs(found, how)
            at = anchors(found, how)
            to = at + how.anchor_words - 1

            def hashes(salt: int, found=found, runs=(first, last), windows=(at, to)) -> pa.Array:
                both = [run_hashes(found["hash"][salt - 1], *runs, salt), run_hashes(found["word_hash"][salt - 1], *windows, salt + 4)]
                return pa.array(np.concatenate(both).view(np.int64))

            if hashes_only:
                yield pa.RecordBatch.from_arrays([hashes(1)], names=["h1"])
                continue
            word = np.concatenate([np.full(len(first), -1), at - np.searchsorted(found["word_doc"], found["word_doc"][at])])
            first = np.concatenate([first, np.searchsorted(found["head"], at, side="right") - 1])
            last = np.concatenate([last, np.searchsorted(found["head"], to, side="right") - 1])
            doc = found["doc"][first]
            begins = np.searchsorted(found["doc"], np.arange(batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [
                    hashes(1),
                    hashes(2),
                    batch.column("doc_id").take(pa.array(doc)),
                    batch.column("content").take(pa.array(doc)),
                    pa.array((first - begins[doc]).astype(np.int32)),
                    pa.array((last - begins[doc]).astype(np.int32)),
                    pa.array(word.astype(np.int32)),
                ],
                names=["h1", "h2", "doc_id", "content", "first", "last", "word"],
            )

    schema = "h1 long" if hashes_only else f"h1 long, h2 long, doc_id {kind}, content long, first int, last int, word int"
    return rows.mapInArrow(run, schema)


def repeated_spans(rows: DataFrame, how: Spans) -> DataFrame:
    """The rows of ``span_table`` whose 64-bit hash is there more than once, staged."""
    counts = span_table(rows, how, hashes_only=True).groupBy("h1").agg(F.count(F.lit(1)).alias("n"))
    # a table of its own, so that the spans are dealt only for the join and a hot hash can be split
    often = staged(counts.filter("n > 1").select("h1"), "repeated-hashes")
    # sorted and merged at every size: what repeats grows with the input
    return staged(span_table(rows, how).join(often.hint("merge"), "h1"), "repeated-spans")


def _later(found: DataFrame, at: str, name: str) -> DataFrame:
    """The rows of ``found`` (h1, h2, doc_id, content, ...) that occur earlier, by id and ``at``."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content", at)
    earliest = found.groupBy("h1", "h2").agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
    earliest = staged(earliest.filter("n > 1").drop("n"), name)
    return found.join(earliest.hint("merge"), ["h1", "h2"]).filter(place != F.col("earliest"))


def later_spans(twice: DataFrame) -> DataFrame:
    """(doc_id, content, first, last) of every span that occurs earlier, by id and place."""
    return _later(twice.filter("word < 0"), "first", "earliest-spans").select("doc_id", "content", "first", "last")


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    """``left`` (doc_id, content) is ``right`` (id, of)."""
    return (left["content"] == right["of"]) & left["doc_id"].eqNullSafe(right["id"])


def later_windows(rows: DataFrame, twice: DataFrame, gone: DataFrame, how: Spans) -> DataFrame:
    """(doc_id, content, first): first words of windows of ``passage_words`` words that occur earlier.

    All of them that lie clear of the sentences of the spans ``gone`` are
    there; others may be.
    """
    held = twice.filter("word >= 0")
    again = _later(held, "word", "earliest-anchors").select("doc_id", "content", "first", F.lit(None).cast("int").alias("last"), "h1", "h2")
    spans = gone.select("doc_id", "content", "first", "last", F.lit(None).cast("long").alias("h1"), F.lit(None).cast("long").alias("h2"))
    # how far the spans reach that begin at an anchor's sentence or before, spans first
    order = Window.partitionBy("doc_id", "content").orderBy("first", F.col("h1").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = again.unionByName(spans).withColumn("reach", F.max("last").over(order))
    still = met.filter(F.col("h1").isNotNull() & (F.coalesce("reach", F.lit(-1)) < F.col("first")))
    asked = staged(still.select("h1", "h2").distinct(), "open-anchors")
    places = held.join(asked.hint("merge"), ["h1", "h2"], "left_semi")
    places = places.groupBy(F.col("doc_id").alias("id"), F.col("content").alias("of")).agg(F.collect_set("word").alias("at"))
    places = staged(places, "anchor-places")
    opened = rows.join(places, _same_document(rows, places)).select("doc_id", "content", "body", "at")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 2 << 20):
            found = sentences(*text_block(batch.column("body")), how, 2)
            begins = np.searchsorted(found["word_doc"], np.arange(batch.num_rows + 1))
            n = len(found["word_doc"])
            # windows that hold an anchor begin up to this many words before it
            reach = how.passage_words - how.anchor_words
            near = np.zeros(n + 1, dtype=np.int64)
            for i, at in enumerate(batch.column("at").to_pylist()):
                at = np.array(at, dtype=np.int64) + begins[i]
                np.add.at(near, np.maximum(at - reach, begins[i]), 1)
                np.add.at(near, at + 1, -1)
            first = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            first = first[first + how.passage_words <= n]
            last = first + how.passage_words - 1
            good = found["word_doc"][first] == found["word_doc"][last]
            first, last = first[good], last[good]
            doc = found["word_doc"][first]
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(run_hashes(found["word_hash"][salt - 1], first, last, salt).view(np.int64)) for salt in (1, 2)],
                    batch.column("doc_id").take(pa.array(doc)),
                    batch.column("content").take(pa.array(doc)),
                    pa.array((first - begins[doc]).astype(np.int32)),
                ],
                names=["h1", "h2", "doc_id", "content", "first"],
            )

    windows = opened.mapInArrow(run, f"h1 long, h2 long, doc_id {kind}, content long, first int")
    return _later(staged(windows, "windows"), "first", "earliest-windows").select("doc_id", "content", "first")


REMOVAL = T.StructType(
    [
        T.StructField("n_sentences", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("clean_text", T.StringType()),
    ]
)


_REMOVED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def cut(texts: pa.Array, spans: list[list[tuple[int, int, bool]] | None], how: Spans) -> list[pa.Array]:
    """The fields of ``REMOVAL`` of each text, without what its spans (first, last, whether these are words) cover.

    Sentences go first; a span of words goes if none of its words is gone with them.
    """
    data, off = text_block(texts)
    found = sentences(data, off, how, 0)
    begins = np.searchsorted(found["doc"], np.arange(len(off)))
    word_begins = np.searchsorted(found["word_doc"], np.arange(len(off)))
    n_removed = np.zeros(len(texts), dtype=np.int64)
    touched, removed, clean = np.zeros(len(texts), dtype=bool), [], []
    for i, listed in enumerate(spans):
        if not listed:
            removed.append([])
            continue
        lo, n = int(begins[i]), int(begins[i + 1] - begins[i])
        word_lo, n_words = int(word_begins[i]), int(word_begins[i + 1] - word_begins[i])
        raw = data[off[i] : off[i + 1]]
        sizes = found["words"][lo : lo + n]
        gone = np.repeat(_covered([(a, b) for a, b, by_word in listed if not by_word], n), sizes)
        before = np.concatenate([[0], np.cumsum(gone)])
        whole = [(a, b) for a, b, by_word in listed if by_word and before[a] == before[b + 1]]
        gone |= _covered(whole, n_words)
        starts = np.append(found["word_start"][word_lo : word_lo + n_words] - off[i], len(raw))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        ranges = [(int(starts[a]), int(starts[b])) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        keep = np.ones(len(raw), dtype=bool)
        for a, b in ranges:
            keep[a:b] = False
        heads = found["head"][lo : lo + n] - word_lo
        n_removed[i] = np.logical_and.reduceat(gone, heads).sum() if ranges else 0
        touched[i] = True
        removed.append([{"start": int(lead[a]), "end": int(lead[b])} for a, b in ranges])
        clean.append(raw[keep].tobytes())
    cleaned = pa.array(clean, type=pa.binary()).cast(texts.type)
    return [
        pa.array(np.diff(begins)),
        pa.array(n_removed),
        pa.array(removed, type=_REMOVED),
        pc.replace_with_mask(texts, pa.array(touched), cleaned),
    ]


def _covered(spans: list[tuple[int, int]], n: int) -> np.ndarray:
    """True at each of ``n`` places that a span (first, last) covers."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for first, last in spans:
        edges[first] += 1
        edges[last + 1] -= 1
    return np.cumsum(edges[:-1]) > 0


def removals(docs: DataFrame, how: Spans | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (doc_id, content, and the fields of ``REMOVAL``); offsets are code points of the text."""
    how = how or Spans()
    rows = _handled(docs, key, text)
    twice = repeated_spans(rows, how)
    gone = staged(later_spans(twice), "later-spans")
    windows = later_windows(rows, twice, gone, how)
    windows = windows.withColumn("last", F.col("first") + F.lit(how.passage_words - 1)).withColumn("by_word", F.lit(True))
    every = gone.withColumn("by_word", F.lit(False)).unionByName(windows)
    lists = every.groupBy("doc_id", "content").agg(F.collect_set(F.struct("first", "last", "by_word")).alias("spans"))
    lists = lists.select(F.col("doc_id").alias("id"), F.col("content").alias("of"), "spans")
    joined = rows.join(lists.hint("merge"), F.col("content").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 4 << 20):
            spans = [x and [(s["first"], s["last"], s["by_word"]) for s in x] for x in batch.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), *cut(batch.column("body"), spans, how)],
                names=["doc_id", "content", *[f.name for f in REMOVAL.fields]],
            )

    fields = T.StructType([rows.schema["doc_id"], T.StructField("content", T.LongType()), *REMOVAL.fields])
    return joined.select("doc_id", "content", "body", "spans").mapInArrow(run, fields)


def without_repeats(docs: DataFrame, how: Spans | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated sentences taken out of ``text``; all rows stay."""
    content, made = free_name(docs, "content"), free_name(docs, "clean_text")
    found = removals(docs, how, key, text).filter(F.size("removed") > 0).dropDuplicates(["doc_id", "content"])
    found = found.select(F.col("doc_id").alias("found_id"), F.col("content").alias(content), F.col("clean_text").alias(made))
    marked = docs.withColumn(content, F.xxhash64(text_or_empty(text))).alias("d")
    joined = marked.join(found.alias("f"), (F.col(f"d.{content}") == F.col(f"f.{content}")) & quoted(key).eqNullSafe(F.col("f.found_id")), "left")
    return joined.select(*[F.coalesce(F.col(f"f.{made}"), F.col(f"d.`{c}`")).alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])


def op1_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated sentence spans."""
    return removals(documents(spark, sf_dir).select("doc_id", "text")).drop("content")
