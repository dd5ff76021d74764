"""Quality rules, line first: drop bad lines, then reject texts that lost too much.

Every line of a text is judged by itself:

* punctuation: symbols and punctuation fill more than ``max_punct`` of the
  characters of a line with a word (tables of marks, shouting with ``!!``),
  or the line has no letter or digit at all;
* navigation: at least ``nav_marks`` separators (``|``, ``»``, ``›``, ``•``, ``·``)
  and one for every two words at least;
* boilerplate phrases: one of ``BOILERPLATE`` stands in the lower-cased line, as
  whole words, and the line has at most ``boiler_fill`` words for each of its own
  (longer lines are prose that mentions it);
* boilerplate of a source: a line of up to ``common_words`` words that stands in
  at least ``common_share`` of its source's documents, and between at least
  ``common_contexts`` different pairs of lines.  Copies of a text, however many, put
  a line between the same two lines, so they make none of their lines common.

A document is rejected when its whole text fails a base rule (too few words,
or too many words in repeated 8-word windows) or when the lines that failed
held more than ``max_lost`` of its words.

Edge cases: a null or empty text has no word, so it fails the base rule and
is not kept; a null id stays null; repeated rows are judged each by itself;
an empty table gives an empty result; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.llm.common import documents, free_name, quoted, staged, text_or_empty, text_slices
from zonekit.llm.wordhash import (
    lines,
    mix,
    per_document,
    repeated,
    span_hashes,
    span_numbers,
    text_block,
    window_numbers,
    words,
)

# Phrases of page furniture and licence notices, lower case (our choice).
BOILERPLATE = (
    "accept cookies", "all rights reserved", "click here", "cookie policy", "cookie settings",
    "copyright ©", "creative commons", "enable javascript", "is licensed under", "javascript is disabled",
    "licensed under the", "log in", "lorem ipsum", "privacy policy", "read more", "released under", "sign up",
    "skip to content", "subscribe to our", "terms of service", "terms of use", "use cookies",
)


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    max_punct: float = 0.25
    nav_marks: int = 3
    boiler_fill: int = 4
    common_words: int = 12
    common_share: float = 0.05
    common_contexts: int = 10
    max_lost: float = 0.5


VERDICT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_bad_lines", T.LongType()),
        T.StructField("words_left", T.LongType()),
        T.StructField("clean_text", T.StringType()),
    ]
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
# ASCII characters that are neither letter, digit nor white space.
_PUNCT = np.array([32 < i < 127 and not chr(i).isalnum() for i in range(256)])
_ALNUM = np.array([i >= 0xC2 or (i < 128 and chr(i).isalnum()) for i in range(256)])
# Bytes of words: letters, digits and all beyond ASCII.
_WORDY = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
_NAV = ("»", "›", "•", "·")


def judge(texts: pa.Array, rules: Rules, common: tuple[pa.Array, pa.Array] | None = None) -> dict[str, np.ndarray | list]:
    """The columns of ``VERDICT`` for a block of texts; ``common`` has each one's source and the hashes of its common lines."""
    data, off = text_block(texts)
    n = len(off) - 1
    w_start, w_end, w_doc = words(data, off)
    numbers = span_numbers(data, w_start, w_end)
    n_words = per_document(w_doc, n)

    # running counts over the bytes: a span's count is a difference
    def counter(flags: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])

    lead = (data & 0xC0) != 0x80
    chars = counter(lead)
    word_chars = per_document(w_doc, n, chars[w_end] - chars[w_start])
    symbols = counter(_SYMBOL[data])
    n_symbols = symbols[off[1:]] - symbols[off[:-1]]

    at, runs = window_numbers(numbers, w_doc, rules.window)
    twice = at[repeated(runs * n + w_doc[at])]
    cover = np.zeros(len(w_doc) + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + rules.window, -1)
    n_repeat = per_document(w_doc[np.cumsum(cover[:-1]) > 0], n)

    l_start, l_end, l_doc = lines(data, off)
    l_words = np.searchsorted(w_start, l_end) - np.searchsorted(w_start, l_start)
    held = np.flatnonzero(l_words)
    keys = span_numbers(data, l_start[held], l_end[held]) * n + l_doc[held]
    _, earliest = np.unique(keys, return_index=True)
    later = np.ones(len(held), dtype=bool)
    later[earliest] = False
    n_dup = per_document(l_doc[held[later]], n)

    bad = bad_lines(data, (l_start, l_end, l_words), chars, rules)
    if common is not None and common[1].null_count < n:
        bad |= _listed(data, (l_start, l_end, l_doc, l_words), rules, common)
    lost = per_document(l_doc, n, np.where(bad, l_words, 0))
    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    n_bad = per_document(l_doc[bad], n)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup,
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & (lost <= rules.max_lost * n_words),
        "n_lines": per_document(l_doc, n),
        "n_bad_lines": n_bad,
        "words_left": n_words - lost,
        "clean_text": _without(data, off, (l_start, l_end, l_doc), bad, n_bad),
    }


def bad_lines(data: np.ndarray, spans: tuple, chars: np.ndarray, rules: Rules) -> np.ndarray:
    """True for each line that fails a rule; lines without a word pass."""
    start, end, n_words = spans
    if not len(data):
        return np.zeros(len(start), dtype=bool)

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[end] - total[start]

    size = chars[end] - chars[start]
    raw = data.tobytes()
    marks = data == ord("|")
    for mark in _NAV:
        _flag(raw, mark.encode(), marks, end)
    low = raw.lower()
    boiler = np.zeros(len(start), dtype=bool)
    for size_of in sorted({len(p.split()) for p in BOILERPLATE}):
        found = np.zeros(len(data), dtype=bool)
        for phrase in (p.encode() for p in BOILERPLATE if len(p.split()) == size_of):
            _flag(low, phrase, found, end, whole=True)
        boiler |= (within(found) > 0) & (n_words <= rules.boiler_fill * size_of)
    n_marks = within(marks)
    punctuation = (within(_PUNCT[data]) > rules.max_punct * size) | (within(_ALNUM[data]) == 0)
    navigation = (n_marks >= rules.nav_marks) & (2 * n_marks >= n_words - n_marks)
    return (n_words > 0) & (punctuation | navigation | boiler)


def _flag(raw: bytes, what: bytes, flags: np.ndarray, line_ends: np.ndarray, whole: bool = False) -> None:
    """Mark where ``what`` begins, if it ends within the same line (texts follow each other without a break).

    ``whole``: and if no letter, digit or other part of a word stands next to its own.
    """
    at = raw.find(what)
    while at >= 0:
        line = np.searchsorted(line_ends, at, side="right")
        stop = at + len(what)
        if stop <= line_ends[line]:
            left = at > (line_ends[line - 1] if line else 0) and _WORDY[raw[at - 1]] and _WORDY[what[0]]
            right = stop < line_ends[line] and _WORDY[raw[stop]] and _WORDY[what[-1]] and what[-1] < 128
            if not whole or not (left or right):
                flags[at] = True
        at = raw.find(what, at + 1)


def _line_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes(data, start, end, 9)


def _listed(data: np.ndarray, spans: tuple, rules: Rules, common: tuple[pa.Array, pa.Array]) -> np.ndarray:
    """True for each short line whose hash is listed for its document's source."""
    start, end, doc, n_words = spans
    source, listed = common[0].to_numpy(), common[1]
    asked = np.flatnonzero((n_words > 0) & (n_words <= rules.common_words) & listed.is_valid().to_numpy(zero_copy_only=False)[doc])
    hashes, owner = _line_hashes(data, start[asked], end[asked]), source[doc[asked]]
    out = np.zeros(len(start), dtype=bool)
    for of, first in zip(*np.unique(source, return_index=True), strict=True):
        if listed[int(first)].is_valid:
            own = np.flatnonzero(owner == of)
            out[asked[own]] = np.isin(hashes[own], listed[int(first)].values.to_numpy().view(np.uint64))
    return out


def common_lines(docs: DataFrame, rules: Rules, text: str = "text", source: str | None = "source") -> DataFrame:
    """(source, lines): hashes of the lines that are boilerplate of a source, for the sources that have any.

    A document has a line once.  The lists are short whatever the source's size: a line
    takes ``common_share`` of its documents.
    """
    kind = docs.schema[source].dataType.simpleString() if source else "int"
    rows = docs.select((quoted(source) if source else F.lit(0)).alias("source"), text_or_empty(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "body", 1 << 20):
            data, off = text_block(batch.column("body"))
            w_start, _, _ = words(data, off)
            start, end, doc = lines(data, off)
            n_words = np.searchsorted(w_start, end) - np.searchsorted(w_start, start)
            hashes = _line_hashes(data, start, end)
            # the lines before and after, of the same text
            edge = np.uint64(0)
            before = np.where(np.append([False], doc[1:] == doc[:-1]), np.append([edge], hashes[:-1]), edge)
            after = np.where(np.append(doc[1:] == doc[:-1], [False]), np.append(hashes[1:], [edge]), edge)
            context = mix(before + np.uint64(1)) + after
            short = np.flatnonzero((n_words > 0) & (n_words <= rules.common_words))
            _, first = np.unique(hashes[short] ^ mix(doc[short].astype(np.uint64) + np.uint64(7)), return_index=True)
            short = short[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source").take(pa.array(doc[short])), pa.array(hashes[short].view(np.int64)), pa.array(context[short].view(np.int64))],
                names=["source", "line", "context"],
            )

    found = rows.mapInArrow(run, f"source {kind}, line long, context long")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs")).select(F.col("source").alias("of"), "docs")
    # copies in one context are summed on the map side; then a line's contexts are
    each = found.groupBy("source", "line", "context").agg(F.count(F.lit(1)).alias("n"))
    counts = each.groupBy("source", "line").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("contexts"))
    counts = staged(counts.filter(F.col("contexts") >= rules.common_contexts), "line-counts")
    often = counts.join(sizes, F.col("source").eqNullSafe(F.col("of"))).filter(F.col("n") >= rules.common_share * F.col("docs"))
    return staged(often.groupBy("source").agg(F.collect_list("line").alias("lines")), "common-lines")


def _without(data: np.ndarray, off: np.ndarray, spans: tuple, bad: np.ndarray, n_bad: np.ndarray) -> list[str]:
    """Each text without its bad lines."""
    start, end, doc = spans
    first = np.searchsorted(doc, np.arange(len(off)))
    out = []
    for i in range(len(off) - 1):
        if n_bad[i]:
            good = [k for k in range(first[i], first[i + 1]) if not bad[k]]
            out.append("\n".join(data[start[k] : end[k]].tobytes().decode() for k in good))
        else:
            out.append(data[off[i] : off[i + 1]].tobytes().decode())
    return out


def assess(docs: DataFrame, text: str = "text", rules: Rules | None = None, out: str | None = None, source: str = "source") -> tuple[DataFrame, str]:
    """``docs`` with a struct column of ``VERDICT``; returns its name too (free of clashes)."""
    rules = rules or Rules()
    out = out or free_name(docs, "quality")
    has_source = source in docs.columns
    common = common_lines(docs, rules, text, source if has_source else None)
    # by place, as a name with a dot cannot be handed to mapInArrow
    columns = [f"c{i}" for i in range(len(docs.columns))]
    body = columns[docs.columns.index(text)]
    plain = docs.toDF(*columns)
    schema = T.StructType([*plain.schema.fields, T.StructField("verdict", VERDICT)])
    fields = [(f.name, pa.int64() if f.dataType == T.LongType() else pa.bool_()) for f in VERDICT.fields[:-1]]
    own = F.col(columns[docs.columns.index(source)]) if has_source else F.lit(0)
    plain = plain.join(common, own.eqNullSafe(F.col("source")), "left").withColumn("of", F.xxhash64(own)).drop("source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, body, 1 << 20):
            got = judge(batch.column(body), rules, (batch.column("of"), batch.column("lines")))
            parts = [pa.array(got[name], type=kind) for name, kind in fields] + [pa.array(got["clean_text"], pa.string())]
            verdict = pa.StructArray.from_arrays(parts, names=[f.name for f in VERDICT.fields])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], verdict], names=[*columns, "verdict"])

    return plain.mapInArrow(run, schema).toDF(*docs.columns, out), out


def clean_lines_then_reject(docs: DataFrame, text: str = "text", length: str | None = None, rules: Rules | None = None) -> DataFrame:
    """The documents that stay, without their bad lines, in the columns of ``docs``.

    ``length`` names a column that holds the text's length in characters,
    which then follows the text.
    """
    judged, verdict = assess(docs, text, rules)
    clean = F.col(verdict)["clean_text"]
    changed = {text: F.when(F.col(verdict)["n_bad_lines"] > 0, clean).otherwise(quoted(text))}
    if length:
        changed[length] = F.when(F.col(verdict)["n_bad_lines"] > 0, F.length(clean).cast(docs.schema[length].dataType)).otherwise(quoted(length))
    return judged.filter(F.col(verdict)["kept"]).select(
        *[changed[c].alias(c) if c in changed else quoted(c) for c in docs.columns]
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and verdict (contract of operator 10)."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    judged, verdict = assess(docs)
    counts = [f.name for f in VERDICT.fields if f.name != "clean_text"]
    return judged.select("doc_id", *[F.col(verdict)[c].alias(c) for c in counts])
