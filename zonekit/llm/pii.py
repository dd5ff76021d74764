"""Personal data: pattern spans, and the words around them that give a person away.

Base spans are e-mail and IP addresses, card and telephone numbers.  Removing
them is not enough where other words of the text point at the same person:
if a word occurs (almost) only in texts that hold one protected value, the
word discloses the value.  So for every protected value e that occurs in
different texts, and every term t of those texts, of any length, the corpus gives

* support: different texts that hold both t and e,
* posterior: support / texts that hold t, a lower bound of P(e | t),
* information: log2(texts * support / (texts with t * texts with e)),
  the pointwise mutual information in bits.

A term that reaches all three thresholds is sanitised in the documents that
hold e: removed where its posterior is ``remove_at`` or more, generalised
otherwise.  The support asked for is two texts: in a single one nothing tells the words
that belong to the value from those that happen to be nowhere else.  All counts are over different texts, so copies change none of
them, and every copy is sanitised like its original.  A value so
frequent that no term can reach the information threshold is left out before
its texts are opened, which changes no result.

Everything is DataFrame operations.  Patterns are written so that matching
is linear: a match may only start where a run of its characters starts, or
where the last match ended, which gives the same leftmost non-overlapping
matches.  Spans are rows until the end (a window sums lengths per document
and kind), so many spans in one text cost no quadratic copying.

Edge cases: a null text is empty and has no spans; a null id stays null;
repeated rows all get the same spans; an empty table gives an empty result;
further columns are left aside by ``find`` and pass through ``sanitise``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonekit.llm.common import documents, free_name, quoted, row_key, staged, text_or_empty

KINDS = ("email", "ip", "card", "phone", "term")

# kind: (cheap test, pattern); possessive where nothing later can need the characters back.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": (
        _LOCAL + r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    "ip": (
        r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    ),
    "card": (
        r"[0-9](?:[ -]?[0-9]){12}",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}+",
    ),
    "phone": (
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9][ ().0-9-]+[0-9]",
    ),
}
# A term is a run of letters and digits, in lower case.
_TERM = r"[\p{L}\p{N}]++"


@dataclass(frozen=True)
class Disclosure:
    min_support: int = 2
    min_posterior: float = 0.8
    min_bits: float = 4.0
    remove_at: float = 0.95


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    small = F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^([0-9]?[0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, small)
        .when(kind == 2, (F.length(digits) <= 19) & F.call_function("luhn_check", digits))
        .otherwise(F.length(digits).between(9, 15))
    )


def _spans(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, end, match) from (keys, before, matches): the text cut at the matches.

    Positions are code points; a window per document adds up the lengths.
    """
    cut = pieces.select(*keys, F.posexplode(F.arrays_zip("before", "matches")).alias("i", "cut"))
    cut = cut.select(*keys, "i", F.length("cut.before").cast("long").alias("gap"), F.col("cut.matches").alias("match"))
    order = Window.partitionBy(*keys).orderBy("i")
    width = F.coalesce(F.length("match").cast("long"), F.lit(0))
    ahead = F.sum(F.col("gap") + width).over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(ahead, F.lit(0)) + F.col("gap")
    placed = cut.select(*keys, start.alias("start"), "match").filter("match is not null")
    return placed.withColumn("end", F.col("start") + F.length("match"))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = text_or_empty(text)
    return docs.select(row_key(quoted(key), body).alias("row"), body.alias("body"))


def base_spans(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, match) of all base spans of ``rows`` (row, body), once for repeated rows."""
    found = []
    for i, kind in enumerate(KINDS[:4]):
        test, pattern = PATTERNS[kind]
        has = F.col("body").rlike(test)
        sign = {"email": "@", "phone": "+"}.get(kind)
        if sign:  # a plain search spares most texts the pattern
            has = F.col("body").contains(sign) & has
        cut = F.struct(
            F.lit(i).alias("kind"),
            F.split("body", pattern, -1).alias("before"),
            F.regexp_extract_all("body", F.lit(pattern), F.lit(0)).alias("matches"),
        )
        found.append(F.when(has, cut))
    held = F.filter(F.array(*found), lambda x: x.isNotNull())
    one = rows.withColumn("held", held).filter(F.size("held") > 0).select("row", "held").dropDuplicates(["row"])
    cuts = one.select("row", F.explode("held").alias("cut")).select("row", "cut.kind", "cut.before", "cut.matches")
    return _spans(cuts, ["row", "kind"]).filter(_valid(F.col("kind"), F.col("match")))


def _without_values(body: Column) -> Column:
    for kind in KINDS[:4]:
        body = F.regexp_replace(body, PATTERNS[kind][1], " ")
    return body


def _terms(body: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(body), F.lit(_TERM), F.lit(0)))


def disclosing(rows: DataFrame, spans: DataFrame, how: Disclosure) -> DataFrame:
    """(row, term, posterior): terms to sanitise in each row, from co-occurrence over all ``rows``."""
    # different texts, not rows: copies are no further evidence, for a term or against it
    content = F.regexp_extract("row", r":(-?\d+:-?\d+)$", 1)
    n_docs = rows.agg(F.count_distinct(content)).scalar()
    values = spans.select("row", F.concat_ws(":", "kind", F.lower("match")).alias("value")).distinct()
    texts = values.groupBy("value").agg(F.count_distinct(content).alias("n_value"))
    texts = texts.filter(F.col("n_value") >= how.min_support).withColumn("n_docs", n_docs)
    texts = texts.filter(F.log2(F.col("n_docs") / F.col("n_value")) >= how.min_bits)
    held = staged(values.join(texts, "value").withColumn("content", content), "values")
    if held.isEmpty():  # no value that a term could disclose
        return held.select("row", F.col("value").alias("term"), F.lit(1.0).alias("posterior"))

    opened = rows.join(held.select("row").distinct().hint("merge"), "row").dropDuplicates(["row"])
    terms = staged(opened.select("row", F.explode(_terms(_without_values(F.col("body")))).alias("term")), "terms")
    pairs = held.dropDuplicates(["value", "content"]).join(terms, "row")
    pairs = pairs.groupBy("value", "term", "n_value", "n_docs").agg(F.count(F.lit(1)).alias("support"))
    pairs = pairs.filter(F.col("support") >= how.min_support)

    # copies meet on the map side first, so a large group of them is one row per task
    each = rows.select(content.alias("content"), "body").dropDuplicates(["content"])
    frequency = each.select(F.explode(_terms(_without_values(F.col("body")))).alias("term"))
    frequency = frequency.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    posterior = F.col("support") / F.col("n_term")
    bits = F.log2(F.col("n_docs") * F.col("support") / (F.col("n_term") * F.col("n_value")))
    known = pairs.join(frequency, "term").withColumn("posterior", posterior)
    known = known.filter((posterior >= how.min_posterior) & (bits >= how.min_bits)).select("value", "term", "posterior")
    known = staged(known, "disclosing")
    meet = held.select("row", "value").join(known, "value").join(terms, ["row", "term"])
    return meet.groupBy("row", "term").agg(F.max("posterior").alias("posterior"))


def term_spans(rows: DataFrame, spans: DataFrame, found: DataFrame, how: Disclosure) -> DataFrame:
    """(row, kind, start, end, match) of the terms in ``found`` (row, term, posterior), clear of base spans.

    ``match`` says what becomes of the term: removed or generalised.
    """
    found = staged(found, "found")
    open_rows = rows.join(found.select("row").distinct().hint("merge"), "row").dropDuplicates(["row"])
    cuts = open_rows.select(
        "row",
        F.split("body", _TERM, -1).alias("before"),
        F.regexp_extract_all("body", F.lit(_TERM), F.lit(0)).alias("matches"),
    )
    words = _spans(cuts, ["row"]).withColumn("term", F.lower("match")).join(found, ["row", "term"])
    words = words.alias("w").join(
        spans.alias("s"),
        (F.col("w.row") == F.col("s.row")) & (F.col("s.start") < F.col("w.end")) & (F.col("w.start") < F.col("s.end")),
        "left_anti",
    )
    fate = F.when(F.col("posterior") >= how.remove_at, "removed").otherwise("generalised")
    return words.select("row", F.lit(4).alias("kind"), "start", "end", fate.alias("match"))


def all_spans(docs: DataFrame, how: Disclosure | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, spans) of the rows that have spans; spans are structs (kind, start, end, match) in order."""
    how = how or Disclosure()
    rows = _rows(docs, key, text)
    base = staged(base_spans(rows), "base-spans")
    more = term_spans(rows, base, disclosing(rows, base, how), how)
    every = base.select("row", "kind", "start", "end", "match").unionByName(more)
    return every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "match"))).alias("spans"))


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find(docs: DataFrame, how: Disclosure | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term)."""
    spans = all_spans(docs, how, key, text)
    rows = docs.select(quoted(key).alias("doc_id"), row_key(quoted(key), text_or_empty(text)).alias("row"))
    held = F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType))
    kinds = F.transform(held, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, i)).cast("long") for i in range(len(KINDS))]
    counts = [(F.size(kinds) - n).alias(f"n_{kind}") for n, kind in zip(counts, KINDS, strict=True)]
    base = F.filter(held, lambda s: s["kind"] < 4)
    return rows.join(spans, "row", "left").select(
        "doc_id", *counts[:4], F.sha2(_written(base), 256).alias("base_sha256"), _written(held).alias("spans"), counts[4]
    )


def sanitise(docs: DataFrame, how: Disclosure | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with base values replaced by their kind in brackets, terms removed or replaced by ``[TERM]``.

    Where spans overlap, the one that starts first (the longer, of equal
    starts) is replaced and the others with it.
    """
    row, spans = free_name(docs, "row_key"), free_name(docs, "spans")
    found = all_spans(docs, how, key, text).select(F.col("row").alias(row), F.col("spans").alias(spans))
    marked = docs.withColumn(row, row_key(quoted(key), text_or_empty(text))).join(found, row, "left")
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    placed = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["end"]).alias("back"),
                F.when(s["match"] == "removed", F.lit("")).otherwise(F.element_at(labels, s["kind"] + 1)).alias("label"),
            ),
        )
    )
    # left to right, carrying where the last replaced span ended
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(quoted(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        inside = s["start"] < acc["at"]
        return F.struct(
            F.when(inside, F.greatest(acc["at"], -s["back"])).otherwise(-s["back"]).alias("at"),
            F.when(inside, acc["done"]).otherwise(F.concat(acc["done"], gap, s["label"])).alias("done"),
        )

    rest = F.aggregate(
        placed, empty, step,
        lambda acc: F.concat(acc["done"], F.substring(quoted(text), (acc["at"] + 1).cast("int"), F.length(quoted(text)))),
    )
    changed = F.when(F.col(spans).isNull(), quoted(text)).otherwise(rest).alias(text)
    return marked.select(*[changed if c == text else quoted(c) for c in docs.columns])


def op8_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document (contract of operator 8)."""
    return find(documents(spark, sf_dir).select("doc_id", "text"))
