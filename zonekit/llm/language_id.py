"""Language identification by Bayesian fusion of text, markup, address and host.

Four kinds of evidence meet in one posterior per text:

* text: a naive Bayes model over hashed byte trigrams, trained here on a
  bounded sample of the labelled rows of each language (``train_rows``), so a
  language with any label is possible, however rare; its log-likelihood is
  tempered by ``text_weight``, as trigrams of one text are not independent;
* markup: the declared language; how often a declaration goes with a
  language is estimated by grouped sums of text posteriors over all rows;
* address suffix, domain and host: priors by grouped sums of text posteriors,
  each level smoothed by the one above (host by domain, domain by suffix,
  suffix by all rows).  A row's own share is taken out of its priors.

The groups are summed on the map side before they are shuffled, so a host
with a third of all rows is one row per task; the join back has one row per
group on the other side, which Spark splits where a host is hot.  Only the
model (languages x buckets) and the declaration table go through the driver.

Edge cases: a null or empty text has no text evidence and is decided by the
priors; a null address is the empty host; an unknown declaration counts as
none; repeated rows count as often as they occur; a table without labelled
rows gives a null language; an empty table gives an empty result; further
columns are left aside.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm.common import documents, staged, text_slices
from zonekit.llm.wordhash import text_block


@dataclass(frozen=True)
class Fusion:
    #: about so many labelled rows of each language train the text model, taken by hashed id
    train_rows: int = 4000
    buckets: int = 1 << 14
    text_weight: float = 0.15
    #: pseudo-counts with which a level is smoothed by the level above
    host_weight: float = 5.0
    domain_weight: float = 10.0
    suffix_weight: float = 50.0
    declared_weight: float = 5.0


def visible(page: bytes) -> bytes:
    """The text of a page without scripts, styles, comments and tags."""
    low, out, at = page.lower(), [], 0
    while (begin := page.find(b"<", at)) >= 0:
        out.append(page[at:begin])
        mark = b">"
        if low.startswith(b"<!--", begin):
            mark = b"-->"
        elif low.startswith((b"<script", b"<style"), begin):
            mark = b"</script" if low.startswith(b"<script", begin) else b"</style"
        end = low.find(mark, begin + 1)
        if end < 0:
            return b" ".join(out)
        if mark.startswith(b"</"):
            end = low.find(b">", end)
            if end < 0:
                return b" ".join(out)
        at = end + len(mark) if mark != b"</script" and mark != b"</style" else end + 1
    out.append(page[at:])
    return b" ".join(out)


def trigrams(texts: pa.Array, markup: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every byte trigram that has no white space at its centre."""
    plain = []
    for text, is_markup in zip(texts.cast(pa.binary()).to_pylist(), markup.to_pylist(), strict=True):
        raw = text or b""
        if is_markup:
            raw = visible(raw)
            if b"&" in raw:
                raw = html.unescape(raw.decode("utf-8", "replace")).encode("utf-8", "replace")
        plain.append(raw.lower())
    data, off = text_block(pa.array([b" " + p + b" " for p in plain], pa.binary()).cast(pa.large_binary()).cast(pa.large_string(), safe=False))
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    wide = data.astype(np.uint32)
    codes = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    bucket = ((codes * np.uint32(2654435761)) >> np.uint32(32 - int(buckets).bit_length() + 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    letters = (data[1:-1] >= 0x80) | ((data[1:-1] | 0x20) - ord("a") < 26)
    good = letters & (owner[:-2] == owner[2:])
    return owner[:-2][good], bucket[good]


def train(labelled: DataFrame, how: Fusion) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities by language and bucket) from ``labelled`` (id, text, markup, lang)."""
    known = labelled.filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    languages = sorted(sizes)
    # by hashed id and in place: no sort, and the same rows every time
    bound = F.lit(1 << 30)
    for lang, n in sizes.items():
        if n > how.train_rows:
            bound = F.when(F.col("lang") == lang, F.lit(how.train_rows * (1 << 30) // n)).otherwise(bound)
    sample = known.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 4 << 20):
            owner, bucket = trigrams(batch.column("text"), batch.column("markup"), how.buckets)
            names, which = np.unique(np.array(batch.column("lang").to_pylist()), return_inverse=True)
            counts = np.bincount(which[owner] * how.buckets + bucket, minlength=len(names) * how.buckets)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[at // how.buckets].tolist(), pa.string()), pa.array(at % how.buckets), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )

    sums = sample.select("text", "markup", "lang").mapInArrow(run, "lang string, bucket long, n long")
    rows = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()  # at most languages x buckets
    counts = np.full((len(languages), how.buckets), 0.5)
    for r in rows:
        counts[languages.index(r["lang"]), r["bucket"]] += r["n"]
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def score(rows: DataFrame, model: tuple[list[str], np.ndarray], how: Fusion) -> DataFrame:
    """(keys, declared, host, text_log) of ``rows`` (keys..., text, markup, declared, host), staged.

    ``text_log`` holds the tempered log-likelihood of each language, the largest being 0.
    """
    languages, logs = model
    kept = [c for c in rows.columns if c not in ("text", "markup")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", 2 << 20):
            owner, bucket = trigrams(batch.column("text"), batch.column("markup"), how.buckets)
            n = batch.num_rows
            found = np.stack([np.bincount(owner, row[bucket], minlength=n)[:n] for row in logs], axis=1) * how.text_weight
            found -= found.max(axis=1, keepdims=True)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * len(languages))
            values = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], values], names=[*kept, "text_log"])

    fields = ", ".join(f"`{c}` {t}" for c, t in rows.select(*kept).dtypes)
    return staged(rows.mapInArrow(run, f"{fields}, text_log array<double>"), "scores")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _sums(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Text posteriors summed by group, as an array ``s``; plain sums, so tasks add up first."""
    totals = [F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(n)]
    made = rows.groupBy(*keys).agg(*totals)
    return made.select(*keys, F.array(*[F.col(f"s{i}") for i in range(n)]).alias("s"))


def fuse(scored: DataFrame, languages: list[str], how: Fusion) -> DataFrame:
    """``scored`` with (lang, posterior, text_lang): the most probable language by all evidence."""
    n = len(languages)
    labels = F.array(*[F.lit(x) for x in languages])
    parts = F.split("host", r"\.")
    rows = scored.withColumn("post", _softmax(F.col("text_log")))
    rows = rows.withColumn("suffix", F.element_at(parts, -1)).withColumn("domain", F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2)))
    known = F.array_contains(labels, F.col("declared"))
    rows = rows.withColumn("declared", F.when(known, F.col("declared")).otherwise(F.lit("")))

    suffixes = _sums(rows, ["suffix"], n)
    # one row per suffix, language pair and declaration: small, and only these sums leave the executors
    everyone = [float(x or 0) for x in suffixes.agg(*[F.sum(F.col("s")[i]) for i in range(n)]).first()]
    total = sum(everyone)
    base = [(x + 1) / (total + n) for x in everyone]
    told = {r["declared"]: r["s"] for r in _sums(rows, ["declared"], n).collect()}
    by_language = [sum(s[i] for s in told.values()) for i in range(n)]
    n_told = n + 1

    def declared_log(word: str) -> Column:
        seen = told.get(word, [0.0] * n)
        return F.array(*[F.lit(float(np.log((seen[i] + how.declared_weight / n_told) / (by_language[i] + how.declared_weight)))) for i in range(n)])

    declared = declared_log("")
    for word in languages:
        declared = F.when(F.col("declared") == word, declared_log(word)).otherwise(declared)

    for level in ("suffix", "domain", "host"):
        # a table of its own: small ones are broadcast by their files' size, larger ones
        # are dealt for the join alone, so that a hot group can be split
        group = staged(_sums(rows, [level], n).withColumnRenamed("s", f"{level}_sum"), f"{level}-sums")
        rows = rows.join(group, level)

    def smoothed(sums: str, above: Column, weight: float) -> Column:
        # without the row's own share
        others = F.transform(F.arrays_zip(F.col(sums).alias("a"), F.col("post").alias("b")), lambda x: F.greatest(x["a"] - x["b"], F.lit(0.0)))
        held = F.aggregate(others, F.lit(0.0), lambda a, x: a + x)
        pairs = F.arrays_zip(others.alias("a"), above.alias("b"))
        return F.transform(pairs, lambda x: (x["a"] + weight * x["b"]) / (held + weight))

    prior = F.array(*[F.lit(x) for x in base])
    for level, weight in (("suffix", how.suffix_weight), ("domain", how.domain_weight), ("host", how.host_weight)):
        rows = rows.withColumn("prior", smoothed(f"{level}_sum", prior, weight))
        prior = F.col("prior")
    rows = rows.withColumn("declared_log", declared)
    joint = F.transform(F.arrays_zip("text_log", "declared_log", "prior"), lambda x: x["text_log"] + x["declared_log"] + F.log(x["prior"]))
    rows = rows.withColumn("joint", _softmax(joint))
    best = F.array_position("joint", F.array_max("joint")).cast("int")
    text_best = F.array_position("text_log", F.array_max("text_log")).cast("int")
    return rows.select(
        *[c for c in scored.columns if c not in ("text_log", "declared", "host")],
        "host",
        F.nullif("declared", F.lit("")).alias("declared"),
        F.element_at(labels, best).alias("lang"),
        F.round(F.array_max("joint"), 6).alias("posterior"),
        F.element_at(labels, text_best).alias("text_lang"),
    )


def identify(rows: DataFrame, labelled: DataFrame, how: Fusion | None = None) -> DataFrame:
    """Language of ``rows`` (keys..., text, markup, declared, host), trained on ``labelled`` (id, text, markup, lang)."""
    how = how or Fusion()
    languages, logs = train(labelled, how)
    if not languages:
        kept = [c for c in rows.columns if c not in ("text", "markup", "declared", "host")]
        null = F.lit(None).cast("string")
        return rows.select(*kept, "host", "declared", null.alias("lang"), F.lit(None).cast("double").alias("posterior"), null.alias("text_lang"))
    return fuse(score(rows, (languages, logs), how), languages, how)


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, text, markup, declared, host) of pages (page_id, url, html)."""
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]{0,500}?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        "page_id",
        F.coalesce(F.col("html"), F.lit("")).alias("text"),
        F.lit(True).alias("markup"),
        F.coalesce(F.lower(declared), F.lit("")).alias("declared"),
        F.coalesce(host, F.lit("")).alias("host"),
    )


def op3_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (host: its source) and of every page."""
    docs = documents(spark, sf_dir)
    pages = page_rows(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("page_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(False).alias("markup"),
        F.lit("").alias("declared"),
        F.coalesce("source", F.lit("")).alias("host"),
    )
    pages = pages.withColumn("doc_id", F.lit(None).cast("long"))
    labelled = docs.select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("markup"), "lang")
    return identify(texts.unionByName(pages), labelled)
