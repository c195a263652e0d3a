"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of
  - the text's likelihood under a byte-trigram model, raised to a power that counts a long
    text as ``EVIDENCE`` independent trigrams,
  - the declared markup language, right with probability ``DECLARED_TRUST``,
  - the address suffix, where it names a language, right with ``SUFFIX_TRUST``,
  - the prior of the host, from the texts of the whole table: soft counts per host are
    smoothed with those of its domain, and these with all texts. A row's own text does not
    count towards its prior.
A further model, in which all trigrams are alike, stands for no language at all.

The languages are those of all labelled rows, by a grouped count over the whole table. The
trigram model of each is fitted on about ``SAMPLE`` of its distinct rows, chosen by a hash of
id and text, or on all of them if they are no more; everything else covers all rows. A label
whose texts all have less than three bytes gives no trigrams and no model.

Rows: a null or empty text, one of less than three bytes or one without a letter has no
language: ``und``, not kept. A null declared language, address or host is no evidence; rows
without host share one. Null ids and repeated rows are rated each. An empty table gives an
empty result; other columns are ignored. Without any labelled row all rows are ``und``.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.words import LOWER, chunks, text_bytes
from tidemark.session import written

SAMPLE = 2_000
#: Texts are looked at in pieces of about this size.
SCORED_BYTES = 1 << 19
#: Steps of the hash by which rows are sampled.
PLACES = 1 << 30
BINS = 1 << 14
EVIDENCE = 40.0
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.8
SMOOTHING = 20.0
#: Average log-likelihood by which the best language must beat the model of no language.
MARGIN = 0.5
KEEP = 0.5
#: Address suffixes that name a language.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en",
            "us": "en", "au": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl"}
SCALE = 1_000_000


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of trigram bins, one row for each language."""

    languages: tuple[str, ...]
    table: np.ndarray

    @property
    def flat(self) -> float:
        return float(-np.log(BINS))


def trigrams(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of all trigrams within rows, each row's first trigram, and which rows hold a letter."""
    low = LOWER[body]
    letter = (low >= 128) | ((low >= 97) & (low <= 122))
    held = np.concatenate([[0], np.cumsum(letter)])
    b = low.astype(np.uint32)
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else np.zeros(0, np.uint32)
    bins = (code * np.uint32(0x9E3779B1)) >> np.uint32(18)
    inside = np.ones(len(code), bool)
    for back in (1, 2):
        cut = offsets[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(code))]] = False
    at = np.concatenate([[0], np.cumsum(inside)])
    return (bins[inside].astype(np.int64), at[np.minimum(offsets, len(code))],
            held[offsets[1:]] > held[offsets[:-1]])


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
        sample: int = SAMPLE) -> TextModel:
    """Trigram counts of a bounded sample of each labelled language, smoothed."""
    text, label = F.col(text_col).cast("string"), F.col(label_col).cast("string")
    key = F.xxhash64(F.col(id_col).cast("string"), text, F.lit("language"))
    labelled = docs.where(label.isNotNull() & (F.octet_length(text) > 2)).select(
        label.alias("label"), text.alias("text"), key.alias("key"))
    sizes = labelled.select("label", "key").distinct().groupBy("label").agg(
        F.count(F.lit(1)).alias("size"))
    place = F.pmod("key", F.lit(PLACES)) * F.col("size")
    rows = labelled.join(written(sizes, "labels"), "label").where(
        (F.col("size") <= sample) | (place < F.lit(sample * PLACES))).dropDuplicates(
        ["label", "key"]).select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            body, offsets = text_bytes(batch.column(1))
            langs = batch.column(0).to_pylist()
            for i, j in chunks(offsets, SCORED_BYTES):
                bins, first, _ = trigrams(body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for lang, lo, hi in zip(langs[i:j], first[:-1], first[1:]):
                    sums.setdefault(lang, np.zeros(BINS, np.int64))
                    sums[lang] += np.bincount(bins[lo:hi], minlength=BINS)
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(counts[some])],
                names=["lang", "bin", "n"])

    counts = rows.mapInArrow(count, "lang string, bin bigint, n bigint").groupBy(
        "lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    table = np.full((len(languages), BINS), 0.5)
    for k, (_, mine) in enumerate(counts.groupby("lang", sort=True)):
        table[k, mine["bin"]] += mine["n"]
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def text_scores(docs: DataFrame, model: TextModel) -> DataFrame:
    """Average log-likelihood of each language, trigrams, and whether the text holds a letter.

    Column 0 holds the text; the other columns are carried along.
    """
    schema = docs.drop("text").schema.add("scores", T.ArrayType(T.DoubleType())).add(
        "trigrams", T.LongType()).add("letters", T.BooleanType())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text_bytes(batch.column(0))
            scores, sizes, letters = [], [], []
            for i, j in chunks(offsets, SCORED_BYTES):
                bins, first, held = trigrams(body[offsets[i]:offsets[j]],
                                             offsets[i:j + 1] - offsets[i])
                n = np.diff(first)
                each = np.empty((j - i, len(model.table)))
                for k, row in enumerate(model.table):      # one running sum at a time
                    run = np.concatenate([[0.0], np.cumsum(row[bins], dtype=np.float64)])
                    each[:, k] = (run[first[1:]] - run[first[:-1]]) / np.maximum(n, 1)
                scores.append(each)
                sizes.append(n)
                letters.append(held)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:],
                 pa.array([list(r) for s in scores for r in np.round(s, 6)], pa.list_(pa.float64())),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *sizes])),
                 pa.array(np.concatenate([np.zeros(0, bool), *letters]))],
                names=[f.name for f in schema])

    return docs.mapInArrow(score, schema)


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    grown = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(grown, lambda x: x / F.aggregate(grown, F.lit(0.0), lambda s, y: s + y))


def identify(docs: DataFrame, model: TextModel, text: Column, carry: list[Column],
             declared: Column, suffix: Column, levels: list[Column]) -> DataFrame:
    """The carried columns, the language of each row and how sure it is.

    ``levels`` go from the widest part of the address to the host.
    """
    names = [f"level_{k}" for k in range(len(levels))]
    rows = docs.select(
        F.coalesce(text.cast("string"), F.lit("")).alias("text"), *carry,
        F.lower(declared.cast("string")).alias("declared"), F.lower(suffix).alias("suffix"),
        *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in zip(levels, names)))
    rows = text_scores(rows, model)
    k = len(model.languages)
    if k == 0:
        return rows.drop("scores", "trigrams", "letters", "suffix", *names).withColumns(
            {"lang": F.lit("und"), "confidence": F.lit(0.0), "kept": F.lit(False)})
    power = F.least(F.col("trigrams").cast("double"), F.lit(EVIDENCE))
    rows = written(rows.withColumn("text_log", F.transform("scores", lambda s: s * power)).withColumn(
        "own", F.transform(softmax(F.col("text_log")), lambda p: F.round(p * SCALE).cast("bigint"))),
        "language")

    def counted(keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*(F.sum(F.col("own")[i]).alias(f"c{i}") for i in range(k)))

    whole = counted([]).first()
    start = [float((whole[i] or 0) + SCALE) for i in range(k)]
    base = F.array(*(F.lit(x / sum(start)) for x in start))

    def smooth(counts: Column, wider: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
        return F.zip_with(counts, wider, lambda c, w: (c + SMOOTHING * SCALE * w) / (
            total + SMOOTHING * SCALE))

    prior = None
    for depth in range(1, len(levels) + 1):
        keys = names[:depth]
        table = counted(keys).select(*keys, F.array(*(F.col(f"c{i}") for i in range(k))).alias(
            "counts"))
        if prior is None:
            prior = table.withColumn("wider", base)
        else:
            prior = table.join(prior.withColumn("wider", smooth(F.col("counts"), F.col("wider")))
                               .drop("counts"), keys[:-1])
    if prior is not None:
        rows = rows.join(prior, names)
        others = F.zip_with("counts", "own", lambda c, o: F.greatest(c - o, F.lit(0).cast("bigint")))
        chance = smooth(others, F.col("wider"))
    else:
        chance = base

    def said(value: Column, trust: float) -> Column:
        """Log-probability of a statement under each language; nothing when none is made."""
        miss = (1 - trust) / max(k - 1, 1)
        each = F.array(*(F.when(value == name, float(np.log(trust))).otherwise(float(np.log(miss)))
                         for name in model.languages))
        known = value.isin(*model.languages)
        return F.when(known, each).otherwise(F.array_repeat(F.lit(0.0), k))

    meant = F.try_element_at(F.create_map(*(F.lit(x) for p in SUFFIXES.items() for x in p)),
                             F.col("suffix"))
    logs = F.zip_with("text_log", chance, lambda t, p: t + F.log(p))
    logs = F.zip_with(logs, said(F.col("declared"), DECLARED_TRUST), lambda a, b: a + b)
    logs = F.zip_with(logs, said(meant, SUFFIX_TRUST), lambda a, b: a + b)
    rows = rows.withColumn("posterior", softmax(logs))
    best = F.array_max("posterior")
    found = F.element_at(F.array(*(F.lit(x) for x in model.languages)),
                         F.array_position("posterior", best).cast("int"))
    spoken = F.col("letters") & (F.col("trigrams") > 0) & (
        F.array_max("scores") > model.flat + MARGIN)
    lang = F.when(spoken, found).otherwise("und")
    return rows.withColumns({"lang": lang, "confidence": F.when(spoken, F.round(best, 6)).otherwise(
        0.0), "kept": spoken & (best >= KEEP)}).drop(
        "scores", "trigrams", "letters", "text_log", "own", "counts", "wider", "suffix",
        "posterior", *names)


def document_languages(docs: DataFrame, model: TextModel | None = None) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``declared``, ``lang``, ``confidence``, ``kept``.

    The source stands for the host. Markup in the text declares a language before the column
    does, and the first address in the text gives the suffix.
    """
    model = model or fit(docs)
    markup = F.nullif(F.regexp_extract(
        "text", r"(?i)<html[^>]*\slang=[\"']?([a-z]{2})", 1), F.lit(""))
    suffix = F.nullif(F.regexp_extract(
        "text", r"https?://[\w.-]{1,200}\.([a-z]{2,6})(?![\w.-])", 1), F.lit(""))
    has = F.contains(F.lower("text"), F.lit("<html"))
    return identify(
        docs, model, F.col("text"), [F.col("doc_id").cast("bigint").alias("doc_id"),
                                     F.xxhash64("text").alias("mark")],
        F.coalesce(F.when(has, markup), F.col("lang")),
        F.when(F.contains("text", F.lit("://")), suffix), [F.col("source")])


def page_languages(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id``, ``url``, ``declared``, ``lang``, ``confidence`` and ``kept`` of web pages."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1))
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    return identify(
        pages, model, plain, [F.col("page_id").cast("bigint").alias("page_id"), F.col("url")],
        F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([a-z]{2})", 1),
                 F.lit("")),
        F.regexp_extract(host, r"\.([a-z]+)$", 1),
        [F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), host])
