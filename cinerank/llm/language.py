"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per page: the likelihood of the visible text under character n-gram models,
the language that the markup declares, the suffix of the address, and a prior of the host. Nothing but the texts'
languages is learnt from labels. How far declarations and suffixes can be trusted is counted over all pages, by the
texts' posteriors, in grouped sums. The host's prior is smoothed by that of its domain, and that by all pages; a page's own
text is taken out of the counts of its host and domain, so no evidence counts twice.

N-grams of one text depend on each other: the log likelihood counts as that of at most ``EVIDENCE`` n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cinerank.llm.batches import Characters, chunks
from cinerank.llm.url_filter import host
from cinerank.session import stored

BITS = 16
WIDTHS = range(1, 4)
PER_LANGUAGE = 500
EVIDENCE = 40
SMOOTHING = 5.0


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The buckets of the n-grams of one width over the batch, and where each row's begin and end."""
    chars = Characters(texts)
    for width, grams in chars.ngrams(WIDTHS):
        begin = np.minimum(chars.rows[:-1], len(grams))
        yield (grams >> np.uint64(64 - BITS)).astype(np.int32), begin, np.maximum(begin, chars.rows[1:] - width + 1)


@dataclass(frozen=True)
class LanguageModel:
    """Log chance of every bucket in every language."""

    languages: list[str]
    chances: np.ndarray

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Log likelihoods by row and language, as of at most ``EVIDENCE`` n-grams."""
        total, count = np.zeros((len(self.languages), len(texts))), np.zeros(len(texts))
        for buckets, begin, end in features(texts):
            for k, chances in enumerate(self.chances):
                running = np.concatenate([[0.0], np.cumsum(chances[buckets], dtype=np.float64)])
                total[k] += running[end] - running[begin]
            count += end - begin
        return (total / np.maximum(count, 1) * np.minimum(count, EVIDENCE)).T


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """N-gram counts of at most ``per_language`` distinct texts of each language, those with the smallest hash."""
    languages = sorted(r[0] for r in docs.where(F.col(lang_col).isNotNull()).select(lang_col).distinct().collect())
    rank = F.xxhash64(text_col)
    picked = None
    for lang in languages:
        own = (docs.where(F.col(lang_col) == lang).select(rank.alias("rank")).distinct().orderBy("rank").limit(per_language)
               .agg(F.max("rank").alias("last")).select(F.lit(lang).alias("lang"), "last"))
        picked = own if picked is None else picked.union(own)
    counts = np.full((len(languages), 1 << BITS), 0.5)
    if picked is not None:
        last = {r[0]: r[1] for r in picked.collect()}  # one number per language
        within = F.lit(False)
        for lang, bound in last.items():
            within = within | ((F.col(lang_col) == lang) & (rank <= bound))
        place = {lang: k for k, lang in enumerate(languages)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros((len(place), 1 << BITS), np.int64)
            for batch in chunks(batches):
                of = np.array([place[x] for x in batch.column("lang").to_pylist()])
                for buckets, begin, end in features(batch.column("text")):
                    for row, k in enumerate(of):
                        own[k] += np.bincount(buckets[begin[row]:end[row]], minlength=1 << BITS)
            k, bucket = np.nonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(own[k, bucket])],
                                             ["k", "bucket", "n"])

        total = (docs.where(within).dropDuplicates([lang_col, text_col]).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
                 .mapInArrow(run, "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n")).toArrow())
        counts[total["k"].to_numpy(), total["bucket"].to_numpy()] += total["n"].to_numpy()
    return LanguageModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def visible_text(html: Column) -> Column:
    """Markup without scripts, styles, comments and tags."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def declared_language(html: Column) -> Column:
    """The primary subtag of the root element's ``lang``, in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,8})""", 1))


def identify(pages: DataFrame, model: LanguageModel, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``declared``, ``text_lang``, ``lang`` and ``chance`` (6 digits).

    Null urls share the empty host, null html is empty: the other evidence decides. Of equal chances the first language
    in order wins. Without languages ``lang`` is null. Repeated rows keep their rows; other columns are not read; an empty
    table gives no rows.
    """
    size = len(model.languages)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # 2^BITS numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = shared.value.evidence(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "host", "declared")), pa.array(list(found), pa.list_(pa.float64()))],
                ["id", "host", "declared", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    html = F.col(html_col)
    read = (pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), declared_language(html).alias("declared"),
                         visible_text(html).alias("text"))
            .mapInArrow(run, f"id {kind}, host string, declared string, text array<double>"))
    labels = F.regexp_replace("host", ":[0-9]*$", "")
    top = F.array_max("text")
    weights = F.transform("text", lambda x: F.exp(x - F.array_max("text")))
    share = F.transform("w", lambda x: (x / F.aggregate("w", F.lit(0.0), lambda a, b: a + b)).cast("decimal(7,6)"))
    rows = stored(read.withColumn("domain", F.substring_index(labels, ".", -2)).withColumn("suffix", F.substring_index(labels, ".", -1))
                  .withColumn("w", weights).withColumn("share", share).drop("w"), "evidence")
    if not size:
        return rows.select(F.col("id").alias(id_col), "host", "declared", F.lit(None).cast("string").alias("text_lang"),
                           F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("chance"))

    def sums(key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.array(*(F.sum(F.col("share")[k]).cast("double") for k in range(size))).alias(f"of_{key}"))

    everything = rows.agg(*(F.sum(F.col("share")[k]).cast("double") for k in range(size)), F.countDistinct("declared"),
                          F.countDistinct("suffix")).first()  # one row
    overall = [(x or 0.0) + 1.0 for x in everything[:size]]
    kinds = {"declared": everything[size], "suffix": everything[size + 1]}
    fused = rows
    for key in ("declared", "suffix", "domain", "host"):
        fused = fused.join(sums(key), key)

    def score(k: int) -> Column:
        own = F.col("share")[k].cast("double")
        prior = F.lit(overall[k] / sum(overall))
        for key in ("domain", "host"):  # each level leaves the page out and is smoothed by the level above
            count = F.aggregate(f"of_{key}", F.lit(0.0), lambda a, b: a + b) - 1.0
            prior = (F.greatest(F.col(f"of_{key}")[k] - own, F.lit(0.0)) + SMOOTHING * prior) / (F.greatest(count, F.lit(0.0)) + SMOOTHING)
        value = F.col("text")[k] - top + F.log(prior)
        for key in ("declared", "suffix"):
            value = value + F.log((F.greatest(F.col(f"of_{key}")[k] - own, F.lit(0.0)) + 1.0) / (overall[k] + kinds[key]))
        return value

    best = F.array_max(F.transform("scores", lambda x, i: F.struct(F.round(x, 9).alias("score"), (-i).alias("place"))))
    names = F.array(*map(F.lit, model.languages))
    chance = 1.0 / F.aggregate(F.transform("scores", lambda x: F.exp(x - F.array_max("scores"))), F.lit(0.0), lambda a, b: a + b)
    first_text = F.array_position("text", F.array_max("text")).cast("int")
    return (fused.withColumn("scores", F.array(*map(score, range(size))))
            .select(F.col("id").alias(id_col), "host", "declared", F.element_at(names, first_text).alias("text_lang"),
                    F.element_at(names, 1 - best["place"]).alias("lang"), F.round(chance, 6).alias("chance")))
