"""Language of web pages by Bayesian fusion of evidence.

The posterior of a language is its host's prior times the likelihoods of the
page's text, of the language its markup declares and of its address suffix.
Text likelihoods are of byte trigrams, counted on a bounded sample of labelled
documents. The other parts come from all pages, by grouped aggregation of a
first guess from the text alone: how often each language declares each value
and has each suffix, and host priors smoothed towards the registered domain's,
those towards the whole corpus's.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written
from .words import _LOWER

#: Labelled documents of each language that the trigram model is fitted on, on average at most.
FIT_DOCS = 600
BUCKETS = 1 << 14
#: Pseudo-counts: of a trigram, of an evidence value, and of a parent's prior.
TRIGRAM_ALPHA, VALUE_ALPHA, PARENT_WEIGHT = 0.5, 1.0, 5.0
#: Trigrams overlap, so each counts as a third of an independent piece of evidence.
TEMPER = 1 / 3

#: A host of a larger share of all pages is hot: there are at most its inverse of them.
HOT_HOST = 0.0005

#: What hides the text up to its end; an opening without an end is a tag.
_OPENS = re.compile(r"(?i)<(?:(script|style)\b|!--)")
_ENDS = {"script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>"), "!--": re.compile("-->")}


def visible_text(page: str) -> str:
    """Text outside tags, comments, scripts and styles, with entities resolved.

    The page is gone through once: an end that isn't found is not looked for
    again, so any page takes time in proportion to its length.
    """
    out, at, missing = [], 0, set()
    while (start := page.find("<", at)) >= 0:
        opened = _OPENS.match(page, start)
        kind = (opened[1] or "!--").lower() if opened else None
        end = -1
        if kind and kind not in missing:
            found = _ENDS[kind].search(page, opened.end())
            end = found.end() if found else -1
            if not found:
                missing.add(kind)
        if end < 0:
            end = page.find(">", start) + 1
        if end <= 0:
            break
        out += [page[at:start], " "]
        at = end
    out.append(page[at:])
    return html.unescape("".join(out))


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte trigrams of a text; ASCII capitals, digits and white space are folded."""
    data = _FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(BUCKETS, np.int64)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(18), minlength=BUCKETS)


_FOLD = _LOWER.copy()
_FOLD[[*range(0x09, 0x0E), *range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20


def text_model(docs: DataFrame, fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram log-probabilities, from about ``fit_docs`` documents of each, those of least hash."""
    labelled = docs.select("text", "lang", "doc_id").where("lang IS NOT NULL AND text IS NOT NULL")
    totals = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not totals:
        return [], np.zeros((0, BUCKETS))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, fit_docs / n))]), F.col("lang"))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) < share * 1_000_000)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                sums[lang] = sums.get(lang, 0) + trigram_counts(text)
        for lang, c in sums.items():
            hit = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": hit, "n": c[hit]})

    rows = chosen.select("text", "lang").mapInPandas(counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(totals)
    table = np.full((len(langs), BUCKETS), TRIGRAM_ALPHA)
    table[rows["lang"].map(langs.index).to_numpy(dtype=int), rows["bucket"].to_numpy(dtype=int)] += rows["n"].to_numpy(dtype=float)
    return langs, np.log(table / table.sum(1, keepdims=True))


def text_evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """page_id, url, declared, and the log-likelihood of each page's visible text in each language (up to one constant a page)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def likelihoods(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            ll = shared.value @ trigram_counts(visible_text(t or "")) * TEMPER
            out.append(ll - ll.max())
        return pd.Series(out)

    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"""(?i)<html\b[^<>]*?\slang\s*=\s*["']?([A-Za-z]{2,3})""", 1))
    return pages.select("page_id", "url", declared.alias("declared"), likelihoods("html").alias("text_ll"))


def host_of(url: Column) -> Column:
    """Lower-cased host, without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def first_guess(values: Column, langs: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, langs)), F.array_position(values, F.array_max(values)).cast("int"))


def _tallies(pages: DataFrame, key: str, langs: list[str], prefix: str) -> DataFrame:
    """For each value of a column the number of pages guessed to be in each language, as an array."""
    return pages.groupBy(key).agg(F.array(*[F.count_if(F.col("guess") == x).cast("double") for x in langs]).alias(prefix))


def _smoothed(own: Column, parent: Column) -> Column:
    """Share of each language among own counts and PARENT_WEIGHT pages of the parent's shares."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x) + PARENT_WEIGHT
    return F.zip_with(own, parent, lambda a, b: (a + PARENT_WEIGHT * b) / total)


def _value_likelihood(counts: Column, totals: list[float], values: int) -> Column:
    """P(value | language), from the counts of the value in each language."""
    return F.zip_with(counts, F.array(*[F.lit(t + VALUE_ALPHA * (values + 1)) for t in totals]), lambda c, t: (c + VALUE_ALPHA) / t)


def identified(pages: DataFrame, docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """For each row of pages: page_id, lang, probability, text_lang, declared, suffix, host.

    A null html is an empty one and gives no text evidence; a page that
    declares nothing, or has no host, counts with those that don't, as a value
    of its own. A null page_id and repeated rows give a row each. If docs has
    no labelled text, lang is null; an empty table gives no rows; other columns
    are ignored. Ties go to the first language by name. A very long or
    malformed page takes time in proportion to its length. The languages are
    those of the labels, a table small enough for the driver.
    """
    langs, model = text_model(docs, fit_docs)
    if not langs:
        nothing = F.lit(None).cast("string")
        return pages.select("page_id", nothing.alias("lang"), F.lit(None).cast("double").alias("probability"), nothing.alias("text_lang"), nothing.alias("declared"), nothing.alias("suffix"), nothing.alias("host"))
    host = host_of(F.col("url"))
    seen = written(
        text_evidence(pages, langs, model)
        .withColumn("host", host)
        .withColumn("domain", F.coalesce(F.regexp_substr("host", F.lit(r"[^.]+\.[^.]+\.?$")), F.lit("")))
        .withColumn("suffix", F.regexp_extract("host", r"\.([a-z]+)\.?$", 1))
        .withColumn("guess", first_guess(F.col("text_ll"), langs))
        .drop("url"),
        "lang-evidence",
    )
    overall = seen.agg(*[F.count_if(F.col("guess") == x).alias(x) for x in langs], F.countDistinct("declared").alias("#declared"), F.countDistinct("suffix").alias("#suffix")).first()
    totals = [float(overall[x]) for x in langs]
    base = F.array(*[F.lit((t + 1) / (sum(totals) + len(langs))) for t in totals])
    domains = _tallies(seen, "domain", langs, "domain_n").select("domain", _smoothed(F.col("domain_n"), base).alias("domain_prior"))
    hosts = seen.groupBy("host").agg(F.first("domain").alias("domain"), F.array(*[F.count_if(F.col("guess") == x).cast("double") for x in langs]).alias("host_n"), F.count(F.lit(1)).alias("pages"))
    priors = hosts.join(domains, "domain").select("host", "pages", _smoothed(F.col("host_n"), F.col("domain_prior")).alias("prior"))
    said = _tallies(seen, "declared", langs, "n").select("declared", _value_likelihood(F.col("n"), totals, overall["#declared"]).alias("declared_p"))
    ends = _tallies(seen, "suffix", langs, "n").select("suffix", _value_likelihood(F.col("n"), totals, overall["#suffix"]).alias("suffix_p"))
    logs = lambda c: F.transform(c, lambda x: F.log(x))
    # Hot hosts' priors are few and broadcast; no other host's pages make a task large.
    priors = written(priors, "lang-priors")
    hot = lambda few: priors.where((F.col("pages") > HOT_HOST * sum(totals)) == F.lit(few)).drop("pages")
    known = seen.join(F.broadcast(hot(True)), "host", "left")
    fused = known.where("prior IS NOT NULL").unionByName(known.where("prior IS NULL").drop("prior").join(hot(False), "host")).join(said, "declared").join(ends, "suffix")
    total = F.col("text_ll")
    for part in ("prior", "declared_p", "suffix_p"):
        total = F.zip_with(total, logs(F.col(part)), lambda a, b: a + b)
    fused = fused.withColumn("log_p", total).withColumn("best", F.array_max("log_p"))
    weight = F.aggregate(F.transform("log_p", lambda x: F.exp(x - F.col("best"))), F.lit(0.0), lambda a, x: a + x)
    return fused.select("page_id", first_guess(F.col("log_p"), langs).alias("lang"), (1 / weight).alias("probability"), F.col("guess").alias("text_lang"), "declared", "suffix", "host")


def query(spark, sf_dir: str) -> DataFrame:
    return identified(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
