"""Language of web pages: text, declared language, address suffix and host, fused by Bayes.

1. Letter n-grams of labelled texts (at most about ``FIT_ROWS`` documents, chosen by hash) give a
   naive Bayes likelihood per language. A page's visible text is scored whole; neighbouring
   n-grams are not independent, so the log-likelihood is divided by ``TEMPER``.
2. The text's posteriors are summed by declared language, by host and by suffix. These grouped
   sums give P(declared | language) and host priors, smoothed from all pages to the suffix and
   from the suffix to the host.
3. A page's posterior is the product of its host's prior, the likelihood of its declaration
   and that of its text.

Rows are pages; ids may repeat or be null. A null or empty page has no text evidence, a missing
declaration is a value of its own, a null address has the empty host. Ties go to the first name.
The model has ``FEATURES`` n-grams of ``LANGUAGES`` languages at most. A page's text is read in time
linear in its length.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, stash, whole_text

FIT_ROWS = 20_000
LANGUAGES = 500  # in the model at most: those with most text in the sample
FEATURES = 40_000  # n-grams in the model at most: the most frequent ones
GRAM = 3
TEMPER = 8.0
SMOOTH = 10.0  # pages' worth of the wider prior

# Elements whose content is not shown, and their ends.
SILENT = re.compile(r"<(script|style|noscript)\b", re.I)
ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript")}
OTHER = re.compile(r"[^\w]+|[\d_]+")


def plain(text: str) -> str:
    """Lower-cased letters; all else parts words."""
    return " " + OTHER.sub(" ", text.lower()).strip() + " "


def visible(html: str) -> str:
    """Text without comments, silent elements and tags; each counts as a blank.

    One pass: what has no end further on is not looked for again, so the time is linear in the
    text, also if it is full of signs that open something.
    """
    out, at = [], 0
    missing: set[str] = set()  # ends that do not occur any more

    def end_of(begin: int) -> int:
        """Where what opens at a sign ends; -1 if it never does."""
        if html.startswith("<!--", begin) and "-->" not in missing:
            end = html.find("-->", begin + 4)
            if end >= 0:
                return end + 3
            missing.add("-->")
        silent = SILENT.match(html, begin)
        if silent and (name := silent[1].lower()) in ENDS and name not in missing:
            found = ENDS[name].search(html, silent.end())
            if found:
                return found.end()
            missing.add(name)
        return html.find(">", begin) + 1 or -1

    while (begin := html.find("<", at)) >= 0:
        end = end_of(begin)
        if end < 0:  # no tag ends any more
            break
        out += (html[at:begin], " ")
        at = end
    return unescape("".join(out) + html[at:])


def grams(text: str) -> Counter:
    return Counter(map("".join, zip(*(text[k:] for k in range(GRAM)), strict=False)))


def _gram_counts(batch: pa.RecordBatch):
    counts: dict[str, Counter] = {}
    for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
        counts.setdefault(lang, Counter()).update(grams(plain(text)))
    for lang, counter in counts.items():
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * len(counter), pa.string()),
                "gram": pa.array(list(counter), pa.string()),
                "n": pa.array(list(counter.values()), pa.int64()),
            }
        )


def train(texts: DataFrame) -> tuple[list[str], dict[str, np.ndarray], np.ndarray]:
    """Languages, log-probabilities of n-grams by language, and those of unknown ones."""
    rows = texts.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), whole_text().alias("text")
    ).where("lang is not null")
    n = rows.count()
    if n > FIT_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * FIT_ROWS / n))
    counted = (
        map_arrow(rows.drop("doc_id"), _gram_counts, "lang string, gram string, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    held = stash(counted, "grams")
    by_lang = held.groupBy("lang").agg(F.sum("n").alias("n"))
    sums = {r["lang"]: r["n"] for r in by_lang.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    langs = sorted(sums)
    held = held.where(F.col("lang").isin(langs))
    frequent = held.groupBy("gram").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "gram").limit(FEATURES)
    totals = np.array([sums[lang] for lang in langs], float) + FEATURES
    unknown = -np.log(totals)
    model: dict[str, np.ndarray] = {}
    for r in held.join(frequent, "gram").collect():
        at = langs.index(r["lang"])
        model.setdefault(r["gram"], unknown.copy())[at] = np.log((r["n"] + 1) / totals[at])
    return langs, model, unknown


def _likelihoods(langs: list[str], model: dict[str, np.ndarray]):
    def work(batch: pa.RecordBatch):
        out = []
        for html in batch.column("html").to_pylist():
            total = np.zeros(len(langs))
            for gram, n in grams(plain(visible(html))).items():
                weights = model.get(gram)
                if weights is not None:
                    total += n * weights
            out.append((total / TEMPER).tolist())
        keep = {c: batch.column(c) for c in batch.schema.names if c != "html"}
        yield pa.record_batch(keep | {"text_log": pa.array(out, pa.list_(pa.float64()))})

    return work


def declared(html: Column) -> Column:
    """The primary tag of the root element's ``lang``; empty without one."""
    tag = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return F.lower(tag)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _posterior(log: Column) -> Column:
    """Probabilities from logarithms."""
    top = F.array_max(log)
    odds = F.transform(log, lambda x: F.exp(x - top))
    sums = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda x: x / sums)


def _sums(rows: DataFrame, key: str | None, n: int, name: str) -> DataFrame:
    """Posteriors of the text, summed over a group."""
    total = F.array(*(F.sum(F.col("text_post")[k]) for k in range(n))).alias(name)
    return rows.groupBy(key).agg(total) if key else rows.agg(total)


def _smoothed(own: Column, wider: Column) -> Column:
    """A group's sums with ``SMOOTH`` pages of the wider prior added, as a distribution."""
    size = F.aggregate(own, F.lit(0.0), lambda a, x: a + x) + SMOOTH
    return F.zip_with(own, wider, lambda x, p: (x + F.lit(SMOOTH) * p) / size)


def page_languages(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """``page_id``, ``lang``, ``probability``, ``declared``, ``host``, ``text_lang``."""
    langs, model, _ = train(texts)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        declared(whole_text("html")).alias("declared"),
        host(whole_text("url")).alias("host"),
        whole_text("html").alias("html"),
    ).withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
    if not langs:
        nothing = F.lit(None).cast("string")
        return rows.select(
            "page_id", nothing.alias("lang"), F.lit(0.0).alias("probability"), "declared", "host", nothing.alias("text_lang")
        )
    scored = stash(
        map_arrow(
            rows,
            _likelihoods(langs, model),
            "page_id bigint, declared string, host string, suffix string, text_log array<double>",
        ).withColumn("text_post", _posterior(F.col("text_log"))),
        "pages",
    )
    n = len(langs)
    flat = F.array(*[F.lit(1.0 / n)] * n)
    everywhere = _sums(scored, None, n, "all_sum").select(_smoothed(F.col("all_sum"), flat).alias("all_prior"))
    suffixes = (
        _sums(scored, "suffix", n, "sum")
        .join(F.broadcast(everywhere))  # one row
        .select("suffix", _smoothed(F.col("sum"), F.col("all_prior")).alias("suffix_prior"))
    )
    hosts = (
        _sums(scored.select("host", "suffix", "text_post"), "host", n, "sum")
        .withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
        .join(suffixes, "suffix")
        .select("host", _smoothed(F.col("sum"), F.col("suffix_prior")).alias("prior"))
    )
    # P(declared | language): each language's pages by declaration, with one page added to each.
    by_tag = _sums(scored, "declared", n, "tag_sum")
    all_tags = by_tag.agg(
        F.count("*").alias("tags"), F.array(*(F.sum(F.col("tag_sum")[k]) for k in range(n))).alias("lang_sum")
    )
    tags = by_tag.join(F.broadcast(all_tags)).select(  # one row
        "declared",
        F.zip_with("tag_sum", "lang_sum", lambda x, all_: (x + 1.0) / (all_ + F.col("tags"))).alias("tag_given"),
    )
    log = F.transform(
        F.arrays_zip(F.col("text_log").alias("t"), F.col("prior").alias("p"), F.col("tag_given").alias("d")),
        lambda x: x["t"] + F.log(x["p"]) + F.log(x["d"]),
    )
    names = F.array(*map(F.lit, langs))
    best = F.array_position(F.col("post"), F.array_max("post")).cast("int")
    text_best = F.array_position(F.col("text_post"), F.array_max("text_post")).cast("int")
    return (
        scored.join(hosts, "host")
        .join(tags, "declared")
        .withColumn("post", _posterior(log))
        .select(
            "page_id",
            F.element_at(names, best).alias("lang"),
            F.array_max("post").alias("probability"),
            "declared",
            "host",
            F.element_at(names, text_best).alias("text_lang"),
        )
    )
