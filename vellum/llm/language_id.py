"""Language identification by Bayesian evidence fusion over web pages.

For each page, the log likelihood of its visible text under character trigrams of each language is added to the log
likelihoods of its declared markup language and of its address suffix, and to a log prior of its host. The two
likelihood tables and the priors come from grouped aggregation of the texts' own posteriors, and each page counts once:
a host's counts are smoothed by its domain's and those by all pages', a suffix's likelihood comes from the pages outside
the page's domain, and the page's own share is taken out of every table first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, discard, materialize, spread_join, table

#: Documents of each language that its profile is fitted on (those whose ids hash lowest), hashed trigrams.
PROFILE_ROWS, BUCKETS = 1_000, 1 << 14
#: Documents of all profiles (a document at least for each language).
PROFILE_TOTAL = 50_000
#: What a language's code looks like; other values of the column are no language, so languages are 18,252 at most.
CODE = "^[a-z]{2,3}$"
#: Pages that make a host hot at least; hot hosts have over one in a thousand pages, so they are a thousand at most.
HOT_PAGES = 1_000
#: Trigrams count as so many independent ones at most: neighbours in a text are not.
EVIDENCE = 60.0
#: Pages that a level's parent counts for.
HOST_WEIGHT, DOMAIN_WEIGHT = 3.0, 5.0
TABLE_WEIGHT = 1.0
_NONE, _OTHER = "", "?"

_OPENS = re.compile(r"<(?:(script|style|noscript|template)\b|!--)", re.I)
_CLOSES = {name: re.compile(rf"</{name}\s*+>", re.I) for name in ("script", "style", "noscript", "template")} | {None: re.compile("-->")}
_ENTITY = re.compile(r"&#?\w{1,10};")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"""\blang\s*+=\s*+(?:["']\s*+)?([A-Za-z]{2,8})""", re.I)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def _without_hidden(html: str) -> str:
    """A blank for each script, style, noscript, template and comment that is closed. One pass: a closer that is not
    ahead of one opener is not ahead of a later one either, so it is looked for no more."""
    kept, at, look, unclosed = [], 0, 0, set()
    while found := _OPENS.search(html, look):
        name = found[1].lower() if found[1] else None
        end = None if name in unclosed else _CLOSES[name].search(html, found.end())
        if end:
            kept.append(html[at : found.start()])
            at = look = end.end()
        else:
            unclosed.add(name)
            look = found.end()
    return " ".join([*kept, html[at:]])


def _without_tags(html: str) -> str:
    kept, at = [], 0
    while (start := html.find("<", at)) >= 0 and (end := html.find(">", start)) >= 0:
        kept.append(html[at:start])
        at = end + 1
    return " ".join([*kept, html[at:]])


def visible_text(html: str | None) -> str:
    """Text without tags, entities and what is not shown; in time linear in the page, whatever is left open in it."""
    return " ".join(_ENTITY.sub(" ", _without_tags(_without_hidden(html or ""))).split())


def declared_language(html: str | None) -> str:
    """The first lang that an html tag gives, in lower case; one pass over the tags, an open one reaching to the end."""
    html, at = html or "", 0
    while tag := _HTML.search(html, at):
        end = html.find(">", tag.end())
        at = len(html) if end < 0 else end
        if found := _LANG.search(html, tag.end(), at):
            return found[1].lower()
    return _NONE


def address(url: str | None) -> tuple[str, str, str]:
    """(host, domain: its last two labels, suffix: its last one), lower case; empty where there is none."""
    found = _HOST.match(url or "")
    host = found[1].lower().strip(".") if found else ""
    labels = host.split(".") if host else []
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 else ""


def trigrams(text: str) -> np.ndarray:
    """Hashed character trigrams of the letters of a text, words apart."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    points = np.where((points < 65) | ((points > 90) & (points < 97)) | ((points > 122) & (points < 170)), np.uint64(32), points)
    if len(points):
        points = points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]
    points = np.concatenate([[np.uint64(32)], points, [np.uint64(32)]])
    if len(points) < 4:
        return np.empty(0, np.int64)
    key = (points[:-2] << np.uint64(42)) ^ (points[1:-1] << np.uint64(21)) ^ points[2:]
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


class Profiles:
    """Log shares of trigrams, by language: what each language has of all trigrams, and, by trigram, what those that
    saw it have more. Only what was seen is held, however many languages there are."""

    def __init__(self, languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.languages = languages
        order = np.lexsort((lang, gram))
        self.starts = np.searchsorted(gram[order], np.arange(BUCKETS + 1))
        self.lang, self.more = lang[order].astype(np.int32), np.log(2.0 * n[order] + 1.0)
        self.unseen = np.log(0.5) - np.log(np.bincount(lang, weights=n, minlength=len(languages)) + 0.5 * BUCKETS)

    def likelihood(self, text: str) -> np.ndarray:
        """Log likelihoods, relative to the greatest; all 0 without trigrams."""
        grams = trigrams(text)
        if not len(grams):
            return np.zeros(len(self.languages))
        kinds, n = np.unique(grams, return_counts=True)
        held = self.starts[kinds + 1] - self.starts[kinds]
        at = np.repeat(self.starts[kinds] - np.cumsum(held) + held, held) + np.arange(held.sum())
        total = np.bincount(self.lang[at], self.more[at] * np.repeat(n, held), len(self.languages)) + self.unseen * len(grams)
        return (total - total.max()) * min(1.0, EVIDENCE / len(grams))


def fit_profiles(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", rows: int = PROFILE_ROWS) -> Profiles:
    """From the `rows` documents of each language whose ids hash lowest, fewer where there are so many languages that
    PROFILE_TOTAL documents would not do: every language that occurs has a profile. Codes count in lower case; documents without an id or with no code are left out."""
    known = docs.select(*[c.alias(n) for c, n in zip(columns_of(docs, [id_col, lang_col, text_col]), ("id", "lang", "text"), strict=True)]).withColumn("lang", F.lower("lang"))
    known = known.where(F.col("id").isNotNull() & F.col("lang").rlike(CODE))
    ids = known.select("id", "lang").distinct().withColumn("h", F.xxhash64("id"))
    rows = max(1, min(rows, PROFILE_TOTAL // max(1, known.select("lang").distinct().count())))
    # 4,096 slots of hashes: only ids of the slots that hold a language's first ones meet in its task.
    slot = F.shiftright("h", 52)
    lower = Window.partitionBy("lang").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = ids.groupBy("lang", slot.alias("slot")).agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    last = counts.where(F.col("before") < rows).groupBy("lang").agg(F.max("slot").alias("last"))  # a row a language: see CODE
    first = Window.partitionBy("lang").orderBy("h", "id")
    few = ids.join(F.broadcast(last), "lang").where(slot <= F.col("last"))
    ids = few.withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows).select("id", "lang")
    chosen = materialize(ids, "chosen")
    texts = known.join(chosen, ["id", "lang"]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for rb in batches:
            for lang, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                grams = np.bincount(trigrams(text or ""), minlength=BUCKETS)
                held[lang] = held.get(lang, 0) + grams
        for lang, grams in held.items():
            at = np.flatnonzero(grams)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(grams[at], pa.int64())], names=["lang", "gram", "n"])

    counted = materialize(texts.mapInArrow(count, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    told = counted.toArrow()  # a row at most for each language and trigram
    languages = sorted(set(told["lang"].to_pylist()))
    place = {x: i for i, x in enumerate(languages)}
    lang = np.array([place[x] for x in told["lang"].to_pylist()], np.int64)
    discard(counted)
    discard(chosen)
    return Profiles(languages, lang, told["gram"].to_numpy(), told["n"].to_numpy())


def evidence(pages: DataFrame, profiles: Profiles, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, host, domain, suffix, declared, logs, own): own is the text's own posterior."""
    frame = pages.select(*columns_of(pages, [id_col, url_col, html_col])).toDF("id", "url", "html")
    schema = T.StructType([frame.schema["id"], *T.StructType.fromDDL("host string, domain string, suffix string, declared string, logs array<double>, own array<double>").fields])
    shared = pages.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(shared.value.languages)
        for rb in batches:
            urls, htmls = rb.column(1).to_pylist(), rb.column(2).to_pylist()
            where = [address(u) for u in urls]
            said = [d if d in known or d == _NONE else _OTHER for d in map(declared_language, htmls)]
            logs = [shared.value.likelihood(visible_text(h)) for h in htmls]
            own = [np.exp(x) / np.exp(x).sum() if len(x) else x for x in logs]
            made = [pa.array([w[i] for w in where], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), *made, pa.array(said, pa.string()), pa.array(logs, pa.list_(pa.float64())), pa.array(own, pa.list_(pa.float64()))], names=schema.names
            )

    return frame.mapInArrow(run, schema)


def _counts(rows: DataFrame, by: str, out: str) -> DataFrame:
    """(by, out): sums of `own` by language, in the order of languages."""
    sums = rows.select(by, F.posexplode("own").alias("place", "s")).groupBy(by, "place").agg(F.sum("s").alias("s"))
    return sums.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "s"))), lambda x: x["s"]).alias(out))


def identify(
    pages: DataFrame, profiles: Profiles, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(id, lang, score, text_lang, declared) for every row: the language of the greatest posterior (ties to the first
    by name), its posterior, the text's own language, and the declared one ('' none, '?' one without a profile).

    Null and empty pages and addresses add no evidence; without any, the prior of all pages decides. Repeated rows
    stay. Without a profile lang is null and score 0.
    """
    n = len(profiles.languages)
    if not n:
        return pages.select(id_col, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("text_lang"), F.lit("").alias("declared"))
    rows = materialize(evidence(pages, profiles, id_col, url_col, html_col), "evidence")
    total = np.zeros(n)
    for r in rows.select(F.posexplode("own").alias("place", "s")).groupBy("place").agg(F.sum("s").alias("s")).collect():  # a row a language
        total[r["place"]] = r["s"]
    named = rows.groupBy("host").agg(F.first("domain").alias("domain"), F.first("suffix").alias("suffix"), F.count("*").alias("pages"))
    hosts = materialize(named.join(_counts(rows, "host", "own"), "host"), "hosts")
    domains, suffixes = _counts(hosts, "domain", "in_domain"), _counts(hosts, "suffix", "in_suffix")
    levels = hosts.join(domains, "domain").join(suffixes, "suffix").select("host", "pages", F.col("own").alias("in_host"), "in_domain", "in_suffix")
    levels = materialize(levels, "levels")
    hot = levels.where(F.col("pages") > max(HOT_PAGES, rows.count() // 1_000))
    rest = rows.join(F.broadcast(hot.select("host")), "host", "left_anti").join(levels, "host")
    every = rest.unionByName(rows.join(F.broadcast(hot), "host"))
    every = spread_join(every, _counts(rows, "declared", "in_declared"), ["declared"], "id")
    joined = every.select("id", "suffix", "declared", "logs", "own", "in_host", "in_domain", "in_suffix", "in_declared")
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("lang string, score double, text_lang string, declared string").fields])
    names = profiles.languages

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = (total + 1.0) / (total.sum() + n)
        for rb in batches:
            if not rb.num_rows:
                continue
            own, host, domain, suffix, same = (rb.column(i).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for i in (4, 5, 6, 7, 8))
            logs = rb.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            without = lambda c: np.maximum(c - own, 0.0)  # noqa: B023, E731
            mix = lambda c, weight, parent: (c + weight * parent) / (c.sum(1, keepdims=True) + weight)
            prior = mix(without(host), HOST_WEIGHT, mix(without(domain), DOMAIN_WEIGHT, share[None, :]))
            # The likelihood of evidence: its share of a language's pages, smoothed by its share of all of them.
            likely = lambda c, of: np.log((c + TABLE_WEIGHT * c.sum(1, keepdims=True) / np.maximum(of.sum(1, keepdims=True), 1.0) + 1e-6) / (of + TABLE_WEIGHT + 1e-6))
            said = rb.column(2).to_pylist()
            tables = likely(without(same), without(np.broadcast_to(total, own.shape)))
            tables[[d == _NONE for d in said]] = 0.0
            ends = likely(np.maximum(suffix - domain, 0.0), np.maximum(total[None, :] - domain, 0.0))
            ends[[s == "" for s in rb.column(1).to_pylist()]] = 0.0
            all_logs = logs + np.log(prior + 1e-9) + ends + tables
            all_logs -= all_logs.max(1, keepdims=True)
            post = np.exp(all_logs)
            post /= post.sum(1, keepdims=True)
            best = post.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array([names[i] for i in best]), pa.array(post[np.arange(len(best)), best]), pa.array([names[i] for i in logs.argmax(1)]), rb.column(2)],
                names=schema.names,
            )

    return joined.mapInArrow(fuse, schema).withColumnRenamed("id", id_col)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null pages and addresses add no evidence; repeated rows stay."""
    profiles = fit_profiles(table(spark, sf_dir, "documents"))
    found = identify(table(spark, sf_dir, "pages"), profiles)
    return found.select("page_id", "lang", F.round("score", 6).alias("score"), "text_lang", "declared")
