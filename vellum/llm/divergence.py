r"""Source divergence audit by joint count histograms.

A language keeps the terms of LEAST of its documents. For a pair of its sources what matters of a term is its count in
either, so kept terms are tallied into cells: (count here, count there) and how many terms have just these. Terms
that both sources have are tallied in their tasks, dealt by their total, so that equal cells meet early; cells where
one count is zero are implied: a source's own histogram less what was tallied with the other, and the rest of the kept
terms at (0, 0). The divergence is evaluated once for each cell and multiplied by its terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import columns_of, discard, materialize, table, with_number

LEAST, TOP = 10, 10
#: Terms of a task before they are sent on, counts that are tallied at a time, and tallied pairs that are summed at a time.
_FLUSH, _CHUNK, _PENDING = 300_000, 1 << 18, 1 << 21
#: Keys that a language's pairs of sources are dealt to.
BLOCKS = 32
#: What is no letter becomes a blank; bytes from 0x80 on stay as they are.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, A-Z in lower case, and of code points from U+0080 on."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs), combined within each task; a term may have several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in held.items():
                found = [w.decode("utf-8", "replace") for w in n]
                columns = pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(found, pa.string())
                counts = pa.array(list(n.values()), pa.int64()), pa.array(list(map(in_docs.__getitem__, n)), pa.int64())
                yield pa.RecordBatch.from_arrays([*columns, *counts], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for rb in batches:
            for lang, source, text in zip(*[rb.column(i).to_pylist() for i in range(3)], strict=True):
                n, in_docs = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
                found, before = terms(text), len(n)
                n.update(found)
                in_docs.update(set(found))
                size += len(n) - before
                if size >= _FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select(*columns_of(docs, [lang_col, source_col, text_col])).mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def kept_terms(counts: DataFrame, groups: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, total, held): held has the groups that have the term, with their counts, by group. counts:
    term_counts(); groups: (lang, source, g), g a number."""
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    numbered = counts.join(groups, ["lang", "source"]).select("lang", "term", "g", "n", "docs")
    by_term = numbered.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("g", "n")).alias("held"))
    return by_term.where(F.col("docs") >= least).select("lang", "term", "total", F.array_sort("held").alias("held"))


class _Tally:
    """Cells of the pairs of groups in some terms."""

    def __init__(self):
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def batches(self, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(rows)["held"].combine_chunks()
        at = np.repeat(np.arange(len(held)), np.asarray(held.value_lengths()))
        flat = held.flatten()
        group = np.asarray(flat.field("g"))
        values, count = np.unique(np.asarray(flat.field("n")), return_inverse=True)
        values = np.concatenate([[0], values])  # code 0 stands for the count 0
        count = count + 1
        base = len(values)

        def summed() -> pa.RecordBatch:
            pair, cell = (np.concatenate([p[i] for p in self.pending]) for i in (0, 1))
            self.pending, self.size = [], 0
            pair, cell, n = _runs(pair, cell, np.ones(len(pair), np.int64))
            # What both have is no longer in the margins: (x, 0) and (0, y) lose it, (0, 0), which lost it twice, regains it.
            margins = [(pair, cell // base * base, -n), (pair, cell % base, -n), (pair, np.zeros_like(cell), n)]
            pair, cell, n = (np.concatenate(x) for x in zip((pair, cell, n), *[_runs(*m) for m in margins], strict=True))
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(values[cell // base]), pa.array(values[cell % base]), pa.array(n)], names=["pair", "x", "y", "m"])

        for d in range(1, int(np.asarray(held.value_lengths()).max(initial=0))):
            i = np.flatnonzero(at[d:] == at[:-d])
            self.pending.append((group[i] << 32 | group[i + d], count[i] * base + count[i + d]))
            self.size += len(i)
            if self.size >= _PENDING:
                yield summed()
        if self.size:
            yield summed()


def _runs(pair: np.ndarray, cell: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n added up for equal pairs and cells."""
    order = np.lexsort((cell, pair))
    pair, cell = pair[order], cell[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (cell[1:] != cell[:-1])]))
    return pair[first], cell[first], np.add.reduceat(n[order], first)


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for rb in batches:
        rows.append(rb)
        size += len(rb.column(0).flatten())
        if size >= _CHUNK:
            yield from _Tally().batches(rows)
            rows, size = [], 0
    if size:
        yield from _Tally().batches(rows)


def joint_histograms(kept: DataFrame, pairs: DataFrame, histograms: DataFrame) -> DataFrame:
    """(pair, x, y, m): how many kept terms have counts x and y in the groups of each pair, zeros too.
    pairs: (pair, a, b, v, kinds_a, kinds_b), a and b numbers of groups; histograms: (g, n, m)."""
    dealt = kept.repartitionByRange("lang", "total", "term").select("held")
    both = dealt.mapInArrow(_tallied, "pair bigint, x bigint, y bigint, m bigint")
    zero = F.lit(0).cast("bigint")
    own = lambda side: histograms.select(F.col("g").alias(side), "n", "m")
    here = pairs.select("pair", "a").join(own("a"), "a").select("pair", F.col("n").alias("x"), zero.alias("y"), "m")
    there = pairs.select("pair", "b").join(own("b"), "b").select("pair", zero.alias("x"), F.col("n").alias("y"), "m")
    none = pairs.select("pair", zero.alias("x"), zero.alias("y"), (F.col("v") - F.col("kinds_a") - F.col("kinds_b")).alias("m"))
    cells = both.unionByName(here).unionByName(there).unionByName(none)
    return cells.groupBy("pair", "x", "y").agg(F.sum("m").alias("m")).where(F.col("m") > 0)


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 * (count + 2) / (total + 2 * kept)), exactly."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({count} + 2 as decimal(18,0))) div cast({total} + 2 * {kept} as decimal(20,0))")


def divergence(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)), of shares: below 2^63."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", *, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank). Part `pair`: every other source of the language, with the divergence
    of the two summed over all kept terms; part `term`: the group's first `top` kept terms whose share there is above
    the language's, with their divergence. Ranks go by value, descending, then by item.

    Nulls in the three columns are ''. A language without kept terms has pairs of value 0; one with a single source has
    none. Every row is a document, repeated rows too. An empty table gives no rows. As many rows come out as there are
    pairs of sources, which is what the pairs part is; nothing else grows with their square but their cells.
    """
    names = docs.select(*[F.coalesce(c, F.lit("")).alias(n) for c, n in zip(columns_of(docs, [lang_col, source_col]), ("lang", "source"), strict=True)]).distinct()
    names = with_number(names, "g")  # two numbers are a pair's, so groups are below 2^31
    kept = materialize(kept_terms(term_counts(docs, lang_col, source_col, text_col), names, least), "terms")
    histograms = materialize(kept.select(F.explode("held").alias("h")).groupBy(F.col("h.g").alias("g"), F.col("h.n").alias("n")).agg(F.count("*").alias("m")), "histograms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
    own = histograms.groupBy("g").agg(F.sum(F.col("n") * F.col("m")).alias("total"), F.sum("m").alias("kinds"))
    groups = names.join(own, "g", "left").join(langs, "lang", "left").na.fill(0, ["total", "kinds", "v", "lang_total"])
    groups = materialize(groups, "groups")
    # Pairs of a language's groups, dealt by the second one.
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("source", "total", "kinds")] + [F.col("g").alias(x)]
    second = groups.select("lang", *side("b"), F.pmod("g", F.lit(BLOCKS)).cast("int").alias("block"))
    first = groups.select("lang", *side("a"), "v", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    pairs = first.join(second, ["lang", "block"]).where(F.col("a") < F.col("b")).drop("block")
    pairs = materialize(pairs.withColumn("pair", F.call_function("shiftleft", F.col("a"), F.lit(32)).bitwiseOR(F.col("b"))), "pairs")
    cells = joint_histograms(kept, pairs, histograms)
    told = cells.join(pairs.where("v > 0").select("pair", "v", "total_a", "total_b"), "pair")
    told = told.withColumn("p", share("x", "total_a", "v")).withColumn("q", share("y", "total_b", "v"))
    sums = told.groupBy("pair").agg(F.sum(divergence("p", "q") * F.col("m")).alias("value"))
    valued = materialize(pairs.select("pair", "lang", "source_a", "source_b").join(sums, "pair", "left").na.fill(0, ["value"]), "values")
    part = lambda rows, source, item, name: rows.select("lang", F.col(source).alias("source"), F.lit(name).alias("part"), F.col(item).alias("item"), "value")
    mirrored = part(valued, "source_a", "source_b", "pair").unionByName(part(valued, "source_b", "source_a", "pair"))
    flat = kept.select("term", F.col("total").alias("in_lang"), F.explode("held").alias("h")).select("term", "in_lang", "h.g", "h.n")
    rows = flat.join(groups, "g").withColumn("p", share("n", "total", "v")).withColumn("q", share("in_lang", "lang_total", "v")).where("p > q")
    rows = part(rows.withColumn("value", divergence("p", "q")), "source", "term", "term")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = mirrored.withColumn("rank", place).unionByName(rows.withColumn("rank", place).where(F.col("rank") <= top))
    discard(histograms)
    return ranked


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls are ''; repeated rows are documents of their own."""
    return audit(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), word AS (
  SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST}
), per_lang AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS c FROM word JOIN kept USING (lang, term) GROUP BY ALL
), grp AS (
  SELECT g.lang, g.source, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counted GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source
), cell AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c, 0) + 2) // (grp.n + 2 * v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (kept.total + 2) // (per_lang.n + 2 * v)::HUGEINT AS q
  FROM grp JOIN kept ON kept.lang = grp.lang JOIN per_lang ON per_lang.lang = grp.lang
  LEFT JOIN counted ON counted.lang = grp.lang AND counted.source = grp.source AND counted.term = kept.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM cell WHERE c > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= {TOP}
"""
