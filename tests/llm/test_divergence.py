"""The divergence audit against plain sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellum.llm import divergence as op


def plain(rows, least, top):
    n_docs, in_group, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        in_group[lang, source].update(found)
        n_docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in n_docs[lang].items() if n >= least)
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: in_group[lang, s][t] for t in kept})
        share = lambda counts: {t: 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p, q = {s: share(in_group[lang, s]) for s in sources}, share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if in_group[lang, s][t] and p[s][t] > q[t])[:top]
            for part, items in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    words = ["the", "The", "a", "é", "naïve", "don't", "x1y", "0", "日本", "zz", "\xa0", "Ä", "ä", *[f"w{chr(97 + i)}" for i in range(20)]]
    made = [(rng.choice(["en", "fr", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "s2", None, "ſ"]), " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for _ in range(150)]
    return [*made, ("de", "only", None), ("it", "a", "one two"), ("it", "b", ""), *[made[0]] * 4, ("en", "empty", None)]


@pytest.mark.parametrize(("least", "top"), [(3, 10), (10, 2), (1, 10)])
def test_audit_is_that_of_plain_sums(spark, least, top):
    rows = rows_of(least)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3).withColumn("value", F.lit(1)).withColumn("term", F.lit("x"))
    found = op.audit(docs, least=least, top=top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, least, top)


def test_many_sources_and_flushes(spark, monkeypatch):
    """Each term in all of 60 sources, tallied and sent on in small parts."""
    monkeypatch.setattr(op, "_CHUNK", 200)
    monkeypatch.setattr(op, "_PENDING", 500)
    monkeypatch.setattr(op, "_FLUSH", 7)
    rng = random.Random(3)
    rows = [("en", f"s{i:02d}", " ".join(rng.choices(["aa", "bb", "cc", "dd"], k=12))) for i in range(60)] + [("en", "s00", "aa " * 5_000)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(2)
    assert sorted(tuple(r) for r in op.audit(docs, least=2).collect()) == plain(rows, 2, 10)


def test_tally_counts_each_cell_once():
    held = [[(0, 1), (1, 2)], [(0, 1), (1, 2)], [(0, 3)], [(0, 1), (1, 5), (2, 1)]]
    kind = pa.list_(pa.struct([("g", pa.int64()), ("n", pa.int64())]))
    rb = pa.RecordBatch.from_arrays([pa.array([[{"g": g, "n": n} for g, n in h] for h in held], kind)], names=["held"])
    cells = defaultdict(int)
    for out in op._tallied([rb]):
        for r in out.to_pylist():
            cells[r["pair"] >> 32, r["pair"] & 0xFFFFFFFF, r["x"], r["y"]] += r["m"]
    assert {k: v for k, v in cells.items() if k[:2] == (0, 1)} == {(0, 1, 1, 2): 2, (0, 1, 1, 5): 1, (0, 1, 1, 0): -3, (0, 1, 0, 2): -2, (0, 1, 0, 5): -1, (0, 1, 0, 0): 3}
    assert np.all([v for k, v in cells.items() if k[1] == 2])


def test_shares_are_exact_for_large_counts(spark):
    count, total, kept = 3 * 10**13, 10**14, 10**9
    frame = spark.createDataFrame([(count, total, kept)], "c bigint, t bigint, v bigint").select(op.share("c", "t", "v").alias("p"), F.lit(7).cast("bigint").alias("q"))
    p = frame.first()["p"]
    assert p == 1 + 10**9 * (count + 2) // (total + 2 * kept)
    assert frame.select(op.divergence("p", "q")).first()[0] == (p - 7) ** 2 // (p + 7)


def test_nothing_kept_and_empty_table(spark):
    schema = "lang string, source string, text string"
    found = op.audit(spark.createDataFrame([("en", "a", "x"), ("en", "b", "y")], schema)).collect()
    assert sorted(map(tuple, found)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert op.audit(spark.createDataFrame([], schema)).collect() == []
