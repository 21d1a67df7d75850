"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vellum.llm import collocations as op


def plain(rows, least, most, top):
    """(lang, rank, phrase, a, l, r, n, score), from every phrase of every piece."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, most + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in frequent.items():
            if len(p) < 2 or any(len(q) > len(p) and b == a and inside(p, q) for q, b in frequent.items()):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a", "é", "x'y", "\xa0", "０"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "! ", "\x0b", "…"]
    fixed = ["new york city", "new york city hall opened", "a a a a", "of the"]
    made = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(0, 30))]
        made.append("".join(p + rng.choice(marks) for p in parts))
    return [(rng.choice(["en", "fr", None, "und"]), t) for t in made] + [("en", None), (None, ""), ("de", "one"), *[("en", made[0])] * 3]


def test_automaton_counts_all_substrings():
    rng = random.Random(5)
    sequences = [(tuple(rng.choices("abc", k=rng.randrange(0, 9))), rng.randrange(1, 4)) for _ in range(60)]
    automaton = op.SuffixAutomaton()
    expected = Counter()
    for s, weight in sequences:
        automaton.add(s, weight)
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                expected[s[i:j]] += weight
    found = list(automaton.substrings(1, 99))
    assert len(found) == len(dict(found))
    assert dict(found) == expected
    assert dict(automaton.substrings(2, 3)) == {k: v for k, v in expected.items() if 2 <= len(k) <= 3}


@pytest.mark.parametrize(("least", "top", "shard_words"), [(5, 2_000, 150), (3, 4, 1 << 20)])
def test_collocations_are_those_of_a_plain_count(spark, least, top, shard_words):
    rows = texts(least)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string").repartition(3)
    docs = docs.withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x")).withColumn("rank", F.lit(None))
    found = op.collocations(docs, least=least, top=top, shard_words=shard_words)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows_found = sorted(tuple(r) for r in found.collect())
    assert rows_found == plain(rows, least, 5, top)
    assert len(rows_found) > 4


def test_a_phrase_inside_one_of_the_same_count_goes(spark):
    docs = spark.createDataFrame([("en", "new york city. york city. york"), ("en", "new york city")], "lang string, text string")
    found = {r["phrase"]: r["a"] for r in op.collocations(docs, least=2).collect()}
    assert found == {"new york city": 2, "york city": 3}


def test_exact_beyond_64_bits(spark):
    """1000 * a * n of 10^15 words each passes 64 bits by far."""
    big = 10**14
    score = spark.createDataFrame([(big, 9 * big, 3, big)], "a bigint, n bigint, l bigint, r bigint").select(F.expr(op.SCORE)).first()[0]
    assert score == 1000 * big * 9 * big // (3 * big)


def test_one_very_long_text(spark):
    docs = spark.createDataFrame([("en", "a b c d " * 40_000)], "lang string, text string")
    found = op.collocations(docs, least=100).collect()
    assert {r["phrase"]: r["a"] for r in found} == {"a b c d a": 39_999, "b c d a b": 39_999, "c d a b c": 39_999, "d a b c d": 39_999, "a b c d": 40_000}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert op.collocations(docs).collect() == []


def test_words_cross_as_compressed_rows(spark, monkeypatch):
    """Words of shards come to their groups and back as one row for each shard and group, never as one for each word."""
    rows, plans, write = texts(7), {}, op.materialize

    def written(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
        return write(df, label)

    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string").repartition(2)
    cut = op.materialize(op.shards(docs, shard_words=100), "shards")
    assert cut.count() > 8
    monkeypatch.setattr(op, "materialize", written)
    found = {(r["lang"], r["phrase"]): r["a"] for r in op.phrase_counts(cut, least=3).where("instr(phrase, ' ') = 0").collect()}
    expected = Counter()
    for r in cut.collect():
        expected.update({(r["lang"], w): n for w, n in zip(r["words"], r["counts"], strict=True)})
    assert found == {k: n for k, n in expected.items() if n >= 3}
    assert plans and not [label for label, plan in plans.items() if "Generate" in plan]
