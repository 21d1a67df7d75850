"""HyperMinHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import hyperminhash as op
from vellum.llm.common import spread_join


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()


def plain(rows, percent=85):
    """(id, n, component, kept) as a sorted list."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    out = [(own, len(sets[i]), least.get(find(i)) if sets[i] else own) for i, (own, _) in enumerate(rows)]
    return sorted([(*r, r[0] == r[2]) for r in out], key=repr)


def group(rng, size, words, change):
    """Near copies of one text: each has its own words at some places."""
    base = [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(words)]
    out = []
    for _ in range(size):
        own = list(base)
        for _ in range(rng.randrange(change + 1)):
            own[rng.randrange(words)] = str(rng.random())
        out.append(" ".join(own))
    return out


def texts(seed, sizes=((12, 60, 3), (10, 25, 2), (15, 200, 16), (6, 8, 1))):
    rng = random.Random(seed)
    made = [t for s in sizes for t in group(rng, *s)]
    made += ["", None, " \n", "one", "ONE", "one two", "One\ttwo", "one two three", "é É", "Ab  CD\x0bef gh", "ab cd ef GH", "ſ K", "x " * 5_000, "x x x"]
    made += [made[0]] * 4 + [" ".join(str(rng.random()) for _ in range(40)) for _ in range(10)]
    rng.shuffle(made)
    rows = [(rng.randrange(10_000), t) for t in made]
    rows[3] = rows[4] = (None, rows[3][1])
    rows[6] = rows[7]
    return rows


def found(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumn("n", F.lit("x")).withColumn("uid", F.lit(1)).withColumn("key", F.lit(None))
    out = op.near_duplicates(docs, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted([tuple(r) for r in out.collect()], key=repr)


@pytest.mark.parametrize("how", [{}, {"turns": 1}, {"turns": 0, "percent": 85}, {"percent": 60}, {"percent": 60, "turns": 0}])
def test_components_are_those_of_all_pairs(spark, how):
    """Without turns all is left to the rarest shingles."""
    rows = texts(len(how) + how.get("turns", 2))
    assert found(spark, rows, **how) == plain(rows, how.get("percent", 85))


def asked_of(spark, rows, **how):
    """How many pairs are compared, and the rows found."""
    asked, plain_links = [], op._Links._linked

    def counted(self, pairs, sets):
        asked.append(pairs.count())
        return plain_links(self, pairs, sets)

    op._Links._linked = counted
    try:
        return found(spark, rows, **how), sum(asked)
    finally:
        op._Links._linked = plain_links


def test_texts_of_one_passage_are_not_compared(spark):
    """400 texts of one passage and own words share many keys and no link; so do much changed copies."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(str(rng.random()) for _ in range(60))) for i in range(400)]
    rows += list(enumerate(group(rng, 150, 100, 30), 1_000))
    got, asked = asked_of(spark, rows)
    assert got == plain(rows) and asked < 2_000


def test_keys_of_unlinked_sets_with_common_shingles(spark):
    """300 texts of the same lines, 40 of 60 each: nothing is one text's own."""
    rng = random.Random(9)
    lines = [" ".join(f"w{i}x{k}" for k in range(6)) for i in range(60)]
    rows = [(i, " ".join(lines[k] for k in sorted(rng.sample(range(60), 40)))) for i in range(300)]
    got, asked = asked_of(spark, rows)
    assert got == plain(rows) and asked < 300 * 299 / 2


def test_near_copies_that_share_changes_are_not_all_compared(spark):
    """300 texts near a base and 200 further off, which link with nothing, though dozens have the same change."""
    rng = random.Random(10)
    base, places = [f"b{i}" for i in range(150)], range(5, 150, 9)
    rows = []
    for i in range(500):
        own = list(base)
        for at in rng.sample(places, rng.randrange(1, 3) if i < 300 else rng.randrange(5, 7)):
            own[at] = f"v{rng.randrange(3)}" if i % 3 else str(rng.random())
        rows.append((i, " ".join(own)))
    got, asked = asked_of(spark, rows)
    assert got == plain(rows) and asked < 12_000


def test_registers_hold_zeros_and_the_bits_behind():
    hashes = np.unique(np.array([0x01FF << 48, (0x01 << 56) | (1 << 55) | (1 << 54), 0x02 << 56, (0xFF << 56) | (1 << 8)], np.uint64))
    own = op.registers(hashes)
    assert own[1] == 0 << 10 | 512 and own[2] == 48 << 10 and own[255] == 47 << 10
    assert (np.delete(own, [1, 2, 255]) == op.EMPTY).all() and len(op.band_keys(own)) == op.BANDS


def test_estimates_are_unbiased_and_keys_meet():
    rng = np.random.default_rng(1)
    share, off = 0, []
    for n in (7, 60, 400, 5_000):
        for _ in range(40):
            union = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            one = max(1, round(n * 0.07))
            a, b = np.unique(union[one:]), np.unique(union[:-one])
            x, y = op.registers(a), op.registers(b)
            estimate, either = op.jaccard(x[None], y[None], np.array([len(a)]), np.array([len(b)]))
            off.append(estimate[0] - (n - 2 * one) / n)
            share += bool(np.isin(op.band_keys(x), op.band_keys(y)).any())
            if (n - 2 * one) / n >= 0.85:
                assert op.may_link(estimate, either)[0]
    assert abs(np.mean(off)) < 0.02 and share >= 158


def test_expected_collisions():
    """Registers of sets without a common element are equal as often as said."""
    rng = np.random.default_rng(2)
    draw = lambda: op.registers(np.unique(rng.integers(0, 1 << 63, 4_096, dtype=np.uint64) * np.uint64(2)))
    equal = np.mean([(draw() == draw()).mean() for _ in range(400)])
    assert op._collisions(96, 96) == pytest.approx(equal, rel=0.5) and op._collisions(96, 96) < 1e-3


def test_spread_join_deals_hot_keys(spark):
    rows = spark.range(3_000).select(F.col("id"), F.when(F.col("id") < 2_500, 7).otherwise(F.col("id")).alias("k"))
    one = spark.range(3_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = spread_join(rows, one, ["k"], "id", salts=4, hot_rows=100)
    assert out.count() == 3_000 and out.where("v <> 2 * k").count() == 0 and out.columns == ["k", "id", "v"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.near_duplicates(docs).collect() == []
