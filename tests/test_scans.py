"""Prefix scans, held fields, sweeps and reachability against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vellum.operators import reach, scans, spans
from vellum.written import removed, written


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_prefix_scan_over_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(-5, 9), rng.choice([None, None, f"v{i}"])) for i in range(300)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, at int, x int, v string")
    told = scans.prefix_scan(frame, ["k"], ["at"], {"s": ("sum", F.col("x")), "m": ("max", F.col("x")), "l": ("last", F.col("v"))}, ranges)
    got = {r.at: (r.s, r.m, r.l) for r in told.collect()}
    assert told.columns == ["k", "at", "x", "v", "s", "m", "l"] and len(got) == 300
    state = defaultdict(lambda: (0, None, None))
    for k, at, x, v in sorted(rows, key=lambda r: r[1]):
        s, m, last = state[k]
        state[k] = (s + x, x if m is None else max(m, x), v or last)
        assert got[at] == state[k]


def test_few_keys_use_all_tasks(spark):
    """Three keys, one with a third of the rows and more: every range has its own rows to scan."""
    rows = spark.range(30_000).select((F.col("id") % 3).alias("k"), "id")
    parts = scans.dealt(rows, ["k"], ["id"], 12).groupBy("__range").count().collect()
    assert len(parts) == 12 and max(r["count"] for r in parts) < 3 * 30_000 / 12
    assert spans.running_offsets(rows, F.lit(2), ["k"], ["id"]).agg(F.max("sector")).first()[0] == 20_000
    ids = spans.numbered_ids(rows, ["k"], ["id"], F.lit("p"))
    assert ids.agg(F.min("id"), F.max("id"), F.count_distinct("k", "id")).first()[:] == ("p:000001", "p:010000", 30_000)


def plain_held(rows, leads, fields):
    out, held = [], defaultdict(dict)
    for key, at, field, value, closer in sorted(rows, key=lambda r: r[1]):
        if field is not None:
            held[key][field] = (value, at)
        if closer is not None and leads[closer] in held[key]:
            out.append((key, at, closer, tuple(held[key].get(k) for k in range(fields))))
            held[key] = {}
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 5, 30])
def test_held_fields(spark, ranges):
    rng = random.Random(ranges)
    rows = []
    for at in range(400):
        field, closer = rng.choice([None, 0, 1, 2, 3]), rng.choice([None, None, None, 0, 1])
        rows.append((rng.choice(["x", "x", "y", None]), at, field, f"v{at}" if at % 11 else None, closer))
    frame = spark.createDataFrame(rows, "k string, at bigint, f int, v string, c int")
    taken = scans.held_fields(frame, ["k"], "at", field=F.col("f"), value=F.col("v"), closer=F.col("c"), leads=[0, 3], fields=4, ranges=ranges)
    got = [(r.k, r["at"], r.closer, tuple(None if x is None else (x["value"], x["at"]) for x in r.taken)) for r in taken.collect()]
    assert sorted(got, key=repr) == plain_held(rows, [0, 3], 4)
    assert scans.held_fields(frame.limit(0), ["k"], "at", field=F.col("f"), value=F.col("v"), closer=F.col("c"), leads=[0, 3], fields=4).count() == 0


def test_sweeps_against_all_pairs(spark):
    rng = random.Random(2)
    make = lambda n, wide: [(rng.choice(["f", "g", None]), i, s := rng.randrange(200), s + rng.randrange(wide)) for i in range(n)]
    some, marks = make(300, 9), make(60, 20)
    schema = "file string, id int, start int, end int"
    a, b = spark.createDataFrame(some, schema), spark.createDataFrame(marks, schema)
    inside = {i for k, i, s, e in some if any(k == m[0] and s >= m[2] and e <= m[3] for m in marks)}
    met = {i for k, i, s, e in some if any(k == m[0] and s < m[3] and e > m[2] for m in marks)}
    ids = lambda frame: sorted(r.id for r in frame.collect())
    assert ids(spans.contained(a, b, ["file"])) == sorted(inside) and inside
    assert ids(spans.exclude_contained(a, b, ["file"])) == sorted({x[1] for x in some} - inside)
    assert ids(spans.exclude_overlapping(a, b, ["file"])) == sorted({x[1] for x in some} - met)
    assert ids(spans.exclude_overlapping(a.unionByName(a), b, ["file"])) == sorted([*{x[1] for x in some} - met] * 2)


def test_a_hot_key_of_spans_makes_no_pairs(spark):
    """100,000 spans of one file within an outer span each: one sorted scan, no join of spans with spans."""
    rows = spark.range(100_000).select(F.lit("f").alias("file"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 5).alias("end"))
    outer = rows.select("file", (F.col("start") - 1).alias("start"), (F.col("end") + 1).alias("end")).where("start % 20 <> 9")
    found = spans.exclude_contained(rows, outer, ["file"])
    assert found.count() == 50_000
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_reachability(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(25)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(80)] + [(5, 5), (None, 3), (25, None), (3, 4)]
    got = reach.reachable(spark.createDataFrame([(0,), (110,), (110,), (None,), (999,)], "node int"), spark.createDataFrame(edges, "source int, target int"))
    want, front, n = {0: 0, 110: 0, 999: 0}, {0, 110, 999}, 0
    while front:
        n += 1
        front = {t for s, t in edges if s in front and t is not None} - set(want)
        want |= dict.fromkeys(front, n)
    assert {r.node: r.round for r in got.collect()} == want and got.count() == len(want)
    assert reach.reachable(spark.createDataFrame([], "node int"), spark.createDataFrame(edges, "source int, target int")).count() == 0


def test_written_frames_go(spark):
    import os

    frame = written(spark.range(3), "gone")
    path = frame._vellum_path.removeprefix("file://")
    assert os.path.isdir(path) and frame.count() == 3
    removed(frame)
    assert not os.path.exists(path)


def test_all_hits_of_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["ab", "\n", "x", "é😀", "a", "b"], k=rng.randrange(0, 40))) for _ in range(60)] + ["", None, "ab" * 20_000, "ab\nab", "a.b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted(tuple(r) for r in spans.all_hits(frame, ["id"], "text", "ab").collect())
    want = []
    for i, t in enumerate(texts):
        at = (t or "").find("ab")
        while at >= 0:
            want.append((i, t.count("\n", 0, at) + 1, at - (t.rfind("\n", 0, at) + 1) + 1, at + 1))
            at = t.find("ab", at + 2)
    assert got == sorted(want)
    assert [r.id for r in spans.all_hits(frame, ["id"], "text", "a.b").collect()] == [len(texts) - 1]  # plain, no pattern


def test_last_of_place(spark):
    frame = spark.createDataFrame([("a", 1, 5, None), ("a", 1, 7, "y"), ("a", 2, 1, "z"), ("b", 1, 0, "w"), (None, 1, 3, "n"), (None, 1, 4, None)], "k string, place int, at int, v string")
    got = spans.last_of_place(frame, ["k"], ["place"], ["at"])
    assert got.columns == frame.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 1, 7, "y"), ("a", 2, 1, "z"), ("b", 1, 0, "w"), (None, 1, 4, None)], key=repr)


@pytest.mark.parametrize("most", [100_000, 2])
def test_rules_as_rows(spark, monkeypatch, most):
    from vellum.operators import rules

    monkeypatch.setattr(rules, "MAX_BROADCAST", most)
    table = [(5, "a", "x", "five"), (1, "b", "7", "one"), (1, "a", "x", "first of a rank"), (2, "a", "y", "two"), (9, "b", "8", None)]
    rows = [(1, "x", 7), (2, "x", 0), (3, "y", 7), (4, "y", 1), (5, "z", 1), (6, None, None), (7, "z", 8)]
    frame, kept = spark.createDataFrame(rows, "id int, a string, b int"), spark.createDataFrame(table, "rank int, field string, value string, result string")
    got = {r.id: r.route for r in rules.routed(frame, kept, ["id"], ["a", "b"], default="none").collect()}
    assert got == {1: "first of a rank", 2: "first of a rank", 3: "one", 4: "two", 5: "none", 6: "none", 7: "none"}
    every = kept.unionByName(spark.createDataFrame([(99, None, None, "rest")], kept.schema))
    assert {r.id: r.route for r in rules.routed(frame, every, ["id"], ["a", "b"]).where("id > 4").collect()} == {5: "rest", 6: "rest", 7: None}
