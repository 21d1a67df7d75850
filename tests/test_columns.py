"""Layouts, runs and edits in columns, against plain Python; and their queries against SQL."""

import random
import struct
from itertools import groupby

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vellum.functions import runs
from vellum.operators import edits
from vellum.plans import columns
from vellum.plans.catalogue import ORACLES, QUERIES
from vellum.sources.layouts import LINK, Field, Layout, padded


def test_layouts_read_what_struct_writes_and_back(spark):
    layout = Layout(Field("a", "u8"), Field("b", "u16le"), Field("c", "u16be"), Field("d", "u32le"), Field("gap", "pad", 2), Field("e", "i32le"), Field("f", "i64le"), Field("g", "bytes", 3), Field("h", "text", 5))
    rng = random.Random(1)
    rows = [(rng.randrange(256), rng.randrange(65_536), rng.randrange(65_536), rng.randrange(1 << 32), rng.randrange(-(1 << 31), 1 << 31), rng.randrange(-(1 << 63), 1 << 63), rng.randbytes(3), rng.choice(["", "é", "abcde", "a b"])) for _ in range(40)]
    data = [struct.pack("<BH", *r[:2]) + struct.pack(">H", r[2]) + struct.pack("<I2xiq", r[3], *r[4:6]) + r[6] + r[7].encode().ljust(5, b"\0") for r in rows]
    assert {len(x) for x in data} == {layout.size}
    frame = spark.createDataFrame([(i, bytearray(b"xx" + d)) for i, d in enumerate(data)], "i int, data binary")
    told = frame.select("i", "data", *layout.unpack(F.col("data"), 2)).orderBy("i").collect()
    assert [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r[2:]) for r in told] == rows
    again = frame.select("i", "data", *layout.unpack(F.col("data"), 2)).select("i", layout.pack(**{n: F.col(n) for n in "abcdefgh"}).alias("p")).orderBy("i").collect()
    assert [bytes(r.p) for r in again] == data


def test_layouts_at_the_edges(spark):
    frame = spark.createDataFrame([(1, bytearray(b"\x01\x02\x03\x04\x05")), (2, bytearray(b"")), (3, None)], "i int, data binary")
    got = {r.i: (r.volume, r.pointer) for r in frame.select("i", *LINK.unpack(F.col("data"), 3)).collect()}
    assert got == {1: (4, None), 2: (None, None), 3: (None, None)}  # a field that the data end in is null
    assert [tuple(r) for r in LINK.records(frame, "data", F.lit(1), strict=False).collect()] == [(1, 0, 1, 0x0302)]
    assert LINK.records(frame, "data", F.lit(0)).count() == 0
    with pytest.raises(PySparkException, match="beyond the end"):
        LINK.records(frame.where("i = 1"), "data", F.lit(2)).collect()
    assert spark.range(1).select(LINK.pack(volume=F.lit(256), pointer=F.lit(1)).alias("p")).first()["p"] is None  # does not fit
    assert bytes(spark.range(1).select(padded(F.lit(bytearray(b"abc")), 4).alias("p")).first()["p"]) == b"abc\0"
    with pytest.raises(ValueError, match="no field"):
        Layout(Field("x", "u7"))


def test_runs_and_back(spark):
    rng = random.Random(2)
    data = [b"", b"a", b"\0" * 700, "é😀éé".encode(), bytes(range(256)), *[bytes(rng.choices(b"aab", k=rng.randrange(90))) for _ in range(30)], b"x" * 50_000 + b"y" * 50_000]
    frame = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(data)], "i int, d binary").select("*", runs.run_lengths(F.col("d")).alias("r"), runs.packed_runs(F.col("d")).alias("p"))
    rows = frame.select("i", "r", "p", runs.from_runs(F.col("r")).alias("back"), runs.unpacked_runs(F.col("p")).alias("unpacked")).orderBy("i").collect()
    for d, r in zip(data, rows, strict=True):
        plain = [(bytes([k]), len(list(g))) for k, g in groupby(d)]
        assert [(bytes(x.value), x.n) for x in r.r] == plain and bytes(r.back) == d == bytes(r.unpacked)
        assert len(r.p) == 2 * sum(-(-n // 255) for _, n in plain)
    assert spark.createDataFrame([(None,)], "d binary").select(runs.run_lengths(F.col("d")), runs.packed_runs(F.col("d"))).first()[:] == (None, None)


def plain_edits(text, some):
    """(errors, text) of all edits or none."""
    errors, reach = [], -1
    for s, e, _, expected in sorted(some, key=lambda x: x[:3]):
        bad = "out of range" if not 0 <= s <= e <= len(text) else "changed" if expected is not None and text[s:e] != expected else None
        if bad is None:
            bad = "overlap" if reach > s else None
            reach = max(reach, e)
        errors.append(bad)
    if any(errors):
        return errors, text
    for s, e, new, _ in sorted(some, key=lambda x: x[:3], reverse=True):
        text = text[:s] + new + text[e:]
    return errors, text


def test_edits_against_plain_splicing(spark):
    rng = random.Random(3)
    texts = {i: "".join(rng.choices("abcé😀\n", k=rng.randrange(0, 40))) for i in range(60)} | {60: "x" * 60_000}
    some = {}
    for i, t in texts.items():
        some[i] = []
        for k in range(rng.randrange(0, 5)):
            s = rng.randrange(0, len(t) + 2)
            e = s + rng.choice([0, 1, 1, 2, 3])
            some[i].append((s, e, f"<{k}>", rng.choice([None, None, t[s:e]])))
    some[60] = [(k * 50, k * 50 + 7, f"[{k}]", None) for k in range(1_000)]
    rows = [(i, s, e, new, x) for i, own in some.items() for s, e, new, x in own] + [(999, 0, 0, "x", None)]
    docs = spark.createDataFrame(list(texts.items()), "id int, text string")
    told = edits.checked(spark.createDataFrame(rows, "id int, start int, end int, new string, expected string"), docs, "id")
    assert [r.error for r in told.where("id = 999").collect()] == ["no text"]
    made = {r.id: (r.text, r.n_edits) for r in edits.applied(docs, told, "id").collect()}
    for i, t in texts.items():
        errors, text = plain_edits(t, some[i])
        assert made[i] == (text, 0 if any(errors) else len(errors))
        assert sorted(map(str, errors)) == sorted(str(r.error) for r in told.where(F.col("id") == i).collect())
    part = edits.applied(docs, told, "id", all_or_none=False).where("n_edits > 0").count()
    assert part >= sum(n > 0 for _, n in made.values())


def test_queries_of_columns_have_no_python(spark, sf_dir):
    for name in ("layout_records", "link_table", "document_runs", "edit_documents"):
        assert name in QUERIES and name in ORACLES
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and columns
