"""Every relational query against its SQL, and the operators' edge cases."""

import glob
import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vellum.functions import arith, text
from vellum.operators import spans, tables
from vellum.plans import catalogue, columns, formats  # noqa: F401


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        where = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{where}'")
    return c


def plain(value):
    if value is None or value is pd.NA or value != value:
        return None
    if isinstance(value, float):
        return int(value) if value.is_integer() else round(value, 9)
    return int(value) if hasattr(value, "dtype") and value.dtype.kind in "iu" else value


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(map(plain, r))) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    ours = catalogue.QUERIES[name](spark, sf_dir).toPandas()
    theirs = duck.sql(catalogue.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and rows(ours) == rows(theirs)


def test_entry_and_names(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_have_no_nested_loop(spark, sf_dir):
    for name in ("interval_exclusion", "span_overlap_exclusion", "asof_value", "nearest_label"):
        plan = catalogue.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_number_forms(spark):
    got = {r.n: (r.a, r.b) for r in spark.range(65_536).select(F.col("id").alias("n"), F.hex(arith.encode_number(F.col("id"))).alias("a"), F.hex(arith.encode_variable(F.col("id"))).alias("b")).collect()}
    assert got[0][0] == "40" and got[0x33][0] == "73" and got[0x34][0] == "0034" and got[0x3FFF][0] == "3FFF" and got[65_535][0] == "3FFF" * 4 + "4379797979"
    assert got[2][1] == "82" and got[0x40][1] == "C040" and got[0x100][1] == "C100" and got[0x4000][1] is None


def test_filetime_round_trip(spark):
    row = spark.sql("select timestamp'1996-12-19 00:00:01' t").select(arith.to_filetime(F.col("t")).alias("f"), "t")
    assert row.select(F.col("t") == arith.from_filetime(F.col("f"))).first()[0]


def test_paths():
    for path, head, base in (("", ".", "."), ("/", "/", "/"), ("a", ".", "a"), ("a/", ".", "a"), ("/a", "/", "a"), ("a/b", "a", "b"), ("a//b/", "a", "b")):
        assert (text.posix_dirname(path), text.posix_basename(path)) == (head, base)
    assert text.replace_suffix("d/a.b.c", "png") == "a.b.png" and text.replace_suffix("a", "x") == "a.x"


def test_spans_of_nothing_and_containment(spark):
    s = spark.createDataFrame([("f", 0, 3), ("f", 5, 9), ("g", 5, 9)], "file string, start int, end int")
    outer = spark.createDataFrame([("f", 5, 10)], "file string, start int, end int")
    assert spans.exclude_contained(s, outer, ["file"]).count() == 2 and spans.exclude_overlapping(s, outer, ["file"]).count() == 2
    assert spans.exclude_overlapping(s, outer.limit(0), ["file"]).count() == 3 and spans.exclude_overlapping(s.limit(0), outer, ["file"]).count() == 0


def test_unique_guard(spark):
    with pytest.raises(ValueError):
        tables.require_unique(spark.createDataFrame([("a",), ("a",)], "id string"), "id")
    assert tables.common_suffix(spark.createDataFrame([("k", [1, 2, 3]), ("k", [9, 2, 3]), ("k", [3]), ("e", [1])], "k string, s array<int>"), ["k"], "s").orderBy("k").collect()[1]["suffix"] == [3]
