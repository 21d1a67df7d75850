"""Written intermediates, and tables dealt to cores."""

import os
import subprocess
import sys

from vellum.llm.common import DEAL_BYTES, table, with_number

SCRIPT = """
import sys
from pyspark.sql import SparkSession
sys.path.insert(0, {root!r})
from vellum.llm.common import materialize
spark = SparkSession.builder.master("local[1]").config("spark.checkpoint.dir", "file://{folder}").config("spark.ui.enabled", "false").getOrCreate()
materialize(spark.range(3), "left")
spark.stop()
"""


def test_intermediates_go_after_the_session_is_stopped(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, folder=tmp_path)], check=True, capture_output=True, timeout=120)
    left = [x for _, _, names in os.walk(tmp_path) for x in names]
    assert left == []


def test_numbers_without_gaps(spark):
    rows = with_number(spark.range(0, 1_000, 1, 7).where("id % 3 = 0"), "n")
    assert sorted(r.n for r in rows.collect()) == list(range(334)) and rows.columns == ["id", "n"]
    assert with_number(spark.range(0), "n").count() == 0


def test_small_tables_are_dealt_large_ones_are_not(spark, tmp_path, monkeypatch):
    spark.range(1_000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    assert table(spark, str(tmp_path), "t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("vellum.llm.common.DEAL_BYTES", 10)
    assert table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1
    assert DEAL_BYTES == 32 << 20
