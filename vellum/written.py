"""Intermediates that are written: lineage ends there, and they survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a local master may do without one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return f"{folder.rstrip('/')}/vellum"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as Parquet in the shared folder, read again. The folder goes when the JVM ends, or by removed()."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where, system = _place(spark, path)
    system.deleteOnExit(where)
    read = spark.read.schema(df.schema).parquet(path)
    read._vellum_path = path  # noqa: SLF001
    return read


def removed(*frames: DataFrame) -> None:
    """Removes written frames that no result reads."""
    for df in frames:
        where, system = _place(df.sparkSession, df._vellum_path)  # noqa: SLF001
        system.delete(where, True)


def _place(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
