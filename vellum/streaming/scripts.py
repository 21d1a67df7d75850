"""Streams: scripts ingested as files arrive, and chains of events as sessions. Beyond what batch tools of the kind do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellum.text.catalog import extract, write_jsonl

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_scripts(spark: SparkSession, folder: str, files_a_batch: int = 1_000) -> DataFrame:
    """(file, content) of scripts as they are put into a folder."""
    read = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.[aA][dD][vV]").option("maxFilesPerTrigger", files_a_batch).load(folder)
    return read.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), "content")


def ingest_catalogs(scripts: DataFrame, output: str, checkpoint: str, encoding: str = "utf-8") -> StreamingQuery:
    """Writes the catalog of each batch of scripts to output/batch=N. A batch that is run again finds its folder
    and is passed over, so each is written once."""

    def put(batch: DataFrame, number: int) -> None:
        path = f"{output}/batch={number}"
        spark = batch.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")  # noqa: SLF001
        system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
        if system.exists(where):
            return
        system.delete(where.getParent(), True)  # what a run that was cut off left
        write_jsonl(extract(batch, encoding).all, path)

    return scripts.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of a key's events with no gap longer than `gap`: counts and first and last times; batch or stream."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(ts, late)
    w = F.session_window(ts, gap)
    return timed.groupBy(key, w.alias("w")).agg(F.count("*").alias("n"), F.max(ts).alias("last")).select(key, F.col("w.start").alias("first"), "last", "n")
