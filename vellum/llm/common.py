"""What the operators share: reading tables, written intermediates and Arrow mapping."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_written: dict[str, SparkSession] = {}


#: Rows in a batch that goes to Python; the default of 10,000 whole texts is a large part of a small executor.
BATCH_ROWS = 1_000
#: Bytes of files up to which a table is dealt to the cores, and to how many tasks.
DEAL_BYTES, DEAL_TASKS = 32 << 20, 64
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Sets the session's batches to BATCH_ROWS rows, unless they are smaller.

    A table of at most DEAL_BYTES is dealt to the cores, DEAL_TASKS at most: a row group is one task, so a small file
    would be read by one core. What is dealt is bounded in bytes, whatever the cluster; larger tables are read as they lie."""
    if not 0 < int(spark.conf.get(_BATCH, "10000")) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)
    read = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size = int(read._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # noqa: SLF001  of its files
    return read.repartition(min(spark.sparkContext.defaultParallelism, DEAL_TASKS)) if size <= DEAL_BYTES else read


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; without one, a temporary folder, on a local
    master only: a cluster's machines do not share it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
    return f"{folder.rstrip('/')}/vellum"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def materialize(df: DataFrame, label: str, *, partition_by: str | None = None) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    schema = df.schema
    if partition_by:
        rest = [f for f in schema.fields if f.name != partition_by]
        schema = T.StructType([*rest, schema[partition_by]])
    _goes_with_jvm(spark, path)
    read = spark.read.schema(schema).parquet(path)
    read._vellum_path = path  # noqa: SLF001
    return read


def _goes_with_jvm(spark: SparkSession, path: str) -> None:
    """The JVM removes what is left of a written path when it ends, after spark.stop() too."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)  # noqa: SLF001


def with_number(df: DataFrame, out: str, label: str = "numbered") -> DataFrame:
    """df, written, with whole numbers from 0 without gaps, as bigint. A task numbers its own rows; the rows of the
    tasks before are added, of which there is one number a task."""
    rows = materialize(df.withColumn("own", F.monotonically_increasing_id()), label)
    task = F.shiftright("own", 33)
    sizes = sorted(tuple(r) for r in rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect())
    before = [(t, sum(n for _, n in sizes[:k])) for k, (t, _) in enumerate(sizes)]
    starts = df.sparkSession.createDataFrame(before or [(0, 0)], "task bigint, before bigint")
    told = rows.join(F.broadcast(starts), task == starts["task"])
    read = told.select(*columns_of(rows, df.columns), (F.col("own").bitwiseAND((1 << 33) - 1) + F.col("before")).alias(out))
    read._vellum_path = rows._vellum_path  # noqa: SLF001
    return read


def discard(df: DataFrame) -> None:
    """Removes the files of a materialized frame that no later result reads."""
    if path := getattr(df, "_vellum_path", None):
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)  # noqa: SLF001
    _written.pop(path, None)


@atexit.register
def _clear() -> None:
    for path, spark in list(_written.items()):
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the session has ended; the cluster's cleaner has the rest
            return


def map_batches(
    df: DataFrame, columns: list[str], schema: T.StructType | str, make: Callable[[], Callable[..., Iterable[pa.Array]]]
) -> DataFrame:
    """mapInArrow over `columns` only. `make` runs once a task and returns a function from the columns'
    Python lists to the output columns (Arrow arrays or lists) of any, equal, length."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = work(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) and x.type == f.type else pa.array(x, f.type) for x, f in zip(out, arrow, strict=True)],
                schema=arrow,
            )

    return df.select(*columns).mapInArrow(run, schema)


_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def stored_order(spark: SparkSession) -> Iterator[None]:
    """Tables of sorted_table() are read in their order by what runs inside; the session's setting comes back."""
    before = spark.conf.get(_SORTED, None)
    spark.conf.set(_SORTED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SORTED) if before is None else spark.conf.set(_SORTED, before)


def sorted_table(rows: DataFrame, label: str, keys: list[str], buckets: int, *, dealt: bool = False) -> DataFrame:
    """rows written as a bucketed table in the shared folder, one sorted file a bucket, and read again. dealt: rows
    come by bucket already, so that nothing is exchanged."""
    spark = rows.sparkSession
    path, name = new_path(spark, label), f"vellum_{uuid.uuid4().hex}"
    dealt_rows = rows if dealt else rows.repartition(buckets, *keys)
    dealt_rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    _goes_with_jvm(spark, path)
    read = spark.table(name)
    read._vellum_path, read._vellum_table = path, name  # noqa: SLF001
    return read


def unsorted(df: DataFrame) -> DataFrame:
    """A sorted_table() read as plain files. Unions must read it so: Spark 4.1 takes a union of bucketed scans for
    bucketed itself and leaves out the exchange that an aggregation over it needs, which gives wrong sums."""
    return df.sparkSession.read.schema(df.schema).parquet(df._vellum_path)  # noqa: SLF001


def drop_table(df: DataFrame) -> None:
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._vellum_table}")  # noqa: SLF001
    discard(df)


def with_columns_replaced(df: DataFrame, added: Iterable[str]) -> list[str]:
    """Names of df's columns that no added column replaces (names compare without case, as Spark does)."""
    taken = {x.lower() for x in added}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


#: Join keys that a hot key's rows are dealt to, and the rows that make a key hot at least, whatever the table's size.
SALTS, HOT_ROWS = 32, 1_000


def spread_join(rows: DataFrame, one: DataFrame, keys: list[str], spread: str, salts: int = SALTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rows joined with `one`, which has one row a key (no nulls in keys). Keys of over one in a thousand rows (so a
    thousand keys at most) are dealt to `salts` keys by the hash of column `spread`, and their row in `one` to each."""
    keyed = [F.col(k).alias(f"hot_{k}") for k in keys]
    hot = rows.groupBy(*keys).agg(F.count("*").alias("rows_of")).where(F.col("rows_of") > max(hot_rows, rows.count() // 1_000)).select(*keyed)
    hot = materialize(hot, "hot")
    if not hot.limit(1).count():
        return rows.join(one, keys)

    def salted(side: DataFrame, salt) -> DataFrame:
        met = [F.col(k) == F.col(f"hot_{k}") for k in keys]
        told = side.join(F.broadcast(hot), met, "left")
        return told.withColumn("salt", salt(F.col(f"hot_{keys[0]}").isNotNull())).drop(*[f"hot_{k}" for k in keys])

    left = salted(rows, lambda is_hot: F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    right = salted(one, lambda is_hot: F.explode(F.sequence(F.lit(0), F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0)))))
    return left.join(right, [*keys, "salt"]).drop("salt")


def columns_of(df: DataFrame, names: Iterable[str]) -> list:
    return [F.col(quoted(n)) for n in names]
