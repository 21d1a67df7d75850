"""Rules kept as rows: the first one that a row meets decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules that go to the executors as one table; more are joined.
MAX_BROADCAST = 100_000


def routed(df: DataFrame, rules: DataFrame, key: Sequence[str], fields: Sequence[str], *, default: str | None = None, out: str = "route") -> DataFrame:
    """df with `out`: the result of the rule of least rank that the row meets, `default` where it meets none.

    rules: (rank, field, value, result); a rule holds where that field of the row, as a string, is value, and one without
    a field holds for every row. Rules of one rank go by field and value. key tells df's rows apart. Each row asks for
    its own fields' values, an equi-join, and the least of what it meets is kept: no rule is tried on every row. Rules are
    broadcast only up to MAX_BROADCAST, which is checked.
    """
    few = rules.select("rank", F.col("field").alias("__f"), F.col("value").alias("__v"), "result")
    if few.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        few = F.broadcast(few)
    asked = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields], F.struct(F.lit("").alias("f"), F.lit("").alias("v")))
    rows = df.select(*key, F.explode(asked).alias("a")).select(*key, F.col("a.f").alias("__f"), F.col("a.v").alias("__v"))
    any_row = few.withColumn("__v", F.when(F.coalesce("__f", F.lit("")) == "", F.lit("")).otherwise(F.col("__v"))).withColumn("__f", F.coalesce("__f", F.lit("")))
    met = rows.join(any_row, ["__f", "__v"])
    first = met.groupBy(*key).agg(F.min_by("result", F.struct("rank", "__f", "__v")).alias(out))
    return df.join(first, list(key), "left").withColumn(out, F.coalesce(out, F.lit(default).cast("string")))
