"""Keyed operators: comparison, validation, merging, guards, thresholds and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compare(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(id, st) over a full outer join: same, differ, only_left, only_right."""
    a = left.select(F.col(key).alias("__a"), F.col(value).alias("__x"))
    b = right.select(F.col(key).alias("__b"), F.col(value).alias("__y"))
    state = (
        F.when(F.col("__a").isNull(), "only_right").when(F.col("__b").isNull(), "only_left").when(F.col("__x") == F.col("__y"), "same").otherwise("differ")
    )
    return a.join(b, F.col("__a") == F.col("__b"), "full_outer").select(F.coalesce("__a", "__b").alias("id"), state.alias("st"))


def validate(requested: DataFrame, current: DataFrame, key: str, rules: Sequence[tuple[str, Column]], ok: str = "ok", out: str = "st") -> DataFrame:
    """requested, with the name of the first rule that holds against its current row; 'missing' where there is none."""
    there = current.withColumn("__there", F.lit(True))
    state = F.when(F.col("__there").isNull(), "missing")
    for name, broken in rules:
        state = state.when(broken, name)
    return requested.join(there, key, "left").withColumn(out, state.otherwise(ok)).drop("__there")


def duplicates(df: DataFrame, key: Column, out: str = "h") -> DataFrame:
    """Keys that more than one row has, and how many."""
    return df.groupBy(key.alias(out)).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """df; an error if a key is null or repeated."""
    bad = df.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"missing or repeated {key}: {bad[0][0]!r}")
    return df


def merge_first_seen(
    df: DataFrame, keys: Sequence[str], seq: str, *, first: Sequence[str] = (), sums: Sequence[str] = (), unions: Sequence[str] = (), examples: str | None = None, most: int = 3
) -> DataFrame:
    """One row a key: scalars of the least seq, sums, sorted unions of arrays, the first `most` distinct examples."""
    out: list[Column] = [F.min_by(c, seq).alias(c) for c in first]
    out += [F.sum(c).cast("bigint").alias(c) for c in sums]
    out += [F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in unions]
    if examples:
        # The least seq of each example first, so that no more than distinct examples are held for a key.
        own = df.groupBy(*keys, examples).agg(F.min(seq).alias("__s"))
        ranked = own.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy("__s", examples))).where(F.col("__r") <= most)
        kept = ranked.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", examples))), lambda x: x[examples]).alias(f"{examples}s"))
        return df.groupBy(*keys).agg(*out).join(kept, list(keys)) if out else kept
    return df.groupBy(*keys).agg(*out)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence, n: int, out: str = "rn") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")).where(F.col(out) <= n)


def frequent(df: DataFrame, term: Column, least: int, unit: str) -> DataFrame:
    """(term, n, files): terms of at least `least` occurrences, and the units they are in."""
    return df.select(term.alias("term"), unit).groupBy("term").agg(F.count("*").alias("n"), F.count_distinct(unit).alias("files")).where(F.col("n") >= least)


def without(df: DataFrame, stop: DataFrame, key: str, stop_key: str) -> DataFrame:
    return df.join(stop.select(F.col(stop_key).alias(key)).distinct(), key, "left_anti")


def buckets(df: DataFrame, bucket: Column, out: str = "vol") -> DataFrame:
    return df.groupBy(bucket.alias(out)).agg(F.count("*").alias("n"))


def common_suffix(df: DataFrame, by: Sequence[str], seq: str) -> DataFrame:
    """(by, suffix): the longest common suffix of the group's arrays; a null array has no part.

    Folded pairwise over (length, array) extremes: the common suffix of a set is that of the least and greatest of
    its reversed arrays, so only two arrays of a group are ever held."""
    back = F.reverse(seq)
    two = df.where(F.col(seq).isNotNull()).groupBy(*by).agg(F.min(back).alias("__a"), F.max(back).alias("__b"))
    n = F.least(F.size("__a"), F.size("__b"))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: (i >= n) | (F.get("__a", i) != F.get("__b", i)))
    return two.select(*by, F.reverse(F.slice("__a", F.lit(1), F.array_min(same))).alias("suffix"))
