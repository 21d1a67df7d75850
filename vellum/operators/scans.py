"""Prefix scans in two passes: no key is one task's, however many rows it has.

Rows are dealt to ranges of (key, order) and written. Each range is scanned on its own; what a key's ranges come to is
scanned once more, one row for each key and range; and what lies before a range is joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.written import written

#: What a scan adds up to: its fold over a window, and how what lies before joins a row's own.
_FOLDS = {
    "sum": (F.sum, lambda own, before: F.coalesce(own, F.lit(0)) + F.coalesce(before, F.lit(0))),
    "max": (F.max, lambda own, before: F.greatest(own, before)),
    "last": (lambda c: F.last_value(c, ignoreNulls=True), lambda own, before: F.coalesce(own, before)),
}


def dealt(df: DataFrame, by: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """df with the number (__range) of the range of (by, order) that each row is in, written."""
    keys = [*by, *order]
    parts = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    return written(parts.withColumn("__range", F.spark_partition_id()), "ranges")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Keys are equal, nulls too."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys], left["__range"] == right["__r"])


def prefix_scan(df: DataFrame, by: Sequence[str], order: Sequence[str], scans: dict[str, tuple[str, Column]], ranges: int | None = None) -> DataFrame:
    """df with one column a scan: {name: (kind, value)} over each key's rows up to and with the row itself, in order.

    kind is sum, max or last (the last non-null value). order must tell a key's rows apart where the result depends
    on it. Nulls in keys are a key; in order they come first. ranges: how many ranges to deal to (the session's
    number of shuffle partitions)."""
    rows = dealt(df.select("*", *[value.alias(f"__v_{name}") for name, (_, value) in scans.items()]), by, order, ranges)
    own = Window.partitionBy("__range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = Window.partitionBy("__range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fold = {name: _FOLDS[kind][0] for name, (kind, _) in scans.items()}
    value = lambda name: F.col(f"__v_{name}")
    told = rows.select("*", *[fold[n](value(n)).over(own).alias(f"__own_{n}") for n in scans], *[fold[n](value(n)).over(first).alias(f"__all_{n}") for n in scans])
    ends = told.groupBy("__range", *by).agg(*[F.first(f"__all_{n}").alias(f"__all_{n}") for n in scans])
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("__range").alias("__r"), *[F.col(k).alias(f"__{k}") for k in by], *[fold[n](F.col(f"__all_{n}")).over(before).alias(f"__before_{n}") for n in scans])
    both = told.join(carried, _same(told, carried, by), "left")
    return both.select(*df.columns, *[_FOLDS[kind][1](F.col(f"__own_{n}"), F.col(f"__before_{n}")).alias(n) for n, (kind, _) in scans.items()])


# ---- fields that are held until a line takes them


def _walk(rows: Iterable[tuple], held: dict[int, tuple], leads: Sequence[int], taken: list | None = None) -> dict[int, tuple]:
    """What is held after rows (field, value, at, closer), if `held` was before them. A closer whose lead is held takes
    and clears all."""
    held = dict(held)
    for field, value, at, closer in rows:
        if not pd.isna(field):
            held[int(field)] = (value, at)
        if not pd.isna(closer) and leads[int(closer)] in held:
            if taken is not None:
                taken.append((at, int(closer), held))
            held = {}
    return held


def held_fields(df: DataFrame, by: Sequence[str], at: str, *, field: Column, value: Column, closer: Column, leads: Sequence[int], fields: int, ranges: int | None = None) -> DataFrame:
    """(by, at, closer, taken): for each closing row that finds its leading field held, the (value, at) of all fields
    held by then, null where one is not; these are cleared by it. field: the number of the field that a row sets (null:
    none), below `fields`, which is small; closer: the number of a closing row's kind (null: none), whose lead is leads[closer].

    What a row clears depends on what rows before it cleared. Each range of rows is therefore one transition from every
    set of fields that may be held before it (2 ** fields) to what is held behind it, and the place each comes from;
    transitions of a key's ranges are composed in order, and ranges are then walked from what they begin with.
    """
    kind = T.StructType().add("value", df.select(value).schema[0].dataType).add("at", df.schema[at].dataType)
    rows = dealt(df.select(*by, at, field.cast("int").alias("__field"), value.alias("__value"), closer.cast("int").alias("__closer")), by, [at], ranges)
    given = [rows.schema[k] for k in by]
    keyed = T.StructType([T.StructField("__range", T.IntegerType()), *given])
    inherited = object()

    def cells(held: dict) -> list:
        return [None if (x := held.get(k)) is None else {"value": x[0], "at": x[1]} for k in range(fields)]

    def of(frame: pd.DataFrame) -> list[tuple]:
        return list(frame.sort_values(at)[["__field", "__value", at, "__closer"]].itertuples(index=False, name=None))

    def transition(frame: pd.DataFrame) -> pd.DataFrame:
        told, lines = [], of(frame)
        for mask in range(1 << fields):
            held = _walk(lines, {k: (inherited, None) for k in range(fields) if mask >> k & 1}, leads)
            kept = sum(1 << k for k, x in held.items() if x[0] is inherited)
            told.append({"kept": kept, "own": cells({k: x for k, x in held.items() if x[0] is not inherited})})
        return pd.DataFrame({"__range": [int(frame["__range"].iloc[0])], **{k: [frame[k].iloc[0]] for k in by}, "told": [told]})

    step = T.StructType().add("kept", T.IntegerType()).add("own", T.ArrayType(kind))
    steps = rows.groupBy("__range", *by).applyInPandas(transition, T.StructType([*keyed.fields, T.StructField("told", T.ArrayType(step))]))

    def composed(frame: pd.DataFrame) -> pd.DataFrame:
        frame, held, begins = frame.sort_values("__range"), {}, []
        for told in frame["told"]:
            begins.append(cells(held))
            now = told[sum(1 << k for k in held)]
            new = {k: held[k] for k in held if now["kept"] >> k & 1}
            held = new | {k: (x["value"], x["at"]) for k, x in enumerate(now["own"]) if x is not None}
        return frame[["__range", *by]].assign(begin=begins)

    begins = steps.groupBy(*by).applyInPandas(composed, T.StructType([*keyed.fields, T.StructField("begin", T.ArrayType(kind))]))
    carried = begins.select(F.col("__range").alias("__r"), *[F.col(k).alias(f"__{k}") for k in by], "begin")
    both = rows.join(carried, _same(rows, carried, by)).select(*rows.columns, "begin")

    def applied(frame: pd.DataFrame) -> pd.DataFrame:
        held = {k: (x["value"], x["at"]) for k, x in enumerate(frame["begin"].iloc[0]) if x is not None}
        taken: list = []
        _walk(of(frame), held, leads, taken)
        made = {at: [x[0] for x in taken], "closer": [x[1] for x in taken], "taken": [cells(x[2]) for x in taken]}
        return pd.DataFrame({**{k: [frame[k].iloc[0]] * len(taken) for k in by}, **made}, dtype=object)

    schema = T.StructType([*given, rows.schema[at], T.StructField("closer", T.IntegerType()), T.StructField("taken", T.ArrayType(kind))])
    return both.groupBy("__range", *by).applyInPandas(applied, schema)
