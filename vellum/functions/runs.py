"""Runs of equal bytes as columns: found by comparing neighbours, in time linear in the bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _byte(data: Column, at: Column) -> Column:
    return F.substring(data, at + 1, F.lit(1))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is made once, not at each byte."""
    return F.element_at(F.transform(F.array(value), body), 1)


def run_lengths(data: Column) -> Column:
    """array<struct<value: binary (one byte), n: int>>: the runs of a byte string, in order; empty for an empty one."""

    def of(bytes_: Column) -> Column:
        size = F.length(bytes_)
        places = F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)))
        starts = F.filter(places, lambda i: (i < size) & ((i == 0) | (_byte(bytes_, i) != _byte(bytes_, i - 1))))
        one = lambda held: F.transform(held, lambda at, k: F.struct(_byte(bytes_, at).alias("value"), (F.coalesce(F.get(held, k + 1), size) - at).alias("n")))
        return _bound(starts, one)

    return F.when(data.isNotNull(), _bound(data, of))


def from_runs(runs: Column) -> Column:
    """The byte string of its runs."""
    return F.unhex(F.array_join(F.transform(runs, lambda r: F.repeat(F.hex(r["value"]), r["n"])), ""))


def cut_runs(runs: Column, most: int) -> Column:
    """Runs of at most `most` bytes: longer ones are whole parts and a rest, as codes of one length byte need."""
    parts = F.transform(runs, lambda r: F.transform(
        F.sequence(F.lit(0), F.floor((r["n"] - 1) / most).cast("int")), lambda k: F.struct(r["value"].alias("value"), F.least(F.lit(most), r["n"] - k * most).cast("int").alias("n"))
    ))
    return F.flatten(parts)


def packed_runs(data: Column) -> Column:
    """Pairs of a length (1 to 255) and a byte."""
    pair = lambda r: F.concat(F.lpad(F.hex(r["n"]), 2, "0"), F.hex(r["value"]))
    return F.unhex(F.array_join(F.transform(cut_runs(run_lengths(data), 255), pair), ""))


def unpacked_runs(packed: Column) -> Column:
    def of(pairs: Column) -> Column:
        n = (F.length(pairs) / 2).cast("int")
        one = lambda i: F.repeat(F.hex(F.substring(pairs, 2 * i, F.lit(1))), F.conv(F.hex(F.substring(pairs, 2 * i - 1, F.lit(1))), 16, 10).cast("int"))
        return F.when(n > 0, F.unhex(F.array_join(F.transform(F.sequence(F.lit(1), n), one), ""))).otherwise(F.lit("").cast("binary"))

    return F.when(packed.isNotNull(), _bound(packed, of))
