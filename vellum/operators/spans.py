"""Position-ordered operators: as-of lookups, islands, interval joins, context and running offsets.

All are partitioned by a file-like key; positions order rows within it.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.operators.scans import prefix_scan


def _window(by: Sequence[str], order: Sequence):
    return Window.partitionBy(*by).orderBy(*order)


def carry_forward(df: DataFrame, value: Column, by: Sequence[str], order: Sequence, out: str) -> DataFrame:
    """The last non-null value up to and with each row; null before the first."""
    frame = _window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last_value(value, ignoreNulls=True).over(frame))


def nearest_preceding(points: DataFrame, marks: DataFrame, by: Sequence[str], at: str, value: str, out: str) -> DataFrame:
    """points with the value of the last mark at or before each; marks of one place: the greatest value.

    As-of join by one sort of the union, so no pair of a point and a mark is made."""
    extra = [c for c in points.columns if c not in {*by, at}]
    rows = points.select(*by, at, F.struct(*extra).alias("__row") if extra else F.lit(True).alias("__row"), F.lit(1).alias("__p"), F.lit(None).cast(marks.schema[value].dataType).alias("__v"))
    seen = marks.select(*by, at, F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"), F.lit(0).alias("__p"), F.col(value).alias("__v"))
    both = carry_forward(rows.unionByName(seen), F.col("__v"), by, [at, "__p", "__v"], out).where(F.col("__p") == 1)
    return both.select(*by, at, *([F.col(f"__row.{c}").alias(c) for c in extra]), out)


def islands(df: DataFrame, starts: Column, by: Sequence[str], order: Sequence, out: str = "island") -> DataFrame:
    """Numbers runs of rows from 1: a run begins where `starts` holds."""
    frame = _window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(F.when(starts, 1).otherwise(0)).over(frame).cast("bigint"))


def previous(value: Column | str, by: Sequence[str], order: Sequence, n: int = 1) -> Column:
    return F.lag(value, n).over(_window(by, order))


def following(value: Column | str, by: Sequence[str], order: Sequence, n: int = 1) -> Column:
    return F.lead(value, n).over(_window(by, order))


def context(df: DataFrame, value: str, by: Sequence[str], order: Sequence, lines: int = 2) -> DataFrame:
    """b<n>..b1 and a1..a<n>: the value of the n-th row before and after."""
    before = [previous(value, by, order, k).alias(f"b{k}") for k in range(lines, 0, -1)]
    after = [following(value, by, order, k).alias(f"a{k}") for k in range(1, lines + 1)]
    return df.select("*", *before, *after)


def _swept(spans: DataFrame, marks: DataFrame, by: Sequence[str], place: str, start: str, end: str, first: int) -> DataFrame:
    """spans with __reach, the greatest end of the marks of their key that start at or before `place` (at it only if
    marks come first there, first=0). One sorted scan of both, so no pair of a span and a mark is made."""
    names = list(spans.columns)
    rows = spans.select(*by, F.col(place).alias("__at"), F.lit(1 - first).alias("__kind"), F.lit(None).cast(marks.schema[end].dataType).alias("__end"), F.struct(*names).alias("__row"))
    seen = marks.select(*by, F.col(start).alias("__at"), F.lit(first).alias("__kind"), F.col(end).alias("__end"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"))
    told = prefix_scan(rows.unionByName(seen), by, ["__at", "__kind"], {"__reach": ("max", F.col("__end"))})
    return told.where(F.col("__row").isNotNull()).select(*[F.col(f"__row.{c}").alias(c) for c in names], "__reach")


def exclude_overlapping(spans: DataFrame, taken: DataFrame, by: Sequence[str], *, start: str = "start", end: str = "end") -> DataFrame:
    """Spans that overlap no taken span of the same key (s < t.end and e > t.start): of the taken ones that start
    before a span's end, the greatest end decides."""
    told = _swept(spans, taken, by, end, start, end, first=1)
    return told.where(F.col("__reach").isNull() | (F.col("__reach") <= F.col(start))).drop("__reach")


def exclude_contained(spans: DataFrame, outer: DataFrame, by: Sequence[str], *, start: str = "start", end: str = "end") -> DataFrame:
    """Spans inside no outer span of the same key: of the outer ones that start at or before it, the greatest end decides."""
    told = _swept(spans, outer, by, start, start, end, first=0)
    return told.where(F.col("__reach").isNull() | (F.col("__reach") < F.col(end))).drop("__reach")


def contained(spans: DataFrame, outer: DataFrame, by: Sequence[str], *, start: str = "start", end: str = "end") -> DataFrame:
    """Spans inside some outer span of the same key, each once."""
    return _swept(spans, outer, by, start, start, end, first=0).where(F.col("__reach") >= F.col(end)).drop("__reach")


def within_after(rows: DataFrame, marks: Column, seconds: int, by: Sequence[str], ts: str, key: str) -> DataFrame:
    """Rows that no other marked row of their key precedes by less than `seconds` (or shares its time with).

    The last marked time at or before a row, itself left out, decides: a window in place of a range join."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(*by).orderBy("__us").rangeBetween(-(seconds * 1_000_000) + 1, 0)
    told = rows.withColumn("__us", micros).withColumn("__m", F.when(marks, 1).otherwise(0))
    return told.withColumn("__n", F.sum("__m").over(w) - F.col("__m")).where(F.col("__n") == 0).drop("__us", "__m", "__n")


def running_offsets(df: DataFrame, size: Column, by: Sequence[str], order: Sequence[str], *, end: str = "sector", number: str = "link_no") -> DataFrame:
    """Inclusive running sum of sizes and a running number, in two passes."""
    told = prefix_scan(df, by, order, {end: ("sum", size.cast("bigint")), number: ("sum", F.lit(1).cast("bigint"))})
    return told.withColumn(end, F.col(end).cast("bigint"))


def fill_links(df: DataFrame, link: str, by: Sequence[str], order: Sequence, out: str = "link") -> DataFrame:
    """Missing numbers continue from the last given one (or from 0)."""
    runs = islands(df, F.col(link).isNotNull(), by, order, "__run")
    base = F.coalesce(F.first(link, ignorenulls=True).over(Window.partitionBy(*by, "__run")), F.lit(0))
    place = F.row_number().over(_window([*by, "__run"], order))
    first = F.when(F.col("__run") > 0, 1).otherwise(0)
    return runs.withColumn(out, (base + place - first).cast("int")).drop("__run")


def overlapping_previous(df: DataFrame, start: Column, end: Column, by: Sequence[str], order: Sequence) -> DataFrame:
    """Rows that begin before the one ahead of them ends."""
    return df.withColumn("__end", previous(end, by, order)).where(F.col("__end") > start).drop("__end")


def changed_rows(df: DataFrame, value: str, by: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each run of equal values."""
    before = previous(value, by, order)
    return df.withColumn("__p", before).where(F.col("__p").isNull() | (F.col("__p") != F.col(value))).drop("__p")


def numbered_ids(df: DataFrame, by: Sequence[str], order: Sequence[str], prefix: Column, out: str = "id") -> DataFrame:
    """prefix:000001 and so on, counted by key in two passes; numbers of more digits are written out."""
    n = F.col("__n").cast("string")
    told = prefix_scan(df, by, order, {"__n": ("sum", F.lit(1).cast("bigint"))})
    return told.withColumn(out, F.concat(prefix, F.lit(":"), F.lpad(n, F.greatest(F.length(n), F.lit(6)), F.lit("0")))).drop("__n")


def line_of(text: Column, at: Column) -> Column:
    """1-based line of a 1-based position."""
    head = F.substring(text, F.lit(1), at - 1)
    return (F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def all_hits(df: DataFrame, key: Sequence[str], text: str, needle: str) -> DataFrame:
    """(key, line, column, at) of every hit of a plain string in a text, hits apart; 1-based places in code points. Texts
    are cut at the hits; places are running sums of the pieces before, so a text of many hits is linear."""
    parts = df.select(*key, F.posexplode(F.split(text, f"\\Q{needle}\\E", -1)).alias("__k", "__piece"))
    last = F.regexp_extract("__piece", r"([^\n]*)\z", 1)
    breaks = F.length("__piece") - F.length(F.replace("__piece", F.lit("\n"), F.lit("")))
    w = _window(key, ["__k"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = parts.select(*key, "__k", F.length("__piece").alias("__size"), breaks.alias("__breaks"), F.length(last).alias("__tail"))
    told = told.withColumn("at", F.sum("__size").over(w) + F.col("__k") * len(needle) + 1).withColumn("line", F.sum("__breaks").over(w) + 1)
    # A line's begin is behind the last piece with a line end; columns count from there.
    begin = F.max(F.when(F.col("__breaks") > 0, F.col("at") - F.col("__tail"))).over(w)
    more = F.lead("__k").over(_window(key, ["__k"]))
    hits = told.withColumn("column", F.col("at") - F.coalesce(begin, F.lit(1)) + 1).withColumn("__more", more).where(F.col("__more").isNotNull())
    return hits.select(*key, *[F.col(c).cast("bigint").alias(c) for c in ("line", "column", "at")])


def last_of_place(df: DataFrame, by: Sequence[str], place: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of one place the last in order."""
    rest = [c for c in df.columns if c not in {*by, *place}]
    kept = df.groupBy(*by, *place).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return kept.select(*[F.col(c) if c in {*by, *place} else F.col(f"__r.{c}").alias(c) for c in df.columns])
