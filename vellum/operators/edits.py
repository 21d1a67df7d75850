"""Edits of texts by spans, checked and applied in columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checked(edits: DataFrame, texts: DataFrame, key: str, *, text: str = "text", rules: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """edits (key, start, end, new, expected, ...) with error: the first rule that an edit breaks, null if none.

    In order: `no text`; `out of range` (0 <= start <= end <= length); `changed` where `expected` is not null and not
    what the span holds; the given rules, on the columns of edits; `overlap` with an edit that begins before it in the
    same text and breaks no rule so far (an insertion at another edit's end does not overlap). Equal places go by order.
    """
    now = texts.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    met = edits.join(now, edits[key] == now["__key"], "left")
    held = F.substring("__text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    error = F.when(F.col("__text").isNull(), "no text")
    error = error.when((F.col("start") < 0) | (F.col("start") > F.col("end")) | (F.col("end") > F.length("__text")), "out of range")
    error = error.when(F.col("expected").isNotNull() & (F.col("expected") != held), "changed")
    for name, broken in rules:
        error = error.when(broken, name)
    told = met.withColumn("error", error).drop("__key", "__text")
    before = Window.partitionBy(key).orderBy("start", "end", "new").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(F.col("error").isNull(), F.col("end"))).over(before)
    return told.withColumn("error", F.coalesce("error", F.when(reach > F.col("start"), "overlap")))


def spliced(text: Column, edits: Column) -> Column:
    """text with edits, an array of struct<start, end, new> in order of their places that do not overlap: what lies between
    them is cut, and all is joined."""
    n = F.size(edits)
    end = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(edits, k - 1)["end"])
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    parts = F.transform(edits, lambda e, k: F.concat(piece(end(k), e["start"]), e["new"]))
    return F.when(n > 0, F.concat(F.array_join(parts, ""), piece(F.get(edits, n - 1)["end"], F.length(text)))).otherwise(text)


def applied(texts: DataFrame, edits: DataFrame, key: str, *, text: str = "text", all_or_none: bool = True) -> DataFrame:
    """texts with the edits of checked() in place, and n_edits, how many. all_or_none: a text with an edit that breaks a
    rule stays as it is; else its other edits are made."""
    good = F.col("error").isNull()
    lists = edits.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(good, F.struct("start", "end", "new")))).alias("__edits"), F.count_if(~good).alias("__bad")
    ).withColumnRenamed(key, "__key")
    met = texts.join(lists, texts[key] == lists["__key"], "left")
    some = F.col("__edits").isNotNull() & (F.lit(not all_or_none) | (F.col("__bad") == 0))
    made = F.when(some, spliced(F.col(text), F.col("__edits"))).otherwise(F.col(text))
    n = F.when(some, F.size("__edits")).otherwise(0).cast("bigint")
    return met.select(*[made.alias(c) if c == text else texts[c] for c in texts.columns], n.alias("n_edits"))
