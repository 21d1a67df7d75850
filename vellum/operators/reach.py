"""Reachability to a fixed point, by semi-naive rounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.written import removed, written


def reachable(seeds: DataFrame, edges: DataFrame, *, node: str = "node", source: str = "source", target: str = "target") -> DataFrame:
    """(node, round): every node that edges (source, target) lead to from the seeds, these included (round 0), with the
    least number of edges. Null nodes lead nowhere.

    A round joins the edges with what the last one found and leaves out what is known already; each round's nodes are
    written, so no lineage grows and nothing but a row count comes to the driver. Rounds end when one finds nothing.
    """
    steps = written(edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).alias("__from"), F.col(target).alias(node)).distinct(), "edges")
    found = [written(seeds.where(F.col(node).isNotNull()).select(node).distinct().withColumn("round", F.lit(0).cast("bigint")), "reached")]
    while found[-1].limit(1).count():
        known = reduce(DataFrame.unionByName, found).select(node)
        ahead = steps.join(found[-1].select(F.col(node).alias("__from")), "__from").select(node).distinct()
        new = ahead.join(known, node, "left_anti").withColumn("round", F.lit(len(found)).cast("bigint"))
        found.append(written(new, "reached"))
    removed(steps)
    return reduce(DataFrame.unionByName, found)
