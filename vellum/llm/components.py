"""Connected components over an edge table: forests of bounded parts, and alternating star steps between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import discard, materialize

#: Edges (16 bytes each) that a task joins by union-find.
TASK_EDGES = 500_000


def connected_components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); root is the smallest node of its component.

    Each round deals the edges to tasks of at most about task_edges, whose union-find replaces them by stars around the
    smallest node each task knows; then a large-star and a small-star step (partially aggregated minima and equi-joins
    back, so a hub's neighbours never meet in one task) join what the tasks found. Rounds go on until one task has held
    all edges or nothing changes; each round's edges are written, so no lineage grows. Loops and repeated edges are
    harmless; an empty table gives an empty one. Nothing is collected but a checksum a round.
    """
    now = materialize(_oriented(edges.select("a", "b")), "edges")
    while True:
        parts = max(1, -(-now.count() // task_edges))
        dealt = now.repartition(parts) if parts == 1 else now.repartition(parts, "a", "b")
        stars = materialize(dealt.mapInArrow(_forest, "a bigint, b bigint"), "stars")
        discard(now)
        if parts == 1:
            break
        now = materialize(_small_star(_large_star(stars.distinct())), "edges")
        if _checksum(now) == _checksum(stars):
            break
        discard(stars)
    pairs = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a task's edges, roots left out: union-find with the smaller root on top."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.setdefault(top, top)) != top:
            top = up
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    for rb in batches:
        for a, b in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
    pairs = [(x, r) for x in sorted(above) if (r := root(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _oriented(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(linked.unionByName(least.select("a", F.col("m").alias("b"))))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
