"""Approximate nearest neighbours by inner product: stable projections in a kd-tree, with a chi-square stopping test.

A vector x gets a further component sqrt(M^2 - |x|^2), M the greatest norm, and a query 0 there; Euclidean distance d
then falls as the inner product grows. A difference is projected on M_DIMS Gaussian directions made orthogonal, scaled
so that the squared projected distance is d^2 times what a chi-square of M_DIMS degrees bounds (independent directions
would have just that distribution, orthogonal ones a narrower one). A query verifies candidates in order of projected
distance and stops when the next one's square is over q d_k^2, q the chi-square quantile of CONFIDENCE and d_k the k-th
best distance verified so far: each true neighbour is missed with a probability of at most 1 - CONFIDENCE.

One kd-tree for the table, fitted on a bounded sample of projections, deals all vectors to cells of about SHARD_ROWS
(a cell that turns out larger is dealt to several shards). A query first searches the shard of its own cell; the
k-th best distance found there bounds the cells that the stopping test still allows, and only those are searched in a
second round. In a shard a smaller kd-tree leaves out whole leaves, then points are taken one by one. Rows of a shard
are copied only where more than BLOCK_VISITS queries come to it, one copy for so many. Equal vectors are one point
with their k + 1 smallest ids, so no hot vector fills a cell.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import discard, materialize, table

K, M_DIMS, CONFIDENCE, LEAF, SEED = 20, 24, 0.88, 64, 7
SHARD_ROWS, BLOCK_VISITS = 8_192, 16_384
#: Projections that the table's tree is fitted on (those whose vectors hash lowest), and its cells at most; larger
#: cells are dealt to shards by hash.
SAMPLE_ROWS, MAX_CELLS = 32_768, 4_096
QUERY_STEP = 20
_CHUNK = 128


@lru_cache(maxsize=8)
def chi_square_quantile(p: float, degrees: int) -> float:
    """Of an even number of degrees, by bisection of the closed form."""

    def cdf(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


@lru_cache(maxsize=64)
def projection(dim: int) -> np.ndarray:
    """(dim + 1) x m: orthogonal directions, m even and at most M_DIMS."""
    size = dim + 1
    m = min(M_DIMS, size // 2 * 2)
    drawn = np.random.default_rng([SEED, dim]).standard_normal((size, m))
    return np.linalg.qr(drawn)[0] * math.sqrt(size)


def project(x: np.ndarray, top: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))
    return (np.column_stack([x, extra]) @ projection(x.shape[1])).astype(np.float32)


def project_queries(x: np.ndarray) -> np.ndarray:
    return (x @ projection(x.shape[1])[:-1]).astype(np.float32)


class KdTree:
    """Leaves by halving at the median of the widest dimension, until they hold at most `leaf` points or `most` leaves
    are reached; `cell` says which leaf any point falls in."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, most: int | None = None):
        parts, self.axis, self.cut, self.child = [], [], [], []
        todo = [(np.arange(len(points)), -1, 0)]
        open_ = 1
        while todo:
            own, parent, side = todo.pop(0)
            span = points[own].max(0) - points[own].min(0) if len(own) else np.zeros(1)
            j = int(span.argmax())
            if len(own) <= leaf or not span[j] > 0 or (most is not None and open_ >= most):
                node = -1 - len(parts)
                parts.append(own)
            else:
                half = np.argpartition(points[own, j], len(own) // 2)
                node = len(self.axis)
                self.axis.append(j), self.cut.append(points[own[half[len(own) // 2]], j]), self.child.append([0, 0])
                right = points[own, j] >= self.cut[-1]
                if right.all():  # ties at the least value: the rest goes left
                    right = points[own, j] > self.cut[-1]
                    self.cut[-1] = points[own[right], j].min()
                todo += [(own[~right], node, 0), (own[right], node, 1)]
                open_ += 1
            if parent >= 0:
                self.child[parent][side] = node
        self.parts, self.leaves = parts, len(parts)
        self.axis, self.cut, self.child = np.array(self.axis, np.int64), np.array(self.cut, np.float32), np.array(self.child, np.int64).reshape(-1, 2)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64) if len(self.axis) else np.full(len(points), -1)
        while (at := np.flatnonzero(node >= 0)).size:
            own = node[at]
            node[at] = self.child[own, (points[at, self.axis[own]] >= self.cut[own]).astype(np.int64)]
        return -1 - node


def box_distances(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


class Shard:
    """The points of a shard in the order of their kd-tree's leaves."""

    def __init__(self, ids: list[list[int]], x: np.ndarray, p: np.ndarray, top: float):
        tree = KdTree(p)
        order = np.concatenate(tree.parts)
        self.sizes = np.array([len(o) for o in tree.parts])
        self.low, self.high = (np.stack([f(p[o], axis=0) for o in tree.parts]) for f in (np.min, np.max))
        self.x, self.p, self.top = np.ascontiguousarray(x[order]), p[order], top
        self.square = np.einsum("ij,ij->i", self.p, self.p)
        self.ids = [ids[i] for i in order]

    def search(self, query_id: int, q: np.ndarray, p: np.ndarray, k: int, confidence: float, known: np.ndarray) -> tuple[list[int], list[float], int]:
        """ids and exact inner products of the nearest found here that may be among the k nearest, nearest first, ties
        to smaller ids, and how many points were verified. known: the k best products found elsewhere, or fewer."""
        limit, length = chi_square_quantile(confidence, len(p)), float(q @ q) + self.top * self.top
        slack = 1e-12 * (length + 1)
        best = np.sort(known)[-k:]
        worst = best[0] if len(best) == k else -np.inf
        radius = lambda: limit * max(length - 2 * worst, 0.0) * (1 + 1e-6)
        near = box_distances(p, self.low, self.high) <= radius()
        rows = np.arange(len(self.x)) if near.all() else np.flatnonzero(np.repeat(near, self.sizes))
        far = self.square[rows] - 2 * (self.p[rows] @ p) + float(p @ p)
        kept, verified = [], 0

        def verify(some: np.ndarray) -> None:
            nonlocal best, worst, verified
            got = self.x[some] @ q
            verified += len(some)
            good = got >= worst - slack
            kept.append(some[good])
            others = np.array([self.ids[j][-1] != query_id or self.ids[j][0] != query_id for j in kept[-1].tolist()], bool)
            best = np.sort(np.concatenate([best, got[good][others]]))[-k:]
            worst = best[0] if len(best) == k else -np.inf

        if worst == -np.inf and len(rows) > _CHUNK:  # the nearest few bound the rest before it is sorted
            few = np.argpartition(far, _CHUNK)
            verify(rows[few[:_CHUNK]])
            rows, far = rows[few[_CHUNK:]], far[few[_CHUNK:]]
        inside = far <= radius()
        rows, far = rows[inside], far[inside]
        order = np.argsort(far, kind="stable")
        rows, far, at = rows[order], far[order], 0
        while at < len(rows) and far[at] <= radius():
            verify(rows[at : at + _CHUNK])
            at += _CHUNK
        found = np.concatenate(kept) if kept else np.empty(0, np.int64)
        exact = (self.x[found] * q).sum(1)  # summed row by row alike, whatever the shard
        good = exact >= worst - slack
        pairs = sorted((-s, i) for s, j in zip(exact[good].tolist(), found[good].tolist(), strict=True) for i in self.ids[j] if i != query_id)[:k]
        return [i for _, i in pairs], [-s for s, _ in pairs], verified


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, norm, v): v holds the components as little-endian doubles. Rows with a null id, and vectors that are
    null, empty, zero, or hold null or non-finite components are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            ids, dims, norms, raws = [], [], [], []
            for i, vec in zip(rb.column(0).to_pylist(), rb.column(1), strict=True):
                if i is None or not vec.is_valid:
                    continue
                values = vec.values
                if not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(i), dims.append(len(x)), norms.append(float(np.sqrt(x @ x))), raws.append((x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(raws, pa.binary())], names=["id", "dim", "norm", "v"])

    quoted = lambda c: F.col(f"`{c}`")
    picked = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vec_col).alias("v"))
    return picked.mapInArrow(run, "id bigint, dim int, norm double, v binary")


class Index:
    """What all tasks know of the table: by dimension the greatest norm, the tree and the first cell; by cell its box,
    its first shard and how many it has."""

    def __init__(self, tops: dict[int, float], trees: dict[int, KdTree]):
        self.tops, self.trees, self.first, n = tops, trees, {}, 0
        for dim in sorted(tops):
            self.first[dim] = n
            n += trees[dim].leaves if dim in trees else 1
        self.cells = n
        self.boxes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def cell(self, dim: int, points: np.ndarray) -> np.ndarray:
        return self.first[dim] + (self.trees[dim].cell(points) if dim in self.trees else np.zeros(len(points), np.int64))

    def lay_out(self, sizes: dict[int, int], bounds: dict[int, tuple[list[float], list[float]]], shard_rows: int) -> None:
        self.shards = np.array([-(-sizes.get(c, 0) // shard_rows) for c in range(self.cells)], np.int64)
        self.start = np.cumsum(self.shards) - self.shards
        for dim in self.tops:
            m = projection(dim).shape[1]
            own = range(self.first[dim], self.first[dim] + (self.trees[dim].leaves if dim in self.trees else 1))
            none = ([np.inf] * m, [np.inf] * m)  # no point: infinitely far
            self.boxes[dim] = tuple(np.array([bounds.get(c, none)[s] for c in own], np.float32) for s in (0, 1))


def _matrix(column: pa.Array, dtype: str = "<f8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _by_dim(rb: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = rb.column(rb.schema.get_field_index("dim")).to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, rb.take(pa.array(np.flatnonzero(dims == dim)))


def _indexed(base: DataFrame, k: int, shard_rows: int) -> tuple[DataFrame, Index]:
    """(ids, dim, v, p, cell) of every distinct vector, written, and the index."""
    spark = base.sparkSession
    same = Window.partitionBy(F.xxhash64("v"), "v")
    some = base.withColumn("n", F.row_number().over(same.orderBy("id"))).where(F.col("n") <= k + 1)
    points = some.groupBy(F.xxhash64("v").alias("h"), "v").agg(F.first("dim").alias("dim"), F.array_sort(F.collect_list("id")).alias("ids"))  # k + 1 ids at most
    sizes = base.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()  # a row for each length of vectors
    tops = {r["dim"]: r["top"] for r in sizes}

    def to_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for dim, part in _by_dim(rb):
                made = project(_matrix(part.column(1)), tops[dim])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r.tobytes() for r in made], pa.binary())], names=["h", "v", "dim", "ids", "p"])

    points = materialize(points.mapInArrow(to_points, "h bigint, v binary, dim int, ids array<bigint>, p binary"), "points")
    large = [r["dim"] for r in sizes if r["n"] > shard_rows]
    drawn = points.where(F.col("dim").isin(large)).orderBy("h").limit(SAMPLE_ROWS).select("dim", "p").collect() if large else []
    trees = {}
    for dim in large:
        own = [r["p"] for r in drawn if r["dim"] == dim]
        n = next(r["n"] for r in sizes if r["dim"] == dim)
        most = max(1, min(MAX_CELLS * len(own) // max(1, len(drawn)), -(-n // shard_rows) * 2))
        if own:
            trees[dim] = KdTree(np.frombuffer(b"".join(own), "<f4").reshape(len(own), -1), max(1, len(own) * shard_rows // n), most)
    index = Index(tops, trees)
    shared = spark.sparkContext.broadcast(index)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for rb in batches:
            for dim, part in _by_dim(rb):
                p = _matrix(part.column(1), "<f4")
                cells = shared.value.cell(dim, p)
                for c in np.unique(cells).tolist():
                    own = p[cells == c]
                    n, low, high = held.get(c, (0, own[0], own[0]))
                    held[c] = [n + len(own), np.minimum(low, own.min(0)), np.maximum(high, own.max(0))]
        cols = list(zip(*held.values(), strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(cols[0], pa.int64()), *[pa.array(list(x), pa.list_(pa.float32())) for x in cols[1:]]], names=["cell", "n", "low", "high"])

    told = points.select("dim", "p").mapInArrow(bounds, "cell int, n bigint, low array<float>, high array<float>")
    pick = lambda f, c: F.array(*[f(F.get(c, F.lit(i))) for i in range(M_DIMS)])  # noqa: E731  beyond an array's end: null
    boxes = told.groupBy("cell").agg(F.sum("n").alias("n"), pick(F.min, "low").alias("low"), pick(F.max, "high").alias("high")).collect()  # a row for each cell
    index.lay_out({r["cell"]: r["n"] for r in boxes}, {r["cell"]: tuple([v for v in r[s] if v is not None] for s in ("low", "high")) for r in boxes}, shard_rows)
    return points, index


_ASKED = "id bigint, dim int, v binary, p binary, known array<double>, seen int, shard int"


def _routed(queries: DataFrame, shared, first: bool, confidence: float, k: int) -> DataFrame:
    """A row for each query (id, dim, v, known, seen) and shard to search: its own cell's first; then all others in
    cells that the stopping test allows, given the products known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for rb in batches:
            for dim, part in _by_dim(rb):
                q = _matrix(part.column(2))
                p = project_queries(q)
                own = index.cell(dim, p)
                owner, to = [], []
                known, seen = part.column(3).to_pylist(), part.column(4).to_pylist()
                low, high = index.boxes[dim]
                for i in range(len(q)):
                    far = box_distances(p[i], low, high)
                    if first:
                        c = own[i] if index.shards[own[i]] else index.first[dim] + int(far.argmin())
                        shards = index.start[c : c + 1] + zlib.crc32(q[i].tobytes()) % index.shards[c]
                    else:
                        limit = chi_square_quantile(confidence, p.shape[1])
                        worst = min(known[i]) if len(known[i]) == k else -np.inf
                        length = float(q[i] @ q[i]) + index.tops[dim] ** 2
                        near = index.first[dim] + np.flatnonzero(far <= limit * max(length - 2 * worst, 0.0) * (1 + 1e-6))
                        n = index.shards[near]
                        shards = np.repeat(index.start[near] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                        shards = shards[shards != seen[i]]
                    owner += [i] * len(shards)
                    to += shards.tolist()
                    if len(owner) >= 2_000:
                        yield _asked(part, p, owner, to)
                        owner, to = [], []
                yield _asked(part, p, owner, to)

    return queries.select("id", "dim", "v", "known", "seen").mapInArrow(run, _ASKED)


def _asked(part: pa.RecordBatch, p: np.ndarray, owner: list[int], to: list[int]) -> pa.RecordBatch:
    at = part.take(pa.array(owner, pa.int64()))
    made = pa.array([p[i].tobytes() for i in owner], pa.binary())
    return pa.RecordBatch.from_arrays([*at.columns[:3], made, at.column(3), at.column(4), pa.array(to, pa.int32())], names=["id", "dim", "v", "p", "known", "seen", "shard"])


_FOUND = "id bigint, dim int, v binary, shard int, ids array<bigint>, scores array<double>, verified bigint"


def _searched(asked: DataFrame, placed: DataFrame, shared, k: int, confidence: float, block_visits: int) -> DataFrame:
    """What each query finds in each shard it is sent to. Shards meet their queries in one sorted stream, points
    before queries, so a task holds one shard and one batch of queries at a time."""
    visits = asked.groupBy("shard").count().where(F.col("count") > block_visits)
    crowded = visits.select(F.col("shard").alias("s"), F.ceil(F.col("count") / block_visits).cast("int").alias("blocks"))
    blocks = lambda df: df.join(crowded, df["shard"] == crowded["s"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    wanted = placed.join(asked.select(F.col("shard").alias("w")).distinct(), F.col("shard") == F.col("w"), "left_semi")
    rows = blocks(wanted).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("shard", "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("id"), "dim", "v", "p", "ids", F.lit(None).cast("array<double>").alias("known"))
    turn = F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")
    ask = blocks(asked).select("shard", turn.alias("block"), F.lit(1).alias("kind"), "id", "dim", "v", "p", F.lit(None).cast("array<bigint>").alias("ids"), "known")
    both = rows.unionByName(ask).repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, key, held, shard = shared.value.tops, None, [], None
        for rb in batches:
            keys = np.stack([rb.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                part, (s, block, kind) = rb.slice(a, b - a), keys[a].tolist()
                if (s, block) != key:
                    key, held, shard = (s, block), [], None
                if kind == 0:
                    held.append(part)
                    continue
                if shard is None:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    held = []
                    dim = whole["dim"][0].as_py()
                    shard = Shard(whole["ids"].to_pylist(), _matrix(whole["v"]), _matrix(whole["p"], "<f4"), tops[dim])
                q, p = _matrix(part.column(5)), _matrix(part.column(6), "<f4")
                made = [shard.search(i, q[j], p[j], k, confidence, np.array(w or [], float)) for j, (i, w) in enumerate(zip(part.column(3).to_pylist(), part.column(8).to_pylist(), strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(3), part.column(4), part.column(5), part.column(0), pa.array([x[0] for x in made], pa.list_(pa.int64())), pa.array([x[1] for x in made], pa.list_(pa.float64())), pa.array([x[2] for x in made], pa.int64())],
                    names=["id", "dim", "v", "shard", "ids", "scores", "verified"],
                )

    return both.mapInArrow(run, _FOUND)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    *,
    k: int = K,
    confidence: float = CONFIDENCE,
    shard_rows: int = SHARD_ROWS,
    block_visits: int = BLOCK_VISITS,
) -> DataFrame:
    """(query_id, rank, <id_col>, score, verified) of the k nearest found to each row that is_query (over a column
    `id`) holds for; verified: how many distinct vectors that query's search compared in full.

    Candidates are the usable rows of the same dimension, but those of the query's own id; fewer than k where there
    are fewer. Rows equal in id and vector are one row; query rows that share an id but not the vector have a ranking
    each. Queries without a usable vector or without candidates have no rows. An empty table gives an empty result.
    """
    base = materialize(usable(vectors, id_col, vec_col).distinct(), "vectors")
    points, index = _indexed(base, k, shard_rows)
    shared = base.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for dim, part in _by_dim(rb):
                cells = shared.value.cell(dim, _matrix(part.column(4), "<f4"))
                turn = part.column(0).to_numpy() % shared.value.shards[cells]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(shared.value.start[cells] + turn, pa.int32())], names=["v", "dim", "ids", "p", "shard"])

    placed = materialize(points.mapInArrow(place, "v binary, dim int, ids array<bigint>, p binary, shard int"), "placed")
    discard(points)
    queries = base.where(is_query).select("id", "dim", "v", F.array().cast("array<double>").alias("known"), F.lit(-1).alias("seen"))
    asked = materialize(_routed(queries, shared, True, confidence, k), "asked")
    near = materialize(_searched(asked, placed, shared, k, confidence, block_visits), "near")
    asked = materialize(_routed(near.select("id", "dim", "v", F.col("scores").alias("known"), F.col("shard").alias("seen")), shared, False, confidence, k), "asked")
    found = near.unionByName(_searched(asked, placed, shared, k, confidence, block_visits)).select("id", F.md5("v").alias("q"), "ids", "scores", "verified")
    one = Window.partitionBy("id", "q")
    each = found.withColumn("verified", F.sum("verified").over(one)).select("id", "q", "verified", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    ranked = each.withColumn("rank", F.row_number().over(one.orderBy(F.desc("x.scores"), "x.ids"))).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("x.ids").alias(id_col), F.col("x.scores").alias("score"), "verified")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, zero and broken vectors take no part; see nearest() for repeated rows and ids."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0)
