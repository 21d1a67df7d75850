"""Quality by regularised quadratic discriminant analysis of transformed document statistics.

Each text is read once, for its statistics. Class means and covariances are sums over all labelled training rows,
added up in the cluster; the driver gets 2 x (1 + d + d x d) numbers. Covariances are shrunk towards their diagonal,
and that towards its mean; scores are the difference of the two log densities, with the Cholesky factors kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, materialize, table

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
SHRINK, RIDGE = 0.1, 0.02
STATS = (
    "words_log", "word_length", "distinct", "top_share", "repeat", "sign_rate", "sentence_rate", "capital_rate", "shouted",
    "digit_rate", "marked_ends", "bars", "line_length", "line_repeat", "common",
)
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'")


def statistics(text: str | None) -> list[float]:
    """Transformed statistics: logs of counts and square roots of rates, so that a few odd words in a clean text
    weigh little and no text is far out for its length alone. Without words all are 0."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    size = len(raw)
    count = lambda chars: size - len(raw.translate(None, chars))
    letters = max(1, count(_LETTERS))
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = raw.split(b"\n")
    root = math.sqrt
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in kinds) / len(kinds)
    upper = sum(w.isupper() and len(w) > 1 for w in kinds) / len(kinds)
    return [
        math.log1p(n), math.log(size / n), math.log(len(kinds)) / math.log(n + 1), root(max(kinds.values()) / n), root(same / n), root(count(_SIGNS) / size), root(count(b".,") / size),
        root(count(_UPPER) / letters), root(upper), root(count(b"0123456789") / size), root(marked), root(kinds.get(b"|", 0) / n), math.log1p(size / len(lines)),
        root(1 - len(set(lines)) / len(lines)), root(sum(v for w, v in kinds.items() if len(w) <= 3) / n),
    ]


class Discriminant:
    """Means, Cholesky factors and log priors of the two classes."""

    def __init__(self, counts: list[float], sums: list[np.ndarray], squares: list[np.ndarray], shrink: float = SHRINK, ridge: float = RIDGE):
        self.means, self.factors, self.offsets = [], [], []
        total = sum(counts)
        pooled = sum(q - np.outer(s, s) / max(n, 1) for n, s, q in zip(counts, sums, squares, strict=True)) / max(total, 1)
        scale = np.maximum(np.diag(pooled), 1e-6)
        for n, s, q in zip(counts, sums, squares, strict=True):
            mean = s / max(n, 1)
            cov = (q - n * np.outer(mean, mean)) / max(n - 1, 1)
            weight = shrink + (1 - shrink) * len(mean) / (n + len(mean))  # small classes are shrunk more
            cov = (1 - weight) * cov + weight * np.diag(np.maximum(np.diag(cov), 0))
            cov += ridge * np.diag(scale)
            factor = np.linalg.cholesky(cov)
            self.means.append(mean)
            self.factors.append(np.linalg.inv(factor))
            self.offsets.append(math.log((n + 1) / (total + 2)) - np.log(np.diag(factor)).sum())

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        logs = [o - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, o in zip(self.means, self.factors, self.offsets, strict=True)]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def fold(id_column: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) for every row."""
    schema = T.StructType([docs.schema[id_col], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([statistics(t) for t in rb.column(1).to_pylist()], pa.list_(pa.float64()))], names=schema.names)

    return docs.select(*columns_of(docs, [id_col, text_col])).mapInArrow(run, schema)


def fit(stats: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id") -> Discriminant:
    """From every labelled row of the training folds. A class without rows has the moments of none."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & (fold(F.col("id")) != HELD_OUT))
    rows = stats.select(F.col(id_col).alias("id"), "x").join(known, "id").select("y", "x")
    d = len(STATS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 + d + d * d))
        for rb in batches:
            y = rb.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = rb.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for c in (0, 1):
                own = x[y == c]
                held[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        if held.any():
            yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(list(held), pa.list_(pa.float64()))], names=["y", "m"])

    summed = rows.mapInArrow(moments, "y int, m array<double>").select("y", F.posexplode("m").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((2, 1 + d + d * d))
    for r in summed:
        m[r["y"], r["i"]] = r["v"]
    return Discriminant([m[c, 0] for c in (0, 1)], [m[c, 1 : d + 1] for c in (0, 1)], [m[c, d + 1 :].reshape(d, d) for c in (0, 1)])


def score(stats: DataFrame, model: Discriminant, id_col: str = "doc_id") -> DataFrame:
    """(id, score) for every row of with_statistics()."""
    schema = T.StructType([stats.schema[id_col], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            x = rb.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(model.score(x))], names=schema.names)

    return stats.select(id_col, "x").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, score) for every row of docs, repeated and null rows too; a null or empty text has the statistics of none."""
    stats = materialize(with_statistics(docs, id_col, text_col), "stats")
    return score(stats, fit(stats, labels, label_col=label_col, id_col=id_col), id_col)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have the statistics of none; a row without an id is not held out; repeated rows stay."""
    scored = classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
