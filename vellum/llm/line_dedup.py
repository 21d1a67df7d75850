"""Line dedup over levelled sorted runs of line hashes.

A run is a bucketed table of (k1, k2, n_docs), sorted by the 128-bit hash of a line's key. Each new batch is
merge-anti-joined with the runs: its unseen lines are its own run, at level 0; its seen lines are counts that add to
the rows they have already. When a level holds `fanout` runs they are compacted into one run of the next level.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, discard, drop_table, materialize, sorted_table, stored_order, table, unsorted, with_columns_replaced

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 1, 10
FANOUT = 3
#: Documents of a batch and batches at least; rows of a batch in a bucket and buckets at least.
BATCH_DOCS, LEAST_BATCHES, BUCKET_LINES, LEAST_BUCKETS = 50_000_000, 3, 250_000, 6
#: Up to so many frequent lines (16 bytes each) go to the executors as one set; beyond it they are joined.
MAX_BROADCAST_LINES = 200_000
_FLUSH = 100_000
_KEYS = ["k1", "k2"]


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """16-byte digest of each line's key, None for keys of fewer than min_chars code points."""
    digest = xxhash.xxh3_128_digest
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
        key = line.strip(SPACE)
        short = not key if min_chars == 1 else len(key) < min_chars or len(key.decode("utf-8", "surrogatepass")) < min_chars
        out.append(None if short else digest(key))
    return out


def _split(digests: list[bytes]) -> list[pa.Array]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))]


def line_counts(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = LEAST_BATCHES) -> DataFrame:
    """(batch, k1, k2, n_docs): documents that hold each line, combined within each task before any shuffle.
    Each row of docs is a document; its batch is a hash of its text."""
    schema = T.StructType.fromDDL("batch int, k1 bigint, k2 bigint, n_docs bigint")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter] = [Counter() for _ in range(batches)]

        def flush(b: int) -> pa.RecordBatch:
            keys, n = list(held[b]), list(held[b].values())
            held[b].clear()
            return pa.RecordBatch.from_arrays([pa.array([b] * len(n), pa.int32()), *_split(keys), pa.array(n, pa.int64())], names=schema.names)

        for rb in rows:
            for text in rb.column(0).to_pylist():
                b = xxhash.xxh32_intdigest((text or "").encode("utf-8", "surrogatepass")) % batches
                found = set(line_keys(text, min_chars))
                found.discard(None)
                held[b].update(found)
                if len(held[b]) >= _FLUSH:
                    yield flush(b)
        yield from (flush(b) for b in range(batches) if held[b])

    return docs.select(*columns_of(docs, [text_col])).mapInArrow(run, schema)


class LineRuns:
    """Runs of lines and of their later counts, each a bucketed table sorted by hash.

    A line's first row is in one run only: a batch's lines that no run has (the anti-join) start there, those that some
    run has go to a run of counts. A line's documents are thus those of its first row and those that its counts add up
    to. When a level has `fanout` runs they are compacted into one of the next level. All tables have the same buckets,
    one sorted file each, so that merges read them in their stored order: no exchange, no sort.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int = 8):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.lines: list[list[DataFrame]] = []
        self.counts: list[list[DataFrame]] = []

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of the batch whose line no run has."""
        for run in _flat(self.lines):
            batch = batch.join(run.select("k1", "k2").hint("merge"), _KEYS, "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Takes a batch's (k1, k2, n_docs); a line may have several rows there."""
        grouped = batch.repartition(self.buckets, *_KEYS).groupBy(*_KEYS).agg(F.sum("n_docs").alias("n_docs"))
        with stored_order(self.spark):
            whole = self._write(grouped, dealt=True)
            if not self.lines:
                self._put(self.lines, whole)
                return
            fresh = self._write(self.unseen(whole), dealt=True)
            seen = self._write(whole.join(fresh.select(*_KEYS).hint("merge"), _KEYS, "left_anti"), dealt=True)
            drop_table(whole)
            self._put(self.lines, fresh)
            self._put(self.counts, seen)

    def _write(self, rows: DataFrame, dealt: bool = False) -> DataFrame:
        return sorted_table(rows, "run", _KEYS, self.buckets, dealt=dealt)

    def _put(self, levels: list[list[DataFrame]], run: DataFrame) -> None:
        for level in range(len(levels) + 1):
            if level == len(levels):
                levels.append([])
            levels[level].append(run)
            if len(levels[level]) < self.fanout:
                return
            run, levels[level] = self._compacted(levels[level], levels is self.counts), []

    def _compacted(self, runs: list[DataFrame], add_up: bool) -> DataFrame:
        rows = reduce(DataFrame.unionByName, map(unsorted, runs)).repartition(self.buckets, *_KEYS)
        made = self._write(rows.groupBy(*_KEYS).agg(F.sum("n_docs").alias("n_docs")) if add_up else rows, dealt=True)
        for run in runs:
            drop_table(run)
        return made

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(k1, k2) of the lines in min_docs documents or more."""
        later = _flat(self.counts)
        if len(later) > 1:
            with stored_order(self.spark):
                later = [self._compacted(later, True)]
            self.counts = [later]
        found = self.spark.createDataFrame([], "k1 bigint, k2 bigint")
        for run in _flat(self.lines):
            total = F.col("n_docs")
            if later:
                run = run.join(later[0].select(*_KEYS, F.col("n_docs").alias("later")).hint("merge"), _KEYS, "left")
                total = total + F.coalesce("later", F.lit(0))
            found = found.unionByName(run.where(total >= min_docs).select(*_KEYS))
        return found

    def close(self) -> None:
        for run in [*_flat(self.lines), *_flat(self.counts)]:
            drop_table(run)
        self.lines, self.counts = [], []


def _flat(levels: list[list[DataFrame]]) -> list[DataFrame]:
    return [run for level in levels for run in level]


def frequent_lines(docs: DataFrame, text_col: str = "text", *, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int | None = None, fanout: int = FANOUT) -> DataFrame:
    """(k1, k2) of the line keys found in min_docs documents or more, written. batches: as many as BATCH_DOCS asks for,
    LEAST_BATCHES at least."""
    spark = docs.sparkSession
    batches = batches or max(LEAST_BATCHES, -(-docs.count() // BATCH_DOCS))
    counts = materialize(line_counts(docs, text_col, min_chars, batches), "lines", partition_by="batch")
    runs = LineRuns(spark, fanout, max(LEAST_BUCKETS, -(-counts.count() // (batches * BUCKET_LINES))))
    for b in range(batches):
        runs.add(counts.where(F.col("batch") == b))
    with stored_order(spark):
        found = materialize(runs.frequent(min_docs), "frequent")
    runs.close()
    discard(counts)
    return found


def _kept(text: str | None, hot, min_chars: int) -> tuple[str, int, int]:
    lines = (text or "").split("\n")
    if not hot:
        return text or "", len(lines), 0
    kept = [x for x, key in zip(lines, line_keys(text, min_chars), strict=True) if key not in hot]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame,
    text_col: str = "text",
    *,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int | None = None,
    fanout: int = FANOUT,
    keep: list[str] | None = None,
    digest: bool = False,
    max_broadcast: int = MAX_BROADCAST_LINES,
) -> DataFrame:
    """docs with `text_col` rid of every line whose key is in min_docs documents or more, and n_lines, n_dropped
    (bigint). keep: the other columns to carry (all); digest: kept_sha256 in place of the text.

    Every row is a document, repeated rows too. A null or empty text is one empty line and comes back as ''.
    Columns named like an added one are replaced. The set of frequent lines is broadcast up to max_broadcast
    lines; a larger one is joined to each text's lines, spread by line and then by text.
    """
    out = "kept_sha256" if digest else text_col
    keep = with_columns_replaced(docs, [text_col, out, "n_lines", "n_dropped"]) if keep is None else keep
    hot = frequent_lines(docs, text_col, min_docs=min_docs, min_chars=min_chars, batches=batches, fanout=fanout)
    # Own names from here on, so that no column of docs clashes with one.
    frame = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(columns_of(docs, keep))], columns_of(docs, [text_col])[0].alias("t"))
    rows = hot.limit(max_broadcast + 1).collect()
    shared = None
    if len(rows) <= max_broadcast:
        known = frozenset(struct.pack("<qq", r["k1"], r["k2"]) for r in rows)
        shared = docs.sparkSession.sparkContext.broadcast(known)
    else:
        frame = _with_hot(frame, hot, min_chars)
    schema = T.StructType([*frame.schema.fields[: len(keep)], *T.StructType.fromDDL("t string, n_lines bigint, n_dropped bigint").fields])

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches_:
            texts = rb.column(len(keep)).to_pylist()
            sets = [shared.value] * len(texts) if shared else [{struct.pack("<qq", k["k1"], k["k2"]) for k in x or ()} for x in rb.column(len(keep) + 1).to_pylist()]
            found = [_kept(t, s, min_chars) for t, s in zip(texts, sets, strict=True)]
            first = [hashlib.sha256(x[0].encode("utf-8", "surrogatepass")).hexdigest() if digest else x[0] for x in found]
            yield pa.RecordBatch.from_arrays(
                [*rb.columns[: len(keep)], pa.array(first, pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())],
                names=schema.names,
            )

    return frame.mapInArrow(run, schema).toDF(*keep, out, "n_lines", "n_dropped")


def _with_hot(frame: DataFrame, hot: DataFrame, min_chars: int) -> DataFrame:
    """frame (text column t last) with the digests of each text's frequent lines. Equal texts have equal lines, so
    lines are joined once a text; a text that many rows hold is a skewed key of the last join, which AQE splits."""
    schema = T.StructType.fromDDL("h string, k1 bigint, k2 bigint")

    def lines(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches_:
            for text in dict.fromkeys(x or "" for x in rb.column(0).to_pylist()):
                if found := list({k for k in line_keys(text, min_chars) if k}):
                    h = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                    yield pa.RecordBatch.from_arrays([pa.array([h] * len(found)), *_split(found)], names=schema.names)

    text = F.coalesce("t", F.lit(""))
    held = frame.select(text.alias("t")).mapInArrow(lines, schema).distinct().join(hot, _KEYS, "left_semi")
    hot_of = held.groupBy("h").agg(F.collect_list(F.struct(*_KEYS)).alias("hot"))
    left = frame.withColumn("own", F.sha2(text.cast("binary"), 256))
    return left.join(hot_of, left["own"] == hot_of["h"], "left").drop("own", "h")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null or empty text is one empty line; repeated rows are documents of their own and stay."""
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return found.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


SQL = r"""
WITH lines AS (
  SELECT d, doc_id, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line
  FROM (SELECT row_number() OVER () AS d, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), hot AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT d) >= 10
), marked AS (
  SELECT keyed.*, hot.k IS NOT NULL AS drop FROM keyed LEFT JOIN hot ON keyed.k = hot.k
)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(drop) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT drop), '')) AS kept_sha256
FROM marked GROUP BY d, doc_id
"""
