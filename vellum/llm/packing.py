"""Best-fit packing of token pieces into sequences, by exact-complement hashing.

Only the histogram of piece lengths (at most `capacity` numbers) reaches the driver. There, for each length from
the greatest down, single lengths, pairs and triples whose sum is exactly the gap are looked up among the lengths
still available and consumed as often as their counts allow; what has no exact complement takes the largest length
that fits, and its smaller gap is looked up again. Each consumption exhausts a length, so the plan's size depends
on `capacity`, not on the data. Pieces then find their place by their rank among those of equal length; ranks are
counted in hashed buckets whose sizes are added up, so a length that a third of the pieces share is spread.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, materialize, table, with_columns_replaced

CAPACITY, END_ID = 1024, 2
TOKENIZER = "byte_bpe_50k"
#: Rows in a rank bucket, and the most buckets there are.
BUCKET_ROWS, MAX_BUCKETS = 2_000, 65_536
#: Units kept by an encoder until its task ends, and the longest that are.
CACHED, CACHED_LENGTH = 60_000, 64
#: Texts that are split into units at a time.
TEXTS = 100
_SHIFT = 40


# ---- tokens


class Encoder:
    """Token ids of whole texts, as bytes (little-endian unsigned 32-bit), equal to those of tokenizers'
    byte-level BPE of the same vocabulary with its added tokens.

    Added tokens' strings are cut out first; each is its token. The pre-tokenizer never joins a character to a space on
    its right, so what lies between is cut before every space that has no white space beside it, into units. Units not
    met before are encoded together, TEXTS texts at a time, and the first CACHED of them are kept until forget().
    """

    def __init__(self, name: str = TOKENIZER, folder: str | None = None, cached: int = CACHED):
        import public_tokenizers as P
        import tiktoken

        path = (lambda x: f"{folder}/{x}") if folder else P.path
        with open(path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding("vellum", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._size[rank] = len(token)
        self._space, self._odd = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s (?:\s|\Z)|  |\A | \Z")
        self._units: dict[str, bytes] = {}
        self._cached = cached
        with open(path(f"{name}.json"), encoding="utf-8") as f:
            added = json.load(f).get("added_tokens", [])
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added):
            raise ValueError("added tokens that are not matched as they stand")
        self._added = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in added}
        strings = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._bpe.encode_ordinary(text), "<u4")

    def _learn(self, units: list[str]) -> None:
        """Encodes new units in one text and cuts its tokens where the units' bytes end."""
        plain = []
        for unit in units:
            if unit and not unit[0].isspace() and not unit[-1].isspace():
                plain.append(unit)
            else:
                self._units[unit] = self._ids(" " + unit).tobytes()
        if not plain:
            return
        ids = self._ids(" " + " ".join(plain))
        ends = np.cumsum(np.fromiter((len(x.encode("utf-8", "surrogatepass")) + 1 for x in plain), np.int64, len(plain)))
        cut = (4 * (np.searchsorted(np.cumsum(self._size[ids]), ends, "right"))).tolist()
        raw, at = ids.tobytes(), 0
        for unit, end in zip(plain, cut, strict=True):
            self._units[unit] = raw[at:end]
            at = end

    def forget(self) -> None:
        """Drops the units kept: the worker that ran a task goes on to others, of other stages too."""
        self._units.clear()

    def batch(self, texts: list[str]) -> list[bytes]:
        return [ids for at in range(0, len(texts), TEXTS) for ids in self._few(texts[at : at + TEXTS])]

    def _few(self, texts: list[str]) -> list[bytes]:
        parts = [self._cut.split(x) if self._cut and self._cut.search(x) else [x] for x in texts]
        if all(len(p) == 1 for p in parts):
            return self._batch(texts)
        found = iter(self._batch([x for p in parts for x in p[::2]]))  # every second one is an added token's string
        return [b"".join(self._added[x] if i % 2 else next(found) for i, x in enumerate(p)) for p in parts]

    def _batch(self, texts: list[str]) -> list[bytes]:
        known = self._units
        split = [self._space.split(x) if self._odd.search(x) else x.split(" ") for x in texts]
        new = list(set().union(*[x[1:] for x in split]) - known.keys())
        self._learn(new)
        get = known.__getitem__
        out = [(self._ids(units[0]).tobytes() if units[0] else b"") + b"".join(map(get, units[1:])) for units in split]
        for unit in new[max(0, len(new) - max(0, len(known) - self._cached)) :]:
            del known[unit]
        for unit in new:
            if len(unit) > CACHED_LENGTH:
                known.pop(unit, None)
        return out


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER, folder: str | None = None) -> Encoder:
    return Encoder(name, folder)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: `capacity` each, the first one the rest."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    name: str = TOKENIZER,
    folder: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids array<bigint>]) for each piece of each row's tokens and end_id.
    A null or empty text is one piece that holds end_id alone. A null id stays null."""
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL(fields).fields])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name, folder)
        try:
            for rb in batches:
                owner, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, raw in enumerate(encode.batch([x or "" for x in rb.column(1).to_pylist()])):
                    raw += end
                    for k, (s, n) in enumerate(cuts(len(raw) // 4, capacity)):
                        part = raw[4 * s : 4 * (s + n)]
                        owner.append(row), piece.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                made = [rb.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
                yield pa.RecordBatch.from_arrays([*made, *([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])], names=schema.names)
        finally:
            encode.forget()

    return docs.select(*columns_of(docs, [id_col, text_col])).mapInArrow(run, schema)


# ---- the plan


class Sums:
    """Single, pair and triple sums of the lengths that are left, by hash of the sum: a pair sum has its pairs, a
    triple sum the lengths that go with a pair sum. Counts only fall, so an entry that no longer holds never will
    again and is dropped when it is met; entries of a sum are made when it is first asked for."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        self.triples: dict[int, list[int]] = {}

    def find(self, gap: int) -> tuple[int, ...] | None:
        """A single length, else a pair, else a triple of available lengths that sums to gap; large ones first."""
        if self.left[gap] > 0:
            return (gap,)
        return self._pair(gap) or self._triple(gap)

    def _holds(self, a: int, b: int, aside: int) -> bool:
        return self.left[a] > (a == b) + (a == aside) and self.left[b] > (a == b) + (b == aside)

    def _pair(self, total: int, aside: int = 0) -> tuple[int, int] | None:
        """aside: a length of which one is not to be used."""
        entries = self.pairs.get(total)
        if entries is None:
            low = np.flatnonzero(self.left[1 : total // 2 + 1] > 0) + 1
            entries = self.pairs[total] = [(total - a, a) for a in low[self.left[total - low] > 0].tolist()[::-1]]
        for i in range(len(entries) - 1, -1, -1):
            a, b = entries[i]
            if self._holds(a, b, aside):
                return a, b
            if not self._holds(a, b, 0):
                del entries[i]
        return None

    def _triple(self, total: int) -> tuple[int, int, int] | None:
        entries = self.triples.get(total)
        if entries is None:
            first = (total + 2) // 3
            entries = self.triples[total] = (np.flatnonzero(self.left[first : max(first, total - 1)] > 0) + first).tolist()
        for i in range(len(entries) - 1, -1, -1):
            a = entries[i]
            if self.left[a] > 0 and (pair := self._pair(total - a, a)):
                return a, *pair
            if not self.left[a] > 0 or not self._pair(total - a):
                del entries[i]
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, how many such sequences)] that uses each length exactly as often as it counts."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} does not fit {capacity}")
        left[length] = n
    out, sums = [], Sums(left)
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            left[length] -= 1
            chosen, gap = [length], capacity - length
            while gap:
                found = sums.find(gap)
                if found is None:
                    fits = np.flatnonzero(left[1 : gap + 1] > 0)
                    if not len(fits):
                        break
                    found = (int(fits[-1]) + 1,)
                for x in found:
                    left[x] -= 1
                    gap -= x
                    chosen.append(x)
            sizes, each = np.unique(chosen, return_counts=True)
            times = 1 + int((left[sizes] // each).min())
            left[sizes] -= each * (times - 1)
            out.append((tuple(sorted(chosen, reverse=True)), times))
    return out


def segments(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their rank among its pieces: for the ranks from `rank` on, the first
    sequence, how many of the length each holds, and the offset of the first. Sorted by (length, rank)."""
    rows, seen, first = [], {}, 0
    for chosen, times in made:
        at = dict(zip(chosen[::-1], list(accumulate((0, *chosen)))[:-1][::-1], strict=True))  # a length's first offset
        for length in at:
            each = chosen.count(length)
            rows.append((length, seen.get(length, 0), first, each, at[length]))
            seen[length] = seen.get(length, 0) + each * times
        first += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return {"key": (cols[0] << _SHIFT) + cols[1], "rank": cols[1], "first": cols[2], "each": cols[3], "offset": cols[4]}


def place(seg: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces."""
    at = np.searchsorted(seg["key"], (length << _SHIFT) + rank, "right") - 1
    local, each = rank - seg["rank"][at], seg["each"][at]
    return seg["first"][at] + local // each, seg["offset"][at] + local % each * length


def pack(pieces: DataFrame, length_col: str = "length", *, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset (bigint): sequences are gapless from offset 0 and hold at most `capacity`.

    pieces is read twice: give a written table. Every row is a piece of its own, repeated rows too. Lengths outside
    1 to capacity are an error, null ones too. Columns named sequence_id or offset are replaced.
    """
    spark = pieces.sparkSession
    names = with_columns_replaced(pieces, ["sequence_id", "offset"])
    cols = [f"c{i}" for i in range(len(names))]
    plain = pieces.select(*columns_of(pieces, names)).toDF(*cols)
    length = cols[names.index(length_col)]
    rows = plain.groupBy(length).count().limit(capacity + 2).collect()
    if any(r[0] is None for r in rows) or len(rows) > capacity:
        raise ValueError(f"lengths must be 1 to {capacity}")
    counts = {int(r[0]): int(r[1]) for r in rows}
    seg = spark.sparkContext.broadcast(segments(plan(counts, capacity)))
    buckets = max(1, min(MAX_BUCKETS, sum(counts.values()) // BUCKET_ROWS))
    order = [F.col(c) for c in cols]
    dealt = plain.withColumn("b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(length).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(length, "b").agg(F.count("*").alias("n"))
        .select(length, "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    )
    ranked = dealt.withColumn("r", F.row_number().over(Window.partitionBy(length, "b").orderBy(*order)))
    ranked = ranked.join(starts, [length, "b"]).select(*order, (F.col("r") - 1 + F.col("o")).alias("r"))
    schema = T.StructType([*plain.schema.fields, *T.StructType.fromDDL("sequence_id bigint, offset bigint").fields])
    at = names.index(length_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n, rank = (rb.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (at, len(names)))
            sequence, offset = place(seg.value, n, rank)
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(names)], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema).toDF(*names, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of packed pieces that carry their ids; at most `capacity` ids a row."""
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.flatten(F.transform(placed, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """token_pieces() and pack() of docs, each row a document."""
    return pack(materialize(token_pieces(docs, id_col, text_col, capacity=capacity, with_ids=with_ids), "pieces"), capacity=capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null or empty text is one piece of the end token; repeated rows are documents of their own."""
    return pack_documents(table(spark, sf_dir, "documents"))
