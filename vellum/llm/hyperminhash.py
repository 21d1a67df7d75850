r"""MinHash near-duplicates by HyperMinHash registers.

A document's shingles are 64-bit hashes. Their first byte says the register; of each register's least hash the number
of leading zeros (6 bits) and the 10 bits behind the first one are kept. Bands of ROWS registers, empty ones filled
from others in a fixed order, make a document's keys: two sets of a Jaccard index of 0.85 share none of the BANDS keys
with a chance of about 10^-9. Pairs that share one are estimated from the registers, less the collisions that compression makes;
an estimate that sampling explains with a chance of no more than 10^-9 ends a pair there, all others are confirmed on full sets.

Groups of copies: equal sets are one unit before any key is made. Units of a key meet its least and greatest one (by an
order that changes with each turn), which joins dense clusters without their pairs. Of what is then still apart, units
of different components are compared that share a rare shingle, or a key if they can link without their rare ones. Before that each unit counts its shingles that no other unit has: it can share no more than the rest, which leaves out
texts of a common passage or a much changed copy without a look at their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, discard, materialize, spread_join, table
from vellum.llm.components import connected_components

SHINGLE, PERCENT = 3, 85
REGISTERS, BANDS, ROWS = 256, 36, 5
EMPTY = 0xFFFF
_ZEROS, _MANTISSA = 48, 10
#: Minus the logarithm of the chance at which an estimate ends a pair.
CERTAINTY = 20.7
#: Turns of least and greatest members before what is left is compared by its rare shingles.
TURNS = 2
#: Units that a rare shingle has at most.
RARE = 128
#: Units whose full sets are fetched by a broadcast of their digests (16 bytes each); more are joined.
MAX_BROADCAST = 500_000
_DIGEST = ["d1", "d2"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of x reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mixed(np.arange(1, 10, dtype=np.uint64)) | np.uint64(1)
#: Which full register stands in for an empty one: the one of its least number.
_STAND_IN = _mixed(np.arange(REGISTERS * REGISTERS, dtype=np.uint64)).reshape(REGISTERS, REGISTERS)


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles; fewer words than `width` are one shingle, none are none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and exactly \x20 \x09-\x0D
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out += own[k : len(words) - size + 1 + k] * _FACTORS[k]
    return np.unique(_mixed(out))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a sorted set of hashes; EMPTY where no hash falls."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if len(hashes):
        at = (hashes >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        rest = (hashes[first] >> np.uint64(8)) & np.uint64((1 << _ZEROS) - 1)
        fraction, exponent = np.frexp(rest.astype(np.float64))  # 48 bits are exact
        mantissa = np.maximum((fraction * 2 - 1) * (1 << _MANTISSA), 0).astype(np.int64)
        out[at[first]] = (_ZEROS - exponent) << _MANTISSA | mantissa
    return out


def band_keys(own: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys of registers that are not all empty."""
    full, empty = np.flatnonzero(own != EMPTY), np.flatnonzero(own == EMPTY)
    dense = own.copy()
    if len(empty):
        dense[empty] = own[full[_STAND_IN[empty][:, full].argmin(1)]]
    rows = dense[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key * _FACTORS[k] + rows[:, k] + np.uint64(1))
    return key.view(np.int64)


@lru_cache(4_096)
def _collisions(eighths_n: int, eighths_m: int) -> float:
    """The chance that a register of two sets without a common hash is equal, by eighths of their sizes' binary logarithms."""
    zeros, parts = np.arange(_ZEROS)[:, None], 1 << _MANTISSA
    low = 2.0 ** -(zeros + 1) * (1 + np.arange(parts)[None, :] / parts)
    high = low + 2.0 ** -(zeros + 1) / parts
    cell = lambda n: np.exp(n * np.log1p(-low / REGISTERS)) - np.exp(n * np.log1p(-high / REGISTERS))
    return float((cell(2 ** (eighths_n / 8)) * cell(2 ** (eighths_m / 8))).sum())


def jaccard(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of pairs (rows of registers, and set sizes), less expected collisions, and the registers each rests on."""
    either = ((a != EMPTY) | (b != EMPTY)).sum(1)
    equal = ((a == b) & (a != EMPTY)).sum(1)
    size = lambda x: np.round(np.log2(np.maximum(x, 1)) * 8).astype(int).tolist()
    chance = np.array([_collisions(*sorted(x)) for x in zip(size(n), size(m), strict=True)])
    share = equal / np.maximum(either, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), either


def may_link(estimate: np.ndarray, either: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """False where an estimate is so far below that links give it with a chance of exp(-CERTAINTY) at most (Chernoff's bound)."""
    t, p = percent / 100, np.clip(estimate, 1e-12, 1 - 1e-12)
    away = p * np.log(p / t) + (1 - p) * np.log((1 - p) / (1 - t)) if t < 1 else np.where(estimate < 1, np.inf, 0)
    return (estimate >= t) | (away * either < CERTAINTY)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE) -> DataFrame:
    """(id, n, d1, d2, sketch) for every row: set size, 128-bit digest of the set, registers (of a set that has any)."""
    frame = docs.select(*columns_of(docs, [id_col, text_col])).toDF("id", "t")
    schema = T.StructType([frame.schema["id"], *T.StructType.fromDDL("n bigint, d1 bigint, d2 bigint, sketch binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n, digests, made = [], [], []
            for text in rb.column(1).to_pylist():
                hashes = shingle_hashes(text, width)
                n.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                made.append(registers(hashes).tobytes() if len(hashes) else b"")
            d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array(made, pa.binary())], names=schema.names)

    return frame.mapInArrow(run, schema)


def full_sets(docs: DataFrame, text_col: str, wanted: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(uid, hashes) of the wanted units (uid, d1, d2), from the texts: a set once a task, then once a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for rb in batches:
            kept = []
            for text in rb.column(0).to_pylist():
                hashes = shingle_hashes(text, width).tobytes()
                digest = xxhash.xxh3_128_digest(hashes)
                if hashes and digest not in seen:
                    seen.add(digest)
                    kept.append((digest, hashes))
            if len(seen) > 1_000_000:
                seen.clear()
            d = np.frombuffer(b"".join(k[0] for k in kept), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array([k[1] for k in kept], pa.binary())], names=["d1", "d2", "hashes"])

    every = docs.select(*columns_of(docs, [text_col])).mapInArrow(run, "d1 bigint, d2 bigint, hashes binary")
    few = wanted.count() <= MAX_BROADCAST
    return every.join(F.broadcast(wanted) if few else wanted, _DIGEST).select("uid", "hashes").dropDuplicates(["uid"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, n, sketch) to (key, uid, n)."""
    for rb in batches:
        own = np.frombuffer(b"".join(rb.column(2).to_pylist()), np.uint16).reshape(-1, REGISTERS)
        keys = np.concatenate([np.empty(0, np.int64), *map(band_keys, own)])
        uid, n = (np.repeat(np.asarray(rb.column(i)), BANDS) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(uid), pa.array(n)], names=["key", "uid", "n"])


def _estimated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            a, b = (np.frombuffer(b"".join(rb.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (4, 5))
            stay = pa.array(may_link(*jaccard(a, b, np.asarray(rb.column(2)), np.asarray(rb.column(3))), percent))
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(stay), rb.column(1).filter(stay)], names=["a", "b"])

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            stay = []
            for x, y in zip(rb.column(2), rb.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                stay.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(stay, pa.bool_())
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(mask), rb.column(1).filter(mask)], names=["a", "b"])

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(uid, hashes) to (uid, hash)."""
    for rb in batches:
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in rb.column(1)]
        uid = np.repeat(np.asarray(rb.column(0)), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(np.concatenate([np.empty(0, np.int64), *sets]))], names=["uid", "hash"])


def common_shingles(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """units (uid, n) with s, how many of their shingles some other unit has too. Two sets share no more than the
    lesser s: units whose s is too small for any link are left out."""
    once = sets.mapInArrow(_exploded, "uid bigint, hash bigint").groupBy("hash").agg(F.count("*").alias("of"), F.min("uid").alias("uid")).where(F.col("of") == 1)
    own = once.groupBy("uid").agg(F.count("*").alias("alone"))
    told = units.join(own, "uid", "left").withColumn("s", F.col("n") - F.coalesce("alone", F.lit(0)))
    return told.where(100 * F.col("s") >= percent * F.col("n")).select("uid", "n", "s")


class _Links:
    """Links between units (uid, n, sketch) that leave their components as all links would."""

    def __init__(self, units: DataFrame, percent: int, turns: int):
        self.percent, self.turns = percent, turns
        own = units.where(F.col("n") * (100 - percent) >= percent)  # smaller sets link with equal ones only
        self.keys = materialize(own.select("uid", "n", "sketch").mapInArrow(_keyed, "key bigint, uid bigint, n bigint"), "keys")
        self.members = self._shared(self.keys)
        self.units = materialize(own.join(self.members.select("uid").distinct(), "uid"), "compared")
        self.edges: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def _shared(self, rows: DataFrame) -> DataFrame:
        """Rows with a key that more than one of them has."""
        many = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
        return materialize(rows.join(many, "key"), "members")

    def found(self, sets: DataFrame) -> DataFrame:
        """The links, over the full sets (uid, hashes) of self.units."""
        common = common_shingles(self.units.select("uid", "n"), sets, self.percent)
        self.members = self._shared(self.members.join(common.select("uid", "s"), "uid"))
        for turn in range(self.turns):
            told, size = self._told("key"), F.col("size")
            few, full = self._apart(told, size <= 3), self._apart(told, size > 3)
            if not self._compare([self._outside(told, few), self._pivots(told, full, turn)], sets):
                return self._all()
            self.members = materialize(told.join(full.select("key"), "key").select("key", "uid", "n", "s"), "members")
        told = self._told("key")
        left = materialize(told.join(self._apart(told, F.lit(True)).select("key"), "key"), "left")
        rare, rest = self._by_rare_shingles(left, sets)
        self._compare([self._outside(rare, self._apart(rare, F.lit(True))), self._outside(rest, self._apart(rest, F.lit(True)), once=True)], sets)
        return self._all()

    def _all(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.edges)

    def _told(self, key: str) -> DataFrame:
        """The members with their components (c)."""
        if self.roots is None:
            return self.members.withColumn("c", F.col("uid"))
        rows = self.members.join(self.roots.withColumnRenamed("node", "uid"), "uid", "left")
        return materialize(rows.select(key, "uid", "n", "s", F.coalesce("root", "uid").alias("c")), "told")

    @staticmethod
    def _apart(told: DataFrame, where) -> DataFrame:
        """(key, main: its largest component) of the keys that several components meet at."""
        parts = told.groupBy("key", "c").agg(F.count("*").alias("n_of"))
        stats = parts.groupBy("key").agg(F.sum("n_of").alias("size"), F.max_by("c", F.struct("n_of", "c")).alias("main"), F.count("*").alias("parts"))
        return stats.where((F.col("parts") > 1) & where).select("key", "main")

    @staticmethod
    def _outside(told: DataFrame, keys: DataFrame, once: bool = False) -> DataFrame:
        """Pairs of the members outside a key's largest component with the members of other ones. once: told has all
        keys of each unit, and a pair is made at the least one that it shares only."""
        more = ["keys"] if once else []
        other = told.select("key", F.col("uid").alias("b"), F.col("n").alias("m"), F.col("s").alias("t"), F.col("c").alias("d"), *[F.col("keys").alias("others")][: len(more)])
        apart = F.col("c") != F.col("d")
        if once:
            apart &= F.array_min(F.array_intersect("keys", "others")) == F.col("key")
        return told.join(keys, "key").where("c <> main").select("key", "uid", "n", "s", "c", *more).join(other, "key").where(apart)

    @staticmethod
    def _pivots(told: DataFrame, keys: DataFrame, turn: int) -> DataFrame:
        """Pairs of a key's members with its least and its greatest one, by an order of this turn."""
        full = told.join(keys.select("key"), "key")
        by = F.struct(F.xxhash64("uid", F.lit(turn)), "uid", "n", "s", "c")
        pivots = full.groupBy("key").agg(F.array(F.min(by), F.max(by)).alias("pivots"))
        others = F.filter("pivots", lambda p: p["c"] != F.col("c"))
        met = full.join(pivots, "key").select("uid", "n", "s", F.explode(others).alias("p"))
        return met.select("uid", "n", "s", F.col("p.uid").alias("b"), F.col("p.n").alias("m"), F.col("p.s").alias("t"))

    def _by_rare_shingles(self, left: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows (key, uid, n, s, c) of two kinds of keys that give all links of the units in `left` between them: shingles
        that at most RARE of the units have, and the keys of old, of units that can link without any of these.

        Shingles are in one order, rarest first. Two sets whose first common shingle is this one share no more than
        what either has from it on, which is its row's s: a pair that links is asked for at its first one at least, and a
        shingle that comes after too many others makes no pair."""
        units = left.select("uid", "n", "s", "c").distinct()
        flat = materialize(sets.join(units.select("uid"), "uid").select("uid", "hashes").mapInArrow(_exploded, "uid bigint, hash bigint"), "flat")
        few = flat.groupBy("hash").agg(F.count("*").alias("of")).where(F.col("of") <= RARE)
        rare = materialize(flat.join(few, "hash"), "rare")
        own = rare.groupBy("uid").agg(F.count("*").alias("rare"))
        at = F.row_number().over(Window.partitionBy("uid").orderBy("of", "hash"))
        first = rare.withColumn("at", at).where("of > 1").join(units, "uid").withColumn("s", F.least("s", F.col("n") - F.col("at") + 1))
        rows = first.where(100 * F.col("s") >= self.percent * F.col("n")).select(F.col("hash").alias("key"), "uid", "n", "s", "c")
        rest = left.join(own, "uid", "left").withColumn("s", F.least("s", F.col("n") - F.coalesce("rare", F.lit(0)))).drop("rare")
        rest = rest.where(100 * F.col("s") >= self.percent * F.col("n"))
        every = self.keys.join(rest.select("uid").distinct(), "uid").groupBy("uid").agg(F.array_sort(F.collect_list("key")).alias("keys"))
        return rows, rest.join(every, "uid").select("key", "uid", "n", "s", "c", "keys")

    def _compare(self, asked: list[DataFrame], sets: DataFrame) -> bool:
        """Adds the links of the asked pairs, and joins components; False if no pair was asked for."""
        n, both = F.col("n") + F.col("m"), F.least("s", "t")  # no two sets share more
        near = (100 * F.least("n", "m") >= self.percent * F.greatest("n", "m")) & (100 * both >= self.percent * (n - both))
        rows = reduce(DataFrame.unionByName, [x.select("uid", "b", "n", "m", "s", "t") for x in asked])
        pairs = rows.where(near).select(F.least("uid", "b").alias("a"), F.greatest("uid", "b").alias("b")).distinct()
        pairs = materialize(pairs, "pairs")
        self.edges.append(self._linked(pairs, sets))
        if not pairs.limit(1).count():
            return False
        self.roots = materialize(connected_components(self._all()), "roots")
        return True

    def _linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        of = lambda frame, side, *names: frame.select(F.col("uid").alias(side), *[F.col(n).alias(f"{n}_{side}") for n in names])
        rows = pairs.join(of(self.units, "a", "n", "sketch"), "a").join(of(self.units, "b", "n", "sketch"), "b")
        rows = rows.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_estimated(self.percent), "a bigint, b bigint")
        likely = materialize(rows, "likely")
        both = likely.join(of(sets, "a", "hashes"), "a").join(of(sets, "b", "hashes"), "b").select("a", "b", "hashes_a", "hashes_b")
        return materialize(both.mapInArrow(_confirmed(self.percent), "a bigint, b bigint"), "links")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = PERCENT, width: int = SHINGLE, turns: int = TURNS
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs.

    component_id is the smallest id among the documents that links (a Jaccard index of `percent` hundredths or more)
    reach, itself included; kept says that it is the row's own. Texts without words, null and empty ones too, have no
    shingles and link with nothing, not even with each other. A null id takes part; a component without any id has
    the id null. Repeated rows stay, each with its own row.
    """
    prints = materialize(sketches(docs, id_col, text_col, width), "prints")
    some = prints.where("n > 0")
    units = some.groupBy(*_DIGEST).agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    units = materialize(units.withColumn("uid", F.monotonically_increasing_id()), "units")
    links = _Links(units, percent, turns)
    sets = materialize(full_sets(docs, text_col, links.units.select("uid", *_DIGEST), width), "sets")
    edges = links.found(sets) if links.members.limit(1).count() else docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    roots = connected_components(edges)
    of = units.select("uid", *_DIGEST, "least").join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    named = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(named, "root").select(*_DIGEST, "component_id")
    told = spread_join(some.select("id", "n", *_DIGEST), of, _DIGEST, "id").select("id", "n", "component_id")
    alone = prints.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    every = told.unionByName(alone)
    return every.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without words, null ones too, link with nothing; repeated rows stay."""
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
  SELECT DISTINCT d, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT d, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, least(len(w), 1)) + 1)) AS i FROM docs)
), size AS (
  SELECT d, count(*) AS n FROM shingle GROUP BY d
), many AS (
  SELECT s FROM shingle GROUP BY s HAVING count(*) > 1
), shared AS (
  SELECT d, s FROM shingle SEMI JOIN many USING (s)
), link AS (
  SELECT a.d AS a, b.d AS b FROM shared a JOIN shared b ON a.s = b.s AND a.d <> b.d JOIN size x ON x.d = a.d JOIN size y ON y.d = b.d
  GROUP BY a.d, b.d, x.n, y.n HAVING 100 * count(*) >= {PERCENT} * (x.n + y.n - count(*))
), reach AS (
  SELECT d, d AS r FROM docs UNION SELECT reach.d, link.b FROM reach JOIN link ON link.a = reach.r
), least AS (
  SELECT reach.d, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.d = reach.r GROUP BY reach.d
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN least ON least.d = docs.d LEFT JOIN size ON size.d = docs.d
"""
