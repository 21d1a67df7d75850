"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The model is fitted on a bounded sample of labelled rows: MAX_POSITIVE and MAX_NEGATIVE of the training folds, those
whose ids hash lowest. From them, executors count in how many texts each word and word stem occurs by class and fold,
and the driver gets the LEXICON_SIZE keys with the greatest log odds, which are their weights: once for all folds, and
once without each of them. A training row's features come from the lexicon without its fold, so that words that
only its fold has do not look better than they are. The driver gets those features, a matrix of bounded size.
Scoring reads every whole text once.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, discard, materialize, table, with_columns_replaced

MAX_POSITIVE, MAX_NEGATIVE = 4_000, 6_000
LEXICON_SIZE, MIN_ODDS = 3_000, 3.0
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
TREES, DEPTH, RATE, BINS, MIN_LEAF = 100, 3, 0.15, 48, 20.0
STEMS = (4, 5, 6)
#: Tokens whose codes are kept, in scoring and in fitting; none outlives its task.
_CACHE, _FIT_CACHE = 200_000, 20_000
#: Texts whose keys, of which each has hundreds, are held and sent at a time.
_KEYED_TEXTS = 50

#: Second person, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr "
    "usted ustedes ti tus vosotros".split()
)
#: Signs that stand for letters.
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
_EDGES = re.compile(r"^[^\w@$]+|[^\w]+$")
_INNER = re.compile(r"[\W_]+")

FEATURES = (
    "words_log", "evidence", "evidence_rate", "strongest", "hits", "hits_log", "hit_rate", "hit_kinds", "stem_hits", "stem_rate", "veiled_hits", "veiled_rate",
    "near_second", "near_second_rate", "second_rate", "capital_rate", "shouted_rate", "bang_rate", "punctuation_rate", "digit_rate", "mixed_rate",
)
_WORD, _STEM, _VEILED, _SECOND, _SHOUTED, _MIXED = 1, 2, 4, 8, 16, 32
_HIT = _WORD | _STEM | _VEILED


def _plain(word: str) -> str:
    return _EDGES.sub("", word).lower()


def _unveiled(word: str) -> str:
    """Without accents, inner signs, or signs that stand for letters; runs of three or more letters cut to one."""
    text = unicodedata.normalize("NFKD", word.lower().translate(_LEET))
    return re.sub(r"(.)\1{2,}", r"\1", _INNER.sub("", "".join(c for c in text if not unicodedata.combining(c))))


class Features:
    """Dense features of texts, given the weights of words, and of stems of STEMS letters."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], cached: int = _CACHE):
        self.words, self.stems, self.cached = words, stems, cached
        self.codes: dict[str, int] = {}

    def weight(self, token: str) -> float:
        """The greatest weight of a token's word, stems, and unveiled word."""
        word = _plain(token)
        return max([self.words.get(word, 0.0), self.words.get(_unveiled(token), 0.0), *[self.stems.get(word[:n], 0.0) for n in STEMS]])

    def _code(self, token: str) -> int:
        word, out = _plain(token), 0
        if word in self.words:
            out |= _WORD
        elif any(word[:n] in self.stems for n in STEMS if len(word) >= n):
            out |= _STEM
        mixed = bool(word) and not word.isalpha() and any(c.isalpha() for c in word) and _INNER.sub("", word) != word or any(c.isdigit() for c in word[1:]) and any(c.isalpha() for c in word)
        if mixed:
            out |= _MIXED
        if not out & _HIT and word and (mixed or not word.isascii() or re.search(r"(.)\1\1", word)):
            bare = _unveiled(token)
            if bare != word and bare in self.words:
                out |= _VEILED
        if word in SECOND_PERSON:
            out |= _SECOND
        if len(word) > 1 and token.isupper():
            out |= _SHOUTED
        if len(self.codes) < self.cached:
            self.codes[token] = out
        return out

    def one(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        tokens = (text or "").split()
        n, size = len(tokens), max(1, len(raw))
        if not n:
            return [0.0] * len(FEATURES)
        known = self.codes.get
        codes = np.fromiter([c if (c := known(t)) is not None else self._code(t) for t in tokens], np.uint8, n)
        count = np.bincount(codes, minlength=64)
        of = lambda bit: int(count[_WITH[bit]].sum())
        words, stems, veiled, second = of(_WORD), of(_STEM), of(_VEILED), of(_SECOND)
        hits, near, kinds, evidence, strongest = words + veiled, 0, 0, 0.0, 0.0
        if hits + stems:
            at = np.flatnonzero(codes & _HIT)
            weights = [self.weight(t) for t in {tokens[i] for i in at}]
            kinds, evidence, strongest = len(weights), sum(weights), max(weights)
            if second:
                you = np.flatnonzero(codes & _SECOND)
                k = np.searchsorted(you, at)
                gap = np.minimum(np.abs(at - you[np.minimum(k, len(you) - 1)]), np.abs(at - you[np.maximum(k - 1, 0)]))
                near = int((gap <= 5).sum())
        kept = lambda drop: size - len(raw.translate(None, drop))
        per = 100.0 / n
        return [
            math.log1p(n), evidence, evidence / math.log2(n + 2), strongest, float(hits), math.log1p(hits), hits * per, float(kinds), float(stems), stems * per, float(veiled), veiled * per,
            float(near), near * per, second * per, kept(_UPPER) / size, of(_SHOUTED) / n, kept(b"!?") / size, kept(_PUNCTUATION) / size,
            kept(b"0123456789") / size, of(_MIXED) / n,
        ]


_WITH = {b: np.flatnonzero(np.arange(64) & b) for b in (_WORD, _STEM, _VEILED, _SECOND, _SHOUTED, _MIXED)}
_UPPER = bytes(range(65, 91))
_PUNCTUATION = b"\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"


# ---- trees


class Boosted:
    """Boosted regression trees of equal depth on binned features, logistic loss."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, min_leaf: float = MIN_LEAF):
        self.n, self.depth, self.rate, self.bins, self.min_leaf = trees, depth, rate, bins, min_leaf

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)
        mean = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
        self.base = math.log(mean / (1 - mean))
        raw, nodes = np.full(len(y), self.base), 2**self.depth
        self.feature, self.cut, self.leaf = (np.zeros((self.n, nodes - 1), np.int64), np.full((self.n, nodes - 1), np.inf), np.zeros((self.n, nodes)))
        for t in range(self.n):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            where = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first = 2**level - 1
                nxt = where * 2
                for k in range(2**level):
                    own = where == k
                    if found := self._split(binned[own], grad[own], hess[own]):
                        j, b = found
                        self.feature[t, first + k], self.cut[t, first + k] = j, self.edges[j][b]
                        nxt[own] += binned[own, j] > b
                where = nxt
            g, h = np.bincount(where, grad, nodes), np.bincount(where, hess, nodes)
            self.leaf[t] = self.rate * g / (h + 1.0)
            raw += self.leaf[t][where]
        return self

    def _split(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int] | None:
        best, found, gs, hs = 1e-3, None, grad.sum(), hess.sum()
        if len(grad) < 2 * self.min_leaf:
            return None
        for j, edges in enumerate(self.edges):
            if not len(edges):
                continue
            size = len(edges) + 1
            n, g, h = (np.cumsum(np.bincount(binned[:, j], w, size))[:-1] for w in (None, grad, hess))
            gain = g * g / (h + 1) + (gs - g) ** 2 / (hs - h + 1) - gs * gs / (hs + 1)
            gain[(n < self.min_leaf) | (len(grad) - n < self.min_leaf)] = 0
            b = int(gain.argmax())
            if gain[b] > best:
                best, found = gain[b], (j, b)
        return found

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for t in range(self.n):
            where = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2**level - 1 + where
                where = where * 2 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.leaf[t][where]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw, probability) of the non-decreasing fit, by pooling adjacent violators; each pool is shrunk
    towards the mean by one row."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, least and greatest raw
    for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        pools.append([v, 1.0, r, r])
        while len(pools) > 1 and (pools[-2][3] >= pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    mean = float(y.mean()) if len(y) else 0.5
    xs, ps = [], []
    for s, n, low, high in pools:
        p = (s + mean) / (n + 1)
        for at in {low, high}:
            xs.append(at), ps.append(p)
    order = np.argsort(xs, kind="stable")
    return np.array(xs)[order], np.maximum.accumulate(np.array(ps)[order])


class Model:
    def __init__(self, words: dict[str, float], stems: dict[str, float], trees: Boosted, knots: tuple[np.ndarray, np.ndarray]):
        self.words, self.stems, self.trees, self.knots = words, stems, trees, knots

    @property
    def features(self) -> Features:
        if not hasattr(self, "_features"):
            self._features = Features(self.words, self.stems)
        return self._features

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_features"}

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features.one(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return np.interp(self.trees.raw(x), *self.knots)


# ---- fitting


def fold(id_column: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """(text, y, fold) of the labelled training rows whose ids hash lowest, up to the documented numbers. Of rows that
    share an id, that of the least text hash is taken; an id with both labels is a row of each."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
    known = known.withColumn("fold", fold(F.col("id"))).where(F.col("fold") != HELD_OUT).withColumn("h", F.xxhash64("id"))
    pick = lambda y, n: known.where(F.col("y") == y).orderBy("h", "id").limit(n)
    chosen = pick(1, MAX_POSITIVE).unionByName(pick(0, MAX_NEGATIVE)).drop("h")
    chosen = materialize(chosen, "chosen")  # at most MAX_POSITIVE + MAX_NEGATIVE rows of three numbers
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen.distinct()), "id")
    least = F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text"))
    found = found.groupBy("id", "y", "fold").agg(least["text"].alias("text"))
    return materialize(found.select("text", F.col("y").cast("double").alias("y"), "fold"), "sample")


def lexicons(rows: DataFrame) -> dict[int | None, tuple[dict[str, float], dict[str, float]]]:
    """Weights of words and of stems: under None those of all folds, under a fold those of the others.

    A weight is the log of the ratio of a key's shares of positive and of negative texts, less one standard error; keys
    of a ratio of MIN_ODDS or more are kept. Near copies count once: of the texts that share the least hash of their
    five-word shingles, each key counts once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in (b.slice(at, _KEYED_TEXTS) for b in batches for at in range(0, b.num_rows, _KEYED_TEXTS)):
            ids, keys, ys, folds = [], [], [], []
            for text, y, own_fold in zip(*[rb.column(i).to_pylist() for i in range(3)], strict=True):
                every = (text or "").split()
                words = {w for t in set(every) if 2 < len(w := _plain(t)) and w.isalpha()}
                if not words:
                    continue
                own = words | {f"{w[:n]}-" for w in words for n in STEMS if len(w) >= n}
                least = min(xxhash.xxh3_64_intdigest(" ".join(every[i : i + 5])) for i in range(max(1, len(every) - 4))) - 2**63
                ids += [least] * len(own)
                keys += own
                ys += [int(y)] * len(own)
                folds += [int(own_fold)] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(ys, pa.int32()), pa.array(folds, pa.int32())], names=["copy", "key", "y", "fold"]
            )

    counted = rows.select("text", "y", "fold").mapInArrow(count, "copy bigint, key string, y int, fold int").distinct()
    total = {(int(r["y"]), int(r["fold"])): r["count"] for r in rows.groupBy("y", "fold").count().collect()}
    training = [f for f in range(FOLDS) if f != HELD_OUT]
    cells = [F.sum(((F.col("y") == y) & (F.col("fold") == f)).cast("int")).alias(f"n{y}_{f}") for y in (0, 1) for f in training]
    # A key of one text is none: it is not shuffled to the end.
    grouped = materialize(counted.groupBy("key").agg(F.sum("y").alias("pos"), *cells).where(F.col("pos") >= 2), "keys")
    out = {}
    for without in (None, *training):
        used = [f for f in training if f != without]
        pos, neg = (sum((F.col(f"n{y}_{f}") for f in used[1:]), F.col(f"n{y}_{used[0]}")) + 0.5 for y in (1, 0))
        of = lambda y: sum(total.get((y, f), 0) for f in used) + 1.0  # noqa: B023, E731
        ratio = F.log(pos / of(1)) - F.log(neg / of(0)) - F.sqrt(1 / pos + 1 / neg)
        top = grouped.select("key", pos.alias("pos"), ratio.alias("w")).where((F.col("pos") > 2) & (F.col("w") >= math.log(MIN_ODDS)))
        found = {r["key"]: r["w"] for r in top.orderBy(F.desc("w"), "key").limit(LEXICON_SIZE).collect()}
        out[without] = {k: w for k, w in found.items() if k[-1] != "-"}, {k[:-1]: w for k, w in found.items() if k[-1] == "-"}
    discard(grouped)
    return out


def fit(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the training folds' labels. Without a positive and a negative row every score is 0."""
    rows = sample(docs, labels, label_col, id_col, text_col)
    every = lexicons(rows)
    words, stems = every[None]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = {f: Features(*pair, _FIT_CACHE) for f, pair in every.items()}
        for rb in batches:
            x = [features[f].one(t) for t, f in zip(rb.column(0).to_pylist(), rb.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), rb.column(1), rb.column(2)], names=["x", "y", "fold"])

    made = rows.select("text", "y", "fold").mapInArrow(make, T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), rows.schema["y"], rows.schema["fold"]])).collect()
    discard(rows)
    made.sort(key=lambda r: (r["x"], r["y"]))  # rows come in any order; sums then do not
    x = np.array([r["x"] for r in made]).reshape(len(made), len(FEATURES))
    y, own = np.array([r["y"] for r in made]), np.array([r["fold"] for r in made])
    if not len(y) or y.min() == y.max():
        return Model(words, stems, Boosted(trees=0).fit(np.zeros((1, len(FEATURES))), np.zeros(1)), (np.array([0.0, 1.0]), np.zeros(2)))
    held = own == CALIBRATION
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held = np.zeros(len(y), bool)
    trees = Boosted().fit(x[~held], y[~held])
    at = held if held.any() else ~held
    return Model(words, stems, trees, isotonic(trees.raw(x[at]), y[at]))


def score(docs: DataFrame, model: Model, text_col: str = "text", *, keep: list[str] | None = None) -> DataFrame:
    """docs with score (double, 0 to 1). Null and empty texts are scored as texts without words. A column named
    score is replaced."""
    keep = with_columns_replaced(docs, ["score"]) if keep is None else keep
    frame = docs.select(*columns_of(docs, keep), *columns_of(docs, [text_col])).toDF(*[f"c{i}" for i in range(len(keep) + 1)])
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = shared.value
        for rb in batches:
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], pa.array(model_.score(rb.column(len(keep)).to_pylist()))], names=schema.names)
        model_.features.codes.clear()  # the worker that ran this task goes on to others

    return frame.mapInArrow(run, schema).toDF(*keep, "score")


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, columns as they are, that score under threshold."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    names = docs.columns
    scored = score(docs.toDF(*[f"c{i}" for i in range(len(names))]), model, f"c{names.index(text_col)}")
    return scored.where(F.col("score") < threshold).drop("score").toDF(*names)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts are scored as texts without words; a row without an id is not held out; repeated rows stay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
