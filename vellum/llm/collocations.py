r"""Phrase collocations from suffix automata of shards.

Documents are dealt to shards of about SHARD_WORDS words of one language, each with its own word list. Two exact prunings
come first: a phrase of `least` occurrences holds only words and neighbouring pairs of as many, so words are counted,
then pairs of frequent words, both summed over shards; each shard gets back its own frequent ones only, never a list of
all. What is left of a shard are runs of words joined by frequent pairs. A generalised suffix automaton
of the distinct runs, weighted by how often each occurs, has the endpos count of every substring: those of 2 to 5 words
are read off its states and summed over shards. A candidate's suffix link (itself without its first word) and the
mirrored link lead from a longer candidate to those it may subsume.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import columns_of, discard, materialize, table

LEAST, WORDS, TOP = 100, 5, 2_000
SHARD_WORDS = 1 << 20
#: Parts of a language that are ranked on their own before its ranks.
RANK_PARTS = 64
#: Groups that words, pairs and phrases are dealt to, at least.
LEAST_GROUPS = 64
#: Breaks between pieces become full stops, tabs blanks.
_BYTES = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"." * 9 + b" ")


#: Factors of up to 15 digits: their products are exact in 38.
SCORE = "(cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"


class SuffixAutomaton:
    """Generalised suffix automaton of weighted sequences: equal substrings have one state, whose count is the weight
    of all places that they end at."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.counts = [-1], [0], [0]
        self.ends: list[tuple] = [((), 0)]  # a sequence and a place in it where the state's substrings end

    def _state(self, length: int, ends: tuple, copied: int | None = None) -> int:
        self.next.append({} if copied is None else self.next[copied].copy())
        self.link.append(0 if copied is None else self.link[copied])
        self.length.append(length)
        self.counts.append(0)
        self.ends.append(ends)
        return len(self.length) - 1

    def _target(self, p: int, word) -> int:
        """The state of p's longest substring and word behind it, where p has that transition."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.ends[q], q)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: tuple, weight: int = 1) -> None:
        last = 0
        for at, word in enumerate(sequence):
            if word in self.next[last]:
                last = self._target(last, word)
            else:
                new, p = self._state(self.length[last] + 1, (sequence, at + 1)), last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                self.link[new] = 0 if p < 0 else self._target(p, word)
                last = new
            self.counts[last] += weight

    def substrings(self, least: int, most: int) -> Iterator[tuple[tuple, int]]:
        """Each distinct substring of least to most words with its occurrences, once all sequences are in."""
        total = self.counts.copy()
        for s in sorted(range(1, len(total)), key=self.length.__getitem__, reverse=True):
            total[self.link[s]] += total[s]
        for s in range(1, len(total)):
            sequence, end = self.ends[s]
            for n in range(max(least, self.length[self.link[s]] + 1), min(most, self.length[s]) + 1):
                yield sequence[end - n : end], total[s]


def tokens(text: str | None) -> list[bytes]:
    """A text's words with b'.' between pieces: A-Z in lower case, pieces cut at .,;:!? and line ends, words at blanks and tabs."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_BYTES)
    return raw.replace(b".", b" . ").split()


def shards(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, lang, size, words, counts, tokens): tokens are `size` places in words from 1, 0 a break, packed. A task closes a
    shard with the document that fills it, or its largest one once all it holds are four times as long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 24)
        held: dict[str, tuple[defaultdict, list[np.ndarray]]] = {}
        size: Counter = Counter()

        def close(lang: str) -> pa.RecordBatch:
            places, parts = held.pop(lang)
            size.pop(lang)
            ids = np.concatenate(parts)
            n = np.bincount(ids, minlength=len(places))[1:]
            words = [w.decode("utf-8", "replace") for w in places][1:]
            row = [next(numbers)], [lang], [len(ids)], [words], [n.tolist()], [_packed(ids)]
            kinds = pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["shard", "lang", "size", "words", "counts", "tokens"])

        for rb in batches:
            for lang, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                lang = "und" if lang is None else lang
                if lang not in held:
                    held[lang] = (defaultdict(count(1).__next__, {b".": 0}), [])
                found = tokens(text)
                found.append(b".")
                held[lang][1].append(np.fromiter(map(held[lang][0].__getitem__, found), np.int32, len(found)))
                size[lang] += len(found)
                if size[lang] >= shard_words:
                    yield close(lang)
                elif size.total() >= 4 * shard_words:
                    yield close(size.most_common(1)[0][0])
        for lang in list(held):
            yield close(lang)

    schema = "shard bigint, lang string, size bigint, words array<string>, counts array<bigint>, tokens binary"
    return docs.select(*columns_of(docs, [lang_col, text_col])).mapInArrow(run, schema)


def _packed(values: np.ndarray) -> bytes:
    """Sorted or small whole numbers: differences, byte by byte of all, compressed."""
    return pa.compress(np.diff(values, prepend=np.int64(0)).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, 8 * n, "zstd", asbytes=True) if n else b""
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view("<i8").reshape(n))


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group's number and places, in their order."""
    order = np.argsort(group, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if len(part):
            yield int(group[part[0]]), part


def _words(groups: int):
    """(group, shard, lang, size, bytes, words, places, counts): each shard's own words, dealt by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                names = [w.encode("utf-8", "surrogatepass") for w in rb.column("words")[i].values.to_pylist()]
                n = np.asarray(rb.column("counts")[i].values) if names else np.empty(0, np.int64)
                group = np.fromiter((zlib.crc32(w) % groups for w in names), np.int64, len(names))
                for g, at in _by_group(group):
                    text = b"\n".join([names[k] for k in at.tolist()])
                    row = [g], [rb.column("shard")[i].as_py()], [rb.column("lang")[i].as_py()], [len(at)], [len(text)], [pa.compress(text, "zstd", asbytes=True)], [_packed(at + 1)], [_packed(n[at])]
                    kinds = pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["group", "shard", "lang", "size", "bytes", "words", "places", "counts"])

    return run


def _frequent_words(least: int, groups: int):
    """Of one group's words, those that have `least` occurrences in all: once each as (lang, phrase, a), and for each
    shard its own ones as (shard, size, places, numbers). A word's number is its own in all groups and languages."""

    def run(rows: pa.Table) -> pa.Table:
        here, total = rows.to_pylist(), defaultdict(Counter)
        listed = [pa.decompress(r["words"], r["bytes"], "zstd", asbytes=True).split(b"\n") for r in here]
        for r, names in zip(here, listed, strict=True):
            counts = total[r["lang"]]
            for word, n in zip(names, _unpacked(r["counts"], r["size"]).tolist(), strict=True):
                counts[word] += n
        frequent = [(lang, w, n) for lang, counts in total.items() for w, n in counts.items() if n >= least]
        out = [(None, None, None, None, lang, w.decode("utf-8", "replace"), n) for lang, w, n in frequent]
        numbers: dict[str, dict[bytes, int]] = defaultdict(dict)
        for k, (lang, w, _) in enumerate(frequent):
            numbers[lang][w] = k * groups + here[0]["group"]
        for r, names in zip(here, listed, strict=True):
            own = numbers[r["lang"]]
            of = np.fromiter((own.get(w, -1) for w in names), np.int64, len(names))
            place = _unpacked(r["places"], r["size"])[of >= 0]
            if len(place):
                out.append((r["shard"], len(place), _packed(place), _packed(of[of >= 0]), None, None, None))
        kinds = (("shard", pa.int64()), ("size", pa.int64()), ("places", pa.binary()), ("numbers", pa.binary()), ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()))
        return pa.table({n: pa.array([x[k] for x in out], t) for k, (n, t) in enumerate(kinds)})

    return run


def _known(rb: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (sorted) and numbers of the frequent words in one row's shard."""
    parts = rb.column("known")[i].as_py()
    place, word = (np.concatenate([_unpacked(x[name], x["size"]) for x in parts]) for name in ("places", "numbers"))
    order = np.argsort(place)
    return place[order], word[order]


def _frequent_ids(rb: pa.RecordBatch, i: int, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One row's tokens as the numbers of its frequent words, -1 for breaks and all other words."""
    ids = _unpacked(rb.column("tokens")[i].as_py(), rb.column("size")[i].as_py())
    to = np.full(max(int(ids.max(initial=0)), int(places.max(initial=0))) + 1, -1, np.int64)
    to[places] = numbers
    return to[ids]


def _codes(ids: np.ndarray) -> np.ndarray:
    """For each place but the last, its pair of neighbours as one number, -1 unless both are frequent words."""
    return np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] << 32 | ids[1:], -1)


def _pairs(groups: int):
    """(group, shard, size, codes, counts): the pairs of neighbours that are both frequent words, counted in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                place, word = _known(rb, i)
                codes, n = np.unique(_codes(_frequent_ids(rb, i, word, place)), return_counts=True)
                codes, n = (x[np.searchsorted(codes, 0) :] for x in (codes, n))
                mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
                parts = [(g, len(at), _packed(codes[at]), _packed(n[at])) for g, at in _by_group((mixed % np.uint64(groups)).astype(np.int64))]
                g, size, packed, counts = zip(*parts, strict=True) if parts else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g, pa.int32()), pa.array([rb.column("shard")[i].as_py()] * len(g), pa.int64()), pa.array(size, pa.int64()), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())],
                    names=["group", "shard", "size", "codes", "counts"],
                )

    return run


def _frequent_pairs(least: int):
    """Of one group's pairs, each shard's own ones that have `least` occurrences in all: (shard, size, codes)."""

    def run(rows: pa.Table) -> pa.Table:
        sizes = rows["size"].to_pylist()
        unpack = lambda name: [_unpacked(x, n) for x, n in zip(rows[name].to_pylist(), sizes, strict=True)]
        codes = np.concatenate(unpack("codes"))
        _, at = np.unique(codes, return_inverse=True)
        total = np.zeros(at.max() + 1, np.int64)
        np.add.at(total, at, np.concatenate(unpack("counts")))
        kept = [c[f] for c, f in zip(*[np.split(x, np.cumsum(sizes)[:-1]) for x in (codes, total[at] >= least)], strict=True)]
        out = [(s, len(c), _packed(c)) for s, c in zip(rows["shard"].to_pylist(), kept, strict=True) if len(c)]
        return pa.table({n: pa.array([x[k] for x in out], t) for k, (n, t) in enumerate((("shard", pa.int64()), ("size", pa.int64()), ("codes", pa.binary())))})

    return run


def runs(ids: np.ndarray, joined: np.ndarray) -> Counter:
    """How often each run of ids occurs whose neighbours are all joined; single ones are left out."""
    edge = np.diff(np.concatenate([[0], joined.astype(np.int8), [0]]))
    found: Counter = Counter()
    listed = ids.tolist()
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        found[tuple(listed[a : b + 1])] += 1
    return found


def _phrases(most: int, groups: int):
    """(group, lang, size, phrases, counts): the phrases of each shard's automaton, sorted and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for i in range(rb.num_rows):
                place, word = _known(rb, i)
                held = np.sort(np.concatenate([_unpacked(x["codes"].as_py(), x["size"].as_py()) for x in rb.column("held")[i]]))
                own = _codes(_frequent_ids(rb, i, word, place))
                joined = held[np.minimum(np.searchsorted(held, own), len(held) - 1)] == own
                local = _frequent_ids(rb, i, np.arange(len(place)), place)
                automaton = SuffixAutomaton()
                for sequence, weight in runs(local, joined).items():
                    automaton.add(sequence, weight)
                names = [w.encode("utf-8", "surrogatepass") for w in rb.column("words")[i].values.take(pa.array(place - 1)).to_pylist()]
                found = sorted((b" ".join([names[w] for w in x]), n) for x, n in automaton.substrings(2, most))
                del automaton
                group = np.fromiter((zlib.crc32(x) % groups for x, _ in found), np.int64, len(found))
                for g, at in _by_group(group):
                    mine = [found[k] for k in at.tolist()]
                    text = b"\n".join([x for x, _ in mine])
                    row = [g], [rb.column("lang")[i].as_py()], [len(mine)], [len(text)], [pa.compress(text, "zstd", asbytes=True)], [_packed(np.array([n for _, n in mine], np.int64))]
                    kinds = pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["group", "lang", "size", "bytes", "phrases", "counts"])

    return run


def _frequent_phrases(least: int):
    """(lang, phrase, a) of one group's phrases with `least` occurrences in all."""

    def run(rows: pa.Table) -> pa.Table:
        total: dict[str, Counter] = defaultdict(Counter)
        for r in rows.to_pylist():
            counts, of = total[r["lang"]], _unpacked(r["counts"], r["size"]).tolist()
            for phrase, n in zip(pa.decompress(r["phrases"], r["bytes"], "zstd", asbytes=True).split(b"\n"), of, strict=True):
                counts[phrase] += n
        out = [(lang, p.decode("utf-8", "replace"), n) for lang, counts in total.items() for p, n in counts.items() if n >= least]
        return pa.table({n: pa.array([x[k] for x in out], t) for k, (n, t) in enumerate((("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())))})

    return run


def phrase_counts(cut: DataFrame, least: int = LEAST, most: int = WORDS) -> DataFrame:
    """(lang, phrase, a) of all phrases of 1 to `most` words with at least `least` occurrences. cut: shards(), written.

    Words, pairs and phrases are dealt to groups by their hash, as one compressed row for each shard and group, and a
    group is summed in one task; there are as many groups as the words ask for, so a group stays as small as a shard."""
    groups = max(LEAST_GROUPS, -(-(cut.agg(F.sum("size")).first()[0] or 0) // SHARD_WORDS))
    dealt = cut.select("shard", "lang", "words", "counts").mapInArrow(_words(groups), "group int, shard bigint, lang string, size bigint, bytes bigint, words binary, places binary, counts binary")
    told = dealt.groupBy("group").applyInArrow(_frequent_words(least, groups), "shard bigint, size bigint, places binary, numbers binary, lang string, phrase string, a bigint")
    told = materialize(told, "words")
    known = told.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("size", "places", "numbers")).alias("known"))
    known = materialize(known, "known")
    pairs = cut.select("shard", "size", "tokens").join(known, "shard").mapInArrow(_pairs(groups), "group int, shard bigint, size bigint, codes binary, counts binary")
    frequent = pairs.groupBy("group").applyInArrow(_frequent_pairs(least), "shard bigint, size bigint, codes binary")
    held = materialize(frequent.groupBy("shard").agg(F.collect_list(F.struct("size", "codes")).alias("held")), "held")
    rows = cut.select("shard", "size", "tokens", "lang", "words").join(known, "shard").join(held, "shard")
    phrases = rows.mapInArrow(_phrases(most, groups), "group int, lang string, size bigint, bytes bigint, phrases binary, counts binary")
    found = phrases.groupBy("group").applyInArrow(_frequent_phrases(least), "lang string, phrase string, a bigint")
    out = materialize(told.where("shard is null").select("lang", "phrase", "a").unionByName(found), "phrases")
    for done in (told, known, held):
        discard(done)
    return out


def _size(phrase: str) -> Column:
    return F.size(F.split(phrase, " "))


def without_subsumed(candidates: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, a) without those inside a longer one that occurs as often. A phrase between two such
    occurs as often too, so links of one word (the suffix link and the mirrored one) reach all of them."""
    links = F.array(F.expr("substring_index(phrase, ' ', size(split(phrase, ' ')) - 1)"), F.expr("substring_index(phrase, ' ', 1 - size(split(phrase, ' ')))"))
    inside = candidates.where(_size("phrase") > 2).select("lang", F.explode(links).alias("phrase"), "a").distinct()
    return candidates.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, least: int = LEAST, most: int = WORDS, top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first `top` phrases of 2 to `most` words.

    n counts a language's words, a, l and r the phrase and the parts of its lowest-scoring cut (ties: the first cut),
    score is floor(1000 * a * n / (l * r)). Phrases have `least` occurrences and lie in no longer one that occurs as
    often. Ranks go by score, then a, both descending, then by phrase. A null language is `und`; null and empty texts
    have no words; every row is a text of its own, repeated rows too. An empty table gives no rows.
    """
    cut = materialize(shards(docs, lang_col, text_col, shard_words), "shards")
    counted = phrase_counts(cut, least, most)
    total = cut.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("n"))
    kept = without_subsumed(counted.where(F.instr("phrase", " ") > 0))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), _size("phrase") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - size(split(phrase, ' ')))"))
    part = lambda side, out: counted.select("lang", F.col("phrase").alias(side), F.col("a").alias(out))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(total, "lang")
    least_cut = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr(SCORE).alias("score"), "k", "l", "r")).alias("s"), F.first("a").alias("a"), F.first("n").alias("n"))
    rows = least_cut.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts have no words, a null language is `und`; repeated rows count."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), piece AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM docs
), place AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece
), part AS (
  SELECT lang, unnest(range(1, least({WORDS}, len(w) - i + 1) + 1)) AS size, i, w FROM place
), f AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS a FROM part GROUP BY ALL HAVING count(*) >= {LEAST}
), total AS (
  SELECT lang, count(*) AS n FROM place GROUP BY lang
), kept AS (
  SELECT * FROM f p WHERE size > 1 AND NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = p.lang AND q.a = p.a AND q.size > p.size AND contains(concat(' ', q.phrase, ' '), concat(' ', p.phrase, ' ')))
), cut AS (
  SELECT *, array_to_string(string_split(phrase, ' ')[:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT cut.lang, cut.phrase, cut.a, l.a AS l, r.a AS r, n, k, CAST(1000::HUGEINT * cut.a * n // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y JOIN total ON total.lang = cut.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= {TOP}
"""
