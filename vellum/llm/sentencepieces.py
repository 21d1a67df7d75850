"""SentencePiece encoding and decoding by suffix-array matching.

A batch's units (a run of word marks and what follows up to the next mark; no piece goes on past one) are joined to one
text, whose suffixes are sorted by as many characters as the longest piece has. Every piece is found in it by binary
search, its occurrences are edges of the text, and the edges are sorted by position. The model at hand is a BPE model:
relaxing its edges by the best sum of scores would not give its segmentation. So edges are relaxed in the model's own
order: of the edges that cover exactly two adjacent symbols, those of the greatest score, from the left, join them,
until none is left. No edge crosses the places that no piece covers, so a text falls there into segments that advance
together, however long its units are; in each, all occurrences of its best piece are joined at once, or only the first
where what it makes could be joined to more before the next one. Symbols that are no piece become bytes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vellum.llm.common import columns_of, table, with_columns_replaced

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Units kept by an encoder, and the longest that are; characters that are indexed at once.
CACHED, CACHED_LENGTH, INDEXED = 300_000, 64, 600_000
_NONE = np.iinfo(np.int64).max


class Pieces:
    """The model's pieces. The library only reads the file here; it encodes nothing."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.names) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scores = np.array([model.get_score(i) for i in plain])
        #: Place of a piece's score among all, the greatest first; equal scores share one.
        self.place = np.zeros(n, np.int64)
        self.place[plain] = np.unique(-scores, return_inverse=True)[1]
        self.ids = {self.names[i]: i for i in plain}
        self.longest = max(map(len, self.ids))
        self.by_length = {}
        for k in range(1, self.longest + 1):
            own = [i for i in plain if len(self.names[i]) == k]
            if own:
                self.by_length[k] = (np.array(own, np.int64), _points("".join(self.names[i] for i in own)).reshape(-1, k))
        #: Places of pieces that are part of a piece of a lesser place: what joins them may be joined to more at once.
        self.hasty = np.zeros(n + 1, bool)
        for name, i in self.ids.items():
            for k in range(1, len(name)):
                if name[:k] in self.ids and name[k:] in self.ids:
                    for part in (name[:k], name[k:]):
                        if len(part) > 1 and self.place[self.ids[part]] >= self.place[i]:
                            self.hasty[self.place[self.ids[part]]] = True
        byte_of = {i: b for b, i in self.bytes.items()}
        known = set(plain)
        self.raw = [bytes([byte_of[i]]) if i in byte_of else b"" if i not in known else p.replace(MARK, " ").encode() for i, p in enumerate(self.names)]
        self.raw[self.unknown] = " ⁇ ".encode()

    def fallback(self, char: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in char.encode("utf-8", "surrogatepass")]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def suffix_array(points: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` (or more) characters, by prefix doubling."""
    n, width = len(points), 1
    _, rank = np.unique(points, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        key = rank * (n + 2)
        key[:-width] += rank[width:]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]) + 1
        width *= 2
    return order


class Edges:
    """Occurrences of all pieces in a text, sorted by position and length, with O(1) access to one of them."""

    def __init__(self, points: np.ndarray, pieces: Pieces):
        order = suffix_array(points, pieces.longest)
        padded = np.concatenate([points, np.full(pieces.longest + 1, -1)])
        packed = [np.empty(0, np.int64)]
        for length, (ids, chars) in pieces.by_length.items():
            low, high = np.zeros(len(ids), np.int64), np.full(len(ids), len(points))
            for j in range(length):
                low = _search(order, padded, j, chars[:, j], low, high, False)
                high = _search(order, padded, j, chars[:, j], low, high, True)
                alive = low < high
                ids, chars, low, high = ids[alive], chars[alive], low[alive], high[alive]
            if len(ids):
                n = high - low
                rows = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                packed.append((order[rows] << 24) | (length << 18) | np.repeat(ids, n))
        edges = np.sort(np.concatenate(packed))
        at = edges >> 24
        self.ids = np.append(edges & 0x3FFFF, 0)
        self.first = np.searchsorted(at, np.arange(len(points)))
        self.lengths = np.zeros(len(points), np.int64)
        size = (edges >> 18) & 63
        np.bitwise_or.at(self.lengths, at, np.int64(1) << size)
        #: For each character, whether some piece covers it and the one before.
        ends = np.zeros(len(points) + 2, np.int64)
        np.add.at(ends, at + 1, 1)
        np.add.at(ends, at + size, -1)
        self.joined = np.cumsum(ends)[: len(points)] > 0

    def get(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The piece that covers each span, -1 where none does."""
        bit = np.where(length < 62, np.int64(1) << np.minimum(length, 62), 0)
        mask = self.lengths[start]
        found = (mask & bit) != 0
        at = self.first[start] + np.bitwise_count(mask & (bit - 1)).astype(np.int64)
        return np.where(found, self.ids[np.where(found, at, 0)], -1)


def _search(order: np.ndarray, padded: np.ndarray, j: int, char: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
    """Within each range of suffixes that agree in j characters, the first one whose next is char or more (or more only)."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        seen = padded[order[np.minimum(mid, len(order) - 1)] + j]
        right = open_ & ((seen <= char) if after else (seen < char))
        low = np.where(right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    return low


class Encoder:
    def __init__(self, path: str, cached: int = CACHED):
        self.pieces = Pieces(path)
        self._known: dict[str, bytes] = {}
        self._cached = cached

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        split = [_units(x) for x in texts]
        new = list(set().union(*split) - self._known.keys())
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (end == at or size + len(new[end]) <= INDEXED):
                size += len(new[end])
                end += 1
            for unit, ids in zip(new[at:end], self._relax(new[at:end]), strict=True):
                self._known[unit] = ids
            at = end
        get = self._known.__getitem__
        out = [b"".join(map(get, units)) for units in split]
        for unit in new[max(0, len(new) - max(0, len(self._known) - self._cached)) :]:
            del self._known[unit]
        for unit in new:
            if len(unit) > CACHED_LENGTH:
                self._known.pop(unit, None)
        return out

    def _relax(self, units: list[str]) -> list[bytes]:
        if not units:
            return []
        text = "".join(units)
        points = _points(text)
        edges = Edges(points, self.pieces)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        first = ~edges.joined
        first[np.cumsum(sizes) - sizes] = True
        start, length, owner = np.arange(len(points)), np.ones(len(points), np.int64), np.cumsum(first)
        place = self.pieces.place
        width = len(points) + 1

        def value(s: np.ndarray, n: np.ndarray) -> np.ndarray:
            found = edges.get(s, n)
            return np.where(found >= 0, place[found] * width + s, _NONE)

        best = np.full(len(start), _NONE)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        best[same] = value(start[same], np.full(len(same), 2))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(start):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(best, heads)
            count = np.diff(np.append(heads, len(start)))
            ended = np.repeat(least == _NONE, count)
            if ended.any():
                done.append((start[ended], length[ended]))
                start, length, owner, best = (x[~ended] for x in (start, length, owner, best))
                if not len(start):
                    break
                count, least = count[least != _NONE], least[least != _NONE]
            piece = least // width
            limit = np.where(self.pieces.hasty[piece], least, piece * width + width - 1)  # the leftmost, or all of the piece
            at = np.flatnonzero(best <= np.repeat(limit, count))
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            of_run = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            at = at[of_run % 2 == 0]  # of overlapping ones every second, from the left
            length[at] += length[at + 1]
            keep = np.ones(len(start), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # a symbol went before each later one
            start, length, owner, best = (x[keep] for x in (start, length, owner, best))
            for left in (at, at[at > 0] - 1):
                left = left[left < len(start)]
                inner = left[(left + 1 < len(start)) & (owner[np.minimum(left + 1, len(start) - 1)] == owner[left])]
                best[left] = _NONE
                best[inner] = value(start[inner], length[inner] + length[inner + 1])
        s, n = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        order = np.argsort(s)
        s, n = s[order], n[order]
        ids = edges.get(s, n)
        which = np.searchsorted(np.cumsum(sizes), s, "right")
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):  # single characters: bytes in their place
            spelled = [self.pieces.fallback(text[i]) for i in s[unknown].tolist()]
            extra = np.ones(len(ids), np.int64)
            extra[unknown] = [len(x) for x in spelled]
            which, ids = np.repeat(which, extra), np.repeat(ids, extra)
            ids[ids < 0] = [b for x in spelled for b in x]
        raw = ids.astype("<u4").tobytes()
        cut = (4 * np.searchsorted(which, np.arange(len(units) + 1))).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes join to characters, the mark put before the text goes."""
        raw = self.pieces.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _units(text: str) -> list[str]:
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " ":
        return re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
    return [MARK + x for x in text.split(" ")]


@lru_cache(maxsize=2)
def encoder(name: str = MODEL, folder: str | None = None) -> Encoder:
    if folder is None:
        import public_tokenizers

        return Encoder(public_tokenizers.path(name))
    return Encoder(f"{folder}/{name}")


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", *, name: str = MODEL, folder: str | None = None) -> DataFrame:
    """docs with the ids of each whole text (array<int>; empty for null and empty texts). A column `out` is replaced."""
    keep = with_columns_replaced(docs, [out])
    frame = docs.select(*columns_of(docs, keep), *columns_of(docs, [text_col])).toDF(*[f"c{i}" for i in range(len(keep) + 1)])
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("made", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(name, folder)
        for rb in batches:
            ids = [np.frombuffer(x, "<i4") for x in work.batch([x or "" for x in rb.column(len(keep)).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

    return frame.mapInArrow(run, schema).toDF(*keep, out)


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "text", *, name: str = MODEL, folder: str | None = None) -> DataFrame:
    """encoded with the text of each row's ids (null ids: ''). A column `out` is replaced."""
    keep = with_columns_replaced(encoded, [out])
    frame = encoded.select(*columns_of(encoded, keep), *columns_of(encoded, [ids_col])).toDF(*[f"c{i}" for i in range(len(keep) + 1)])
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("made", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(name, folder)
        for rb in batches:
            texts = [work.decode(x or []) for x in rb.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], pa.array(texts, pa.string())], names=schema.names)

    return frame.mapInArrow(run, schema).toDF(*keep, out)


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_crc32, text_sha256, round_trip): the ids of each whole text, and its text decoded from them.
    round_trip holds where that is the text itself (word marks in it come back as spaces)."""
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL("n_tokens bigint, ids_crc32 bigint, text_sha256 string, round_trip boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder()
        for rb in batches:
            texts = [x or "" for x in rb.column(1).to_pylist()]
            n, crc, sha, same = [], [], [], []
            for text, raw in zip(texts, work.batch(texts), strict=True):
                back = work.decode(np.frombuffer(raw, "<u4").tolist())
                n.append(len(raw) // 4), crc.append(zlib.crc32(raw)), same.append(back == text.replace(MARK, " "))
                sha.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha), pa.array(same)], names=schema.names)

    return docs.select(*columns_of(docs, [id_col, text_col])).mapInArrow(run, schema)


def op10_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have no ids and come back as ''; repeated rows stay."""
    return encode_digests(table(spark, sf_dir, "documents"))
