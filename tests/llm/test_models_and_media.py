"""Packing, neighbours, classifiers, media, language and pieces: brute force, round trips and held-out accuracy."""

import hashlib
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vellum.llm import language_id, media, neighbours, packing, quality, sentencepieces, toxicity

# ---- packing

TEXTS = [
    None, "", " ", "a\n \nb", " foo", "foo ", "foo \n", "a  b", "it's we'll  x", "\n\n x", "<|endoftext|> a", "é  b", "\x1c \x1d a", "日本 語", "a" * 5_000 + " b", "word " * 3_000, "  x  y", "x  y",
]


def test_ids_are_those_of_tokenizers(spark):
    import public_tokenizers

    told = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(6)
    odd = list("ab  é\n日😀'.1\x1c\u00a0\t") + ["<|endoftext|>", "'s", " the"]
    texts = [*TEXTS, "first <|endoftext|> second", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext| >", "z" * 100_000, " " * 50_000 + "x  " * 50]
    texts += ["".join(rng.choice(odd, rng.integers(0, 40))) for _ in range(500)]
    want = [told.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[len(TEXTS)] == [11085, 220, 50256, 1218]
    for cached in (0, 1_000):
        own = packing.Encoder(cached=cached)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in own.batch([t or "" for t in texts])] == want
    rows = packing.token_pieces(spark.createDataFrame(list(enumerate(texts[:20])), "doc_id bigint, text string").where("doc_id = 18"), capacity=100, with_ids=True).collect()
    assert rows[0].ids == [11085, 220, 50256, 1218, 2]


def fewest(lengths, capacity):
    """The least number of sequences, by trying every one."""
    best = len(lengths)

    def go(i, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if i == len(lengths):
            best = len(loads)
            return
        for j in range(len(loads)):
            if loads[j] + lengths[i] <= capacity and loads[j] not in loads[:j]:
                go(i + 1, [*loads[:j], loads[j] + lengths[i], *loads[j + 1 :]])
        go(i + 1, [*loads, lengths[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_plans_are_near_the_best_there_is(lengths):
    made = sum(times for _, times in packing.plan(Counter(lengths), 20))
    best = fewest(sorted(lengths, reverse=True), 20)
    assert best <= made <= best + 1


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 3), max_size=12), st.lists(st.tuples(st.integers(1, 30), st.integers(1, 40)), max_size=25))
def test_sums_find_a_combination_exactly_where_there_is_one(counts, steps):
    from itertools import combinations

    left = np.zeros(41, np.int64)
    for length, n in counts.items():
        left[length] = n
    sums = packing.Sums(left)
    for used, gap in steps:
        every = [x for x in range(1, 41) for _ in range(left[x])]
        found = sums.find(gap)
        exists = any(sum(c) == gap for k in (1, 2, 3) for c in combinations(every, k))
        assert (found is not None) == exists
        if found:
            assert sum(found) == gap and all(left[x] >= n for x, n in Counter(found).items())
        left[used] = max(0, left[used] - 1)


def test_pack_keeps_columns_of_any_name(spark):
    names = ["b", "r", "o", "n", "c0", "__b", "__r", "__o", "sequence_id", "offset"]
    pieces = spark.createDataFrame([(600, *range(10)), (424, *range(10)), (10, *range(10))], "length bigint, " + ", ".join(f"`{n}` int" for n in names))
    rows = packing.pack(pieces).collect()
    assert all([r[n] for n in names[:8]] == list(range(8)) for r in rows) and sorted((r.length, r.offset) for r in rows) == [(10, 0), (424, 600), (600, 0)]
    assert len({r.sequence_id for r in rows}) == 2 and len(rows[0]) == 11


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 50), max_size=30))
def test_plan_uses_each_length_as_often_as_it_counts(counts):
    made = packing.plan(counts, 60)
    used = Counter()
    for lengths, times in made:
        assert sum(lengths) <= 60 and times > 0
        for x in lengths:
            used[x] += times
    assert used == Counter(counts)
    length = np.concatenate([np.full(n, k) for k, n in counts.items()] or [np.empty(0, np.int64)]).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in counts.values()] or [np.empty(0, np.int64)]).astype(np.int64)
    if not len(length):
        return
    rows = pd.DataFrame(dict(zip(["s", "o"], packing.place(packing.segments(made), length, rank), strict=True))).assign(n=length).sort_values(["s", "o"])
    assert ((rows.groupby("s").n.cumsum() - rows.n) == rows.o).all() and rows.s.nunique() == sum(t for _, t in made)


def test_exact_complements_come_first():
    assert packing.plan({700: 2, 324: 1, 200: 1, 124: 1}, 1024) == [((700, 324), 1), ((700, 200, 124), 1)]
    assert packing.plan({}, 10) == []
    assert packing.cuts(2_500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cuts(2_048, 1024) == [(0, 1024), (1024, 1024)] and packing.cuts(1, 1024) == [(0, 1)]


def test_an_encoder_holds_few_texts_and_forgets_with_its_task(spark, monkeypatch):
    """What a task leaves in its worker adds to the memory of the stages after it."""
    own, sizes, split = packing.Encoder(), [], packing.Encoder._batch
    monkeypatch.setattr(packing.Encoder, "_batch", lambda self, texts: sizes.append(len(texts)) or split(self, texts))
    texts = [f"w{i} x{i % 7} y" for i in range(1_000)]
    assert own.batch(texts) == [own._ids(t).tobytes() for t in texts] and sum(sizes) == 1_000 and max(sizes) <= 100
    own.forget()
    assert not own._units

    def left(batches):
        import pyarrow as pa

        for rb in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(packing.encoder()._units)] * rb.num_rows, pa.int64())], names=["n"])

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    assert packing.token_pieces(docs).count() == 1_000
    kept = [r["n"] for r in spark.range(0, 64, 1, 8).mapInArrow(left, "n bigint").collect()]
    assert set(kept) == {0}


def test_toxicity_lexicons_send_few_texts_at_a_time(spark):
    """A batch of 1,000 texts has a million keys."""
    rows = spark.createDataFrame([(" ".join(f"k{chr(97 + i % 26)}{chr(97 + j)}zz" for j in range(20)), float(i % 2), 1 + i % 4) for i in range(400)], "text string, y double, fold int")
    made, real = [], type(rows).mapInArrow

    def kept(self, f, schema, *a, **b):
        made.append(f)
        return real(self, f, schema, *a, **b)

    type(rows).mapInArrow = kept
    try:
        toxicity.lexicons(rows)
    finally:
        type(rows).mapInArrow = real
    out = list(made[0](iter(rows.toArrow().combine_chunks().to_batches())))
    assert sum(b.num_rows for b in out) == 400 * 20 * 3 and max(b.num_rows for b in out) <= 100 * 20 * 3


def test_packing(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS * 3)] + [(None, "x", 5)], "doc_id bigint, text string, length int")
    packed = packing.pack_documents(docs, with_ids=True)
    rows = packed.toPandas().sort_values(["sequence_id", "offset"])
    assert ((rows.groupby("sequence_id").length.cumsum() - rows.length) == rows.offset).all() and rows.groupby("sequence_id").length.sum().max() <= 1024
    total = rows.length.sum()
    assert rows.sequence_id.nunique() <= -(-total // 1024) + 1
    own = packing.encoder()
    for i, part in rows[rows.doc_id.notna()].sort_values(["doc_id", "piece"]).groupby("doc_id"):
        ids = [*np.frombuffer(own.batch([TEXTS[int(i) % len(TEXTS)] or ""])[0], "<u4").tolist(), 2]
        assert [x for p in part.ids for x in p] == ids and part.start.tolist() == (part.length.cumsum() - part.length).tolist()
        assert part.ids_crc32.iloc[0] == zlib.crc32(struct.pack(f"<{part.length.iloc[0]}I", *ids[: part.length.iloc[0]]))
    assert packing.sequences(packed).where("size(ids) <> n_tokens").count() == 0
    assert packing.pack_documents(docs.limit(0)).count() == 0


# ---- neighbours


def test_quantile():
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(5.9915, abs=1e-3) and neighbours.chi_square_quantile(0.99, 8) == pytest.approx(20.090, abs=1e-3)


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 12)).astype(np.float32) * rng.uniform(0.5, 2, (600, 1)).astype(np.float32)
    x[5] = x[3]  # a tie
    x[9] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())]
    bad = [(None, x[0].tolist()), (1000, None), (1001, [0.0] * 12), (1002, [float("nan")] + [1.0] * 11), (1003, []), (1004, [None] + [1.0] * 11), (1020, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(frame, F.col("id") % 20 == 0, k=10, shard_rows=150, block_visits=8).toPandas()
    hits = 0
    for q in range(0, 600, 20):
        scores = (x.astype(float) * x[q].astype(float)).sum(1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(600), -scores))[:10]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, scores[own.vec_id], rtol=1e-12)
        hits += len(set(best) & set(own.vec_id))
        tied = own[own.vec_id.isin([3, 5, 9])].vec_id.tolist()
        assert tied == sorted(tied)
    assert hits >= 0.95 * 300 and set(got.query_id) == set(range(0, 600, 20))
    assert neighbours.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def test_neighbours_of_a_table_stop_before_they_have_seen_it(spark):
    base = "/root/testdata/sf0.1"
    rows = pd.read_parquet(f"{base}/embeddings.parquet")
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got = neighbours.nearest(spark.read.parquet(f"{base}/embeddings.parquet"), F.col("id") % 20 == 0, shard_rows=500).toPandas()
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        hits += len(set(ids[np.lexsort((ids, -scores))[:20]]) & set(got[got.query_id == ids[i]].vec_id))
    assert hits >= 0.9 * len(got) and len(got) == 20 * (ids % 20 == 0).sum()
    assert got.drop_duplicates("query_id").verified.mean() < 0.6 * len(rows)


def test_neighbours_of_hot_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(6).astype(np.float32).tolist()
    rows = [(i, hot) for i in range(400)] + [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(400, 700)]
    rows += [(20, rng.standard_normal(6).astype(np.float32).tolist()), (900, [1.0] * 3), (901, [2.0] * 3), (920, [1.0] * 4)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x")).withColumn("shard", F.lit(1))
    got = neighbours.nearest(frame, F.col("id") % 20 == 0, k=5, shard_rows=64).toPandas()
    h = np.array(hot, float)
    best = sorted([(-float(np.array(v, float) @ h), i) for i, v in rows if len(v) == 6 and i != 0])[:5]
    own = got[got.query_id == 0].sort_values("rank")
    assert own.vec_id.tolist() == [i for _, i in best] and np.allclose(own.score, [-s for s, _ in best])
    assert len(got[got.query_id == 20]) == 10 and 20 not in got[got.query_id == 20].vec_id.tolist()  # two vectors, a ranking each
    assert got[got.query_id == 900].vec_id.tolist() == [901] and 920 not in set(got.query_id)
    assert set(got.groupby("query_id").size()) == {5, 10, 1}


# ---- classifiers


@pytest.fixture(scope="module")
def labelled(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").where("doc_id % 3 = 0").select("doc_id", "text")
    return docs.cache(), spark.read.parquet(f"{base}/labels.parquet"), pd.read_parquet(f"{base}/labels.parquet")


def accuracy(rows, label, threshold):
    return ((rows.score >= threshold).astype(int) == rows[label]).mean()


def test_toxicity(labelled, spark):
    docs, labels, known = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).select("doc_id", "score", (toxicity.fold(F.col("doc_id")) == 0).alias("held")).toPandas().merge(known, on="doc_id")
    held = rows[rows.held]
    assert accuracy(held, "toxic", 0.5) > 0.96 and rows.score.between(0, 1).all()
    assert (held[held.toxic == 0].score < 0.5).mean() > 0.98
    odd = spark.createDataFrame([(1, None, 3.0), (1, "", 3.0), (2, "!" * 100_000, 3.0)], "doc_id bigint, text string, score double")
    got = toxicity.score(odd, model).collect()
    assert len(got) == 3 and got[0].score == got[1].score < 0.5
    kept = toxicity.drop_toxic(odd.withColumnRenamed("score", "c0"), labels.limit(0))
    assert kept.columns == ["doc_id", "text", "c0"] and kept.count() == 3
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2_000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = toxicity.Boosted(trees=40).fit(x, y)
    assert ((trees.raw(x) > 0) == y).mean() > 0.95
    xs, ps = toxicity.isotonic(np.array([0.0, 1, 2, 3, 3]), np.array([0.0, 1, 0, 1, 0]))
    assert (np.diff(ps) >= 0).all() and (np.diff(xs) >= 0).all() and 0 <= ps.min() and ps.max() <= 1


def test_trees_and_features_against_plain_versions():
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((500, 4)).round(1), rng.integers(0, 2, 500).astype(float)
    trees = toxicity.Boosted(trees=15, depth=3, min_leaf=5).fit(x, y)
    for row, raw in zip(x[:60], trees.raw(x[:60]), strict=True):
        total = trees.base
        for t in range(15):
            node = 0
            while node < 7:
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.cut[t, node])
            total += trees.leaf[t][node - 7]
        assert raw == pytest.approx(total)
    xs, ps = toxicity.isotonic(x[:, 0], y)
    order = np.argsort(x[:, 0], kind="stable")
    a, b = x[order, 0], y[order]
    values = np.unique(a)
    sums, n = np.array([b[a == v].sum() for v in values]), np.array([(a == v).sum() for v in values])
    for i, v in enumerate(values):  # the greatest of the least means of ranges around a value, each shrunk by one row
        fits = max(min(sums[j : k + 1].sum() / n[j : k + 1].sum() for k in range(i, len(values))) for j in range(i + 1))
        got = float(ps[np.searchsorted(xs, v, "right") - 1])
        assert abs(got - fits) <= 1 / 2 and (fits in (0.0, 1.0) or abs(got - fits) < 0.2)
    text = "You idiot! you ARE 1d10t, zzz. 50 words"
    row = dict(zip(toxicity.FEATURES, toxicity.Features({"idiot": 2.0}, {"zzzz": 1.0}).one(text), strict=True))
    assert row["words_log"] == pytest.approx(np.log1p(8)) and row["hits"] == 2 and row["veiled_hits"] == 1 and row["near_second"] == 2
    assert row["second_rate"] == 25.0 and row["bang_rate"] == 1 / len(text) and row["digit_rate"] == 5 / len(text) and row["capital_rate"] == 4 / len(text)


def test_samples_of_repeated_ids_are_bounded(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 50 + [(1, "b")] * 50 + [(2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.sample(docs, labels, "toxic", "doc_id", "text").count() <= 2


def test_discriminant_against_plain_densities():
    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((300, 3)), rng.standard_normal((200, 3)) * [1, 2, 0.5] + [1, 0, 0]
    model = quality.Discriminant([300, 200], [a.sum(0), b.sum(0)], [a.T @ a, b.T @ b])
    pooled = (np.cov(a.T, bias=True) * 300 + np.cov(b.T, bias=True) * 200) / 500
    logs = []
    for own in (a, b):
        weight = quality.SHRINK + (1 - quality.SHRINK) * 3 / (len(own) + 3)
        cov = np.cov(own.T)
        cov = (1 - weight) * cov + weight * np.diag(np.diag(cov)) + quality.RIDGE * np.diag(np.diag(pooled))
        x = rng.standard_normal((1, 3)) * 0 + np.array([[0.3, -1.0, 0.2]])
        gap = x - own.mean(0)
        logs.append(np.log((len(own) + 1) / 502) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (gap @ np.linalg.inv(cov) @ gap.T).item())
    assert model.log_odds(np.array([[0.3, -1.0, 0.2]])).item() == pytest.approx(logs[1] - logs[0])


def test_rows_without_an_id_are_not_held_out(spark, tmp_path):
    spark.createDataFrame([(None, "a b"), (3, "c d")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert quality.op7_quality(spark, str(tmp_path)).where("held_out is null").count() == 0
    assert toxicity.op4_toxicity(spark, str(tmp_path)).where("held_out is null").count() == 0


def test_quality(labelled, spark):
    docs, labels, known = labelled
    rows = quality.classify(docs, labels).select("doc_id", "score", (quality.fold(F.col("doc_id")) == quality.HELD_OUT).alias("held")).toPandas().merge(known, on="doc_id")
    assert accuracy(rows[rows.held], "quality", quality.THRESHOLD) > 0.95 and rows.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "x " * 50_000)], "doc_id bigint, text string")
    assert [0 <= r.score <= 1 for r in quality.classify(odd, labels.limit(0)).collect()] == [True] * 3
    assert quality.classify(odd.limit(0), labels).count() == 0


# ---- media


def test_codecs():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (media.decode(b"P5 # c\n4 3\n255\n" + grey.tobytes()) == grey).all()
    assert (media.decode(b"P2\n4 3\n255\n" + b" ".join(b"%d" % v for v in grey.ravel())) == grey).all()
    rgb = np.arange(36, dtype=np.uint8).reshape(3, 4, 3)
    assert (media.decode(b"P6\n4 3 255 " + rgb.tobytes()) == rgb).all() and media.grey(rgb).shape == (3, 4)
    assert (media.decode(b"P4\n3 2\n\xa0\x40") == [[0, 255, 0], [255, 0, 255]]).all() and (media.decode(b"P1 3 2 101\n0 1 0") == [[0, 255, 0], [255, 0, 255]]).all()
    assert media.decode(b"P5\n1 1\n65535\n\x01\x02").item() == 258
    body = b"".join(bytes(rgb[y, :, ::-1].tobytes()).ljust(12, b"\0") for y in (2, 1, 0))
    head = b"BM" + struct.pack("<IIIIiiHHIIiiII", 54 + len(body), 0, 54, 40, 4, 3, 1, 24, 0, 0, 0, 0, 0, 0)
    assert (media.decode(head + body) == rgb).all()
    for bad in (b"", b"P9", b"P5\n4 3\n255\nxx", b"P5\n0 3\n255\n", b"P5 #", b"BM", head, b"P2\n1 1\n9\nx"):
        with pytest.raises(media.MediaError):
            media.decode(bad)


def test_area_resize():
    image = np.random.default_rng(1).integers(0, 256, (37, 64)).astype(np.uint8)
    fine = np.repeat(np.repeat(image, 8, 0), 9, 1).astype(float)  # 296 x 576: whole cells of an 8 x 9 grid
    assert np.allclose(media.area_resize(image, 8, 9), fine.reshape(8, 37, 9, 64).mean((1, 3)))
    assert np.allclose(media.area_resize(np.full((1, 64), 7, np.uint8), 16, 16), 7)


def brute_resize(image, height, width):
    """Means of cells, a sample at a time, by the share of it that lies in the cell."""
    out = np.zeros((height, width))
    h, w = image.shape
    for y in range(height):
        for x in range(width):
            top, bottom, left, right = y * h / height, (y + 1) * h / height, x * w / width, (x + 1) * w / width
            total = area = 0.0
            for i in range(int(top), min(h, int(np.ceil(bottom)))):
                for j in range(int(left), min(w, int(np.ceil(right)))):
                    share = max(0.0, min(i + 1, bottom) - max(i, top)) * max(0.0, min(j + 1, right) - max(j, left))
                    total, area = total + share * float(image[i, j]), area + share
            out[y, x] = total / area
    return out


def test_hash_and_tile_against_brute_force():
    rng = np.random.default_rng(8)
    for shape in ((1, 64), (3, 5), (37, 64), (100, 7)):
        image = rng.integers(0, 256, shape).astype(np.uint8)
        cells = brute_resize(image, 8, 9)
        bits = "".join("1" if cells[y, x] < cells[y, x + 1] - 1e-9 else "0" for y in range(8) for x in range(8))
        assert media.difference_hash(image) == int(bits, 2)
        assert (media.shrunk(image) == np.floor(brute_resize(image, 16, 16).round(6) + 0.5)).all()
        assert (media.decode(media.encode_bmp(image))[:, :, 1] == image).all()
    assert (media.shrunk(np.full((4, 4), 1_000, np.uint16)) == 4).all() and (media.shrunk(np.full((4, 4), 65_535, np.uint16)) == 255).all()


def test_samples_are_scaled_and_masks_read():
    assert media.decode(b"P2 3 1 15\n0 7 15").tolist() == [[0, 119, 255]] and media.decode(b"P5 2 1 1000\n\x00\x00\x03\xe8").tolist() == [[0, 65_535]]
    head = lambda bits, packed, at, body: b"BM" + struct.pack("<IIIIiiHHIIiiII", at + len(body), 0, at, 40, 2, 1, 1, bits, packed, 0, 0, 0, 0, 0)
    body = struct.pack("<HH", 0x7C00, 0x03E0)
    assert media.decode(head(16, 0, 54, body) + body).tolist() == [[[255, 0, 0], [0, 255, 0]]]
    body = struct.pack("<II", 0xFF, 0xFF00)
    masks = struct.pack("<III", 0xFF, 0xFF00, 0xFF0000)
    assert media.decode(head(32, 3, 66, body) + masks + body).tolist() == [[[255, 0, 0], [0, 255, 0]]]


def test_malformed_images_are_errors(spark):
    rng = np.random.default_rng(9)
    good = [media.encode_bmp(np.arange(12, dtype=np.uint8).reshape(3, 4)), b"P5 4 3 255\n" + bytes(12), b"P2 2 2 300 1 2 3 4", b"P6 1 1 9 abc"]
    bad = [b"P5 " + b"9" * 5_000 + b" 1 255 x", b"P2 1 1 9 " + b"9" * 40, b"P2 1 1 9 300", b"P2 1 1 99 -5", b"P5 1 1 9 \xff", good[0][:46] + b"\xff" * 8 + good[0][54:60], good[0][:14] + b"\xff" * 4 + good[0][18:]]
    for _ in range(3_000):
        data = bytearray(good[rng.integers(len(good))])
        for _ in range(rng.integers(1, 4)):
            data[rng.integers(len(data))] = rng.integers(256)
        bad.append(bytes(data[: rng.integers(len(data)) + 1]))
    rows = media.media_features(spark.createDataFrame(list(enumerate(bad)), "media_id int, media binary")).collect()
    assert len(rows) == len(bad) and all(r.error for r in rows[:7]) and all((r.error is None) == (r.tile is not None) for r in rows)


def test_text_media(spark):
    texts = [None, "", "é" * 32, "x" * 65, "long " * 50_000, "x" * 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = media.text_media_digests(docs).orderBy("doc_id").collect()
    for text, r in zip(texts, rows, strict=True):
        raw = (text or "").encode()
        body = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]))
    assert rows[3][1:] == rows[5][1:] and rows[0].feature == rows[1].feature
    assert all(r.feature.endswith("preview=true") for r in rows)
    stored = media.text_media(docs.withColumn("tile", F.lit(1)).withColumn("c0", F.lit(1)))
    got = media.media_features(stored.unionByName(stored.limit(1).withColumn("media", F.lit(b"?").cast("binary")))).collect()
    assert sum(r.error is not None for r in got) == 1 and all(len(r.tile) == 128 + 256 for r in got if not r.error)
    assert media.text_media_digests(docs.limit(0)).count() == 0


# ---- languages


def test_language_fusion(spark):
    words = {"en": "the house and the garden of that night with those things", "fr": "la maison et le jardin de cette nuit avec ces choses", "de": "das haus und der garten dieser nacht mit solchen dingen"}
    docs = spark.createDataFrame([(i, f"{t} {i}", k) for i in range(30) for k, t in words.items()], "doc_id bigint, text string, lang string")
    profiles = language_id.fit_profiles(docs)
    assert profiles.languages == ["de", "en", "fr"]
    page = lambda i, url, lang, text: (i, url, f"<html lang='{lang}'><script>the and that</script><p>{text}</p></html>" if text is not None else None)
    rows = [page(i, f"http://{'www' if i % 2 else 'm'}.site.fr/{i}", "fr", words["fr"]) for i in range(40)] + [page(100 + i, f"http://a.site.com/{i}", "en", words["en"]) for i in range(40)]
    odd = [page(200, "http://www.site.fr/x", "", ""), page(201, "http://a.site.com/x", "fr", words["en"]), (202, None, None), (203, "no address", "<html lang=xx>"), page(204, "http://other.de/", "de", words["de"]), page(200, "http://www.site.fr/x", "", "")]
    frame = spark.createDataFrame(rows + odd, "page_id bigint, url string, html string").withColumn("lang", F.lit("?"))
    got = [(r.page_id, r.lang, r.declared) for r in language_id.identify(frame, profiles).collect()]
    by = {i: (lang, said) for i, lang, said in got}
    assert len(got) == 86 and by[0][0] == "fr" and by[100][0] == "en" and by[204][0] == "de"
    assert by[200][0] == "fr" and by[201] == ("en", "fr") and by[203][1] == "?" and by[202][0] in ("en", "fr")
    assert language_id.identify(frame.limit(0), profiles).count() == 0
    none = language_id.fit_profiles(docs.limit(0))
    assert language_id.identify(frame, none).where("lang is null").count() == 86
    assert language_id.address("HTTP://u@WWW.Ex.co.uk:80/p?q#f") == ("www.ex.co.uk", "co.uk", "uk")


def test_fusion_against_a_plain_version(spark):
    rng = np.random.default_rng(5)
    names = ["aa", "bb", "cc"]
    profiles = language_id.Profiles(names, np.repeat(np.arange(3), language_id.BUCKETS), np.tile(np.arange(language_id.BUCKETS), 3), rng.integers(0, 50, 3 * language_id.BUCKETS))
    hosts = ["www.x.fr", "m.x.fr", "y.fr", "z.de", "w.z.de", ""]
    rows = []
    for i in range(60):
        host = hosts[rng.integers(6)]
        text = "".join(rng.choice(list("abcdefgh "), 4))
        lang = ["", "aa", "bb", "qq"][rng.integers(4)]
        rows.append((i, f"http://{host}/p" if host else None, f'<html lang="{lang}"><p>{text}</p></html>'))
    told = {r.page_id: r for r in language_id.identify(spark.createDataFrame(rows, "page_id bigint, url string, html string"), profiles).collect()}
    seen = {}
    for i, url, html in rows:
        logs = profiles.likelihood(language_id.visible_text(html))
        said = language_id.declared_language(html)
        seen[i] = (*language_id.address(url), said if said in names or not said else "?", logs, np.exp(logs) / np.exp(logs).sum())
    for i, (host, domain, suffix, said, logs, own) in seen.items():
        others = [x for j, x in seen.items() if j != i]
        add = lambda keep: sum((x[5] for x in others if keep(x)), np.zeros(3))
        everyone, full = add(lambda x: True), add(lambda x: True) + own
        share = (full + 1) / (full.sum() + 3)
        at_domain = (add(lambda x: x[1] == domain) + 5 * share) / (add(lambda x: x[1] == domain).sum() + 5)  # noqa: B023
        prior = (add(lambda x: x[0] == host) + 3 * at_domain) / (add(lambda x: x[0] == host).sum() + 3)  # noqa: B023
        total = logs + np.log(prior + 1e-9)
        likely = lambda c, of: np.log((c + c.sum() / max(of.sum(), 1) + 1e-6) / (of + 1 + 1e-6))
        if said:
            total = total + likely(add(lambda x: x[3] == said), everyone)  # noqa: B023
        if suffix:
            total = total + likely(add(lambda x: x[2] == suffix and x[1] != domain), add(lambda x: x[1] != domain))  # noqa: B023
        post = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert told[i].lang == names[int(post.argmax())] and told[i].score == pytest.approx(post.max(), abs=1e-6)


def test_languages_of_pages_of_unseen_texts(spark):
    """Pages name their language and document in their paths, which no evidence is taken from."""
    base = "/root/testdata/sf0.1"
    profiles = language_id.fit_profiles(spark.read.parquet(f"{base}/documents.parquet").where("doc_id % 2 = 0"))
    pages = spark.read.parquet(f"{base}/pages.parquet")
    truth = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]{2})/([0-9]+)", 1)
    known = pages.select("page_id", truth.alias("truth"), F.regexp_extract("url", "/([0-9]+)[^/]*$", 1).try_cast("int").alias("d")).where("truth <> '' and d % 2 = 1")
    rows = language_id.identify(pages, profiles).join(known, "page_id").selectExpr("count(*) AS n", "avg(int(lang = truth)) AS right").first()
    assert rows.n > 300 and rows.right > 0.95, rows


def test_more_languages_than_any_cap(spark):
    rng = np.random.default_rng(4)
    codes = [a + b for a in "abcdefghij" for b in "klmnopqr"]
    docs = [(i * 100 + j, " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(4)), c) for i, c in enumerate(codes) for j in range(2)]
    profiles = language_id.fit_profiles(spark.createDataFrame([*docs, (1, "x", "no language"), (None, "x", "zz")], "doc_id bigint, text string, lang string"))
    assert profiles.languages == sorted(codes)


# ---- pieces

PIECES = ["", " ", "  ", "a", " a", "a ", "▁x", "a\tb\nc", "日本 ﬁ Ａ", "é é", "x " * 3, "a" * 3_000, "abcde" * 300, "the  quick   brown", "😀​", "hello world " * 200]


def test_pieces_are_those_of_the_library():
    import public_tokenizers

    told = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepieces.MODEL))
    rng = np.random.default_rng(4)
    chars = list("ab  ▁é\n日😀ﬁthe.1")
    texts = PIECES + ["".join(rng.choice(chars, rng.integers(0, 40))) for _ in range(400)]
    texts += ["".join(rng.choice(list("etaoinshrdlu"), 20_000)), "".join(rng.choice(list("日本語中文字人大小国的一是不了"), 20_000)), "aaab" * 5_000, "e" * 7_001]
    own = sentencepieces.encoder()
    assert own.pieces.hasty.any() and not own.pieces.hasty.all()
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in own.batch(texts)]
        assert got == told.encode(texts, num_threads=1)
    assert [own.decode(x) for x in got] == told.decode(got)


def test_suffix_array_and_edges():
    points = np.array([ord(c) for c in "banana"], np.int64)
    assert sentencepieces.suffix_array(points, 16).tolist() == [5, 3, 1, 0, 4, 2]
    pieces = sentencepieces.encoder().pieces
    text = "▁the▁then"
    edges = sentencepieces.Edges(np.array([ord(c) for c in text], np.int64), pieces)
    for s in range(len(text)):
        for n in range(1, len(text) - s + 1):
            assert edges.get(np.array([s]), np.array([n]))[0] == pieces.ids.get(text[s : s + n], -1)


def test_encode_and_decode(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, *PIECES])], "doc_id bigint, text string").withColumn("ids", F.lit(0))
    back = sentencepieces.decode(sentencepieces.encode(docs), out="back").orderBy("doc_id").collect()
    assert [r.back for r in back] == [(t or "").replace("▁", " ") for t in [None, *PIECES]]
    got = sentencepieces.encode_digests(docs)
    assert got.where("not round_trip").count() == 0 and sentencepieces.encode_digests(docs.limit(0)).count() == 0


def test_profiles_are_of_the_ids_that_hash_lowest(spark):
    rows = [(i % 2500, f"text number {i % 2500} {'abc' * (i % 7)}", "en" if i % 10 else "fr") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    for most in (1, 40, 5000):
        kept = None
        for lang in ("en", "fr"):
            own = docs.where(F.col("lang") == lang)
            ids = [r.doc_id for r in own.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
            part = own.where(F.col("doc_id").isin(ids))
            kept = part if kept is None else kept.unionByName(part)
        got, plain = language_id.fit_profiles(docs, rows=most), language_id.fit_profiles(kept, rows=10**9)
        for name, value in vars(plain).items():
            np.testing.assert_array_equal(getattr(got, name), value, err_msg=name)


def plain_visible(html):
    skipped = re.sub(r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->", " ", html, flags=re.I | re.S)
    return " ".join(re.sub(r"&#?\w{1,10};", " ", re.sub(r"<[^>]*>", " ", skipped)).split())


def test_pages_are_read_in_one_pass():
    rng = np.random.default_rng(6)
    parts = ["<script", "<SCRIPT x>", "</script >", "</Script\n>", "<style>", "</style>", "<!--", "-->", "<b>", "<", ">", "word", " ", "&amp;", "<html ", "<html>", " lang=en", ' LANG = "de', "scripts", "<scripty>", "lang"]
    for _ in range(3_000):
        html = "".join(rng.choice(parts, rng.integers(0, 14)))
        assert language_id.visible_text(html) == plain_visible(html)
        found = re.search(r"""<html\b[^>]*?\blang\s*=\s*["']?\s*([A-Za-z]{2,8})""", html, re.I)
        assert language_id.declared_language(html) == (found[1].lower() if found else "")


@pytest.mark.parametrize("part", ["<html ", "<script ", "<!-- ", "<style></", "<", "<html lang=", "lang = '", "<html lang" + " " * 99, "</script " + " " * 99])
def test_a_megabyte_of_open_tags_takes_no_second(part):
    html = part * (1_000_000 // len(part))
    began = time.process_time()
    language_id.visible_text(html), language_id.declared_language(html)
    assert time.process_time() - began < 1


def test_thousands_of_languages(spark):
    """5,000 codes: profiles hold what was seen, not a row of all trigrams for each."""
    import itertools
    import pickle

    codes = ["".join(x) for x in itertools.islice(itertools.product("abcdefghijklmnopqrst", repeat=3), 5_000)]
    docs = spark.createDataFrame([(i, f"some words of {c} {c}{c} {c}x", c) for i, c in enumerate(codes)], "doc_id bigint, text string, lang string")
    profiles = language_id.fit_profiles(docs)
    assert len(profiles.languages) == 5_000 and len(pickle.dumps(profiles)) < 5_000 * 1_000
    pages = spark.createDataFrame([(i, f"http://h{i}.{codes[7 * i]}/", f"<html lang={codes[7 * i]}><p>{codes[7 * i] * 2} {codes[7 * i]}x") for i in range(40)], "page_id bigint, url string, html string")
    found = {r.page_id: r.lang for r in language_id.identify(pages, profiles).collect()}
    assert sum(found[i] == codes[7 * i] for i in range(40)) >= 38
