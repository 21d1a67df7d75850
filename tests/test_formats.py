"""Charset, archives and image codecs: round trips and constructed bytes."""

import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hn
from pyspark.sql import functions as F

from vellum.codecs import pms, png, qnt, vsp
from vellum.functions import charset as C
from vellum.sources import archive as A
from vellum.sources import images


def test_charset_cells():
    assert len(C.cells()) == 7913 and len(C.ambiguous()) == 396
    assert C.cells()[0xEC9E] == "" and C.cells()[0x82F2] == "ゔ"
    for cell, char in C.cells().items():
        raw = cell.to_bytes(2, "big")
        assert C.decode(raw) == char and (C.encode(char) == raw or char in C.ambiguous())
    assert C.decode(b"\xa0\xb1") == "｠ｱ" and C.decode(b"\x81", "?") == "?" and C.decode(b"\xfd\x41", "?") == "?A"
    with pytest.raises(UnicodeDecodeError):
        C.decode(b"\x81")
    assert C.encode("😀é", b"?") == b"??"


def test_compaction_is_an_inverse_pair():
    for b in range(256):
        if C.is_compacted(b):
            lead, trail = C.expand(b)
            assert C.compact(lead, trail) == b
    assert C.decode(C.expand(0xB1)) == "あ" and C.decode(C.expand(0xA7)) == "ぁ" and C.compact(0x88, 0x9F) == 0


def test_utf8_form():
    assert C.invalid_utf8_at("aé日😀".encode()) == -1 and C.invalid_utf8_at(b"a\x80") == 1 and C.invalid_utf8_at(b"ab\xe3\x81") == 2


def entries(spark, rows):
    when = datetime.datetime(1996, 12, 19, tzinfo=datetime.timezone.utc)
    return spark.createDataFrame([(i, v, n, when, bytearray(d)) for i, v, n, d in rows], "entry_index int, volume int, name string, mtime timestamp, data binary")


def test_archive_round_trip(spark, tmp_path):
    rows = [(1, 1, "a.txt", b"content"), (3, 1, "very_long_file_name.txt", b"ok"), (4, 2, "日本.txt", b""), (5, 2, "b", b"x" * 700)]
    made = A.encode_ald(entries(spark, rows)).withColumn("name", F.concat(F.lit("tS"), F.char(F.col("volume") + 64), F.lit(".ALD")))
    A.save(made, "name", "content", str(tmp_path))
    back = A.read_ald(spark, str(tmp_path)).orderBy("entry_index").collect()
    assert [(r.entry_index, r.volume, r.name, bytes(r.data)) for r in back] == rows
    assert [r.link_no for r in back] == [1, 2, 1, 2] and back[0].mtime.year == 1996 and back[0].warning is None
    raw = bytes(made.where("volume = 1").first().content)
    assert len(raw) % 256 == 16 and A.links(raw)[:3] == [(1, 1), (0, 0), (1, 2)]
    assert A.read_volume(raw[:-8] + b"\x05" + raw[-7:], "xSA.ALD")[1] == "wrong volume 5 in the footer"
    with pytest.raises(A.ArchiveError):
        A.read_volume(raw[:-8] + b"\x05" + raw[-7:], "xSC.ALD")
    assert A.read_volume(raw[:-1])[1] and A.read_volume(b"")[0] == []


def test_archive_tools(spark, tmp_path):
    left = entries(spark, [(1, 1, "a", b"same"), (2, 1, "b", b"abcX"), (3, 1, "c", b""), (5, 1, "E", b"1")])
    right = entries(spark, [(1, 1, "A", b"same"), (2, 1, "b", b"abcY"), (4, 1, "d", b""), (5, 1, "f", b"1")])
    assert sorted(map(tuple, A.compare(left, right).collect())) == [(2, "data", 3), (3, "only_left", None), (4, "only_right", None), (5, "name", None)]
    assert A.find(left, "0x2").first().name == "b" and A.find(left, "e").first().entry_index == 5 and A.find(left, "9").count() == 0
    lines = spark.createDataFrame([(1, "1,5,x.qnt"), (2, "1,y.qnt"), (3, "2,z.qnt"), (4, "")], "at int, line string")
    assert [tuple(r)[1:] for r in A.parse_manifest(lines).orderBy("at").select("at", "volume", "link_no", "name").collect()] == [(1, 5, "x.qnt"), (1, 6, "y.qnt"), (2, 1, "z.qnt")]
    with pytest.raises(A.ArchiveError):
        A.parse_manifest(spark.createDataFrame([(1, "1,5,x"), (2, "1,5,y")], "at int, line string"))
    members = [b"", b"BMxx", b"PM\x01\0data", b"\xff\xd8\xff\xe0"]
    (tmp_path / "a.alk").write_bytes(A.write_alk(members))
    got = A.scan_alk(spark, str(tmp_path / "a.alk")).orderBy("entry_index").collect()
    assert [(r.ftype, bytes(r.data)) for r in got] == list(zip(["", "bmp", "pms", "jpeg"], members, strict=True))


small = st.tuples(st.integers(1, 7), st.integers(1, 9))


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_vsp_round_trip(data):
    h, w = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 3)) * 8
    pixels = data.draw(hn.arrays(np.uint8, (h, w), elements=st.integers(0, data.draw(st.sampled_from([1, 15])))))
    image = vsp.Vsp(3, 4, 7, (np.arange(48).reshape(16, 3) % 16 * 17).astype(np.uint8), pixels)
    back = vsp.decode(vsp.encode(image))
    assert (back.pixels == pixels).all() and (back.palette == image.palette).all() and (back.x, back.y, back.bank) == (3, 4, 7)


def test_vsp_codes():
    head = bytes([0, 0, 0, 0, 1, 0, 4, 0, 0, 0]) + bytes(48)
    body = bytes([1, 3, 0xFF]) + bytes([6, 3, 3]) + bytes([2, 1, 9, 10]) + bytes([7, 1, 0x10, 7, 0, 8])
    planes = np.unpackbits(np.array([[255] * 4, [0] * 4, [9, 10, 9, 10], [1, 16, 0, 8]], np.uint8), axis=None).reshape(4, 4, 8)
    assert (vsp.decode(head + body).pixels == (planes * np.array([1, 2, 4, 8])[:, None, None]).sum(0)).all()
    with pytest.raises(vsp.VspError):
        vsp.decode(head + bytes([1, 9, 1]))
    with pytest.raises(vsp.VspError):
        vsp.decode(head + bytes([1]))


@settings(max_examples=40, deadline=None)
@given(st.data())
def test_pms_round_trip(data):
    h, w = data.draw(st.integers(1, 6)), data.draw(st.integers(1, 30))
    few = st.sampled_from([0, 1, 0xF8, 0xFF])
    eight = data.draw(hn.arrays(np.uint16, (h, w), elements=few))
    palette = np.arange(768).reshape(256, 3).astype(np.uint8)
    for version in (0, 1, 2):
        back = pms.decode(pms.encode(pms.Pms(5, 6, eight, palette, None, 0xFFFE, version, 1_000)), old=True)
        assert (back.pixels == eight).all() and (back.palette == palette).all() and (back.x, back.y, back.palette_mask, back.version) == (5, 6, 0xFFFE, version)
    wide = data.draw(hn.arrays(np.uint16, (h, w), elements=st.sampled_from([0, 1, 0xFFF8, 0xF81F, 0xE61C, 0xE61D, 0x00FA])))
    back = pms.decode(pms.encode(pms.Pms(0, 0, wide, None, eight.astype(np.uint8), 0, 2, 1_000)))
    assert (back.pixels == wide).all() and (back.alpha == eight).all() and back.seconds == 1_000


def test_pms_broken():
    head = pms.encode(pms.Pms(0, 0, np.zeros((1, 4), np.uint16), np.zeros((256, 3), np.uint8)))[: 48 + 768]
    for body in (b"\xff\x01", b"\xfd\x09\x01", b"\x01", b"\xfc\x00\x01\x02"):
        with pytest.raises(pms.PmsError):
            pms.decode(head + body)


@settings(max_examples=30, deadline=None)
@given(hn.arrays(np.uint8, st.tuples(st.integers(1, 7), st.integers(1, 7), st.just(4))))
def test_qnt_and_png_round_trip(rgba):
    image = qnt.Qnt(60, 40, rgba[:, :, :3], rgba[:, :, 3])
    data = qnt.encode(image)
    back = qnt.decode(data)
    assert (back.pixels == image.pixels).all() and (back.alpha == image.alpha).all()
    made = images.to_png(data)
    assert (png.decode(made)[0] == rgba).all() and images.from_png(made, "qnt") == data
    alone = qnt.decode(qnt.encode(qnt.Qnt(0, 0, None, rgba[:, :, 3])))
    assert alone.pixels is None and (alone.alpha == rgba[:, :, 3]).all()


def test_image_rows(spark):
    rng = np.random.default_rng(1)
    v = vsp.encode(vsp.Vsp(5, 20, 7, np.zeros((16, 3), np.uint8), rng.integers(0, 16, (8, 16)).astype(np.uint8)))
    p = pms.encode(pms.Pms(50, 30, pms.from_rgb(rng.integers(0, 256, (4, 5, 3))), None, None, 0, 2, 1_615_694_426))
    rows = spark.createDataFrame([("v", bytearray(v)), ("p", bytearray(p)), ("x", bytearray(b"?"))], "path string, content binary")
    got = {r.path: r for r in images.image_info(rows).collect()}
    assert (got["v"].width, got["v"].x, got["v"].palette_bank) == (16, 40, 7) and got["p"].mtime.minute == 0 and got["p"].bpp == 16 and got["x"].error
    back = images.convert(images.convert(rows, None).where("error is null").drop("error"), "pms").where("path = 'p'").first()
    assert (pms.decode(bytes(back.content)).pixels == pms.decode(p).pixels).all()
