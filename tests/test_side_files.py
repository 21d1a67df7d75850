"""Project files, pages, side files and symbols."""

import pytest

from vellum.sources import binary as B
from vellum.sources import project as P


def test_config():
    c = P.read_config("sys_ver = 3.6\nencoding = SJIS\nhed = a b\nunicode = off\ndebug=yes\nain_version = 2\nwhat = x\n")
    assert (c.sys_ver, c.sco_ver, c.encoding, c.hed, c.unicode, c.debug, c.ain_version) == ("3.6", "S360", "sjis", "a", False, True, 2)
    assert P.read_config("unicode = false", legacy_bool=True).unicode
    assert P.read_config(P.write_config(c)) == c
    for bad in ("sys_ver = 9", "encoding = x", "debug = maybe"):
        with pytest.raises(P.ProjectError):
            P.read_config(bad)


def test_lists():
    assert P.read_variables("RND\nD01  \n\n \n") == ["RND", "D01"] and P.read_variables("") == []
    hed = P.read_hed("#SYSTEM35\na.adv ; first\n\nb.adv\n#DLLHeader  \nx.hel\n\x1a\nignored")
    assert hed == P.Hed(["a.adv", "b.adv"], ["x.hel"]) and P.read_hed(P.write_hed(hed)) == hed
    with pytest.raises(P.ProjectError):
        P.read_hed("a.adv")


def test_headers():
    text = "// note\nvoid Init(void)\nvoid Draw(ISurface s, int x,\n int y)\nvoid None()\n"
    functions = [("Init", []), ("Draw", [2, 1, 1]), ("None", [])]
    assert P.read_hel(text) == functions and P.read_hel(P.write_hel(functions)) == functions
    for bad in ("int f(void)", "void f(what x)", "void f(" + ", ".join(f"int a{i}" for i in range(21)) + ")"):
        with pytest.raises(P.ProjectError):
            P.read_hel(bad)


def test_page():
    data = B.write_page(B.Page("S380", 42, b"TEST.ADV", b"ABC"))
    assert len(data) == 0x23 and data[4] == 32 and B.read_page(data) == B.Page("S380", 42, b"TEST.ADV", b"ABC")
    assert B.read_page(B.write_page(B.Page("S350", 1, b"d/a", b""))).name == b"d\\a"
    for bad in (b"", data[:-1], b"X" + data):
        with pytest.raises(B.BinaryError):
            B.read_page(bad)


def test_side_file(spark, tmp_path):
    ain = B.Ain("AIN2", 2, {b"lib": [(b"f", [1, 2]), (b"g", [])]}, [(b"a", 1, 32), (b"b", 1, 32), (b"c", 0, 7)], [b"RND", b"V"], [b"hi", b""])
    assert B.read_ain(B.write_ain(ain)) == ain
    assert [f[0] for f in B.read_ain(B.write_ain(ain, with_variables=False)).functions] == [b"c", b"a", b"b"]
    assert '"address": 32' in B.ain_json(ain)
    (tmp_path / "x.ain").write_bytes(B.write_ain(ain))
    got = B.scan_ain(spark, str(tmp_path / "x.ain"))
    assert {(r.page, r.addr, r.name, tuple(r.aliases)) for r in got["functions"].collect()} == {(1, 32, "a", ("b",)), (0, 7, "c", ())}
    for bad in (b"AINX", b"AINI\x03\0\0\0", B.write_ain(ain)[:-3]):
        with pytest.raises(B.BinaryError):
            B.read_ain(bad)


def test_symbols_and_line_map(spark):
    s = B.Symbols([(b"a.adv", b"text"), (b"b.adv", b"")], [(b"f", 1, 9, True), (b"g", 0, 3, False)], [b"V"], b"\x01\x02")
    back = B.read_symbols(B.write_symbols(s))
    assert back.sources == s.sources and back.variables == s.variables and back.functions == s.functions[::-1] and back.lines == s.lines
    rows = spark.createDataFrame([(0, 1, 1, 32), (0, 2, 2, 32), (0, 3, 3, 40), (0, 4, 3, 50), (0, 5, 4, 60)], "page int, seq int, line int, addr int")
    assert sorted((r.line, r.addr) for r in B.compressed_lines(rows).collect()) == [(2, 32), (3, 40), (4, 60)]
