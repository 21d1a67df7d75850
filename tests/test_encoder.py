"""The compiler: facts of the format as source and bytes, errors, and the same pages by Spark."""

import pytest

from vellum.lang import opcodes as O
from vellum.lang.encoder import CompileError, compile_pages, compile_project, compile_tables, number_bytes, side_file, symbols, variable_bytes
from vellum.sources.binary import read_ain, read_page, read_symbols, write_ain, write_symbols
from vellum.sources.project import VERSIONS, Config


def code(source, version="3.5", **options):
    system, page = VERSIONS[version]
    pages, names, messages = compile_pages([("page.adv", source)], Config(sys_ver=system, sco_ver=page, **options), ["V"])
    return read_page(pages[0]).code


def be(n):
    """A number of an expression: 0 to 51 in one byte, larger ones in two, the greater half first."""
    return bytes([0x40 + n]) if n < 0x34 else n.to_bytes(2, "big")


def arguments(*numbers):
    return b"".join(be(n) + b"\x7f" for n in numbers)


def at(offset):
    """An address: pages begin at 0x20."""
    return (0x20 + offset).to_bytes(4, "little")


SET, V, END = b"!", b"\x80", b"\x7f"
#: By version: sources, and their bytes by the format's rules. V is variable 0.
VECTORS = {
    "3.5": [
        # commands
        ("A R A", b"ARA"),
        ("G7:", b"G\x00" + arguments(7)),
        ("G 12,3:", b"G\x01" + arguments(12, 3)),
        ("WV 10,20,300,400:", b"WV" + arguments(10, 20, 300, 400)),
        ("CB 5,60,700,8,9:", b"CB" + arguments(5, 60, 700, 8, 9)),
        ("LC 3,4,SEA.BMP:", b"LC" + arguments(3, 4) + b"SEA.BMP:"),
        ("; first\nR // second\n/* third\n*/ A", b"RA"),
        # data
        ("[0b101, 0x10, 255b, 300]", b"\x05\x00\x10\x00\xff\x2c\x01"),
        ('"うみ"', b"\xb3\xd0\x00"),
        ("'かに　'", b"\xb6\xc6 "),
        ("'<0x82a0>'", "あ".encode("shift_jis")),
        # expressions
        ("!V:7!", SET + V + be(7) + END),
        ("!V:51!!V:52!", SET + V + b"\x73" + END + SET + V + b"\x00\x34" + END),
        ("!V-:3!!V*:2!", b"\x11" + V + be(3) + END + b"\x12" + V + be(2) + END),
        ("!V[n]:5!!n:V[2]!", SET + b"\xc0\x01\x00\x00\x81" + END + be(5) + END + SET + b"\x81" + b"\xc0\x01\x00\x00" + be(2) + END + END),
        ("!V:9-4-2!", SET + V + be(9) + be(4) + b"\x7a" + be(2) + b"\x7a" + END),
        ("!V:8/(3+1)!", SET + V + be(8) + be(3) + be(1) + b"\x79\x78" + END),
        ("!V:6%4!", SET + V + be(6) + be(4) + b"\xc0\x02" + END),
        ("!V:1=2!", SET + V + be(1) + be(2) + b"\x7b" + END),
        ("!V:40000!", SET + V + be(0x3FFF) * 2 + be(40_000 - 2 * 0x3FFF) + b"\x79\x79" + END),
        ("const word FIVE=5: !V:FIVE*2!", SET + V + be(5) + be(2) + b"\x77" + END),
        ("\n\n!V:__LINE__!", SET + V + be(3) + END),
        # places
        ("A*top:R@top:", b"AR@" + at(1)),
        ("@end:R*end:A", b"@" + at(6) + b"RA"),
        ("\\sub:A*sub:R\\0:", b"\\" + at(6) + b"AR" + b"\\\0\0\0\0"),
        ("#tbl,2:*tbl:[1]", b"#" + at(7) + arguments(2) + b"\x01\x00"),
        ("pragma address 0x26: R", bytes(6) + b"R"),
        # blocks
        ("{V=3:R}A", b"{" + V + be(3) + b"\x7b" + END + at(10) + b"RA"),
        ("<@V<9:!V+:1!>", b"{" + V + be(9) + b"\x7c" + END + at(18) + b"\x10" + V + be(1) + END + b">" + at(0)),
        ("<V,2,5,1,1:R>", SET + V + be(2) + END + b"<\x00<\x01" + at(26) + V + END + arguments(5, 1, 1) + b"R>" + at(6)),
        ("!P:0!**twice P: !P*:2! ~0,P: ~twice 4:", SET + b"\x81" + be(0) + END + b"\x12\x81" + be(2) + END + b"~\0\0\x81" + END + SET + b"\x81" + be(4) + END + b"~\1\0" + at(4)),
        # menus
        ("$go$うみ$*go:A", b"$" + at(8) + b"\xb3\xd0$A"),
        ("$go$'う'R$*go:A", b"$" + at(8) + b"\xb3R$A"),
    ],
    "3.6": [("'かに　'", "かに　".encode("shift_jis"))],
    "3.8": [
        ("TOC:", b"/\x00"),
        ("'Tom\\'s'", b"/!Tom's\0"),
        ('MT "Ship":', b"/(Ship\0"),
        ("{V:R}else{A}", b"{" + V + END + at(13) + b"R@" + at(14) + b"A"),
    ],
    "3.9": [
        ("'one'A'two'", b"/\x7c\0\0\0\0A/\x7c\1\0\0\0"),
        ("H2 7:'x'", b"/\x7d\0\0\0\0\x02" + arguments(7) + b"/\x7c\1\0\0\0"),
    ],
}


@pytest.mark.parametrize(("version", "source", "wanted"), [(v, *x) for v, every in VECTORS.items() for x in every])
def test_bytes_of_sources(version, source, wanted):
    assert code(source, version) == wanted


def test_long_messages_of_many_operators():
    for sign, byte in zip("&|^", (b"\x74", b"\x75", b"\x76"), strict=True):
        assert code(f"!V:6{sign}3!") == SET + V + be(6) + be(3) + byte + END
    for sign, byte in (("<=", b"\xc0\x03"), (">=", b"\xc0\x04"), ("\\", b"\x7e"), (">", b"\x7d")):
        assert code(f"!V:2{sign}5!") == SET + V + be(2) + be(5) + byte + END


def test_unicode():
    assert code("'シ'", unicode=True) == b"ZU\x41\x7f" + "シ".encode() and code("'<0x8356>'", unicode=True)[4:] == "シ".encode()


def test_numbers():
    assert number_bytes(0x33) == b"\x73" and number_bytes(0x34) == b"\x00\x34" and variable_bytes(0x40) == b"\xc0\x40" and variable_bytes(0x100) == b"\xc1\x00"
    assert len(O.extended()) == 141 and O.extended()["sysReset"][0] == b"\x2f\x8c"


BROKEN = {
    "places": ["@nowhere:", "*twice:*twice:", "**again: **again:", "~missing:"],
    "blocks": ["{1:R", "<V,1,5,1,1:R", "}"],
    "texts": ["'open", '"open', "/* open", "'latin'", "$go$ latin $"],
    "numbers": ["!V:unknown!", "[99999]", "const word V=3: !V:1!"],
    "words": ["ZZZ:", "nothing:", "pragma nothing:"],
}


@pytest.mark.parametrize("source", [x for every in BROKEN.values() for x in every])
def test_errors(source):
    with pytest.raises(CompileError):
        code(source)


def test_foreign_calls():
    config = Config(disable_ain_message=True)
    pages, _, _ = compile_pages([("a.adv", 'lib.f 1, "x":')], config, dlls={"lib": [("g", []), ("f", [2, 1, 18])]})
    assert read_page(pages[0]).code == b"\x2f\x60\0\0\0\0\1\0\0\0" + b"\x40\x7f\x41\x7fx\0"


def test_project(spark):
    sources = [("d/a.adv", "!X:1! ~f 3: 'm' &#B.adv:"), ("B.ADV", "**f Z: ~0,Z: !Z:X! 'n' pragma ald_volume 2:"), ("c.adv", "!Q:0! ~f Q: 'o' <X,1,2,1,1:A>")]
    config = Config()
    pages, names, messages = compile_pages(sources, config, ["V"])
    assert names.variables == {"V": 0, "X": 1, "Z": 2, "Q": 3} and messages == [b"m", b"n", b"o"]
    frame = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(sources)], "page int, name string, text string").repartition(3)
    got = compile_project(frame, config, ["V"]).orderBy("page").collect()
    assert [bytes(r.content) for r in got] == pages and [r.volume for r in got] == [1, 2, 1]


def test_side_file_and_symbols(spark):
    sources = [("a.adv", "!X:1! 'm' \\l: *l:\nA ~f:\n"), ("b.adv", "'n'\n\n**f: 'o' ~0,X:")]
    config = Config(debug=True)
    made = compile_tables(spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(sources)], "page int, name string, text string").repartition(2), config, ["V"])
    pages, _, messages = compile_pages(sources, Config(), ["V"])
    assert [bytes(r.content) for r in made.pages.orderBy("page").collect()] == pages
    ain = read_ain(write_ain(side_file(made, config, {"lib": [("g", [1])]})))
    assert ain.messages == messages == [b"m", b"n", b"o"] and ain.variables == [b"V", b"X"] and ain.dlls == {b"lib": [(b"g", [1])]}
    assert ain.functions == [(b"f", 2, 0x26)]
    told = read_symbols(write_symbols(symbols(made, sources)))
    assert told.sources == [(n.encode(), t.encode()) for n, t in sources] and told.variables == [b"V", b"X"]
    assert told.functions == [(b"l", 0, 0x2F, True), (b"f", 1, 0x26, False)]
    numbers = [int.from_bytes(told.lines[i : i + 4], "little") for i in range(0, len(told.lines), 4)]
    assert numbers == [2, 2, 1, 0x20, 2, 0x2F, 1, 1, 0x20]  # b.adv has no line end: its last line meets the page's end
