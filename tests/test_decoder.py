"""Compiled pages read back: the text compiles to the same bytes."""

import pytest

from tests.test_encoder import VECTORS
from vellum.lang import decoder as D
from vellum.lang.encoder import Parser, compile_pages, compile_project
from vellum.sources.binary import read_page
from vellum.sources.project import VERSIONS, Config


def again(sources, version="3.8", variables=None, **options):
    system, sco = VERSIONS[version]
    config = Config(sys_ver=system, sco_ver=sco, **options)
    pages, names, messages = compile_pages(sources, config, variables)
    texts, told = D.decompile_pages(pages, Config(sys_ver=system, sco_ver=sco, **options), D.Names(list(names.variables), messages=messages))
    back, _, _ = compile_pages([(n, t) for (n, _), t in zip(sources, texts, strict=True)], told, list(names.variables))
    return pages, back, texts, told


@pytest.mark.parametrize(("version", "source"), [(v, source) for v, every in VECTORS.items() for source, _ in every])
def test_round_trip_of_sources(version, source):
    pages, back, texts, _ = again([("page.adv", source)], version, ["V"])
    assert pages == back, texts


PROGRAM = """
  !A:1!!B+:A*2!
*top:
  {A=1: 'then' {B: !B:0!} } else if {B>2 : 'two' } else { 'else' }
  <@ A<10: !A+:1! {A\\3: R} >
  <B, 1, 10, 1, 1: MT "title": >
  $top$'menu' R$ ]
  ~twice A+(B-1)*2: ~~A:
  #table, 0:
  @top:
*table:
  [1, 2, 0xffff] "text" _top:
**twice X: ~0, X*2:
  !X:65535!!X:16383+X!!A[B+1]:A[2]!
  menuSetCbkSelect twice: dlgManualProtect "ab", "c": inc A: B 1,1,2,3,4,5,6: UP 1,"x",2:
  &3: %0:
"""


@pytest.mark.parametrize("options", [{}, {"unicode": True}, {"disable_else": True}])
def test_round_trip_of_a_program(options):
    program = PROGRAM.replace("} else if {B>2 : 'two' } else { 'else' }", "}") if options.get("disable_else") else PROGRAM
    pages, back, texts, told = again([("a.adv", "!X:0!" + program)], "3.8", **options)
    assert pages == back, texts[0]
    assert told.disable_else == bool(options.get("disable_else"))
    assert ("else" in texts[0]) != told.disable_else


def test_functions_of_other_pages_are_followed():
    sources = [("a.adv", "!X:0! ~f: R"), ("b.adv", "@end: **f: A ~g: ~0,1: **g: 'deep' ~0,2: *end:")]
    pages, back, texts, _ = again(sources)
    assert pages == back and "'deep'" in texts[1]


def test_expressions():
    names = D.Names(["a", "b"])
    for text in ("a+b*2", "(a+b)*2", "a-(b-1)", "a-b-1", "a[b+1]=1", "(a=b)&1", "16384", "65535", "a%3<=b"):
        p = Parser(f"!a:{text}!", Config())
        p.parse()
        pages, _, _ = compile_pages([("x", f"!a:{text}!")], Config(), ["a", "b"])
        r = D.Reader(read_page(pages[0]).code, 2)
        assert D.show(r.expression(), names) == text
    assert D.show(D.Reader(b"\x41\x42\x7f", 0).expression(), names) == "1 $ 2"
    for bad in (b"\x79\x7f", b"\x7f", b"\x41"):
        with pytest.raises(D.DecodeError):
            D.Reader(bad, 0).expression()


def test_project(spark):
    sources = [("d/a.adv", "!X:1! ~f: 'm' {X: A} else {R}"), ("b.adv", "@e: **f: ~g: ~0,X: **g: 'n' ~0,0: *e: pragma ald_volume 2:"), ("c.adv", "R")]
    config = Config(disable_ain_message=True)
    frame = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(sources)], "page int, name string, text string").repartition(3)
    compiled = compile_project(frame, config)
    texts, told = D.decompile_project(compiled, Config(disable_ain_message=True), D.Names(["X"]))
    back = compile_project(texts.select("page", "name", "text"), told, ["X"])
    assert {(r.page, bytes(r.content), r.volume) for r in back.collect()} == {(r.page, bytes(r.content), r.volume) for r in compiled.collect()}
    names = D.Names(functions={(1, 64): "late", (1, 40): "f", (2, 9): "there"}, aliases={(1, 40): ["again"]})
    gone = D.missing_pages(texts.where("page <> 1"), names).collect()
    assert [(r.page, r.text) for r in gone] == [(1, "pragma ald_volume 0:\npragma address 0x28:\n**f:\n**again:\npragma address 0x40:\n**late:\n")]
    assert [r.text for r in D.missing_pages(texts.where("page <> 1")).collect()] == ["pragma ald_volume 0:\n"]


def test_chains_of_calls_are_followed_to_their_end(spark, monkeypatch):
    monkeypatch.setattr(D, "MAX_ROUNDS", 1, raising=False)  # the bound that there was
    config = lambda: Config(sys_ver="3.8", disable_ain_message=True)
    sources = [("p0.adv", "!X:1! ~f1:"), *[(f"p{i}.adv", f"@end: **f{i}: 'deep{i}' ~f{i + 1}: ~0,X: *end: A") for i in (1, 2)], ("p3.adv", "@end: **f3: 'deep3' ~0,X: *end: A")]
    pages, _, _ = compile_pages(sources, config())
    texts, _ = D.decompile_pages(pages, config())
    assert all(f"'deep{i}'" in texts[i] for i in (1, 2, 3))
    rows = spark.createDataFrame([(bytearray(p), 1) for p in pages], "content binary, volume int")
    told, _ = D.decompile_project(rows, config())
    assert [r.text.count(f"'deep{r.page}'") for r in told.orderBy("page").collect()] == [0, 1, 1, 1]


@pytest.mark.parametrize("version", ["3.5", "3.8"])
@pytest.mark.parametrize(
    ("data", "shown"),
    [
        ('"name" "" "x y" [513, 1]', ['"name"', '""', '"x y"', "[513, 1]"]),
        ('[1, 2, 3, 4, 5, 6, 7, 8, 9, 7b]', ["[1, 2, 3, 4, 5, 6, 7, 8, 9, 7b]"]),
        ('[1] "a\\"b\\\\c\\<" [0b]', ["[1]", '"a\\"b\\\\c\\<"', '""']),
        ('"日本語のカナ"', ['"日本語のカナ"']),
        ('[65b, 0b]', ["[65]"]),
        ('[0b]', ['""']),
        ('[0b] "ab"', ['""', '"ab"']),
    ],
)
def test_data_are_strings_and_numbers(version, data, shown):
    pages, back, texts, _ = again([("a.adv", f"#t, 0: R @e: *t: {data} *e: R")], version)
    assert pages == back, texts[0]
    lines = texts[0].splitlines()
    if version == "3.5":  # where the byte of a space is a wide one
        shown = [x.replace("x y", "x\u3000y") for x in shown]
    assert [x for x in lines if x[0] in '["'] == shown


@pytest.mark.parametrize(("version", "options"), [("3.5", {}), ("3.8", {}), ("3.8", {"unicode": True})])
def test_any_bytes_as_data(version, options):
    import random

    rng = random.Random(5)
    for size in (1, 2, 3, 40, 400, 4000):
        for choose in (range(256), (0, 0x41, 0x22, 0x5C, 0x3C), (0, 0x82, 0xA0, 0xE3, 0x81, 0x82, 0x20, 0x0A, 0x7F)):
            data = ", ".join(f"{rng.choice(choose)}b" for _ in range(size))
            pages, back, texts, _ = again([("a.adv", f"#t, 0: R @e: *t: [{data}] *e: R")], version, **options)
            assert pages == back, texts[0]


def test_long_data_take_time_in_proportion():
    pages, back, _, _ = again([("a.adv", "#t, 0: R @e: *t: [" + ", ".join(["65b"] * 60_001) + "] *e: R")])
    assert pages == back


CALLS = [
    ("a.adv", "!A:1!!B:2!!C:3! ~f: !C:A! ~f: !A:5!!B:A+1! ~g: !A:7! *in: !B:8! ~g: !A:1!!C[2]:4!!B:2! ~g: @in:"),
    ("b.adv", "@e: **f: ~0,C: **g: !A:3!!B:4! ~h: ~0,B: **h: ~0,A: *e: R"),
]


def test_calls_get_their_arguments():
    """f: C in every call; g: B, as a label or an element stands before it; h: one call, all that it assigns."""
    pages, back, texts, _ = again(CALLS, variables=["A", "B", "C"])
    assert pages == back, texts
    assert texts[0].splitlines()[:8] == ["!A:1!", "!B:2!", "~F_1_00025 3:", "~F_1_00025 A:", "!A:5!", "~F_1_0002a A+1:", "!A:7!", texts[0].splitlines()[7]]
    assert [x for x in texts[1].splitlines() if x.startswith(("**", "~F"))] == ["**F_1_00025 C:", "**F_1_0002a B:", "~F_1_0003e 3, 4:", "**F_1_0003e A, B:"]


@pytest.mark.parametrize(("many", "found"), [(20, True), (21, False)])
def test_setting_up_is_no_call(many, found):
    names = [f"v{i}" for i in range(many)]
    program = "".join(f"!{n}:1!" for n in names) + "~f: R @e: **f: ~0,1: *e: R"
    pages, back, texts, _ = again([("a.adv", program)], variables=names)
    assert pages == back and texts[0].startswith("~F_") == found


def test_calls_of_a_project_get_their_arguments(spark):
    config = lambda: Config(sys_ver="3.8", disable_ain_message=True)
    pages, _, _ = compile_pages(CALLS, config(), ["A", "B", "C"])
    plain, _ = D.decompile_pages(pages, config(), D.Names(["A", "B", "C"]))
    rows = spark.createDataFrame([(bytearray(p), 1) for p in pages], "content binary, volume int").repartition(2)
    texts, _ = D.decompile_project(rows, config(), D.Names(["A", "B", "C"]))
    assert [r.text for r in texts.orderBy("page").collect()] == plain
    only, _ = D.decompile_project(rows.where("false").unionByName(spark.createDataFrame([(bytearray(pages[0]), 1)], rows.schema)), config(), D.Names(["A", "B", "C"]))
    assert "~F_1_00025:" in only.first().text  # its page is not there
