"""Compiled pages (SCO), their side file (AIN) and symbols (DSYM): readers, writers and scans."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import charset

# Marks of the files and their sections.
PAGE_MARKS = (b"S350", b"S351", b"153S", b"S360", b"S380")
SIDE_MARKS = (b"AINI", b"AIN2")
SYMBOL_MARK = b"DSYM"


class BinaryError(ValueError):
    pass


@dataclass
class Page:
    version: str
    page: int
    name: bytes
    code: bytes


def read_page(data: bytes) -> Page:
    if data[:4] not in PAGE_MARKS or len(data) < 18:
        raise BinaryError("no page")
    head, size, page, n = struct.unpack_from("<IIIH", data, 4)
    if size != len(data):
        raise BinaryError(f"the header says {size} bytes, there are {len(data)}")
    return Page(data[:4].decode(), page, data[18 : 18 + n], data[head:])


def write_page(page: Page) -> bytes:
    name = page.name.replace(b"/", b"\\")
    if len(name) >= 1024:
        raise BinaryError("the name is too long")
    head = (18 + len(name) + 15) & ~15
    out = page.version.encode() + struct.pack("<IIIH", head, head + len(page.code), page.page, len(name)) + name
    return out.ljust(head, b"\0") + page.code


class _Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def number(self, size: int) -> int:
        self.at += size
        if self.at > len(self.data):
            raise BinaryError("the file ends early")
        return int.from_bytes(self.data[self.at - size : self.at], "little")

    def text(self) -> bytes:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise BinaryError("a string without end")
        out, self.at = self.data[self.at : end], end + 1
        return out

    def many(self, read: Callable[[], object]) -> list:
        return [read() for _ in range(self.number(4))]


@dataclass
class Ain:
    magic: str = "AINI"
    version: int = 1
    dlls: dict[bytes, list[tuple[bytes, list[int]]]] = field(default_factory=dict)
    functions: list[tuple[bytes, int, int]] = field(default_factory=list)  # (name, page, address); names may share an address
    variables: list[bytes] = field(default_factory=list)
    messages: list[bytes] = field(default_factory=list)


def _rotated(data: bytes, left: int) -> bytes:
    return data.translate(bytes((b << left | b >> (8 - left)) & 255 for b in range(256)))


def read_ain(data: bytes) -> Ain:
    if data[:4] not in SIDE_MARKS:
        raise BinaryError("no side file")
    out = Ain(data[:4].decode(), int.from_bytes(data[4:8], "little"))
    if out.version not in (1, 2):
        raise BinaryError(f"version {out.version}")
    c = _Cursor(_rotated(data[8:], 2))
    while c.at < len(c.data):
        tag = c.data[c.at : c.at + 4]
        c.at += 8
        if tag == b"HEL0":
            out.dlls = dict(c.many(lambda: (c.text(), c.many(lambda: (c.text(), c.many(lambda: c.number(4)))))))
        elif tag == b"FUNC":
            out.functions = c.many(lambda: (c.text(), c.number(2), c.number(4)))
        elif tag == b"VARI":
            out.variables = c.many(c.text)
        elif tag == b"MSGI":
            out.messages = c.many(c.text)
        else:
            raise BinaryError(f"unknown section {tag!r}")
    return out


def _strings(values: list[bytes]) -> bytes:
    return struct.pack("<I", len(values)) + b"".join(v + b"\0" for v in values)


def write_ain(ain: Ain, with_variables: bool = True) -> bytes:
    """Functions go by name; without variables, by page and address."""
    section = lambda tag, body: tag + bytes(4) + body
    numbers = lambda v: struct.pack(f"<{len(v) + 1}I", len(v), *v)
    dlls = struct.pack("<I", len(ain.dlls))
    for name, functions in ain.dlls.items():
        dlls += name + b"\0" + struct.pack("<I", len(functions)) + b"".join(f + b"\0" + numbers(types) for f, types in functions)
    ordered = sorted(ain.functions, key=(lambda f: f[0]) if with_variables else (lambda f: f[1:]))
    out = section(b"HEL0", dlls) + section(b"FUNC", struct.pack("<I", len(ordered)) + b"".join(n + b"\0" + struct.pack("<HI", p, a) for n, p, a in ordered))
    if with_variables:
        out += section(b"VARI", _strings(ain.variables))
    if ain.messages:
        out += section(b"MSGI", _strings(ain.messages))
    return ain.magic.encode() + struct.pack("<I", ain.version) + _rotated(out, 6)


def aliases(ain: Ain) -> dict[tuple[int, int], list[bytes]]:
    """Names of each (page, address), the first one leading."""
    out: dict[tuple[int, int], list[bytes]] = {}
    for name, page, at in ain.functions:
        out.setdefault((page, at), []).append(name)
    return out


def ain_json(ain: Ain) -> str:
    text = lambda b: charset.decode(b, "�")
    whole = {
        "magic": ain.magic, "version": ain.version, "dlls": {text(d): [{"name": text(f), "args": t} for f, t in fs] for d, fs in ain.dlls.items()},
        "functions": [{"name": text(n), "page": p, "address": a} for n, p, a in ain.functions], "variables": list(map(text, ain.variables)), "messages": list(map(text, ain.messages)),
    }
    return json.dumps(whole, ensure_ascii=False, indent=2)


@dataclass
class Symbols:
    sources: list[tuple[bytes, bytes]] = field(default_factory=list)  # (name, text)
    functions: list[tuple[bytes, int, int, bool]] = field(default_factory=list)
    variables: list[bytes] = field(default_factory=list)
    lines: bytes = b""  # the LINE section's body, as it is


def read_symbols(data: bytes) -> Symbols:
    if data[:4] != SYMBOL_MARK or int.from_bytes(data[4:8], "little") != 0:
        raise BinaryError("no symbols of a known version")
    at, found = 12, {}
    for _ in range(int.from_bytes(data[8:12], "little")):
        if at + 8 > len(data):
            break
        size = int.from_bytes(data[at + 4 : at + 8], "little")
        found[data[at : at + 4]] = data[at + 8 : at + size]
        at += size
    strings = {}
    for tag in (b"SRCS", b"SCNT", b"VARI"):
        if tag not in found:
            raise BinaryError(f"no section {tag!r}")
        c = _Cursor(found[tag])
        strings[tag] = c.many(c.text)
        if c.at != len(c.data):
            raise BinaryError(f"section {tag!r} is too long")
    if len(strings[b"SRCS"]) != len(strings[b"SCNT"]):
        raise BinaryError("names and texts differ in number")
    out = Symbols(list(zip(strings[b"SRCS"], strings[b"SCNT"], strict=True)), [], strings[b"VARI"], found.get(b"LINE", b""))
    if b"FUNC" in found:
        c = _Cursor(found[b"FUNC"])
        out.functions = c.many(lambda: (c.text(), c.number(2), c.number(4), bool(c.number(1))))
    return out


def write_symbols(symbols: Symbols) -> bytes:
    functions = sorted(symbols.functions, key=lambda f: f[1:3])
    packed = struct.pack("<I", len(functions)) + b"".join(n + b"\0" + struct.pack("<HIB", p, a, own) for n, p, a, own in functions)
    bodies = [(b"SRCS", _strings([n for n, _ in symbols.sources])), (b"SCNT", _strings([t for _, t in symbols.sources])), (b"LINE", symbols.lines), (b"FUNC", packed), (b"VARI", _strings(symbols.variables))]
    return SYMBOL_MARK + struct.pack("<II", 0, len(bodies)) + b"".join(tag + struct.pack("<I", len(b) + 8) + b for tag, b in bodies)


def compressed_lines(rows: DataFrame, by: str = "page", seq: str = "seq") -> DataFrame:
    """(page, line, addr) of a line map: of rows of one address the last line counts; a row of the line before it goes."""
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(seq)
    last = rows.withColumn("__next", F.lead("addr").over(w)).where(F.col("__next").isNull() | (F.col("__next") != F.col("addr"))).drop("__next")
    return last.withColumn("__p", F.lag("line").over(w)).where(F.col("__p").isNull() | (F.col("__p") != F.col("line"))).select(by, "line", "addr")


def scan_pages(members: DataFrame) -> DataFrame:
    """(volume, entry_index, version, page, src_name, code, error) of archive members."""

    def one(data: bytes | None) -> tuple:
        try:
            p = read_page(data or b"")
            return p.version, p.page, charset.decode(p.name, "�"), p.code, None
        except BinaryError as e:
            return None, None, None, None, str(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows = [one(x) for x in rb.column(2).to_pylist()]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=["volume", "entry_index", "version", "page", "src_name", "code", "error"])

    return members.select("volume", "entry_index", "data").mapInArrow(run, "volume int, entry_index int, version string, page bigint, src_name string, code binary, error string")


def scan_ain(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a side file: dlls, functions (with aliases), variables and messages, numbered from 0. It is one small
    file by its form, so it is read at once."""
    ain = read_ain(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))
    text = lambda b: charset.decode(b, "�")
    return {
        "dlls": spark.createDataFrame([(text(d), i, text(f), t) for d, fs in ain.dlls.items() for i, (f, t) in enumerate(fs)], "dll string, id int, name string, argtypes array<int>"),
        "functions": spark.createDataFrame([(p, a, text(n[0]), list(map(text, n[1:]))) for (p, a), n in aliases(ain).items()], "page int, addr bigint, name string, aliases array<string>"),
        "variables": spark.createDataFrame([(i, text(v)) for i, v in enumerate(ain.variables)], "id int, name string"),
        "messages": spark.createDataFrame([(i, text(m)) for i, m in enumerate(ain.messages)], "id int, text string"),
    }
