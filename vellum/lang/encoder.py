"""Compiling script pages.

A page is parsed on its own to parts: bytes, and references by name to variables, constants, labels, functions, pages
and messages. What names mean is known when all pages are parsed; parts then get their sizes and places, and at last
the places of functions in other pages. So parsing and laying out are a task a page, and the three tables of names
between them are small by the format (16,384 variables, 65,536 pages).
"""

from __future__ import annotations

import pickle
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import charset
from vellum.lang import opcodes as O
from vellum.sources.binary import Ain, Page, Symbols, write_page
from vellum.sources.project import Config


class CompileError(ValueError):
    """A source that does not compile; begins with its place."""


def number_bytes(n: int) -> bytes:
    """A literal: see functions.arith.encode_number()."""
    if n <= 0x33:
        return bytes([n + 0x40])
    if n <= 0x3FFF:
        return n.to_bytes(2, "big")
    times, rest = divmod(n, 0x3FFF)
    return b"\x3f\xff" * times + (number_bytes(rest) + b"\x79" * times if rest else b"\x79" * (times - 1))


def variable_bytes(n: int) -> bytes:
    if n <= 0x3F:
        return bytes([n + 0x80])
    if n <= 0xFF:
        return bytes([0xC0, n])
    if n > 0x3FFF:
        raise CompileError(f"no form for variable {n}")
    return (n + 0xC000).to_bytes(2, "big")


@dataclass
class Unit:
    """A parsed page."""

    parts: list[tuple] = field(default_factory=list)
    names: list[tuple[str, str, object]] = field(default_factory=list)  # (kind, name, value) in order of first sight
    volume: int = 1
    messages: int = 0


_BLANK = re.compile(r"(?:[ \t\n\v\f\r　]|;[^\n]*|//[^\n]*|/\*.*?\*/)*", re.S)
_NAME = re.compile(r"[A-Za-z_.\x80-\U0010ffff][A-Za-z0-9_.\x80-\U0010ffff]*")
_FILE = re.compile(r"[A-Za-z0-9_.\x80-\U0010ffff]+")
_LABEL = re.compile(r"[!-#%-+\--9<-~\x80-\U0010ffff]+")
_NUMBER = re.compile(r"0[xX][0-9a-fA-F]+|0[bB][01]+|[0-9]+")
_CODEPOINT = re.compile(r"<\s*(0[xX][0-9a-fA-F]+|[0-9]+)\s*>")
_COMMAND = re.compile(r"[AR]|LXW[A-Z]{1,2}(?![A-Z])|ND[-+*/]|N[-+*/><=\\&|^~]|[A-Z]{1,3}(?![A-Z])|[a-z][A-Za-z0-9]*")
_FOREIGN = re.compile(r"([A-Za-z][A-Za-z0-9]*)\.([A-Za-z_0-9.]+)")


class Parser:
    def __init__(self, source: str, config: Config, name: str = "", first: bool = False, dlls: dict[str, list[tuple[str, list[int]]]] | None = None):
        self.s, self.at, self.c, self.name, self.dlls = source + "\n", 0, config, name, dlls or {}
        self.unit, self.out = Unit(), []
        self.version = float(config.sys_ver)
        self.ain = config.sys_ver == "3.9" and not config.disable_ain_message
        self.marks = 0
        self.open_menu = False
        self.branches: list[int] | None = [] if config.sys_ver == "3.5" else None
        self.raw = config.unicode
        self.line, self.counted = 1, 0
        if first and config.unicode:
            self.skip()
            self.line_here()
            self.emit(b"ZU\x41\x7f")

    # ---- reading

    def fail(self, what: str) -> CompileError:
        line = self.s.count("\n", 0, self.at) + 1
        return CompileError(f"{self.name}:{line}: {what}")

    def skip(self) -> None:
        self.at = _BLANK.match(self.s, self.at).end()
        if self.s.startswith("/*", self.at):
            raise self.fail("a comment is never closed")

    def peek(self) -> str:
        self.skip()
        return self.s[self.at : self.at + 1]

    def take(self, char: str) -> bool:
        if self.peek() != char:
            return False
        self.at += 1
        return True

    def expect(self, char: str) -> None:
        if not self.take(char):
            raise self.fail(f"no {char!r} here")

    def match(self, pattern: re.Pattern, what: str) -> str:
        self.skip()
        m = pattern.match(self.s, self.at)
        if not m:
            raise self.fail(f"no {what} here")
        self.at = m.end()
        return m[0]

    def keyword(self, word: str) -> bool:
        self.skip()
        m = re.compile(word + r"(?![A-Za-z0-9_])").match(self.s, self.at)
        if m:
            self.at = m.end()
        return bool(m)

    def number(self) -> int:
        text = self.match(_NUMBER, "number").lower()
        return int(text, 16 if text[:2] == "0x" else 2 if text[:2] == "0b" else 10)

    # ---- parts

    def emit(self, data: bytes) -> None:
        self.unit.parts.append(("bytes", data))

    def part(self, *part: object) -> None:
        self.unit.parts.append(part)

    def mark(self) -> int:
        self.marks += 1
        return self.marks

    def line_here(self) -> None:
        """The line of what follows, for symbols; the line end that was put behind the source does not count."""
        if self.c.debug:
            at = min(self.at, len(self.s) - 1)
            self.line, self.counted = self.line + self.s.count("\n", self.counted, at), at
            self.part("line", self.line)

    # ---- expressions

    def expression(self) -> None:
        self.level(len(O.LEVELS) - 1)
        self.emit(bytes([O.END]))

    def level(self, k: int) -> None:
        if k < 0:
            self.primary()
            return
        self.level(k - 1)
        while True:
            self.skip()
            op = next((x for x in O.LEVELS[k] if self.s.startswith(x, self.at)), None)
            if op is None:
                return
            self.at += len(op)
            self.level(k - 1)
            self.emit(bytes.fromhex(O.OPERATORS[op]))

    def primary(self) -> None:
        c = self.peek()
        if self.take("("):
            self.level(len(O.LEVELS) - 1)
            self.expect(")")
        elif c.isdigit() and c.isascii():
            self.emit(number_bytes(self.number()))
        elif self.take("#"):
            m = _FILE.match(self.s, self.at)
            if not m:
                raise self.fail("#file needs the name of a page")
            self.at = m.end()
            self.part("page", m[0])
        else:
            name = self.match(_NAME, "identifier")
            if name == "__LINE__":
                self.emit(number_bytes(self.s.count("\n", 0, self.at) + 1))
            else:
                self.variable(name, "name")

    def variable(self, name: str, kind: str = "var") -> None:
        """A variable, or (kind name) perhaps a constant; with an index, in brackets."""
        if self.take("["):
            self.part("index", name)
            self.expression()
            self.expect("]")
        else:
            self.part(kind, name)

    def own_variable(self) -> None:
        """A variable that comes into being here."""
        name = self.match(_NAME, "identifier")
        self.unit.names.append(("var", name, None))
        self.variable(name)

    # ---- strings

    def text(self, chars: str, compact: bool = False) -> bytes:
        if self.raw:
            return chars.encode("utf-8", "surrogatepass")
        raw = charset.encode(chars, b"?")
        if not compact:
            return raw
        out, i = bytearray(), 0
        while i < len(raw):
            if charset.is_lead(raw[i]) and i + 1 < len(raw):
                small = charset.compact(raw[i], raw[i + 1])
                out += bytes([small]) if small else raw[i : i + 2]
                i += 2
            else:
                out.append(raw[i])
                i += 1
        return bytes(out)

    def quoted(self, end: str, compact: bool = False, no_ascii: bool = False) -> bytes:
        """What stands before `end`, which is passed; backslashes take the next character as it is."""
        out, top = b"", self.at
        while True:
            c = self.s[self.at : self.at + 1]
            if not c or self.at >= len(self.s) - 1 and c != end:
                self.at = top
                raise self.fail("a string is never closed")
            if c == end:
                self.at += 1
                return out
            if c == "<":
                m = _CODEPOINT.match(self.s, self.at)
                if not m:
                    raise self.fail("<0x...> needs a code")
                cell = int(m[1], 0).to_bytes(2, "big")
                if self.raw:
                    try:
                        cell = charset.decode(cell).encode()
                    except UnicodeDecodeError:
                        raise self.fail(f"{m[1]} is no character") from None
                out += cell
                self.at = m.end()
                continue
            if c == "\\":
                self.at += 1
                c = self.s[self.at]
            if c.isascii() and no_ascii:
                raise self.fail("this text may hold wide characters only")
            out += self.text(c, compact)
            self.at += 1

    # ---- arguments

    def arguments(self, signature: str) -> None:
        for k, kind in enumerate(signature):
            if k and not (k == 1 and signature[0] == "n" and not self.take(",")):
                if not (k == 1 and signature[0] == "n"):
                    self.expect(",")
            self.argument(kind)
        self.expect(":")

    def argument(self, kind: str) -> None:
        if kind == "e":
            self.expression()
        elif kind == "n":
            self.emit(bytes([self.number() & 255]))
        elif kind == "v":
            self.variable(self.match(_NAME, "identifier"))
            self.emit(bytes([O.END]))
        elif kind == "F":
            self.part("func", self.match(_LABEL, "label"))
        elif kind == "o":
            self.expect('"')
            self.emit(b"\0" + bytes((b >> 4 | b << 4) & 255 for b in self.quoted('"')) + b"\0")
        else:
            while self.s[self.at] in " \t\n\v\f\r" and self.at < len(self.s) - 1:  # a wide space is text
                self.at += 1
            if self.s[self.at] == '"':
                self.at += 1
                data = self.quoted('"')
            else:
                m = re.compile(r"[^,:]*(?=[,:])").match(self.s, self.at)
                if not m:
                    raise self.fail("a string argument is never closed")
                data, self.at = self.text(m[0]), m.end()
            self.emit(data + (b"\0" if kind == "z" else b":"))

    # ---- commands

    def parse(self) -> Unit:
        self.commands()
        if self.peek():
            raise self.fail(f"{self.peek()!r} has no place here")
        if self.open_menu:
            raise self.fail("a menu item is never closed")
        if self.branches:
            raise self.fail("a block is never closed")
        return self.unit

    def commands(self) -> None:
        while self.command():
            pass

    def command(self) -> bool:
        c = self.peek()
        self.line_here()
        if not c or c == ">" or c == "}" and not self.branches:
            return False
        if c.isascii() and c.isalpha():
            return self.word()
        self.at += 1
        handler = {
            "'": self.message, "!": self.assign, "{": self.branch, "}": self.close_branch, "*": self.label_here, "@": lambda: self.jump(b"@"), "\\": self.call_label, "&": lambda: self.paged(b"&"),
            "%": lambda: self.paged(b"%"), "<": self.loop, "]": self.menu, "$": self.menu_item, "#": self.table, "_": lambda: self.address(":"), '"': self.data_string, "[": self.data, "~": self.call, "\x1a": lambda: None,
        }.get(c)
        if not handler:
            self.at -= 1
            raise self.fail(f"{c!r} begins no command")
        handler()
        return True

    def address(self, after: str | None = None) -> None:
        self.part("addr", self.match(_LABEL, "label"))
        if after:
            self.expect(after)

    def message(self) -> None:
        if self.ain:
            self.emit(O.extended()["ainMsg"][0])
            self.new_message(self.quoted("'"))
        elif self.version >= 3.8:
            self.emit(O.extended()["msg"][0] + self.quoted("'") + b"\0")
        else:
            self.emit(self.quoted("'", self.version == 3.5, True))

    def new_message(self, data: bytes) -> None:
        self.part("msg", self.unit.messages, data)
        self.unit.messages += 1

    def assign(self) -> None:
        place = len(self.unit.parts)
        self.emit(b"!")
        self.own_variable()
        for k, op in enumerate("+-*/%&|^"):
            if self.take(op):
                self.unit.parts[place] = ("bytes", bytes([0x10 + k]))
                break
        self.expect(":")
        self.expression()
        self.expect("!")

    def branch(self) -> None:
        self.emit(b"{")
        self.expression()
        self.expect(":")
        end = self.mark()
        self.part("addr", end)
        if self.branches is not None:
            self.branches.append(end)
            return
        self.commands()
        self.expect("}")
        if self.version >= 3.8 and not self.c.disable_else:
            done = self.mark()
            self.emit(b"@")
            self.part("addr", done)
            self.part("mark", end)
            end = done
            if self.keyword("else"):
                if self.keyword("if"):
                    self.expect("{")
                    self.branch()
                else:
                    self.expect("{")
                    self.commands()
                    self.expect("}")
        self.part("mark", end)

    def close_branch(self) -> None:
        self.part("mark", self.branches.pop())

    def label_here(self) -> None:
        if self.take("*"):
            name = self.match(_LABEL, "label")
            parameters: list[str] = []
            while not self.take(":"):
                if parameters:
                    self.expect(",")
                parameters.append(self.match(_NAME, "identifier"))
            self.unit.names.append(("func", name, parameters))
            self.part("def", name, parameters)
        else:
            self.part("mark", self.match(_LABEL, "label"))
            self.expect(":")

    def jump(self, code: bytes) -> None:
        self.emit(code)
        self.address(":")

    def call_label(self) -> None:
        if self.take("0"):
            self.emit(b"\\" + bytes(4))
            self.expect(":")
        else:
            self.emit(b"\\")
            self.part("addr", self.match(_LABEL, "label"), True)
            self.expect(":")

    def paged(self, code: bytes) -> None:
        self.emit(code)
        self.expression()
        self.expect(":")

    def loop(self) -> None:
        end, again = self.mark(), self.mark()
        if self.take("@"):
            self.part("mark", again)
            self.emit(b"{")
            self.expression()
            self.expect(":")
            self.part("addr", end)
        else:
            self.emit(b"!")
            first = len(self.unit.parts)
            self.own_variable()
            variable = self.unit.parts[first:]
            self.expect(",")
            self.expression()
            self.expect(",")
            self.emit(b"<\0")
            self.part("mark", again)
            self.emit(b"<\x01")
            self.part("addr", end)
            self.unit.parts += variable
            self.emit(bytes([O.END]))
            for after in ",,:":
                self.expression()
                self.expect(after)
        self.commands()
        self.expect(">")
        self.emit(b">")
        self.part("addr", again)
        self.part("mark", end)

    def menu(self) -> None:
        self.emit((O.extended()["menu"][0] if self.version >= 3.8 else b"") + b"]")

    def menu_item(self) -> None:
        self.emit(b"$")
        if self.open_menu:
            self.open_menu = False
            return
        self.address("$")
        if self.s[self.at].isascii():
            self.open_menu = True
        else:
            self.emit(self.quoted("$", self.version == 3.5, True) + b"$")

    def table(self) -> None:
        self.emit(b"#")
        self.address(",")
        self.expression()
        self.expect(":")

    def data_string(self) -> None:
        self.emit(self.quoted('"', self.version == 3.5) + b"\0")

    def data(self) -> None:
        first = True
        while not self.take("]"):
            if not first:
                self.expect(",")
            first = False
            n = self.number()
            if n > 0xFFFF:
                raise self.fail(f"{n} does not fit a datum")
            self.emit(bytes([n & 255]) if self.take("b") else n.to_bytes(2, "little"))

    def call(self) -> None:
        if self.take("~"):
            self.emit(b"~\xff\xff")
            self.variable(self.match(_NAME, "identifier"))
            self.emit(bytes([O.END]))
            self.expect(":")
            return
        name = self.match(_LABEL, "label")
        if name == "0":
            self.emit(b"~\0\0")
            self.expect(",")
            self.expression()
            self.expect(":")
            return
        given, whole = [], self.unit.parts
        self.take(",")
        while not self.take(":"):
            if given:
                self.expect(",")
            self.unit.parts = []
            self.expression()
            given.append(self.unit.parts)
        self.unit.parts = whole
        self.part("call", name, given, self.s.count("\n", 0, self.at) + 1)

    def word(self) -> bool:
        foreign = _FOREIGN.match(self.s, self.at) if self.version == 3.9 else None
        if foreign:
            self.foreign(foreign)
            return True
        m = _COMMAND.match(self.s, self.at)
        if not m:
            raise self.fail("no command of this name")
        top, name = self.at, m[0]
        self.at = m.end()
        if name in ("A", "R"):
            self.emit(name.encode())
        elif name == "if":
            self.expect("{")
            self.branch()
        elif name == "const":
            self.constants()
        elif name == "pragma":
            self.pragma()
        elif name == "ZU":
            self.number()
            self.expect(":")
        else:
            code, signature = self.lookup(name)
            if code is None:
                self.at = top
                raise self.fail(f"no command is called {name}")
            self.emit(code)
            if signature == "G":
                self.page_command()
            elif isinstance(signature, dict):
                n = self.number()
                self.emit(bytes([n & 255]))
                self.take(",")
                if n in signature:
                    self.arguments(signature[n])
            else:
                if code in (O.extended()[x][0] for x in ("ainH", "ainHH", "ainX")):
                    self.new_message(b"")
                self.arguments(signature)
        return True

    def lookup(self, name: str) -> tuple[bytes | None, object]:
        more, plain = O.extended(), O.letters()
        if name in O.ALWAYS or name[0].islower() and name in more:
            return more[name]
        if self.version >= 3.8:
            if self.ain and name in O.WITH_MESSAGES:
                return more[O.WITH_MESSAGES[name]]
            if name in O.SAME_NAME:
                return more[name]
            if f"new{name}" in more:
                return more[f"new{name}"][0], O.numbered().get(f"new{name}", more[f"new{name}"][1])
        if name == "G":
            return b"G", "G"
        if name == "SR":
            return b"SR", "ev" if self.version == 3.5 or self.c.old_SR else "nv"
        if name in O.numbered():
            return name.encode(), O.numbered()[name]
        return (name.encode(), plain[name]) if name in plain else (None, None)

    def page_command(self) -> None:
        """One expression or two, with their number less one before; the colon may be left out."""
        place = len(self.unit.parts)
        self.emit(b"\0")
        self.expression()
        if self.take(","):
            self.unit.parts[place] = ("bytes", b"\1")
            self.expression()
        self.take(":")

    def constants(self) -> None:
        if not self.keyword("word"):
            raise self.fail("constants are words")
        while True:
            name = self.match(_NAME, "identifier")
            self.take("=")
            self.unit.names.append(("const", name, self.number()))
            if not self.take(","):
                break
        self.expect(":")

    def pragma(self) -> None:
        if self.keyword("ald_volume"):
            self.unit.volume = self.number()
        elif self.keyword("address"):
            self.part("at", self.number())
        else:
            raise self.fail("no pragma of this name")
        self.expect(":")

    def foreign(self, m: re.Match) -> None:
        names = list(self.dlls)
        functions = self.dlls.get(m[1]) or []
        place = next((i for i, (f, _) in enumerate(functions) if f == m[2]), None)
        if place is None:
            raise self.fail(f"no library has a function {m[0]}")
        self.at = m.end()
        self.emit(O.extended()["dllCall"][0] + names.index(m[1]).to_bytes(4, "little") + place.to_bytes(4, "little"))
        comma = False
        for kind in functions[place][1]:
            if kind in (0, 1, 3, 18):
                if comma:
                    self.expect(",")
                comma = True
                if kind == 18:
                    self.expect('"')
                    self.emit(self.quoted('"') + b"\0")
                else:
                    self.expression()
            else:
                self.emit(number_bytes(0) + bytes([O.END]))
        self.expect(":")


# ---- names and places


@dataclass
class Names:
    variables: dict[str, int] = field(default_factory=dict)
    constants: dict[str, int] = field(default_factory=dict)
    functions: dict[str, list[str]] = field(default_factory=dict)
    pages: dict[str, int] = field(default_factory=dict)  # lower-case file name: the first page of it
    messages: dict[int, int] = field(default_factory=dict)  # page: number of its first message

    def add(self, kind: str, name: str, value: object) -> None:
        if kind == "var":
            if name in self.constants:
                raise CompileError(f"{name!r} names a constant and a variable")
            self.variables.setdefault(name, len(self.variables))
        elif kind == "const":
            if name in self.constants or name in self.variables:
                raise CompileError(f"two constants are called {name!r}")
            self.constants[name] = value
        else:
            if name in self.functions:
                raise CompileError(f"two functions are called {name!r}")
            self.functions[name] = value


@dataclass
class Laid:
    code: bytearray
    functions: dict[str, int] = field(default_factory=dict)
    holes: list[tuple[int, str]] = field(default_factory=list)  # places of six bytes for (page + 1, address)
    messages: list[bytes] = field(default_factory=list)
    called: dict[str, int] = field(default_factory=dict)  # labels that calls name
    lines: list[tuple[int, int]] = field(default_factory=list)  # (line, address), with config.debug


def lay_out(unit: Unit, names: Names, page: int, start: int, where: str = "") -> Laid:
    """A page's bytes from address `start` on; labels are set, functions are holes."""
    out = Laid(bytearray())
    labels: dict[object, int] = {}
    refs: list[tuple[int, object]] = []

    def variable(name: str) -> int:
        if name not in names.variables:
            raise CompileError(f"{where}: no variable is called {name!r}")
        return names.variables[name]

    def put(parts: list[tuple]) -> None:
        for kind, *x in parts:
            if kind == "bytes":
                out.code += x[0]
            elif kind == "var" or kind == "name" and x[0] not in names.constants:
                out.code += variable_bytes(variable(x[0]))
            elif kind == "name":
                out.code += number_bytes(names.constants[x[0]])
            elif kind == "index":
                out.code += O.INDEX + variable(x[0]).to_bytes(2, "big")
            elif kind == "page":
                if x[0].lower() not in names.pages:
                    raise CompileError(f"{where}: the project has no page {x[0]!r}")
                out.code += number_bytes(names.pages[x[0].lower()])
            elif kind == "addr":
                refs.append((len(out.code), x[0]))
                if x[1:]:
                    out.called[x[0]] = 0
                out.code += bytes(4)
            elif kind == "mark":
                if x[0] in labels:
                    raise CompileError(f"{where}: two labels are called {x[0]!r}")
                labels[x[0]] = start + len(out.code)
            elif kind == "def":
                for p in x[1]:
                    variable(p)
                out.functions[x[0]] = start + len(out.code)
            elif kind == "func":
                function(x[0])
            elif kind == "call":
                wanted = names.functions.get(x[0])
                if wanted is None:
                    raise CompileError(f"{where}:{x[2]}: no function is called {x[0]!r}")
                if len(wanted) != len(x[1]):
                    raise CompileError(f"{where}:{x[2]}: {x[0]!r} takes {len(wanted)} arguments")
                for p, value in zip(wanted, x[1], strict=True):
                    out.code += b"!" + variable_bytes(variable(p))
                    put(value)
                out.code += b"~"
                function(x[0])
            elif kind == "msg":
                out.code += (names.messages.get(page, 0) + x[0]).to_bytes(4, "little")
                out.messages.append(x[1])
            elif kind == "at":
                size = max(0, x[0] - start)
                out.code[size:] = b""
                out.code += bytes(size - len(out.code))
                out.lines.clear()
            elif kind == "line":
                here = start + len(out.code)
                if out.lines and out.lines[-1][1] == here:
                    out.lines[-1] = (x[0], here)
                elif not out.lines or out.lines[-1][0] != x[0]:
                    out.lines.append((x[0], here))

    def function(name: str) -> None:
        if name not in names.functions:
            raise CompileError(f"{where}: no function is called {name!r}")
        out.holes.append((len(out.code), name))
        out.code += bytes(6)

    put(unit.parts)
    for at, label in refs:
        if label not in labels:
            raise CompileError(f"{where}: no label is called {label!r}")
        if at + 4 <= len(out.code):
            out.code[at : at + 4] = labels[label].to_bytes(4, "little")
    out.called = {x: labels[x] for x in out.called}
    del out.lines[-1:]  # the page's end
    return out


def fill(laid: Laid, places: dict[str, tuple[int, int]]) -> bytes:
    for at, name in laid.holes:
        page, address = places[name]
        if at + 6 <= len(laid.code):
            laid.code[at : at + 6] = (page + 1).to_bytes(2, "little") + address.to_bytes(4, "little")
    return bytes(laid.code)


def _head(name: str, config: Config) -> tuple[bytes, int]:
    raw = name.replace("/", "\\")
    data = raw.encode() if config.unicode else charset.encode(raw, b"?")
    return data, (18 + len(data) + 15) & ~15


def compile_pages(sources: list[tuple[str, str]], config: Config, variables: list[str] | None = None, dlls: dict | None = None) -> tuple[list[bytes], Names, list[bytes]]:
    """Pages of (name, text) in page order, the names, and the messages; for a few pages, without Spark."""
    names = Names({v: i for i, v in enumerate(variables or [])})
    units = [Parser(text, config, name, i == 0, dlls).parse() for i, (name, text) in enumerate(sources)]
    count = 0
    for i, ((name, _), unit) in enumerate(zip(sources, units, strict=True)):
        names.pages.setdefault(name.replace("\\", "/").rpartition("/")[2].lower(), i)
        names.messages[i] = count
        count += unit.messages
        for kind, key, value in unit.names:
            names.add(kind, key, value)
    laid = [lay_out(u, names, i, _head(n, config)[1], n) for i, ((n, _), u) in enumerate(zip(sources, units, strict=True))]
    places = {f: (i, a) for i, x in enumerate(laid) for f, a in x.functions.items()}
    pages = [write_page(Page(config.sco_ver, i, _head(n, config)[0], fill(x, places))) for i, ((n, _), x) in enumerate(zip(sources, laid, strict=True))]
    return pages, names, [m for x in laid for m in x.messages]


@dataclass
class Compiled:
    """Tables of a compiled project."""

    pages: DataFrame  # (page, name, volume, content); volume 0 is not to be written
    messages: DataFrame  # (id, page, data), ids as the pages have them
    functions: DataFrame  # (name, page, addr, own), pages from 0; own: a label of its page that a call names
    variables: DataFrame  # (id, name)
    lines: DataFrame  # (page, lines), an array of (line, addr) for each page; empty without config.debug


def compile_project(sources: DataFrame, config: Config, variables: list[str] | None = None, dlls: dict | None = None) -> DataFrame:
    """The pages of compile_tables(). Where config has messages in the side file, their texts are not in them."""
    return compile_tables(sources, config, variables, dlls).pages


def compile_tables(sources: DataFrame, config: Config, variables: list[str] | None = None, dlls: dict | None = None) -> Compiled:
    """The project of (page, name, text) rows, page 0 first.

    Pages are parsed and laid out in parallel. Names are numbered by their first sight in (page, place) order, over the
    table of names alone; what reaches the driver is that table, without texts or code."""
    spark = sources.sparkSession

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = zip(frame["page"], frame["name"], frame["text"], strict=True)
            units = [Parser(text, config, name, page == 0, dlls).parse() for page, name, text in rows]
            yield pd.DataFrame({"page": frame["page"], "name": frame["name"], "volume": [u.volume for u in units], "messages": [u.messages for u in units], "unit": [pickle.dumps(u) for u in units]})

    units = sources.select("page", "name", "text").mapInPandas(parse, "page int, name string, volume int, messages int, unit binary").persist()

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(p, i, k, n, pickle.dumps(v)) for p, u in zip(frame["page"], frame["unit"], strict=True) for i, (k, n, v) in enumerate(pickle.loads(bytes(u)).names)]
            yield pd.DataFrame(rows, columns=["page", "seq", "kind", "name", "value"])

    told = units.select("page", "unit").mapInPandas(seen, "page int, seq int, kind string, name string, value binary")
    first = F.row_number().over(Window.partitionBy("kind", "name").orderBy("page", "seq"))
    kept = told.withColumn("__r", first).where((F.col("__r") == 1) | (F.col("kind") != "var"))  # a variable's first sight
    names = Names({v: i for i, v in enumerate(variables or [])})
    for r in kept.orderBy("page", "seq").collect():
        names.add(r["kind"], r["name"], pickle.loads(bytes(r["value"])))
    count = 0
    for r in units.select("page", "name", "messages").orderBy("page").collect():
        names.pages.setdefault(r["name"].replace("\\", "/").rpartition("/")[2].lower(), r["page"])
        names.messages[r["page"]] = count
        count += r["messages"]
    shared = spark.sparkContext.broadcast(names)

    def lay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            laid = [lay_out(pickle.loads(bytes(u)), shared.value, p, _head(n, config)[1], n) for p, n, u in zip(frame["page"], frame["name"], frame["unit"], strict=True)]
            yield pd.DataFrame({"page": frame["page"], "name": frame["name"], "volume": frame["volume"], "laid": [pickle.dumps(x) for x in laid], "functions": [list(x.functions) for x in laid], "places": [list(x.functions.values()) for x in laid]})

    placed = units.mapInPandas(lay, "page int, name string, volume int, laid binary, functions array<string>, places array<int>").persist()
    rows = placed.select("page", F.explode(F.arrays_zip("functions", "places")).alias("f")).select("page", "f.functions", "f.places").collect()
    places = spark.sparkContext.broadcast({r["functions"]: (r["page"], r["places"]) for r in rows})

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pages = [write_page(Page(config.sco_ver, int(p), _head(n, config)[0], fill(pickle.loads(bytes(x)), places.value))) for p, n, x in zip(frame["page"], frame["name"], frame["laid"], strict=True)]
            yield pd.DataFrame({"page": frame["page"], "name": frame["name"], "volume": frame["volume"], "content": pages})

    def told_by(row) -> object:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for p, x in zip(frame["page"], frame["laid"], strict=True):
                    yield row(int(p), pickle.loads(bytes(x)))

        return run

    def messages(p: int, x: Laid) -> pd.DataFrame:
        first = shared.value.messages[p]
        return pd.DataFrame([(first + i, p, m) for i, m in enumerate(x.messages)], columns=["id", "page", "data"])

    def functions(p: int, x: Laid) -> pd.DataFrame:
        return pd.DataFrame([(n, p, a, own) for own, known in ((True, x.called), (False, x.functions)) for n, a in known.items()], columns=["name", "page", "addr", "own"])

    def lines(p: int, x: Laid) -> pd.DataFrame:
        return pd.DataFrame({"page": [p], "lines": [[{"line": n, "addr": a} for n, a in x.lines]]})

    laid = placed.select("page", "laid")
    return Compiled(
        placed.select("page", "name", "volume", "laid").mapInPandas(link, "page int, name string, volume int, content binary"),
        laid.mapInPandas(told_by(messages), "id bigint, page int, data binary"),
        laid.mapInPandas(told_by(functions), "name string, page int, addr bigint, own boolean"),
        spark.createDataFrame([(i, v) for v, i in names.variables.items()], "id int, name string"),
        laid.mapInPandas(told_by(lines), "page int, lines array<struct<line:int,addr:bigint>>"),
    )


def side_file(made: Compiled, config: Config, dlls: dict | None = None) -> Ain:
    """What the system reads beside the pages of version 3.9: its form is one file, so it comes to the driver."""
    text = lambda x: x.encode() if config.unicode else charset.encode(x, b"?")
    return Ain(
        config.ain_magic, config.ain_version, {text(d): [(text(f), list(types)) for f, types in fs] for d, fs in (dlls or {}).items()},
        [(text(r["name"]), r["page"] + 1, r["addr"]) for r in made.functions.where("not own").orderBy("page", "addr").collect()],
        [text(r["name"]) for r in made.variables.orderBy("id").collect()], [bytes(r["data"]) for r in made.messages.orderBy("id").collect()],
    )


def symbols(made: Compiled, sources: list[tuple[str, str]]) -> Symbols:
    """Symbols of a project compiled with config.debug, from the (name, text) of its pages in order."""
    told = [[(x["line"], x["addr"]) for x in r["lines"]] for r in made.lines.orderBy("page").collect()]
    return Symbols(
        [(n.encode(), t.encode()) for n, t in sources], [(r["name"].encode(), r["page"], r["addr"], r["own"]) for r in made.functions.orderBy("page", "addr", F.desc("own"), "name").collect()],
        [r["name"].encode() for r in made.variables.orderBy("id").collect()],
        struct.pack("<I", len(told)) + b"".join(struct.pack(f"<{2 * len(x) + 1}I", len(x), *[n for pair in x for n in pair]) for x in told),
    )
