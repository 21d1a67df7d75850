"""Reading compiled pages back to source that compiles to the same bytes.

Each page is followed from its start, from its labels and from the functions that any page calls in it; what is never
reached is data. Calls name places in other pages, so pages are followed in rounds until no new place turns up; a round
only looks at pages that got one. What every call of a function assigns last are its parameters. Conditions get their else branches back where every page's jumps allow it; else the
source is for `disable_else`, with the jumps written out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import charset
from vellum.lang import opcodes as O
from vellum.operators import tables
from vellum.sources.binary import Page, read_page
from vellum.sources.project import Config

_BINARY = {int(v, 16): k for k, v in O.OPERATORS.items() if len(v) == 2}
_EXTRA = {int(v[2:], 16): k for k, v in O.OPERATORS.items() if len(v) == 4}
_RANK = {op: len(O.LEVELS) - k for k, ops in enumerate(O.LEVELS) for op in ops}


#: Assignments at once that are no arguments in the first page.
_SET_UP = 20


class DecodeError(ValueError):
    pass


@dataclass
class Names:
    variables: list[str] = field(default_factory=list)
    functions: dict[tuple[int, int], str] = field(default_factory=dict)  # (page, address)
    messages: list[bytes] = field(default_factory=list)
    dlls: list[tuple[str, list[tuple[str, list[int]]]]] = field(default_factory=list)
    aliases: dict[tuple[int, int], list[str]] = field(default_factory=dict)  # further names of a function
    parameters: dict[tuple[int, int], list[int]] = field(default_factory=dict)  # variables that its calls give values

    def variable(self, n: int) -> str:
        return self.variables[n] if n < len(self.variables) and self.variables[n] else f"VAR{n}"

    def function(self, page: int, address: int) -> str:
        return self.functions.get((page, address)) or f"F_{page}_{address:05x}"

    def heads(self, page: int, address: int) -> list[str]:
        """Lines that begin the function, one for each of its names."""
        given = ", ".join(map(self.variable, self.parameters.get((page, address), ())))
        return [f"**{n} {given}".rstrip() + ":" for n in (self.function(page, address), *self.aliases.get((page, address), ()))]


# ---- expressions


def show(node: tuple, names: Names, least: int = 0) -> str:
    """Text of an expression tree with no more brackets than it needs; right operands bind one tighter."""
    kind, *x = node
    if kind == "number":
        return str(x[0])
    if kind == "variable":
        return names.variable(x[0])
    if kind == "index":
        return f"{names.variable(x[0])}[{show(x[1], names)}]"
    rank = _RANK[kind]
    text = f"{show(x[0], names, rank)}{' $ ' if kind == '$' else kind}{show(x[1], names, rank + 1)}"
    return f"({text})" if rank < least else text


def fold(op: str, left: tuple, right: tuple) -> tuple:
    """A node; 16383 plus a number is the number it was written as, up to 65535."""
    if op == "+" and left == ("number", 0x3FFF) and right[0] == "number" and right[1] + 0x3FFF <= 0xFFFF:
        return ("number", right[1] + 0x3FFF)
    return (op, left, right)


class Reader:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at

    def byte(self) -> int:
        if self.at >= len(self.data):
            raise DecodeError("the page ends early")
        self.at += 1
        return self.data[self.at - 1]

    def number(self, size: int) -> int:
        if self.at + size > len(self.data):
            raise DecodeError("the page ends early")
        self.at += size
        return int.from_bytes(self.data[self.at - size : self.at], "little")

    def variable(self, first: int | None = None) -> tuple:
        b = self.byte() if first is None else first
        if 0x80 <= b <= 0xBF:
            return ("variable", b - 0x80)
        if b == 0xC0:
            n = self.byte()
            if n == 1:
                place = self.byte() << 8 | self.byte()
                return ("index", place, self.expression())
            if n >= 0x40:
                return ("variable", n)
        elif b > 0xC0:
            return ("variable", (b << 8 | self.byte()) & 0x3FFF)
        raise DecodeError("no variable")

    def expression(self) -> tuple:
        stack: list[tuple] = []
        while True:
            b = self.byte()
            if b == O.END:
                break
            op = _BINARY.get(b)
            if b == 0xC0 and self.at < len(self.data) and self.data[self.at] in _EXTRA:
                op = _EXTRA[self.byte()]
            if op:
                if len(stack) < 2:
                    raise DecodeError("an operator without operands")
                right, left = stack.pop(), stack.pop()
                stack.append(fold(op, left, right))
            elif b >= 0x80:
                stack.append(self.variable(b))
            elif b >= 0x40:
                stack.append(("number", b - 0x40))
            else:
                stack.append(("number", b << 8 | self.byte()))
        if not stack:
            raise DecodeError("an empty expression")
        node = stack[0]
        for x in stack[1:]:  # operands that no operator takes
            node = ("$", node, x)
        return node

    def string(self, end: int) -> bytes:
        at = self.data.find(bytes([end]), self.at)
        if at < 0:
            raise DecodeError("a string without end")
        out, self.at = self.data[self.at : at], at + 1
        return out


# ---- instructions


@dataclass
class Step:
    start: int
    end: int
    text: str
    kind: str = ""  # "if", "else-jump", "loop", "next" and so on, where structure needs it
    targets: tuple[int, ...] = ()  # addresses that code goes on at
    marks: tuple[int, ...] = ()  # addresses that need a label, data ones too
    calls: tuple[tuple[int, int], ...] = ()
    stops: bool = False  # what follows is only reached from elsewhere
    sets: tuple[int, str] | None = None  # variable and value of a plain assignment


class Walker:
    """Follows a page's code."""

    def __init__(self, page: Page, start: int, config: Config, names: Names):
        self.page, self.start, self.c, self.names = page, start, config, names
        self.data = bytes(start) + page.code
        self.version = float(config.sys_ver)
        self.steps: dict[int, Step] = {}
        self.bad: set[int] = set()
        first = start
        if page.page == 0 and page.code[:4] == b"ZU\x41\x7f":
            self.c.unicode, first = True, start + 4
        self.first = first
        self.by_code = {code: (name, sig) for name, (code, sig) in O.extended().items()}
        self.follow([first])

    def follow(self, places: list[int]) -> None:
        todo = list(places)
        while todo:
            at = todo.pop()
            while self.start <= at < len(self.data) and at not in self.steps and at not in self.bad:
                try:
                    step = self.step(at)
                except DecodeError:
                    self.bad.add(at)
                    break
                self.steps[at] = step
                todo += step.targets
                if step.stops:
                    break
                at = step.end

    def calls(self) -> set[tuple[int, int]]:
        return {c for s in self.steps.values() for c in s.calls}

    def assigned(self, functions: set[int]) -> dict[int, list[Step]]:
        """Of each call, by its address, the plain assignments right before it, without a place among them that code is
        come to from elsewhere. More than 20 at once from variable 0 on in the first page set the program up: none."""
        entered = functions.union(*[(*s.targets, *s.marks) for s in self.steps.values()])
        before = {s.end: s for s in self.steps.values() if s.sets}
        out = {}
        for s in self.steps.values():
            if s.kind == "call":
                run, at = [], s.start
                while at not in entered and at in before:
                    run.append(before[at])
                    at = before[at].start
                first = len(run) > _SET_UP and self.page.page == 0 and run[-1].sets[0] == 0
                out[s.start] = [] if first else run[::-1]
        return out

    def given(self, functions: set[int]) -> list[tuple[int, int, list[int]]]:
        """(page, address, variables assigned) of each call."""
        return [(*self.steps[at].calls[0], [x.sets[0] for x in run]) for at, run in self.assigned(functions).items()]

    # one instruction

    def step(self, at: int) -> Step:
        r = Reader(self.data, at)
        b = r.byte()
        c = chr(b)
        say = lambda node: show(node, self.names)
        done = lambda text, **more: Step(at, r.at, text, **more)
        if b == 0x21 or 0x10 <= b <= 0x17:
            variable = r.variable()
            op = "" if b == 0x21 else "+-*/%&|^"[b - 0x10]
            value = r.expression()
            if b == 0x21 and self.data[r.at : r.at + 4] == b"<\0<\x01":
                return self.counted(at, r, variable, value)
            plain = b == 0x21 and variable[0] == "variable"
            return done(f"!{say(variable)}{op}:{say(value)}!", sets=(variable[1], say(value)) if plain else None)
        if c == "{":
            value, end = r.expression(), r.number(4)
            return done(f"{{{say(value)}:", kind="if", targets=(end,))
        if c in "@\\":
            target = r.number(4)
            if c == "\\" and target == 0:
                return done("\\0:", stops=True)
            self.code_place(target)
            return done(c + "{}:", kind="jump" if c == "@" else "", targets=(target,), marks=(target,), stops=c == "@")
        if c in "&%":
            return done(f"{c}{say(r.expression())}:", stops=c == "&")
        if c == ">":
            return done(">", kind="next", targets=(r.number(4),), stops=True)
        if c == "]":
            return done("]")
        if c == "$":
            return self.menu(at, r)
        if c == "#":
            target = r.number(4)
            return done("#{}," + say(r.expression()) + ":", marks=(target,))
        if c == "~":
            return self.call(at, r)
        if c in "AR":
            return done(c)
        if b == 0x2F:
            return self.extended(at, r)
        if "A" <= c <= "Z":
            return self.letters(at, r)
        if self.version < 3.8 and (b == 0x20 or b >= 0x80):
            r.at = at
            return done(self.text_run(r))
        raise DecodeError(f"no command {b:02x}")

    def code_place(self, target: int) -> None:
        if not self.start <= target < len(self.data) + 1:
            raise DecodeError("a jump out of the page")

    def counted(self, at: int, r: Reader, variable: tuple, first: tuple) -> Step:
        r.at += 4
        end = r.number(4)
        if r.variable() != variable or r.byte() != O.END:
            raise DecodeError("a loop over two variables")
        rest = [show(r.expression(), self.names) for _ in range(3)]
        text = f"<{show(variable, self.names)},{show(first, self.names)},{','.join(rest)}:"
        return Step(at, r.at, text, kind="loop", targets=(end,))

    def menu(self, at: int, r: Reader) -> Step:
        if getattr(self, "_open", None) == at:  # set by the step that opened it
            return Step(at, r.at, "$")
        target = r.number(4)
        self.code_place(target)
        b = self.data[r.at] if r.at < len(self.data) else 0
        if self.version < 3.8 and (b == 0x20 or b >= 0x80):
            text = self.text_run(r)[1:-1]
            if r.byte() != 0x24 or text[:1].isascii():
                raise DecodeError("a menu item without end")
            return Step(at, r.at, "${}$" + text.replace("{", "{{").replace("}", "}}") + "$", targets=(target,), marks=(target,))
        # The item's commands come next, and a $ of its own ends them.
        own = r.at
        while own < len(self.data) and self.data[own] != 0x24:
            own = self.step(own).end
        self._open = own
        return Step(at, r.at, "${}$", targets=(target,), marks=(target,))

    def call(self, at: int, r: Reader) -> Step:
        page = r.number(2)
        if page == 0xFFFF:
            variable = r.variable()
            if r.byte() != O.END:
                raise DecodeError("no end")
            return Step(at, r.at, f"~~{show(variable, self.names)}:")
        if page == 0:
            value = show(r.expression(), self.names)
            return Step(at, r.at, f"~0,{value}:", stops=True)
        place = (page - 1, r.number(4))
        return Step(at, r.at, f"~{self.names.function(*place)}:", kind="call", calls=(place,))

    def letters(self, at: int, r: Reader) -> Step:
        for size in (3, 2, 1):
            name = self.data[at : at + size].decode("latin-1")
            r.at = at + size
            if name == "G" and size == 1:
                two = r.byte()
                if two > 1:
                    continue
                args = [show(r.expression(), self.names) for _ in range(two + 1)]
                return Step(at, r.at, f"G {', '.join(args)}:")
            if name == "SR":
                old = self.version == 3.5 or self.c.old_SR
                return self.finish(at, r, name, "ev" if old else "nv")
            if name in O.numbered() and name != "newUP":
                n = r.byte()
                if n not in O.numbered()[name]:
                    raise DecodeError("no such sub-command")
                return self.finish(at, r, f"{name} {n}", O.numbered()[name][n], "," if O.numbered()[name][n] else "")
            if name in O.letters():
                return self.finish(at, r, name, O.letters()[name])
        raise DecodeError("no command")

    def extended(self, at: int, r: Reader) -> Step:
        code = self.data[at : at + 2]
        if code not in self.by_code:
            raise DecodeError("no command")
        name, signature = self.by_code[code]
        r.at = at + 2
        if name == "msg":
            return self.message(at, r, r.string(0))
        if name == "ainMsg":
            n = r.number(4)
            if n >= len(self.names.messages):
                raise DecodeError("no such message")
            return self.message(at, r, self.names.messages[n])
        if name == "menu":
            if r.byte() != 0x5D:
                raise DecodeError("a menu without end")
            return Step(at, r.at, "]")
        if name == "dllCall":
            return self.foreign(at, r)
        if name in O.WITH_MESSAGES.values():
            r.number(4)
            name = next(k for k, v in O.WITH_MESSAGES.items() if v == name)
        elif name == "newUP":
            n = r.byte()
            if n not in O.numbered()["newUP"]:
                raise DecodeError("no such sub-command")
            return self.finish(at, r, f"UP {n}", O.numbered()["newUP"][n], ",")
        elif name.startswith("new"):
            name = name[3:]
        return self.finish(at, r, name, signature)

    def foreign(self, at: int, r: Reader) -> Step:
        d, f = r.number(4), r.number(4)
        if d >= len(self.names.dlls) or f >= len(self.names.dlls[d][1]):
            raise DecodeError("no such function")
        dll, functions = self.names.dlls[d]
        args = []
        for kind in functions[f][1]:
            if kind == 18:
                args.append(self.quoted(r.string(0), '"'))
            elif kind in (0, 1, 3):
                args.append(show(r.expression(), self.names))
            elif r.expression() != ("number", 0):
                raise DecodeError("an object that is not 0")
        return Step(at, r.at, f"{dll}.{functions[f][0]}{' ' if args else ''}{', '.join(args)}:")

    def finish(self, at: int, r: Reader, name: str, signature: str, joint: str = "") -> Step:
        args, calls = [], []
        for kind in signature:
            if kind == "e":
                args.append(show(r.expression(), self.names))
            elif kind == "n":
                args.append(str(r.byte()))
            elif kind == "v":
                args.append(show(r.variable(), self.names))
                if r.byte() != O.END:
                    raise DecodeError("no end")
            elif kind == "F":
                calls.append((r.number(2) - 1, r.number(4)))
                args.append(self.names.function(*calls[-1]))
            elif kind == "o":
                if r.byte() != 0:
                    raise DecodeError("no string")
                args.append(self.quoted(bytes((b >> 4 | b << 4) & 255 for b in r.string(0)), '"'))
            else:
                args.append(self.quoted(r.string(0 if kind == "z" else 0x3A), '"'))
        text = f"{name}{joint} {', '.join(args)}".rstrip() + ":"
        return Step(at, r.at, text, calls=tuple(calls))

    # texts

    def message(self, at: int, r: Reader, raw: bytes) -> Step:
        return Step(at, r.at, self.quoted(raw, "'"))

    def quoted(self, raw: bytes, quote: str) -> str:
        out = []
        if self.c.unicode:
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                raise DecodeError("no text") from None
            out = [f"\\{c}" if c in ("\\", "<", quote) else c for c in text]
        else:
            i = 0
            while i < len(raw):
                b = raw[i]
                if charset.is_lead(b) and i + 1 < len(raw):
                    safe = charset.is_safe(b, raw[i + 1])
                    out.append(charset.cells()[b << 8 | raw[i + 1]] if safe else f"<0x{b:02x}{raw[i + 1]:02x}>")
                    i += 2
                    continue
                if b >= 0x80 and not charset.is_half_kana(b):
                    raise DecodeError("no text")
                c = chr(b) if b < 0x80 else charset.decode(bytes([b]))
                out.append(f"\\{c}" if c in ("\\", "<", quote) else c)
                i += 1
        text = "".join(out)
        if "\n" in text:
            raise DecodeError("a line end in a text")
        return f"{quote}{text}{quote}"

    def text_run(self, r: Reader) -> str:
        """A message of bytes before 3.8: whole cells, and in 3.5 bytes that stand for one."""
        out, at = [], r.at
        while at < len(self.data):
            b = self.data[at]
            if self.version == 3.5 and charset.is_compacted(b):
                out.append(charset.decode(charset.expand(b)))
                at += 1
            elif charset.is_lead(b) and at + 1 < len(self.data) and charset.is_trail(self.data[at + 1]):
                low = self.data[at + 1]
                plain = charset.is_safe(b, low) and not (self.version == 3.5 and charset.compact(b, low))
                out.append(charset.cells()[b << 8 | low] if plain else f"<0x{b:02x}{low:02x}>")
                at += 2
            else:
                break
        if not out:
            raise DecodeError("no text")
        r.at = at
        return f"'{''.join(out)}'"

    # data

    def data_lines(self, at: int, upto: int) -> list[str]:
        """Data as strings and numbers. Text of two bytes or more before a zero is a string; so is a zero alone, one
        after a string and one before a string: an empty one. Else two bytes are a number; an odd last byte is one of
        its own, with `b`. Linear in the bytes."""
        lines: list[str] = []
        words: list[str] = []
        dead: set[int] = set()  # characters from which no string goes on
        while at < upto:
            found = self.data_text(at, upto, dead)
            if not found and self.data[at] == 0:
                beside = not words and (lines[-1:] and lines[-1][0] == '"' or self.data_text(at + 1, upto, dead))
                found = ("", at + 1) if at + 1 == upto or beside else None
            if not found:
                words.append(f"{self.data[at]}b" if at + 1 == upto else str(int.from_bytes(self.data[at : at + 2], "little")))
                at += 2
            if words and (found or at >= upto):
                lines.append(f"[{', '.join(words)}]")
                words = []
            if found:
                lines.append(f'"{found[0]}"')
                at = found[1]
        return lines

    def data_text(self, at: int, upto: int, dead: set[int]) -> tuple[str, int] | None:
        """The string that begins here and what follows its zero; None where none does."""
        begin, out, passed = at, [], [at]
        while at < upto and at not in dead:
            if self.data[at] == 0:
                if at - begin < 2:
                    break
                return "".join(out), at + 1
            shown, size = self.data_character(at, upto)
            if not size:
                break
            passed.append(at)
            out.append(shown)
            at += size
        dead.update(passed)
        return None

    def data_character(self, at: int, upto: int) -> tuple[str, int]:
        """A character of a string and its bytes; no bytes where none is."""
        b, old = self.data[at], self.version == 3.5
        if self.c.unicode and b >= 0x80:
            size = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            try:
                return self.data[at : min(at + size, upto)].decode(), size
            except UnicodeDecodeError:
                return "", 0
        if old and charset.is_compacted(b):
            return charset.decode(charset.expand(b)), 1
        if charset.is_lead(b) and at + 1 < upto and charset.is_trail(self.data[at + 1]):
            low = self.data[at + 1]
            plain = charset.is_safe(b, low) and not (old and charset.compact(b, low))
            return charset.cells()[b << 8 | low] if plain else f"<0x{b:02x}{low:02x}>", 2
        if 0x20 <= b < 0x7F:
            return f"\\{chr(b)}" if chr(b) in '\\<"' else chr(b), 1
        return "", 0


# ---- source


def has_else(walker: Walker) -> bool:
    """Whether every condition ends as one with a jump over its else branch does."""
    before = {s.end: s for s in walker.steps.values()}
    for s in walker.steps.values():
        if s.kind == "if":
            last = before.get(s.targets[0])
            loop = last is not None and last.kind == "next" and last.targets[0] == s.start
            if not loop and (last is None or last.kind != "jump" or last.targets[0] < s.targets[0] or last.start < s.end):
                return False
    return True


def source(walker: Walker, functions: set[int], with_else: bool, volume: int = 1) -> str:
    """The page's text, one instruction a line, data as strings and numbers."""
    steps, names = walker.steps, walker.names
    before = {s.end: s for s in steps.values()}
    closing: dict[int, list[tuple[int, str]]] = {}
    silent: set[int] = set()
    opened: dict[int, str] = {}
    for s in sorted(steps.values(), key=lambda s: s.start):
        if s.kind != "if":
            continue
        end, last = s.targets[0], before.get(s.targets[0])
        if last is not None and last.kind == "next" and last.targets[0] == s.start:
            opened[s.start] = "<@ " + s.text[1:]
        elif with_else:
            over = last.targets[0]
            silent.add(last.start)
            closing.setdefault(end, []).append((s.start, "} else {" if over > end else "}"))
            if over > end:
                closing.setdefault(over, []).append((s.start, "}"))
        else:
            closing.setdefault(end, []).append((s.start, "}"))
    for at, run in walker.assigned(functions).items():
        place = steps[at].calls[0]
        own = run[len(run) - len(names.parameters.get(place, ())) :]
        if own:
            silent.update(s.start for s in own)
            opened[at] = f"~{names.function(*place)} {', '.join(s.sets[1] for s in own)}:"
    labels = {m for s in steps.values() if s.start not in silent for m in s.marks}
    name = lambda a: f"L_{a:05x}"
    lines = [] if volume == 1 else [f"pragma ald_volume {volume}:"]
    at, end = walker.first, len(walker.data)
    stops = sorted(set(steps) | labels | functions | set(closing) | {end})

    def heads(a: int) -> None:
        lines.extend(text for _, text in sorted(closing.get(a, []), reverse=True))
        if a in functions:
            lines.extend(names.heads(walker.page.page, a))
        if a in labels:
            lines.append(f"*{name(a)}:")

    while at < end:
        heads(at)
        step = steps.get(at)
        if step:
            if at not in silent:
                text = opened.get(at, step.text)
                lines.append(text.format(*map(name, step.marks)) if step.marks else text)
            at = step.end
        else:
            upto = stops[bisect_right(stops, at)]
            lines += walker.data_lines(at, upto)
            at = upto
    heads(end)
    return "\n".join(lines) + "\n"


def _start(page: Page) -> int:
    return (18 + len(page.name) + 15) & ~15


def decompile_pages(contents: list[bytes], config: Config, names: Names | None = None) -> tuple[list[str], Config]:
    """Texts of pages, and the configuration that they compile under; for a few pages, without Spark."""
    names, pages = replace(names or Names()), [read_page(c) for c in contents]
    if pages and pages[0].code[:4] == b"ZU\x41\x7f":
        config.unicode = True
    walkers = {p.page: Walker(p, _start(p), config, names) for p in pages}
    seen: set[tuple[int, int]] = set(names.functions)
    while True:
        for p, a in seen:
            if p in walkers:
                walkers[p].follow([a])
        found = set().union(*[w.calls() for w in walkers.values()]) - seen
        if not found:
            break
        seen |= found
    own = lambda w: {a for p, a in seen if p == w.page.page}
    common: dict[tuple[int, int], list[int]] = {}
    for p, a, found in [x for w in walkers.values() for x in w.given(own(w)) if x[0] in walkers]:
        common[p, a] = _common_end(common.get((p, a), found), found)
    names.parameters = common
    with_else = float(config.sys_ver) >= 3.8 and all(has_else(w) for w in walkers.values())
    config.disable_else = not with_else
    return [source(w, own(w), with_else) for w in walkers.values()], config


def _common_end(a: list[int], b: list[int]) -> list[int]:
    n = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    return a[len(a) - n :]


def decompile_project(pages: DataFrame, config: Config, names: Names | None = None) -> tuple[DataFrame, Config]:
    """(page, name, volume, text) of (content, volume) rows of compiled pages, and the configuration for them.

    The places that calls name are gathered round by round; they are (page, address) pairs, bounded by the format.
    A round follows only pages that got a new place. Parameters are the common ends of what calls assign, grouped by
    function over all pages; functions of pages that are not there keep none. The texts
    compile with the list of variables, since one that only parameters name comes into being nowhere else."""
    spark, names = pages.sparkSession, replace(names or Names())
    rows = pages.select("content", "volume").persist()

    def walk(content: bytes, places: dict[int, set[int]]) -> Walker:
        page = read_page(bytes(content))
        walker = Walker(page, _start(page), config, names)
        walker.follow(sorted(places.get(page.page, ())))
        return walker

    head = rows.where(F.substring(F.substring("content", 13, 4), 1, 4) == F.unhex(F.lit("00000000"))).select("content").limit(1).collect()
    if head and read_page(bytes(head[0][0])).code[:4] == b"ZU\x41\x7f":
        config.unicode = True
    places: dict[int, set[int]] = {}
    for p, a in names.functions:
        places.setdefault(p, set()).add(a)
    with_else = float(config.sys_ver) >= 3.8
    fresh: set[int] | None = None
    while True:
        known = spark.sparkContext.broadcast((places, fresh))

        def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = []
                for content in frame["content"]:
                    if known.value[1] is not None and read_page(bytes(content)).page not in known.value[1]:  # noqa: B023
                        continue
                    w = walk(content, known.value[0])  # noqa: B023
                    out += [(p, a, True) for p, a in w.calls()] + ([] if has_else(w) else [(-1, -1, False)])
                yield pd.DataFrame(out, columns=["page", "addr", "ok"])

        found = rows.select("content").mapInPandas(look, "page int, addr bigint, ok boolean").distinct().collect()
        with_else = with_else and all(r["ok"] for r in found)
        new = {(r["page"], r["addr"]) for r in found if r["ok"] and r["addr"] not in places.get(r["page"], ())}
        if not new:
            break
        for p, a in new:
            places.setdefault(p, set()).add(a)
        fresh = {p for p, _ in new}
    config.disable_else = not with_else
    last = spark.sparkContext.broadcast(places)

    def give(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            walkers = [walk(c, last.value) for c in frame["content"]]
            out = [(w.page.page, -1, []) for w in walkers] + [x for w in walkers for x in w.given(last.value.get(w.page.page, set()))]
            yield pd.DataFrame(out, columns=["page", "addr", "argv"])

    ends = tables.common_suffix(rows.select("content").mapInPandas(give, "page int, addr bigint, argv array<int>"), ["page", "addr"], "argv").collect()
    here = {r["page"] for r in ends if r["addr"] < 0}
    names.parameters = {(r["page"], r["addr"]): list(r["suffix"]) for r in ends if r["suffix"] and r["page"] in here}

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            walkers = [walk(c, last.value) for c in frame["content"]]
            texts = [source(w, last.value.get(w.page.page, set()), with_else, int(v)) for w, v in zip(walkers, frame["volume"], strict=True)]
            yield pd.DataFrame({"page": [w.page.page for w in walkers], "name": [charset.decode(w.page.name, "?").replace("\\", "/") for w in walkers], "volume": frame["volume"], "text": texts})

    return rows.mapInPandas(write, "page int, name string, volume int, text string"), config


def missing_pages(pages: DataFrame, names: Names | None = None) -> DataFrame:
    """(page, text) of the pages that are not there below the last one: sources that put nothing into an archive, but
    keep the addresses of the functions in them that `names` has."""
    names = names or Names()
    places = [(p, a, "\n".join([f"pragma address 0x{a:x}:", *names.heads(p, a)]) + "\n") for p, a in names.functions]
    told = pages.sparkSession.createDataFrame(places, "page int, at bigint, line string").groupBy("page").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("told"))
    last = pages.agg(F.max("page").alias("n")).select(F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(0)))).alias("page"))
    lines = F.array_join(F.coalesce(F.col("told.line"), F.array().cast("array<string>")), "")
    return last.join(pages.select("page"), "page", "left_anti").join(told, "page", "left").select("page", F.concat(F.lit("pragma ald_volume 0:\n"), lines).alias("text"))
