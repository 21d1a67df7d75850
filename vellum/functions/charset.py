"""The scripts' Shift_JIS, by rule from the platform's cp932.

It is cp932 without the private lead bytes 0xf0 to 0xf9, and with: 0x82f2 as U+3094; a run of user-defined cells from
0xeb9f to 0xec9e as U+E000 onwards; and single bytes 0xa0 to 0xdf as U+FF60 onwards. Where several cells give one
character, the first one is its reverse.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Cells beyond cp932.
PRIVATE_LEADS = range(0xF0, 0xFA)
EXTRA_CELL, EXTRA_CHAR = 0x82F2, "ゔ"
USER_FIRST, USER_LAST, USER_CHAR = 0xEB9F, 0xEC9E, 0xE000
SPACE, HALF_FIRST, HALF_LAST = 0x20, 0xA1, 0xDF


def is_lead(b: int) -> bool:
    return 0x81 <= b <= 0x9F or 0xE0 <= b <= 0xFC


def is_trail(b: int) -> bool:
    return 0x40 <= b <= 0x7E or 0x80 <= b <= 0xFC


def is_half_kana(b: int) -> bool:
    return 0xA0 <= b <= 0xDF


def is_compacted(b: int) -> bool:
    return b == SPACE or HALF_FIRST <= b <= 0xDD


@lru_cache(maxsize=1)
def cells() -> dict[int, str]:
    """Two-byte cells and their characters, in the cells' order."""
    out = {}
    user = USER_CHAR
    for lead in range(0x81, 0xFD):
        if not is_lead(lead) or lead in PRIVATE_LEADS:
            continue
        for trail in range(0x40, 0xFD):
            if not is_trail(trail):
                continue
            cell = lead << 8 | trail
            try:
                out[cell] = bytes((lead, trail)).decode("cp932")
            except UnicodeDecodeError:
                if USER_FIRST <= cell <= USER_LAST:
                    out[cell] = chr(user)
                    user += 1
    out[EXTRA_CELL] = EXTRA_CHAR
    return dict(sorted(out.items()))


@lru_cache(maxsize=1)
def reverse() -> dict[str, bytes]:
    out: dict[str, bytes] = {}
    for cell, char in cells().items():
        out.setdefault(char, cell.to_bytes(2, "big"))
    return out


@lru_cache(maxsize=1)
def ambiguous() -> frozenset[str]:
    """Characters that more than one cell gives."""
    seen, twice = set(), set()
    for char in cells().values():
        (twice if char in seen else seen).add(char)
    return frozenset(twice)


def decode(data: bytes, substitute: str | None = None) -> str:
    """Characters of Shift_JIS bytes. A byte that begins no cell is `substitute`; without one it is an error."""
    out, at, known = [], 0, cells()
    while at < len(data):
        b = data[at]
        if b < 0x80:
            out.append(chr(b))
        elif is_half_kana(b):
            out.append(chr(0xFF60 + b - 0xA0))
        elif at + 1 < len(data) and (char := known.get(b << 8 | data[at + 1])):
            out.append(char)
            at += 1
        elif substitute is None:
            raise UnicodeDecodeError("shift_jis", data, at, at + 1, "no such cell")
        else:
            out.append(substitute)
        at += 1
    return "".join(out)


def encode(text: str, substitute: bytes | None = None) -> bytes:
    out, known = bytearray(), reverse()
    for at, char in enumerate(text):
        n = ord(char)
        if n < 0x80:
            out.append(n)
        elif 0xFF60 <= n <= 0xFF9F:
            out.append(n - 0xFF60 + 0xA0)
        elif char in known:
            out += known[char]
        elif substitute is None:
            raise UnicodeEncodeError("shift_jis", text, at, at + 1, "no such character")
        else:
            out += substitute
    return bytes(out)


def is_safe(lead: int, trail: int) -> bool:
    """Whether a cell survives the way to Unicode and back."""
    char = cells().get(lead << 8 | trail)
    return char is not None and not 0xE000 <= ord(char) <= 0xEFFF and char not in ambiguous()


def expand(b: int) -> bytes:
    """The full-width cell that a compacted byte stands for: the wide space, or hiragana and marks in the order of the
    half-width bytes."""
    if b in (SPACE, 0xA0):
        return reverse()["　"]
    if b == 0xDE:
        return reverse()["゛"]
    if b == 0xDF:
        return reverse()["゜"]
    wide = unicodedata.normalize("NFKC", chr(0xFF60 + b - 0xA0))
    return reverse()[chr(ord(wide) - 0x60) if "ァ" <= wide <= "ン" else wide]


@lru_cache(maxsize=1)
def _compacted() -> dict[bytes, int]:
    return {expand(b): b for b in range(256) if is_compacted(b)}


def compact(lead: int, trail: int) -> int:
    """The byte that stands for a cell, 0 if none does."""
    return _compacted().get(bytes((lead, trail)), 0)


def invalid_utf8_at(data: bytes) -> int:
    """Place of the first byte that cannot be UTF-8 by its form, -1 if there is none. Overlong forms and surrogates pass."""
    at = 0
    while at < len(data):
        b = data[at]
        n = 0 if b < 0x80 else 1 if 0xC0 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if 0xF0 <= b < 0xF8 else -1
        if n < 0 or any(i >= len(data) or data[i] & 0xC0 != 0x80 for i in range(at + 1, at + n + 1)):
            return at
        at += n + 1
    return -1


@F.pandas_udf(T.StringType())
def decode_column(data: pd.Series) -> pd.Series:
    """Text of Shift_JIS bytes; U+FFFD for what is no cell."""
    return data.map(lambda x: None if x is None else decode(bytes(x), "�"))


@F.pandas_udf(T.BinaryType())
def encode_column(text: pd.Series) -> pd.Series:
    """Shift_JIS bytes; '?' for what has no cell."""
    return text.map(lambda x: None if x is None else encode(x, b"?"))
