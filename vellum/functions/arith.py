"""Script arithmetic and number forms as column expressions.

Script integers are 0 to 65535. Sums and products stay at 65535, differences at 0; a quotient by 0 is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOP = 65_535
#: 100 ns steps from 1601 to 1970.
FILETIME_EPOCH = 116_444_736_000_000_000


def add(a: Column, b: Column) -> Column:
    return F.least(a.cast("bigint") + b.cast("bigint"), F.lit(TOP).cast("bigint"))


def mul(a: Column, b: Column) -> Column:
    return F.least(a.cast("bigint") * b.cast("bigint"), F.lit(TOP).cast("bigint"))


def sub(a: Column, b: Column) -> Column:
    return F.greatest(a.cast("bigint") - b.cast("bigint"), F.lit(0).cast("bigint"))


def div(a: Column, b: Column) -> Column:
    """Whole quotient, cut towards zero; null for a divisor of zero. No number goes through a double."""
    return F.when(b != 0, F.call_function("div", a.cast("bigint"), b.cast("bigint")))


def mod(a: Column, b: Column) -> Column:
    """What div() leaves, with the dividend's sign; null for a divisor of zero."""
    return F.when(b != 0, a.cast("bigint") % b.cast("bigint"))


def compare(op: str, a: Column, b: Column) -> Column:
    """1 or 0 for <, >, <=, >=, = and \\ (unequal)."""
    test = {"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b, "=": a == b, "\\": a != b}[op]
    return test.cast("int")


def bits(op: str, a: Column, b: Column) -> Column:
    return {"&": a.bitwiseAND, "|": a.bitwiseOR, "^": a.bitwiseXOR}[op](b)


def _byte(n: Column) -> Column:
    return F.lpad(F.hex(n.cast("bigint")), 2, "0")


def _word(n: Column) -> Column:
    return F.lpad(F.hex(n.cast("bigint")), 4, "0")


def encode_number(n: Column) -> Column:
    """Bytes of a literal: to 0x33 one byte n + 0x40; to 0x3fff two, high byte first; larger ones 0x3fff as often as it
    goes, the rest, and as many additions (0x79)."""
    n = n.cast("bigint")
    plain = lambda x: F.when(x <= 0x33, _byte(x + 0x40)).otherwise(_word(x))
    times = F.floor(n / 0x3FFF).cast("int")
    rest = n - times * 0x3FFF
    large = F.concat(F.repeat(F.lit("3FFF"), times), F.when(rest > 0, plain(rest)).otherwise(F.lit("")), F.repeat(F.lit("79"), times - F.when(rest > 0, 0).otherwise(1)))
    return F.unhex(F.when(n <= 0x3FFF, plain(n)).otherwise(large))


def encode_variable(n: Column) -> Column:
    """Bytes of a variable: to 0x3f one byte n + 0x80; to 0xff c0 and n; to 0x3fff n + 0xc000, high byte first; null beyond."""
    n = n.cast("bigint")
    return F.unhex(F.when(n <= 0x3F, _byte(n + 0x80)).when(n <= 0xFF, F.concat(F.lit("C0"), _byte(n))).when(n <= 0x3FFF, _word(n + 0xC000)))


def to_filetime(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) * 10 + FILETIME_EPOCH


def from_filetime(ft: Column) -> Column:
    """The second that holds it."""
    return F.timestamp_seconds(F.floor((ft - FILETIME_EPOCH) / 10_000_000))


def little_endian(data: Column, at: int, size: int) -> Column:
    """Unsigned number of `size` bytes (7 at most) from a 0-based place."""
    return F.conv(F.hex(F.reverse(F.substring(data, at + 1, size))), 16, 10).cast("bigint")
