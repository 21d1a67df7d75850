"""Fixed byte layouts, declared once, as column expressions: no bytes go to Python.

A layout is a list of fields in order; unpack() reads one record at a place, records() a table of them (a count and a
place, which may be columns read by another layout), pack() writes one. Numbers are unsigned unless their kind says so.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of numbers: bytes, whether the low byte comes first, whether the top bit is a sign.
NUMBERS = {
    "u8": (1, True, False), "u16le": (2, True, False), "u16be": (2, False, False), "u24le": (3, True, False), "u32le": (4, True, False), "u32be": (4, False, False), "u48le": (6, True, False),
    "i16le": (2, True, True), "i32le": (4, True, True), "i64le": (8, True, True), "i64be": (8, False, True),
}


@dataclass(frozen=True)
class Field:
    """kind: one of NUMBERS; `bytes`, of `size`; `text`, of `size`, up to the first zero byte; `pad`, of `size` zero bytes."""

    name: str
    kind: str
    size: int = 0

    @property
    def width(self) -> int:
        return NUMBERS[self.kind][0] if self.kind in NUMBERS else self.size


class Layout:
    def __init__(self, *fields: Field):
        for f in fields:
            if f.kind not in NUMBERS and (f.kind not in ("bytes", "text", "pad") or f.size < 1):
                raise ValueError(f"no field of kind {f.kind} and size {f.size}")
        self.fields, self.size = fields, sum(f.width for f in fields)

    def unpack(self, data: Column, at: Column | int = 0) -> list[Column]:
        """The fields of the record at a 0-based place, each under its name; null where the data end before a field does."""
        place, out = F.lit(at) if isinstance(at, int) else at, []
        for f in self.fields:
            if f.kind != "pad":
                raw = F.substring(data, (place + 1).cast("int"), F.lit(f.width))
                out.append(F.when(F.length(raw) == f.width, _read(raw, f)).alias(f.name))
            place = place + f.width
        return out

    def pack(self, **values: Column) -> Column:
        """The bytes of one record."""
        return F.concat(*[_written(values.get(f.name), f) for f in self.fields])

    def records(self, df: DataFrame, data: str, count: Column, at: Column | int = 0, *, number: str = "record", strict: bool = True) -> DataFrame:
        """df's other columns, and each of `count` records that lie one after another from a place, numbered from 0.
        Records that the data end before are left out; strict: they are an error."""
        place = F.lit(at) if isinstance(at, int) else at
        whole = F.greatest(F.coalesce(F.floor((F.length(data) - place) / self.size), F.lit(0)), F.lit(0))
        n = F.when(count <= whole, count).otherwise(F.raise_error(F.lit("records beyond the end of the data")).cast("bigint")) if strict else F.least(count, whole)
        some = df.withColumn("__at", place.cast("int")).withColumn("__n", n.cast("int")).where(F.col("__n") > 0)
        # Only a record's own bytes are carried past the explode.
        own = some.withColumn("__r", F.explode(F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda i: F.struct(i.alias("k"), F.substring(F.col(data), F.col("__at") + i * self.size + 1, F.lit(self.size)).alias("d")))))
        rest = [c for c in df.columns if c != data]
        return own.select(*rest, F.col("__r.k").cast("bigint").alias(number), *self.unpack(F.col("__r.d")))


def _read(raw: Column, f: Field) -> Column:
    if f.kind == "bytes":
        return raw
    if f.kind == "text":
        return F.decode(F.unhex(F.regexp_extract(F.hex(raw), "^((?:(?!00)..)*)", 1)), "UTF-8")
    size, low_first, signed = NUMBERS[f.kind]
    byte = lambda k: F.conv(F.hex(F.substring(raw, k + 1, 1)), 16, 10).cast("bigint")
    parts = [F.call_function("shiftleft", byte(k), F.lit(8 * (k if low_first else size - 1 - k))) for k in range(size)]
    n = reduce(lambda a, b: a.bitwiseOR(b), parts)
    if signed and size < 8:
        n = F.when(n >= 1 << (8 * size - 1), n - (1 << 8 * size)).otherwise(n)
    return n


def _written(value: Column | None, f: Field) -> Column:
    if f.kind == "pad" or value is None:
        return F.unhex(F.lit("00" * f.width))
    if f.kind == "bytes":
        return F.when(F.length(value) == f.size, value)
    if f.kind == "text":
        raw = F.encode(value, "UTF-8")
        return F.when(F.length(raw) <= f.size, F.unhex(F.rpad(F.hex(raw), 2 * f.size, "0")))
    size, low_first, signed = NUMBERS[f.kind]
    lowest, highest = (-(1 << (8 * size - 1)), (1 << (8 * size - 1)) - 1) if signed else (0, (1 << 8 * size) - 1)
    n = value.cast("bigint")
    digits = F.substring(F.lpad(F.hex(n), 16, "0"), 17 - 2 * size, 2 * size)  # hex() of a negative number has all 16
    order = range(size - 1, -1, -1) if low_first else range(size)
    return F.when(n.between(lowest, highest), F.unhex(F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in order])))


def padded(data: Column, multiple: int) -> Column:
    """data with zero bytes up to a multiple."""
    return F.concat(data, F.unhex(F.repeat(F.lit("00"), F.pmod(-F.length(data), F.lit(multiple)).cast("int"))))


#: A record of a volume's link table, and a member's header before its name.
LINK = Layout(Field("volume", "u8"), Field("pointer", "u16le"))
MEMBER = Layout(Field("header_size", "u32le"), Field("size", "u32le"), Field("filetime", "i64le"))
#: What a compiled page begins with, before its name.
PAGE = Layout(Field("signature", "text", 4), Field("header_size", "u32le"), Field("file_size", "u32le"), Field("page", "u32le"), Field("name_size", "u16le"))
