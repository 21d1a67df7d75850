"""Archives of named members in volumes (ALD) and of anonymous members (ALK).

A volume file is read in one task, through Spark's file source, so any store that Spark reads will do. Written
volumes are rows of bytes; save() puts them into files.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum import schemas
from vellum.functions import charset
from vellum.functions.arith import FILETIME_EPOCH

# Footer signatures, the sector size, and the mark of anonymous archives.
SIGNATURES = (0x14C4E, 0x12020)
SECTOR = 256
ALK_MARK = b"ALK0"


class ArchiveError(ValueError):
    pass


def _pointer(data: bytes, index: int) -> int:
    """Place of a 24-bit sector number in the table at the start."""
    at = int.from_bytes(data[3 * index : 3 * index + 3], "little") * SECTOR
    if at + SECTOR > len(data):
        raise ArchiveError(f"sector out of range: {at}")
    return at


def links(data: bytes) -> list[tuple[int, int]]:
    """(volume, number) of each place of the link table; volume 0 is a hole."""
    body = data[_pointer(data, 0) : _pointer(data, 1)]
    return [(body[i], int.from_bytes(body[i + 1 : i + 3].ljust(2, b"\0"), "little")) for i in range(0, len(body), 3)]


def read_volume(data: bytes, path: str = "") -> tuple[list[tuple], str | None]:
    """Members (entry_index, volume, link_no, name, seconds, size, data) and a warning. What does not look like a volume
    has none and a warning; a footer of a wrong volume is set right by the letter before the suffix."""
    if len(data) % SECTOR != 16 or int.from_bytes(data[-16:-12], "little") not in SIGNATURES:
        return [], "not an archive volume"
    table = links(data)
    volume, count = data[-8], int.from_bytes(data[-7:-5], "little")
    warning = None
    if sum(v == volume for v, _ in table) != count:
        warning = f"wrong volume {volume} in the footer"
        volume = ord(path[-5:-4].lower() or "`") - ord("a") + 1
        if sum(v == volume for v, _ in table) != count:
            raise ArchiveError(f"{path}: cannot tell the volume")
    out = []
    for place, (own, number) in enumerate(table, 1):
        if own != volume:
            continue
        at = _pointer(data, number)
        head, size, filetime = struct.unpack_from("<IIQ", data, at)
        name = data[at + 16 : at + head].split(b"\0", 1)[0]
        if at + head + size > len(data) - 16:
            raise ArchiveError(f"{path}: member {place} goes past the end")
        out.append((place, volume, number, charset.decode(name, "�"), (filetime - FILETIME_EPOCH) // 10_000_000, size, data[at + head : at + head + size]))
    return out, warning


def header_size(name: bytes) -> int:
    return (len(name) + 1 + 31) & ~15


def write_volume(index: list[tuple[int, int, int]], members: list[tuple[int, bytes, int, bytes]], volume: int) -> bytes:
    """A volume's bytes. index: (place, volume, number) of all members of all volumes; members: (number, name, seconds,
    data) of this one."""
    pad = lambda b: b + bytes(-len(b) % SECTOR)
    members = sorted(members)
    bodies = []
    for _, name, seconds, data in members:
        size = header_size(name)
        head = struct.pack("<IIQ", size, len(data), seconds * 10_000_000 + FILETIME_EPOCH) + name
        bodies.append(pad(head.ljust(size, b"\0") + data))
    places = {place: (own, number) for place, own, number in index}
    table = b""
    for place in range(1, max(places, default=0) + 1):
        own, number = places.get(place, (0, 0))
        table += struct.pack("<BH", own, number)
    sectors = [-(-3 * (len(bodies) + 2) // SECTOR), -(-len(table) // SECTOR), *[len(b) // SECTOR for b in bodies]]
    pointers, total = b"", 0
    for n in sectors:
        total += n
        if total >= 1 << 24:
            raise ArchiveError("a volume of more than 2^24 sectors")
        pointers += total.to_bytes(3, "little")
    footer = struct.pack("<IIII", SIGNATURES[0], 0x10, len(bodies) << 8 | volume, 0)
    return pad(pointers) + pad(table) + b"".join(bodies) + footer


def read_ald(spark: SparkSession, *paths: str, include_data: bool = True) -> DataFrame:
    """Members of all volumes (schemas.ARCHIVE); a volume that cannot be used is one row with only a warning."""
    return parse_ald(spark.read.format("binaryFile").load(list(paths)).select("path", "content"), include_data)


def parse_ald(files: DataFrame, include_data: bool = True) -> DataFrame:
    schema = T.StructType.fromDDL(schemas.ARCHIVE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path, content in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                members, warning = read_volume(content, path)
                if not include_data:
                    members = [(*m[:6], None) for m in members]
                cols = list(zip(*members, strict=True)) if members else [[]] * 7
                if not members:
                    cols = [[None]] * 7
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string()]
                made = [pa.array(c, k) for c, k in zip(cols[:4], kinds, strict=True)]
                made.append(pa.array([None if s is None else s * 1_000_000 for s in cols[4]], pa.timestamp("us", tz="UTC")))
                made += [pa.array(cols[5], pa.int32()), pa.array(cols[6], pa.binary()), pa.array([warning] * len(cols[0]), pa.string())]
                yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return files.select("path", "content").mapInArrow(run, schema)


def number_links(entries: DataFrame) -> DataFrame:
    """entries with link_no: 1, 2 and so on in each volume by entry_index."""
    return entries.withColumn("link_no", F.row_number().over(Window.partitionBy("volume").orderBy("entry_index")).cast("int"))


def encode_ald(entries: DataFrame) -> DataFrame:
    """(volume, content) of (entry_index, volume, name, mtime, data) rows; link numbers are counted anew. Every volume
    has the link table of all members, which the format keeps under 26 times 65,536 rows."""
    numbered = number_links(entries)
    rows = numbered.select("entry_index", "volume", "link_no").limit(26 * 65_536 + 1).collect()
    index = [tuple(r) for r in rows]
    if any(not 1 <= v <= 26 or n > 65_535 for _, v, n in index) or len({p for p, _, _ in index}) < len(index):
        raise ArchiveError("volumes are 1 to 26, numbers up to 65535, places unique")

    def run(frame):
        import pandas as pd

        volume = int(frame["volume"].iloc[0])
        members = [(int(r.link_no), charset.encode(r.name_), int(r.seconds), bytes(r.data)) for r in frame.rename(columns={"name": "name_"}).itertuples()]
        return pd.DataFrame({"volume": [volume], "content": [write_volume(index, members, volume)]})

    rows_ = numbered.select("volume", "link_no", "name", F.unix_seconds("mtime").alias("seconds"), "data")
    return rows_.groupBy("volume").applyInPandas(run, "volume int, content binary")


def read_alk(data: bytes) -> list[bytes]:
    if data[:4] != ALK_MARK or len(data) < 8:
        raise ArchiveError("not an ALK archive")
    n = int.from_bytes(data[4:8], "little")
    if len(data) < 8 + 8 * n:
        raise ArchiveError("a table past the end")
    spans = [struct.unpack_from("<II", data, 8 + 8 * i) for i in range(n)]
    if any(a + size > len(data) for a, size in spans):
        raise ArchiveError("a member past the end")
    return [data[a : a + size] for a, size in spans]


def write_alk(members: list[bytes]) -> bytes:
    head, at = ALK_MARK + struct.pack("<I", len(members)), 8 + 8 * len(members)
    for m in members:
        head += struct.pack("<II", at, len(m))
        at += len(m)
    return head + b"".join(members)


def scan_alk(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, entry_index, size, ftype, data) of ALK files; members of no bytes are empty places."""
    from vellum.functions.text import sniff

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path, content in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                members = read_alk(content)
                n = len(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(map(len, members), pa.int32()), pa.array(members, pa.binary())],
                    names=["path", "entry_index", "size", "data"],
                )

    rows = spark.read.format("binaryFile").load(list(paths)).select("path", "content").mapInArrow(run, "path string, entry_index int, size int, data binary")
    return rows.select("path", "entry_index", "size", sniff(F.col("data")).alias("ftype"), "data")


def find(entries: DataFrame, selector: str) -> DataFrame:
    """The member of a 1-based place (decimal, 0x or leading-0 octal), else the first of a name in any case."""
    text = selector.strip()
    try:
        n = int(text, 8) if len(text) > 1 and text[0] == "0" and text[1:].isdigit() else int(text, 0)
    except ValueError:
        named = entries.where(F.lower("name") == selector.lower())
        return named.orderBy("entry_index").limit(1)
    return entries.where(F.col("entry_index") == n)


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(entry_index, state, at) of the places that differ: only_left, only_right, name, data; at: the first differing byte."""
    a = left.select(F.col("entry_index").alias("i"), F.col("name").alias("n"), F.col("data").alias("d"))
    b = right.select(F.col("entry_index").alias("j"), F.col("name").alias("m"), F.col("data").alias("e"))
    both = a.join(b, F.col("i") == F.col("j"), "full_outer")
    state = (
        F.when(F.col("i").isNull(), "only_right").when(F.col("j").isNull(), "only_left").when(F.lower("n") != F.lower("m"), "name").when(F.col("d") != F.col("e"), "data")
    )

    @F.pandas_udf(T.IntegerType())
    def first(d, e):
        import pandas as pd

        return pd.Series([None if x is None or y is None else len(os.path.commonprefix([bytes(x), bytes(y)])) for x, y in zip(d, e, strict=True)], dtype="Int32")

    told = both.select(F.coalesce("i", "j").alias("entry_index"), state.alias("state"), "d", "e").where("state is not null")
    return told.select("entry_index", "state", F.when(F.col("state") == "data", first("d", "e")).alias("at"))


def listing(entries: DataFrame) -> DataFrame:
    return entries.where("entry_index is not null").select("entry_index", "volume", "mtime", "size", "name").orderBy("entry_index")


def parse_manifest(lines: DataFrame, order: str = "at", line: str = "line") -> DataFrame:
    """(at, volume, link_no, name) of manifest lines `volume,link,name`, or `volume,name` whose link goes on from the last
    of its volume. Volumes are 1 to 26, links 1 to 65535 and each once."""
    from vellum.operators.spans import fill_links

    full, short = r"^\s*(\d+)\s*,\s*(\d+)\s*,(.*)$", r"^\s*(\d+)\s*,(.*)$"
    rows = lines.where(F.trim(line) != "").select(
        F.col(order).alias("at"), F.regexp_extract(line, short, 1).cast("int").alias("volume"), F.nullif(F.regexp_extract(line, full, 2), F.lit("")).cast("int").alias("given"),
        F.when(F.col(line).rlike(full), F.regexp_extract(line, full, 3)).otherwise(F.regexp_extract(line, short, 2)).alias("name"),
    )
    out = fill_links(rows, "given", ["volume"], ["at"], "link_no").drop("given")
    bad = out.groupBy("volume", "link_no").count().where("volume is null or volume not between 1 and 26 or link_no not between 1 and 65535 or count > 1").limit(1).collect()
    if bad:
        raise ArchiveError(f"bad manifest line: volume {bad[0][0]}, link {bad[0][1]}")
    return out


def manifest(entries: DataFrame) -> DataFrame:
    """(entry_index, line) of an archive's members: manifest lines `volume,link,name`, the link being the member's place.
    Holes have no line."""
    line = F.concat_ws(",", F.col("volume").cast("string"), F.col("entry_index").cast("string"), F.coalesce("name", F.lit("")))
    return entries.where("entry_index is not null").select("entry_index", line.alias("line"))


def save(files: DataFrame, name: str, content: str, folder: str) -> None:
    """One file a row, one at a time."""
    os.makedirs(folder, exist_ok=True)
    for row in files.select(name, content).toLocalIterator():
        with open(os.path.join(folder, str(row[0])), "wb") as f:
            f.write(row[1])
