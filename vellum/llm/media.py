"""Media columns: Netpbm and BMP decoded to numpy arrays, area-resized by integral images, written as NPY tiles
with difference hashes."""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import columns_of, materialize, table, with_columns_replaced

WIDTH = 64
TILE = 16
_ROWS = 65_536
#: Digits of a number in a Netpbm header at most.
_DIGITS = 18


class MediaError(ValueError):
    """Bytes that are no whole image of a known form."""


# ---- codecs


def _tokens(data: bytes, at: int, n: int) -> tuple[list[int], int]:
    """n decimal numbers of a Netpbm header, comments skipped; the place after the one white space that ends them."""
    out = []
    while len(out) < n:
        while at < len(data) and (data[at : at + 1].isspace() or data[at] == 35):
            if data[at] == 35:
                at = data.find(b"\n", at)
                if at < 0:
                    raise MediaError("a comment without end")
            at += 1
        end = at
        while end < len(data) and 48 <= data[end] <= 57:
            end += 1
        if end == at:
            raise MediaError("no number in the header")
        if end - at > _DIGITS:
            raise MediaError("a number out of range")
        out.append(int(data[at:end]))
        at = end
    return out, at


def _scaled(samples: np.ndarray, top: int) -> np.ndarray:
    """Samples of 0 to top, to the whole range of uint8 (top under 256) or uint16, halves rounded up."""
    full, kind = (255, np.uint8) if top < 256 else (65_535, np.uint16)
    if samples.size and int(samples.max()) > top:
        raise MediaError("a sample above the maximum")
    if top == full:
        return samples.astype(kind, copy=False)
    return ((samples.astype(np.int64) * (2 * full) + top) // (2 * top)).astype(kind)


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6, to (height, width) or (height, width, 3) of uint8, or uint16 for maxima above 255, samples scaled to
    the type's range. Bitmaps: 1 is black, 0."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise MediaError("not Netpbm")
    bitmap, raw, depth = kind in (b"P1", b"P4"), kind >= b"P4", 3 if kind in (b"P3", b"P6") else 1
    numbers, at = _tokens(data, 2, 2 if bitmap else 3)
    width, height, top = numbers[0], numbers[1], 1 if bitmap else numbers[2]
    if not width or not height or not 0 < top < 65_536:
        raise MediaError("empty, or samples out of range")
    shape = (height, width, 3) if depth == 3 else (height, width)
    row = (width + 7) // 8
    size = 1 if top < 256 else 2
    need = row * height if kind == b"P4" else width * height * depth * (size if raw else 1)
    if len(data) - at < need:  # a plain sample is a character at least
        raise MediaError("too few samples")
    n = width * height * depth
    if raw:
        at += 1
        if len(data) < at + need:
            raise MediaError("too few samples")
        if bitmap:
            bits = np.unpackbits(np.frombuffer(data, np.uint8, need, at).reshape(height, row), axis=1)[:, :width]
            return (1 - bits) * np.uint8(255)
        out = np.frombuffer(data, np.uint8 if size == 1 else ">u2", n, at)
    elif bitmap:
        digits = np.frombuffer(data, np.uint8, offset=at)
        out = digits[(digits == 48) | (digits == 49)][:n] - 48
        if len(out) < n:
            raise MediaError("too few samples")
        return ((1 - out) * np.uint8(255)).reshape(shape)
    else:
        words = data[at:].split()[:n]
        if len(words) < n:
            raise MediaError("too few samples")
        if not all(w.isdigit() and len(w) <= _DIGITS for w in words):
            raise MediaError("a sample that is no number")
        out = np.array(words, np.int64)
    return _scaled(out, top).reshape(shape)


def _channel(values: np.ndarray, mask: int) -> np.ndarray:
    if not mask:
        return np.zeros(values.shape, np.uint8)
    low = (mask & -mask).bit_length() - 1
    top = mask >> low
    return ((((values & mask) >> low) * 510 + top) // (2 * top)).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 16, 24 or 32 bits, with masks too, to (height, width, 3) of uint8 in red, green,
    blue. Indexes past the palette are black."""
    if data[:2] != b"BM" or len(data) < 54:
        raise MediaError("not BMP")
    at, head, width, height, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if head < 40 or width <= 0 or not height or bits not in (1, 4, 8, 16, 24, 32) or packed not in (0, 3) or (packed == 3 and bits not in (16, 32)):
        raise MediaError("a BMP form that is not read")
    rows, stride = abs(height), (width * bits + 31) // 32 * 4
    if at < 54 or len(data) < max(at + stride * rows, 66 if packed else 0):
        raise MediaError("too few samples")
    body = np.frombuffer(data, np.uint8, stride * rows, at).reshape(rows, stride)
    if bits == 24:
        out = body[:, : width * 3].reshape(rows, width, 3)[:, :, ::-1]
    elif bits > 8:
        plain = (0x7C00, 0x3E0, 0x1F) if bits == 16 else (0xFF0000, 0xFF00, 0xFF)
        masks = struct.unpack_from("<III", data, 54) if packed == 3 else plain
        values = np.ascontiguousarray(body[:, : width * bits // 8]).view("<u2" if bits == 16 else "<u4").astype(np.int64)
        out = np.stack([_channel(values, m) for m in masks], 2)
    else:
        used = min(struct.unpack_from("<I", data, 46)[0] or 1 << bits, 1 << bits)
        if len(data) < 14 + head + 4 * used:
            raise MediaError("a palette past the end")
        palette = np.zeros((256, 3), np.uint8)
        palette[:used] = np.frombuffer(data, np.uint8, used * 4, 14 + head).reshape(-1, 4)[:, 2::-1]
        each = 8 // bits
        index = np.stack([(body >> (8 - bits * (k + 1))) & ((1 << bits) - 1) for k in range(each)], 2).reshape(rows, -1)[:, :width]
        out = palette[index]
    return np.ascontiguousarray(out[::-1] if height > 0 else out)


def encode_bmp(image: np.ndarray) -> bytes:
    """A grey (height, width) image of uint8 as BMP of 8 bits, with a grey palette."""
    height, width = image.shape
    stride = (width + 3) // 4 * 4
    body = np.zeros((height, stride), np.uint8)
    body[:, :width] = image[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4) * np.array([1, 1, 1, 0], np.uint8)
    at = 54 + palette.size
    head = struct.pack("<IIIIiiHHIIiiII", at + body.size, 0, at, 40, width, height, 1, 8, 0, body.size, 0, 0, 256, 0)
    return b"BM" + head + palette.tobytes() + body.tobytes()


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(samples: bytes, width: int = WIDTH) -> bytes:
    """Grey image of 8-bit samples, whole rows."""
    if not samples or len(samples) % width:
        raise MediaError("samples must fill whole rows")
    return b"P5\n%d %d\n255\n" % (width, len(samples) // width) + samples


# ---- features


def grey(image: np.ndarray) -> np.ndarray:
    """(height, width) of the rounded mean of the channels, of the image's type; grey images as they are."""
    return image if image.ndim == 2 else ((image.sum(2, dtype=np.uint32) + image.shape[2] // 2) // image.shape[2]).astype(image.dtype)


def _edges(size: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole and fractional part of the parts + 1 borders of equal shares of size."""
    whole, rest = np.divmod(np.arange(parts + 1, dtype=np.int64) * size, parts)
    return whole, rest / parts


def _at(integral: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Values of running sums (first axis) at borders between whole rows."""
    upper = integral[np.minimum(whole + 1, len(integral) - 1)]
    return integral[whole] + rest[:, None] * (upper - integral[whole])


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each cell of a height x width grid over the image, cells cutting samples by area: differences of the
    integral image at the cells' borders. The integral image is only kept at the columns of borders."""
    x = _edges(image.shape[1], width)
    columns = []
    for at in range(0, image.shape[0], _ROWS):
        block = image[at : at + _ROWS]
        sums = np.zeros((block.shape[1] + 1, len(block)))
        np.cumsum(block.T, axis=0, dtype=np.float64, out=sums[1:])
        columns.append(np.diff(_at(sums, *x), axis=0).T)
    sums = np.concatenate([np.zeros((1, width)), np.cumsum(np.concatenate(columns), axis=0)])
    cells = np.diff(_at(sums, *_edges(image.shape[0], height)), axis=0)
    return cells * (height * width / (image.shape[0] * image.shape[1]))


def difference_hash(image: np.ndarray) -> int:
    """64 bits: each cell of 8 rows of 9 is darker than the next one."""
    cells = area_resize(image, 8, 9)
    # Equal means must compare equal, whatever order they were summed in.
    bits = np.round(cells[:, :-1], 6) < np.round(cells[:, 1:], 6)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def shrunk(image: np.ndarray, size: int = TILE) -> np.ndarray:
    """The image resized to size x size of uint8, halves rounded up; samples of uint16 by their share of its range."""
    cells = area_resize(image, size, size)
    if image.dtype == np.uint16:
        cells = cells / 257
    return np.clip(np.floor(np.round(cells, 6) + 0.5), 0, 255).astype(np.uint8)


def npy(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, image, allow_pickle=False)
    return out.getvalue()


# ---- operators


def media_features(media: DataFrame, media_col: str = "media", *, size: int = TILE, keep: list[str] | None = None, digests: bool = False) -> DataFrame:
    """media with height, width, channels (int), dhash (string, 16 hex digits), tile (binary, NPY), preview (binary, the
    tile as BMP) and error (string); with digests also samples_bytes (bigint), samples_sha256 (string) and tail_crc32
    (bigint, of the last WIDTH) of the decoded samples.

    Rows that do not decode, null ones too, have null features and an error. Columns of these names are replaced."""
    added = "height int, width int, channels int, dhash string, tile binary, preview binary, error string"
    added += ", samples_bytes bigint, samples_sha256 string, tail_crc32 bigint" * digests
    fields = T.StructType.fromDDL(added).fields
    keep = with_columns_replaced(media, [f.name for f in fields]) if keep is None else keep
    cols = [f"c{i}" for i in range(len(keep))]
    frame = media.select(*columns_of(media, keep), *columns_of(media, [media_col])).toDF(*cols, "media")
    schema = T.StructType([*frame.schema.fields[:-1], *fields])

    def one(data: bytes | None) -> tuple:
        try:
            image = decode(bytes(data or b""))
        except MediaError as e:
            return (*[None] * 6, str(e), *[None] * 3)
        plain = grey(image)
        small = shrunk(plain, size)
        back = image.tobytes() if digests else b""
        told = (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-WIDTH:])) if digests else ()
        return (*image.shape[:2], 1 if image.ndim == 2 else image.shape[2], f"{difference_hash(plain):016x}", npy(small), encode_bmp(small), None, *told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.int64()][: len(fields)]
        for rb in batches:
            rows = [one(x) for x in rb.column(len(keep)).to_pylist()]
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], *made], names=schema.names)

    return frame.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])


def payload_of(text: str | None) -> bytes:
    """UTF-8 and bytes 0 up to a positive multiple of WIDTH."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b"\0")


def text_media(docs: DataFrame, text_col: str = "text", out: str = "media", *, keep: list[str] | None = None) -> DataFrame:
    """docs with each text's payload as a grey PGM of WIDTH columns (binary column `out`, replaced if there); a null
    text is an empty one. keep: the columns of docs to carry (all)."""
    keep = with_columns_replaced(docs, [out]) if keep is None else keep
    cols = [f"c{i}" for i in range(len(keep))]
    frame = docs.select(*columns_of(docs, keep), *columns_of(docs, [text_col])).toDF(*cols, "text")
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            made = pa.array([encode_pgm(payload_of(x)) for x in rb.column(len(keep)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], made], names=schema.names)

    return frame.mapInArrow(run, schema).toDF(*keep, out)


def preview_matches(tiles: DataFrame) -> DataFrame:
    """tiles with tile_crc32 (bigint) and preview_ok (boolean): the preview, decoded, is the tile."""
    schema = T.StructType([*tiles.schema.fields, *T.StructType.fromDDL("tile_crc32 bigint, preview_ok boolean").fields])
    at, preview = tiles.columns.index("tile"), tiles.columns.index("preview")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows = rb.column(at).to_pylist()
            same = [x is not None and bool((decode(y)[:, :, 0] == np.load(io.BytesIO(x), allow_pickle=False)).all()) for x, y in zip(rows, rb.column(preview).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array([zlib.crc32(x) if x else None for x in rows], pa.int64()), pa.array(same)], names=schema.names)

    return tiles.mapInArrow(run, schema)


def text_media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text as an image (a Parquet table with a media column in the shared folder), reads the stored images
    back, stores their tiles (NPY) and previews (BMP) likewise, and gives the digests of what was read back.

    A null text is an empty one; a null id stays null; repeated rows stay."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    stored = materialize(text_media(plain, keep=["id", "n_bytes"]), "media")
    held = stored.select("id", "n_bytes", "media", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    tiles = materialize(media_features(held, keep=["id", "n_bytes", "media_bytes", "media_sha256"], digests=True), "tiles")
    told = preview_matches(tiles)
    feature = F.format_string("dhash=%s;shape=%dx%d;npy=%s;preview=%s", "dhash", "height", "width", F.lower(F.lpad(F.hex("tile_crc32"), 8, "0")), F.col("preview_ok").cast("string"))
    return told.select(
        F.col("id").alias(id_col), "n_bytes", F.col("samples_bytes").alias("payload_bytes"), F.col("samples_sha256").alias("payload_sha256"), "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature")
    )


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null texts are empty ones; equal texts have equal values; repeated rows stay."""
    return text_media_digests(table(spark, sf_dir, "documents"))
