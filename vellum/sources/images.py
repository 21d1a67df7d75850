"""Images of the three forms as rows: their headers, their samples, and their conversion to and from PNG."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vellum.codecs import pms, png, qnt, vsp

INFO = (
    "format string, version int, width int, height int, bpp int, x int, y int, palette_bank int, palette_mask int, alpha boolean, mtime timestamp, error string"
)
ERRORS = (vsp.VspError, pms.PmsError, qnt.QntError, png.PngError)


def form(data: bytes, old: bool = False) -> str:
    if data[:2] == pms.MARK:
        return "pms"
    if data[:4] == qnt.MARK:
        return "qnt"
    return "pms" if old else "vsp"


def info(data: bytes, old: bool = False) -> dict:
    kind = form(data, old)
    if kind == "qnt":
        h = qnt.header(data)
        return {"format": kind, "version": h["version"], "width": h["width"], "height": h["height"], "bpp": h["bpp"] if h["pixel_size"] else 0, "x": h["x"], "y": h["y"], "alpha": h["alpha_size"] > 0}
    if kind == "pms":
        h = pms.header(data, old)
        made = {k: h[k] for k in ("version", "width", "height", "bpp", "x", "y", "palette_mask")}
        return made | {"format": kind, "alpha": h["alpha_bpp"] > 0, "mtime": h["seconds"] * 1_000_000 if h["version"] >= 2 else None}
    h = vsp.header(data)
    return {"format": kind, "version": 0, "width": h["columns"] * 8, "height": h["height"], "bpp": 4, "x": h["x"] * 8, "y": h["y"], "palette_bank": h["bank"], "alpha": False}


def to_png(data: bytes, old: bool = False) -> bytes:
    """Offsets are kept in oFFs, a palette bank in pbNk, a palette mask in pmSk."""
    kind = form(data, old)
    if kind == "vsp":
        v = vsp.decode(data)
        return png.encode(v.pixels, v.palette, (v.x * 8, v.y), {b"pbNk": bytes([v.bank])})
    if kind == "pms":
        p = pms.decode(data, old)
        if p.palette is not None:
            return png.encode(p.pixels, p.palette, (p.x, p.y), {b"pmSk": p.palette_mask.to_bytes(2, "big")})
        rgb = pms.to_rgb(p.pixels)
        return png.encode(rgb if p.alpha is None else np.dstack([rgb, p.alpha]), None, (p.x, p.y))
    q = qnt.decode(data)
    if q.pixels is None:
        return png.encode(q.alpha, None, (q.x, q.y))
    return png.encode(q.pixels if q.alpha is None else np.dstack([q.pixels, q.alpha]), None, (q.x, q.y))


def from_png(data: bytes, kind: str, version: int = 1, seconds: int = 0) -> bytes:
    pixels, other = png.decode(data)
    x, y = (int.from_bytes(other[b"oFFs"][i : i + 4], "big", signed=True) for i in (0, 4)) if b"oFFs" in other else (0, 0)
    palette = np.frombuffer(other[b"PLTE"], np.uint8).reshape(-1, 3) if b"PLTE" in other else None
    grown = lambda n: np.pad(palette, [(0, n - len(palette)), (0, 0)])
    if kind == "vsp":
        if palette is None or len(palette) > 16:
            raise vsp.VspError("sixteen colours at most")
        return vsp.encode(vsp.Vsp(x // 8, y, other.get(b"pbNk", b"\0")[0], grown(16), pixels))
    if kind == "pms":
        if palette is not None:
            return pms.encode(pms.Pms(x, y, pixels, grown(256), None, int.from_bytes(other.get(b"pmSk", b"\xff\xff"), "big"), version, seconds))
        alpha = pixels[:, :, 3] if pixels.ndim == 3 and pixels.shape[2] == 4 else None
        return pms.encode(pms.Pms(x, y, pms.from_rgb(pixels), None, alpha, 0, version, seconds))
    if pixels.ndim == 2:
        return qnt.encode(qnt.Qnt(x, y, None, pixels))
    return qnt.encode(qnt.Qnt(x, y, pixels[:, :, :3], pixels[:, :, 3] if pixels.shape[2] == 4 else None))


def image_info(images: DataFrame, data_col: str = "content", old: bool = False) -> DataFrame:
    """images without their bytes, with the columns of INFO; what is no image has only an error."""
    keep = [c for c in images.columns if c != data_col]
    fields = T.StructType.fromDDL(INFO).fields
    kinds = [pa.string(), *[pa.int32()] * 8, pa.bool_(), pa.timestamp("us", tz="UTC"), pa.string()]
    schema = T.StructType([*[images.schema[c] for c in keep], *fields])

    def one(data: bytes | None) -> dict:
        try:
            return info(bytes(data or b""), old)
        except ERRORS as e:
            return {"error": str(e)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows = [one(x) for x in rb.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], *[pa.array([r.get(f.name) for r in rows], k) for f, k in zip(fields, kinds, strict=True)]], names=schema.names)

    return images.select(*keep, data_col).mapInArrow(run, schema)


def convert(images: DataFrame, kind: str | None, data_col: str = "content", old: bool = False) -> DataFrame:
    """images with their bytes as PNG (kind None), or PNG bytes in the form of `kind`; and an error column."""
    keep = [c for c in images.columns if c != data_col]
    schema = T.StructType([*[images.schema[c] for c in keep], T.StructField(data_col, T.BinaryType()), T.StructField("error", T.StringType())])

    def one(data: bytes | None) -> tuple[bytes | None, str | None]:
        try:
            return (to_png(bytes(data or b""), old) if kind is None else from_png(bytes(data or b""), kind)), None
        except (*ERRORS, ValueError) as e:
            return None, str(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            rows = [one(x) for x in rb.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns[: len(keep)], pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=schema.names)

    return images.select(*keep, data_col).mapInArrow(run, schema)
