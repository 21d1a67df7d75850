"""QNT images: two-by-two blocks of predicted samples, deflated; colour, alpha, or both."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MARK = b"QNT\0"
_FIELDS = ("x", "y", "width", "height", "bpp", "one", "pixel_size", "alpha_size")


class QntError(ValueError):
    pass


@dataclass
class Qnt:
    x: int
    y: int
    pixels: np.ndarray | None  # (height, width, 3)
    alpha: np.ndarray | None  # (height, width)
    version: int = 1


def header(data: bytes) -> dict[str, int]:
    if data[:4] != MARK or len(data) < 44:
        raise QntError("not QNT")
    version = int.from_bytes(data[4:8], "little")
    at = 12 if version else 8
    out = {"version": version, "header_size": int.from_bytes(data[8:12], "little") if version else 48}
    return out | dict(zip(_FIELDS, struct.unpack_from("<8I", data, at), strict=True))


def _predict(up: np.ndarray, left: np.ndarray) -> np.ndarray:
    return (up + left) >> 1


def unfilter(raw: np.ndarray) -> np.ndarray:
    """Samples from differences: each is the mean of those above and to the left (or the one there is) less the raw value.
    Both are on the diagonal before, so a diagonal is done at once."""
    out = raw.astype(np.int64)
    height, width = out.shape[:2]
    for d in range(1, height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        up, left = out[np.maximum(y - 1, 0), x], out[y, np.maximum(x - 1, 0)]
        edge = lambda c: c[:, None] if out.ndim == 3 else c
        base = np.where(edge(y == 0), left, np.where(edge(x == 0), up, _predict(up, left)))
        out[y, x] = (base - out[y, x]) & 255
    return out.astype(np.uint8)


def filtered(samples: np.ndarray) -> np.ndarray:
    s = samples.astype(np.int64)
    out = s.copy()
    out[0, 1:] = s[0, :-1] - s[0, 1:]
    out[1:, 0] = s[:-1, 0] - s[1:, 0]
    out[1:, 1:] = _predict(s[:-1, 1:], s[1:, :-1]) - s[1:, 1:]
    return (out & 255).astype(np.uint8)


def _blocks(planes: np.ndarray) -> bytes:
    """Blue, green, red planes; in each, blocks left to right and down, in a block columns first."""
    h, w = planes.shape[:2]
    return planes.reshape(h // 2, 2, w // 2, 2, 3).transpose(4, 0, 2, 3, 1)[::-1].tobytes()


def _unblocks(raw: bytes, h: int, w: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(3, h // 2, w // 2, 2, 2)[::-1].transpose(1, 4, 2, 3, 0).reshape(h, w, 3)


def _inflate(data: bytes, least: int) -> bytes:
    try:
        raw = zlib.decompressobj().decompress(data)
    except zlib.error as e:
        raise QntError("broken image") from e
    if len(raw) < least:
        raise QntError("broken image")
    return raw


def decode(data: bytes) -> Qnt:
    h = header(data)
    width, height = h["width"], h["height"]
    wide, high = width + (width & 1), height + (height & 1)
    at, pixels, alpha = h["header_size"], None, None
    if h["pixel_size"]:
        raw = _inflate(data[at : at + h["pixel_size"]], wide * high * 3)[: wide * high * 3]
        pixels = unfilter(_unblocks(raw, high, wide)[:height, :width])
        at += h["pixel_size"]
    if h["alpha_size"]:
        raw = _inflate(data[at : at + h["alpha_size"]], wide * height)  # the height need not be even
        plane = np.frombuffer(raw, np.uint8, wide * height).reshape(height, wide)[:, :width]
        alpha = unfilter(plane[:, :, None])[:, :, 0]
    return Qnt(h["x"], h["y"], pixels, alpha, h["version"])


def encode(image: Qnt) -> bytes:
    some = image.pixels if image.pixels is not None else image.alpha
    height, width = some.shape[:2]
    even = lambda a: np.pad(a, [(0, height & 1), (0, width & 1)] + [(0, 0)] * (a.ndim - 2))
    body = [b"", b""]
    if image.pixels is not None:
        body[0] = zlib.compress(_blocks(even(filtered(image.pixels))), 9)
    if image.alpha is not None:
        body[1] = zlib.compress(even(filtered(image.alpha[:, :, None])[:, :, 0]).tobytes(), 9)
    head = MARK + struct.pack("<2I8I", 1, 52, image.x, image.y, width, height, 24, 1, len(body[0]), len(body[1]))
    return head.ljust(52, b"\0") + b"".join(body)
