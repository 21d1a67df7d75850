"""PMS images: 256 colours with a palette, or 16-bit colour with alpha, packed by runs and copies of lines.

One reader and one writer serve both depths, as their commands differ in counts and sample size only.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from vellum.functions.arith import FILETIME_EPOCH

MARK = b"PM"
_LONG = struct.Struct("<HHBBBBH9I")
_LONG_FIELDS = ("version", "header_size", "bpp", "alpha_bpp", "transparent", "_1", "palette_mask", "_2", "x", "y", "width", "height", "data", "aux", "comment", "_3")
_COMMANDS = 0xF8
#: Bits that a run of 16-bit samples with one leading byte shares.
_SHARED = 0xE61C


class PmsError(ValueError):
    pass


@dataclass
class Pms:
    x: int
    y: int
    pixels: np.ndarray  # (height, width): palette places, or 16-bit colours
    palette: np.ndarray | None = None  # (256, 3)
    alpha: np.ndarray | None = None  # (height, width)
    palette_mask: int = 0xFFFF
    version: int = 1  # 0 is the old form without a mark
    seconds: int = 0


@dataclass(frozen=True)
class _Depth:
    size: int  # bytes of a sample
    line: int  # least length of a copied line
    run: int  # of a run of one sample
    pair: int  # of a run of two


_EIGHT, _SIXTEEN = _Depth(1, 3, 4, 3), _Depth(2, 2, 3, 2)


def header(data: bytes, old: bool = False) -> dict[str, int]:
    if data[:2] == MARK and len(data) >= 48:
        out = dict(zip(_LONG_FIELDS, _LONG.unpack_from(data, 2), strict=True))
        out["seconds"] = (int.from_bytes(data[48:56], "little") - FILETIME_EPOCH) // 10_000_000 if out["version"] >= 2 else 0
        return out
    if not old or len(data) < 0x20:
        raise PmsError("not PMS")
    x, y, right, bottom, flag, mask = struct.unpack_from("<6H", data)
    if x > right or y > bottom or right >= 640 or bottom >= 480 or flag > 1 or any(data[12:0x20]):
        raise PmsError("not PMS")
    return {
        "version": 0, "header_size": 0x20, "bpp": 8, "alpha_bpp": 0, "palette_mask": mask, "x": x, "y": y, "width": right - x + 1, "height": bottom - y + 1, "data": 0x320, "aux": 0x20, "seconds": 0,
    }


def _unpack(source: bytes, width: int, height: int, depth: _Depth) -> np.ndarray:
    """Samples line by line. The reader keeps its place; a command that goes past its line is an error."""
    out = np.zeros((height, width), np.uint16)
    at, wide = 0, depth.size == 2

    def take(n: int) -> bytes:
        nonlocal at
        at += n
        if at > len(source):
            raise PmsError("broken image")
        return source[at - n : at]

    def sample() -> int:
        return int.from_bytes(take(depth.size), "little")

    for y in range(height):
        row, x = out[y], 0
        while x < width:
            code = take(1)[0]
            if code < _COMMANDS:
                made = [code | take(1)[0] << 8 if wide else code]
            elif code >= 0xFE:
                n, above = take(1)[0] + depth.line, 0x100 - code
                if y < above:
                    raise PmsError("broken image")
                made = out[y - above, x : x + n]
                if len(made) < n:
                    raise PmsError("broken image")
            elif code == 0xFD:
                n = take(1)[0] + depth.run
                made = [sample()] * n
            elif code == 0xFC:
                n = take(1)[0] + depth.pair
                made = [sample(), sample()] * n
            elif wide and code >= 0xFA:
                side = x - 1 if code == 0xFB else x + 1
                if y < 1 or not 0 <= side < width:
                    raise PmsError("broken image")
                made = [out[y - 1, side]]
            elif wide and code == 0xF9:
                low = take(1)[0] + 1
                high = take(1)[0]
                shared = (high & 0xE0) << 8 | (high & 0x18) << 6 | (high & 0x07) << 2
                made = [shared | (c & 0xC0) << 5 | (c & 0x3C) << 3 | c & 0x03 for c in take(low)]
            else:
                made = [sample()]
            if x + len(made) > width:
                raise PmsError("broken image")
            row[x : x + len(made)] = made
            x += len(made)
    return out


def _agree(a: np.ndarray, b: np.ndarray, most: int) -> int:
    differ = np.flatnonzero(a[:most] != b[:most])
    return int(differ[0]) if len(differ) else min(len(a), len(b), most)


def _ways(out: np.ndarray, y: int, x: int, depth: _Depth):
    """(samples covered, code) of each way to go on; the plain one first, with code b"" for 16 bits, whose plain runs are
    packed on their own."""
    row, wide = out[y, x:], depth.size == 2
    c = int(row[0])
    word = lambda v: int(v).to_bytes(depth.size, "little")
    yield 1, b"" if wide else bytes([0xF8, c] if c >= _COMMANDS else [c])
    for above in (1, 2):
        if y >= above:
            n = _agree(row, out[y - above, x:], depth.line + 255)
            if n >= depth.line:
                yield n, bytes([0x100 - above, n - depth.line])
    n = _agree(row, np.full(len(row), c), depth.run + 255)
    if n >= depth.run:
        yield n, bytes([0xFD, n - depth.run]) + word(c)
    if len(row) > 1 and not (wide and row[1] == c):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).astype(np.int64)
        n = _agree(pairs[:, 0] << 16 | pairs[:, 1], np.full(len(pairs), c << 16 | int(row[1])), depth.pair + 255)
        if n >= depth.pair:
            yield 2 * n, bytes([0xFC, n - depth.pair]) + word(c) + word(row[1])
    if wide and y:
        if x and out[y - 1, x - 1] == c:
            yield 1, b"\xfb"
        if len(row) > 1 and out[y - 1, x + 1] == c:
            yield 1, b"\xfa"


def _pack(pixels: np.ndarray, depth: _Depth) -> bytes:
    """Greedy: at each place the code that saves most bytes, of equal ones the first."""
    out = bytearray()
    height, width = pixels.shape
    for y in range(height):
        x = plain = 0

        def saved(way: tuple[int, bytes], y: int = y) -> int:
            n, code = way
            return depth.size * n - (len(code) or (3 if pixels[y, x] & 0xFF >= _COMMANDS else 2))  # noqa: B023

        while x < width:
            n, code = max(_ways(pixels, y, x, depth), key=saved)
            if code:
                out += _plain(pixels[y, x - plain : x]) + code
                plain = 0
            else:
                plain += 1
            x += n
        out += _plain(pixels[y, width - plain :])
    return bytes(out)


def _plain(samples: np.ndarray) -> bytes:
    """16-bit samples; three or more that share the bits of _SHARED have those once."""
    out, at, values = bytearray(), 0, samples.tolist()
    while at < len(values):
        end = at + 1
        while end < len(values) and end - at < 256 and (values[end] ^ values[at]) & _SHARED == 0:
            end += 1
        if end - at > 2:
            v = values[at]
            out += bytes([0xF9, end - at - 1, (v & 0xE000) >> 8 | (v & 0x600) >> 6 | (v & 0x1C) >> 2])
            out += bytes((c & 0x1800) >> 5 | (c & 0x1E0) >> 3 | c & 3 for c in values[at:end])
            at = end
        else:
            out += (b"\xf8" if values[at] & 0xFF >= _COMMANDS else b"") + values[at].to_bytes(2, "little")
            at += 1
    return bytes(out)


def decode(data: bytes, old: bool = False) -> Pms:
    h = header(data, old)
    width, height, wide = h["width"], h["height"], h["bpp"] == 16
    if h["bpp"] not in (8, 16):
        raise PmsError(f"{h['bpp']} bits a sample")
    pixels = _unpack(data[h["data"] :], width, height, _SIXTEEN if wide else _EIGHT)
    palette = alpha = None
    if not wide:
        palette = np.frombuffer(data, np.uint8, 768, h["aux"]).reshape(256, 3)
    elif h["aux"]:
        alpha = _unpack(data[h["aux"] :], width, height, _EIGHT).astype(np.uint8)
    return Pms(h["x"], h["y"], pixels, palette, alpha, h["palette_mask"], h["version"], h["seconds"])


def encode(image: Pms) -> bytes:
    height, width = image.pixels.shape
    wide = image.palette is None
    body = _pack(image.pixels.astype(np.uint16), _SIXTEEN if wide else _EIGHT)
    if image.version == 0:
        if wide:
            raise PmsError("the old form has 256 colours")
        head = struct.pack("<6H", image.x, image.y, image.x + width - 1, image.y + height - 1, 1, image.palette_mask).ljust(0x20, b"\0")
        return head + image.palette.astype(np.uint8).tobytes().ljust(768, b"\0") + body
    size = 64 if image.version >= 2 else 48
    aux = b""
    if not wide:
        aux, places = image.palette.astype(np.uint8).tobytes().ljust(768, b"\0"), (size + 768, size)
    else:
        aux = b"" if image.alpha is None else _pack(image.alpha.astype(np.uint16), _EIGHT)
        places = (size, size + len(body) if aux else 0)
    head = MARK + _LONG.pack(image.version, size, 16 if wide else 8, 8 if wide and aux else 0, 0, 0, image.palette_mask, 0, image.x, image.y, width, height, *places, 0, 0)
    if image.version >= 2:
        head += struct.pack("<QII", image.seconds * 10_000_000 + FILETIME_EPOCH, 0, 0)
    return head + (body + aux if wide else aux + body)


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """(height, width, 3) of 16-bit colours, high bits repeated in the low ones."""
    p = pixels.astype(np.uint32)
    r, g, b = p >> 11, p >> 5 & 63, p & 31
    return np.stack([r << 3 | r >> 2, g << 2 | g >> 4, b << 3 | b >> 2], -1).astype(np.uint8)


def from_rgb(rgb: np.ndarray) -> np.ndarray:
    c = rgb.astype(np.uint16)
    return (c[..., 0] & 0xF8) << 8 | (c[..., 1] & 0xFC) << 3 | c[..., 2] >> 3
