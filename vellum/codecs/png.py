"""A small PNG reader and writer for eight-bit samples: palette, grey, colour, and colour with alpha."""

from __future__ import annotations

import struct
import zlib

import numpy as np

MARK = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class PngError(ValueError):
    pass


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(pixels: np.ndarray, palette: np.ndarray | None = None, offset: tuple[int, int] | None = None, extra: dict[bytes, bytes] | None = None) -> bytes:
    """offset goes to oFFs; extra has further chunks, written before the image data."""
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    kind = 3 if palette is not None else {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    height, width = pixels.shape[:2]
    out = MARK + _chunk(b"IHDR", struct.pack(">2I5B", width, height, 8, kind, 0, 0, 0))
    if palette is not None:
        out += _chunk(b"PLTE", palette.astype(np.uint8).tobytes())
    if offset is not None:
        out += _chunk(b"oFFs", struct.pack(">2iB", *offset, 0))
    for name, body in (extra or {}).items():
        out += _chunk(name, body)
    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1).astype(np.uint8)], 1)
    return out + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 9)) + _chunk(b"IEND", b"")


def chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    if data[:8] != MARK:
        raise PngError("not PNG")
    out, at = [], 8
    while at + 12 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) < n or zlib.crc32(kind + body) != int.from_bytes(data[at + 8 + n : at + 12 + n], "big"):
            raise PngError("broken chunk")
        out.append((kind, body))
        at += 12 + n
    return out


def decode(data: bytes) -> tuple[np.ndarray, dict[bytes, bytes]]:
    """Samples (height, width[, channels]) and the other chunks."""
    found = chunks(data)
    other = {k: v for k, v in found if k != b"IDAT"}
    width, height, depth, kind, _, _, interlace = struct.unpack(">2I5B", other[b"IHDR"])
    if depth != 8 or interlace or kind not in _CHANNELS:
        raise PngError("a PNG form that is not read")
    n = _CHANNELS[kind]
    raw = np.frombuffer(zlib.decompress(b"".join(v for k, v in found if k == b"IDAT")), np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height + 1, width + 1, n), np.int64)  # a row above and a sample to the left of the image
    for y in range(height):
        way, line = int(raw[y, 0]), raw[y, 1:].reshape(width, n).astype(np.int64)
        row, above = out[y + 1], out[y]
        if way == 0:
            row[1:] = line
        elif way == 1:
            row[1:] = np.cumsum(line, 0) & 255
        elif way == 2:
            row[1:] = (line + above[1:]) & 255
        else:
            for x in range(width):
                a, b, c = row[x], above[x + 1], above[x]
                if way == 3:
                    base = (a + b) >> 1
                else:
                    p = a + b - c
                    da, db, dc = np.abs(p - a), np.abs(p - b), np.abs(p - c)
                    base = np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, c))
                row[x + 1] = (line[x] + base) & 255
    pixels = out[1:, 1:].astype(np.uint8)
    return (pixels[:, :, 0] if n == 1 else pixels), other
