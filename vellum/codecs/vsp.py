"""VSP images: sixteen colours in four planes of eight-pixel columns, packed by runs and copies."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_LIMIT = 256


class VspError(ValueError):
    pass


@dataclass
class Vsp:
    x: int  # in columns of eight pixels
    y: int
    bank: int
    palette: np.ndarray  # (16, 3), red, green, blue
    pixels: np.ndarray  # (height, width), 0 to 15


def header(data: bytes) -> dict[str, int]:
    if len(data) < 10:
        raise VspError("not VSP")
    x, y, right, bottom, _, bank = struct.unpack_from("<4H2B", data)
    out = {"x": x, "y": y, "columns": right - x, "height": bottom - y, "bank": bank}
    if x > 80 or y > 400 or not 0 <= out["columns"] <= 80 or not 0 <= out["height"] <= 401 or bank > 15:
        raise VspError("not VSP")
    return out


def decode(data: bytes) -> Vsp:
    h = header(data)
    height, columns = h["height"], h["columns"]
    colours = np.frombuffer(data, np.uint8, 48, 10).reshape(16, 3).astype(np.int64) * 17
    source = iter(data[58:])
    planes = np.zeros((columns + 1, 4, height), np.uint8)  # the first is the column before the image
    try:
        flip = 0
        for column in range(1, columns + 1):
            for p in range(4):
                own, y = planes[column, p], 0
                while y < height:
                    code = next(source)
                    if code == 6:
                        flip = 255
                        continue
                    if code >= 7:
                        made = bytes([next(source) if code == 7 else code])
                    else:
                        n = next(source) + 1
                        if code == 0:
                            made = planes[column - 1, p, y : y + n].tobytes()
                        elif code == 1:
                            made = bytes([next(source)]) * n
                        elif code == 2:
                            made = bytes([next(source), next(source)]) * n
                        else:
                            made = (planes[column, code - 3, y : y + n] ^ flip).tobytes()
                            flip = 0
                        if y + (2 * n if code == 2 else n) > height:
                            raise VspError("broken image")
                    own[y : y + len(made)] = np.frombuffer(made, np.uint8)
                    y += len(made)
    except StopIteration:
        raise VspError("broken image") from None
    bits = np.unpackbits(planes[1:], axis=None).reshape(columns, 4, height, 8)
    chunky = (bits * np.array([1, 2, 4, 8], np.uint8)[None, :, None, None]).sum(1, dtype=np.uint8)
    return Vsp(h["x"], h["y"], h["bank"], colours[:, [1, 2, 0]].astype(np.uint8), chunky.transpose(1, 0, 2).reshape(height, columns * 8))


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading values agree, of _LIMIT at most."""
    a, b = a[:_LIMIT], b[:_LIMIT]
    differ = np.flatnonzero(a != b)
    return int(differ[0]) if len(differ) else min(len(a), len(b))


def _choices(column: np.ndarray, before: np.ndarray | None, p: int, y: int):
    """(bytes covered, code) of each way to go on at y, plain first; of equal savings the first counts."""
    own = column[p, y:]
    c = int(own[0])
    yield 1, bytes([7, c] if c < 8 else [c])
    if before is not None:
        n = _run(own, before[p, y:])
        yield n, bytes([0, (n - 1) & 255])
    n = _run(own, np.full(len(own), c))
    yield n, bytes([1, n - 1, c])
    if len(own) > 1:
        pairs = own[: len(own) // 2 * 2].reshape(-1, 2)
        n = _run(pairs[:, 0].astype(np.int64) << 8 | pairs[:, 1], np.full(len(pairs), c << 8 | int(own[1])))
        yield 2 * n, bytes([2, n - 1, c, own[1]])
    for q in range(p):
        n = _run(own, column[q, y:])
        yield n, bytes([3 + q, (n - 1) & 255])
    for q in range(p):  # the first plane is looked at for any q, and so only it is ever the best
        n = _run(own, column[0, y:] ^ 255)
        yield n, bytes([6, 3 + q, (n - 1) & 255])


def encode(image: Vsp) -> bytes:
    """Greedy: at each place the code that saves most bytes."""
    height, width = image.pixels.shape
    if width % 8 or image.pixels.max(initial=0) > 15:
        raise VspError("widths are multiples of 8, colours 0 to 15")
    out = bytearray(struct.pack("<4H2B", image.x, image.y, image.x + width // 8, image.y + height, 0, image.bank))
    out += (image.palette[:, [2, 0, 1]] >> 4).astype(np.uint8).tobytes().ljust(48, b"\0")
    chunky = image.pixels.reshape(height, width // 8, 8).transpose(1, 0, 2)
    planes = np.stack([np.packbits((chunky >> p) & 1, axis=2)[:, :, 0] for p in range(4)], 1) if width else np.zeros((0, 4, height), np.uint8)
    for k, column in enumerate(planes):
        for p in range(4):
            y = 0
            while y < height:
                n, code = max(_choices(column, planes[k - 1] if k else None, p, y), key=lambda x: x[0] - len(x[1]))
                out += code
                y += n
    return bytes(out)
