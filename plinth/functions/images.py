"""Pixels of images: by an imaging library where there is one, else PNG and BMP by numpy alone."""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

try:
    from PIL import Image
except ImportError:
    Image = None

PNG = b"\x89PNG\r\n\x1a\n"
#: Values of a pixel by the colour type of a PNG.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def suffix() -> str:
    """Of the files that `encoded` makes."""
    return ".jpg" if Image else ".png"


def _unfiltered(raw: bytes, rows: int, stride: int, step: int) -> np.ndarray:
    """The rows of a PNG, of stride bytes each, without their filters; a pixel has step bytes."""
    data = np.frombuffer(raw, np.uint8).reshape(rows, stride + 1)
    out = np.zeros((rows, stride), np.uint8)
    above = np.zeros(stride, np.uint8)
    for y in range(rows):
        kind, line = data[y, 0], data[y, 1:].copy()
        if kind == 1:
            for c in range(step):
                line[c::step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind == 2:
            line += above
        elif kind in (3, 4):
            for x in range(stride):
                a, b = (int(line[x - step]) if x >= step else 0), int(above[x])
                c = int(above[x - step]) if x >= step else 0
                guess = (a + b) // 2 if kind == 3 else min((a, b, c), key=lambda v, p=a + b - c: abs(p - v))
                line[x] = (int(line[x]) + guess) & 255
        out[y] = above = line
    return out


def _png(content: bytes) -> np.ndarray | None:
    at, chunks = len(PNG), {}
    while at + 8 <= len(content):
        size, name = struct.unpack(">I4s", content[at : at + 8])
        chunks.setdefault(name, []).append(content[at + 8 : at + 8 + size])
        at += size + 12
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[b"IHDR"][0])
    if depth != 8 or interlaced:
        return None
    n = CHANNELS[colour]
    pixels = _unfiltered(zlib.decompress(b"".join(chunks[b"IDAT"])), height, width * n, n).reshape(height, width, n)
    if colour == 3:
        return np.frombuffer(chunks[b"PLTE"][0], np.uint8).reshape(-1, 3)[pixels[:, :, 0]]
    return pixels[:, :, :3] if n >= 3 else np.repeat(pixels[:, :, :1], 3, axis=2)


def _bmp(content: bytes) -> np.ndarray | None:
    start, width, height, depth = (*struct.unpack("<I", content[10:14]), *struct.unpack("<ii", content[18:26]), *struct.unpack("<H", content[28:30]))
    if depth != 24:
        return None
    stride = (width * 3 + 3) // 4 * 4
    rows = np.frombuffer(content, np.uint8, stride * abs(height), start).reshape(abs(height), stride)[:, : width * 3].reshape(abs(height), width, 3)
    return (rows[::-1] if height > 0 else rows)[:, :, ::-1]


def decoded(content: bytes) -> np.ndarray | None:
    """Height x width x RGB; None for what cannot be read."""
    try:
        if Image:
            with Image.open(io.BytesIO(content)) as image:
                return np.asarray(image.convert("RGB"))
        return _png(content) if content[:8] == PNG else _bmp(content) if content[:2] == b"BM" else None
    except Exception:  # noqa: BLE001  what a file may hold is not known
        return None


def resized(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """The image in another size: smoothed by the library, else bilinear between the centres of pixels."""
    if pixels.shape[:2] == (height, width):
        return pixels
    if Image:
        return np.asarray(Image.fromarray(pixels).resize((width, height), Image.Resampling.LANCZOS))

    def places(new: int, old: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(new) + 0.5) * old / new - 0.5, 0, old - 1)
        low = at.astype(int)
        return low, np.minimum(low + 1, old - 1), at - low

    (y0, y1, fy), (x0, x1, fx) = places(height, pixels.shape[0]), places(width, pixels.shape[1])
    p, fy, fx = pixels.astype(float), fy[:, None, None], fx[None, :, None]
    top, bottom = p[y0][:, x0] * (1 - fx) + p[y0][:, x1] * fx, p[y1][:, x0] * (1 - fx) + p[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + bottom * fy).astype(np.uint8)


def encoded(pixels: np.ndarray) -> bytes:
    """A JPEG by the library, else a PNG."""
    if Image:
        out = io.BytesIO()
        Image.fromarray(pixels).save(out, format="JPEG", quality=95)
        return out.getvalue()
    height, width = pixels.shape[:2]
    raw = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, width * 3)], axis=1).tobytes()

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    return PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def blank_share(pixels: np.ndarray, background: int = 255, tolerance: int = 6) -> float:
    """Share of pixels within tolerance of the background; 1 without any."""
    near = np.abs(pixels.astype(int) - background) <= tolerance
    return float(near.all(axis=-1).mean()) if pixels.size else 1.0
