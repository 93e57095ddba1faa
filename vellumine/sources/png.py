"""PNG files as pixel arrays: 8 bits a channel, not interlaced; grey, colour, with or without alpha.

Pixels are blue-green-red, as everywhere in ``functions.imaging``; alpha comes
as an array of its own and is put back on writing.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# The signature, and channels by colour type.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def _chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG file")
    at = 8
    while at < len(data):
        (size,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk is damaged")
        yield kind, body
        at += 12 + size


def decoded(data: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    """Pixels (height, width, 3), blue first, and the alpha channel, if there is one."""
    parts, head = [], b""
    for kind, body in _chunks(data):
        if kind == b"IHDR":
            head = body
        elif kind == b"IDAT":
            parts.append(body)
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    if depth != 8 or colour not in CHANNELS or interlaced:
        raise ValueError("only 8-bit grey and colour images that are not interlaced")
    n = CHANNELS[colour]
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height + 1, (width + 1) * n), np.uint8)  # a row above and a pixel on the left, both zero
    for y in range(height):
        out[y + 1, n:] = _unfiltered(int(rows[y, 0]), rows[y, 1:], out[y], n)
    pixels = out[1:, n:].reshape(height, width, n)
    alpha = pixels[..., -1].copy() if n in (2, 4) else None
    return (np.repeat(pixels[..., :1], 3, axis=2) if n < 3 else pixels[..., 2::-1].copy()), alpha


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, n: int) -> np.ndarray:
    up, corner = above[n:], above[:-n]
    if kind == 0:
        return row
    if kind == 2:
        return row + up
    if kind == 1:  # each byte adds to the one a pixel before it
        return np.cumsum(row.reshape(-1, n), axis=0, dtype=np.uint8).ravel()
    out = [0] * n
    for x, b, c in zip(row.tolist(), up.tolist(), corner.tolist(), strict=True):
        a = out[-n]
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out.append((x + guess) & 255)
    return np.array(out[n:], np.uint8)


def encoded(pixels: np.ndarray, alpha: np.ndarray | None = None, level: int = 6) -> bytes:
    """A PNG file of blue-green-red pixels, with alpha if given; every row differs from the one above."""
    rgb = pixels[..., ::-1]
    if alpha is not None:
        rgb = np.concatenate((rgb, alpha[..., None]), axis=2)
    height, width, n = rgb.shape
    flat = np.ascontiguousarray(rgb).reshape(height, width * n)
    rows = np.concatenate((np.full((height, 1), 2, np.uint8), np.diff(flat, axis=0, prepend=np.zeros((1, width * n), np.uint8))), axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, 6 if n == 4 else 2, 0, 0, 0)
    body = [(b"IHDR", head), (b"IDAT", zlib.compress(rows.tobytes(), level)), (b"IEND", b"")]
    return SIGNATURE + b"".join(struct.pack(">I", len(x)) + k + x + struct.pack(">I", zlib.crc32(k + x)) for k, x in body)


def images(files: DataFrame) -> DataFrame:
    """Decoded images of binary files (path, content): ``path, width, height, pixels, alpha, error``; a file that is no such image has an error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    pixels, alpha = decoded(bytes(content))
                    rows.append((path, pixels.shape[1], pixels.shape[0], pixels.tobytes(), None if alpha is None else alpha.tobytes(), None))
                except (ValueError, struct.error, zlib.error) as e:
                    rows.append((path, None, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "pixels", "alpha", "error"]).astype({"width": "Int32", "height": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, width int, height int, pixels binary, alpha binary, error string")


def files(pages: DataFrame) -> DataFrame:
    """``page, content``: PNG files of decoded images (page, width, height, pixels, alpha)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                pixels = np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 3)
                alpha = None if r.alpha is None else np.frombuffer(r.alpha, np.uint8).reshape(r.height, r.width)
                rows.append((r.page, encoded(pixels, alpha)))
            yield pd.DataFrame(rows, columns=["page", "content"])

    return pages.select("page", "width", "height", "pixels", "alpha").mapInPandas(run, "page int, content binary")
