"""PNG bytes of a frame, and what a PNG's header tells without decoding it."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the PNG format: signature, end chunk, colour type by channels.
SIGNATURE = bytes([137]) + b"PNG\r\n" + bytes([26]) + b"\n"
COLOUR_TYPE = {1: 0, 3: 2, 4: 6}
END_CHUNK = bytes(4) + b"IEND" + bytes([174, 66, 96, 130])


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(data: bytes, height: int, width: int, channels: int) -> bytes:
    """PNG of an interleaved grey, BGR or BGRA frame."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels >= 3:
        pixels = pixels[:, :, [2, 1, 0, 3][:channels]]
    lines = np.zeros((height, 1 + width * channels), np.uint8)          # each line with filter 0 in front
    lines[:, 1:] = pixels.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPE[channels], 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes())) + END_CHUNK


def _number(content: Column, at: int, size: int) -> Column:
    """Big-endian number of ``size`` bytes from byte ``at``."""
    return F.conv(F.hex(F.substring(content, at + 1, size)), 16, 10).cast("int")


def png_header(content: Column) -> Column:
    """(width, height, channels) of a PNG from its first 26 bytes; NULL if it is none or its end is missing.

    Palette images count as three channels, grey with alpha as four, as an image reader hands them out.
    """
    kind = _number(content, 25, 1)
    channels = (F.when(kind == 0, 1).when(kind.isin(2, 3), 3).when(kind.isin(4, 6), 4))
    whole = ((F.substring(content, 1, len(SIGNATURE)) == F.lit(SIGNATURE)) & (F.substring(content, 13, 4) == F.lit(b"IHDR"))
             & (F.substring(content, -len(END_CHUNK), len(END_CHUNK)) == F.lit(END_CHUNK)) & channels.isNotNull())
    return F.when(whole, F.struct(_number(content, 16, 4).alias("width"), _number(content, 20, 4).alias("height"),
                                  channels.alias("channels")))
