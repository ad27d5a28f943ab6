"""Unsigned integers packed at a fixed number of bits each, most significant bit first."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 15  # a multiple of eight values, so every chunk ends on a whole byte


def packed_size(count: int, width: int) -> int:
    return (count * width + 7) // 8


def pack(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` (0 to 64) bits of every value; the last byte is filled up with zeros."""
    if not width:
        return b""
    step = 2 if width <= 16 else 4 if width <= 32 else 8
    out = []
    for at in range(0, len(values), CHUNK):
        part = np.ascontiguousarray(values[at : at + CHUNK], dtype=f">u{step}")
        bits = np.unpackbits(part.view(np.uint8)).reshape(len(part), 8 * step)
        out.append(np.packbits(bits[:, 8 * step - width :]).tobytes())
    return b"".join(out)


def unpack(data: bytes | memoryview, count: int, width: int) -> np.ndarray:
    """``count`` values of ``width`` bits as unsigned 64-bit integers."""
    if not width or not count:
        return np.zeros(count, dtype=np.uint64)
    step = 2 if width <= 16 else 4 if width <= 32 else 8
    out = np.empty(count, dtype=np.uint64)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, count, CHUNK):
        n = min(CHUNK, count - at)
        first = at * width // 8
        bits = np.zeros((n, 8 * step), dtype=np.uint8)
        held = np.unpackbits(raw[first : first + packed_size(n, width)], count=n * width)
        bits[:, 8 * step - width :] = held.reshape(n, width)
        out[at : at + n] = np.packbits(bits).view(f">u{step}")
    return out
