"""Compact columns of integers that chunks of documents and slices of a key space exchange.

A chunk sends each slice the sorted keys it has there and gets its answers back in the
same order; sorted keys are stored as differences, and integers as planes of bytes of
which the empty ones are left out and the others compressed where that helps.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np


RAW, ZERO, MATCHED, CODED = range(4)


def _coded(plane: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, zlib.MAX_WBITS, 9, zlib.Z_HUFFMAN_ONLY)
    return packer.compress(plane) + packer.flush()


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as bytes: each plane of bytes as it is, left out if zero, or
    compressed with or without matches, whichever a part of it suggests."""
    planes = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8)
    body = []
    for i in range(8):
        column = np.ascontiguousarray(planes[:, i])
        plane = column.tobytes()
        if not column.any():
            kind, plane = ZERO, b""
        else:
            some = plane[:1 << 14]
            sizes = {RAW: 0.95 * len(some), MATCHED: len(zlib.compress(some, 1)), CODED: len(_coded(some))}
            kind = min(sizes, key=sizes.get)
            plane = zlib.compress(plane, 1) if kind == MATCHED else _coded(plane) if kind == CODED else plane
        body.append(struct.pack("<BI", kind, len(plane)) + plane)
    return struct.pack("<I", len(values)) + b"".join(body)


def unpack(body: bytes) -> np.ndarray:
    (n,), at = struct.unpack_from("<I", body), 4
    planes = np.zeros((n, 8), np.uint8)
    for i in range(8):
        kind, size = struct.unpack_from("<BI", body, at)
        raw = body[at + 5:at + 5 + size]
        if kind != ZERO:
            planes[:, i] = np.frombuffer(raw if kind == RAW else zlib.decompress(raw), np.uint8)
        at += 5 + size
    return planes.view(np.uint64).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(body: bytes) -> np.ndarray:
    return np.cumsum(unpack(body), dtype=np.uint64)


def bundle(parts: list[bytes]) -> bytes:
    return struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def unbundle(body: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<I", body)
    sizes = struct.unpack_from(f"<{n}Q", body, 4)
    out, at = [], 4 + 8 * n
    for s in sizes:
        out.append(body[at:at + s])
        at += s
    return out


def slice_bounds(keys: np.ndarray, bits: int, slices: int) -> np.ndarray:
    """Where each of ``slices`` equal slices of the key space [0, 2^bits) begins in sorted ``keys``."""
    edges = np.array([(i << bits) // slices for i in range(1, slices)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def mixed(*columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of unsigned integer columns."""
    h = np.full(len(columns[0]), len(columns) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h
