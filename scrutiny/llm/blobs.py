"""Numbers and words of one partial result in one byte string, compressed."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

WIDTHS = (np.uint8, np.uint16, np.uint32, np.int64)


def packed(arrays: list[np.ndarray], words: pa.Array) -> bytes:
    """Arrays of numbers from 0 up, in as few bytes as their largest needs, and words."""
    n = len(words)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1] if n else np.zeros(1, np.int32)
    data = (words.buffers()[2] or b"") if n else b""
    raw = [memoryview(data)[ends[0]:ends[-1]]]
    head = [struct.pack("<qq", n, int(ends[-1] - ends[0]))]
    for a in [np.diff(ends), *arrays]:
        most = int(a.max()) if len(a) else 0
        k = next(k for k, w in enumerate(WIDTHS) if most <= np.iinfo(w).max)
        head.append(struct.pack("<Bq", k, len(a)))
        raw.append(a.astype(WIDTHS[k]).tobytes())
    whole = struct.pack("<H", len(arrays)) + b"".join(head) + b"".join(raw)
    return struct.pack("<q", len(whole)) + pa.compress(whole, "zstd", asbytes=True)


def unpacked(blob: bytes) -> tuple[list[np.ndarray], pa.Array]:
    """What ``packed`` was given; numbers as 64-bit integers."""
    (size,) = struct.unpack_from("<q", blob)
    whole = pa.decompress(memoryview(blob)[8:], size, "zstd", asbytes=True)
    (n_arrays,) = struct.unpack_from("<H", whole)
    n, n_bytes = struct.unpack_from("<qq", whole, 2)
    heads = [struct.unpack_from("<Bq", whole, 18 + 9 * k) for k in range(n_arrays + 1)]
    at = 18 + 9 * (n_arrays + 1)
    data = whole[at:at + n_bytes]
    at += n_bytes
    arrays = []
    for k, length in heads:
        arrays.append(np.frombuffer(whole, WIDTHS[k], length, at).astype(np.int64))
        at += length * np.dtype(WIDTHS[k]).itemsize
    offsets = np.concatenate([[0], np.cumsum(arrays[0])]).astype(np.int32)
    return arrays[1:], pa.BinaryArray.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
