"""Arrays of numbers as short byte strings, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def planes(x: np.ndarray) -> bytes:
    """``x`` compressed byte by byte of its numbers; small numbers in wide types cost little."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def from_planes(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = np.frombuffer(pa.decompress(data[8:], n * width, "zstd"), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()


def slim(x: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Slices of counts between ``edges``: a byte each, and those of 255 and more again in full at the end."""
    head = np.minimum(x, 255).astype(np.uint8).tobytes()
    big = np.flatnonzero(x >= 255)
    cut = np.searchsorted(big, edges).tolist()
    full = x[big].astype(np.uint64)
    e = edges.tolist()
    return [head[a:b] + full[c:d].tobytes() for a, b, c, d in zip(e, e[1:], cut, cut[1:])]


def from_slim(data: bytes, n: int) -> np.ndarray:
    x = np.frombuffer(data, np.uint8, n).astype(np.uint64)
    if len(data) > n:
        x[x == 255] = np.frombuffer(data[n:], np.uint64)
    return x


def narrow(x: np.ndarray, edges: np.ndarray, base: np.ndarray) -> tuple[int, list[bytes]]:
    """Slices of the sorted ``x`` between ``edges`` as differences, the first of each to its ``base``, and their width in bytes."""
    step = np.diff(x, prepend=np.uint64(0))
    held = np.flatnonzero(edges[1:] > edges[:-1])
    step[edges[held]] = x[edges[held]] - base[held]
    width = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    e = (edges * width).tolist()
    return width, [raw[a:b] for a, b in zip(e, e[1:])]


def from_narrow(data: bytes, width: int, base: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(base)
