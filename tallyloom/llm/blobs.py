"""Arrays as compressed bytes, for tables whose rows hold many small numbers."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

_HEAD = struct.Struct("<3sQQ")


def pack(*arrays: np.ndarray) -> bytes:
    """One-dimensional numeric arrays as bytes: equal places of all numbers together, then compressed."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        body = codec.compress(planes, asbytes=True) if planes else b""
        out += [_HEAD.pack(a.dtype.str[1:].encode().ljust(3), len(a), len(body)), body]
    return b"".join(out)


def unpack(raw: bytes) -> list[np.ndarray]:
    codec, out, at = pa.Codec("zstd"), [], 0
    while at < len(raw):
        kind, n, size = _HEAD.unpack_from(raw, at)
        at += _HEAD.size
        dtype = np.dtype("<" + kind.decode().strip())
        planes = codec.decompress(raw[at : at + size], n * dtype.itemsize, asbytes=True) if size else b""
        at += size
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).reshape(n))
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned numbers, the first kept; ``np.cumsum`` restores them."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))
