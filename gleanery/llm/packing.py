"""Integer arrays in compressed form, for rows that carry many numbers."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays in one compressed piece; each is stored in byte planes, so small numbers cost little."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T
        used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
        out.append(struct.pack("<qb", len(a), used) + planes[:used].tobytes())
    return zstandard.compress(b"".join(out), 3)


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(data), 0, []
    while at < len(raw):
        n, used = struct.unpack_from("<qb", raw, at)
        at += 9
        full = np.zeros((n, 8), np.uint8)
        if used:
            full[:, :used] = np.frombuffer(raw, np.uint8, n * used, at).reshape(used, n).T
        out.append(full.view(np.int64).ravel())
        at += n * used
    return out
