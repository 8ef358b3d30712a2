"""Rows ``(part, block, payload)`` that carry packed arrays between tasks, and the hashing of their keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bits of a key's hash kept beside those that name its part.
KEY_BITS = 40

PAYLOAD = "part long, block long, payload binary"
PAYLOAD_SCHEMA = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("payload", pa.binary())])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(keys: np.ndarray, owner: np.ndarray) -> bytes:
    """Sorted keys as first key and differences, byte plane by byte plane so that high bytes compress away."""
    steps = np.diff(keys, prepend=keys[:1]) if len(keys) else keys
    width = 4 if not len(steps) or steps.max() < 1 << 32 else 8
    planes = steps.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    head = np.array([len(keys), width, keys[0] if len(keys) else 0], np.uint64)
    return head.tobytes() + np.ascontiguousarray(planes).tobytes() + owner.astype("<u2").tobytes()


def unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, width, first = (int(x) for x in np.frombuffer(payload, np.uint64, 3))
    planes = np.frombuffer(payload, np.uint8, n * width, 24).reshape(width, n)
    steps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)
    return np.cumsum(steps) + np.uint64(first), np.frombuffer(payload, "<u2", n, 24 + n * width)
