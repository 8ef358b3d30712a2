"""Runs of bytes of a class in whole texts, found some documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Text bytes that are cut at a time.
SLICE_BYTES = 1 << 20
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Slice(NamedTuple):
    """Bytes of the documents ``first`` on; document i of the slice lies between offsets i and i + 1."""

    first: int
    text: np.ndarray
    offsets: np.ndarray


def slices(texts: pa.Array, cut: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A binary column as slices of some ``limit`` bytes.

    A longer document comes in several slices of its own, each cut behind a
    byte of the class ``cut``; only a stretch without such a byte is longer.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        begin, end = int(offsets[row]), int(offsets[stop])
        while end - begin > limit:
            reach = begin + limit
            back = np.flatnonzero(cut[whole[begin:reach]])
            if len(back):
                reach = begin + int(back[-1]) + 1
            else:
                while reach < end and not cut[whole[reach - 1]]:
                    ahead = np.flatnonzero(cut[whole[reach : min(reach + limit, end)]])
                    reach = reach + int(ahead[0]) + 1 if len(ahead) else min(reach + limit, end)
            yield Slice(row, whole[begin:reach], np.array([0, reach - begin]))
            begin = reach
        if stop == row + 1:
            yield Slice(row, whole[begin:end], np.array([0, end - begin]))
        else:
            yield Slice(row, whole[begin:end], offsets[row : stop + 1] - begin)
        row = stop


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of members; none goes beyond its document."""
    if not len(member):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.zeros(len(member) + 1, bool)
    edge[offsets] = True
    starts = member & (np.r_[True, ~member[:-1]] | edge[:-1])
    ends = member & (np.r_[~member[1:], True] | edge[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (as many as lengths[0]), first[1], and so on."""
    return np.arange(int(lengths.sum())) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
