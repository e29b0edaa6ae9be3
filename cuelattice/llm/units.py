"""Texts as sequences of units that are encoded apart, each distinct unit once.

A block of texts is one byte array. Where two adjacent bytes may stand inside one
unit, a table of 65,536 byte pairs says so; everywhere else there is a cut. Units are
then slices of the block, told apart by Arrow's dictionary encoding, so Python sees
each distinct unit of a block once, and ids are gathered by position.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .common import by_bytes

#: Bytes of text that are worked on at once; a longer text is a block of its own.
BLOCK = 4_000_000


def blocks(texts: list[bytes], lead: bytes, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, data, ends): texts lo to hi in one array, `lead` before each that is
    not empty, and where each ends."""
    for lo, hi in by_bytes(texts, limit):
        some = [lead + t if t else b"" for t in texts[lo:hi]]
        yield lo, hi, np.frombuffer(b"".join(some), np.uint8), np.cumsum([len(t) for t in some], dtype=np.int64)


def cut(data: np.ndarray, ends: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the units (one more than units), and per text the number of units
    up to its end. apart: for each pair of bytes (256 * first + second) whether a
    unit ends between them."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(ends), np.int64)
    new = np.empty(len(data), bool)
    new[0] = True
    pair = data[:-1].astype(np.uint16)
    pair <<= 8
    pair |= data[1:]
    np.take(apart, pair, out=new[1:])
    new[ends[ends < len(data)]] = True
    at = np.r_[np.flatnonzero(new), len(data)]
    return at, np.searchsorted(at, ends)


class UnitTable:
    """Ids of the units met so far, kept between blocks and tasks.

    learn(units) gives the number of ids of each unit and all ids in a row. Once
    more than `limit` units are held, those met in one block only go."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int, dtype):
        self.learn, self.limit, self.dtype = learn, limit, dtype
        self._clear()

    def _clear(self):
        self.at: dict[bytes, int] = {}
        self.size, self.first, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, self.dtype)

    def _shrink(self) -> None:
        keep = np.flatnonzero(self.met > 1)
        if len(keep) > self.limit // 2:
            keep = keep[np.argsort(-self.met[keep], kind="stable")[: self.limit // 2]]
        units, ids, size = list(self.at), gather(self.ids, self.first[keep], self.size[keep]), self.size[keep]
        self.at = {units[i]: k for k, i in enumerate(keep.tolist())}
        self.ids, self.size, self.first, self.met = ids, size, np.cumsum(size) - size, self.met[keep] // 2

    def rows(self, units: list[bytes]) -> np.ndarray:
        """Position of each of the distinct units."""
        if len(self.at) > self.limit:
            self._shrink()
        get = self.at.get
        at = np.array([get(u, -1) for u in units], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [units[i] for i in new.tolist()]
            size, ids = self.learn(fresh)
            at[new] = np.arange(len(self.at), len(self.at) + len(new))
            self.at.update(zip(fresh, at[new].tolist(), strict=True))
            self.first = np.r_[self.first, len(self.ids) + np.cumsum(size) - size]
            self.size, self.ids, self.met = np.r_[self.size, size], np.concatenate([self.ids, ids]), np.r_[self.met, np.zeros(len(new), np.int32)]
        self.met[at] += 1
        return at

    def encode(self, data: np.ndarray, at: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block in a row, and per text the number of ids up to its end."""
        if len(at) < 2:
            return np.zeros(0, self.dtype), np.zeros(len(upto), np.int64)
        kind, offs = (pa.binary(), at.astype(np.int32)) if at[-1] < 2**31 else (pa.large_binary(), at)
        found = pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(offs), pa.py_buffer(data)]).dictionary_encode()
        row = self.rows(found.dictionary.to_pylist())[found.indices.to_numpy()]
        size = self.size[row]
        return gather(self.ids, self.first[row], size), np.r_[0, np.cumsum(size)][upto]


def gather(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[first[k] : first[k] + size[k]] of all k, in a row."""
    end = np.cumsum(size)
    return values[np.arange(end[-1] if len(end) else 0) + np.repeat(first - end + size, size)]
