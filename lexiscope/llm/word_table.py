"""A bounded table of words with what an encoder made of each, for texts as arrays of entries.

A table lives as long as a Python worker. It has two generations: when the younger is full it takes
the older's place, and words that come up again are copied, so words in use are never made twice.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bits of an entry that hold the number of ids; that many ones stand for a word that only whole texts can encode.
SIZE_BITS = 20
ODD = (1 << SIZE_BITS) - 1


class WordTable:
    """``learn(words)`` gives all their ids in a row and each word's number of ids, -1 for a word that only whole texts can encode."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kind: str, limit: int = 400_000):
        self.learn, self.kind, self.limit = learn, np.dtype(kind), limit
        self.entries: dict[str, int] = {}
        self.ids = array(kind)
        self.old: tuple[dict[str, int], np.ndarray] = {}, self.pool()

    def pool(self) -> np.ndarray:
        """All ids as a view, which must be gone before the next look_up."""
        return np.frombuffer(self.ids, self.kind) if len(self.ids) else np.zeros(0, self.kind)

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(places in the pool, numbers of ids or -1) of words, good until the next call."""
        if len(self.entries) > self.limit or len(self.ids) > 24 * self.limit:
            self.old = self.entries, self.pool()
            self.entries, self.ids = {}, array(self.ids.typecode)
        entries = np.fromiter(map(self.entries.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(entries < 0).tolist()
        if new := {words[k] for k in missing}:
            if kept := new.intersection(self.old[0]):
                some = list(kept)
                starts, sizes = _unpacked(np.fromiter(map(self.old[0].__getitem__, some), np.int64, len(some)))
                self._add(some, self.old[1][spread(starts, np.maximum(sizes, 0))], sizes)
            if some := list(new - kept):
                self._add(some, *self.learn(some))
            entries[missing] = [self.entries[words[k]] for k in missing]
        return _unpacked(entries)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.ids) + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        self.ids.frombytes(ids.astype(self.kind).tobytes())
        self.entries.update(zip(words, (starts << SIZE_BITS | np.where((sizes < 0) | (sizes >= ODD), ODD, sizes)).tolist(), strict=True))


def _unpacked(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = entries & ODD
    sizes[sizes == ODD] = -1
    return entries >> SIZE_BITS, sizes


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each size, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about so many bytes; a row stays whole."""
    at, lengths = 0, pc.fill_null(pc.binary_length(batch[column]), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
