"""Ids of text units remembered by a worker, and rows put together from them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from offerledger.llm import kernel


class Memory:
    """Ids of units by hash: sorted arrays, with a small recent part that joins the rest when it has grown."""

    def __init__(self):
        self.parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def __len__(self) -> int:
        return sum(len(h) for h, _, _ in self.parts)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin (-1: not known) and number of the ids of each hash."""
        begin, size = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for known, at, n in self.parts:
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                same = known[place] == hashes
                begin[same], size[same] = at[place[same]], n[place[same]]
        return begin, size

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.int32)])
        self.flat[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        rest, recent = self.parts
        recent = self._joined(recent, (hashes, begin, sizes))
        if len(recent[0]) > 20_000 + len(rest[0]) // 8:
            rest, recent = self._joined(rest, recent), tuple(x[:0] for x in recent)
        self.parts = [rest, recent]

    @staticmethod
    def _joined(a: tuple, b: tuple) -> tuple:
        both = [np.concatenate(x) for x in zip(a, b, strict=True)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)


def rows_of_units(memory: Memory, data: np.ndarray, starts: np.ndarray, offsets: np.ndarray, ask: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Ids of each row whose units begin at starts; ask encodes the units that aren't remembered yet."""
    distinct, first, unit = np.unique(kernel.segment_hashes(data, starts), return_index=True, return_inverse=True)
    begin, size = memory.find(distinct)
    if len(new := np.flatnonzero(begin < 0)):
        ends = np.r_[starts[1:], len(data)]
        memory.add(distinct[new], *ask([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]))
        begin, size = memory.find(distinct)
    sizes = size[unit]
    total = np.r_[0, np.cumsum(sizes)]
    flat = memory.flat[np.repeat(begin[unit] - total[:-1], sizes) + np.arange(total[-1])]
    cut = total[np.searchsorted(starts, offsets)]
    return [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
