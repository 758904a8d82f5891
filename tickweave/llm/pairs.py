"""Hashed lookup of adjacent symbol pairs, for the byte-pair operators."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> (rank, merged id), open addressing over numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self._rank = np.full(1 << bits, NONE, np.int32)
        self._merged = np.zeros(1 << bits, np.int32)
        self._of = None
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self._keys[slot] == np.uint64(2**64 - 1)
            at, first = np.unique(slot[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            which = todo[placed]
            self._keys[at], self._rank[at], self._merged[at] = keys[which], rank[which], merged[which]
            left_over = np.ones(len(todo), bool)
            left_over[placed] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (NONE where the pair doesn't merge) and merged ids."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        there = self._keys[slot]
        off = np.flatnonzero((there != keys) & (there != np.uint64(2**64 - 1)))
        while len(off):
            slot[off] = (slot[off] + 1) & self._mask
            there = self._keys[slot[off]]
            off = off[(there != keys[off]) & (there != np.uint64(2**64 - 1))]
        hit = self._keys[slot] == keys
        return np.where(hit, self._rank[slot], NONE), self._merged[slot]


    def pair(self, left: int, right: int) -> tuple[int, int] | None:
        """(rank, merged id) of one pair. The dictionary is made when a long sequence first
        needs it; numpy calls for one pair cost twenty times as much."""
        if self._of is None:
            at = np.flatnonzero(self._rank != NONE)
            self._of = dict(zip(self._keys[at].tolist(), zip(self._rank[at].tolist(), self._merged[at].tolist(), strict=True), strict=True))
        return self._of.get(left << 32 | right)


def merge_one(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """One long sequence: the leftmost lowest-rank pair merges each round. A heap gives pairs
    by (rank, place); places keep their order, so the neighbours are links, and an entry
    counts only while its pair still stands as it was entered."""
    n = len(ids)
    if n < 2:
        return ids.astype(np.int32)
    rank, merged = table.find(ids[:-1], ids[1:])
    there = np.flatnonzero(rank != NONE)
    heap = (rank[there].astype(np.int64) << 32 | there).tolist()
    heapq.heapify(heap)
    into = dict(zip(there.tolist(), merged[there].tolist(), strict=True))  # place of a pair: what it merges to
    at = np.full(n, -1, np.int64)
    at[there] = rank[there]
    standing, sym = at.tolist(), ids.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    found, pop, push = table.pair, heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        if standing[i] != entry >> 32:
            continue
        j = after[i]
        sym[i] = into[i]
        sym[j] = standing[j] = -1
        k = after[i] = after[j]
        standing[i] = -1
        if k < n:
            before[k] = i
            hit = found(sym[i], sym[k])
            if hit:
                standing[i], into[i] = hit
                push(heap, hit[0] << 32 | i)
        b = before[i]
        if b >= 0:
            hit = found(sym[b], sym[i])
            if hit:
                standing[b], into[b] = hit
                push(heap, hit[0] << 32 | b)
            else:
                standing[b] = -1
    left = np.array(sym, np.int32)
    return left[left >= 0]
