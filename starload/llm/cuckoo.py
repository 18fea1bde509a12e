"""Cuckoo filters over 128-bit keys, as arrays: sets that allow deletions.

A key, two unsigned 64-bit words, has a 16-bit tag and two buckets of four slots; either
bucket follows from the other and the tag. A filter never misses a key that it holds and
answers yes by mistake for about one other key in eight thousand.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
_KICKS = 500
_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd 64-bit constant of multiplicative hashing


class Full(Exception):
    """No place was found for a key; build a larger filter."""


def tags(hi: np.ndarray) -> np.ndarray:
    """Tags from the upper word's top bits; zero marks an empty slot, so it becomes one."""
    return np.maximum(hi >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def _jump(tag: np.ndarray, mask: np.ndarray | np.uint64) -> np.ndarray:
    return (((tag.astype(np.uint64) * _SPREAD) >> np.uint64(20)) | np.uint64(1)) & mask


def empty(keys: int) -> np.ndarray:
    """A filter, a (buckets, SLOTS) array, with room for so many keys."""
    buckets = 2
    while buckets * SLOTS * 0.85 < keys:
        buckets *= 2
    return np.zeros((buckets, SLOTS), np.uint16)


def insert(slots: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> None:
    mask = np.uint64(len(slots) - 1)
    tag = tags(hi)
    first = (lo & mask).astype(np.int64)
    jump = _jump(tag, mask).astype(np.int64)
    turn = 0
    for t, i, j in zip(tag.tolist(), first.tolist(), jump.tolist(), strict=True):
        for _ in range(_KICKS):
            for bucket in (i, i ^ j):
                free = np.flatnonzero(slots[bucket] == 0)
                if len(free):
                    slots[bucket, free[0]] = t
                    break
            else:
                turn += 1
                i, victim = i ^ j, turn % SLOTS
                t, slots[i, victim] = int(slots[i, victim]), t
                j = int(_jump(np.array([t], np.uint16), mask)[0])
                continue
            break
        else:
            raise Full


def delete(slots: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> None:
    """Take out keys that are in the filter."""
    mask = np.uint64(len(slots) - 1)
    tag = tags(hi)
    first = (lo & mask).astype(np.int64)
    jump = _jump(tag, mask).astype(np.int64)
    for t, i, j in zip(tag.tolist(), first.tolist(), jump.tolist(), strict=True):
        for bucket in (i, i ^ j):
            held = np.flatnonzero(slots[bucket] == t)
            if len(held):
                slots[bucket, held[0]] = 0
                break
        else:
            raise KeyError("a key to delete is not in the filter")


def build(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    slots = empty(len(hi))
    while True:
        try:
            insert(slots, hi, lo)
            return slots
        except Full:
            slots = np.zeros((2 * len(slots), SLOTS), np.uint16)


class Shards:
    """Filters of many shards side by side, asked for many keys at once."""

    def __init__(self, filters: dict[int, np.ndarray], shards: int):
        none = np.zeros((1, SLOTS), np.uint16)
        parts = [filters.get(s, none) for s in range(shards)]
        sizes = np.array([len(p) for p in parts])
        self.shards = shards
        self.slots = np.concatenate(parts)
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.mask = (sizes - 1).astype(np.uint64)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        shard = shard_of(hi, self.shards)
        mask, start, tag = self.mask[shard], self.start[shard], tags(hi)
        first = lo & mask
        second = first ^ _jump(tag, mask)
        wanted = tag[:, None]
        return (self.slots[start + first.astype(np.int64)] == wanted).any(axis=1) | (
            self.slots[start + second.astype(np.int64)] == wanted
        ).any(axis=1)


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a key, from bits that neither tag nor bucket use."""
    return ((hi & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int64)
