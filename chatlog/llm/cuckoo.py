"""Cuckoo filters over 64-bit key hashes, one per shard, as flat arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np

SLOTS, KICKS, LOAD = 4, 200, 0.8


def _print_of(h: np.ndarray) -> np.ndarray:
    """16-bit fingerprint, never 0."""
    return np.maximum(h.view(np.uint64) >> np.uint64(48), 1).astype(np.uint16)


def _other(fp: np.ndarray) -> np.ndarray:
    """What leads from either bucket of a fingerprint to the other."""
    return (fp.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(0xFFFFFFFF)


class Shard:
    """A filter of one shard; keys that find no place go to an exact stash, with their number."""

    def __init__(self, slots: np.ndarray, stash: Iterable[int] = ()):
        self.slots, self.stash = slots, Counter(stash)  # slots: buckets x SLOTS, 0 is free

    @classmethod
    def sized(cls, keys: int) -> "Shard":
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @property
    def held(self) -> int:
        return int(np.count_nonzero(self.slots)) + self.stash.total()

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints, and both buckets of each."""
        fp, mask = _print_of(h), len(self.slots) - 1
        first = (h & 0xFFFFFFFFFFFF) & mask
        return fp, first, (first ^ _other(fp).astype(np.int64)) & mask

    def _fill(self, fp: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; true for those that are left over."""
        order = np.argsort(at, kind="stable")
        begun = np.r_[True, at[order][1:] != at[order][:-1]]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.arange(len(at)) - np.maximum.accumulate(np.where(begun, np.arange(len(at)), 0))
        taken = self.slots[at] != 0
        fits = rank < SLOTS - taken.sum(1)
        slot = np.argsort(taken, axis=1, kind="stable")[fits, rank[fits]]
        self.slots[at[fits], slot] = fp[fits]
        return ~fits

    def insert(self, keys: np.ndarray) -> None:
        """All of `keys`: in their first buckets, in their second ones, and the few left over by kicks."""
        h = np.ascontiguousarray(keys, np.int64)
        if not len(h):
            return
        fp, first, second = self._places(h)
        left = np.flatnonzero(self._fill(fp, first))
        if len(left):
            left = left[self._fill(fp[left], second[left])]
        for i in left:
            if not self._kick(int(fp[i]), int(first[i])):
                self.stash[int(h[i])] += 1

    def _kick(self, fp: int, at: int) -> bool:
        path = []
        for kick in range(KICKS):
            slot = kick % SLOTS
            path.append((at, slot))
            fp, self.slots[at, slot] = int(self.slots[at, slot]), fp
            at = (at ^ int(_other(np.array([fp], np.uint16))[0])) & (len(self.slots) - 1)
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = fp
                return True
        for at, slot in reversed(path):  # put everything back: a fingerprint has no key to stash
            fp, self.slots[at, slot] = int(self.slots[at, slot]), fp
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted before."""
        h = np.ascontiguousarray(keys, np.int64)
        for key, fp, *buckets in zip(h.tolist(), *(part.tolist() for part in self._places(h))):
            if self.stash[key]:
                self.stash[key] -= 1
                continue
            for at in buckets:
                there = np.flatnonzero(self.slots[at] == fp)
                if len(there):
                    self.slots[at, there[0]] = 0
                    break
        self.stash = +self.stash

    def contains(self, h: np.ndarray) -> np.ndarray:
        return Bank({0: self}).contains(np.zeros(len(h), np.int64), h)


class Bank:
    """Many shards side by side, for lookups of keys of any of them at once."""

    def __init__(self, shards: dict[int, Shard]):
        last = max(shards, default=-1) + 1
        self.begin, self.mask = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
        flat, at = [np.zeros((1, SLOTS), np.uint16)], 1  # bucket 0 serves shards that have no filter
        for number, shard in sorted(shards.items()):
            self.begin[number], self.mask[number] = at, len(shard.slots) - 1
            flat.append(shard.slots)
            at += len(shard.slots)
        self.slots = np.concatenate(flat)
        self.stash = np.sort(np.array([h for s in shards.values() for h in s.stash], np.int64))

    def contains(self, shard: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Whether each key may be in; never false for one that is."""
        shard = np.where(shard < len(self.begin), shard, len(self.begin) - 1)
        fp = _print_of(np.ascontiguousarray(h, np.int64))
        mask, begin = self.mask[shard], self.begin[shard]
        first = (h & 0xFFFFFFFFFFFF) & mask
        second = (first ^ _other(fp).astype(np.int64)) & mask
        found = (self.slots[begin + first] == fp[:, None]).any(1) | (self.slots[begin + second] == fp[:, None]).any(1)
        if len(self.stash):
            at = np.minimum(np.searchsorted(self.stash, h), len(self.stash) - 1)
            found |= self.stash[at] == h
        return found
