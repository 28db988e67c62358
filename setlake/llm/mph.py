"""A minimal perfect hash of 64-bit keys, built shard by shard and looked up many keys at once.

Each shard is a stack of bit arrays of twice as many bits as keys are left. A key that has a position of an array to itself sets its
bit there; keys that meet move on to the next array. The slot of a key is the number of bits set before its own, over the arrays of all shards
laid end to end, so n keys have the slots 0 to n - 1. Keys are stored by slot, and every lookup compares: a key that isn't in has no slot, so
answers are exact whatever the hashes do.
"""

from __future__ import annotations

import numpy as np

#: Bits of an array for each key that is left.
SPACE = 2
_GOLD = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Unsigned 64-bit hashes of unsigned 64-bit keys."""
    x = keys + np.uint64((seed + 1) * _GOLD & (1 << 64) - 1)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(by)
    return x ^ x >> np.uint64(31)


def spread(keys: np.ndarray) -> np.ndarray:
    """31 bits of hash by which keys are dealt to rounds and shards."""
    return (mixed(keys, 63) >> np.uint64(33)).astype(np.int64)


def build(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The arrays of a shard of distinct keys: words of bits, and the keys that set them in order."""
    levels = []
    while len(keys):
        size = -(-SPACE * len(keys) // 64) * 64
        at = (mixed(keys, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        held = alone[at]
        order = np.argsort(at[held])
        levels.append((np.packbits(alone, bitorder="little").view(np.uint64), keys[held][order]))
        keys = keys[~held]
    return levels


class PerfectHash:
    """Shards (by number; absent ones are empty) as one table of slots. ``rounds``: only keys whose spread leaves ``own`` when divided by it are in."""

    def __init__(self, shards: dict[int, list[tuple[np.ndarray, np.ndarray]]], n_shards: int, rounds: int = 1, own: int = 0) -> None:
        self.n_shards, self.rounds, self.own = n_shards, rounds, own
        self.levels, stored, base = [], [np.zeros(0, np.uint64)], 0
        for j in range(max(map(len, shards.values()), default=0)):
            parts = [shards[s][j] if s in shards and j < len(shards[s]) else (np.zeros(0, np.uint64), np.zeros(0, np.uint64)) for s in range(n_shards)]
            sizes = np.array([64 * len(w) for w, _ in parts], np.uint64)
            words = np.concatenate([w for w, _ in parts])
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((sizes, np.cumsum(sizes) - sizes, words, base + np.cumsum(ones) - ones))
            stored += [k for _, k in parts]
            base += int(ones.sum())
        self.keys = np.concatenate(stored)

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it isn't in."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        dealt = spread(keys)
        left = np.flatnonzero(dealt % self.rounds == self.own)
        shard = dealt[left] // self.rounds % self.n_shards
        for j, (sizes, starts, words, ranks) in enumerate(self.levels):
            size = sizes[shard]
            some = size > 0
            if not some.all():
                left, shard, size = left[some], shard[some], size[some]
            at = starts[shard] + mixed(keys[left], j) % size
            word, bit = words[at >> np.uint64(6)], at & np.uint64(63)
            on = (word >> bit & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            hit = left[on]
            slot = ranks[at[on] >> np.uint64(6)] + np.bitwise_count(below[on])
            same = self.keys[slot] == keys[hit]
            out[hit[same]] = slot[same]
            left, shard = left[~on], shard[~on]
            if not len(left):
                break
        return out
