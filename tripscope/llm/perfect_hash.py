"""Minimal perfect hashing of distinct 64-bit keys, in shards.

A shard's keys are thrown into a bit array twice their number; whoever is alone at
a place has its bit set, the others go on to the next, smaller array.  The number of
set bits before a key's bit is its place, 0 to n - 1: about 3.5 bits a key.  Strangers
hit bits too, so the keys are kept in order of their places and compared.

Shards are chosen by a hash of distinct keys, so they are alike in size whatever the
data; shards in a row make one array of bits, keys and counts (``Places``).
"""

from __future__ import annotations

import numpy as np

#: Keys of a shard, on average; bytes a key takes in ``Places``, counts included.
SHARD_KEYS, KEY_BYTES = 1 << 16, 20
MAX_LEVELS = 64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash (xor-shift-multiply rounds) of unsigned 64-bit keys."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shard_hash(keys: np.ndarray) -> np.ndarray:
    """What decides the shard, as a non-negative signed number."""
    return (mixed(keys, 0) >> np.uint64(1)).astype(np.int64)


def built(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits of each level, the levels' bits as 64-bit words, the keys by place)
    of distinct keys."""
    left, sizes, words, placed, at, start = keys.astype(np.uint64), [], [], [], [], 0
    while len(left):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("keys are not distinct")
        size = 64 * -(-2 * len(left) // 64)
        place = (mixed(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size)[place] == 1
        bits = np.zeros(size, np.uint8)
        bits[place[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        sizes.append(size)
        placed.append(left[alone])
        at.append(start + place[alone])
        left, start = left[~alone], start + size
    if not sizes:
        return [], np.zeros(0, "<u8"), keys[:0]
    return sizes, np.concatenate(words), np.concatenate(placed)[np.argsort(np.concatenate(at))].astype(keys.dtype)


class Places:
    """Shards ``first``, ``first`` + 1, ... of ``shards``, to look keys up in."""

    def __init__(self, shards: int, first: int, parts: list[tuple[list[int], np.ndarray, np.ndarray]]):
        self.shards, self.first = shards, first
        self.size = np.zeros((len(parts), max([len(p[0]) for p in parts], default=0)), np.int64)
        for i, (sizes, _, _) in enumerate(parts):
            self.size[i, : len(sizes)] = sizes
        flat = self.size.ravel()
        self.start = (np.cumsum(flat) - flat).reshape(self.size.shape)
        self.words = np.concatenate([p[1] for p in parts]).astype(np.uint64) if parts else np.zeros(0, np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.keys = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.uint64)
        self.ends = np.cumsum([len(p[2]) for p in parts], dtype=np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for keys that are not here."""
        out = np.full(len(keys), -1, np.int64)
        shard = shard_hash(keys) % self.shards - self.first
        todo = np.flatnonzero((shard >= 0) & (shard < len(self.size)))
        for level in range(self.size.shape[1]):
            size = self.size[shard[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            if not len(todo):
                break
            place = (mixed(keys[todo], level + 1) % size.astype(np.uint64)).astype(np.int64) + self.start[shard[todo], level]
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.before[place >> 6] + np.bitwise_count(below))[hit]
            todo = todo[~hit]
        found = out >= 0
        out[found] = np.where(self.keys[out[found]] == keys[found], out[found], -1)
        return out
