"""Minimal perfect hashing of distinct 64-bit keys, level by level."""

from __future__ import annotations

import numpy as np

from eventlake.llm.tables import xxhash64_of_longs

#: Places of a level for each key that is left; more places, fewer levels.
ROOM = 1.5
LEAST_PLACES = 64
LEVELS = 64


class PerfectHash:
    """Gives n known keys the slots 0 to n - 1, each its own, in about three bits a key.

    At each level a key is dealt a place; keys alone at theirs take it, the
    others go on to the next level. A slot is the rank of a taken place. Any
    other key gets some slot or none, so whoever looks up keeps the keys in slot
    order and compares.
    """

    def __init__(self, sizes: np.ndarray, taken: np.ndarray) -> None:
        self.sizes, self.taken = sizes, taken
        self._ranks = np.cumsum(taken) - 1

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of distinct keys; repeated ones are an error."""
        sizes, levels = [], []
        left = keys
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(LEAST_PLACES, int(ROOM * len(left)))
            place = _places(left, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[place]]
        return cls(np.array(sizes, np.int64), np.concatenate([*levels, np.zeros(0, bool)]))

    @classmethod
    def read(cls, sizes: bytes, taken: bytes) -> PerfectHash:
        """The hash that `sizes_bytes` and `taken_bytes` were written of."""
        own = np.frombuffer(sizes, np.int64)
        return cls(own, np.unpackbits(np.frombuffer(taken, np.uint8), count=int(own.sum())).astype(bool))

    @property
    def sizes_bytes(self) -> bytes:
        return self.sizes.tobytes()

    @property
    def taken_bytes(self) -> bytes:
        return np.packbits(self.taken).tobytes()

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for one that fits nowhere."""
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            place = start + _places(keys[left], level, size)
            hit = self.taken[place]
            out[left[hit]] = self._ranks[place[hit]]
            left, start = left[~hit], start + size
        return out


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (xxhash64_of_longs(keys, level) % np.uint64(size)).astype(np.int64)
