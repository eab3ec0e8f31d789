"""A minimal perfect hash over 64-bit keys, in numpy.

Level by level, keys hash into a bit array a little larger than their number; a key that is
alone on its bit stays, the others go to the next level. A key's index is the number of set
bits before its own, over all levels. Keys left after the last level (only equal ones, in
practice) are numbered at the end and found by comparison.
"""

from __future__ import annotations

import io

import numpy as np

GROWTH, LEVELS = 1.5, 32


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well spread 64-bit values (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(((seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.starts = np.cumsum(sizes) - sizes
        flat = np.unpackbits(bits)[: int(sizes.sum())]
        self.set = flat.astype(bool)
        self.before = np.cumsum(flat, dtype=np.int32) - flat
        self.placed = int(flat.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        for level in range(LEVELS):
            if not len(keys):
                break
            size = int(len(keys) * GROWTH) + 1
            at = (mix(keys, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        bits = np.packbits(np.concatenate(levels)) if levels else np.zeros(0, np.uint8)
        return cls(np.array(sizes, np.int64), bits, keys)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; -1 for some keys that are not in the set, any for others."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist())):
            if not len(todo):
                return out
            at = start + (mix(keys[todo], level) % np.uint64(size)).astype(np.int64)
            hit = self.set[at]
            out[todo[hit]] = self.before[at[hit]]
            todo = todo[~hit]
        return out

    def order(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key of the set itself; equal keys get different ones."""
        out = self.index(keys)
        rest = out < 0
        out[rest] = self.placed + np.arange(int(rest.sum()))
        return out

    def dump(self, **arrays: np.ndarray) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, sizes=self.sizes, bits=self.bits, rest=self.rest, **arrays)
        return buffer.getvalue()

    @classmethod
    def load(cls, data: bytes) -> tuple[PerfectHash, dict[str, np.ndarray]]:
        with np.load(io.BytesIO(data)) as found:
            arrays = {name: found[name] for name in found.files}
        return cls(arrays.pop("sizes"), arrays.pop("bits"), arrays.pop("rest")), arrays
