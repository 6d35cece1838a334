"""A bit map over the hashes of keys, by which tasks leave out rows that no key asks for."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The map has sixteen bits a key, within these bounds (at most 32 MB).
MAP_BITS = (1 << 18, 1 << 28)


class KeyMap:
    """A bit map of keys: says no only of keys that aren't in it."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @classmethod
    def of(cls, keys: DataFrame, name: str = "h") -> KeyMap:
        """Of a column of longs; the map alone, whose size is bounded, comes to the driver."""
        least, most = MAP_BITS
        size = least
        while size < min(most, 16 * keys.count()):
            size *= 2
        place = F.col(name).bitwiseAND(size - 1) + 1
        parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        bits = np.zeros(size // 8, np.uint8)
        for r in parts.toLocalIterator():
            held = np.frombuffer(bytes(r["bits"]), np.uint8)
            at = (r["part"] - 1) * len(held)
            bits[at : at + len(held)] = held[: len(bits) - at]
        return cls(bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys.view(np.uint64) & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
