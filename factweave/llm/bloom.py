"""A blocked Bloom filter: a cheap first look before an exact hash join."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix

PROBES = 8
#: Bits a key, and the bounds of a filter's size (2 MB at most go to each executor for 2**24 bits; the ceiling is 32 MB).
BITS_A_KEY, LEAST_BITS, MOST_BITS = 12, 1 << 16, 1 << 28
#: Parts of a filter that are filled apart, each by the keys of its own blocks.
PARTS = 64


class BlockedBloom:
    """A Bloom filter whose probes of one key stay in one block of 512 bits; its size never grows."""

    def __init__(self, bits: int, probes: int = PROBES):
        self.words, self.probes = np.zeros(max(8, bits // 64 // 8 * 8), np.uint64), probes

    def blocks(self, h: np.ndarray) -> np.ndarray:
        return (mix(h.astype(np.int64).view(np.uint64)) >> np.uint64(32)) % np.uint64(len(self.words) // 8)

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block = self.blocks(h)
        h = mix(h.astype(np.int64).view(np.uint64))
        step, at = (h & np.uint64(0xFFFF)) | np.uint64(1), (h >> np.uint64(16)) & np.uint64(0xFFFF)
        bit = (at[:, None] + step[:, None] * np.arange(self.probes, dtype=np.uint64)) & np.uint64(511)
        return block[:, None] * np.uint64(8) + (bit >> np.uint64(6)), np.uint64(1) << (bit & np.uint64(63))

    def add(self, hashes: np.ndarray) -> None:
        where, what = self._places(hashes)
        np.bitwise_or.at(self.words, where, what)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        where, what = self._places(hashes)
        return ((self.words[where] & what) == what).all(axis=1)


def shared_bloom(hashes: DataFrame, bits: int | None = None):
    """Broadcast filter of a column of 64-bit hashes, sized by their number up to a ceiling.

    Hashes are dealt by their block, so each task fills parts of the filter that no other task touches, and the driver
    gets the filter's size once, however many hashes and tasks there are.
    """
    name = hashes.columns[0]
    keys = hashes.where(F.col(name).isNotNull()).distinct()
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * keys.count()).bit_length()))
    size = -(-len(BlockedBloom(bits).words) // 8 // PARTS) * 8  # words of a part: whole blocks

    def deal(batches):
        empty = BlockedBloom(bits)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array((empty.blocks(h) * np.uint64(8) // np.uint64(size)).astype(np.int32)), pa.array(h)], ["part", "h"])

    def fill(batches):
        bloom, touched = BlockedBloom(bits), set()
        for b in batches:
            touched.update(b.column(0).to_pylist())
            bloom.add(b.column(1).to_numpy(zero_copy_only=False))
        if touched:
            at = sorted(touched)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([bloom.words[k * size : (k + 1) * size].tobytes() for k in at], pa.binary())], ["part", "words"])

    bloom = BlockedBloom(bits)
    dealt = keys.mapInArrow(deal, "part int, h long").repartition(PARTS, "part")
    for r in dealt.mapInArrow(fill, "part int, words binary").collect():  # the size of the filter
        words = np.frombuffer(bytes(r["words"]), np.uint64)
        bloom.words[r["part"] * size : r["part"] * size + len(words)] |= words
    return hashes.sparkSession.sparkContext.broadcast(bloom)


def passes(held):
    """A column function: does the filter let a hash pass?"""

    @F.pandas_udf(T.BooleanType())
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(held.value.has(h.to_numpy()))

    return maybe
