"""Bloom filters in blocks, of bounded size, built by Spark: a filter that lets too much through costs rows downstream, never an answer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a block; all probes of a hash fall into one.
BLOCK_BITS = 1 << 16
#: Bits for each entry, up to MOST_BLOCKS blocks (32 MB): beyond about 16 million entries more and more strangers pass.
BITS_EACH = 16
MOST_BLOCKS = 1 << 12


def _spots(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each hash's block, and four bits in it."""
    x = hashes * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    y = x * np.uint64(0xD1342543DE82EF95)
    y ^= y >> np.uint64(32)
    block = (hashes >> np.uint64(40)) & np.uint64(blocks - 1)
    return block.astype(np.int64), [((y >> np.uint64(16 * i)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64) for i in range(4)]


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` (uint64) may be in the filter; those that are in it always pass. ``table``: a row of bytes for each block."""
    block, bits = _spots(hashes, len(table))
    out = np.ones(len(hashes), bool)
    for b in bits:
        out &= (table[block, b >> 3] >> (b & 7).astype(np.uint8)) & 1 == 1
    return out


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """The filter of a table's one column of long hashes, a row of bytes for each block. Hashes go to their blocks in a shuffle; the driver gets the blocks."""
    n = hashes.count()
    blocks = 1
    while blocks * BLOCK_BITS < BITS_EACH * n and blocks < MOST_BLOCKS:
        blocks *= 2

    def fill(batches):
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bits = _spots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), blocks)
            for k in np.unique(block).tolist():
                table = mine.setdefault(k, np.zeros(BLOCK_BITS // 8, np.uint8))
                for b in bits:
                    at = b[block == k]
                    np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(mine), pa.int64()), pa.array([t.tobytes() for t in mine.values()], pa.binary())], names=["block", "bits"])

    name = hashes.columns[0]
    dealt = hashes.select(name).repartition(F.shiftright(name, 40).bitwiseAND(F.lit(blocks - 1)))
    out = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for r in dealt.mapInArrow(fill, "block long, bits binary").toLocalIterator():
        out[r.block] |= np.frombuffer(r.bits, np.uint8)
    return out
