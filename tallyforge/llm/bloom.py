"""Bloom filters of bounded size, so that rows wanted by a later equi-join can be picked out of a scan of the text
without shuffling the text.  A false positive costs a row, never a result."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.kernels import U, mix

BITS = 1 << 26


def places(size: int, *columns: np.ndarray) -> np.ndarray:
    h = np.zeros(len(columns[0]), U)
    for c in columns:
        h = mix(h + c.astype(np.int64).view(U))
    return (h % U(size)).astype(np.int64)


class Bloom:
    """One hash and 16 bits for each row of integer columns, BITS at most; the bits travel as a broadcast."""

    def __init__(self, wanted: DataFrame):
        self.size = size = min(BITS, 1 << max(10, math.ceil(math.log2(16 * wanted.count() + 1))))

        def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.unique(places(size, *(c.to_numpy(zero_copy_only=False) for c in b.columns)))
                word = at >> 6
                edge = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(at) else at
                bits = np.bitwise_or.reduceat(U(1) << (at & 63).astype(U), edge).view(np.int64) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(word[edge]), pa.array(bits)], ["word", "bits"])

        words = wanted.mapInArrow(bits_of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        bits = np.zeros(size // 64 + 1, np.int64)
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.bits = wanted.sparkSession.sparkContext.broadcast(bits)

    def has(self, *columns: np.ndarray) -> np.ndarray:
        """Which rows may be wanted; for use in Python tasks."""
        at = places(self.size, *columns)
        return (self.bits.value[at >> 6] >> (at & 63)) & 1 == 1

    def filter(self, batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(self.has(b.column(column).to_numpy(zero_copy_only=False))))
