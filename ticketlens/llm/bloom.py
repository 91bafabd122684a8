"""A Bloom filter of bounded size over 64-bit hashes, built in Spark and tested in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm import textutil as tu

MOST_BITS = 1 << 27
_U = np.uint64


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [tu.mix(h + _U(k)) & _U(bits - 1) for k in range(3)]


def build(hashes: DataFrame) -> bytes:
    """The filter of the one long column, of 16 bits a value and at most ``MOST_BITS``, whatever
    their number. Tasks' bits are combined in Spark, so the driver gets each 64-bit word once."""
    column = hashes.columns[0]
    n = hashes.agg(F.approx_count_distinct(column)).first()[0]
    bits = 1 << 12
    while bits < min(16 * n, MOST_BITS):
        bits *= 2

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_places(b[column].to_numpy().view(_U), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> _U(6)).astype(np.int64)),
                                              pa.array((_U(1) << (at & _U(63))).view(np.int64))], ["word", "bit"])

    words = hashes.mapInArrow(set_bits, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    words = words.toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.tobytes()


def may_hold(bloom: bytes, h: np.ndarray) -> np.ndarray:
    """False where a hash is certainly not in the filter."""
    words = np.frombuffer(bloom, _U)
    out = np.ones(len(h), bool)
    for place in _places(h, len(words) * 64):
        out &= ((words[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1)).astype(bool)
    return out
