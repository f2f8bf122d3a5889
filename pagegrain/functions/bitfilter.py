"""A bit filter over 64-bit keys, to drop rows early that can't join.

Its size follows from a count of the keys, 16 bits or more for each, between 128 kB and 64 MB; a key sets three of them. Of
the rows that match none it lets 0.5 % pass, at 10**8 keys 8 %. Beyond that it drops less but loses nothing: what passes
must still be joined with the keys themselves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .textvec import mix64

LEAST, MOST = 20, 29  # logarithms of the number of bits
PARTS = 8
_U = np.uint64


def _slots(keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    h, mask = mix64(keys), _U(size - 1)
    for x in (h, h >> _U(64 - MOST), (h * _U(0x9E3779B97F4A7C15)) >> _U(64 - MOST)):
        yield (x & mask).astype(np.int64)


def bits_for(n: int) -> int:
    """How many bits the filter of ``n`` keys has."""
    return 1 << min(MOST, max(LEAST, (16 * max(n, 1) - 1).bit_length()))


def build(df: DataFrame, column: str) -> np.ndarray:
    """The filter of the bigint keys in ``column``; nulls must be gone. Partitions are or-ed piece by piece before one copy reaches the driver."""
    size = bits_for(df.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, np.bool_)
        for b in batches:
            for at in _slots(b.column(0).to_numpy().view(_U), size):
                bits[at] = True
        out = [zlib.compress(np.packbits(p).tobytes(), 1) for p in np.split(bits, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(out, pa.binary())], ["part", "bits"])

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size // PARTS // 8, np.uint8)
        for b in pdf["bits"]:
            total |= np.frombuffer(zlib.decompress(b), np.uint8)
        return pd.DataFrame({"part": [key[0]], "bits": [zlib.compress(total.tobytes(), 1)]})

    got = df.select(column).mapInArrow(run, "part int, bits binary").groupBy("part").applyInPandas(add, "part int, bits binary").collect()  # PARTS rows
    by = {r["part"]: np.frombuffer(zlib.decompress(bytes(r["bits"])), np.uint8) for r in got}
    return np.concatenate([by.get(i, np.zeros(size // PARTS // 8, np.uint8)) for i in range(PARTS)])


def probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (any shape) may be in the filter."""
    out = np.ones(keys.shape, np.bool_)
    for s in _slots(keys, 8 * len(bits)):
        out &= ((bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1).astype(np.bool_)
    return out
