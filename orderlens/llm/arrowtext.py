"""Helpers for tasks that read texts as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task expands into numpy arrays at a time (a longer text is one slice).
SLICE_BYTES = 1 << 20


def documents(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` as string (null: empty), then ``more`` columns as they
    are; whatever else the frame holds is left behind, so its names can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column back to back, and where each value starts (n + 1 numbers)."""
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xor, shift, multiply)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Hashes of any stretches of a byte array: sums of random numbers per byte value times
    powers of an odd base, modulo 2**64, mixed at the end. ``seed`` picks the random numbers."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**61, 2**63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self._powers = {}

    def powers(self, base: int, n: int) -> np.ndarray:
        have = self._powers.get(base)
        if have is None or len(have) < n:
            have = np.ones(1, np.uint64)
            while len(have) < n:
                step = np.uint64(pow(base, len(have), 2**64))
                have = np.concatenate([have, have * step])
            if len(have) <= 1 << 23:
                self._powers[base] = have
        return have[:n]

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers(self.base, len(data)), out=sums[1:])
        return sums

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end); the same bytes give the same hash wherever they stand."""
        back = self.powers(self.inverse, len(prefix))
        return mix((prefix[end] - prefix[start]) * back[start]
                   + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
