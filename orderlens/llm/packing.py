"""Packing documents into sequences of a fixed length, with a certified number of sequences.

Pieces are dealt out to buckets of bounded size and each bucket is packed by best fit decreasing.
Dual feasible functions give a lower bound for the bucket's number of sequences: a bucket that
meets it is done. Of a bucket with a gap, the full sequences stay, and the pieces of the others
are exchanged with the other such buckets and packed again.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources import materialize

from .arrowtext import documents, slices
from .encoders import encoder
from .token_planes import checksum

#: Pieces that one task packs at a time.
BUCKET_PIECES = 8192
#: A sequence's number: the round, the bucket, and its place among the bucket's sequences.
_TURN_BIT, _BIN_BITS = 59, 18
_PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
_PLACED = "doc_id long, row long, piece int, start long, length long, ids_crc32 long, " \
          "bin long, offset long, done boolean"


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int,
         capacity: int) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4")
    for part in slices(batches):
        out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32")}
        encoded = encode(part.column("text").to_pylist())
        for doc_id, row, raw in zip(part.column("doc_id").to_pylist(),
                                    part.column("row").to_pylist(), encoded):
            ids = np.concatenate([np.frombuffer(raw, "<u4"), end])
            for piece, start in enumerate(range(0, len(ids), capacity)):
                here = ids[start:start + capacity]
                for k, v in zip(out, (doc_id, row, piece, start, len(here), checksum(here))):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()),
             ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))


def document_pieces(docs: DataFrame, vocabulary: str, end_id: int,
                    capacity: int = 4096) -> DataFrame:
    """The pieces of every document: its ids and ``end_id``, cut after each ``capacity`` ids.

    Null and empty texts are their end id alone. ``row`` is a hash of the text, which tells
    apart rows that share a doc_id; equal rows give equal pieces.
    """
    rows = documents(docs).withColumn("row", F.xxhash64("text"))
    return rows.mapInArrow(lambda it: _cut(it, vocabulary, end_id, capacity), _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that the lengths need at least, by three families of dual feasible functions.

    A function u on 0..capacity is dual feasible if lengths that fit in one sequence never have
    u values above u(capacity) in total; then sum(u) / u(capacity) sequences are needed.
    """
    if len(lengths) == 0:
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)                 # u(x) = x
    for small in np.unique(sizes[sizes <= capacity // 2]):             # drop what is below small
        value = np.where(sizes > capacity - small, capacity, np.where(sizes < small, 0, sizes))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    for k in range(1, 20):                                             # rounding to k parts
        scaled = sizes * (k + 1)
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (capacity * k)))
    for part in range(2, 40):                                          # parts of a given size
        unit = capacity // part
        whole = capacity // unit
        value = np.where(2 * sizes > capacity, 2 * (whole - (capacity - sizes) // unit),
                         np.where(2 * sizes == capacity, whole, 2 * (sizes // unit)))
        best = max(best, -(-int((value * counts).sum()) // (2 * whole)))
    return best


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, for lengths in descending order."""
    open_bins: dict[int, list[int]] = {}   # by room left
    rooms: list[int] = []                  # ascending, those with an open bin
    bins, offsets, n = [], [], 0
    for length in lengths:
        k = bisect.bisect_left(rooms, length)
        if k == len(rooms):
            number, room, n = n, capacity, n + 1
        else:
            room = rooms[k]
            number = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[k]
        bins.append(number)
        offsets.append(capacity - room)
        left = room - length
        if left:
            if left not in open_bins:
                bisect.insort(rooms, left)
                open_bins[left] = []
            open_bins[left].append(number)
    return bins, offsets


def _pack(rows: pd.DataFrame, first_bin: int, capacity: int, last: bool) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "row", "piece"],
                            ascending=[False, True, True, True], ignore_index=True)
    bins, rows["offset"] = best_fit_decreasing(rows["length"].tolist(), capacity)
    rows["bin"] = np.array(bins, np.int64) + first_bin
    certified = len(set(bins)) == lower_bound(rows["length"].to_numpy(), capacity)
    filled = rows.groupby("bin")["length"].transform("sum")
    rows["done"] = last or certified
    if not rows["done"].all():
        rows["done"] = filled == capacity
    return rows[[c.split()[0] for c in _PLACED.split(", ")]]


def _packing(turn: int, capacity: int, last: bool):
    def work(key, rows: pd.DataFrame) -> pd.DataFrame:
        first = (turn + 1 << _TURN_BIT) + (int(key[0]) << _BIN_BITS)
        return _pack(rows.drop(columns="bucket"), first, capacity, last)
    return work


def pack(pieces: DataFrame, capacity: int = 4096, rounds: int = 4) -> DataFrame:
    """Places every piece: ``bin`` (the number of its sequence) and ``offset`` in it.

    Buckets hold :data:`BUCKET_PIECES` pieces on average, whatever the number of pieces, and are
    drawn by a hash of the piece, so no key gathers more. ``rounds`` bounds how often pieces of
    buckets with a gap between packing and lower bound are exchanged; the last round keeps what
    it has. Equal pieces share a bucket's order and get places of their own. Empty input gives
    no rows.
    """
    waiting = materialize(pieces, "pieces")
    placed = None
    for turn in range(rounds):
        last = turn == rounds - 1
        # A full piece needs no partner; it is left alone in a sequence of its own.
        free = waiting.where(F.col("length") < capacity) if turn == 0 else waiting
        n = free.count()
        if turn and not n:
            break
        buckets = max(1, -(-n // BUCKET_PIECES))
        bucket = F.pmod(F.xxhash64("doc_id", "row", "piece", F.lit(turn)), F.lit(buckets))

        packed = free.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(
            _packing(turn, capacity, last), _PLACED)
        if turn == 0:
            alone = waiting.where(F.col("length") >= capacity).select(
                "*", F.monotonically_increasing_id().alias("bin"),
                F.lit(0).cast("long").alias("offset"), F.lit(True).alias("done"))
            packed = packed.unionByName(alone)
        packed = materialize(packed, "packed")
        ready = packed.where("done")
        placed = ready if placed is None else placed.unionByName(ready)
        waiting = packed.where("not done").drop("bin", "offset", "done")
    return placed.drop("done")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 4096,
                   rounds: int = 4) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset."""
    placed = pack(document_pieces(docs, vocabulary, end_id, capacity), capacity, rounds)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.col("bin").alias("sequence_id"), "offset")
