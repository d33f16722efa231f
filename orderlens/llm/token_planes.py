"""Token ids as binary files: blocks of ids, transposed into planes, each plane compressed.

A file set has two tables. ``blocks`` holds one row per block of ``BLOCK_IDS`` ids (the last of
a shard may be shorter): the compressed planes, and the documents that lie in it. ``index`` holds
one row per block without its ids: where it starts in the whole sequence, how many ids and bytes.
Both are Parquet, so they can stand in any store that Spark reaches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrowtext import documents, partitions, slices
from .encoders import encoder

BLOCK_IDS = 1 << 16
_BLOCK_SCHEMA = ("shard int, block int, start long, n_ids int, width int, planes array<binary>, "
                 "doc_ids array<long>, doc_starts array<long>, doc_sizes array<long>")


def to_planes(ids: np.ndarray, width: int = 8) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids: 4 byte planes (``width`` 8) or 32 bit planes
    (``width`` 1), lowest first."""
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=3).compress
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if width == 1:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        return [squeeze(np.packbits(bits[:, k]).tobytes()) for k in range(32)]
    return [squeeze(raw[:, k].tobytes()) for k in range(4)]


def from_planes(planes: list[bytes], n_ids: int, width: int) -> np.ndarray:
    """The ids that :func:`to_planes` was given."""
    import zstandard
    expand = zstandard.ZstdDecompressor().decompress
    parts = [np.frombuffer(expand(p, max_output_size=n_ids + 8), np.uint8) for p in planes]
    if width == 1:
        bits = np.stack([np.unpackbits(p)[:n_ids] for p in parts], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()
    return np.stack(parts, axis=1).copy().view("<u4").ravel()


def _blocks_of(batches: Iterator[pa.RecordBatch], path: str, end_id: int,
               width: int) -> Iterator[pa.RecordBatch]:
    """Encodes the documents of one shard and cuts their ids into blocks."""
    from pyspark import TaskContext
    shard = TaskContext.get().partitionId()
    encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
    waiting, held, start, block = [], 0, 0, 0
    here: list[tuple[int, int, int]] = []   # documents that reach into the waiting ids
    total = 0

    def cut(n_ids: int) -> pa.RecordBatch:
        nonlocal waiting, held, start, block, here
        flat = b"".join(waiting)
        ids = np.frombuffer(flat[:4 * n_ids], "<u4")
        inside = [d for d in here if d[1] < start + n_ids]
        row = {"shard": shard, "block": block, "start": start, "n_ids": n_ids, "width": width,
               "planes": to_planes(ids, width), "doc_ids": [d[0] for d in inside],
               "doc_starts": [d[1] for d in inside], "doc_sizes": [d[2] for d in inside]}
        start, block = start + n_ids, block + 1
        waiting, held = [flat[4 * n_ids:]], held - n_ids
        here = [d for d in here if d[1] + d[2] > start]
        return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)

    for part in slices(batches):
        texts = part.column("text").to_pylist()
        for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts)):
            size = len(ids) // 4 + 1
            here.append((doc_id, total, size))
            waiting += [ids, end]
            total, held = total + size, held + size
            while held >= BLOCK_IDS:
                yield cut(BLOCK_IDS)
    if held:
        yield cut(held)


_ARROW_BLOCK = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()),
    ("width", pa.int32()), ("planes", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())),
    ("doc_starts", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int,
                 width: int = 8) -> None:
    """Encodes the whole text of every document with the vocabulary file, appends ``end_id``,
    and writes all ids in ascending ``doc_id`` order (nulls first, ties by text).

    A null or empty text is its end id alone; repeated rows are written as often as they occur;
    an empty table gives empty files; other columns are ignored. Documents are dealt out by
    ranges of doc_id, so a shard is a stretch of that order.
    """
    spark, rows = docs.sparkSession, documents(docs)
    ranged = rows.repartitionByRange(partitions(rows), "doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    blocks = ranged.mapInArrow(lambda it: _blocks_of(it, vocabulary, end_id, width), _BLOCK_SCHEMA)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    written = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    shards = written.groupBy("shard").agg(F.sum(F.col("n_ids").cast("long")).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    # One row per shard: 1,000,000 of them for 100 TB.
    written.select("shard", "block", "start", "n_ids").join(bases, "shard").select(
        "shard", "block", (F.col("base") + F.col("start")).alias("first"), "n_ids", "base",
    ).write.parquet(f"{path}/index")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of ids with the place of their first id in the whole sequence (``base`` is that of
    their shard)."""
    blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    index = spark.read.schema("shard int, block int, first long, n_ids int, base long") \
        .parquet(f"{path}/index").select("shard", "block", "base")
    return blocks.join(index, ["shard", "block"])


def _parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):   # one block at a time
            b = batch.slice(row, 1).to_pylist()[0]
            raw = from_planes(b["planes"], b["n_ids"], b["width"]).tobytes()
            out = {k: [] for k in ("start", "doc_id", "n_tokens", "at", "part", "ids")}
            for doc_id, start, size in zip(b["doc_ids"], b["doc_starts"], b["doc_sizes"]):
                low = max(start, b["start"])
                high = min(start + size, b["start"] + b["n_ids"])
                out["start"].append(b["base"] + start)
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(size)
                out["at"].append(low - start)
                out["part"].append(high - low)
                out["ids"].append(raw[4 * (low - b["start"]):4 * (high - b["start"])])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                (k, pa.binary() if k == "ids" else pa.int64()) for k in out]))


def read_document_parts(spark: SparkSession, path: str) -> DataFrame:
    """For each document and block it lies in: ``start`` (its first id in the whole sequence),
    ``doc_id``, ``n_tokens``, ``at`` (ids of it in earlier blocks), ``part`` (ids here), ``ids``."""
    return read_blocks(spark, path).mapInArrow(
        _parts_of, "start long, doc_id long, n_tokens long, at long, part long, ids binary")


_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's, lowest power in the highest bit."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return product


def crc_join(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two byte strings back to back, from the crc32 of each."""
    power, square, n = 1 << 31, 1 << 23, second_bytes   # 1, and x**8
    while n:
        if n & 1:
            power = _times(power, square)
        square, n = _times(square, square), n >> 1
    return _times(first, power) ^ second


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = []
        for parts in batch.column("parts").to_pylist():
            crc = 0
            for p in sorted(parts, key=lambda p: p["at"]):
                crc = crc_join(crc, p["crc"], 4 * p["part"])
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")),
             pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """One row per document read back: doc_id, start, n_tokens, crc32 of its ids' bytes."""
    parts = read_document_parts(spark, path).select(
        "doc_id", "start", "n_tokens", "at", "part", F.crc32("ids").alias("crc"))
    kept = ["doc_id", "start", "n_tokens"]
    # Only documents that cross a block's end have several parts: one or two per block.
    crossing = parts.where("part < n_tokens").groupBy(*kept).agg(
        F.collect_list(F.struct("at", "part", "crc")).alias("parts")).mapInArrow(
        _joined, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return parts.where("part = n_tokens").select(
        *kept, F.col("crc").alias("ids_crc32")).unionByName(crossing)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
