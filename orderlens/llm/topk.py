"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; each keeps its mean and deviation. For segments of m components,
m * (difference of means squared + difference of deviations squared) is at most their squared
distance, so coarse statistics bound the distance from below, and with the vectors' lengths the
inner product from above: |q|^2 + |x|^2 - d^2 = 2 q.x. Bounds are taken from one segment down to
short ones; only what can still be among the k best goes on, and survivors are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import materialize

from .arrowtext import partitions

#: Rows of the query set and of all vectors that meet in one numpy step.
QUERY_BLOCK, VECTOR_BLOCK = 512, 4096


def integer_vectors(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """vec_id and v = floor(factor * component, taken as double) as array<long>.

    Rows whose id or vector is null, or that hold a null, NaN or infinite component, or one too
    large for a long, take no part. Other columns are left behind.
    """
    values = F.col("embedding").cast("array<double>")
    scaled = F.transform(values, lambda x: F.floor(x * factor))
    fits = F.forall(values, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < 2.0 ** 62 / factor), F.lit(False)))
    return vectors.where(fits & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<long>").alias("v"))


def _stack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Up to ``rows`` vectors of one length as one row: dim, ids, matrix (little-endian int64)."""
    waiting: dict[int, tuple[list, list]] = {}

    def packed(dim: int) -> pa.RecordBatch:
        ids, vs = waiting.pop(dim)
        return pa.RecordBatch.from_pylist([{
            "dim": dim, "ids": np.array(ids, "<i8").tobytes(),
            "matrix": np.array(vs, "<i8").tobytes()}], schema=pa.schema(
                [("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary())]))

    for batch in batches:
        for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
            ids, vs = waiting.setdefault(len(v), ([], []))
            ids.append(vec_id)
            vs.append(v)
            if len(ids) == rows:
                yield packed(len(v))
    for dim in list(waiting):
        yield packed(dim)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    return vectors.mapInArrow(lambda it: _stack(it, rows), "dim int, ids binary, matrix binary")


def _statistics(matrix: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(m) * mean and sqrt(m) * deviation, so that dot products of these rows
    bound the vectors' own. Uneven lengths give segments that differ by one component."""
    edges = np.linspace(0, matrix.shape[1], segments + 1).astype(int)
    parts = []
    for low, high in zip(edges[:-1], edges[1:]):
        part = matrix[:, low:high]
        mean = part.mean(axis=1)
        spread = np.sqrt(np.maximum((part * part).mean(axis=1) - mean * mean, 0.0))
        parts += [mean * np.sqrt(high - low), spread * np.sqrt(high - low)]
    return np.stack(parts, axis=1)


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, in whole numbers of any size."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[-1]
    if largest >= 2.0 ** 62:
        return (q.astype(object) * x.astype(object)).sum(axis=-1)
    return (q * x).sum(axis=-1)


def _products(q: np.ndarray, x: np.ndarray, qf: np.ndarray, xf: np.ndarray) -> np.ndarray:
    """All inner products; in floating point where that is exact, which is much faster."""
    if np.abs(qf).max(initial=0) * np.abs(xf).max(initial=0) * q.shape[1] < 2.0 ** 53:
        return qf @ xf.T
    return np.stack([_exact(row[None, :], x) for row in q])


def block_top(q_ids, q, x_ids, x, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """The k best vectors of a block for each query: query rows, vector rows, scores; and how
    many pairs each level of statistics left."""
    qf, xf = q.astype(float), x.astype(float)
    own = q_ids[:, None] == x_ids[None, :]
    dim, counts = q.shape[1], {}
    levels = [n for n in (1, 4, 16) if n < dim] if dim else []
    slack = 1.0 + 1e-9 * np.sqrt((qf * qf).sum(1))[:, None] * np.sqrt((xf * xf).sum(1))[None, :]
    floor, alive = np.full(len(q), -np.inf), ~own
    for n in levels:
        upper = _statistics(qf, n) @ _statistics(xf, n).T
        upper += slack
        upper[own] = -np.inf
        if n == levels[0] and k < len(x):
            # k likely winners give each query a score that the k best must reach.
            likely = np.argpartition(-upper, k, axis=1)[:, :k]
            scores = _exact(q[:, None, :], x[likely]).astype(float)
            scores[np.take_along_axis(own, likely, axis=1)] = -np.inf
            floor = scores.min(axis=1)
        alive &= upper >= floor[:, None]
        counts[n] = int(alive.sum())
    # Survivors: the vectors that any query of the block still needs.
    columns = np.flatnonzero(alive.any(axis=0))
    scores = _products(q, x[columns], qf, xf[columns])
    there = alive[:, columns]
    masked = np.where(there, scores, -np.inf).astype(float)
    if len(columns) > k:
        least = np.partition(masked, len(columns) - k, axis=1)[:, len(columns) - k]
        there &= masked >= least[:, None]
    rows, at = np.nonzero(there)
    best, ids = scores[rows, at], x_ids[columns[at]]
    order = sorted(range(len(rows)), key=lambda i: (rows[i], -int(best[i]), ids[i]))
    rows, at, best = rows[order], at[order], best[order]
    first = np.searchsorted(rows, np.arange(len(q)))
    keep = np.arange(len(rows)) - first[rows] < k
    return rows[keep], columns[at[keep]], best[keep], counts


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    def matrix(row, name):
        ids = np.frombuffer(row[f"{name}_ids"], "<i8")
        return ids, np.frombuffer(row[f"{name}_matrix"], "<i8").reshape(len(ids), row["dim"])

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            (q_ids, q), (x_ids, x) = matrix(row, "q"), matrix(row, "x")
            r, c, scores, _ = block_top(q_ids, q, x_ids, x, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[r], pa.int64()), pa.array(x_ids[c], pa.int64()),
                 pa.array([int(s) for s in scores], pa.int64())],
                ["query_id", "vec_id", "score"])


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The k highest inner products of every query among all vectors with another vec_id and the
    same number of components, ties to the smaller vec_id: query_id, rank, vec_id, score.

    Both frames come from :func:`integer_vectors`. Every block of queries meets every block of
    vectors once; a pair of blocks hands on k rows per query at most. Rows that repeat a vec_id
    are one candidate each. Empty input gives no rows. Scores must fit in a long.
    """
    q = materialize(_blocks(queries, QUERY_BLOCK), "query-blocks")
    n, tasks = q.count(), partitions(vectors)
    # The stated query set against all rows, in blocks. A key is a block of queries and a slice of
    # the vectors, as many slices as it takes to give every task a key.
    parts = max(1, tasks // max(n, 1))
    order = Window.orderBy("place")
    q = q.withColumn("place", F.monotonically_increasing_id())
    names = q.select("place", (F.row_number().over(order) - 1).alias("q_block"))  # a row per block
    q = q.join(names, "place").select(
        "dim", "q_block", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("slice"))
    x = _blocks(vectors, VECTOR_BLOCK).select(
        "dim", F.col("ids").alias("x_ids"), F.col("matrix").alias("x_matrix"),
        F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(max(n - 1, 0)))).alias("q_block"))
    pairs = q.join(x, ["dim", "q_block", "slice"])
    best = pairs.mapInArrow(lambda it: _search(it, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
