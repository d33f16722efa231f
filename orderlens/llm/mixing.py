"""Mixing sources to target weights by pivotal dependent rounding.

Every document should be taken ``target / source size`` times on average. The whole part is taken
as it is; of the fraction, pairs of documents of one source exchange mass until one of them is
whole. The exchange is weighed by size, so the words taken of a source never change, and it is
random, so every document keeps its expected number of copies. Chunks of a source are rounded
where they lie; each leaves at most one fractional document, and these are combined level by
level in a tree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import materialize

#: Documents of one source that one task rounds at a time, and chunks that meet on each level.
CHUNK_ROWS = 8192
FAN_IN = 64
#: Weights of the sources in order of code point, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this on average.
MOST_COPIES = 3

_ROUNDED = "doc_id long, row long, size long, place int, source_size long, target double, " \
           "copies int, rest double, chunk long"


def word_count(text) -> F.Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D (null: 0).

    Two regular-expression passes in the JVM: each run shrinks to one mark, white space goes.
    """
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_COPIES) -> DataFrame:
    """Target words per source: shares of all words by weight, none above ``most`` times its size.

    ``sizes`` has a row per source: source, source_size. Sources are ranked by code point, null
    last. Sharing the excess again and again ends at min(most * size, weight * level) for the one
    level at which the targets add up to all words; sorted by most * size / weight, the sources
    below it come first, so running sums find it. Adds ``place`` (the rank from 0) and ``target``.
    The windows hold one row per source.
    """
    ranked = sizes.withColumn("place", F.row_number().over(
        Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1)
    pattern = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(
        pattern, (F.col("place") % len(weights) + 1).cast("int")).cast("long")) \
        .withColumn("cap", (F.col("source_size") * most).cast("long"))
    every = Window.partitionBy()
    upto = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    levels = ranked.select(
        "*", F.sum("source_size").over(every).alias("total"),
        F.sum("weight").over(every).alias("all_weight"),
        (F.sum("cap").over(upto.rowsBetween(Window.unboundedPreceding, 0))).alias("cap_to"),
        (F.sum("weight").over(upto.rowsBetween(Window.unboundedPreceding, 0))).alias("weight_to"))
    # The level if this source and all before it were capped before it: what is left of all words,
    # over the weights from this source on. This source is capped if its cap lies below that; the
    # first that isn't has the level, and those after it get lower ones.
    level = (F.col("total") - F.col("cap_to") + F.col("cap")) / \
        (F.col("all_weight") - F.col("weight_to") + F.col("weight"))
    open_level = F.when(F.col("cap") >= F.col("weight") * level, level)
    found = levels.withColumn("level", F.max(open_level).over(every))
    return found.select("source", "source_size", "place", F.least(
        F.col("cap").cast("double"),
        F.coalesce(F.col("weight") * F.col("level"), F.col("cap").cast("double"))).alias("target"))


def _round_chunk(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Pairs fractions of one chunk until one document at most has one left (in ``rest``)."""
    rows = rows.sort_values(["doc_id", "row"], na_position="first", ignore_index=True)
    key = pd.util.hash_array(rows["row"].to_numpy(np.int64)) ^ pd.util.hash_array(
        rows["doc_id"].fillna(-1).to_numpy(np.int64))
    first = int(key[0] & np.uint64(0x7FFFFFFF)) if len(key) else 0
    draws = np.random.default_rng([seed, first, len(rows)]).random(len(rows)).tolist()
    sizes, rest = rows["size"].tolist(), rows["rest"].tolist()
    copies = rows["copies"].tolist()
    held = -1
    for i, p in enumerate(rest):
        if p <= 0.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, q = sizes[held], sizes[i], rest[held]
        mass = q * a + p * b
        # Either the held one is filled up (or all its mass goes over), or the other way round;
        # the odds keep both documents' expected copies.
        up = min((1.0 - q) * a, p * b)      # mass the held one can gain
        down = min(q * a, (1.0 - p) * b)    # mass it can lose
        gain = up if draws[i] * (up + down) < down else -down
        q_new = q + gain / a
        if gain > 0:
            whole_held = (1.0 - q) * a <= p * b
        else:
            whole_held = q * a <= (1.0 - p) * b
        if whole_held:
            copies[held] += gain > 0
            rest[held] = 0.0
            left = (mass - (a if gain > 0 else 0.0)) / b
            rest[i] = min(max(left, 0.0), 1.0)
            held = i
        else:
            copies[i] += gain < 0
            rest[i] = 0.0
            rest[held] = min(max(q_new, 0.0), 1.0)
        if rest[held] < 1e-12 or rest[held] > 1 - 1e-12:
            copies[held] += rest[held] > 0.5
            rest[held] = 0.0
            held = -1
    rows["copies"], rows["rest"] = copies, rest
    return rows


def _rounding(seed: int):
    def work(group: pd.DataFrame) -> pd.DataFrame:
        return _round_chunk(group, seed)[[c.split()[0] for c in _ROUNDED.split(", ")]]
    return work


def mix_sources(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES, seed: int = 7,
                size: str | None = None) -> DataFrame:
    """How often the mix takes every document: doc_id, row, source, size, source_size, target
    (its source's), copies, taken (size * copies).

    A document's size is its number of words, or the column ``size``. Null sources are one source.
    Documents without words are not taken. ``row`` is a hash of the text, which tells
    apart rows that share a doc_id; every row, repeated ones too, is decided by itself.
    The draws depend on the rows alone: runs over the same rows agree. Empty input gives no rows.
    """
    words = F.col(size).cast("long") if size else word_count(F.col("text").cast("string"))
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("row"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(words, F.lit(0)).alias("size")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count("*").alias("source_rows"))
    targets = materialize(source_targets(sizes.drop("source_rows"), weights, most).join(
        sizes.withColumnRenamed("source", "named").drop("source_size"),
        F.col("source").eqNullSafe(F.col("named"))).drop("named"), "targets")
    joined = rows.join(targets.withColumnRenamed("source", "named"),
                       F.col("source").eqNullSafe(F.col("named"))).drop("named", "source")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    share = F.least(share, F.lit(float(most)))
    whole = F.when(F.col("size") > 0, F.floor(share)).otherwise(0).cast("int")
    chunks = F.ceil(F.col("source_rows") / F.lit(CHUNK_ROWS))
    level = joined.select(
        "doc_id", "row", "size", "place", "source_size", "target", whole.alias("copies"),
        F.when(F.col("size") > 0, share - F.floor(share)).otherwise(0.0).alias("rest"),
        F.pmod(F.xxhash64("doc_id", "row"), chunks).cast("long").alias("chunk"))
    most_rows = targets.agg(F.max("source_rows")).first()[0] or 0
    groups, done, turn = -(-most_rows // CHUNK_ROWS), None, 0
    while True:
        rounded = materialize(level.groupBy("place", "chunk").applyInPandas(
            _rounding(seed + turn), _ROUNDED), "rounded")
        whole_rows = rounded.where("rest = 0")
        done = whole_rows if done is None else done.unionByName(whole_rows)
        left = rounded.where("rest > 0")
        if groups <= 1:
            break
        level = left.withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
        groups, turn = -(-groups // FAN_IN), turn + 1
    # The last fraction of a source, one document, is settled by one draw.
    draw = F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(1 << 20)) / F.lit(1 << 20)
    last = left.withColumn("copies", F.col("copies") + F.when(draw < F.col("rest"), 1).otherwise(0))
    names = targets.select("place", "source")
    return done.unionByName(last.withColumn("rest", F.lit(0.0))).join(names, "place").select(
        "doc_id", "row", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most=MOST_COPIES,
                    seed: int = 7) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with all its columns."""
    copies = mix_sources(docs, weights, most, seed).where("copies > 0").select(
        F.col("doc_id").alias("id"), "row", "source", "copies")
    keys = ["id", "row", "source"]
    copies = copies.withColumn("n", F.row_number().over(
        Window.partitionBy(*keys).orderBy("copies")))
    # The row travels as one value, so no column of it meets a name that is used here.
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("row"),
        F.col("source").cast("string").alias("source"))
    numbered = keyed.withColumn("n", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.xxhash64("document"))))
    met = numbered.alias("d").join(copies.alias("c"), [
        F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*keys, "n")])
    return met.select(F.col("d.document").alias("document"), F.explode(
        F.sequence(F.lit(1), F.col("c.copies"))).alias("copy")).select("document.*")
