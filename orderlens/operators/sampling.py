"""Stratified splits, scaling, class weights and oversampling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import draw_hash, uniform
from ..sources.store import materialize
from .neighbors import neighbour_lists


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _draw_cuts(drawn: DataFrame, label: str, wanted: Callable[[Column], Column]) -> DataFrame:
    """Per class the draw up to which exactly ``wanted(n)`` rows fall; no row for a class
    that wants none.

    No class is ranked. Its rows are counted per value of the first four hex digits of the draw,
    the value in which the cut lies is counted by the next four, and what shares those eight
    digits, a four-billionth of the class, by whole draws. A window sees at most 65,536 counts of
    a class, or, at the end, those few draws; copies of a row are one of them. ``drawn`` is read
    three times, so it should stand on a work table.
    """
    digits = [F.substring("_draw", 1, 4), F.substring("_draw", 5, 4), F.col("_draw")]
    by_class = Window.partitionBy("_class")
    upto = by_class.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows, edges = drawn.withColumn("_class", F.col(label)), None
    for place, value in enumerate(digits):
        if edges is not None:
            reached = edges.select("_class", "_want", F.col("_value").alias("_reached"))
            rows = rows.join(F.broadcast(reached), "_class").where(   # one row per class
                digits[place - 1] == F.col("_reached")).drop("_reached")
        known = [] if edges is None else ["_want"]
        counts = rows.groupBy("_class", *known, value.alias("_value")).agg(
            F.count("*").alias("_rows")).withColumn("_upto", F.sum("_rows").over(upto))
        if edges is None:
            counts = counts.withColumn(
                "_want", wanted(F.sum("_rows").over(by_class)).cast("bigint"))
        # What is still wanted inside the value that the cut lies in.
        edges = counts.where("_upto >= _want and _upto - _rows < _want").withColumn(
            "_want", F.col("_want") - F.col("_upto") + F.col("_rows"))
        rows = rows.select(label, "_draw", "_class")
    return edges.select(F.col("_class").alias(label), F.col("_value").alias("_cut"))


def stratified_split(df: DataFrame, label: str, key: str | Sequence[str], test: float = 0.2,
                     seed: int = 42, names: tuple[str, str] = ("train", "test"),
                     split: str = "split") -> DataFrame:
    """``df`` + split: the given share of every class, to the nearest row, is test.

    Rows are drawn by a hash of their unique key, so a row keeps its side in every run and
    when a lost task is repeated. ``df`` is written to a work table once, so pass the columns you
    need: cuts and sides are read from there, and the plan behind ``df`` runs once.
    """
    drawn = materialize(df, "split-rows").withColumn("_draw", draw_hash(*_keys(key), seed=seed))
    cuts = _draw_cuts(drawn, label, lambda n: F.floor(n * F.lit(test) + F.lit(0.5)))
    is_test = F.col("_cut").isNotNull() & (F.col("_draw") <= F.col("_cut"))
    return (drawn.join(F.broadcast(cuts), label, "left")   # one row per class
            .select(*df.columns, F.when(is_test, names[1]).otherwise(names[0]).alias(split)))


def validation_split(df: DataFrame, label: str, key: str | Sequence[str], share: float = 0.2,
                     seed: int = 7) -> DataFrame:
    """``df`` + is_validation: a hashed hold-out of each class for early stopping."""
    held = stratified_split(df, label, key, share, seed, ("fit", "hold"), "_side")
    return held.withColumn("is_validation", F.col("_side") == "hold").drop("_side")


def numbered(df: DataFrame, key: str | Sequence[str], seed: int = 42,
             number: str = "number") -> DataFrame:
    """``df`` + number: 0, 1, 2, ... in the order of a hash of the unique key.

    Rows are counted per four-digit prefix of the hash; a row's number is the count before its
    prefix plus its rank in it, so no task ranks more than a 65,536th of the rows.
    """
    drawn = df.withColumn("_draw", draw_hash(*_keys(key), seed=seed)).withColumn(
        "_prefix", F.substring("_draw", 1, 4))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = drawn.groupBy("_prefix").agg(F.count("*").alias("_rows")).select(
        "_prefix", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_prefix").orderBy("_draw", *_keys(key)))
    return (drawn.withColumn("_rank", rank).join(F.broadcast(starts), "_prefix")   # 65,536 rows
            .select(*df.columns, (F.col("_start") + F.col("_rank") - 1).alias(number)))


def scale_params(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column; a constant column gets 1."""
    stats = df.agg(*[e for c in cols for e in (
        F.avg(F.col(c).cast("double")).alias(f"mean_{c}"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}"))])
    return stats.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"mean_{c}").alias("mean"),
                 F.when(F.col(f"std_{c}") == 0, 1.0).otherwise(F.col(f"std_{c}")).alias("std"))
        for c in cols])))


def standard_scale(df: DataFrame, cols: Sequence[str],
                   fit_on: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Scale columns to mean 0 and population standard deviation 1, measured on ``fit_on``, or on
    ``df`` itself, which is then read twice from a work table."""
    if fit_on is None:
        df = materialize(df, "scale-rows")
    params = scale_params(df if fit_on is None else fit_on, cols)
    fitted = params.agg(F.struct(*[e for c in cols for e in (
        F.max(F.when(F.col("column") == c, F.col("mean"))).alias(f"mean_{c}"),
        F.max(F.when(F.col("column") == c, F.col("std"))).alias(f"std_{c}"))])).scalar()
    scaled = {c: (F.col(c).cast("double") - fitted[f"mean_{c}"]) / fitted[f"std_{c}"]
              for c in cols}
    return df.withColumns(scaled), params


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``df`` + weight: rows / (classes * rows of the class). Read twice from a work table."""
    df = materialize(df, "weight-rows")
    counts = df.groupBy(label).agg(F.count("*").alias("_rows"))
    everything = Window.partitionBy(F.lit(0))   # over one row per class
    weights = counts.select(label, (
        F.sum("_rows").over(everything)
        / (F.count("*").over(everything) * F.col("_rows"))).alias("weight"))
    return df.join(F.broadcast(weights), label)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def smote_neighbors(df: DataFrame, cols: Sequence[str], key: str, k: int = 5,
                    leaf_sites: int | None = None) -> DataFrame:
    """The k nearest other rows of every row: key, neighbour_key, rank, distance."""
    lists = neighbour_lists(df, cols, key, k, leaf_sites)
    return lists.select(key, F.posexplode("neighbours").alias("_pos", "_n")).select(
        key, F.col("_n.key").alias("neighbour_key"), (F.col("_pos") + 1).alias("rank"),
        F.col("_n.distance").alias("distance"))


def smote(df: DataFrame, cols: Sequence[str], label: str, key: str, ratio: float = 1.0,
          k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` + is_synthetic, with the smaller class filled up to ``ratio`` of the larger.

    int(ratio * larger - smaller) rows are added, as evenly as possible over the rows of the
    smaller class, each at a drawn place between a row and one of its k nearest neighbours
    in that class. Columns that are neither feature, label nor key are NULL in new rows. A
    class already at the ratio gets none. Two counts are read to size the work. All of it reads
    ``df`` from a work table.
    """
    original = materialize(df.withColumns({c: F.col(c).cast("double") for c in cols}
                                          | {key: F.col(key).cast("string")}), "smote-rows")
    # Two classes, so two rows.
    sizes = sorted((row["n"], row[label]) for row in
                   class_counts(original.where(F.col(label).isNotNull()), label).limit(3).collect())
    if len(sizes) != 2:
        raise ValueError(f"oversampling needs two classes, found {len(sizes)}")
    (n_minor, minor), (n_major, _) = sizes
    n_new = int(ratio * n_major - n_minor)
    if n_new <= 0:
        return original.withColumn("is_synthetic", F.lit(0))
    if n_minor < 2:
        raise ValueError("oversampling needs two rows of the smaller class")

    smaller = original.where(F.col(label) == minor).select(key, label, *cols)
    every, extra = divmod(n_new, n_minor)
    drawn = smaller.withColumn("_draw", draw_hash(key, seed=seed))
    copies = F.lit(every)
    if extra:
        cut = _draw_cuts(drawn, label, lambda n: F.lit(extra)).select("_cut").scalar()
        copies = copies + F.when(F.col("_draw") <= cut, 1).otherwise(0)
    lists = neighbour_lists(smaller, cols, key, k)
    seeds = drawn.withColumn("_copies", copies).where("_copies > 0").join(lists, key)
    new = seeds.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    new = new.withColumn("_draw", draw_hash(key, "_copy", seed=seed))
    choice = (F.floor(uniform(F.col("_draw"), 1) * F.size("neighbours")) + 1).cast("int")
    new = new.withColumn("_other", F.element_at("neighbours", choice)["features"])
    step = uniform(F.col("_draw"), 9)
    made = {c: F.col(c) + step * (F.col("_other")[i] - F.col(c)) for i, c in enumerate(cols)}
    made[key] = F.concat_ws("#", key, "_copy")
    fields = {f.name: f.dataType for f in original.schema.fields}
    synthetic = new.select(*[
        (made[c] if c in made else F.col(c) if c == label else F.lit(None).cast(fields[c])).alias(c)
        for c in original.columns], F.lit(1).alias("is_synthetic"))
    return original.withColumn("is_synthetic", F.lit(0)).unionByName(synthetic)
