"""Data quality: outlier bounds and reports, winsorizing, profiles, chart-ready tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import flag
from ..functions.quantiles import RankTarget, narrow, order_statistics, quantile_table
from ..sources.store import materialize


def _bounds(df: DataFrame, cols: Sequence[str], k: float) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return quantile_table(df, cols, [0.25, 0.75], ["q1", "q3"]).select(
        "column", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - iqr * k).alias("lower"), (F.col("q3") + iqr * k).alias("upper"))


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """q1, q3 and the bounds k interquartile ranges outside them, one row per column."""
    return _bounds(narrow(df, cols), cols, k)


def outlier_report(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Number and percentage (of all rows) of outliers per column."""
    df = narrow(df, cols)
    return spread_report(df, quartiles(df, cols), k).select(
        "column", "n_outliers", "pct_outliers", "lower", "upper")


def remove_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Drop the outliers of one column after the other; each column's bounds are taken from
    the rows the previous ones left.

    The input is written to a work table once: the bounds of a step (one row, read here)
    become literals that the scans of the next step push down.
    """
    kept = materialize(df, "remove-outliers")
    for col in cols:
        bounds = _bounds(kept, [col], k).first()
        if bounds is not None:
            kept = kept.where(F.col(col).between(bounds["lower"], bounds["upper"]))
    return kept


def winsorize(df: DataFrame, col: str, low: float = 0.05, high: float = 0.05) -> DataFrame:
    """``df`` + ``<col>_winsorized``: the lowest and highest shares of rows take the value of
    the nearest remaining row; and ``<col>_1k``, the raw column in thousands."""
    limits = order_statistics(narrow(df, [col]), [col], [
        RankTarget("low", lambda n: floor(n * low)),
        RankTarget("high", lambda n: n - 1 - floor(n * high))])
    limit = limits.agg(F.struct(*[
        F.max(F.when(F.col("target") == t, F.col("value"))).alias(t) for t in ("low", "high")])
    ).scalar()
    clamped = F.least(F.greatest(F.col(col), limit.getField("low")), limit.getField("high"))
    return df.withColumns({
        f"{col}_winsorized": F.when(F.col(col).isNotNull(), clamped),
        f"{col}_1k": F.col(col) / 1000})


def outlier_customers(df: DataFrame, col: str = "net_spent", k: float = 1.5) -> DataFrame:
    """Customers with outlying orders and how many they have."""
    df = materialize(df.select("customer_id", col), "customer-values")
    bounds = _bounds(df, [col], k).select(F.struct("lower", "upper")).scalar()
    outside = (F.col(col) < bounds.getField("lower")) | (F.col(col) > bounds.getField("upper"))
    return (df.groupBy("customer_id").agg(F.sum(flag(outside)).alias("n_outlier_orders"))
            .where("n_outlier_orders <> 0")
            .orderBy(F.desc("n_outlier_orders"), "customer_id"))


def table_preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def table_profile(df: DataFrame) -> DataFrame:
    """Type, rows and NULLs of every column."""
    counts = df.agg(F.count("*").alias("n_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("type"), F.col("n_rows"),
                 F.col(f"null_{name}").alias("n_null")) for name, dtype in df.dtypes])))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles, maximum per column."""
    df = narrow(df, cols)
    wanted = [e for c in cols for e in (
        F.count(c).alias(f"count_{c}"), F.avg(c).alias(f"mean_{c}"),
        F.stddev_samp(c).alias(f"std_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    basic = df.agg(*wanted).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{c}").alias(m) for m in (
            "count", "mean", "std", "min", "max")]) for c in cols]))).where("count > 0")
    return basic.join(quartiles(df, cols), "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def boxplot_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, the outermost values within k interquartile ranges, and the values beyond."""
    df = narrow(df, cols)
    spread = spread_report(df, quartiles(df, cols), k)
    return spread.select("column", F.col("q25").alias("q1"), F.col("q50").alias("median"),
                         F.col("q75").alias("q3"), "whisker_low", "whisker_high",
                         F.col("n_outliers").alias("n_fliers"))


def discount_spend_bins(lines: DataFrame, discount_step: float = 0.01,
                        spend_step: float = 1000) -> DataFrame:
    """Lines per label in cells of discount and net spend: the content of their scatter plot."""
    return lines.groupBy(*discount_spend_cells(discount_step, spend_step),
                         "is_returned").agg(F.count("*").alias("n"))


def discount_spend_cells(discount_step: float = 0.01, spend_step: float = 1000) -> list[Column]:
    """discount_bin and spend_bin of a line."""
    def cell(col: str, step: float):
        return F.floor(F.col(col).cast("decimal(18,4)") / F.lit(str(step)).cast("decimal(10,4)"))

    return [cell("discount", discount_step).cast("bigint").alias("discount_bin"),
            cell("net_spent", spend_step).cast("bigint").alias("spend_bin")]


def counted(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict]:
    """``df`` as a work table, and one row of aggregates over it: ``n_rows``, ``null_<c>`` of every
    column, and ``count_``, ``mean_``, ``std_``, ``min_`` and ``max_<c>`` of ``cols`` as doubles.

    An aggregate, not observed metrics: once a session has observed any, Spark can't ship task
    code that holds the session, as Spark ML's does."""
    wanted = [F.count(F.lit(1)).alias("n_rows")]
    wanted += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    for c in cols:
        value = F.col(c).cast("double")
        wanted += [F.count(value).alias(f"count_{c}"), F.avg(value).alias(f"mean_{c}"),
                   F.stddev_samp(value).alias(f"std_{c}"), F.min(value).alias(f"min_{c}"),
                   F.max(value).alias(f"max_{c}")]
    rows = materialize(df, "report-rows")
    return rows, rows.agg(*wanted).first().asDict()


def counted_profile(rows: DataFrame, seen: dict) -> DataFrame:
    """:func:`table_profile` of a counted table."""
    return rows.sparkSession.createDataFrame(
        [(c, t, seen["n_rows"], seen[f"null_{c}"]) for c, t in rows.dtypes],
        "column string, type string, n_rows long, n_null long")


def counted_moments(rows: DataFrame, cols: Sequence[str], seen: dict) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of a counted table's columns
    that hold a value."""
    measures = ["count", "mean", "std", "min", "max"]
    return rows.sparkSession.createDataFrame(
        [(c, *[seen[f"{m}_{c}"] for m in measures]) for c in cols if seen[f"count_{c}"]],
        "column string, count long, mean double, std double, min double, max double")


def quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, q25, q50, q75."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return quantile_table(numbers, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


def spread_report(df: DataFrame, quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """``quartiles`` + lower, upper, n_outliers, pct_outliers, whisker_low, whisker_high: what
    outlier report and box plot show, from one pass. The bounds (one row per column, read here)
    are literals in it."""
    known = [(r["column"], r["q25"], r["q50"], r["q75"]) for r in quartiles.collect()]
    wanted, bounds = [F.count(F.lit(1)).alias("n_rows")], []
    for i, (c, q1, _, q3) in enumerate(known):
        low, high = q1 - (q3 - q1) * k, q3 + (q3 - q1) * k
        value = F.col(c).cast("double")
        inside = value.between(low, high)
        bounds.append((low, high))
        wanted += [F.count_if(~inside).alias(f"out_{i}"),
                   F.min(F.when(inside, value)).alias(f"low_{i}"),
                   F.max(F.when(inside, value)).alias(f"high_{i}")]
    found = df.agg(*wanted).first()
    return df.sparkSession.createDataFrame(
        [(*row, *bounds[i], found[f"out_{i}"], found[f"out_{i}"] * 100.0 / found["n_rows"],
          found[f"low_{i}"], found[f"high_{i}"]) for i, row in enumerate(known)],
        "column string, q25 double, q50 double, q75 double, lower double, upper double,"
        " n_outliers long, pct_outliers double, whisker_low double, whisker_high double")


def pair_bins(df: DataFrame, cols: Sequence[str], n_bins: int = 20) -> DataFrame:
    """Rows per cell of every pair of columns, and per bin of every single column (where
    col_x = col_y): the content of a pair plot.

    Rows are first counted per combination of all bins, so the fan-out to pairs works on
    that much smaller table.
    """
    df = narrow(df, cols)
    extent = df.agg(F.struct(*[e for c in cols for e in (
        F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])).scalar()

    def bin_of(col: str):
        low, high = extent.getField(f"min_{col}"), extent.getField(f"max_{col}")
        share = F.try_divide(F.col(col) - low, high - low)
        within = F.least(F.floor(share * n_bins), F.lit(n_bins - 1))
        return F.when(F.col(col).isNotNull(), F.coalesce(within, F.lit(0))).cast("bigint")

    combined = df.select(*[bin_of(c).alias(c) for c in cols]).groupBy(*cols).agg(
        F.count("*").alias("n"))
    plots = [(c, c) for c in cols] + list(combinations(cols, 2))
    cells = F.array(*[F.struct(F.lit(x).alias("col_x"), F.lit(y).alias("col_y"),
                               F.col(x).alias("bin_x"), F.col(y).alias("bin_y"))
                      for x, y in plots])
    return (combined.select("n", F.inline(cells))
            .where("bin_x is not null and bin_y is not null")
            .groupBy("col_x", "col_y", "bin_x", "bin_y").agg(F.sum("n").alias("n")))
