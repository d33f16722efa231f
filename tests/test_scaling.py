"""Work that grows no faster than the input: plans that run once, shared sketches, bounded groups."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import quantiles
from orderlens.operators import (explain, metrics, neighbors, orders, quality, recommend, returns,
                                 sampling)
from orderlens.plans import jobs
from orderlens.sources import base_schemas


def counted_rows(spark, n=400):
    """Rows behind a plan that counts how many of them it made."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    plain = spark.range(n, numPartitions=2).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 4 == 0).cast("int").alias("label"),
        (F.col("id") * 37 % 101).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    return plain.mapInPandas(count, plain.schema), made


@pytest.mark.parametrize("job", [
    lambda df: sampling.stratified_split(df, "label", "key"),
    lambda df: sampling.validation_split(df, "label", "key", 0.25),
    lambda df: sampling.class_weights(df, "label"),
    lambda df: sampling.standard_scale(df, ["x", "y"])[0],
    lambda df: sampling.smote(df, ["x", "y"], "label", "key", 0.5)])
def test_the_plan_behind_the_rows_runs_once(spark, job):
    df, made = counted_rows(spark)
    assert job(df).count() >= 400
    assert made.value == 400


def test_scores_are_summed_by_one_number(spark):
    df, made = counted_rows(spark)
    df = df.select("key", "x", "y")
    values = explain.shapley_values(lambda f: f.withColumn("score", F.col("x") + F.col("y")), df,
                                    ["x", "y"], df.limit(3).select("x", "y"), "key")
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    grown = next(line for line in plan.splitlines() if "Aggregate" in line and "_weight_0" in line)
    assert "Aggregate [_vector" in grown and "_own_0" not in grown
    assert values.count() == 800


def test_order_features_are_made_once_for_the_reorder_rows(spark, monkeypatch):
    df, made = counted_rows(spark)
    day = F.date_add(F.lit("1997-06-01").cast("date"), F.col("y").cast("int"))
    features = df.select(
        (F.col("y") % 7).cast("long").alias("customer_id"), F.col("y").cast("long").alias("order_id"),
        day.alias("order_date"), F.col("x").alias("net_spent"),
        F.lit(1).cast("long").alias("total_quantity"), F.col("x").alias("avg_discount"),
        F.col("x").alias("avg_unit_price"), F.lit(2).cast("long").alias("total_orders"),
        F.lit("1997Q1").alias("year_quarter"))
    monkeypatch.setattr(orders, "order_features", lambda *_: features)
    rows, _, _ = jobs.reorder_training_rows({}, jobs.ReorderConfig())
    assert 0 < rows.count() <= 400 and made.value == 400


def test_components_read_the_resampled_rows_from_a_table(spark, monkeypatch):
    import __spark_entry__ as registered
    df, made = counted_rows(spark)
    rows = df.select(F.col("key").alias("line_id"), F.col("label").alias("is_returned"),
                     *[(F.col("x") * (i + 1) + F.col("y") * (i % 2)).alias(c)
                       for i, c in enumerate(registered.LINE_FEATURES)])
    monkeypatch.setattr(registered, "_smote", lambda *_: rows)
    assert registered._pca(spark, "").count() == 400
    assert made.value == 400


def test_products_are_joined_after_orders(spark):
    lines = spark.createDataFrame(
        [("a", 1, 7, 2.0, 3, 0.25), ("b", 1, 8, 4.0, 1, 0.0), ("c", 2, 7, 2.0, 0, 0.0),
         ("d", 9, 7, 2.0, 1, 0.5)],
        "line_id string, order_id long, product_id long, unit_price double, quantity int,"
        " discount double").withColumns({
            "unit_price": F.col("unit_price").cast("decimal(12,2)"),
            "discount": F.col("discount").cast("decimal(4,2)")})
    tables = {"order_details": lines,
              "orders": spark.createDataFrame([(1, 5), (2, 6)], "order_id long, customer_id long"),
              "products": spark.createDataFrame([(7, "seven"), (8, "eight")],
                                                "product_id long, product_name string")}
    found = returns.return_lines(tables)
    rows = {r["line_id"]: (r["customer_id"], r["product_name"], float(r["net_spent"]),
                           r["avg_discount_by_product"], r["is_returned"]) for r in found.collect()}
    assert rows == {"a": (5, "seven", 4.5, 0.25, 1), "b": (5, "eight", 4.0, 0.0, 0)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "product_id" in joins[0] and "order_id" in joins[1]


def test_ranks_of_a_column_share_the_first_sketch(spark, monkeypatch):
    seen, plain = [], quantiles._aggregates

    def spy(df, wanted):
        seen.append([str(c) for c in wanted])
        return plain(df, wanted)

    monkeypatch.setattr(quantiles, "_aggregates", spy)
    values = np.random.default_rng(3).normal(size=5_000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    row = quantiles.quantile_table(df, ["x"], [0.25, 0.5, 0.75], ["a", "b", "c"], 100).first()
    assert [row["a"], row["b"], row["c"]] == pytest.approx(
        np.quantile(values, [0.25, 0.5, 0.75]).tolist(), abs=0)
    assert sum("percentile_approx" in c for c in seen[1]) == 1


def test_box_plot_and_report_read_only_columns_with_values(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (2.0, None, None), (3.0, None, 2.0),
                                (90.0, None, 3.0), (None, None, None)],
                               "x double, none double, z double")
    box = {r["column"]: r for r in quality.boxplot_stats(df, ["x", "none", "z"]).collect()}
    assert set(box) == {"x", "z"}
    assert (box["x"]["q1"], box["x"]["median"], box["x"]["q3"]) == (1.75, 2.5, 24.75)
    assert (box["x"]["whisker_low"], box["x"]["whisker_high"], box["x"]["n_fliers"]) == (1, 3, 1)
    told = {r["column"]: r for r in quality.outlier_report(df, ["x", "none", "z"]).collect()}
    assert (told["x"]["n_outliers"], told["x"]["pct_outliers"]) == (1, 20.0)
    assert told["z"]["n_outliers"] == 0
    stats = {r["column"]: r for r in quality.describe_numeric(df, ["x", "none", "z"]).collect()}
    assert set(stats) == {"x", "z"}
    assert (stats["z"]["count"], stats["z"]["mean"], stats["z"]["max"]) == (3, 2.0, 3.0)


def test_reach_is_judged_in_small_blocks():
    """What one step holds: its rows times all coordinates of the boxes."""
    low = np.zeros((256, 6))
    x, sizes = np.ones((4_000, 6)), []
    for row, _ in neighbors._within_reach(x, np.full(4_000, 9.0), low, low + 1):
        sizes.append(len(np.unique(row)) * low.size)
    assert max(sizes) <= 1_000_000 and neighbors.QUERIES_PER_GROUP <= 5_000


def test_copies_of_customers_grow_with_the_tables():
    def copies(n):
        customers, products, categories = 90_000 * n, 120_000 * n, 25
        edge = recommend._cell_edge(customers * products)
        blocks = -(-products // categories // (recommend.PRODUCTS_PER_BLOCK * edge))
        return customers * categories * blocks

    assert recommend._cell_edge(15_000 * 20_000) == 1
    assert copies(60) <= 6 * 1.3 * copies(10)


def test_rows_above_the_floor_hold_the_best(spark):
    rng = np.random.default_rng(5)
    rows = [(c, p, int(p % 3 == 0), float(s)) for c in (1, 2) for p, s in
            enumerate(np.round(rng.random(2_000), 2 if c == 1 else 9))]
    rows += [(3, p, 0, s) for p, s in enumerate([None, float("nan"), 0.5, 0.5, None, 0.5, 0.1])]
    rows += [(None, p, 0, s) for p, s in enumerate([0.3, None, 0.2])]
    scored = spark.createDataFrame(
        rows, "customer_id long, product_id long, purchased int, purchase_probability double")
    left = recommend.above_floor(scored, 4)
    keys = ["customer_id", "product_id", "rank"]
    got, want = (sorted(map(str, recommend.top_k_per_customer(df, 4).select(*keys).collect()))
                 for df in (left, scored))
    assert got == want
    assert left.where("customer_id = 2").count() <= 40


def odd_shop(spark):
    """Customers, products and sales with ties, NULLs, prices below 0 and rows that come twice."""
    rng = np.random.default_rng(11)
    cents = lambda x: None if x is None else Decimal(str(round(float(x), 2)))
    products = [(p, f"p{p}", p % 3 + 1, float(rng.integers(1, 40)), int(p % 2)) for p in range(240)]
    products += [(300, "none", 1, None, 0), (301, "below", 2, -500.0, 0), (302, "small", 4, 3.0, 0),
                 (303, "nan", 1, float("nan"), 0), (304, "alone", 9, 1.0, 0), products[0], products[7]]
    customers = [(c, "TR", "Izmir") for c in range(40)] + [(3, "TR", "Izmir"), (99, "TR", "Izmir")]
    orders_ = [(o, int(rng.integers(0, 40)), dt.date(1998, 1, 1 + o % 28)) for o in range(160)]
    orders_ += [(900, 90, dt.date(1998, 1, 1))]
    lines = [(f"l{i}", int(rng.integers(0, 160)), int(rng.zipf(1.4)) % 240,
              cents(rng.integers(1, 30)), int(rng.integers(1, 5)), cents(0.1)) for i in range(700)]
    of = {o: c for o, c, _ in orders_}
    # One customer pays below 0 on average, one has no price, one spends nothing.
    price = {1: Decimal("-7.77"), 2: None, 4: Decimal("0.00")}
    lines = [(i, o, p, price.get(of[o], x), q, d) for i, o, p, x, q, d in lines]
    lines += [("x", 0, 301, cents(5), 1, cents(0)), ("y", 0, None, cents(5), 1, cents(0))]
    rows = {"customers": customers, "products": products, "orders": orders_, "order_details": lines,
            "categories": [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]}
    schemas = base_schemas(T.LongType())
    return {name: spark.createDataFrame(data, schemas[name]) for name, data in rows.items()}


def test_contenders_hold_the_best_of_the_whole_grid(spark, monkeypatch, k=4):
    import __spark_entry__ as registered
    tables = odd_shop(spark)
    known = recommend.summarize(tables)
    score = registered._closed_form_score
    monkeypatch.setattr(recommend, "LEADER_CHUNK", 50)
    monkeypatch.setattr(recommend, "LEADER_BLOCK", 7)
    monkeypatch.setattr(recommend, "CUSTOMERS_PER_BLOCK", 9)
    monkeypatch.setattr(recommend, "PRODUCTS_PER_BLOCK", 11)
    within = recommend.contenders(tables, known, score, registered.CLOSED_FORM_ORDER, k)
    assert [r[0] for r in within.whole.collect()] == [1]
    part, grid = (score(recommend.recommend_features(tables, known=known, within=w))
                  for w in (within, None))
    everything = sorted(map(str, grid.select(*sorted(grid.columns)).collect()))
    assert set(map(str, part.select(*sorted(grid.columns)).collect())) <= set(everything)
    assert part.where("customer_id <> 1").count() < grid.where("customer_id <> 1").count() / 3
    keys = ["customer_id", "product_id", "rank", "purchase_probability", "purchased"]
    got, want = (sorted(map(str, recommend.top_k_per_customer(df, k).select(*keys).collect()))
                 for df in (part, grid))
    assert got == want and len(want) == k * known.customers.count()


def test_additive_scores_are_attributed_without_growing(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", float(rng.normal()), float(rng.integers(0, 3)), float(i)) for i in range(30)]
    odd = [("null", None, 1.0, 2.0), ("nan", float("nan"), 1.0, 2.0), ("inf", 1.0, float("inf"), 2.0)]
    cols = ["x", "y", "z"]
    df = spark.createDataFrame(rows + odd, "key string, x double, y double, z double")
    score = explain.AdditiveScore({"x": F.col("x") * F.col("x"), "z": F.col("z") * F.lit(-0.5)})

    def values(fn, background):
        found = explain.shapley_values(fn, df, cols, background, "key")
        return found, {(r["key"], r["feature"]): r["value"] for r in found.collect()}

    for background in (df.where("key < 'k2'"), df.where("key < 'k2' or key = 'null'")):
        found, got = values(score, background)
        _, want = values(lambda d: score(d), background)
        assert got.keys() == want.keys() and len(got) == 3 * (len(rows) + len(odd))
        for at, value in want.items():
            assert got[at] == pytest.approx(value, abs=1e-9, nan_ok=True), at
    plain = explain.shapley_values(score, df.where("x < 9 and y < 9"), cols,
                                   df.where("key < 'k2'"), "key")
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_each_score_is_written_out_once(spark):
    scored = spark.range(200).select((F.col("id") % 2).alias("label"),
                                     (F.col("id") * 0.37 % 1.0).alias("score"))
    auc = metrics.roc_auc(scored)
    plan = auc._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string(") == 1 and plan.count("regexp") == 2
    assert 0 <= auc.first()["value"] <= 1
