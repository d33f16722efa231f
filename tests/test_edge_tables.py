"""Branches the generated tables lack, against results worked out by hand (FIXTURES.md)."""

import datetime as dt

import pytest

from orderlens.operators import orders, quality, recommend, returns
from orderlens.plans import jobs

from .fixtures import edge_tables


@pytest.fixture(scope="module")
def tables(spark):
    return edge_tables(spark)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_order_features_fan_out(tables):
    got = rows(orders.order_features(tables), "order_id", "net_spent", "total_quantity",
               "avg_discount", "avg_unit_price", "total_orders", "recent_order", "year_quarter")
    d = dt.date
    assert got == [
        ("O1", 310, 28, 0.125, 15, 4, d(1998, 4, 1), "1997Q2"),
        ("O2", 1280, 160, 0.2, 10, 4, d(1998, 4, 1), "1997Q3"),
        ("O3", 72, 4, 0.1, 20, 4, d(1998, 4, 1), "1998Q2"),
        ("O5", 0, 0, 0.5, 20, 2, d(1998, 5, 6), "1998Q2"),
        ("O7", 0, 3, 0, 0, 1, d(1997, 7, 1), "1997Q3")]


def test_order_features_true_totals(tables):
    got = rows(orders.order_features(tables, fanout=False), "order_id", "net_spent",
               "total_quantity")
    assert got == [("O1", 77.5, 7), ("O2", 320, 40), ("O3", 18, 1), ("O5", 0, 0), ("O7", 0, 3)]


def test_order_features_sorted(tables):
    got = [r["order_id"] for r in orders.order_features(tables, ordered=True).collect()]
    assert got == ["O1", "O2", "O3", "O5", "O7"]


def test_reorder_labels(tables):
    labelled = orders.reorder_labels(orders.order_features(tables))
    assert rows(labelled, "order_id", "will_reorder_6m") == [
        ("O1", True), ("O2", False), ("O7", False)]
    assert rows(orders.confirmed_lapsed(labelled), "order_id") == [("O2",), ("O7",)]


def test_quarter_dummies(tables):
    features = orders.order_features(tables)
    got = orders.quarter_dummies(features)
    assert [c for c in got.columns if c.startswith("year_quarter")] == [
        "year_quarter_1997Q3", "year_quarter_1998Q2"]
    unseen = orders.quarter_dummies(features, levels=["1990Q1", "1990Q2"])
    assert {r["year_quarter_1990Q2"] for r in unseen.collect()} == {0}


def test_product_stats_and_lines(tables):
    stats = rows(returns.product_stats(tables["order_details"]), "product_id",
                 "avg_discount_by_product", "avg_net_spent_by_product")
    assert [s[0] for s in stats] == ["P1", "P2", "P3"]
    assert [s[1] for s in stats] == pytest.approx([0.15, 0.2, 0])
    assert [s[2] for s in stats] == pytest.approx([122.5, 58 / 3, 0])
    lines = returns.return_lines(tables)
    assert [r[0] for r in rows(lines, "line_id", "is_returned") if r[1]] == ["O1-P1"]
    summary = returns.return_summary(lines).first()
    assert (summary["total_orders"], summary["return_count"], summary["return_rate_pct"],
            summary["return_rate"]) == (6, 1, 16.7, "%16.7")
    assert rows(returns.top_returned_products(lines), "product_name", "n") == [("chai", 1)]
    first = returns.return_lines(tables, ordered=True).first()
    assert first["line_id"] == "O1-P1"


def test_return_summary_of_nothing(tables):
    lines = returns.return_lines(tables).where("1 = 0")
    summary = returns.return_summary(lines).first()
    assert (summary["total_orders"], summary["return_count"]) == (0, 0)
    assert summary["return_rate_pct"] is None


def test_summaries(tables):
    assert rows(recommend.customer_summary(tables), "customer_id", "customer_orders",
                "customer_spend", "customer_avg_price") == [
        ("C1", 3, 415.5, 15), ("C2", 2, 10, 15), ("C4", 1, 0, 0)]
    assert rows(recommend.product_popularity(tables), "product_id", "product_orders",
                "product_buyers") == [("P1", 3, 2), ("P2", 3, 2), ("P3", 1, 1), ("P4", 0, 0)]
    assert rows(recommend.purchased_pairs(tables), "customer_id", "product_id") == [
        ("C1", "P1"), ("C1", "P2"), ("C2", "P1"), ("C2", "P2"), ("C4", "P3")]


def test_grid(tables):
    grid = {(r["customer_id"], r["product_id"]): r
            for r in recommend.recommend_grid(tables, ordered=True).collect()}
    assert len(grid) == 16
    first = grid["C1", "P1"]
    assert (first["category_spend"], first["category_spend_share"], first["price_ratio"],
            first["purchased"]) == (415.5, 1.0, 0.67, 1)
    free = grid["C4", "P3"]
    assert free["category_spend_share"] is None and free["price_ratio"] is None
    assert grid["C3", "P1"]["customer_orders"] is None
    assert grid["C1", "P4"]["product_orders"] == 0 and grid["C1", "P3"]["purchased"] == 0


def test_grid_of_candidates_equals_the_full_grid(tables):
    full = recommend.recommend_grid(tables)
    pairs = full.select("customer_id", "product_id")
    some = recommend.recommend_grid(tables, candidates=pairs)
    cols = recommend.GRID_COLUMNS
    assert sorted(map(str, full.select(*cols).collect())) == sorted(
        map(str, some.select(*cols).collect()))


def test_grid_with_tiny_blocks(tables, monkeypatch):
    want = sorted(map(str, recommend.recommend_grid(tables).collect()))
    monkeypatch.setattr(recommend, "CUSTOMERS_PER_BLOCK", 1)
    monkeypatch.setattr(recommend, "PRODUCTS_PER_BLOCK", 1)
    assert sorted(map(str, recommend.recommend_grid(tables).collect())) == want


def test_recommend_features(tables):
    got = recommend.recommend_features(tables).collect()
    assert len(got) == 12
    assert {(r["customer_id"], r["recency_days"]) for r in got} == {("C1", 35), ("C2", 0), ("C4", 309)}
    recency = {(r["customer_id"], r["category_id"]): r["category_recency_days"] for r in got}
    assert recency["C1", 2] == 309 and recency["C4", 1] == 309 and recency["C1", 1] == 35


def test_outlier_customers_and_profile(tables):
    features = orders.order_features(tables)
    profile = {r["column"]: r for r in quality.table_profile(features).collect()}
    assert profile["net_spent"]["type"] == "double" and profile["net_spent"]["n_rows"] == 5
    assert rows(quality.outlier_customers(features), "customer_id", "n_outlier_orders") == [("C1", 1)]


def test_recommend_lookup_and_precision(spark, tables):
    from pyspark.sql import functions as F
    scored = recommend.recommend_features(tables).withColumn(
        "purchase_probability", F.col("product_price") / 100)
    top = recommend.recommend_top(scored, tables, k=2)
    assert [(r["product_id"]) for r in recommend.recommend_lookup(top, "C1").collect()] == ["P2", "P1"]
    assert recommend.recommend_lookup(top, "nobody").count() == 0
    # C1 and C2 bought both of their first two, C4 neither.
    assert recommend.precision_at_k(scored, 2).first()[0] == pytest.approx(4 / 6)
    # Four rows per customer, still divided by five.
    assert recommend.precision_at_k(scored, 5).first()[0] == pytest.approx(5 / 15)
    unbought = recommend.recommend_top(scored, tables, k=5, exclude_purchased=True)
    assert {r["purchased"] for r in unbought.collect()} == {0}


def test_eda_report_runs(tables):
    report = jobs.eda_report(returns.return_lines(tables))
    assert {name: df.count() for name, df in report.items()} == {
        "preview": 5, "profile": 12, "describe": 6, "outliers": 6, "boxplots": 6,
        "status_counts": 2, "discount_spend": 4, "top_products": 3}


def test_eda_report_reads_its_lines_once(spark, tables):
    """Rows that pass a counting function on the way, after all tables were made and read."""
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    lines = returns.return_lines(tables)
    report = jobs.eda_report(lines.mapInPandas(counting, lines.schema))
    for df in report.values():
        df.collect()
    assert passed.value == lines.count() > 0


def test_eda_report_equals_its_parts(tables):
    lines = returns.return_lines(tables)
    report = jobs.eda_report(lines)
    cols = ["net_spent", "quantity", "discount", "unit_price",
            "avg_discount_by_product", "avg_net_spent_by_product"]
    parts = {"profile": quality.table_profile(lines),
             "outliers": quality.outlier_report(lines, cols),
             "boxplots": quality.boxplot_stats(lines, cols),
             "status_counts": returns.return_status_counts(lines),
             "discount_spend": quality.discount_spend_bins(lines),
             "top_products": returns.top_products(lines)}
    for name, part in parts.items():
        assert sorted(map(str, report[name].collect())) == sorted(map(str, part.collect())), name


@pytest.mark.parametrize("kept", [0, 1])
def test_eda_report_of_few_lines(tables, kept):
    report = jobs.eda_report(returns.return_lines(tables).limit(kept))
    assert [r["n_rows"] for r in report["profile"].collect()] == [kept] * 12
    assert report["describe"].count() == report["boxplots"].count() == 6 * kept
    assert report["top_products"].count() == report["status_counts"].count() == kept
