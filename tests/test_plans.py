"""Plans as a cluster would see them: nothing small enough to broadcast by itself."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens.operators import metrics, orders, recommend, returns
from orderlens.sources import (read_recommendations, tables_from_star_schema,
                               write_recommendations)

from .oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    yield spark
    spark.conf.set(conf, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["order_features", "reorder_labels", "return_lines",
                                 "recommend_grid", "recommend_features", "top_k_per_customer",
                                 "outlier_report", "class_weights", "standard_scale"])
def test_no_product_of_tables_and_same_rows(no_broadcast, key):
    df = entry.queries()[key](no_broadcast, SF_DIR)
    assert not re.search("CartesianProduct|NestedLoopJoin", plan(df))
    assert compare(df, connect(SF_DIR), entry.oracle_sql()[key]) is None


def test_filters_and_columns_reach_the_scan(no_broadcast):
    tables = tables_from_star_schema(no_broadcast, SF_DIR)
    text = plan(orders.order_features(tables))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(o_orderdate,1997-05-06", text)
    stats = plan(returns.product_stats(tables["order_details"]))
    assert set(re.search(r"ReadSchema: struct<([^>]*)>", stats).group(1).split(",")) == {
        "l_partkey:bigint", "l_quantity:double", "l_extendedprice:double", "l_discount:double"}


def test_lines_are_shuffled_once_for_order_features(no_broadcast):
    """Aggregated before the shuffle, and joined where the aggregation left them."""
    tables = tables_from_star_schema(no_broadcast, SF_DIR)
    text = plan(orders.order_features(tables))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", text)) == 2   # sums and orders


def test_top_k_is_cut_before_its_shuffle(no_broadcast):
    df = no_broadcast.createDataFrame(
        [(1, 1, 0, 0.5)], "customer_id long, product_id long, purchased int, purchase_probability double")
    text = plan(recommend.top_k_per_customer(df))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_stored_lookup_reads_its_buckets_only(spark, tmp_path):
    top = spark.range(2000).selectExpr(
        "concat('C', id div 5) as customer_id", "id as product_id", "'tea' as category_name",
        "id % 5 / 5D as purchase_probability")
    write_recommendations(top, str(tmp_path / "top"), 16)
    stored = read_recommendations(spark, str(tmp_path / "top"))
    one = recommend.recommend_lookup(stored, "C17")
    assert [r["product_id"] for r in one.collect()] == [89, 88, 87, 86, 85]
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", scan)
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(customer_id,C17\)", scan)
    keys = spark.createDataFrame([("C3",), ("C17",), ("C17",), ("nobody",), (None,)], "customer_id string")
    several = recommend.recommend_lookup(stored, keys)
    plain = recommend.recommend_lookup(top, keys)
    assert several.collect() == plain.collect() and several.count() == 10
    assert recommend.recommend_lookup(stored, "nobody").count() == 0


def test_auc_runs_nothing_until_it_is_read(spark):
    broken = spark.range(4).selectExpr("raise_error('read') as score", "1 as label")
    text = plan(metrics.roc_auc(broken.selectExpr("cast(score as double) as score", "label")))
    assert "SinglePartition" in text and not re.search(r"rangepartitioning", text)


def test_grid_is_not_shuffled(no_broadcast):
    """Above the join of its two sides the grid has no exchange."""
    tables = tables_from_star_schema(no_broadcast, SF_DIR)
    text = plan(recommend.recommend_grid(tables))
    assert "Exchange" not in text[:text.index("SortMergeJoin")]
