"""Return-risk lines and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import exact_avg, net_amount, rule_return_flag
from ..sources.store import materialize
from ..sources.tables import Tables
from .quality import discount_spend_cells

RETURN_FEATURES = ["quantity", "unit_price", "discount", "net_spent",
                   "avg_discount_by_product", "avg_net_spent_by_product"]


def product_stats(lines: DataFrame) -> DataFrame:
    """Average discount and net amount per product, over all its lines."""
    return lines.groupBy("product_id").agg(
        exact_avg(F.col("discount")).alias("avg_discount_by_product"),
        exact_avg(net_amount()).alias("avg_net_spent_by_product"))


def line_product_stats(lines: DataFrame) -> DataFrame:
    """Every line with the averages of its product.

    Aggregating first and joining one row per product back keeps a very large product out
    of a single window partition.
    """
    return lines.join(product_stats(lines), "product_id")


def return_lines(tables: Tables, discount_min: float = 0.2, net_max: float = 200,
                 ordered: bool = False) -> DataFrame:
    """One row per line with a positive quantity: product averages (which also cover lines
    of quantity 0) and the rule label ``is_returned``.

    The label is a rule on two of the model inputs, so a model that learns it says nothing
    about real returns.
    """
    lines = tables["order_details"]
    # One join on product_id instead of two: the averages ride on the product row.
    catalogue = tables["products"].select("product_id", "product_name").join(
        product_stats(lines), "product_id")
    # Lines meet orders first and products last: what a product brings is never shuffled per line.
    sold = lines.where("quantity > 0").join(
        tables["orders"].select("order_id", "customer_id"), "order_id")
    result = (sold.join(catalogue, "product_id").withColumn("net_spent", net_amount())
              .select("line_id", "order_id", "customer_id", "product_id", "product_name",
                      "quantity", "unit_price", "discount", "net_spent",
                      "avg_discount_by_product", "avg_net_spent_by_product",
                      rule_return_flag(F.col("net_spent"), F.col("discount"),
                                       discount_min, net_max).alias("is_returned")))
    if ordered:
        result = result.orderBy(F.desc("is_returned"), "order_id", "product_id", "line_id")
    return result


def return_status_counts(lines: DataFrame, col: str = "is_returned") -> DataFrame:
    return lines.groupBy(col).agg(F.count("*").alias("n"))


def top_products(lines: DataFrame, n: int = 10) -> DataFrame:
    """The products with most lines, counted by name."""
    return (lines.groupBy("product_name").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "product_name").limit(n))


def top_returned_products(lines: DataFrame, n: int = 5) -> DataFrame:
    return top_products(lines.where("is_returned = 1"), n)


def line_counts(lines: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    """Lines per status, per cell of discount, spend and status, and of the ``n`` most frequent
    products: one pass by grouping sets, kept as a work table of one row per group."""
    keys = ["discount_bin", "spend_bin", "is_returned", "product_name"]
    cells = lines.select(*discount_spend_cells(), "is_returned", "product_name")
    # Bits of the set's number: the keys left out, first key highest.
    sets = {"status_counts": ["is_returned"], "discount_spend": keys[:3],
            "top_products": ["product_name"]}
    counted = materialize(
        cells.groupingSets([[F.col(c) for c in s] for s in sets.values()], *keys).agg(
            F.count("*").alias("n"), F.grouping_id().cast("int").alias("level")), "line-counts")

    def of(name: str) -> DataFrame:
        level = sum(8 >> i for i, c in enumerate(keys) if c not in sets[name])
        return counted.where(F.col("level") == level).select(*sets[name], "n")

    tables = {name: of(name) for name in sets}
    tables["top_products"] = tables["top_products"].orderBy(F.desc("n"), "product_name").limit(n)
    return tables


def return_summary(lines: DataFrame) -> DataFrame:
    """Lines, returned lines, their share in percent, also as text."""
    rate = F.round((F.col("return_count") * 100).cast("decimal(28,6)")
                   / F.nullif("total_orders", F.lit(0)), 1)
    return (lines.agg(F.count("*").alias("total_orders"),
                      F.coalesce(F.sum("is_returned"), F.lit(0)).alias("return_count"))
            .withColumn("return_rate_pct", rate.cast("double"))
            .withColumn("return_rate", F.format_string("%%%.1f", "return_rate_pct")))
