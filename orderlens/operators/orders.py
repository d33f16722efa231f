"""Order-level features and reorder labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import flag, net_amount, within_days, year_quarter
from ..sources.tables import Tables

ORDER_NUMERIC = ["avg_discount", "avg_unit_price", "net_spent", "total_quantity", "total_orders"]


def order_sums(tables: Tables) -> DataFrame:
    """Exact sums of the lines of each order; one row per order that has lines."""
    return tables["order_details"].groupBy("order_id").agg(
        F.sum(net_amount()).alias("net"), F.sum("quantity").alias("quantity"),
        F.sum("discount").alias("discount"), F.sum("unit_price").alias("price"),
        F.count("*").alias("n_lines"), F.count("discount").alias("n_discount"),
        F.count("unit_price").alias("n_price"))


def customer_order_history(tables: Tables) -> DataFrame:
    """Number of orders and last order date per customer, over all orders. ``order_id`` is
    the key of orders, so a plain count is the distinct count without its second shuffle."""
    return tables["orders"].groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.max("order_date").alias("recent_order"))


def order_features(tables: Tables, since: str = "1997-05-06", fanout: bool = True,
                   ordered: bool = False) -> DataFrame:
    """One row per order since a date, with its sums and the history of its customer.

    ``fanout=True`` gives the sums of a query that joins every order of the customer again:
    each sum is multiplied by the customer's number of orders. The lines are aggregated per
    order and the orders per customer before either join, so the fan-out is a product of two
    columns and never a set of rows. ``fanout=False`` gives the true totals.
    """
    orders = tables["orders"].where(F.col("order_date") >= F.lit(since).cast("date"))
    # One row per customer first, so that orders meet customers in one join, whose skew
    # adaptive execution can split.
    customers = tables["customers"].join(customer_order_history(tables), "customer_id")
    joined = orders.join(order_sums(tables), "order_id").join(customers, "customer_id")
    times = (F.col("total_orders") if fanout else F.lit(1)).cast("decimal(10,0)")
    features = joined.select(
        "customer_id", "order_id", "order_date",
        (F.col("net") * times).cast("double").alias("net_spent"),
        (F.col("quantity") * times).cast("bigint").alias("total_quantity"),
        (F.col("discount").cast("double") / F.nullif("n_discount", F.lit(0))).alias("avg_discount"),
        (F.col("price").cast("double") / F.nullif("n_price", F.lit(0))).alias("avg_unit_price"),
        "total_orders", "recent_order", year_quarter("order_date").alias("year_quarter"),
        "country", "city")
    return features.orderBy("customer_id", "order_date", "order_id") if ordered else features


def next_order_dates(orders: DataFrame) -> DataFrame:
    """``orders`` + next_order_date, the date of the customer's following order by
    (order_date, order_id).

    A window over all orders of a customer would sort a very large customer in one task.
    All orders of a day but its last are followed by an order of the same day, so the window
    runs over the distinct days of a customer instead, a list the calendar bounds. An order
    without a customer or a date follows none and is followed by none.
    """
    placed = orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    days = placed.groupBy("customer_id", "order_date").agg(
        F.max("order_id").alias("_last_order"))
    by_day = Window.partitionBy("customer_id").orderBy("order_date")
    days = days.withColumn("_next_day", F.lead("order_date").over(by_day))
    return orders.join(days, ["customer_id", "order_date"], "left").select(
        *[orders[c] for c in orders.columns],
        F.when(orders["order_id"] < F.col("_last_order"), orders["order_date"])
        .otherwise(F.col("_next_day")).alias("next_order_date"))


def label_all_orders(orders: DataFrame, horizon_days: int = 180,
                     reliable_months: int = 6) -> DataFrame:
    """``orders`` + next_order_date, will_reorder_6m, label_is_reliable.

    The label counts days, the reliability rule calendar months. An order without a
    successor is labelled False, reliably so only if the months had passed by the last
    order date in the data.
    """
    last_date = orders.agg(F.max("order_date")).scalar()
    matured = F.add_months("order_date", reliable_months) <= last_date
    return next_order_dates(orders).withColumns({
        "will_reorder_6m": within_days(F.col("next_order_date"), F.col("order_date"),
                                       horizon_days),
        "label_is_reliable": F.col("next_order_date").isNotNull() | matured})


def reorder_labels(orders: DataFrame, horizon_days: int = 180,
                   reliable_months: int = 6) -> DataFrame:
    """The orders whose label can be trusted."""
    return label_all_orders(orders, horizon_days, reliable_months).where("label_is_reliable")


def confirmed_lapsed(labelled: DataFrame) -> DataFrame:
    """Reliable orders that were not followed in time."""
    return labelled.where(~F.col("will_reorder_6m"))


def quarter_levels(df: DataFrame, col: str = "year_quarter") -> list[str]:
    """Sorted distinct quarters: a calendar-bounded list, read once when features are learnt."""
    return [row[0] for row in df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).collect()]


def quarter_dummies(df: DataFrame, levels: list[str] | None = None,
                    col: str = "year_quarter") -> DataFrame:
    """Replace the quarter by one 0/1 column per level but the first; a quarter outside the
    learnt levels gives zeros."""
    if levels is None:
        levels = quarter_levels(df, col)
    return df.select(*[c for c in df.columns if c != col],
                     *[flag(F.col(col) == level).alias(f"{col}_{level}") for level in levels[1:]])
