"""Base tables: schemas, loading from Parquet or JDBC, and the adapter for the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]


def base_schemas(customer_id_type: T.DataType = T.StringType()) -> dict[str, T.StructType]:
    """Schemas of the five base tables.

    Keys: customers.customer_id, orders.order_id, products.product_id and
    categories.category_id are unique; ``order_details.line_id`` is unique per line.
    """
    def field(name: str, dtype: T.DataType) -> T.StructField:
        return T.StructField(name, dtype)

    return {
        "customers": T.StructType([
            field("customer_id", customer_id_type),
            field("country", T.StringType()),
            field("city", T.StringType()),
        ]),
        "orders": T.StructType([
            field("order_id", customer_id_type),
            field("customer_id", customer_id_type),
            field("order_date", T.DateType()),
        ]),
        "order_details": T.StructType([
            field("line_id", T.StringType()),
            field("order_id", customer_id_type),
            field("product_id", customer_id_type),
            field("unit_price", T.DecimalType(12, 2)),
            field("quantity", T.IntegerType()),
            field("discount", T.DecimalType(4, 2)),
        ]),
        "products": T.StructType([
            field("product_id", customer_id_type),
            field("product_name", T.StringType()),
            field("category_id", T.IntegerType()),
            field("unit_price", T.DoubleType()),
            field("discontinued", T.IntegerType()),
        ]),
        "categories": T.StructType([
            field("category_id", T.IntegerType()),
            field("category_name", T.StringType()),
        ]),
    }


SCORE_REQUEST_SCHEMA = T.StructType([
    T.StructField(name, T.DoubleType())
    for name in ("quantity", "unit_price", "discount", "net_spent",
                 "avg_discount_by_product", "avg_net_spent_by_product")
])


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 bounds: tuple | None = None, num_partitions: int = 64,
                 fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of one JDBC read. Without a partition column Spark reads the table in a
    single task, so large tables should name a numeric or date column and its bounds."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned JDBC read needs bounds=(lower, upper)")
        options.update(partitionColumn=partition_column, lowerBound=str(bounds[0]),
                       upperBound=str(bounds[1]), numPartitions=str(num_partitions))
    return options


def load_tables(spark: SparkSession, source: str | dict[str, dict[str, str]],
                customer_id_type: T.DataType = T.StringType()) -> Tables:
    """Load the base tables from a folder of Parquet tables (a path) or over JDBC (a dict of
    ``jdbc_options`` per table)."""
    schemas = base_schemas(customer_id_type)
    if isinstance(source, str):
        root = source.rstrip("/")
        return {name: spark.read.schema(schema).parquet(f"{root}/{name}.parquet")
                for name, schema in schemas.items()}
    tables = {}
    for name, schema in schemas.items():
        raw = spark.read.format("jdbc").options(**source[name]).load()
        if name == "order_details" and "line_id" not in raw.columns:
            raw = raw.withColumn("line_id", F.concat_ws("-", "order_id", "product_id"))
        tables[name] = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                    for f in schema.fields])
    return tables


def tables_from_star_schema(spark: SparkSession, sf_dir: str) -> Tables:
    """The base tables, derived from the star-schema test tables (see FIXTURES.md)."""
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    nation = read("nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                   F.col("n_name").alias("country"))
    customers = read("customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), "country",
        F.col("c_mktsegment").alias("city"))
    orders = read("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"))
    # Whole cents with integer division: rounding a double quotient depends on the engine.
    unit_cents = F.expr("cast(round(l_extendedprice * 100) as bigint)"
                        " div cast(l_quantity as bigint)")
    order_details = read("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        (unit_cents * F.expr("0.01BD")).cast("decimal(12,2)").alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"))
    brand_number = F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")
    part = read("part")
    products = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        brand_number.alias("category_id"), F.col("p_retailprice").alias("unit_price"),
        F.when(F.col("p_size") % 10 == 0, 1).otherwise(0).alias("discontinued"))
    categories = part.select(brand_number.alias("category_id"),
                             F.col("p_brand").alias("category_name")).distinct()
    return {"customers": customers, "orders": orders, "order_details": order_details,
            "products": products, "categories": categories}
