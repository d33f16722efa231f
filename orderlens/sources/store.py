"""Writing and reading back: work tables, recommendation CSV, scaled splits, models."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would lose its files with the executor that wrote them.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = spark.conf.get("orderlens.local.work.dir", None)
    if not own:
        own = tempfile.mkdtemp(prefix="orderlens-")
        spark.conf.set("orderlens.local.work.dir", own)
    return own


def new_work_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a shared work table and read it back, so that iterative work
    neither recomputes the plan behind it nor loses it with an executor. Work tables stay
    until the work folder is cleared, as returned frames may still read them."""
    path = new_work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_recommendations_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)


def read_recommendations_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def customer_bucket(customer: Column, buckets: Column) -> Column:
    """The folder of a customer among ``buckets``."""
    return F.pmod(F.xxhash64(customer), buckets).cast("int")


def write_recommendations(df: DataFrame, path: str, buckets: int = 64) -> None:
    """Save recommendations for lookups, one folder per bucket of customers and in it sorted by
    customer, so that a lookup opens the files of its buckets and reads the row groups of its
    customers. The number of buckets is a folder level too, so a reader finds it in the path."""
    of = customer_bucket(F.col("customer_id"), F.lit(buckets))
    placed = df.withColumns({"buckets": F.lit(buckets), "bucket": of})
    (placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "customer_id")
     .write.mode("overwrite").partitionBy("buckets", "bucket").parquet(path))


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """Save scaled features and labels, one folder per split, so that reading one side
    prunes the other."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str | None = None,
               split: str = "split") -> DataFrame:
    df = spark.read.parquet(path)
    return df if name is None else df.where(df[split] == name)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
