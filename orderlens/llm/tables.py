"""Work tables between the stages of an operator."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources import materialize

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared work folder and read back. The shuffle files behind it
    are removed as soon as the table stands, so stages don't add up on the executors' disks.
    ``batch_rows`` bounds the rows that a Python task is handed at a time."""
    values = {_CLEANUP: "true"} | ({} if batch_rows is None else {_BATCH: str(batch_rows)})
    with _settings(df.sparkSession, values):
        return materialize(df, name)
