"""Score request files as they arrive: the stateless transform of batch scoring on a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..plans.jobs import score_returns
from ..sources.tables import SCORE_REQUEST_SCHEMA


def read_requests(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A stream of JSON requests, one object per line, from a folder."""
    return (spark.readStream.schema(SCORE_REQUEST_SCHEMA)
            .option("maxFilesPerTrigger", max_files).json(path))


def score_request_stream(model: PipelineModel, requests: DataFrame, out: str, checkpoint: str,
                         threshold: float = 0.3) -> StreamingQuery:
    """Append the scores of all requests waiting now to a Parquet folder, then stop; run it
    again for later ones. The checkpoint keeps every request from being scored twice."""
    return (score_returns(model, requests, threshold).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
