"""Review files that keep arriving: the batch projection and business filter on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palate.operators.cohort import cohort_reviews
from palate.sources.jsonl import typed_reviews
from palate.sources.schemas import REVIEW


def stream_cohort_reviews(spark: SparkSession, folder: str, businesses: DataFrame) -> DataFrame:
    """Streaming version of load_reviews + cohort_reviews; stateless, so no watermark is needed."""
    raw = spark.readStream.schema(REVIEW).json(folder)
    return cohort_reviews(typed_reviews(raw), businesses)


def append_interactions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all files present now and stop; the checkpoint makes reruns pick up only new files."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
