"""Scoring on a stream of trip requests (K4).

Structured Streaming reuses :func:`farelane.ml.scoring.score_batch` as is:
every step is stateless (row filters, stream-static broadcast joins against
the zone and calendar dimensions, ``PipelineModel.transform``), so no state
store, watermark or window is needed.  Progress is kept in the checkpoint
folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from farelane.ml.scoring import score_batch, score_schema


def read_request_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet", id_col: str = "request_id",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(score_schema(id_col)).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def score_stream(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    preprocess: PipelineModel,
    model,
    zones: DataFrame | None,
    lookup: DataFrame,
    holidays: DataFrame,
    model_name: str,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the scoring query; with ``available_now`` it drains the backlog and stops."""
    requests = read_request_stream(spark, source_dir, fmt)
    scored = score_batch(requests, preprocess, model, zones, lookup, holidays, model_name)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(sink_dir)
