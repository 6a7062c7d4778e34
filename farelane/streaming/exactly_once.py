"""Scoring a stream exactly once, with a quarantine and a model that may change while it runs (K4).

Each micro-batch is a transaction under its batch id.  The batch's scored rows
and its unreadable records are written to folders named by the id, replacing
what an earlier attempt left there, and then one commit row is appended.  A
batch whose commit row exists is skipped when it is delivered again, so after a
stop between writing and committing no request appears twice or is lost.
Readers take the folders of committed batches only.

The model is looked up once per batch, in a table of published versions, and
its version is written with every row and in the commit.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelane.ml import scoring

_COMMITS = "batch_id long, model_version long, n_scored long, n_rejected long, n_quarantined long"
_VERSIONS = "version long, preprocess string, model string, model_name string"


# ---------------------------------------------------------------- model versions
def publish_model(spark: SparkSession, registry: str, preprocess: PipelineModel, model, model_name: str) -> int:
    """Save both parts under the next version number; the version exists once its row is written."""
    version = max((v for v, *_ in _versions(spark, registry)), default=0) + 1
    places = [f"{registry}/v{version:06d}/{part}" for part in ("preprocess", "model")]
    for place, part in zip(places, (preprocess, PipelineModel([model])), strict=True):  # a pipeline loads its stages, whatever their class
        part.write().overwrite().save(place)
    spark.createDataFrame([(version, *places, model_name)], _VERSIONS).coalesce(1).write.mode("append").json(f"{registry}/versions")
    return version


def _versions(spark: SparkSession, registry: str) -> list:
    try:
        return [tuple(r) for r in spark.read.schema(_VERSIONS).json(f"{registry}/versions").collect()]  # one row per version
    except AnalysisException:
        return []


@dataclass
class Models:
    """The newest published model; loaded again only when there is a newer one."""

    spark: SparkSession
    registry: str
    version: int = 0

    def newest(self) -> tuple[int, PipelineModel, object, str]:
        found = _versions(self.spark, self.registry)
        if not found:
            raise RuntimeError(f"no model is published under {self.registry}")
        version, preprocess, model, name = max(found)
        if version != self.version:
            self.loaded = (PipelineModel.load(preprocess), PipelineModel.load(model), name)
            self.version = version
        return (version, *self.loaded)


# ---------------------------------------------------------------- records
def split_records(raw: DataFrame, col: str = "value", id_col: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """(requests, quarantine) of JSON text.

    A record that is no JSON object, or has a field of the wrong type, or no
    id, cannot be answered: it goes to quarantine as it came, with a reason.
    A record with missing fields is a request, and is rejected by the scorer.
    """
    bad = "_bad"
    schema = scoring.score_schema(id_col).add(bad, "string")
    parsed = raw.select(F.col(col).cast("string").alias("record"), F.from_json(F.col(col).cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}).alias("r"))
    reason = (
        F.when(F.col("record").isNull(), "no record")
        .when(F.col("r").isNull() | F.col(f"r.{bad}").isNotNull(), "malformed record")
        .when(F.col(f"r.{id_col}").isNull(), f"no {id_col}")
    )
    judged = parsed.withColumn("reason", reason)
    requests = judged.filter("reason is null").select("r.*").drop(bad)
    return requests, judged.filter("reason is not null").select("record", "reason")


# ---------------------------------------------------------------- the query
class BatchScorer:
    """Scores one micro-batch as a transaction; an instance is passed to ``foreachBatch``."""

    def __init__(self, spark: SparkSession, sink: str, registry: str, zones: DataFrame | None, lookup: DataFrame, holidays: DataFrame, id_col: str = "request_id"):
        self.spark, self.sink, self.models = spark, sink, Models(spark, registry)
        self.dims, self.id_col = (zones, lookup, holidays), id_col

    def committed(self) -> dict[int, int]:
        """Batch id -> model version of all committed batches."""
        try:
            rows = self.spark.read.schema(_COMMITS).json(f"{self.sink}/commits").select("batch_id", "model_version").collect()  # one row per batch
        except AnalysisException:
            return {}
        return {r["batch_id"]: r["model_version"] for r in rows}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id in self.committed():
            return
        version, preprocess, model, name = self.models.newest()
        requests, quarantine = split_records(batch, id_col=self.id_col)
        zones, lookup, holidays = self.dims
        scored = scoring.score_batch(requests, preprocess, model, zones, lookup, holidays, name, self.id_col).withColumn("model_version", F.lit(version).cast("long"))
        scored.write.mode("overwrite").parquet(f"{self.sink}/scored/batch={batch_id:012d}")
        quarantine.write.mode("overwrite").parquet(f"{self.sink}/quarantine/batch={batch_id:012d}")
        done = self.spark.read.parquet(f"{self.sink}/scored/batch={batch_id:012d}").agg(F.count_if(F.col("status") == "ok"), F.count_if(F.col("status") != "ok")).first()
        n_bad = self.spark.read.parquet(f"{self.sink}/quarantine/batch={batch_id:012d}").count()
        self.commit((batch_id, version, done[0], done[1], n_bad))

    def commit(self, row: tuple) -> None:
        self.spark.createDataFrame([row], _COMMITS).coalesce(1).write.mode("append").json(f"{self.sink}/commits")


def score_stream_exactly_once(
    spark: SparkSession,
    source_dir: str,
    sink: str,
    checkpoint_dir: str,
    registry: str,
    zones: DataFrame | None,
    lookup: DataFrame,
    holidays: DataFrame,
    id_col: str = "request_id",
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    scorer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start scoring JSON text files; without ``processing_time`` the backlog is drained and the query stops."""
    reader = spark.readStream.schema("value string").format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.load(source_dir).writeStream.foreachBatch(scorer or BatchScorer(spark, sink, registry, zones, lookup, holidays, id_col)).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def read_committed(spark: SparkSession, sink: str, kind: str = "scored") -> DataFrame:
    """The ``scored`` or ``quarantine`` rows of committed batches, with ``batch``."""
    batches = sorted(BatchScorer(spark, sink, "", None, None, None).committed())
    if not batches:
        raise ValueError(f"no batch is committed under {sink}")
    return spark.read.option("basePath", f"{sink}/{kind}").parquet(*[f"{sink}/{kind}/batch={b:012d}" for b in batches])
