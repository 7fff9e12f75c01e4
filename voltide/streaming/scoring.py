"""A stream scored with the model that the registry names at the time.

``foreachBatch`` asks the registry once for each micro-batch and loads the model if its version is not the one at
hand, so a promotion takes effect with the next micro-batch. The scores of a micro-batch are the partition
``batch=<id>`` of the target, written by dynamic overwrite: a batch that was killed half-way and comes again
replaces what it left, and every input row is scored once. Which version a batch was scored with is noted before it
is written, so a repeated batch takes the same version even if another was promoted in between.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.operators.models import fill_numeric
from voltide.operators.registry import Registry
from voltide.sources.put_once import numbered, put_if_absent, records
from voltide.streaming.jobs import score_rows


class RegisteredScorer:
    """The body of ``foreachBatch``."""

    def __init__(self, registry: Registry, name: str, target: str, *, text: str, numeric=(), keep=()):
        self.registry, self.name, self.target = registry, name, target.rstrip("/")
        self.text, self.numeric, self.keep = text, list(numeric), list(keep)
        self.version: int | None = None
        self.model: PipelineModel | None = None
        self.loads = 0

    def version_of(self, batch_id: int) -> tuple[int, str]:
        """The version of a batch: what the registry names, or what the batch was begun with."""
        spark, folder = self.registry.spark, f"{self.target}/versions"
        version, path = self.registry.current(self.name)
        if not put_if_absent(spark, numbered(folder, batch_id), {"version": version, "path": path}):
            begun = records(spark, folder)[batch_id]
            version, path = begun["version"], begun["path"]
        return version, path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        version, path = self.version_of(batch_id)
        if version != self.version:
            self.model, self.version, self.loads = PipelineModel.load(path), version, self.loads + 1
        rows = fill_numeric(batch, self.numeric)
        scored = score_rows(rows, text=self.text, model=self.model, version=str(version))
        kept = scored.select(*self.keep, "prediction_probability", "prediction_class", "confidence_level", "model_version")
        stamped = kept.withColumn("batch", F.lit(batch_id).cast("bigint"))
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.target}/data")


def score_stream(stream: DataFrame, scorer: RegisteredScorer, *, available_now: bool = True, interval: str = "10 seconds"):
    """Start the stream; with ``available_now`` it ends with what its source holds, otherwise it goes on."""
    writer = stream.writeStream.foreachBatch(scorer).option("checkpointLocation", f"{scorer.target}/state")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def scored(scorer: RegisteredScorer) -> DataFrame:
    """The scores written so far."""
    return scorer.registry.spark.read.parquet(f"{scorer.target}/data")
