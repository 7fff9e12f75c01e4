"""Structured Streaming forms of scoring, voting and rule checks.

Each function maps a streaming (or batch) frame to another one; ``run_available`` drives a query
over what the source holds now, with its checkpoint in the shared folder. The windowed jobs use the
same aggregates as their batch forms below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.functions.scalars import class_threshold, confidence_band, keyword_score
from voltide.operators.ordering import scratch_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, *, glob: str | None = None, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need a TIMESTAMP; zone-free times are read in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def score_rows(df: DataFrame, *, text: str, model=None, version: str = "rules", asof: Column | None = None) -> DataFrame:
    """The online response per headline, by a fitted pipeline or by the keyword score, stamped with ``asof`` if given."""
    if model is None:
        scored = df.withColumn("_p", keyword_score(text))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(df).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(
        *df.columns,
        F.round("_p", 4).alias("prediction_probability"),
        class_threshold("_p", inclusive=True).alias("prediction_class"),
        confidence_band("_p").alias("confidence_level"),
        F.lit(version).alias("model_version"),
        *([asof.alias("timestamp")] if asof is not None else []),
    )


def tumbling_vote(df: DataFrame, *, ts: str = "ts", proba: str = "p", width: str = "1 day") -> DataFrame:
    """The daily vote over tumbling event-time windows."""
    agg = df.groupBy(F.window(ts, width).alias("_w")).agg(
        F.count(F.lit(1)).alias("num_headlines"),
        F.avg(proba).alias("prediction_mean_proba"),
        F.sum(class_threshold(proba)).alias("_votes"),
        F.max(proba).alias("prediction_max_proba"),
    )
    return agg.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        "num_headlines",
        "prediction_mean_proba",
        class_threshold("prediction_mean_proba").alias("prediction_mean_class"),
        (F.col("_votes") >= F.col("num_headlines") / 2).cast("int").alias("prediction_majority_vote"),
        "prediction_max_proba",
        class_threshold("prediction_max_proba").alias("prediction_max_class"),
    )


def sliding_breach(df: DataFrame, *, ts: str = "ts", by: Sequence[str], breach: Column, width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Values and breaches per sliding window and metric.

    ``width`` is a multiple of ``slide``: rows first collapse to one per (slide, metric), and only
    those cells are copied into the overlapping windows.
    """
    cells = df.groupBy(F.window(ts, slide).alias("_cell"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce(breach.cast("bigint"), F.lit(0))).alias("b"),
    )
    agg = cells.groupBy(F.window("_cell", width, slide).alias("_w"), *by).agg(
        F.sum("n").alias("n_values"),
        F.sum("b").alias("n_breaches"),
    )
    return agg.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by, "n_values", "n_breaches")


def stream_daily_vote(stream: DataFrame, *, ts: str = "ts", proba: str = "p", delay: str = "1 hour") -> DataFrame:
    """Append mode: a day appears once the watermark has passed its end; later rows are dropped."""
    return tumbling_vote(event_time(stream, ts).withWatermark(ts, delay), ts=ts, proba=proba)


def stream_metric_breach(stream: DataFrame, *, ts: str = "ts", by: Sequence[str], breach: Column, delay: str = "10 minutes") -> DataFrame:
    return sliding_breach(event_time(stream, ts).withWatermark(ts, delay), ts=ts, by=by, breach=breach)


def run_available(df: DataFrame, name: str, *, mode: str = "append", target: str | None = None) -> str:
    """Run a streaming frame over all available input into a parquet table; returns its path."""
    spark = df.sparkSession
    target = target or scratch_path(spark, name)
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{target}/data")
        .option("checkpointLocation", f"{target}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{target}/data"
