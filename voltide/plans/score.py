"""Scoring job: load the registered model, score the chosen day (or all days), save by day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators import models as ML
from voltide.operators.ordering import checkpointed
from voltide.operators.reshape import day_slice_with_fallback
from voltide.sources.tables import sink_predictions_by_day


def scoring_job(
    spark: SparkSession,
    tall: DataFrame,
    *,
    registry: str,
    name: str,
    target: Date | None,
    at: datetime,
    path: str,
    day: str = "date",
    label: str = "vol_up",
    order: str,
    numeric: Sequence[str] = (),
) -> DataFrame:
    """Daily predictions, also written with the detailed rows below ``path``. ``target=None`` scores
    every day of ``tall`` in the same job."""
    model, version = ML.load_registered(spark, registry, name=name)
    rows = tall if target is None else day_slice_with_fallback(tall, date=day, target=target)
    stamp = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    daily, detailed = ML.score_days(rows, model, day=day, label=label, order=order, version=str(version), asof=stamp, numeric=numeric)
    scored = checkpointed(detailed)  # both outputs read the scores, which are computed once
    votes = ML.daily_vote(scored, day=day, proba="prediction_proba", pred="prediction_class", label=label, order=order)
    stamped = votes.withColumns({"model_version": F.lit(str(version)), "prediction_timestamp": stamp})
    sink_predictions_by_day(stamped, scored, path, date=day)
    return stamped.select(*daily.columns)
