"""Monitoring job: drift and quality of the recent data, appended metrics, alerts, one summary row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.operators.alerts import FLOW_RULES, check_alerts, monitoring_metrics, run_summary
from voltide.operators.drift import column_drift
from voltide.operators.joins import rule_table
from voltide.operators.ordering import checkpointed
from voltide.operators.reshape import last_n_dates, scan_recent_window
from voltide.sources.tables import metrics_append, with_fallback


def recent_predictions(detailed: DataFrame, daily: DataFrame, *, asof: Column, days: int, date: str = "date") -> DataFrame:
    """Recent detailed predictions if there are any, else recent daily ones."""
    recent = [scan_recent_window(df, date=date, asof=asof, days=days) for df in (detailed, daily)]
    return with_fallback(*recent)


def monitoring_job(
    reference: DataFrame,
    current: DataFrame,
    predictions: DataFrame,
    *,
    numeric: Sequence[str],
    categorical: Sequence[str],
    text: Sequence[str] = (),
    key: str | None = None,
    y: str,
    yhat: str,
    score: str,
    asof: Column,
    metrics_path: str,
    date: str = "date",
    days: int = 7,
    rules: Sequence[tuple] = tuple(FLOW_RULES),
    model_version: str = "unknown",
    run: str | None = None,
) -> DataFrame:
    """The run summary. The metrics of the run (a dozen rows) are computed once and reused; with ``run`` a
    repeated job replaces its rows in the metrics table."""
    window = last_n_dates(current, date=date, n=days)
    columns = column_drift(reference, window, numeric=numeric, categorical=categorical, text=text, key=key)
    found = checkpointed(monitoring_metrics(reference, window, predictions, columns, y=y, yhat=yhat, score=score))
    metrics_append(found, metrics_path, ts=asof, model_version=model_version, run=run)
    alerts = check_alerts(found, rule_table(found.sparkSession, rules))
    predicted = predictions.agg(F.countDistinct(date)).scalar() if date in predictions.columns else None
    return run_summary(found, alerts, asof=asof, prediction_days=predicted)


def as_of(df: DataFrame, ts: str) -> Column:
    """The newest time in a frame, as a scalar subquery."""
    return df.agg(F.max(ts)).scalar()
