"""Alert rules over the long metrics table. Rules are data; "now" is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.operators.joins import compare
from voltide.operators.ordering import position, running_sums

# Fixed values: (rule, metric, comparator, threshold, seconds it must hold, severity).
FLOW_RULES = [
    ("dataset_drift", "data_drift_detected", "gt", 0.0, 0, "warning"),
    ("drift_share", "drift_share", "gt", 0.4, 0, "warning"),
    ("accuracy", "accuracy", "lt", 0.52, 0, "warning"),
    ("f1", "f1", "lt", 0.50, 0, "warning"),
    ("auc", "auc", "lt", 0.52, 0, "critical"),
]
MODEL_RULES = [
    ("ModelAUCDrop", "auc", "lt", 0.52, 120, "critical"),
    ("ModelF1Drop", "f1", "lt", 0.65, 300, "warning"),
    ("ModelAccuracyDrop", "accuracy", "lt", 0.65, 300, "warning"),
    ("DataDriftDetected", "drift_share", "gt", 0.3, 600, "warning"),
]
# Colour steps per metric, (metric, step, colour); a value takes the highest step
# that is not above it.
STATUS_BANDS = [
    ("auc", 0.0, "red"),
    ("auc", 0.52, "yellow"),
    ("auc", 0.6, "green"),
    ("f1", 0.0, "red"),
    ("f1", 0.65, "yellow"),
    ("f1", 0.75, "green"),
    ("accuracy", 0.0, "red"),
    ("accuracy", 0.65, "yellow"),
    ("accuracy", 0.75, "green"),
    ("drift_share", 0.0, "green"),
    ("drift_share", 0.2, "yellow"),
    ("drift_share", 0.3, "red"),
]


def latest_per_metric(df: DataFrame, *, name: str = "metric_name", value: str = "metric_value", ts: str = "ts", key: str = "id") -> DataFrame:
    """The newest row per metric (largest key among equal times), by aggregation instead of
    ranking: each task reduces its rows to one per metric before the shuffle, so a metric with a
    third of all rows weighs no more than the others."""
    return df.groupBy(name).agg(F.max(ts).alias(ts), F.max_by(value, position(df, [ts, key])).alias(value))


def avg_last_n(df: DataFrame, *, name: str = "metric_name", value: str = "metric_value", ts: str = "ts", key: str = "id", n: int = 10) -> DataFrame:
    """Mean of the last n values per metric; the rank limit runs in each task before the shuffle."""
    w = Window.partitionBy(name).orderBy(F.desc(ts), F.desc(key))
    ranked = df.select(name, value, ts, key).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)
    return ranked.groupBy(name).agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))


def latest_vs_baseline(df: DataFrame, *, baselines: dict[str, float], name: str = "metric_name", value: str = "metric_value", **how) -> DataFrame:
    """Newest value per metric and its distance to the metric's fixed baseline."""
    latest = latest_per_metric(df.where(F.col(name).isin(*baselines)), name=name, value=value, **how)
    base = F.lit(None).cast("double")
    for metric, number in baselines.items():
        base = F.when(F.col(name) == metric, F.lit(float(number))).otherwise(base)
    return latest.select(name, F.col(value).alias("latest_value"), base.alias("baseline"), (F.col(value) - base).alias("delta"))


def metric_series(df: DataFrame, *, names: Sequence[str], name: str = "metric_name", order: Sequence[str] = ("ts", "id")) -> DataFrame:
    return df.where(F.col(name).isin(*names)).orderBy(*order)


def recent_metric_rows(df: DataFrame, *, names: Sequence[str], asof: Column, window: str = "1 DAY", name: str = "metric_name", ts: str = "ts", key: str = "id") -> DataFrame:
    recent = df.where(F.col(name).isin(*names) & (F.col(ts) > asof - F.expr(f"INTERVAL {window}")))
    return recent.orderBy(F.desc(ts), F.desc(key))


def status_band(df: DataFrame, bands: Sequence[tuple[str, float, str]], *, name: str = "metric_name", value: str = "metric_value", out: str = "status") -> DataFrame:
    """Colour of each value by its metric's steps; no join, the steps are a few literals."""
    colour = F.lit(None).cast("string")
    for metric, step, text in sorted(bands, key=lambda b: b[1]):
        colour = F.when((F.col(name) == metric) & (F.col(value) >= step), text).otherwise(colour)
    return df.withColumn(out, colour)


def alert_message(metric: Column, op: Column, value: Column, threshold: Column) -> Column:
    share = metric == "drift_share"
    return (
        F.when(metric == "data_drift_detected", "Dataset drift detected!")
        .when(share, F.format_string("High drift share: %.2f%% > %.2f%%", value * 100, threshold * 100))
        .when(op.isin("lt", "le"), F.format_string("Low %s: %.3f < %.3f", metric, value, threshold))
        .otherwise(F.format_string("High %s: %.3f > %.3f", metric, value, threshold))
    )


def check_alerts(metrics: DataFrame, rules: DataFrame, *, name: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Broken rules of a run's metrics, with a message. The rules are a short driver-made list."""
    joined = metrics.select(F.col(name).alias("_name"), F.col(value).alias("value")).join(F.broadcast(rules), F.col("_name") == F.col("metric"), "inner")
    broken = joined.where(compare(F.col("op"), F.col("value"), F.col("threshold")))
    return broken.select("rule", "metric", "value", "threshold", "severity", alert_message(F.col("metric"), F.col("op"), F.col("value"), F.col("threshold")).alias("message"))


def alert_rules_latest(metrics: DataFrame, rules: DataFrame, *, name: str = "metric_name", value: str = "metric_value", **how) -> DataFrame:
    """One row per rule: the newest value of its metric and whether it breaks the rule. Metrics
    without a rule leave first, so what meets the rules is as short as their list."""
    watched = rules.select(F.col("metric").alias(name)).distinct()
    latest = latest_per_metric(metrics.join(F.broadcast(watched), name, "left_semi"), name=name, value=value, **how)
    joined = rules.join(latest, F.col("metric") == F.col(name), "left")
    breach = compare(F.col("op"), F.col(value), F.col("threshold"))
    state = F.when(F.col(value).isNull(), "NoData").when(breach, "Alerting").otherwise("OK")
    return joined.select("rule", "metric", "severity", F.col(value).alias("value"), "threshold", state.alias("state"))


def alert_rules_fresh(metrics: DataFrame, rules: DataFrame, *, asof: Column, window: str = "10 MINUTES", ts: str = "ts", **how) -> DataFrame:
    """The same, looking only at values newer than the window; a rule without any is ``NoData``."""
    fresh = metrics.where(F.col(ts) > asof - F.expr(f"INTERVAL {window}"))
    return alert_rules_latest(fresh, rules, ts=ts, **how)


def alert_state(metrics: DataFrame, rules: DataFrame, *, name: str = "metric_name", value: str = "metric_value", ts: str = "ts", key: str = "id") -> DataFrame:
    """Runs of consecutive breaches per rule: pending until the run has lasted ``for_seconds``,
    then firing.

    A run is keyed by the number of good values before it. That count is a distributed prefix sum,
    and the runs are then an ordinary aggregate, so neither a busy metric nor one endless run lands
    in a single task.
    """
    rows = metrics.select(F.col(name).alias("_name"), F.col(value).alias("_value"), ts, key)
    joined = rows.join(F.broadcast(rules), F.col("_name") == F.col("metric"), "inner")
    breach = F.coalesce(compare(F.col("op"), F.col("_value"), F.col("threshold")), F.lit(False))
    marked = joined.select("rule", "severity", "for_seconds", ts, key, breach.alias("_breach"), (~breach).cast("bigint").alias("ok"))
    counted = running_sums(marked, by=["rule"], order=[ts, key], sums=["ok"])
    runs = counted.where("_breach").groupBy("rule", "severity", "for_seconds", F.col("ok_before").alias("run")).agg(
        F.min(ts).alias("started"),
        F.max(ts).alias("ended"),
        F.count(F.lit(1)).alias("n_values"),
    )
    timed = runs.withColumn("lasted_seconds", F.timestamp_diff("SECOND", "started", "ended"))
    return timed.withColumn("state", F.when(F.col("lasted_seconds") >= F.col("for_seconds"), "firing").otherwise("pending")).drop("run")


def performance_tests(scores: DataFrame, *, limits: dict[str, float], rows: str = "n", minimum: int = 10) -> DataFrame:
    """Pass or fail per metric of a one-row score frame; ``minimum`` rows or fewer decide nothing, and
    ``reason`` says so."""
    long = scores.select(F.col(rows).alias("_rows"), *[F.col(m).cast("double").alias(m) for m in limits]).unpivot(["_rows"], list(limits), "test", "value")
    limit = F.lit(None).cast("double")
    for metric, number in limits.items():
        limit = F.when(F.col("test") == metric, F.lit(float(number))).otherwise(limit)
    enough = F.col("_rows") > minimum
    judged = long.withColumn("limit", limit).withColumn("passed", F.when(enough, F.col("value") >= F.col("limit")))
    return judged.withColumn("reason", F.when(~enough, F.lit(f"{minimum} rows or fewer"))).drop("_rows")


def monitoring_metrics(reference: DataFrame, current: DataFrame, predictions: DataFrame, columns: DataFrame, *, y: str, yhat: str, score: str) -> DataFrame:
    """Sample counts, drift, quality of the labelled predictions and score quantiles of one run as
    (metric_name, metric_value). ``columns`` is a ``column_drift`` result."""
    from voltide.operators.drift import dataset_drift
    from voltide.operators.metrics import classification_scores, column_quantile

    n_rows = lambda df, n: df.agg(F.count(F.lit(1)).cast("double").alias("metric_value")).select(F.lit(n).alias("metric_name"), "metric_value")
    drift = dataset_drift(columns).select(F.col("data_drift_detected").cast("double"), "drift_share")
    labelled = predictions.where(F.col(y).isNotNull())
    scores = classification_scores(labelled, y=y, yhat=yhat, score=score).where(F.col("n") > 0)
    # a single class has no AUC: .5 stands for it
    scores = scores.select("accuracy", "f1", F.coalesce("auc", F.lit(0.5)).alias("auc"))
    quantiles = column_quantile(labelled, cols=[score])
    names = F.concat(F.lit(f"{score}_quantile_"), F.format_string("%.2f", F.col("q")))
    parts = [
        n_rows(current, "current_samples"),
        drift.unpivot([], drift.columns, "metric_name", "metric_value"),
        scores.unpivot([], scores.columns, "metric_name", "metric_value"),
        quantiles.select(names.alias("metric_name"), F.col("quantile").alias("metric_value")),
    ]
    out = n_rows(reference, "reference_samples")
    for part in parts:
        out = out.unionByName(part)
    return out.where(F.col("metric_value").isNotNull())


def run_summary(metrics: DataFrame, alerts: DataFrame, *, asof: Column, prediction_days: Column | None = None) -> DataFrame:
    """One row for a run: status, counts, predicted days, key metrics, and the alerts (at most one per rule)."""
    name, value = F.col("metric_name"), F.col("metric_value")
    pick = lambda m: F.max(F.when(name == m, value))
    keys = ["data_drift_detected", "drift_share", "accuracy", "f1"]
    top = metrics.agg(
        F.count(F.lit(1)).alias("metrics_count"),
        pick("reference_samples").cast("bigint").alias("reference_samples"),
        pick("current_samples").cast("bigint").alias("current_samples"),
        F.struct(*[pick(m).alias(m) for m in keys]).alias("key_metrics"),
    )
    cols = ["rule", "metric", "value", "threshold", "severity", "message"]
    raised = alerts.agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("alerts")).scalar()
    have = F.coalesce(F.col("current_samples"), F.lit(0)) > 0
    return top.withColumn("alerts", raised).select(
        asof.alias("timestamp"),
        F.when(have, "success").otherwise("error").alias("status"),
        "metrics_count",
        F.size("alerts").alias("alerts_count"),
        "reference_samples",
        "current_samples",
        (F.lit(0) if prediction_days is None else F.coalesce(prediction_days, F.lit(0))).cast("bigint").alias("prediction_days"),
        "key_metrics",
        "alerts",
    )
