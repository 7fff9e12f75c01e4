"""The joins of the engine. Small sides are broadcast only where their size is fixed by a rule
list or checked; all others are left to the statistics and to adaptive execution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE_SCHEMA = "rule string, metric string, op string, threshold double, for_seconds bigint, severity string"


def join_vol_news(features: DataFrame, news: DataFrame, *, on: Sequence[str] = ("date",)) -> DataFrame:
    """Day features and news of the same day. One row per day on the left: adaptive execution
    broadcasts it while it is small."""
    return features.join(news, list(on), "inner")


def semi_join_dates(df: DataFrame, dates: DataFrame, *, on: str = "date") -> DataFrame:
    return df.join(dates.select(on), on, "left_semi")


def broadcast_day_features(df: DataFrame, *, date: str, order: str, cols: Sequence[str]) -> DataFrame:
    """The feature values of the day's first row, given to every row of the day.

    One ``min_by`` per (numeric) column keeps the aggregate a hash aggregate; a struct of all
    columns would turn it into a sort.
    """
    first = df.groupBy(date).agg(*[F.min_by(c, order).alias(c) for c in cols])
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest).join(first, date, "inner").select(*rest, *cols)


def compare(op: Column, value: Column, threshold: Column) -> Column:
    """The comparator named by a rule; null for an unknown value or comparator."""
    return (
        F.when(op == "lt", value < threshold)
        .when(op == "le", value <= threshold)
        .when(op == "gt", value > threshold)
        .when(op == "ge", value >= threshold)
        .when(op == "eq", value == threshold)
    )


def rule_table(spark, rules: Sequence[tuple]) -> DataFrame:
    """Rules as data: (rule, metric, op, threshold, for_seconds, severity), as literals of the plan."""
    names = [part.split()[0] for part in RULE_SCHEMA.split(", ")]
    lines = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*lines).cast(f"array<struct<{_struct_fields()}>>")))


def _struct_fields() -> str:
    return ", ".join(":".join(part.split()) for part in RULE_SCHEMA.split(", "))


def join_thresholds(metrics: DataFrame, rules: DataFrame, *, metric: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Every metric row with the rules on its name, and whether the rule is broken.

    The rule table comes from a list held by the driver, so its size is known and small.
    """
    joined = metrics.join(F.broadcast(rules), metrics[metric] == rules["metric"], "inner").drop("metric")
    return joined.withColumn("breach", compare(F.col("op"), F.col(value), F.col("threshold")))


def importance_zip(df: DataFrame, *, names: str, values: str) -> DataFrame:
    """Two arrays of one row zipped by position into (pos, feature, importance)."""
    zipped = df.select(F.posexplode(F.arrays_zip(F.col(names).alias("f"), F.col(values).alias("v"))).alias("pos", "z"))
    return zipped.select("pos", F.col("z.f").alias("feature"), F.col("z.v").alias("importance"))
