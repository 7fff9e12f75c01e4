"""Data preparation: prices and wide news to the leak-free tall data set, split and published."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators.features import calendar_features, calendar_one_hot, technical_features, temporal_split3
from voltide.operators.joins import join_vol_news
from voltide.operators.ordering import per_series
from voltide.operators.reshape import label_alias, wide_to_tall
from voltide.operators.volatility import build_bars, vol_target, volatility_metrics
from voltide.sources.tables import sink_parquet


#: Rows before a bar that its features depend on: an average of 20 rows, each with a 20-row
#: estimator over returns that look one row back.
LOOKBACK = 41


def features_of_bars(bars: DataFrame, *, keep_current: bool = False, one_hot: bool = False, chunks: int | None = None) -> DataFrame:
    """Estimators, target, lags and averages, calendar; rows without full history dropped.

    After the bars there is one shuffle by series and one sort for everything. Daily bars are as
    long as the calendar; fine-grained bars run in ``chunks``.
    """

    def build(frame: DataFrame, keys: list[str]) -> DataFrame:
        extra = [c for c in frame.columns if c.startswith("_") and c not in keys]
        measured = volatility_metrics(frame, series=keys).select(*keys, "date", "realized_vol", "tr_vol", "park_vol", *extra)
        return technical_features(vol_target(measured, series=keys), series=keys, keep_current=keep_current).drop("vol_change")

    bounded = {"per_period": True} if chunks is None else {"chunks": chunks}
    built = per_series(bars, build, series=["series"], order=["date"], lookback=LOOKBACK, **bounded)
    dated = calendar_one_hot(built) if one_hot else calendar_features(built)
    return dated.na.drop("any")


def price_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: volatility features per series and day from ``orders`` as ticks."""
    ticks = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    bars = build_bars(ticks, series="o_orderpriority", ts="o_orderdate", price="o_totalprice", order=["o_orderkey"])
    return features_of_bars(bars)


def tall_dataset(bars: DataFrame, news: DataFrame, *, slots: Sequence[str], date: str = "Date", series: str | None = None, keep_current: bool = False) -> DataFrame:
    """Day features joined to the news of the day, one row per headline.

    ``news`` has a series column too if several series are prepared at once. Features come before
    the join, over each series' full history, so a split later takes no history from the test rows.
    """
    features = features_of_bars(bars, keep_current=keep_current)
    renamed = label_alias(news, out="news_label", names=["Label"]) if "Label" in news.columns else news
    keys = ["date"] + ([series] if series else [])
    right = renamed.withColumnRenamed(date, "date")
    joined = join_vol_news(features, right, on=keys)
    return wide_to_tall(joined, slots=slots)


def publish_splits(tall: DataFrame, path: str, *, train_end: Date, val_end: Date, date: str = "date") -> None:
    """One pass, one table partitioned by split and month: later reads prune both."""
    split = temporal_split3(tall, date=date, train_end=train_end, val_end=val_end)
    sink_parquet(split.withColumn("month_start", F.trunc(date, "month")), path, partition_by=["split", "month_start"])
