"""Price bars, volatility estimators, the target, and label statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import daily_to_annual
from voltide.operators.ordering import position, series_frames

MEASURES = ("realized_vol", "tr_vol", "park_vol")
#: Parkinson's constant, 4 ln 2.
PARKINSON = 4 * 0.6931471805599453


# Seconds of the periods shorter than a day.
SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def period_start(ts: Column, period: str) -> Column:
    """Start of the period a zone-free time falls in: a date from the day upwards, else a time."""
    if period == "day":
        return ts.cast("date")
    if period not in SECONDS:
        return F.trunc(ts.cast("date"), period)
    width, zero = SECONDS[period], F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", zero, ts.cast("timestamp_ntz"))
    return F.timestamp_add("SECOND", F.floor(micros / F.lit(width * 1_000_000)) * width, zero)


def build_bars(
    df: DataFrame,
    *,
    series: str,
    ts: str,
    price: str,
    order: Sequence[str],
    period: str = "day",
    out_series: str | Sequence[str] = "series",
) -> DataFrame:
    """Ticks to bars: open, high, low, close, volume per (series, period).

    All aggregates combine on the map side, so a hot series costs no more than any other.
    """
    at = period_start(F.col(ts), period)
    at_tick = position(df, order)
    return df.groupBy(F.col(series).alias(out_series), at.alias("date")).agg(
        F.min_by(price, at_tick).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at_tick).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def spec(series: str | Sequence[str], order: str) -> Window:
    """The one window of a series (its key may have several columns)."""
    keys = [series] if isinstance(series, str) else list(series)
    return Window.partitionBy(*keys).orderBy(order)


def log_returns(bars: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", close: str = "close") -> DataFrame:
    w = spec(series, order)
    return bars.withColumn("returns", F.ln(F.col(close) / F.lag(close).over(w)))


def realized_vol(bars: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", close: str = "close", window: int = 20) -> DataFrame:
    """Sample deviation of the log returns in the last ``window`` rows, yearly, in percent."""
    frame = spec(series, order).rowsBetween(1 - window, 0)
    returns = log_returns(bars, series=series, order=order, close=close)
    return returns.withColumn("realized_vol", F.stddev_samp("returns").over(frame) * daily_to_annual() * 100)


def true_range_pct(high: Column, low: Column, close: Column, before: Column) -> Column:
    """True range in percent of the close; unknown while there is no previous close."""
    widest = F.greatest(high - low, F.abs(high - before), F.abs(low - before))
    return F.when(before.isNotNull(), F.lit(100) * widest / close)


def true_range_vol(bars: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", window: int = 20) -> DataFrame:
    w = spec(series, order)
    ranged = bars.withColumn("_tr", true_range_pct(F.col("high"), F.col("low"), F.col("close"), F.lag("close").over(w)))
    return ranged.withColumn("tr_vol", F.avg("_tr").over(w.rowsBetween(1 - window, 0)) * daily_to_annual()).drop("_tr")


def parkinson_vol(bars: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", window: int = 20) -> DataFrame:
    frame = spec(series, order).rowsBetween(1 - window, 0)
    squared = F.pow(F.ln(F.col("high") / F.col("low")), 2)
    return bars.withColumn("park_vol", F.lit(100) * F.sqrt(F.lit(252 / PARKINSON) * F.avg(squared).over(frame)))


def volatility_metrics(bars: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", window: int = 20) -> DataFrame:
    """Returns and the three estimators. Equal window specs share one shuffle and one sort."""
    real = realized_vol(bars, series=series, order=order, window=window)
    ranged = true_range_vol(real, series=series, order=order, window=window)
    return parkinson_vol(ranged, series=series, order=order, window=window)


def vol_target(df: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", measure: str = "realized_vol") -> DataFrame:
    """``vol_change`` against the previous row and its sign as 0/1; unknown counts as 0."""
    change = F.col(measure) - F.lag(measure).over(spec(series, order))
    moved = df.withColumn("vol_change", change)
    return moved.withColumn("vol_up", F.coalesce((F.col("vol_change") > 0).cast("int"), F.lit(0)))


def rolling_labels(
    df: DataFrame,
    *,
    series: Sequence[str],
    order: Sequence[str],
    label: str = "vol_up",
    window: int = 20,
    **how,
) -> DataFrame:
    """Mean and sample deviation of the label over the last ``window`` rows.

    These run over raw headline rows, of which one series may hold most: they are cut in chunks.
    """

    def frames(w):
        last = w.rowsBetween(1 - window, 0)
        return {
            "historical_vol_mean": F.avg(label).over(last),
            "historical_vol_std": F.stddev_samp(label).over(last),
        }

    return series_frames(df, series=series, order=order, frames=frames, lookback=window - 1, **how)


def rolling_mean(
    df: DataFrame,
    *,
    series: Sequence[str],
    order: Sequence[str],
    col: str,
    window: int = 30,
    out: str = "rolling_mean",
    **how,
) -> DataFrame:
    """Mean of the last ``window`` rows, unknown until that many values are there."""
    frames = lambda w: {out: full_mean(col, w.rowsBetween(1 - window, 0), window)}
    return series_frames(df, series=series, order=order, frames=frames, lookback=window - 1, **how)


def full_mean(col: str, frame: Window, n: int) -> Column:
    return F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))
