"""Leak-free lag, moving-average, ratio, calendar and direction features; date splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import calendar_columns, one_hot_columns
from voltide.operators.ordering import row_index, series_frames
from voltide.operators.volatility import MEASURES, full_mean, spec

LAGS = (1, 2, 3, 5, 10)
AVERAGES = (5, 10, 20)
LABEL_WINDOWS = (1, 2, 3, 5, 7, 15)


def _lag_columns(w: Window, cols: Sequence[str], lags: Sequence[int]) -> dict:
    return {f"{c}_lag_{i}": F.lag(c, i).over(w) for i in lags for c in cols}


def _average_columns(w: Window, cols: Sequence[str], mas: Sequence[int]) -> dict:
    return {f"{c}_ma_{n}": full_mean(c, w.rowsBetween(-n, -1), n) for n in mas for c in cols}


def lag_features(df: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", cols: Sequence[str] = MEASURES, lags: Sequence[int] = LAGS) -> DataFrame:
    return df.withColumns(_lag_columns(spec(series, order), cols, lags))


def shifted_moving_avg(df: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", cols: Sequence[str] = MEASURES, mas: Sequence[int] = AVERAGES) -> DataFrame:
    """Means of the previous n rows, without the current one; unknown until n values are there."""
    return df.withColumns(_average_columns(spec(series, order), cols, mas))


def vol_ratios(df: DataFrame, *, measure: str = "realized_vol", mas: Sequence[int] = (5, 20)) -> DataFrame:
    """Current value against its moving averages."""
    return df.withColumns({f"vol_ratio_{n}d": F.col(measure) / F.nullif(F.col(f"{measure}_ma_{n}"), F.lit(0.0)) for n in mas})


def drop_current_day(df: DataFrame, cols: Sequence[str] = MEASURES) -> DataFrame:
    """Remove the columns that give the target away."""
    return df.drop(*cols)


def technical_features(
    df: DataFrame,
    *,
    series: str | Sequence[str] = "series",
    order: str = "date",
    cols: Sequence[str] = MEASURES,
    lags: Sequence[int] = LAGS,
    mas: Sequence[int] = AVERAGES,
    keep_current: bool = False,
) -> DataFrame:
    """Lags and moving averages in one sort. ``keep_current`` keeps the day's own values and adds
    the ratios, as the notebook form does; the default leaks nothing."""
    w = spec(series, order)
    built = df.withColumns({**_lag_columns(w, cols, lags), **_average_columns(w, cols, mas)})
    return vol_ratios(built) if keep_current else drop_current_day(built, cols)


def calendar_features(df: DataFrame, *, date: str = "date") -> DataFrame:
    return df.withColumns(calendar_columns(date))


def calendar_one_hot(df: DataFrame, *, date: str = "date") -> DataFrame:
    return df.withColumns(one_hot_columns(date))


def default_feature_values() -> dict[str, float]:
    """Values for a headline without history: zeros, and Monday / January / first quarter."""
    values = {f"{c}_lag_{i}": 0.0 for i in LAGS for c in MEASURES}
    values |= {f"{c}_ma_{n}": 0.0 for n in AVERAGES for c in MEASURES}
    values |= {f"dow_{k}": float(k == 0) for k in range(7)}
    values |= {f"month_{k}": float(k == 1) for k in range(1, 13)}
    values |= {f"quarter_{k}": float(k == 1) for k in range(1, 5)}
    return values


def default_features(df: DataFrame) -> DataFrame:
    """Add the default for every missing feature column and fill the nulls of existing ones."""
    out = {}
    for name, value in default_feature_values().items():
        out[name] = F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
    return df.withColumns(out)


def label_lead(df: DataFrame, *, series: Sequence[str], order: Sequence[str], label: str = "label", ahead: int = 3, **how) -> DataFrame:
    """The label ``ahead`` rows later."""
    frames = lambda w: {f"{label}_lead": F.lead(label, ahead).over(w)}
    return series_frames(df, series=series, order=order, frames=frames, lookback=0, lookahead=ahead, **how)


def _label_mean_columns(w: Window, label: str, windows: Sequence[int], ahead: int) -> dict:
    """Shifting the led label back again gives the raw label, but loses the first ``ahead`` rows of
    the series: a mean is unknown while its frame reaches into them."""
    out = {}
    for n in windows:
        clear = F.lag(F.lit(1), n - 1 + ahead).over(w).isNotNull() if n - 1 + ahead else F.lit(True)
        out[f"rolling_mean_{n}d"] = F.when(clear, full_mean(label, w.rowsBetween(1 - n, 0), n))
    return out


def shifted_label_means(df: DataFrame, *, series: Sequence[str], order: Sequence[str], label: str = "label", ahead: int = 3, windows: Sequence[int] = LABEL_WINDOWS, **how) -> DataFrame:
    """Means of the label through the current row, as the prediction ``ahead`` rows on sees them."""
    frames = lambda w: _label_mean_columns(w, label, windows, ahead)
    return series_frames(df, series=series, order=order, frames=frames, lookback=max(windows) - 1 + ahead, **how)


def positional_trim(df: DataFrame, *, series: Sequence[str], order: Sequence[str], first: int = 15, last: int = 3) -> DataFrame:
    """Drop the first and last rows of each series, the unnamed one too; ``order`` must be total.

    Rows are numbered in chunks, so a series of any length is spread over many tasks.
    """
    placed = row_index(df, by=list(series), order=list(order), out="_place")
    kept = (F.col("_place") > first) & (F.col("_place") <= F.col("_place_of") - last)
    return placed.where(kept).select(*df.columns)


def direction_features(df: DataFrame, *, series: str | Sequence[str] = "series", order: str = "date", label: str = "label", ahead: int = 3, windows: Sequence[int] = LABEL_WINDOWS, first: int = 15, last: int = 3) -> DataFrame:
    """Led label, label means and the trim, all in one sort per series of daily rows."""
    w = spec(series, order)
    cols = _label_mean_columns(w, label, windows, ahead)
    cols["_from_start"] = F.row_number().over(w)
    cols["_to_end"] = F.lead(F.lit(1), last).over(w)
    cols[f"{label}_lead"] = F.lead(label, ahead).over(w)
    kept = F.col("_from_start") > first
    if last > 0:
        kept = kept & F.col("_to_end").isNotNull()
    return df.withColumns(cols).where(kept).drop("_from_start", "_to_end")


def temporal_split2(df: DataFrame, *, date: str = "date", cut: Date) -> DataFrame:
    """``split`` = train up to the cut, test after it."""
    return df.withColumn("split", F.when(F.col(date) <= F.lit(cut), "train").otherwise("test"))


def temporal_split3(df: DataFrame, *, date: str = "date", train_end: Date, val_end: Date) -> DataFrame:
    split = F.when(F.col(date) <= F.lit(train_end), "train").when(F.col(date) <= F.lit(val_end), "val").otherwise("test")
    return df.withColumn("split", split)
