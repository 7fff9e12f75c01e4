"""Bars, volatility, features, splits and direction labels."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import functions as F

from voltide.catalog.inputs import CUT, CUT2, bars, labels_by_day, metrics, target, vol
from voltide.catalog.registry import query, r6, table
from voltide.functions import scalars as S
from voltide.operators import features as X
from voltide.operators import volatility as V
from voltide.plans.prepare import features_of_bars

D, D2 = Date.fromisoformat(CUT), Date.fromisoformat(CUT2)
W = "WINDOW w AS (PARTITION BY series ORDER BY date)"
MEASURES = ("realized_vol", "tr_vol", "park_vol")


def _lag_sql() -> str:
    return ", ".join(f"round(lag({c}, {i}) OVER w, 6) AS {c}_lag_{i}" for i in X.LAGS for c in MEASURES)


def _full_avg(c: str, frame: str, n: int, out: str) -> str:
    over = f"OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {frame})"
    return f"round(CASE WHEN count({c}) {over} = {n} THEN avg({c}) {over} END, 6) AS {out}"


def _ma_sql() -> str:
    return ", ".join(_full_avg(c, f"{n} PRECEDING AND 1 PRECEDING", n, f"{c}_ma_{n}") for n in X.AVERAGES for c in MEASURES)


@query("SELECT series, date, open, high, low, close, volume FROM bars", "bars")
def build_bars(spark, d):
    return bars(spark, d)


@query(
    """SELECT event_type AS series, date_trunc('hour', ts) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
      min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2"""
)
def build_bars_hourly(spark, d):
    return V.build_bars(table(spark, d, "events"), series="event_type", ts="ts", price="value", order=["ts", "event_id"], period="hour")


@query("SELECT series, date, open, high, low, close, volume FROM bars WHERE series = '1-URGENT' AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'", "bars")
def scan_price_bars(spark, d):
    return bars(spark, d).where((F.col("series") == "1-URGENT") & F.col("date").between(Date(1996, 1, 1), Date(1999, 12, 31)))


@query("SELECT series, date, round(returns, 6) AS returns FROM rets", "rets")
def log_returns(spark, d):
    return r6(V.log_returns(bars(spark, d)).select("series", "date", "returns"))


@query("SELECT series, date, round(realized_vol, 6) AS realized_vol FROM vol", "vol")
def realized_vol(spark, d):
    return r6(V.realized_vol(bars(spark, d)).select("series", "date", "realized_vol"))


@query("SELECT series, date, round(tr_vol, 6) AS tr_vol FROM vol", "vol")
def true_range_vol(spark, d):
    return r6(V.true_range_vol(bars(spark, d)).select("series", "date", "tr_vol"))


@query("SELECT series, date, round(park_vol, 6) AS park_vol FROM vol", "vol")
def parkinson_vol(spark, d):
    return r6(V.parkinson_vol(bars(spark, d)).select("series", "date", "park_vol"))


@query("SELECT series, date, round(realized_vol, 6) AS realized_vol, round(tr_vol, 6) AS tr_vol, round(park_vol, 6) AS park_vol FROM vol", "vol")
def volatility_metrics(spark, d):
    return r6(vol(spark, d))


@query("SELECT series, date, round(vol_change, 6) AS vol_change, vol_up FROM target", "target")
def vol_target(spark, d):
    return r6(target(spark, d).select("series", "date", "vol_change", "vol_up"))


@query(f"SELECT series, date, {_lag_sql()} FROM vol {W}", "vol")
def lag_features(spark, d):
    return r6(X.drop_current_day(X.lag_features(vol(spark, d))))


@query(f"SELECT series, date, {_ma_sql()} FROM vol", "vol")
def shifted_moving_avg(spark, d):
    return r6(X.drop_current_day(X.shifted_moving_avg(vol(spark, d))))


@query(
    """SELECT series, date, round(realized_vol / nullif(ma5, 0), 6) AS vol_ratio_5d, round(realized_vol / nullif(ma20, 0), 6) AS vol_ratio_20d FROM (
      SELECT *, CASE WHEN count(realized_vol) OVER a = 5 THEN avg(realized_vol) OVER a END AS ma5,
        CASE WHEN count(realized_vol) OVER b = 20 THEN avg(realized_vol) OVER b END AS ma20 FROM vol
      WINDOW a AS (PARTITION BY series ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
        b AS (PARTITION BY series ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))""",
    "vol",
)
def vol_ratios(spark, d):
    base = X.shifted_moving_avg(vol(spark, d), cols=["realized_vol"], mas=(5, 20))
    return r6(X.vol_ratios(base).select("series", "date", "vol_ratio_5d", "vol_ratio_20d"))


@query(f"SELECT series, date, vol_up, {_lag_sql()}, {_ma_sql()} FROM target {W}", "target")
def technical_features(spark, d):
    return r6(X.technical_features(target(spark, d)).drop("vol_change"))


@query(
    f"SELECT * FROM (SELECT series, date, vol_up, {_lag_sql()}, {_ma_sql()} FROM target {W}) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in [f"{m}_lag_10" for m in MEASURES] + [f"{m}_ma_20" for m in MEASURES]),
    "target",
)
def technical_features_chunked(spark, d):
    """The whole feature chain over series that are cut into chunks with halos."""
    built = features_of_bars(bars(spark, d), chunks=12)
    return r6(built.drop("dow", "month", "quarter"))


@query("SELECT series, date, vol_up FROM target", "target")
def drop_current_day(spark, d):
    return X.drop_current_day(target(spark, d)).drop("vol_change")


@query("SELECT series, date, CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter FROM bars", "bars")
def calendar_features(spark, d):
    return X.calendar_features(bars(spark, d).select("series", "date"))


def _hot_sql() -> str:
    parts = [("dow", "isodow(date) - 1", range(7)), ("month", "month(date)", range(1, 13)), ("quarter", "quarter(date)", range(1, 5))]
    return ", ".join(f"CAST({e} = {k} AS INTEGER) AS {n}_{k}" for n, e, ks in parts for k in ks)


@query(f"SELECT series, date, {_hot_sql()} FROM bars", "bars")
def calendar_one_hot(spark, d):
    return X.calendar_one_hot(bars(spark, d).select("series", "date"))


@query(
    "SELECT series, date, "
    + ", ".join(f"coalesce(round(lag({c}, {i}) OVER w, 6), 0) AS {c}_lag_{i}" for i in X.LAGS for c in MEASURES)
    + ", "
    + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in X.default_feature_values().items() if "_lag_" not in k)
    + f" FROM vol {W}",
    "vol",
)
def default_features(spark, d):
    return r6(X.default_features(X.drop_current_day(X.lag_features(vol(spark, d)))))


@query(
    """SELECT doc_id, date, vol_up, round(avg(vol_up) OVER w, 6) AS historical_vol_mean FROM label_rows
    WINDOW w AS (ORDER BY date, doc_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "label_rows",
)
def rolling_label_mean(spark, d):
    rows = V.rolling_labels(labels_by_day(spark, d), series=["series"], order=["date", "doc_id"])
    return r6(rows.select("doc_id", "date", "vol_up", "historical_vol_mean"))


@query(
    """SELECT doc_id, date, vol_up, round(stddev_samp(vol_up) OVER w, 6) AS historical_vol_std FROM label_rows
    WINDOW w AS (ORDER BY date, doc_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "label_rows",
)
def rolling_label_std(spark, d):
    rows = V.rolling_labels(labels_by_day(spark, d), series=["series"], order=["date", "doc_id"])
    return r6(rows.select("doc_id", "date", "vol_up", "historical_vol_std"))


@query(
    f"""SELECT series, date, vol_up, {_full_avg("vol_up", "29 PRECEDING AND CURRENT ROW", 30, "rolling_mean")} FROM target""",
    "target",
)
def rolling_mean_30(spark, d):
    rows = V.rolling_mean(target(spark, d), series=["series"], order=["date"], col="vol_up", per_period=True)
    return r6(rows.select("series", "date", "vol_up", "rolling_mean"))


@query(
    """SELECT metric_name, id, ts, round(CASE WHEN count(*) OVER w = 30 THEN avg(metric_value) OVER w END, 6) AS rolling_mean FROM metrics
    WINDOW w AS (PARTITION BY metric_name ORDER BY ts, id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
    "metrics",
)
def rolling_mean_30_chunked(spark, d):
    """The same frame over raw rows of few, long series, through chunks with halos."""
    rows = V.rolling_mean(metrics(spark, d), series=["metric_name"], order=["ts", "id"], col="metric_value")
    return r6(rows.select("metric_name", "id", "ts", "rolling_mean"))


@query(f"SELECT series, date, vol_up, lead(vol_up, 3) OVER w AS vol_up_lead FROM target {W}", "target")
def label_lead(spark, d):
    rows = X.label_lead(target(spark, d), series=["series"], order=["date"], label="vol_up", per_period=True)
    return rows.select("series", "date", "vol_up", "vol_up_lead")


def _means_sql() -> str:
    parts = []
    for n in X.LABEL_WINDOWS:
        over = f"OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        parts.append(f"round(CASE WHEN count(shifted) {over} = {n} THEN avg(shifted) {over} END, 6) AS rolling_mean_{n}d")
    return ", ".join(parts)


SHIFTED = """(SELECT *, lag(led, 3) OVER (PARTITION BY series ORDER BY date) AS shifted FROM (
  SELECT series, date, vol_up, lead(vol_up, 3) OVER (PARTITION BY series ORDER BY date) AS led,
    row_number() OVER (PARTITION BY series ORDER BY date) AS rn, count(*) OVER (PARTITION BY series) AS n FROM target))"""


@query(f"SELECT series, date, {_means_sql()} FROM {SHIFTED}", "target")
def shifted_label_means(spark, d):
    rows = X.shifted_label_means(target(spark, d), series=["series"], order=["date"], label="vol_up", per_period=True)
    return r6(rows.select("series", "date", *[f"rolling_mean_{n}d" for n in X.LABEL_WINDOWS]))


@query(
    f"SELECT series, date, vol_up_lead, {', '.join(f'rolling_mean_{n}d' for n in X.LABEL_WINDOWS)} FROM (SELECT series, date, led AS vol_up_lead, rn, n, {_means_sql()} FROM {SHIFTED}) WHERE rn > 15 AND rn <= n - 3",
    "target",
)
def direction_features(spark, d):
    rows = X.direction_features(target(spark, d), label="vol_up")
    return r6(rows.select("series", "date", "vol_up_lead", *[f"rolling_mean_{n}d" for n in X.LABEL_WINDOWS]))


@query(
    """SELECT metric_name, id, ts, metric_value FROM (
      SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY metric_name) AS n FROM metrics WINDOW w AS (PARTITION BY metric_name ORDER BY ts, id))
    WHERE rn > 15 AND rn <= n - 3""",
    "metrics",
)
def positional_trim(spark, d):
    return X.positional_trim(metrics(spark, d), series=["metric_name"], order=["ts", "id"])


@query(f"SELECT series, date, vol_up, CASE WHEN date <= DATE '{CUT}' THEN 'train' ELSE 'test' END AS split FROM target", "target")
def temporal_split2(spark, d):
    return X.temporal_split2(target(spark, d).select("series", "date", "vol_up"), cut=D)


SPLIT3 = f"CASE WHEN date <= DATE '{CUT2}' THEN 'train' WHEN date <= DATE '{CUT}' THEN 'val' ELSE 'test' END"


@query(f"SELECT series, date, vol_up, {SPLIT3} AS split FROM target", "target")
def temporal_split3(spark, d):
    return X.temporal_split3(target(spark, d).select("series", "date", "vol_up"), train_end=D2, val_end=D)


@query(f"SELECT {SPLIT3} AS split, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM target GROUP BY 1", "target")
def split_summary(spark, d):
    from voltide.operators.metrics import split_summary as summary

    return summary(X.temporal_split3(target(spark, d).select("series", "date"), train_end=D2, val_end=D))


@query(
    """SELECT series, date, round(sqrt(close), 6) AS root, round(ln(close), 6) AS log, abs(close - open) AS gap,
      round(power((high - low) / close, 2), 6) AS square, greatest(open, close) AS top, least(1.0::DOUBLE, greatest(0.0::DOUBLE, round(close / high, 6))) AS clamped FROM bars""",
    "bars",
)
def math_core(spark, d):
    c = F.col
    return r6(
        bars(spark, d).select(
            "series",
            "date",
            F.sqrt("close").alias("root"),
            F.ln("close").alias("log"),
            F.abs(c("close") - c("open")).alias("gap"),
            F.pow((c("high") - c("low")) / c("close"), 2).alias("square"),
            F.greatest("open", "close").alias("top"),
            S.clamp(c("close") / c("high"), 0.0, 1.0).alias("clamped"),
        ),
        "root",
        "log",
        "square",
        "clamped",
    )
