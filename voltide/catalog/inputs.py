"""The engine's inputs derived from the given tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.catalog.registry import cte, table
from voltide.operators.volatility import build_bars, vol_target, volatility_metrics

SLOTS = [f"Top{i}" for i in range(1, 9)]
# Short stop word list of the registered text queries.
STOPWORDS = ["the", "of", "and", "to", "in", "is", "it", "that", "for", "on", "with", "as", "by", "at", "le", "la", "les", "de", "des", "et", "der", "die", "das", "und", "el", "los", "que", "en"]
STOP_SQL = ", ".join(f"'{w}'" for w in STOPWORDS)
RULES = [
    ("error_high", "error", "gt", 60.0, 600, "critical"),
    ("click_low", "click", "lt", 20.0, 300, "warning"),
    ("view_high", "view", "gt", 40.0, 0, "warning"),
    ("purchase_low", "purchase", "le", 30.0, 3600, "warning"),
    ("absent", "never_reported", "gt", 1.0, 0, "info"),
]
CUT, CUT2 = "1999-12-31", "1998-12-31"


def bars(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders", "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return build_bars(orders, series="o_orderpriority", ts="o_orderdate", price="o_totalprice", order=["o_orderkey"])


cte(
    "bars",
    """SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS date,
      arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
      min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
    FROM orders GROUP BY 1, 2""",
)


def vol(spark: SparkSession, d: str) -> DataFrame:
    return volatility_metrics(bars(spark, d)).select("series", "date", "realized_vol", "tr_vol", "park_vol")


cte(
    "rets",
    """SELECT *, ln(close / lag(close) OVER w) AS returns,
      CASE WHEN lag(close) OVER w IS NOT NULL THEN 100 * greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) / close END AS tr
    FROM bars WINDOW w AS (PARTITION BY series ORDER BY date)""",
    "bars",
)
cte(
    "vol",
    """SELECT series, date, stddev_samp(returns) OVER w * sqrt(252) * 100 AS realized_vol,
      avg(tr) OVER w * sqrt(252) AS tr_vol,
      100 * sqrt(252 / (4 * ln(2)) * avg(ln(high / low) ** 2) OVER w) AS park_vol
    FROM rets WINDOW w AS (PARTITION BY series ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "rets",
)


def target(spark: SparkSession, d: str) -> DataFrame:
    return vol_target(vol(spark, d))


cte(
    "target",
    """SELECT *, coalesce(CAST(vol_change > 0 AS INTEGER), 0) AS vol_up FROM (
      SELECT *, realized_vol - lag(realized_vol) OVER (PARTITION BY series ORDER BY date) AS vol_change FROM vol)""",
    "vol",
)


def preds(spark: SparkSession, d: str) -> DataFrame:
    """Headline-level predictions."""
    p = F.col("value") / (F.col("value") + 50)
    return table(spark, d, "events").select(
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("source"),
        p.alias("p"),
        F.col("event_type").isin("error", "purchase").cast("int").alias("y"),
        (p > 0.5).cast("int").alias("yhat"),
    )


cte(
    "preds",
    """SELECT event_id, ts, CAST(ts AS DATE) AS date, event_type AS source, value / (value + 50) AS p,
      CAST(event_type IN ('error', 'purchase') AS INTEGER) AS y,
      CAST(value / (value + 50) > CAST(0.5 AS DOUBLE) AS INTEGER) AS yhat FROM events""",
)
cte(
    "daily",
    """SELECT date, arg_min(y, event_id) AS true_label, avg(p) AS prediction_mean_proba,
      CAST(avg(p) > CAST(0.5 AS DOUBLE) AS INTEGER) AS prediction_mean_class,
      CAST(sum(yhat) >= count(*) / 2.0 AS INTEGER) AS prediction_majority_vote,
      max(p) AS prediction_max_proba, CAST(max(p) > CAST(0.5 AS DOUBLE) AS INTEGER) AS prediction_max_class,
      count(*) AS num_headlines
    FROM preds GROUP BY date""",
    "preds",
)


def daily(spark: SparkSession, d: str) -> DataFrame:
    from voltide.operators.votes import daily_vote

    return daily_vote(preds(spark, d), pred="yhat", label="y", order="event_id")


def metrics(spark: SparkSession, d: str) -> DataFrame:
    """The long metrics table."""
    return table(spark, d, "events").select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"))


cte("metrics", "SELECT event_id AS id, ts, event_type AS metric_name, value AS metric_value FROM events")
cte(
    "rules",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{r}', '{m}', '{o}', CAST({t} AS DOUBLE), CAST({s} AS BIGINT), '{v}')" for r, m, o, t, s, v in RULES)
    + ") AS t(rule, metric, op, threshold, for_seconds, severity)",
)
cte(
    "judged",
    """SELECT rule, severity, for_seconds, metric, threshold, id, ts, metric_value,
      CASE op WHEN 'lt' THEN metric_value < threshold WHEN 'le' THEN metric_value <= threshold
        WHEN 'gt' THEN metric_value > threshold WHEN 'ge' THEN metric_value >= threshold ELSE metric_value = threshold END AS breach
    FROM metrics JOIN rules ON metric_name = metric""",
    "metrics",
    "rules",
)


def asof(df: DataFrame, ts: str = "ts") -> Column:
    """The newest time of the data stands for "now"."""
    return df.agg(F.max(ts)).scalar()


def tall(spark: SparkSession, d: str) -> DataFrame:
    """Tall text with target: labelled documents."""
    docs, labels = table(spark, d, "documents", "doc_id", "text", spread_by="doc_id"), table(spark, d, "labels", "doc_id", "quality")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return docs.join(labels, "doc_id", "inner").select("doc_id", day.alias("date"), F.col("text").alias("Headline"), F.col("quality").alias("vol_up"))


cte(
    "tall",
    """SELECT doc_id, CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS date, text AS Headline, quality AS vol_up
    FROM documents JOIN labels USING (doc_id)""",
)


def labels_by_day(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the tall rows without their text, as one long series."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return table(spark, d, "labels").select(F.lit("all").alias("series"), "doc_id", day.alias("date"), F.col("quality").alias("vol_up"))


cte(
    "label_rows",
    """SELECT 'all' AS series, doc_id, CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS DATE) AS date, quality AS vol_up FROM labels""",
)


def wide(spark: SparkSession, d: str) -> DataFrame:
    """Wide news: one row per conversation, turns 0..7 as Top1..Top8, some of them blanked."""
    turns = table(spark, d, "conversations", "conv_id", "turn", "text")
    blank = (F.col("conv_id") % 7 == 0) & (F.col("turn") % 3 == 1)
    slots = [F.max(F.when(F.col("turn") == i, F.when(blank, "  ").otherwise(F.col("text")))).alias(s) for i, s in enumerate(SLOTS)]
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 36500).cast("int"))
    flat = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), *slots)
    return flat.select("conv_id", day.alias("Date"), (F.col("n_turns") % 2).cast("int").alias("Label"), "n_turns", *SLOTS)


cte(
    "wide",
    "SELECT conv_id, CAST(DATE '2024-01-01' + CAST(conv_id % 36500 AS INTEGER) AS DATE) AS Date, CAST(count(*) % 2 AS INTEGER) AS Label, count(*) AS n_turns, "
    + ", ".join(f"max(CASE WHEN turn = {i} THEN CASE WHEN conv_id % 7 = 0 AND turn % 3 = 1 THEN '  ' ELSE text END END) AS {s}" for i, s in enumerate(SLOTS))
    + " FROM conversations GROUP BY conv_id",
)


def _event_features(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        "ts",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        "event_type",
        F.col("event_type").isin("error", "purchase").cast("int").alias("y"),
        (F.col("value") > 50).cast("int").alias("yhat"),
        "props",
    )


def drift_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, d, "events")
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    return _event_features(events.where(F.col("ts") < cut)), _event_features(events.where(F.col("ts") >= cut))


cte(
    "sides",
    """SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_type,
      CAST(event_type IN ('error', 'purchase') AS INTEGER) AS y, CAST(value > 50 AS INTEGER) AS yhat,
      CAST(ts >= TIMESTAMP '2024-01-21' AS INTEGER) AS is_current FROM events""",
)
cte(
    "long_num",
    """SELECT 'value' AS "column", value AS v, is_current FROM sides UNION ALL SELECT 'k', k, is_current FROM sides""",
    "sides",
)
cte(
    "ecdf",
    """SELECT "column", v, sum(n_ref) OVER w / sum(n_ref) OVER (PARTITION BY "column") AS f_ref, sum(n_cur) OVER w / sum(n_cur) OVER (PARTITION BY "column") AS f_cur,
      lead(v) OVER (PARTITION BY "column" ORDER BY v) AS v_next FROM (
        SELECT "column", v, CAST(count(*) FILTER (is_current = 0) AS DOUBLE) AS n_ref, CAST(count(*) FILTER (is_current = 1) AS DOUBLE) AS n_cur FROM long_num GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY "column" ORDER BY v)""",
    "long_num",
)
cte(
    "cat_counts",
    """SELECT "column", v, CAST(count(*) FILTER (is_current = 0) AS DOUBLE) AS n_ref, CAST(count(*) FILTER (is_current = 1) AS DOUBLE) AS n_cur FROM (
      SELECT 'event_type' AS "column", event_type AS v, is_current FROM sides UNION ALL
      SELECT 'y', CAST(y AS VARCHAR), is_current FROM sides UNION ALL SELECT 'yhat', CAST(yhat AS VARCHAR), is_current FROM sides) GROUP BY 1, 2""",
    "sides",
)
cte(
    "cat_stats",
    """SELECT "column", count(*) AS categories,
      sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js_distance,
      sum(CASE WHEN p > 0 THEN (n_cur - p * cur_total) ** 2 / (p * cur_total) END) AS chi_square
    FROM (SELECT *, n_ref / sum(n_ref) OVER (PARTITION BY "column") AS p, n_cur / sum(n_cur) OVER (PARTITION BY "column") AS q,
      sum(n_cur) OVER (PARTITION BY "column") AS cur_total FROM cat_counts) GROUP BY 1""",
    "cat_counts",
)

cte(
    "days",
    "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice / (o_totalprice + 250000) AS p FROM orders",
)
cte("sided", "SELECT *, CASE WHEN date < DATE '2024-01-21' THEN 'reference' ELSE 'current' END AS side FROM preds", "preds")
