"""Streaming jobs run over the available input, and their batch forms."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from voltide.catalog.inputs import RULES, preds
from voltide.catalog.registry import cte, query, r6, table
from voltide.catalog.scores import HALF, KEYWORD, _band_sql
from voltide.catalog.training import _exact_model
from voltide.operators.joins import rule_table
from voltide.operators.ordering import scratch_path
from voltide.operators.registry import Registry
from voltide.streaming import alerting as A
from voltide.streaming import jobs as J
from voltide.streaming.scoring import RegisteredScorer, score_stream, scored

VOTE = f"""SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, (date_trunc('day', ts) + INTERVAL 1 DAY)::TIMESTAMP AS window_end, count(*) AS num_headlines, round(avg(p), 6) AS prediction_mean_proba,
  CAST(avg(p) > {HALF} AS INTEGER) AS prediction_mean_class, CAST(sum(yhat) >= count(*) / 2.0 AS INTEGER) AS prediction_majority_vote,
  round(max(p), 6) AS prediction_max_proba, CAST(max(p) > {HALF} AS INTEGER) AS prediction_max_class FROM preds GROUP BY 1, 2"""

SLIDING = """SELECT w AS window_start, w + INTERVAL 5 MINUTES AS window_end, event_type, count(*) AS n_values, count(*) FILTER (value > 60) AS n_breaches FROM (
  SELECT event_type, value, unnest([date_trunc('minute', ts)::TIMESTAMP - to_minutes(CAST(i AS INTEGER)) for i in range(5)]) AS w FROM events) GROUP BY 1, 2, 3"""


def zone_free(df):
    """The windows as zone-free times again, in the session's zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _stream(spark, d, name, *, max_files=None):
    """A table as a stream; it is one file or a folder of part files. A file source takes a single file only
    from a glob, and a glob of one name finds either."""
    schema = spark.read.parquet(f"{d}/{name}.parquet").schema
    return J.read_stream(spark, f"{d}/{{{name}.parquet}}", schema, max_files=max_files)


@query(
    f"""SELECT conv_id, turn, round(p, 4) AS prediction_probability, CAST(p >= {HALF} AS INTEGER) AS prediction_class, {_band_sql('>=', '<=')} AS confidence_level, 'rules' AS model_version
    FROM (SELECT conv_id, turn, {KEYWORD} AS p FROM conversations)"""
)
def stream_score(spark, d):
    rows = _stream(spark, d, "conversations").select("conv_id", "turn", "text")
    path = J.run_available(J.score_rows(rows, text="text").drop("text"), "scored")
    return spark.read.parquet(path)


@query(
    f"SELECT * FROM ({VOTE}) WHERE window_end <= (SELECT max(ts) FROM preds) - INTERVAL 1 HOUR",
    "preds",
)
def stream_daily_vote(spark, d):
    rows = _stream(spark, d, "events").select("ts", (F.col("value") / (F.col("value") + 50)).alias("p"))
    path = J.run_available(J.stream_daily_vote(rows), "votes")
    return r6(zone_free(spark.read.parquet(path)))


@query(
    f"SELECT * FROM ({SLIDING}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES",
)
def stream_metric_breach(spark, d):
    rows = _stream(spark, d, "events").select("ts", "event_type", "value")
    path = J.run_available(J.stream_metric_breach(rows, by=["event_type"], breach=F.col("value") > 60), "breaches")
    return zone_free(spark.read.parquet(path))


@query(VOTE, "preds")
def tumbling_vote(spark, d):
    votes = J.tumbling_vote(preds(spark, d).select("ts", "p"))
    return r6(votes)


@query(SLIDING)
def sliding_breach(spark, d):
    rows = table(spark, d, "events").select("ts", "event_type", "value")
    return J.sliding_breach(rows, by=["event_type"], breach=F.col("value") > 60)


cte("walked", "SELECT * FROM (SELECT rule, severity, for_seconds, id, ts, coalesce(breach, false) AS breach FROM judged) WHERE ts <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTES FROM events)", "judged")
cte(
    "placed",
    """SELECT *, CASE WHEN breach THEN min(ts) OVER (PARTITION BY rule, breach, island) END AS started, CASE WHEN breach THEN row_number() OVER (PARTITION BY rule, breach, island ORDER BY ts, id) ELSE 0 END AS n FROM (
      SELECT *, sum(CAST(NOT breach AS BIGINT)) OVER (PARTITION BY rule ORDER BY ts, id) AS island FROM walked)""",
    "walked",
)
cte("chained", "SELECT *, lag(ts) OVER w AS prev, lag(breach) OVER w AS was, lag(started) OVER w AS run_started, coalesce(lag(n) OVER w, 0) AS run_n FROM placed WINDOW w AS (PARTITION BY rule ORDER BY ts, id)", "placed")
cte("fired", "SELECT rule, severity, island, started, min(ts) AS \"at\", arg_min(n, ts) AS n FROM placed WHERE breach AND epoch_us(ts) - epoch_us(started) >= for_seconds * 1000000 GROUP BY ALL", "placed")
SILENT = "epoch_us(ts) - epoch_us(prev) > 600000000"


@query(
    f"""SELECT rule, severity, transition, "at", started, CAST(n_values AS BIGINT) AS n_values FROM (
      SELECT rule, severity, 'pending' AS transition, ts AS "at", started, 1 AS n_values FROM placed WHERE breach AND n = 1 AND for_seconds > 0 UNION ALL
      SELECT rule, severity, 'firing', "at", started, n FROM fired UNION ALL
      SELECT c.rule, c.severity, CASE WHEN f."at" IS NULL THEN 'inactive' ELSE 'resolved' END, c.ts, c.run_started, c.run_n FROM chained c LEFT JOIN fired f ON f.rule = c.rule AND f.island = c.island - 1 WHERE NOT c.breach AND c.was UNION ALL
      SELECT rule, severity, 'nodata', prev + INTERVAL 10 MINUTES, run_started, run_n FROM chained WHERE {SILENT} UNION ALL
      SELECT rule, severity, 'data', ts, run_started, run_n FROM chained WHERE {SILENT} UNION ALL
      SELECT rule, severity, 'nodata', ts + INTERVAL 10 MINUTES, started, n FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY ts DESC, id DESC) AS back FROM placed)
        WHERE back = 1 AND ts + INTERVAL 10 MINUTES < (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTES FROM events))""",
    "chained",
    "fired",
)
def stream_alert_state(spark, d):
    """Transitions of all rules up to the watermark, by a state per rule."""
    rows = _stream(spark, d, "events").select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"))
    path = A.run_alerts(A.alert_transitions(rows, rule_table(spark, RULES)))
    return spark.read.parquet(path).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "started")})


@query(
    f"SELECT event_id, round(p, 4) AS prediction_probability, CAST(p >= 0.5 AS INTEGER) AS prediction_class, {_band_sql('>=', '<=')} AS confidence_level, '1' AS model_version FROM ex_p",
    "ex_p",
)
def stream_score_registered(spark, d):
    """The rows of a stream, scored with the saved model that the registry names for each micro-batch."""
    model, test = _exact_model(spark, d)
    registry = Registry(spark, scratch_path(spark, "registry"))
    at = datetime(2024, 2, 1)
    registry.move("volatility", registry.register("volatility", model, at=at), "Production", at=at)
    source = scratch_path(spark, "headlines")
    test.select("event_id", "Headline", "flag").write.parquet(source)
    scorer = RegisteredScorer(registry, "volatility", scratch_path(spark, "scored"), text="Headline", numeric=["flag"], keep=["event_id"])
    score_stream(J.read_stream(spark, source, spark.read.parquet(source).schema), scorer).awaitTermination()
    return scored(scorer).drop("batch")
