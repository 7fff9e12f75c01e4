"""Scalars, votes and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.catalog.inputs import SLOTS, asof, daily, metrics, preds, target, wide
from voltide.catalog.registry import query, r6, table
from voltide.functions import scalars as S
from voltide.operators import metrics as M
from voltide.streaming.jobs import score_rows
from voltide.operators import models as ML
from voltide.operators import votes as V

HALF = "CAST(0.5 AS DOUBLE)"
DAILY = """SELECT date, true_label, round(prediction_mean_proba, 6) AS prediction_mean_proba, prediction_mean_class, prediction_majority_vote,
  round(prediction_max_proba, 6) AS prediction_max_proba, prediction_max_class, num_headlines FROM daily"""


def _kw_sql(words, weight):
    return " + ".join(f"CASE WHEN contains(lower(text), '{w}') THEN CAST({weight} AS DOUBLE) ELSE 0 END" for w in words)


KEYWORD = f"least(1::DOUBLE, greatest(0::DOUBLE, {HALF} + {_kw_sql(S.UP_WORDS + S.DOWN_WORDS, S.VOLATILE_WEIGHT)} - ({_kw_sql(S.CALM_WORDS, S.CALM_WEIGHT)})))"
SIMPLE = f"least(CAST(0.9 AS DOUBLE), greatest(CAST(0.1 AS DOUBLE), {HALF} + {_kw_sql(S.SIMPLE_WORDS, S.VOLATILE_WEIGHT)}))"


@query("SELECT doc_id, length(text) AS n FROM documents")
def headline_length(spark, d):
    return table(spark, d, "documents").select("doc_id", S.headline_length("text").cast("bigint").alias("n"))


@query("SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS n FROM documents")
def word_count(spark, d):
    return _texts(spark, d).select("doc_id", S.word_count("text").cast("bigint").alias("n"))


@query("SELECT conv_id, " + ", ".join(f"regexp_matches({s}, '\\S') AS ok_{s}" for s in SLOTS) + " FROM wide", "wide")
def nonblank(spark, d):
    return wide(spark, d).select("conv_id", *[S.nonblank(s).alias(f"ok_{s}") for s in SLOTS])


@query(f"SELECT doc_id, round({KEYWORD}, 6) AS score FROM documents")
def keyword_score(spark, d):
    return r6(_texts(spark, d).select("doc_id", S.keyword_score("text").alias("score")))


@query(f"SELECT doc_id, round({SIMPLE}, 6) AS score FROM documents")
def keyword_score_simple(spark, d):
    return r6(_texts(spark, d).select("doc_id", S.keyword_score_simple("text").alias("score")))


def _texts(spark, d):
    return table(spark, d, "documents", "doc_id", "text", spread_by="doc_id")


@query(f"SELECT event_id, CAST(p > {HALF} AS INTEGER) AS batch_class, CAST(p >= {HALF} AS INTEGER) AS online_class FROM preds", "preds")
def class_threshold(spark, d):
    return preds(spark, d).select("event_id", S.class_threshold("p").alias("batch_class"), S.class_threshold("p", inclusive=True).alias("online_class"))


@query("SELECT event_id, round(abs(p - 0.5) * 2, 6) AS confidence FROM preds", "preds")
def confidence(spark, d):
    return r6(preds(spark, d).select("event_id", S.confidence("p").alias("confidence")))


def _band_sql(a, b):
    edge = lambda x: f"CAST({x} AS DOUBLE)"
    return f"CASE WHEN p {a} {edge(0.7)} OR p {b} {edge(0.3)} THEN 'High' WHEN p {a} {edge(0.6)} OR p {b} {edge(0.4)} THEN 'Medium' ELSE 'Low' END"


@query(f"SELECT event_id, {_band_sql('>=', '<=')} AS band, {_band_sql('>', '<')} AS strict_band FROM preds", "preds")
def confidence_band(spark, d):
    return preds(spark, d).select("event_id", S.confidence_band("p").alias("band"), S.confidence_band("p", inclusive=False).alias("strict_band"))


@query(f"SELECT event_id, CASE WHEN yhat = 1 THEN '{S.TEXT_UP}' ELSE '{S.TEXT_DOWN}' END AS interpretation FROM preds", "preds")
def interpretation(spark, d):
    return preds(spark, d).select("event_id", S.interpretation("yhat").alias("interpretation"))


@query(
    f"""SELECT event_id, CASE WHEN source = 'view' THEN 0 ELSE yhat END AS prediction_class, CASE WHEN source = 'view' THEN 0.5 ELSE round(p, 6) END AS prediction_proba,
      CASE WHEN source = 'view' THEN 0 ELSE round(abs(p - 0.5) * 2, 6) END AS confidence,
      CASE WHEN source = 'view' THEN '{S.TEXT_ERROR}' WHEN yhat = 1 THEN '{S.TEXT_UP}' ELSE '{S.TEXT_DOWN}' END AS interpretation,
      CASE WHEN source = 'view' THEN 'no score' END AS error FROM preds""",
    "preds",
)
def prediction_error_row(spark, d):
    """Scores of one event type are lost; their rows become error rows."""
    rows = preds(spark, d).select("event_id", F.when(F.col("source") != "view", F.col("p")).alias("p"))
    return r6(ML.with_response(rows).drop("p"))


@query("SELECT event_id, round(p, 4) AS p4, round(value, 1) AS v1 FROM preds JOIN events USING (event_id)", "preds")
def row_round(spark, d):
    return table(spark, d, "events").select("event_id", F.round(F.col("value") / (F.col("value") + 50), 4).alias("p4"), F.round("value", 1).alias("v1"))


@query("SELECT event_id, epoch_us(ts) / CAST(1000 AS DOUBLE) AS millis FROM events")
def epoch_millis(spark, d):
    return table(spark, d, "events").select("event_id", S.epoch_millis("ts").alias("millis"))


@query(
    f"""SELECT conv_id, turn, text AS headline, CAST(p >= {HALF} AS INTEGER) AS prediction_class, round(p, 4) AS prediction_probability, {_band_sql('>=', '<=')} AS confidence_level,
      'rules' AS model_version, TIMESTAMP '2024-02-01 00:00:00' AS timestamp FROM (SELECT conv_id, turn, text, {KEYWORD} AS p FROM conversations)"""
)
def json_request(spark, d):
    """Headlines packed into JSON requests, parsed, scored, and answered as JSON; the whole response row."""
    requests = table(spark, d, "conversations").select("conv_id", "turn", F.to_json(F.struct(F.col("text").alias("headline"))).alias("request"))
    parsed = requests.select("conv_id", "turn", F.from_json("request", "headline string").headline.alias("headline"))
    scored = score_rows(parsed, text="headline", asof=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    fields = [c for c in scored.columns if c not in ("conv_id", "turn")]
    answers = scored.select("conv_id", "turn", F.to_json(F.struct(*fields)).alias("response"))
    kinds = "headline string, prediction_probability double, prediction_class int, confidence_level string, model_version string, timestamp timestamp_ntz"
    return answers.select("conv_id", "turn", F.from_json("response", kinds).alias("r")).select("conv_id", "turn", "r.*")


@query(DAILY, "daily")
def daily_vote(spark, d):
    return r6(daily(spark, d))


@query(
    """SELECT date, coalesce(num_headlines, 0) AS num_headlines, coalesce(round(prediction_mean_proba, 6), 0.5) AS prediction_mean_proba,
      coalesce(prediction_mean_class, 0) AS prediction_mean_class, coalesce(prediction_majority_vote, 0) AS prediction_majority_vote,
      coalesce(round(prediction_max_proba, 6), 0.5) AS prediction_max_proba, coalesce(prediction_max_class, 0) AS prediction_max_class,
      CASE WHEN num_headlines IS NULL THEN 'No headlines provided' END AS error
    FROM (SELECT CAST(unnest(generate_series(min(date), max(date) + 7, INTERVAL 1 DAY)) AS DATE) AS date FROM days)
    LEFT JOIN (SELECT date, count(*) AS num_headlines, avg(p) AS prediction_mean_proba, CAST(avg(p) > 0.5 AS INTEGER) AS prediction_mean_class,
        CAST(sum(CAST(p > 0.5 AS INTEGER)) >= count(*) / 2.0 AS INTEGER) AS prediction_majority_vote, max(p) AS prediction_max_proba,
        CAST(max(p) > 0.5 AS INTEGER) AS prediction_max_class FROM days GROUP BY date) USING (date)""".replace("0.5", HALF),
    "days",
)
def daily_vote_empty(spark, d):
    """Votes of all orders by day; the calendar adds days without orders and the week to come."""
    rows = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date"), (F.col("o_totalprice") / (F.col("o_totalprice") + 250000)).alias("p"))
    votes = V.daily_vote(rows)
    return r6(V.daily_vote_empty(V.day_calendar(rows, date="date", ahead=7), votes))


REQ = f"SELECT conv_id, turn, {KEYWORD} AS p FROM conversations"


@query(
    f"""SELECT conv_id, count(*) AS headlines_count, round(avg(p), 4) AS mean_probability, CAST(avg(p) >= {HALF} AS INTEGER) AS mean_prediction,
      CAST(sum(CAST(p >= {HALF} AS INTEGER)) > count(*) / 2.0 AS INTEGER) AS majority_vote,
      CAST(arg_min(p, (-p, turn)) >= {HALF} AS INTEGER) AS max_prob_class, round(max(p), 4) AS max_prob_value FROM ({REQ}) GROUP BY conv_id"""
)
def api_vote(spark, d):
    return V.api_vote(_requests(spark, d), group="conv_id")


def _requests(spark, d):
    turns = table(spark, d, "conversations", "conv_id", "turn", "text", spread_by="conv_id")
    return turns.select("conv_id", "turn", S.keyword_score("text").alias("p"))


@query(
    f"""SELECT conv_id, list(CAST(p >= {HALF} AS INTEGER) ORDER BY turn, p) AS individual_predictions,
      list(round(p, 4) ORDER BY turn, p) AS individual_probabilities FROM ({REQ}) GROUP BY 1"""
)
def individual_arrays(spark, d):
    return V.individual_arrays(_requests(spark, d), group="conv_id", pos="turn")


@query(f"SELECT conv_id, turn, CAST(p >= {HALF} AS INTEGER) AS prediction, round(p, 4) AS probability FROM ({REQ})")
def individual_rows(spark, d):
    return V.individual_rows(_requests(spark, d), group="conv_id", pos="turn")


@query("SELECT conv_id, list_filter([" + ", ".join(SLOTS) + "], lambda x: regexp_matches(x, '\\S')) AS headlines FROM wide", "wide")
def collect_day_headlines(spark, d):
    return V.collect_day_headlines(wide(spark, d), ids=["conv_id"], slots=SLOTS)


@query("SELECT round(avg(CAST(prediction_majority_vote = prediction_mean_class AS DOUBLE)), 6) AS agreement_rate FROM daily", "daily")
def agreement_rate(spark, d):
    return r6(V.agreement_rate(daily(spark, d), left="prediction_majority_vote", right="prediction_mean_class"))


@query("SELECT date, round(avg(y), 6) AS mean_value FROM preds GROUP BY date", "preds")
def group_mean_by_date(spark, d):
    return r6(V.group_mean_by_date(preds(spark, d), date="date", value="y"))


@query("SELECT event_id, date, CASE WHEN yhat = y THEN 'Correct' ELSE 'Incorrect' END AS verdict FROM preds", "preds")
def day_correctness(spark, d):
    verdict = F.when(F.col("yhat") == F.col("y"), "Correct").otherwise("Incorrect")
    return preds(spark, d).select("event_id", "date", verdict.alias("verdict"))


TP, FP, FN, TN = (f"count(*) FILTER ({c})" for c in ("y = 1 AND yhat = 1", "y = 0 AND yhat = 1", "y = 1 AND yhat = 0", "y = 0 AND yhat = 0"))
F1 = f"coalesce(2.0 * {TP} / nullif(2 * {TP} + {FP} + {FN}, 0), 0)"
ACC = "avg(CAST(y = yhat AS DOUBLE))"


def _auc_sql(by: str, src: str) -> str:
    """Rank form: mean ranks of the positives."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}(sum(r) FILTER (y = 1) - cp * (cp + 1) / 2) / nullif(cp * cn, 0) AS auc FROM (
      SELECT {keys}y, rank() OVER ({part} ORDER BY p) + (count(*) OVER (PARTITION BY {keys}p) - 1) / 2.0 AS r,
        CAST(sum(y) OVER ({part}) AS DOUBLE) AS cp, CAST(sum(1 - y) OVER ({part}) AS DOUBLE) AS cn FROM {src}) {group if by else ''} {'GROUP BY cp, cn' if not by else ', cp, cn'}"""


@query(f"SELECT round({ACC}, 6) AS accuracy FROM preds", "preds")
def accuracy(spark, d):
    return r6(M.accuracy(preds(spark, d)))


@query(f"SELECT source, round({F1}, 6) AS f1 FROM preds GROUP BY source", "preds")
def f1_score(spark, d):
    return r6(M.f1_score(preds(spark, d), by=["source"]))


@query(f"SELECT round(auc, 6) AS auc FROM ({_auc_sql('', 'preds')})", "preds")
def roc_auc(spark, d):
    return r6(M.roc_auc(preds(spark, d)))


KINDS = "(SELECT *, CASE WHEN event_id % 3 = 0 THEN 'both' ELSE source END AS kind FROM preds)"


@query(f"SELECT kind, round(coalesce(auc, 0.5), 6) AS auc FROM ({_auc_sql('kind', KINDS)})", "preds")
def roc_auc_guarded(spark, d):
    """An event type has one class only, where the guard answers .5; the group of all types has two."""
    kind = F.when(F.col("event_id") % 3 == 0, "both").otherwise(F.col("source"))
    return r6(M.roc_auc(preds(spark, d).withColumn("kind", kind), by=["kind"], single_class=0.5))


@query(f"SELECT 0 AS y, 0 AS yhat, {TN} AS n FROM preds UNION ALL SELECT 0, 1, {FP} FROM preds UNION ALL SELECT 1, 0, {FN} FROM preds UNION ALL SELECT 1, 1, {TP} FROM preds", "preds")
def confusion_matrix(spark, d):
    return M.confusion_matrix(preds(spark, d))


PER_CLASS = """SELECT k AS label, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(said + support, 0), 0) AS f1, support, tp FROM (
  SELECT k, CAST(count(*) FILTER (y = k AND yhat = k) AS DOUBLE) AS tp, CAST(count(*) FILTER (yhat = k) AS DOUBLE) AS said, count(*) FILTER (y = k) AS support FROM preds, (VALUES (0), (1)) AS t(k) GROUP BY k)"""


@query(
    f"""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
      SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support FROM ({PER_CLASS}) UNION ALL
      SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM ({PER_CLASS}) UNION ALL
      SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM ({PER_CLASS}) UNION ALL
      SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM ({PER_CLASS}))""",
    "preds",
)
def classification_report(spark, d):
    return r6(M.classification_report(preds(spark, d)))


LOSS = "avg(CASE WHEN y = 1 THEN -ln(least(greatest(p, 1e-15), 1 - 1e-15)) ELSE -ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)) END)"


@query(
    f"""SELECT side, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(log_loss, 6) AS log_loss, n, round(auc, 6) AS auc FROM (
      SELECT side, {ACC} AS accuracy, coalesce(CAST({TP} AS DOUBLE) / nullif({TP} + {FP}, 0), 0) AS precision, coalesce(CAST({TP} AS DOUBLE) / nullif({TP} + {FN}, 0), 0) AS recall,
        {F1} AS f1, {LOSS} AS log_loss, count(*) AS n FROM sided GROUP BY side) JOIN ({_auc_sql('side', 'sided')}) USING (side)""",
    "sided",
)
def classification_quality(spark, d):
    return r6(M.classification_scores(_sided(spark, d), by=["side"]))


GAPS = """(SELECT event_id, yhat, CASE WHEN event_id % 7 <> 0 THEN p END AS p, CASE WHEN event_id % 11 <> 0 THEN y END AS y,
  CASE WHEN event_id % 5 <> 0 THEN event_id % 5 END AS grp FROM preds)"""
KNOWN = f"(SELECT grp, coalesce(grp, -1) AS g, y, p FROM {GAPS} WHERE y IS NOT NULL AND p IS NOT NULL)"


@query(
    f"""SELECT grp, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(log_loss, 6) AS log_loss, n, round(auc, 6) AS auc FROM (
      SELECT grp, avg(CASE WHEN y IS NOT NULL AND yhat IS NOT NULL THEN CAST(y = yhat AS INTEGER) END) AS accuracy,
        coalesce(2.0 * count(*) FILTER (y = 1 AND yhat = 1) / nullif(2 * count(*) FILTER (y = 1 AND yhat = 1) + count(*) FILTER (y = 0 AND yhat = 1) + count(*) FILTER (y = 1 AND yhat = 0), 0), 0) AS f1,
        avg(CASE WHEN y = 1 AND p IS NOT NULL THEN -ln(greatest(p, 1e-15)) WHEN y = 0 AND p IS NOT NULL THEN -ln(1 - least(p, 1 - 1e-15)) END) AS log_loss, count(*) AS n FROM {GAPS} GROUP BY grp)
      LEFT JOIN (SELECT g, auc FROM ({_auc_sql('g', KNOWN)})) ON g = coalesce(grp, -1)""",
    "preds",
)
def classification_gaps(spark, d):
    """Scores, labels and groups with unknown values: each measure is over the rows that have what it needs."""
    i = F.col("event_id")
    rows = preds(spark, d).select(
        "yhat", F.when(i % 7 != 0, F.col("p")).alias("p"), F.when(i % 11 != 0, F.col("y")).alias("y"), F.when(i % 5 != 0, i % 5).alias("grp")
    )
    return r6(M.classification_scores(rows, by=["grp"]).select("grp", "accuracy", "f1", "log_loss", "n", "auc"))


def _sided(spark, d):
    cut = F.lit("2024-01-21").cast("date")
    return preds(spark, d).withColumn("side", F.when(F.col("date") < cut, "reference").otherwise("current"))


@query(
    f"SELECT 'accuracy' AS metric, round({ACC}, 6) AS value FROM preds UNION ALL SELECT 'f1', round({F1}, 6) FROM preds UNION ALL SELECT 'auc', round(auc, 6) FROM ({_auc_sql('', 'preds')})",
    "preds",
)
def headline_metrics(spark, d):
    return r6(M.headline_metrics(preds(spark, d)))


METHOD_ROWS = """(SELECT 'mean_proba' AS method, true_label AS y, prediction_mean_class AS yhat, prediction_mean_proba AS p FROM daily UNION ALL
  SELECT 'majority_vote', true_label, prediction_majority_vote, NULL FROM daily UNION ALL
  SELECT 'max_proba', true_label, prediction_max_class, prediction_max_proba FROM daily)"""
METHODS = f"""SELECT method, a.accuracy, a.f1, b.auc FROM (SELECT method, {ACC} AS accuracy, {F1} AS f1 FROM {METHOD_ROWS} GROUP BY method) a
  LEFT JOIN ({_auc_sql('method', "(SELECT * FROM " + METHOD_ROWS + " WHERE p IS NOT NULL)")}) b USING (method)"""


@query(f"SELECT method, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(auc, 6) AS auc FROM ({METHODS})", "daily")
def vote_method_metrics(spark, d):
    return r6(M.vote_method_metrics(daily(spark, d)))


@query(
    f"""SELECT level, metric, round(value, 6) AS value FROM (
      SELECT 'headline' AS level, 'accuracy' AS metric, {ACC} AS value FROM preds UNION ALL SELECT 'headline', 'f1', {F1} FROM preds UNION ALL SELECT 'headline', 'auc', auc FROM ({_auc_sql('', 'preds')}) UNION ALL
      SELECT 'daily_' || method, 'accuracy', accuracy FROM ({METHODS}) UNION ALL SELECT 'daily_' || method, 'f1', f1 FROM ({METHODS}) UNION ALL
      SELECT 'daily_' || method, 'auc', auc FROM ({METHODS}) WHERE auc IS NOT NULL UNION ALL
      SELECT 'size', 'num_test_days', count(*) FROM daily UNION ALL SELECT 'size', 'num_test_headlines', count(*) FROM preds)""",
    "daily",
)
def evaluate_test(spark, d):
    return r6(M.evaluate_test(preds(spark, d), order="event_id"))


YEARS = "(SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderstatus = 'F' AS INTEGER) AS y, CAST(o_totalprice > 250000 AS INTEGER) AS yhat, o_totalprice / 500000 AS p FROM orders)"


@query(f"SELECT year, round(accuracy, 6) AS accuracy, round(auc, 6) AS auc, days FROM (SELECT year, {ACC} AS accuracy, count(*) AS days FROM {YEARS} GROUP BY year) JOIN ({_auc_sql('year', YEARS)}) USING (year)")
def yearly_metrics(spark, d):
    price = F.col("o_totalprice")
    rows = table(spark, d, "orders").select("o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("y"), (price > 250000).cast("int").alias("yhat"), (price / 500000).alias("p"))
    return r6(M.yearly_metrics(rows, date="o_orderdate", y="y", yhat="yhat", score="p"))


@query("SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS days, round(avg(y), 6) AS positive_share, round(greatest(avg(y), 1 - avg(y)), 6) AS baseline_accuracy FROM preds", "preds")
def baseline_stats(spark, d):
    return r6(M.baseline_stats(preds(spark, d), date="date", y="y"))


@query("SELECT vol_up, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM target GROUP BY vol_up", "target")
def class_distribution(spark, d):
    return r6(M.class_distribution(target(spark, d), "vol_up"))


@query("SELECT side, y, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY side), 6) AS share FROM sided GROUP BY side, y", "sided")
def class_balance(spark, d):
    """Classes of the reference and of the current rows."""
    return r6(M.class_distribution(_sided(spark, d), "y", by=["side"]))


@query('SELECT "column", n_missing FROM (' + " UNION ALL ".join(f"SELECT '{s}' AS \"column\", count(*) FILTER ({s} IS NULL) AS n_missing FROM wide" for s in SLOTS) + ") WHERE n_missing > 0", "wide")
def null_counts(spark, d):
    return M.null_counts(wide(spark, d).select("conv_id", *SLOTS))


@query(
    """SELECT y, n, round(total / (k * n), 6) AS weight, round((total / (k * n)) / (total / (k * zero)), 6) AS weight_ratio FROM (
      SELECT y, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total, count(*) OVER () AS k, CAST(sum(count(*) FILTER (y = 0)) OVER () AS DOUBLE) AS zero FROM preds GROUP BY y)""",
    "preds",
)
def class_weights(spark, d):
    return r6(M.class_weights(preds(spark, d), y="y"))


BINS = "CAST(least(floor((p - lo) / ((hi - lo) / {b})), {b} - 1) AS INTEGER)"
EDGED = "(SELECT *, min(p) OVER () AS lo, max(p) OVER () AS hi FROM preds)"


@query(f"SELECT {BINS.format(b=50)} AS bin, count(*) AS n FROM {EDGED} GROUP BY 1", "preds")
def histogram(spark, d):
    return M.histogram(preds(spark, d), col="p", bins=50)


@query(f"SELECT y, bin, n, round(n / (sum(n) OVER (PARTITION BY y) * w), 6) AS density FROM (SELECT y, {BINS.format(b=20)} AS bin, count(*) AS n, any_value((hi - lo) / 20) AS w FROM {EDGED} GROUP BY 1, 2)", "preds")
def histogram_density(spark, d):
    return r6(M.histogram(preds(spark, d), col="p", bins=20, by=["y"], density=True))


@query("SELECT metric_name, count(*) AS n, min(metric_value) AS min_val, max(metric_value) AS max_val, round(avg(metric_value), 6) AS avg_val FROM metrics WHERE ts > (SELECT max(ts) FROM metrics) - INTERVAL 2 MONTHS GROUP BY 1", "metrics")
def metric_stats(spark, d):
    rows = metrics(spark, d)
    return r6(M.metric_stats(rows, name="metric_name", value="metric_value", ts="ts", since=asof(rows) - F.expr("INTERVAL 2 MONTHS")), "avg_val")


@query("SELECT round(avg(metric_value), 6) AS avg_value FROM metrics WHERE metric_name = 'error'", "metrics")
def metric_avg(spark, d):
    return r6(M.metric_avg(metrics(spark, d), value="metric_value", name="metric_name", names=["error"]))


@query("SELECT count(*) AS n_breaches FROM metrics WHERE ts > (SELECT max(ts) FROM metrics) - INTERVAL 6 HOURS AND metric_value < 20", "metrics")
def breach_count(spark, d):
    rows = metrics(spark, d)
    return M.breach_count(rows, ts="ts", asof=asof(rows), window="6 HOURS", condition=F.col("metric_value") < 20)


@query(
    """SELECT source, 'p' AS "column", q, round(quantile, 6) AS quantile FROM (
      SELECT source, CAST(0.05 AS DOUBLE) AS q, quantile_cont(p, 0.05) AS quantile FROM preds GROUP BY source UNION ALL SELECT source, CAST(0.95 AS DOUBLE), quantile_cont(p, 0.95) FROM preds GROUP BY source)""",
    "preds",
)
def column_quantile(spark, d):
    return r6(M.column_quantile(preds(spark, d), cols=["p"], by=["source"]), "quantile")


WIDE_X = "(SELECT *, 1 AS one, CAST(NULL AS INTEGER) AS nothing FROM wide)"
WIDE_COLS = ["n_turns", "Label", *SLOTS, "one", "nothing"]


@query(
    f"""SELECT count(*) AS n_rows, {len(WIDE_COLS)} AS n_columns, CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in WIDE_COLS)} AS BIGINT) AS n_missing_cells,
      CAST({' + '.join(f'(count(DISTINCT {c}) = 1)::INTEGER' for c in WIDE_COLS)} AS INTEGER) AS n_constant_columns, CAST({' + '.join(f'(count({c}) = 0)::INTEGER' for c in WIDE_COLS)} AS INTEGER) AS n_empty_columns,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(WIDE_COLS)} FROM {WIDE_X})) AS n_duplicated_rows FROM {WIDE_X}""",
    "wide",
)
def dataset_summary(spark, d):
    frame = wide(spark, d).select("n_turns", "Label", *SLOTS, F.lit(1).alias("one"), F.lit(None).cast("int").alias("nothing"))
    return M.dataset_summary(frame)


def _summary_sql(col):
    return f"""SELECT '{col}' AS "column", count({col}) AS n, count(*) - count({col}) AS n_missing, round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std, round(min({col}), 6)::DOUBLE AS min, round(max({col}), 6)::DOUBLE AS max,
      (SELECT CAST(arg_min({col}, (-c, {col})) AS DOUBLE) FROM (SELECT {col}, count(*) AS c FROM orders WHERE {col} IS NOT NULL GROUP BY 1)) AS most_common, count(DISTINCT {col}) AS n_distinct,
      round(quantile_cont({col}, 0.25), 6) AS p25, round(quantile_cont({col}, 0.5), 6) AS p50, round(quantile_cont({col}, 0.75), 6) AS p75 FROM orders"""


@query(" UNION ALL ".join(_summary_sql(c) for c in ("o_totalprice", "o_custkey")))
def column_summary(spark, d):
    return r6(M.column_summary(table(spark, d, "orders"), cols=["o_totalprice", "o_custkey"]))
