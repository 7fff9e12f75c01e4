"""Metric queries, alerts, drift, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.catalog.inputs import RULES, asof, bars, drift_sides, metrics, preds, wide
from voltide.catalog.registry import cte, query, r6, table
from voltide.catalog.scores import ACC, F1, _auc_sql
from voltide.operators import alerts as A
from voltide.operators import drift as D
from voltide.operators import joins as J
from voltide.operators import metrics as M
from voltide.operators import reports as R
from voltide.operators import text_drift as TD

LATEST = "SELECT metric_name, max(ts) AS ts, arg_max(metric_value, (ts, id)) AS metric_value FROM metrics GROUP BY 1"


@query(LATEST, "metrics")
def latest_per_metric(spark, d):
    return A.latest_per_metric(metrics(spark, d))


@query("SELECT metric_name, round(avg(metric_value), 6) AS avg_value, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY ts DESC, id DESC) AS rn FROM metrics) WHERE rn <= 10 GROUP BY 1", "metrics")
def avg_last_n(spark, d):
    return r6(A.avg_last_n(metrics(spark, d)))


@query(
    f"SELECT metric_name, metric_value AS latest_value, baseline, round(metric_value - baseline, 6) AS delta FROM ({LATEST}) JOIN (VALUES ('error', 50.0::DOUBLE), ('view', 20.0::DOUBLE)) AS b(metric_name, baseline) USING (metric_name)",
    "metrics",
)
def latest_vs_baseline(spark, d):
    return r6(A.latest_vs_baseline(metrics(spark, d), baselines={"error": 50.0, "view": 20.0}), "delta")


@query("SELECT id, ts, metric_name, metric_value FROM metrics WHERE metric_name IN ('error', 'purchase') ORDER BY ts, id", "metrics")
def metric_series(spark, d):
    return A.metric_series(metrics(spark, d), names=["error", "purchase"])


@query("SELECT id, ts, metric_name, metric_value FROM metrics WHERE metric_name IN ('error', 'view') AND ts > (SELECT max(ts) FROM metrics) - INTERVAL 1 DAY", "metrics")
def recent_metric_rows(spark, d):
    rows = metrics(spark, d)
    return A.recent_metric_rows(rows, names=["error", "view"], asof=asof(rows))


BANDS = [("error", 0.0, "green"), ("error", 60.0, "yellow"), ("error", 120.0, "red"), ("view", 0.0, "red"), ("view", 10.0, "yellow"), ("view", 30.0, "green")]
BAND_SQL = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({s} AS DOUBLE) AS step, '{c}' AS colour" for m, s, c in BANDS)


@query(
    f"SELECT id, metric_name, metric_value, arg_max(colour, step) FILTER (step <= metric_value) AS status FROM metrics LEFT JOIN ({BAND_SQL}) ON metric = metric_name GROUP BY 1, 2, 3",
    "metrics",
)
def status_band(spark, d):
    return A.status_band(metrics(spark, d), BANDS).drop("ts")


MSG = "CASE WHEN op IN ('lt', 'le') THEN format('Low {}: {:.3f} < {:.3f}', metric, value, threshold) ELSE format('High {}: {:.3f} > {:.3f}', metric, value, threshold) END"
RULE_TEST = "CASE op WHEN 'lt' THEN value < threshold WHEN 'le' THEN value <= threshold WHEN 'gt' THEN value > threshold WHEN 'ge' THEN value >= threshold ELSE value = threshold END"


@query(
    f"""SELECT rule, metric, round(value, 6) AS value, threshold, severity, {MSG} AS message FROM (
      SELECT metric_name, avg(metric_value) AS value FROM metrics GROUP BY 1) JOIN rules ON metric_name = metric WHERE {RULE_TEST}""",
    "metrics",
    "rules",
)
def check_alerts(spark, d):
    means = metrics(spark, d).groupBy("metric_name").agg(F.avg("metric_value").alias("metric_value"))
    return r6(A.check_alerts(means, J.rule_table(spark, RULES)), "value")


STATE = f"CASE WHEN value IS NULL THEN 'NoData' WHEN {RULE_TEST} THEN 'Alerting' ELSE 'OK' END"


@query(f"SELECT rule, metric, severity, value, threshold, {STATE} AS state FROM rules LEFT JOIN (SELECT metric_name, metric_value AS value FROM ({LATEST})) ON metric_name = metric", "metrics", "rules")
def alert_rules_latest(spark, d):
    return A.alert_rules_latest(metrics(spark, d), J.rule_table(spark, RULES))


@query(
    f"""SELECT rule, metric, severity, value, threshold, {STATE} AS state FROM rules LEFT JOIN (
      SELECT metric_name, arg_max(metric_value, (ts, id)) AS value FROM metrics WHERE ts > (SELECT max(ts) FROM metrics) - INTERVAL 10 MINUTES GROUP BY 1) ON metric_name = metric""",
    "metrics",
    "rules",
)
def alert_rules_fresh(spark, d):
    rows = metrics(spark, d)
    return A.alert_rules_fresh(rows, J.rule_table(spark, RULES), asof=asof(rows))


@query(
    """SELECT rule, severity, for_seconds, started, ended, n_values, lasted_seconds, CASE WHEN lasted_seconds >= for_seconds THEN 'firing' ELSE 'pending' END AS state FROM (
      SELECT rule, severity, for_seconds, min(ts) AS started, max(ts) AS ended, count(*) AS n_values, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS lasted_seconds FROM (
        SELECT *, sum(CAST(changed AS INTEGER)) OVER (PARTITION BY rule ORDER BY ts, id) AS island FROM (
          SELECT *, breach IS DISTINCT FROM lag(breach) OVER (PARTITION BY rule ORDER BY ts, id) AS changed FROM judged))
      WHERE breach GROUP BY rule, severity, for_seconds, island)""",
    "judged",
)
def alert_state(spark, d):
    return A.alert_state(metrics(spark, d), J.rule_table(spark, RULES))


cte(
    "ks",
    """SELECT "column", max(abs(f_ref - f_cur)) AS ks, (SELECT count(*) FROM sides WHERE is_current = 0) AS n_ref, (SELECT count(*) FROM sides WHERE is_current = 1) AS n_cur FROM ecdf GROUP BY 1""",
    "ecdf",
)


def p_sql(d: str, n: str, m: str) -> str:
    x2 = f"({d} * {d} * CAST({n} AS DOUBLE) * {m} / ({n} + {m}))"
    return f"CASE WHEN {x2} < 0.0016 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * k * k * {x2}))))) END"


@query(f"SELECT \"column\", round(ks, 6) AS ks, n_ref, n_cur, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM (SELECT *, {p_sql('ks', 'n_ref', 'n_cur')} AS p_value FROM ks)", "ks")
def numeric_drift_ks(spark, d):
    return r6(D.numeric_drift_ks(*drift_sides(spark, d), cols=["value", "k"]))


cte(
    "wass",
    """SELECT "column", wasserstein, ref_std, wasserstein / greatest(ref_std, 0.001) AS distance FROM (
      SELECT "column", sum(abs(f_ref - f_cur) * (v_next - v)) AS wasserstein FROM ecdf GROUP BY 1) JOIN (
      SELECT "column", stddev_pop(v) FILTER (is_current = 0) AS ref_std FROM long_num GROUP BY 1) USING ("column")""",
    "ecdf",
)


@query('SELECT "column", round(wasserstein, 6) AS wasserstein, round(ref_std, 6) AS ref_std, round(distance, 6) AS distance, distance >= 0.1 AS drifted FROM wass', "wass")
def numeric_drift_wasserstein(spark, d):
    return r6(D.numeric_drift_wasserstein(*drift_sides(spark, d), cols=["value", "k"]))


@query("""SELECT "column", categories, round(js_distance, 6) AS js_distance, round(chi_square, 6) AS chi_square, js_distance >= 0.1 AS drifted FROM cat_stats""", "cat_stats")
def categorical_drift(spark, d):
    return r6(D.categorical_drift(*drift_sides(spark, d), cols=["event_type", "y", "yhat"]))


@query("""SELECT "column", categories, round(js_distance, 6) AS js_distance, round(chi_square, 6) AS chi_square, js_distance >= 0.1 AS drifted FROM cat_stats WHERE "column" IN ('y', 'yhat')""", "cat_stats")
def target_drift(spark, d):
    return r6(D.target_drift(*drift_sides(spark, d), target="y", prediction="yhat"))


def text_drift_ctes(p: str, src: str) -> None:
    """CTEs <p>_rows and <p> over (key, text, is_current) rows."""
    cte(
        f"{p}_rows",
        f"""SELECT *, CAST('0x' || substr(id, 1, 8) AS BIGINT) % 5 = 0 AS held_out, row_number() OVER () AS rid FROM (
          SELECT md5(coalesce(CAST(key AS VARCHAR), text, '')) AS id, md5(coalesce(text, '')) AS t, is_current, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+')) AS ws FROM ({src}))""",
    )
    cte(f"{p}_n", f"SELECT CAST(count(*) FILTER (is_current = 0) AS DOUBLE) AS n0, CAST(count(*) FILTER (is_current = 1) AS DOUBLE) AS n1 FROM {p}_rows WHERE NOT held_out", f"{p}_rows")
    cte(
        f"{p}_weights",
        f"""SELECT term, ln((c + 1.0) / (n1 + 2)) - ln((r + 1.0) / (n0 + 2)) AS w FROM (
          SELECT term, CAST(count(*) FILTER (is_current = 0) AS DOUBLE) AS r, CAST(count(*) FILTER (is_current = 1) AS DOUBLE) AS c FROM (SELECT unnest(ws) AS term, is_current FROM {p}_rows WHERE NOT held_out) GROUP BY term ORDER BY count(*) DESC, term LIMIT 16384), {p}_n""",
        f"{p}_n",
    )
    cte(
        f"{p}_scores",
        f"""SELECT is_current AS y, round(coalesce(w, 0), 9) AS p FROM {p}_rows LEFT JOIN (SELECT rid, sum(w) AS w FROM (SELECT rid, unnest(ws) AS term FROM {p}_rows WHERE held_out) JOIN {p}_weights USING (term) GROUP BY rid) USING (rid) WHERE held_out""",
        f"{p}_weights",
    )
    cte(f"{p}_draws", f"SELECT is_current AS y, draw, md5(CAST(draw AS VARCHAR) || '|' || id || '|' || t || '|' || CAST(is_current AS VARCHAR)) AS p FROM {p}_rows, range(1, 1001) AS d(draw) WHERE held_out AND (SELECT count(*) FROM {p}_rows) < 1000", f"{p}_rows")
    cte(
        p,
        f"""SELECT (SELECT count(*) FROM {p}_rows WHERE NOT held_out) AS n_train, (SELECT count(*) FROM {p}_rows WHERE held_out) AS n_test, (SELECT auc FROM ({_auc_sql('', f'{p}_scores')})) AS auc,
          coalesce((SELECT quantile_cont(auc, 0.95) FROM ({_auc_sql('draw', f'{p}_draws')})), 0.55) AS threshold""",
        f"{p}_scores",
        f"{p}_draws",
    )


text_drift_ctes("td_docs", "SELECT doc_id AS key, text, CAST(lang <> 'en' AS INTEGER) AS is_current FROM documents")
text_drift_ctes("td_same", "SELECT CAST(NULL AS VARCHAR) AS key, text, CAST(substr(source, -1) IN ('1', '3', '5', '7', '9') AS INTEGER) AS is_current FROM documents")
text_drift_ctes("td_props", "SELECT event_id AS key, props AS text, CAST(ts >= TIMESTAMP '2024-01-21' AS INTEGER) AS is_current FROM events")

COLUMNS = """SELECT "column", 'wasserstein' AS test, distance AS score, distance >= 0.1 AS drifted FROM wass UNION ALL SELECT "column", 'jensen_shannon', js_distance, js_distance >= 0.1 FROM cat_stats UNION ALL SELECT 'props', 'text_auc', auc, auc > threshold FROM td_props"""


@query(f'SELECT "column", test, round(score, 6) AS score, drifted FROM ({COLUMNS})', "wass", "cat_stats", "td_props")
def column_drift(spark, d):
    return r6(_columns(spark, d))


def _columns(spark, d):
    return D.column_drift(*drift_sides(spark, d), numeric=["value", "k"], categorical=["event_type", "y", "yhat"], text=["props"], key="event_id")


@query()
def column_drift_small(spark, d):
    """The p-value tests; the chi-square tail has no SQL form."""
    return r6(D.column_drift(*drift_sides(spark, d), numeric=["value", "k"], categorical=["event_type", "y", "yhat"], small=True))


@query(
    f"SELECT count(*) AS n_columns, count(*) FILTER (drifted) AS n_drifted, round(avg(CAST(drifted AS DOUBLE)), 6) AS drift_share, avg(CAST(drifted AS DOUBLE)) >= 0.5 AS data_drift_detected FROM ({COLUMNS})",
    "wass",
    "cat_stats",
    "td_props",
)
def dataset_drift(spark, d):
    return r6(D.dataset_drift(_columns(spark, d)))


@query(
    """SELECT "column", round(ref_mean, 6) AS ref_mean, round(ref_std, 6) AS ref_std, round(cur_mean, 6) AS cur_mean, round(abs(cur_mean - ref_mean) / ref_std, 6) AS shift, abs(cur_mean - ref_mean) / ref_std > 2 AS shifted FROM (
      SELECT "column", avg(v) FILTER (is_current = 0) AS ref_mean, stddev_samp(v) FILTER (is_current = 0) AS ref_std, avg(v) FILTER (is_current = 1) AS cur_mean FROM long_num GROUP BY 1)""",
    "long_num",
)
def mean_shift_sigma(spark, d):
    return r6(D.mean_shift_sigma(*drift_sides(spark, d), cols=["value", "k"]))


Q_COLS = ["n_turns", "Label", "Top1", "Top4", "Top7", "one"]


def _facts(side, where):
    src = f"(SELECT *, 1 AS one FROM wide WHERE {where})"
    any_null = " OR ".join(f"{c} IS NULL" for c in Q_COLS)
    pick = {
        "columns_with_nulls": " + ".join(f"(count(*) FILTER ({c} IS NULL) > 0)::BIGINT" for c in Q_COLS),
        "rows_with_nulls": f"count(*) FILTER ({any_null})",
        "constant_columns": " + ".join(f"(count(DISTINCT {c}) = 1)::BIGINT" for c in Q_COLS),
        "duplicated_rows": f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(Q_COLS)} FROM {src}))",
        "column_types": "any_value(0)",
    }
    return " UNION ALL ".join(f"SELECT '{t}' AS test, '{side}' AS side, CAST({e} AS BIGINT) AS v FROM {src}" for t, e in pick.items())


@query(
    f"""SELECT test, value, reference_value, value <= reference_value AS passed FROM (
      SELECT test, max(v) FILTER (side = 'value') AS value, max(v) FILTER (side = 'reference_value') AS reference_value FROM (
        {_facts('value', 'n_turns < 5')} UNION ALL {_facts('reference_value', 'n_turns >= 5')}) GROUP BY test)""",
    "wide",
)
def quality_tests(spark, d):
    frame = wide(spark, d).withColumn("one", F.lit(1)).select(*Q_COLS)
    return D.quality_tests(frame.where(F.col("n_turns") >= 5), frame.where(F.col("n_turns") < 5))


@query(
    """SELECT c AS "column", round(CASE c WHEN 'open' THEN corr(open, close) WHEN 'low' THEN corr(low, close) ELSE corr(volume, close) END, 6) AS target_correlation,
      round(CASE c WHEN 'open' THEN corr(open, high) WHEN 'low' THEN corr(low, high) ELSE corr(volume, high) END, 6) AS prediction_correlation
    FROM bars, (VALUES ('open'), ('low'), ('volume')) AS t(c) GROUP BY c""",
    "bars",
)
def correlation_tests(spark, d):
    return r6(D.correlation_tests(bars(spark, d), cols=["open", "low", "volume"], target="close", prediction="high"))


@query(
    f"""SELECT test, round(value, 6) AS value, "limit", value >= "limit" AS passed, CAST(NULL AS VARCHAR) AS reason FROM (
      SELECT 'accuracy' AS test, {ACC} AS value, CAST(0.5 AS DOUBLE) AS "limit" FROM preds UNION ALL SELECT 'f1', {F1}, CAST(0.5 AS DOUBLE) FROM preds)""",
    "preds",
)
def performance_tests(spark, d):
    return r6(A.performance_tests(M.classification_scores(preds(spark, d)), limits={"accuracy": 0.5, "f1": 0.5}))


CURRENT = "(SELECT * FROM preds WHERE date >= DATE '2024-01-21')"
METRIC_SQL = f"""SELECT 'reference_samples' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM sides WHERE is_current = 0 UNION ALL
  SELECT 'current_samples', count(*) FROM sides WHERE is_current = 1 UNION ALL
  SELECT 'data_drift_detected', CAST(avg(CAST(drifted AS DOUBLE)) >= 0.5 AS DOUBLE) FROM ({COLUMNS}) UNION ALL
  SELECT 'drift_share', avg(CAST(drifted AS DOUBLE)) FROM ({COLUMNS}) UNION ALL
  SELECT 'accuracy', {ACC} FROM {CURRENT} UNION ALL SELECT 'f1', {F1} FROM {CURRENT} UNION ALL SELECT 'auc', coalesce(auc, 0.5) FROM ({_auc_sql('', CURRENT)}) UNION ALL
  SELECT 'p_quantile_0.05', quantile_cont(p, 0.05) FROM {CURRENT} UNION ALL SELECT 'p_quantile_0.95', quantile_cont(p, 0.95) FROM {CURRENT}"""


@query(f"SELECT metric_name, round(metric_value, 6) AS metric_value FROM ({METRIC_SQL})", "preds", "wass", "cat_stats", "td_props")
def monitoring_metrics(spark, d):
    return r6(_run_metrics(spark, d))


def _run_metrics(spark, d):
    reference, current = drift_sides(spark, d)
    recent = preds(spark, d).where(F.col("date") >= F.lit("2024-01-21").cast("date"))
    return A.monitoring_metrics(reference, current, recent, _columns(spark, d), y="y", yhat="yhat", score="p")


cte(
    "flow_rules",
    "SELECT * FROM (VALUES " + ", ".join(f"('{r}', '{m}', '{o}', CAST({t} AS DOUBLE), '{v}')" for r, m, o, t, _, v in A.FLOW_RULES) + ") AS t(rule, metric, op, threshold, severity)",
)
cte("run_metrics", METRIC_SQL, "preds", "wass", "cat_stats", "td_props")
FLOW_MSG = f"CASE WHEN metric = 'data_drift_detected' THEN 'Dataset drift detected!' WHEN metric = 'drift_share' THEN format('High drift share: {{:.2f}}% > {{:.2f}}%', value * 100, threshold * 100) ELSE {MSG} END"
cte(
    "run_alerts",
    f"SELECT rule, {FLOW_MSG} AS message FROM (SELECT r.*, metric_value AS value FROM run_metrics JOIN flow_rules r ON metric = metric_name) WHERE {RULE_TEST}",
    "run_metrics",
    "flow_rules",
)
KEY_METRICS = ["data_drift_detected", "drift_share", "accuracy", "f1"]


@query(
    f"""SELECT (SELECT max(ts) FROM events) AS timestamp, 'success' AS status, (SELECT count(*) FROM run_metrics WHERE metric_value IS NOT NULL) AS metrics_count, CAST((SELECT count(*) FROM run_alerts) AS INTEGER) AS alerts_count,
      {', '.join(f"CAST((SELECT metric_value FROM run_metrics WHERE metric_name = '{m}') AS BIGINT) AS {m}" for m in ('reference_samples', 'current_samples'))}, (SELECT count(DISTINCT date) FROM {CURRENT}) AS prediction_days,
      {', '.join(f"round((SELECT metric_value FROM run_metrics WHERE metric_name = '{m}'), 6) AS {m}" for m in KEY_METRICS)},
      (SELECT coalesce(string_agg(rule || ': ' || message, '; ' ORDER BY rule), '') FROM run_alerts) AS alerts""",
    "run_alerts",
)
def run_summary(spark, d):
    from voltide.operators.ordering import checkpointed

    found = checkpointed(_run_metrics(spark, d))
    raised = A.check_alerts(found, J.rule_table(spark, A.FLOW_RULES))
    days = preds(spark, d).where(F.col("date") >= F.lit("2024-01-21").cast("date")).agg(F.countDistinct("date")).scalar()
    summary = A.run_summary(found, raised, asof=asof(table(spark, d, "events")), prediction_days=days)
    texts = F.array_join(F.transform("alerts", lambda a: F.concat(a["rule"], F.lit(": "), a["message"])), "; ")
    return r6(summary.select(*[c for c in summary.columns if c not in ("key_metrics", "alerts")], *[F.col(f"key_metrics.{m}").alias(m) for m in KEY_METRICS], texts.alias("alerts")))


cte("cur", "SELECT value, (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS period FROM sides WHERE is_current = 1", "sides")
cte(
    "grid",
    """SELECT period, x, (SELECT count(*) FROM sides s WHERE s.is_current = 0 AND s.value <= x) / CAST((SELECT count(*) FROM sides WHERE is_current = 0) AS DOUBLE) AS f_ref,
      (SELECT count(*) FROM cur c WHERE c.period = g.period AND c.value <= x) / CAST((SELECT count(*) FROM cur c WHERE c.period = g.period) AS DOUBLE) AS f_cur
    FROM (SELECT DISTINCT p.period, s.value AS x FROM sides s, (SELECT DISTINCT period FROM cur) p) g""",
    "cur",
)
cte(
    "period_ks",
    """SELECT g.period, n_rows, mean, min, max, ks, (SELECT count(*) FROM sides WHERE is_current = 0) AS n_ref FROM (SELECT period, max(abs(f_ref - f_cur)) AS ks FROM grid GROUP BY 1) g JOIN (
      SELECT period, count(*) AS n_rows, avg(value) AS mean, min(value) AS min, max(value) AS max FROM cur GROUP BY 1) USING (period)""",
    "grid",
)


@query(
    f"SELECT period, n_rows, round(mean, 6) AS mean, round(min, 6) AS min, round(max, 6) AS max, round(ks, 6) AS ks, round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM (SELECT *, {p_sql('ks', 'n_ref', 'n_rows')} AS p_value FROM period_ks)",
    "period_ks",
)
def period_drift(spark, d):
    reference, current = drift_sides(spark, d)
    return r6(D.period_drift(reference, current, col="value", order=["ts", "event_id"]))


R_NUM = {
    "value": "value",
    "k": "k",
    "props_length": "CAST(length(props) AS DOUBLE)",
    "props_words": "CAST(len(regexp_extract_all(lower(props), '[\\p{L}\\p{N}_]+')) AS DOUBLE)",
    "props_non_letter_share": "CASE WHEN length(props) > 0 THEN (length(props) - length(regexp_replace(props, '[^\\p{L}]', '', 'g'))) / length(props) WHEN length(props) = 0 THEN 0 END",
    "y": "CAST(y AS DOUBLE)",
    "yhat": "CAST(yhat AS DOUBLE)",
    "p": "p",
}
R_COLS = ["value", "k", "event_type", "props", "y", "yhat", "p"]
cte(
    "pr",
    """SELECT CASE WHEN is_current = 0 THEN -1 ELSE (row_number() OVER (PARTITION BY is_current ORDER BY ts, event_id) - 1) // 500 END AS period, value, k, event_type, y, yhat, value / (value + 50) AS p, props
    FROM sides JOIN (SELECT event_id, props FROM events) USING (event_id)""",
    "sides",
)
cte("pr_num", " UNION ALL ".join(f"SELECT period, '{c}' AS col, {e} AS v FROM pr" for c, e in R_NUM.items()), "pr")
cte(
    "pr_ecdf",
    """SELECT *, CAST(sum(r) OVER w AS DOUBLE) / sum(r) OVER (PARTITION BY col, period) AS fr, CAST(sum(c) OVER w AS DOUBLE) / sum(c) OVER (PARTITION BY col, period) AS fc, lead(v) OVER w AS nv FROM (
      SELECT col, period, v, sum(r) AS r, sum(c) AS c FROM (
        SELECT n.col, q.period, n.v, 1 AS r, 0 AS c FROM pr_num n JOIN (SELECT DISTINCT col, period FROM pr_num WHERE period >= 0 AND v IS NOT NULL) q USING (col) WHERE n.period = -1 AND v IS NOT NULL
        UNION ALL SELECT col, period, v, 0, 1 FROM pr_num WHERE period >= 0 AND v IS NOT NULL) GROUP BY col, period, v)
    WINDOW w AS (PARTITION BY col, period ORDER BY v)""",
    "pr_num",
)
cte(
    "pr_moved",
    f"""SELECT *, wasserstein / greatest(ref_std, 0.001) AS distance, {p_sql('ks', 'n_ref', 'n')} AS p_value FROM (
      SELECT col, period, max(abs(fr - fc)) AS ks, coalesce(sum(abs(fr - fc) * (nv - v)), 0) AS wasserstein, CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(c) AS BIGINT) AS n FROM pr_ecdf GROUP BY 1, 2)
      JOIN (SELECT col, stddev_pop(v) AS ref_std FROM pr_num WHERE period = -1 GROUP BY 1) USING (col)""",
    "pr_ecdf",
)
cte(
    "pr_kinds",
    """SELECT col, period, count(*) AS categories, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js_distance,
      sum(CASE WHEN p > 0 THEN (c - p * m) ** 2 / (p * m) END) AS chi_square FROM (
      SELECT col, period, v, r / sum(r) OVER (PARTITION BY col, period) AS p, c / sum(c) OVER (PARTITION BY col, period) AS q, c, sum(c) OVER (PARTITION BY col, period) AS m FROM (
        SELECT col, period, v, CAST(sum(r) AS DOUBLE) AS r, CAST(sum(c) AS DOUBLE) AS c FROM (
          SELECT n.col, q.period, n.v, 1 AS r, 0 AS c FROM pr_cat n JOIN (SELECT DISTINCT col, period FROM pr_cat WHERE period >= 0) q USING (col) WHERE n.period = -1
          UNION ALL SELECT col, period, v, 0, 1 FROM pr_cat WHERE period >= 0) GROUP BY 1, 2, 3)) GROUP BY 1, 2""",
    "pr_cat",
)
cte("pr_cat", "SELECT period, 'event_type' AS col, event_type AS v FROM pr UNION ALL SELECT period, 'y', CAST(y AS VARCHAR) FROM pr UNION ALL SELECT period, 'yhat', CAST(yhat AS VARCHAR) FROM pr", "pr")
cte("pr_flags", "SELECT period, CAST(distance >= 0.1 AS DOUBLE) AS f FROM pr_moved WHERE col IN ('value', 'k') UNION ALL SELECT period, CAST(js_distance >= 0.1 AS DOUBLE) FROM pr_kinds", "pr_moved", "pr_kinds")
_TP, _FP, _FN, _TN = (f"CAST(count(*) FILTER (y = {a} AND yhat = {b}) AS DOUBLE)" for a, b in ((1, 1), (0, 1), (1, 0), (0, 0)))
_R_COLUMN = {
    "count": "count(v)", "mean": "avg(v)", "std": "stddev_samp(v)", "min": "min(v)", "p25": "quantile_cont(v, 0.25)", "p50": "quantile_cont(v, 0.5)", "p75": "quantile_cont(v, 0.75)", "max": "max(v)",
    "distinct": "count(DISTINCT v)", "missing": "count(*) - count(v)",
}
_R_PARTS = [
    *[f"SELECT period, 'summary', NULL, '{m}', {e} FROM pr GROUP BY period" for m, e in {
        "n_rows": "count(*)", "n_columns": str(len(R_COLS)), "n_missing_cells": " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in R_COLS),
        "n_constant_columns": " + ".join(f"CAST(count(DISTINCT {c}) = 1 AS INTEGER)" for c in R_COLS), "n_empty_columns": " + ".join(f"CAST(count({c}) = 0 AS INTEGER)" for c in R_COLS)}.items()],
    f"SELECT period, 'summary', NULL, 'n_duplicated_rows', sum(n - 1) FROM (SELECT period, count(*) AS n FROM pr GROUP BY period, {', '.join(R_COLS)}) GROUP BY period",
    *[f"SELECT period, 'columns', col, '{m}', {e} FROM pr_num WHERE period >= 0 GROUP BY period, col" for m, e in _R_COLUMN.items()],
    "SELECT period, 'columns', col, 'most_common', v FROM (SELECT period, col, v, row_number() OVER (PARTITION BY period, col ORDER BY count(*) DESC, v) AS i FROM pr_num WHERE period >= 0 AND v IS NOT NULL GROUP BY 1, 2, 3) WHERE i = 1",
    *[f"SELECT period, 'quantiles', col, 'quantile_{q:.2f}', quantile_cont(v, {q}) FROM pr_num WHERE period >= 0 GROUP BY period, col" for q in (0.05, 0.95)],
    *[f"SELECT period, 'drift', col, '{m}', {e} FROM pr_moved WHERE col NOT IN ('y', 'yhat', 'p')" for m, e in {"ks": "ks", "p_value": "p_value", "wasserstein": "wasserstein", "distance": "distance", "drifted": "CAST(distance >= 0.1 AS DOUBLE)"}.items()],
    *[f"SELECT period, 'drift', col, '{m}', {e} FROM pr_kinds" for m, e in {"categories": "categories", "js_distance": "js_distance", "chi_square": "chi_square", "drifted": "CAST(js_distance >= 0.1 AS DOUBLE)"}.items()],
    *[f"SELECT period, 'drift', NULL, '{m}', {e} FROM pr_flags GROUP BY period" for m, e in {"n_drifted": "sum(f)", "drift_share": "avg(f)", "data_drift_detected": "CAST(avg(f) >= 0.5 AS DOUBLE)"}.items()],
    *[f"SELECT period, 'quality', NULL, '{m}', {e} FROM pr GROUP BY period" for m, e in {
        "accuracy": "avg(CAST(y = yhat AS DOUBLE))", "precision": f"coalesce({_TP} / nullif({_TP} + {_FP}, 0), 0)", "recall": f"coalesce({_TP} / nullif({_TP} + {_FN}, 0), 0)", "f1": f"coalesce(2 * {_TP} / nullif(2 * {_TP} + {_FP} + {_FN}, 0), 0)",
        "log_loss": "avg(CASE WHEN y = 1 THEN -ln(least(greatest(p, 1e-15), 1 - 1e-15)) ELSE -ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)) END)", "n": "count(*)"}.items()],
    f"SELECT period, 'quality', NULL, 'auc', auc FROM ({_auc_sql('period', 'pr')})",
    *[f"SELECT period, 'confusion', NULL, '{m}', {e} FROM pr GROUP BY period" for m, e in {"tp": _TP, "fp": _FP, "fn": _FN, "tn": _TN}.items()],
    *[f"SELECT period, 'balance', '{c}', 'share_' || {c}, count(*) / sum(count(*)) OVER (PARTITION BY period) FROM pr GROUP BY period, {c}" for c in ("y", "yhat")],
]
REPORT_SQL = 'SELECT period, section, "column", metric, round(value, 6) AS value FROM (SELECT CAST(period AS BIGINT) AS period, section, CAST("column" AS VARCHAR) AS "column", metric, CAST(value AS DOUBLE) AS value FROM (' + " UNION ALL ".join(_R_PARTS) + ') AS t(period, section, "column", metric, value)) WHERE value IS NOT NULL'


@query(REPORT_SQL, "pr_num", "pr_moved", "pr_kinds", "pr_flags")
def period_reports(spark, d):
    """The whole report of each period of 500 rows."""
    rows = table(spark, d, "events").select("event_id", "ts", "event_type", "value", "props", F.get_json_object("props", "$.k").cast("double").alias("k"))
    rows = rows.withColumns({"y": F.col("event_type").isin("error", "purchase").cast("int"), "yhat": (F.col("value") > 50).cast("int"), "p": F.col("value") / (F.col("value") + 50)})
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    return r6(
        R.period_reports(
            rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut), order=["ts", "event_id"], numeric=["value", "k"], categorical=["event_type"], text=["props"], target="y", prediction="yhat", score="p"
        ),
        "value",
    )


def _text_sides(spark, d):
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    return docs.where("lang = 'en'"), docs.where("lang <> 'en'")


@query("SELECT is_current, held_out, count(*) AS n FROM td_docs_rows GROUP BY ALL", "td_docs_rows")
def text_drift_split(spark, d):
    """How the rows of both sides are dealt to training and test."""
    reference, current = _text_sides(spark, d)
    rows = TD.text_drift_rows(reference, current, text="text", key="doc_id")
    return rows.groupBy("is_current", "held_out").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'text' AS "column", n_train, n_test, round(auc, 6) AS auc, round(threshold, 6) AS threshold, auc > threshold AS drifted FROM td_docs""", "td_docs")
def text_drift(spark, d):
    """English against other languages: the words must tell them apart."""
    reference, current = _text_sides(spark, d)
    return r6(TD.text_drift(reference, current, text="text", key="doc_id"))


@query("""SELECT 'text' AS "column", n_train, n_test, round(auc, 6) AS auc, round(threshold, 6) AS threshold, auc > threshold AS drifted FROM td_same""", "td_same")
def text_drift_none(spark, d):
    """Documents of even against documents of odd sources: nothing to tell apart."""
    docs = table(spark, d, "documents", "text", "source")
    odd = F.substring("source", -1, 1).isin(*"13579")
    return r6(TD.text_drift(docs.where(~odd), docs.where(odd), text="text"))
