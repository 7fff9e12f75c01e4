"""Drift against brute force, alert rules and runs, and the monitoring job."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from support import rows
from pyspark.sql import functions as F

from voltide.operators import alerts as A
from voltide.operators import drift as D
from voltide.operators.joins import rule_table
from voltide.plans.monitor import monitoring_job


def sample(n, shift, seed):
    rng = np.random.default_rng(seed)
    return [round(float(x), 2) for x in rng.normal(shift, 1, n)]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")


def gap(a, b):
    grid = np.array(sorted(set(a) | set(b)))
    fa, fb = (np.searchsorted(np.sort(v), grid, side="right") / len(v) for v in (a, b))
    return grid, fa, fb


def test_ks_and_wasserstein(spark, many_chunks):
    a, b = sample(300, 0, 1), sample(170, 0.4, 2)
    grid, fa, fb = gap(a, b)
    ks = D.numeric_drift_ks(frame(spark, a), frame(spark, b), cols=["x"]).first()
    assert ks.ks == pytest.approx(np.max(np.abs(fa - fb))) and (ks.n_ref, ks.n_cur) == (300, 170)
    lam = ks.ks * np.sqrt(300 * 170 / 470)
    assert ks.p_value == pytest.approx(2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 101)))
    w = D.numeric_drift_wasserstein(frame(spark, a), frame(spark, b), cols=["x"]).first()
    assert w.wasserstein == pytest.approx(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))
    assert w.distance == pytest.approx(w.wasserstein / np.std(a)) and w.drifted


def test_same_data_do_not_drift(spark):
    a = frame(spark, sample(200, 0, 3))
    ks = D.numeric_drift_ks(a, a, cols=["x"]).first()
    assert ks.ks == 0 and ks.p_value == 1.0 and not ks.drifted
    same = D.categorical_drift(a.withColumn("c", F.lit("u")), a.withColumn("c", F.lit("u")), cols=["c"]).first()
    assert same.js_distance == 0 and not same.drifted


def test_chi_square_tail():
    # reference points of the chi-square table
    assert D._chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert D._chi2_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert D._chi2_tail(18.307038053275146, 10) == pytest.approx(0.05)
    # an even number of degrees has a closed form
    closed = np.exp(-0.25) * sum(0.25**i / math.factorial(i) for i in range(5))
    assert D._chi2_tail(0.5, 10) == pytest.approx(closed) and D._chi2_tail(0.0, 3) == 1.0


def test_category_missing_on_one_side(spark):
    ref = spark.createDataFrame([("a",)] * 8 + [("b",)] * 2, "c string")
    cur = spark.createDataFrame([("a",)] * 5 + [("z",)] * 5, "c string")
    got = D.categorical_drift(ref, cur, cols=["c"]).first()
    p, q = np.array([0.8, 0.2, 0]), np.array([0.5, 0, 0.5])
    m = (p + q) / 2
    kl = lambda x: sum(v * np.log(v / w) for v, w in zip(x, m) if v > 0)
    assert got.js_distance == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2)) and got.categories == 3


def test_period_drift_against_pairs(spark, many_chunks):
    a, b = sample(200, 0, 5), sample(90, 0.2, 6)
    cur = spark.createDataFrame([(i, v) for i, v in enumerate(b)], "id int, x double").repartition(5)
    got = {r.period: r for r in D.period_drift(frame(spark, a), cur, col="x", order=["id"], size=40).collect()}
    assert [got[p].n_rows for p in sorted(got)] == [40, 40, 10]
    for p, r in got.items():
        part = b[p * 40 : (p + 1) * 40]
        _, fa, fb = gap(a, part)
        assert r.ks == pytest.approx(np.max(np.abs(fa - fb))) and r.mean == pytest.approx(np.mean(part))


def test_quality(spark):
    ref = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    cur = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (1.0, None)], "n double, s string")
    got = {r.test: (r.value, r.passed) for r in D.quality_tests(ref, cur).collect()}
    assert got == {"columns_with_nulls": (1, False), "rows_with_nulls": (1, False), "constant_columns": (2, False), "duplicated_rows": (1, False), "column_types": (1, False)}


T0 = datetime(2024, 1, 1)


def metric_rows(spark, values, name="auc", step=60):
    data = [(i, T0 + timedelta(seconds=step * i), name, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "id int, ts timestamp_ntz, metric_name string, metric_value double")


def test_runs_of_breaches(spark, many_chunks):
    df = metric_rows(spark, [0.6, 0.5, 0.5, 0.5, 0.6, 0.4, 0.6]).repartition(4)
    runs = A.alert_state(df, rule_table(spark, [A.MODEL_RULES[0]])).orderBy("started").collect()
    assert [(r.n_values, r.lasted_seconds, r.state) for r in runs] == [(3, 120, "firing"), (1, 0, "pending")]


def test_latest_and_fresh(spark):
    df = metric_rows(spark, [0.6, 0.5]).unionByName(metric_rows(spark, [0.7], "f1", 0))
    rules = rule_table(spark, A.MODEL_RULES)
    states = {r.rule: r.state for r in A.alert_rules_latest(df, rules).collect()}
    assert states == {"ModelAUCDrop": "Alerting", "ModelF1Drop": "OK", "ModelAccuracyDrop": "NoData", "DataDriftDetected": "NoData"}
    late = F.lit("2024-01-01 00:05:30").cast("timestamp_ntz")
    fresh = {r.rule: r.state for r in A.alert_rules_fresh(df, rules, asof=late, window="5 MINUTES").collect()}
    assert fresh["ModelAUCDrop"] == "Alerting" and fresh["ModelF1Drop"] == "NoData"


def test_messages(spark):
    df = spark.createDataFrame([("drift_share", 0.5), ("auc", 0.5), ("f1", 0.9), ("data_drift_detected", 1.0)], "metric_name string, metric_value double")
    got = {r.metric: r.message for r in A.check_alerts(df, rule_table(spark, A.FLOW_RULES)).collect()}
    assert got == {"drift_share": "High drift share: 50.00% > 40.00%", "auc": "Low auc: 0.500 < 0.520", "data_drift_detected": "Dataset drift detected!"}


def test_tie_on_time_takes_largest_key(spark):
    df = metric_rows(spark, [1.0, 2.0, 3.0], step=0)
    assert A.latest_per_metric(df).first().metric_value == 3.0


def test_performance_needs_rows(spark):
    scores = spark.createDataFrame([(0.6, 0.4, 10)], "accuracy double, f1 double, n int")
    assert rows(A.performance_tests(scores, limits={"accuracy": 0.5, "f1": 0.5}).select("test", "passed", "reason")) == [("accuracy", None, "10 rows or fewer"), ("f1", None, "10 rows or fewer")]
    many = scores.withColumn("n", F.lit(11))
    assert rows(A.performance_tests(many, limits={"accuracy": 0.5, "f1": 0.5}).select("test", "passed")) == [("accuracy", True), ("f1", False)]


def test_monitoring_job(spark, tmp_path):
    def side(n, shift, start):
        return spark.createDataFrame(
            [(start + timedelta(days=i // 10), i, v, "ab"[i % 2], i % 2, int(v > 0), 1 / (1 + float(np.exp(-v)))) for i, v in enumerate(sample(n, shift, n))],
            "date date, id int, x double, c string, y int, yhat int, p double",
        )

    ref, cur = side(300, 0, date(2024, 1, 1)), side(200, 2, date(2024, 3, 1))
    path = str(tmp_path / "metrics")
    how = dict(numeric=["x"], categorical=["c"], y="y", yhat="yhat", score="p", asof=F.lit("2024-04-01 00:00:00").cast("timestamp_ntz"), metrics_path=path)
    summary = monitoring_job(ref, cur, cur, **how).first()
    assert summary.status == "success" and summary.current_samples == 70 and summary.reference_samples == 300
    assert summary.key_metrics.drift_share == 0.5 and summary.key_metrics.data_drift_detected == 1.0
    assert {a.metric for a in summary.alerts} >= {"data_drift_detected", "drift_share"} and summary.alerts_count == len(summary.alerts)
    saved = spark.read.parquet(path)
    assert saved.count() == summary.metrics_count
    monitoring_job(ref, cur, cur, **how).first()
    assert spark.read.parquet(path).count() == 2 * summary.metrics_count
