"""Votes and metrics by hand, with ties and undefined cases."""

import math
from datetime import date

import pytest
from support import plan_of, rows
from pyspark.sql import functions as F

from voltide.functions import scalars as S
from voltide.operators import metrics as M
from voltide.operators import models as ML
from voltide.operators import votes as V


def day(spark, ps, preds=None, d=date(2024, 1, 1), y=1):
    preds = preds or [int(p > 0.5) for p in ps]
    return spark.createDataFrame([(d, i, p, c, y) for i, (p, c) in enumerate(zip(ps, preds))], "date date, id int, p double, yhat int, y int")


def test_vote_ties(spark):
    df = day(spark, [0.5, 0.9, 0.1, 0.5])
    batch = V.daily_vote(df, label="y", order="id").first()
    assert (batch.prediction_mean_proba, batch.prediction_mean_class) == (0.5, 0)
    assert batch.prediction_majority_vote == 0 and batch.num_headlines == 4 and batch.true_label == 1
    online = V.api_vote(df, group="date").first()
    assert (online.mean_prediction, online.majority_vote, online.max_prob_class, online.max_prob_value) == (1, 1, 1, 0.9)
    even = day(spark, [0.9, 0.1])
    assert V.daily_vote(even).first().prediction_majority_vote == 1
    assert V.daily_vote(even, tie_up=False).first().prediction_majority_vote == 0
    assert V.api_vote(even, group="date").first().majority_vote == 0


def test_first_label_is_by_key(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 2, 0.1, 0), (date(2024, 1, 1), 1, 0.2, 1)], "date date, id int, p double, y int").repartition(4)
    assert V.daily_vote(df, label="y", order="id").first().true_label == 1


def test_empty_days(spark):
    df = day(spark, [0.9]).unionByName(day(spark, [0.2], d=date(2024, 1, 3)))
    got = V.daily_vote_empty(V.day_calendar(df, date="date"), V.daily_vote(df)).orderBy("date").collect()
    assert [r.num_headlines for r in got] == [1, 0, 1]
    assert (got[1].prediction_mean_proba, got[1].prediction_max_class, got[1].error) == (0.5, 0, "No headlines provided")


def test_one_array_for_each_request(spark):
    df = spark.range(25).select(F.lit("r").alias("g"), F.col("id").alias("pos"), (F.col("id") / 25).alias("p"))
    (got,) = V.individual_arrays(df, group="g", pos="pos").collect()
    assert len(got.individual_predictions) == 25 and got.individual_probabilities[10] == 0.4
    flat = sorted(tuple(r) for r in V.individual_rows(df, group="g", pos="pos").collect())
    assert [r[2] for r in flat] == list(got.individual_predictions) and [r[3] for r in flat] == list(got.individual_probabilities)


def brute_auc(pairs):
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark, many_chunks):
    pairs = [((i * 37 % 23) / 23, int(i * 11 % 5 > 2)) for i in range(200)]
    df = spark.createDataFrame([(p, y, "a" if i % 3 else "b") for i, (p, y) in enumerate(pairs)], "p double, y int, g string")
    assert M.roc_auc(df).first().auc == pytest.approx(brute_auc(pairs))
    by = {r.g: r.auc for r in M.roc_auc(df, by=["g"]).collect()}
    assert by["b"] == pytest.approx(brute_auc(pairs[::3]))


def test_auc_and_f1_undefined(spark):
    one = spark.createDataFrame([(0.2, 1, 0), (0.7, 1, 0)], "p double, y int, yhat int")
    assert M.roc_auc(one).first().auc is None
    assert M.roc_auc(one, single_class=0.5).first().auc == 0.5
    nothing = one.withColumn("y", F.lit(0))
    assert M.f1_score(nothing).first().f1 == 0.0
    assert M.roc_auc(one.where("p > 1")).first().auc is None


def test_hot_score_costs_one_row(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 10000).alias("p"), (F.col("id") % 2).alias("y"))
    plan = plan_of(M.roc_auc(df))
    assert plan.index("HashAggregate") < plan.rindex("HashAggregate") and "Python" not in plan
    assert "rangepartitioning" in plan


def test_report_and_confusion(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(0, 1)] * 2 + [(0, 0)] * 5, "y int, yhat int")
    report = {r.label: r for r in M.classification_report(df).collect()}
    assert report["1"].precision == pytest.approx(0.6) and report["1"].recall == 1.0
    assert report["accuracy"].f1 == pytest.approx(0.8) and report["macro avg"].support == 10
    assert {(r.y, r.yhat): r.n for r in M.confusion_matrix(df).collect()} == {(0, 0): 5, (0, 1): 2, (1, 0): 0, (1, 1): 3}


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 1, 0.8), (0, 0, 0.0)], "y int, yhat int, p double")
    assert M.classification_scores(df).first().log_loss == pytest.approx(-math.log(0.8) / 2)


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_quantiles_interpolate(spark, many_chunks, n):
    import numpy as np

    values = [float(i * 7 % 11) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.q: r.quantile for r in M.column_quantile(df, cols=["x"], qs=(0.0, 0.05, 0.5, 0.95, 1.0)).collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(values, q))
    assert len(got) == 5


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    assert {r.bin: r.n for r in M.histogram(df, col="x", bins=5).collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    same = df.select(F.lit(3.0).alias("x"))
    assert rows(M.histogram(same, col="x", bins=5)) == [(0, 11)]


def test_summaries(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, None), (None, None)], "a double, b double")
    s = M.dataset_summary(df).first()
    assert (s.n_rows, s.n_missing_cells, s.n_constant_columns, s.n_empty_columns, s.n_duplicated_rows) == (4, 5, 0, 1, 1)
    c = {r.column: r for r in M.column_summary(df, cols=["a", "b"]).collect()}
    assert (c["a"].n, c["a"].n_missing, c["a"].n_distinct, c["a"].most_common, c["a"].p50) == (3, 1, 2, 1.0, 1.0)
    assert c["b"].n == 0 and c["b"].most_common is None
    assert M.dataset_summary(df.where("a > 9")).first().n_rows == 0


def test_bands_and_classes(spark):
    df = spark.createDataFrame([(0.3,), (0.4,), (0.5,), (0.6,), (0.7,), (None,)], "p double")
    got = df.select(S.confidence_band("p"), S.confidence_band("p", inclusive=False), S.class_threshold("p"), S.class_threshold("p", inclusive=True)).collect()
    assert [r[0] for r in got] == ["High", "Medium", "Low", "Medium", "High", None]
    assert [r[1] for r in got] == ["Medium", "Low", "Low", "Low", "Medium", None]
    assert [r[2] for r in got] == [0, 0, 0, 1, 1, None] and got[2][3] == 1


def test_keyword_score(spark):
    df = spark.createDataFrame([("Stocks RALLY as fears fade",), ("Rates unchanged, markets stable and steady",), ("plain",), ("rally surge soar boom crash",), (None,)], "t string")
    got = [r[0] for r in df.select(F.round(S.keyword_score("t"), 6)).collect()]
    assert got == [0.8, 0.2, 0.5, 1.0, None]
    assert [r[0] for r in df.select(F.round(S.keyword_score_simple("t"), 6)).collect()] == [0.65, 0.5, 0.5, 0.9, None]


def test_error_rows(spark):
    got = ML.with_response(spark.createDataFrame([(0.9,), (None,)], "p double")).collect()
    assert (got[0].prediction_class, got[0].error) == (1, None) and 0 <= got[0].confidence <= 1
    assert (got[1].prediction_class, got[1].prediction_proba, got[1].confidence, got[1].interpretation) == (0, 0.5, 0.0, "Error in prediction")


def test_unknown_scores_labels_and_groups(spark):
    """An unknown score or label stays out of log-loss and AUC; the unknown group keeps its AUC."""
    data = [(None, 1, 1, 0.9), (None, 0, 0, 0.1), (None, None, 1, 0.8), (None, 1, 1, None), ("a", 1, 1, 0.5)]
    got = M.classification_scores(spark.createDataFrame(data, "g string, y int, yhat int, p double"), by=["g"]).orderBy("g").collect()
    assert round(got[0].log_loss, 3) == 0.105 and got[0].auc == 1.0 and got[0].n == 4
    assert got[1].auc is None


def test_an_unnamed_label_order_is_refused(spark):
    with pytest.raises(ValueError):
        V.daily_vote(spark.createDataFrame([], "date date, p double, y int"), label="y")


@pytest.mark.parametrize("sketch", [1, 5, 40, 10_000])
def test_quantiles_by_selection_are_exact(spark, monkeypatch, sketch):
    """Small sketches, so that brackets are real on small data; ties, one value, a null group, a skewed group."""
    import numpy as np

    from voltide.operators import metrics as M

    monkeypatch.setattr(M, "SKETCH", sketch)
    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(0, 1, 3000), "ties": rng.integers(0, 5, 700).astype(float), None: rng.exponential(1, 90), "one": np.array([2.5]), "same": np.full(200, 7.0), "two": np.array([1.0, 2.0])}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(data, "g string, x double").repartition(6)
    qs = (0.0, 0.05, 0.25, 0.5, 0.95, 0.999, 1.0)
    got = {(r.g, r.q): r.quantile for r in M.column_quantile(df, cols=["x"], qs=qs, by=["g"]).collect()}
    assert len(got) == len(groups) * len(qs)
    for g, vs in groups.items():
        for q in qs:
            assert got[g, q] == pytest.approx(np.quantile(vs, q), abs=1e-12), (g, q)


def test_quantiles_exchange_no_ranges(spark):
    from voltide.operators import metrics as M

    plan = plan_of(M.column_quantile(spark.range(100).selectExpr("cast(id as double) x"), cols=["x"]))
    assert "rangepartitioning" not in plan
