"""The search over shared term counts against separate fits."""

from datetime import date

import pytest
from support import rows

from voltide.operators import models as ML

WORDS = ["oil", "bank", "rates", "rise", "fall", "calm", "storm", "peace"]


@pytest.fixture(scope="module")
def sides(spark):
    data = [(i, date(2024, 1, 1 + i % 9), f"{WORDS[i % 8]} {WORDS[(i * 3) % 8]} {WORDS[(i * i) % 8]} {WORDS[i % 5]}", (i % 8 in (1, 3, 4)) * 1, float(i % 4)) for i in range(240)]
    df = spark.createDataFrame(data, "id int, date date, t string, y int, x double").coalesce(2)
    return df.where("id < 160"), df.where("id >= 160")


HOW = dict(text="t", label="y", numeric=["x"], stopwords=[])
PLACE = dict(day="date", order="id")
TRIALS = [dict(max_features=k, max_ngram=n, max_depth=2, n_estimators=4) for k, n in ((3, 1), (8, 1), (6, 2), (20, 2))]


def test_log_equals_separate_fits(spark, sides):
    train, val = sides
    best, log = ML.search_hyperparameters(train, val, TRIALS, **HOW, **PLACE)
    got = {(r.trial, r.metric): r.value for r in log.collect()}
    aucs = []
    for i, params in enumerate(TRIALS):
        model = ML.train_boosted_trees(train, **HOW, **params)
        alone = dict(rows(ML.trial_metrics(ML.probability(ML.fill_numeric(val, ["x"]), model), label="y", **PLACE)))
        mine = {m: v for (t, m), v in got.items() if t == i and m != "optimization_metric"}
        assert mine.keys() == alone.keys() and all(mine[m] == pytest.approx(alone[m]) for m in alone)
        aucs.append(alone["daily_mean_proba_auc"])
    assert best == TRIALS[max(range(4), key=lambda i: (aucs[i], -i))]


def test_texts_are_read_once_for_each_range(spark, sides, monkeypatch):
    train, val = sides
    made = []
    plain = ML.TextCounts.__init__

    def counting(self, *args, **how):
        made.append(how["max_ngram"])
        plain(self, *args, **how)

    monkeypatch.setattr(ML.TextCounts, "__init__", counting)
    ML.search_hyperparameters(train, val, TRIALS, **HOW, **PLACE)
    assert sorted(made) == [1, 2]


def test_halving_keeps_the_better_half(spark, sides):
    train, val = sides
    best, log = ML.search_hyperparameters(train, val, TRIALS, **HOW, **PLACE, halvings=1)
    trials = {(r.trial, r.params) for r in log.select("trial", "params").distinct().collect()}
    first, last = [t for t in trials if "n_estimators=2" in t[1]], [t for t in trials if "n_estimators=4" in t[1]]
    assert len(first) == 4 and len(last) == 2
    half = {(r.trial, r.value) for r in log.where("metric = 'optimization_metric' and params like '%n_estimators=2'").collect()}
    kept = {t for t, _ in sorted(half, key=lambda x: (-x[1], x[0]))[:2]}
    assert {t for t, _ in last} == kept and best in [TRIALS[t] for t in kept]


def test_failed_candidates_are_logged(spark, sides):
    train, val = sides
    bad = dict(max_features=3, max_ngram=1, max_depth=-1, n_estimators=2)
    best, log = ML.search_hyperparameters(train, val, [bad, TRIALS[0]], **HOW, **PLACE)
    assert best == TRIALS[0] and log.where("trial = 0 and metric like 'failed: %'").count() == 1
    with pytest.raises(RuntimeError, match="no candidate succeeded"):
        ML.search_hyperparameters(train, val, [bad], **HOW, **PLACE)
