"""Files, streams, and the training and scoring jobs."""

import os
from datetime import date, datetime

import pytest
from support import SF, rows
from pyspark.sql import functions as F

from voltide.operators import models as ML
from voltide.plans.score import scoring_job
from voltide.plans.train import training_job
from voltide.sources import tables as IO
from voltide.streaming import jobs as J


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-02", 1, 'He said "up", twice\nthen left', " padded "), ("bad date", 0, None, "x")], "Date string, Label int, Top1 string, Top2 string")
    IO.sink_csv(df, str(tmp_path / "c"))
    got = IO.scan_csv_wide(spark, str(tmp_path / "c"), schema=IO.wide_schema(2), multiline=True).orderBy("Label").collect()
    assert got[1] == (date(2020, 1, 2), 1, 'He said "up", twice\nthen left', " padded ") and got[0].Date is None


def test_rerun_of_a_day_replaces_it(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(date(2024, 1, i), i, 0) for i in (1, 2, 3)], "date date, x int, run int")
    IO.sink_by_day(df, path)
    IO.sink_by_day(df.where("x = 2").withColumn("run", F.lit(1)), path)
    assert rows(spark.read.parquet(path).select("x", "run")) == [(1, 0), (2, 1), (3, 0)]


def test_writes_are_rebalanced_by_partition(spark):
    from support import plan_of

    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(IO.gathered(spark.range(9), ["id"]))


def test_recent_by_name_skips_bad_names(spark, tmp_path):
    for name in ("2024-01-01", "2024-01-09", "2024-13-45", "nothing"):
        spark.createDataFrame([(name,)], "name string").coalesce(1).write.parquet(str(tmp_path / "in" / f"{name}_detailed"))
    got = IO.scan_recent_by_name(spark, str(tmp_path / "in"), asof=date(2024, 1, 10), days=7)
    assert [(r.name, r.file_date) for r in got.collect()] == [("2024-01-09", date(2024, 1, 9))]


def test_fallback_order(spark):
    df = spark.range(3).withColumn("w", F.lit("a"))
    other = spark.range(2).withColumn("w", F.lit("b"))
    assert {r.w for r in IO.with_fallback(df, other).collect()} == {"a"}
    assert {r.w for r in IO.with_fallback(df.where("id > 9"), other).collect()} == {"b"}
    empty = IO.with_fallback(df.where("id > 9"), other.where("id > 9"))
    assert empty.count() == 0 and empty.columns == ["id", "w"]


def test_parquet_round_trip_keeps_shape(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/labels.parquet")
    IO.sink_parquet(df, str(tmp_path / "l"))
    assert rows(IO.scan_parquet(spark, str(tmp_path / "l"))) == rows(df)


def test_retention(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1), (datetime(2024, 3, 1), 2)], "ts timestamp_ntz, x int")
    IO.sink_parquet(df, str(tmp_path / "m"))
    kept = IO.apply_retention(spark, str(tmp_path / "m"), str(tmp_path / "k"), ts="ts", asof=F.lit("2024-03-15 00:00:00").cast("timestamp_ntz"))
    assert [r.x for r in kept.collect()] == [2]


def test_stream_drops_late_rows_and_closes_days(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "ts timestamp_ntz, p double"
    days = [[(datetime(2024, 1, 1, h), 0.9) for h in (1, 2)], [(datetime(2024, 1, 3, 5), 0.2)], [(datetime(2024, 1, 1, 3), 0.1), (datetime(2024, 1, 4, 9), 0.4)]]
    target = str(tmp_path / "out")
    for i, day in enumerate(days):  # one run per arriving file, same checkpoint
        spark.createDataFrame(day, schema).coalesce(1).write.mode("append").parquet(src)
        stream = J.read_stream(spark, src, spark.createDataFrame([], schema).schema)
        path = J.run_available(J.stream_daily_vote(stream), "votes", target=target)
    got = spark.read.parquet(path).orderBy("window_start").collect()
    assert [(r.num_headlines, r.prediction_majority_vote) for r in got] == [(2, 1), (1, 0)]  # the late row is gone, day 4 is open


def test_stream_equals_batch(spark):
    schema = spark.read.parquet(f"{SF}/conversations.parquet").schema
    stream = J.read_stream(spark, SF, schema, glob="conversations.parquet")
    path = J.run_available(J.score_rows(stream, text="text"), "scored")
    assert rows(spark.read.parquet(path)) == rows(J.score_rows(spark.read.parquet(f"{SF}/conversations.parquet"), text="text"))


def test_search_space():
    a, b = ML.draw_candidates(5, seed=1), ML.draw_candidates(5, seed=1)
    assert a == b and a != ML.draw_candidates(5, seed=2)
    assert all(0.01 <= c["learning_rate"] <= 0.3 and c["max_depth"] in (3, 4, 5, 6, 7) for c in a)
    assert len(ML.grid_candidates(x=[1, 2], y=[3])) == 2


def test_registry_prefers_production(spark, tmp_path):
    reg = str(tmp_path / "reg")
    at = lambda h: datetime(2024, 1, 1, h)
    ML.register_model(spark, reg, name="m", version=1, stage="Staging", path="a", at=at(1))
    ML.register_model(spark, reg, name="m", version=2, stage="Staging", path="b", at=at(2))
    assert ML.model_registry(spark.read.parquet(reg), name="m").first().version == 2
    ML.register_model(spark, reg, name="m", version=1, stage="Production", path="a", at=at(3))
    assert ML.model_registry(spark.read.parquet(reg), name="m").first().version == 1
    ML.register_model(spark, reg, name="m", version=1, stage="Archived", path="a", at=at(4))
    assert ML.model_registry(spark.read.parquet(reg), name="m").first().version == 2
    with pytest.raises(LookupError):
        ML.load_registered(spark, reg, name="other")


def test_train_then_score(spark, tmp_path):
    """A word decides the label: the trained model finds it, and the daily files are written."""
    data = [(date(2024, 1, 1 + i % 12), i, ("storm surge" if i % 12 % 2 else "calm steady") + f" w{i % 5}", i % 12 % 2, float(i % 3)) for i in range(240)]
    tall = spark.createDataFrame(data, "date date, id bigint, Headline string, vol_up int, x double")
    cut = lambda a, b: tall.where(F.dayofmonth("date").between(a, b))
    base = str(tmp_path)
    common = dict(registry=f"{base}/reg", name="vol", order="id", label="vol_up", day="date", numeric=["x"])
    candidates = ML.grid_candidates(max_features=[20], max_ngram=[1, 2], max_depth=[2], n_estimators=[2])
    model, log, metrics = training_job(
        cut(1, 6), cut(7, 9), cut(10, 12), text="Headline", candidates=candidates, model_path=f"{base}/m1", version=1, at=datetime(2024, 2, 1), stopwords=[], **common
    )
    found = {(r.level, r.metric): r.value for r in metrics.collect()}
    assert found[("headline", "accuracy")] == 1.0 and found[("daily_mean_proba", "auc")] == 1.0 and found[("size", "num_test_days")] == 3.0
    assert {r.trial for r in log.collect()} == {0, 1}
    top = ML.top_k_importance(ML.feature_importance(model, spark, numeric=["x"]), k=3).first()
    assert top.feature.split()[0] in {"storm", "surge", "calm", "steady"}
    daily = scoring_job(spark, cut(10, 12), target=None, at=datetime(2024, 2, 2), path=f"{base}/out", **common)
    got = daily.orderBy("date").collect()
    assert [r.prediction_mean_class == r.true_label for r in got] == [True] * 3 and got[0].num_headlines == 20
    assert sorted(os.listdir(f"{base}/out/daily"))[-1] == "date=2024-01-12"
    detailed = spark.read.parquet(f"{base}/out/detailed")
    assert detailed.count() == 60 and {"x", "Headline", "prediction_class", "confidence"} <= set(detailed.columns)
    one = scoring_job(spark, cut(10, 12), target=date(2030, 1, 1), at=datetime(2024, 2, 2), path=f"{base}/one", **common)
    assert [r.date for r in one.collect()] == [date(2024, 1, 10)]
