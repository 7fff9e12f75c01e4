"""Reshape, volatility, features: expectations on tiny frames, and leak invariants."""

import math
from datetime import date, timedelta

import pytest
from support import SF, plan_of, rows
from pyspark.sql import functions as F

from voltide.operators import features as X
from voltide.operators import reshape as R
from voltide.operators import volatility as V
from voltide.plans.prepare import features_of_bars, publish_splits, tall_dataset


def test_tall_rows_and_features(spark):
    wide = spark.createDataFrame(
        [("2023-01-01", 1, "a", "b", "c", 1.0, 0.5), ("2023-01-02", 0, "d", None, "f", 2.0, 0.6)],
        "Date string, vol_up int, Top1 string, Top2 string, Top3 string, feature1 double, feature2 double",
    )
    tall = R.wide_to_tall(wide, slots=[f"Top{i}" for i in range(1, 26)])
    assert tall.count() == 5
    assert set(tall.columns) == {"Date", "Headline", "vol_up", "feature1", "feature2"}
    assert {r.feature1 for r in tall.where("Date = '2023-01-01'").collect()} == {1.0}
    assert "Exchange" not in plan_of(tall)


def test_blanks_are_dropped(spark):
    wide = spark.createDataFrame([("2023-01-01", 1, "x", None, "", "  \t", 1.0)], "Date string, vol_up int, Top1 string, Top2 string, Top3 string, Top4 string, feature1 double")
    assert [r.Headline for r in R.wide_to_tall(wide, slots=["Top1", "Top2", "Top3", "Top4"]).collect()] == ["x"]


def test_empty_keeps_columns(spark):
    wide = spark.createDataFrame([], "Date string, vol_up int, Top1 string, Top2 string")
    tall = R.wide_to_tall(wide, slots=["Top1", "Top2"])
    assert tall.count() == 0 and {"Date", "Headline", "vol_up"} <= set(tall.columns)


def test_label_names(spark):
    assert R.label_alias(spark.createDataFrame([(3,)], "Label int")).first().vol_up == 3
    assert R.label_alias(spark.createDataFrame([(3,)], "x int")).first().vol_up == 0


def test_calendar(spark):
    df = spark.createDataFrame([(date(2023, 1, 1),), (date(2023, 2, 1),)], "date date")
    sunday = X.calendar_one_hot(X.calendar_features(df)).orderBy("date").first()
    assert (sunday.dow, sunday.month, sunday.quarter) == (6, 1, 1)
    assert (sunday.dow_6, sunday.month_1, sunday.quarter_1) == (1, 1, 1)
    assert sum(sunday[f"month_{m}"] for m in range(1, 13)) == 1


def bar_frame(spark, n=60, series=("a", "b")):
    out = []
    for s in series:
        price = 100.0 + len(s)
        for i in range(n):
            close = price * (1 + 0.01 * math.sin(i * 1.7 + len(out)))
            out.append((s, date(2020, 1, 1) + timedelta(days=i), price, max(price, close) * 1.01, min(price, close) * 0.99, close, 10))
            price = close
    return spark.createDataFrame(out, "series string, date date, open double, high double, low double, close double, volume bigint")


def test_estimators_by_hand(spark):
    bars = spark.createDataFrame(
        [("a", date(2020, 1, 1), 100.0, 110.0, 95.0, 100.0, 1), ("a", date(2020, 1, 2), 100.0, 120.0, 100.0, 110.0, 1), ("a", date(2020, 1, 3), 110.0, 112.0, 90.0, 99.0, 1)],
        "series string, date date, open double, high double, low double, close double, volume bigint",
    )
    first, second, third = V.volatility_metrics(bars).orderBy("date").collect()
    assert first.returns is None and first.realized_vol is None and first.tr_vol is None
    assert first.park_vol == pytest.approx(100 * math.sqrt(252 / (4 * math.log(2)) * math.log(110 / 95) ** 2))
    assert second.realized_vol is None  # one return has no deviation
    assert second.tr_vol == pytest.approx(100 * 20 / 110 * math.sqrt(252))
    r = [math.log(1.1), math.log(0.9)]
    assert third.realized_vol == pytest.approx(abs(r[0] - r[1]) / math.sqrt(2) * math.sqrt(252) * 100)
    labels = [x.vol_up for x in V.vol_target(V.volatility_metrics(bars)).orderBy("date").collect()]
    assert labels == [0, 0, 0]


def test_one_sort_after_the_bars(spark):
    plan = plan_of(X.technical_features(V.vol_target(V.volatility_metrics(bar_frame(spark)))))
    assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning(series") == 1
    assert "Python" not in plan and "SinglePartition" not in plan


def test_features_do_not_see_the_future(spark):
    bars = bar_frame(spark, 60)
    cut = date(2020, 2, 15)
    changed = bars.withColumn("close", F.when(F.col("date") > F.lit(cut), F.col("close") * 3).otherwise(F.col("close")))
    upto = lambda df: rows(features_of_bars(df).where(F.col("date") <= F.lit(cut)))
    assert upto(bars) == upto(changed)
    # not even the current day: its own prices decide the label only
    same_day = bars.withColumn("close", F.when(F.col("date") == F.lit(cut), F.col("close") * 3).otherwise(F.col("close")))
    feats = lambda df: rows(features_of_bars(df).where(F.col("date") <= F.lit(cut)).drop("vol_up"))
    assert feats(bars) == feats(same_day)


def test_splits_are_complete_and_disjoint(spark):
    days = spark.range(0, 1000).select(F.date_add(F.lit("2013-06-01").cast("date"), F.col("id").cast("int")).alias("date"))
    split = X.temporal_split3(days, train_end=date(2013, 12, 31), val_end=date(2014, 12, 31))
    bounds = {r.split: (r.lo, r.hi, r.n) for r in split.groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi"), F.count("date").alias("n")).collect()}
    assert sum(b[2] for b in bounds.values()) == 1000
    assert bounds["train"][1] == date(2013, 12, 31) and bounds["val"][:2] == (date(2014, 1, 1), date(2014, 12, 31)) and bounds["test"][0] == date(2015, 1, 1)


def test_label_means_lose_the_first_led_rows(spark):
    df = spark.createDataFrame([("s", i, i % 2) for i in range(12)], "series string, at int, label int")
    got = X.shifted_label_means(df, series=["series"], order=["at"], windows=(1, 2), per_period=True).orderBy("at").collect()
    assert [r.rolling_mean_1d for r in got] == [None, None, None, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0]
    assert [r.rolling_mean_2d for r in got][:6] == [None, None, None, None, 0.5, 0.5]


def test_rolling_labels_chunked_equal_plain(spark, many_chunks):
    df = spark.createDataFrame([("s", i // 7, i, i % 3 % 2) for i in range(200)], "series string, date int, id int, vol_up int")
    how = dict(series=["series"], order=["date", "id"])
    assert rows(V.rolling_labels(df, chunks=9, **how)) == rows(V.rolling_labels(df, per_period=True, **how))
    assert rows(X.label_lead(df, label="vol_up", chunks=9, **how)) == rows(X.label_lead(df, label="vol_up", per_period=True, **how))


def test_positional_trim_matches_ranks(spark):
    df = spark.createDataFrame([("s" if i % 4 else "t", i) for i in range(90)], "series string, at int")
    kept = {(r.series, r.at) for r in X.positional_trim(df, series=["series"], order=["at"], first=15, last=3).collect()}
    for s in ("s", "t"):
        all_ = sorted(r.at for r in df.where(F.col("series") == s).collect())
        assert sorted(a for x, a in kept if x == s) == all_[15:-3]


def test_seeded_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000)
    a, b = (rows(R.seeded_sample_n(d, key="id", n=100, seed=42)) for d in (df, df.repartition(7)))
    assert a == b and len(a) == 100
    assert rows(R.seeded_sample_n(df, key="id", n=100, seed=43)) != a


def test_day_slice(spark):
    df = spark.createDataFrame([(date(2020, 1, 5), 1), (date(2020, 1, 3), 2)], "date date, x int")
    assert [r.x for r in R.day_slice_with_fallback(df, date="date", target=date(2020, 1, 5)).collect()] == [1]
    assert [r.x for r in R.day_slice_with_fallback(df, date="date", target=date(2021, 1, 1)).collect()] == [2]
    with pytest.raises(Exception, match="No data available"):
        R.day_slice_with_fallback(df.where("x > 5"), date="date", target=date(2020, 1, 5)).collect()


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    bars = V.build_bars(orders.where(F.col("o_orderpriority") == "2-HIGH"), series="o_orderpriority", ts="o_orderdate", price="o_totalprice", order=["o_orderkey"])
    plan = plan_of(bars)
    assert "EqualTo(o_orderpriority,2-HIGH)" in plan and "o_custkey" not in plan and "HashAggregate" in plan


def test_tall_dataset_and_publish(spark, tmp_path):
    bars = bar_frame(spark, 60, series=("index",))
    news = bars.select(F.col("date").alias("Date"), F.lit("first").alias("Top1"), F.when(F.col("volume") > 0, "second").alias("Top2"))
    tall = tall_dataset(bars, news, slots=["Top1", "Top2"])
    kept = features_of_bars(bars).count()
    assert tall.count() == 2 * kept and "realized_vol" not in tall.columns
    publish_splits(tall, str(tmp_path / "splits"), train_end=date(2020, 2, 5), val_end=date(2020, 2, 15))
    back = spark.read.parquet(str(tmp_path / "splits"))
    assert back.count() == tall.count() and back.where("split = 'train'").agg(F.max("date")).first()[0] <= date(2020, 2, 5)


def test_feature_chain_in_chunks(spark, many_chunks):
    """Series cut into chunks shorter than the look-back give the same features."""
    bars = bar_frame(spark, 150, series=("a",)).unionByName(bar_frame(spark, 30, series=("bb",))).repartition(4)
    cut = lambda df: rows(R.dropna_any(df).select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]))
    assert cut(features_of_bars(bars, chunks=17)) == cut(features_of_bars(bars))
    assert features_of_bars(bars, chunks=17).columns == features_of_bars(bars).columns


def test_trim_of_an_unnamed_series(spark):
    df = spark.createDataFrame([(s, i) for s in (None, "a") for i in range(20)], "series string, at int")
    kept = X.positional_trim(df, series=["series"], order=["at"])
    assert rows(kept) == rows(df.where("at between 15 and 16"))
