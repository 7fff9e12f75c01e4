"""The metrics table: repeated runs, and retention that leaves young files alone."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from voltide.operators.ordering import scratch_path
from voltide.sources import tables as IO


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def metrics(spark, **values):
    return spark.createDataFrame([(k, v) for k, v in values.items()], "metric_name string, metric_value double")


def stored(spark, path, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


def test_a_repeated_run_replaces_its_rows(spark):
    path = scratch_path(spark, "m")
    IO.metrics_append(metrics(spark, auc=0.5, f1=0.4), path, ts=stamp("2024-01-01 23:59:00"), run="a")
    IO.metrics_append(metrics(spark, auc=0.6), path, ts=stamp("2024-01-01 23:59:00"), run="b*")
    # the same run again after midnight, with one metric less
    IO.metrics_append(metrics(spark, auc=0.7), path, ts=stamp("2024-01-02 00:01:00"), run="a")
    assert stored(spark, path, "run", "metric_name", "metric_value") == [("a", "auc", 0.7), ("b*", "auc", 0.6)]
    IO.metrics_append(metrics(spark, auc=None), path, ts=stamp("2024-01-02 00:01:00"), run="b*")
    assert stored(spark, path, "run", "metric_value") == [("a", 0.7)]


def table(spark, days, *more):
    path = scratch_path(spark, "m")
    rows = spark.createDataFrame([(datetime(2024, 1, d, h), d * 100 + h, "r1" if h < 12 else "r2") for d in days for h in (1, 8, 20)], "ts timestamp_ntz, x int, run string")
    rows.withColumn("day", F.col("ts").cast("date")).coalesce(1).write.partitionBy("day", *more).parquet(path)
    return path


def files(spark, path):
    meta = spark.read.parquet(path).select("day", "_metadata.file_path", "_metadata.file_modification_time")
    return {(str(r[0]), r[1], r[2]) for r in meta.distinct().collect()}


@pytest.mark.parametrize("more", [(), ("run",)])
def test_only_the_border_is_rewritten(spark, more):
    path = table(spark, range(1, 11), *more)
    before = files(spark, path)
    done = IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-01-10 10:00:00"), keep="5 DAYS")
    assert stored(spark, path, "x") == [(x,) for x in sorted([520, *(d * 100 + h for d in range(6, 11) for h in (1, 8, 20))])]
    assert done == {"dropped": 4 + len(more), "rewritten": 1}
    after = files(spark, path)
    young = {f for f in before if f[0] > "2024-01-05"}
    assert young <= after and len({f for f in after if f[0] == "2024-01-05"}) == 1
    assert IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-01-10 10:00:00"), keep="5 DAYS") == {"dropped": 0, "rewritten": 0}
    assert files(spark, path) == after


def test_border_day_that_is_all_old_or_all_young(spark):
    path = table(spark, range(1, 5))
    assert IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-01-04 00:30:00"), keep="1 DAYS") == {"dropped": 2, "rewritten": 0}
    assert len(stored(spark, path, "x")) == 6
    assert IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-01-04 23:00:00"), keep="1 DAYS") == {"dropped": 1, "rewritten": 0}
    assert {x // 100 for (x,) in stored(spark, path, "x")} == {4}


def test_a_reader_that_began_before_goes_on(spark):
    """A plan over the young days, made before the run, reads them during and after it."""
    path = table(spark, range(1, 11))
    reader = spark.read.parquet(path).where("day > '2024-01-06'").select("x")
    seen = reader.count()
    IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-01-10 10:00:00"), keep="5 DAYS")
    assert reader.count() == seen == 12


def test_rows_without_a_day_stay(spark):
    path = scratch_path(spark, "m")
    rows = spark.createDataFrame([(datetime(2024, 1, 1), 1), (None, 2), (datetime(2024, 3, 1), 3)], "ts timestamp_ntz, x int")
    rows.withColumn("day", F.col("ts").cast("date")).write.partitionBy("day").parquet(path)
    IO.retention_in_place(spark, path, ts="ts", asof=stamp("2024-03-02 00:00:00"), keep="5 DAYS")
    assert stored(spark, path, "x") == [(2,), (3,)]
    assert IO.retention_in_place(spark, path, ts="ts", asof=F.lit(None).cast("timestamp_ntz")) == {"dropped": 0, "rewritten": 0}
