"""Chunked prefix sums, row numbers and halo windows against plain windows."""

import os
import random

import pytest
from support import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltide.operators import ordering as O


def skewed(spark, n=400, seed=0):
    """One series holds most rows; one is null; some have a single row."""
    rng = random.Random(seed)
    names = ["hot"] * 8 + [None, "b"] 
    data = [(rng.choice(names), rng.randint(0, 40), i, rng.choice([None, 1.0, 2.5, 4.0])) for i in range(n)]
    data += [(f"single{i}", 1, n + i, 1.0) for i in range(5)]
    return spark.createDataFrame(data, "series string, at int, id int, v double").repartition(5)


def window():
    return Window.partitionBy("series").orderBy("at", "id")


def test_row_index(spark, many_chunks):
    df = skewed(spark)
    ours = O.row_index(df, by=["series"], order=["at", "id"], out="n")
    theirs = df.withColumn("n", F.row_number().over(window())).withColumn("n_of", F.count(F.lit(1)).over(Window.partitionBy("series")))
    assert rows(ours) == rows(theirs)
    whole = O.row_index(df, order=["at", "id"], out="n").select("id", "n")
    assert rows(whole) == rows(df.select("id", F.row_number().over(Window.orderBy("at", "id")).alias("n")))


def test_running_sums_and_next(spark, many_chunks):
    df = skewed(spark).withColumn("one", F.lit(1))
    ours = O.running_sums(df, by=["series"], order=["at", "id"], sums=["one", "v"], next_of="at")
    before = window().rowsBetween(Window.unboundedPreceding, -1)
    theirs = df.select(
        *df.columns,
        F.coalesce(F.sum("one").over(before), F.lit(0)).alias("one_before"),
        F.coalesce(F.sum("v").over(before), F.lit(0.0)).alias("v_before"),
        F.lead("at").over(window()).alias("at_next"),
        F.sum("one").over(Window.partitionBy("series")).alias("one_total"),
        F.sum("v").over(Window.partitionBy("series")).alias("v_total"),
    ).select(*ours.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("back,ahead", [(1, 0), (19, 0), (0, 3), (60, 5)])
def test_halo_windows(spark, many_chunks, back, ahead):
    """Frames longer than a whole chunk included."""
    df = skewed(spark, n=120)

    def frames(w):
        return {
            "mean": F.avg("v").over(w.rowsBetween(-back, ahead)),
            "n": F.count(F.lit(1)).over(w.rowsBetween(-back, ahead)),
            "lagged": F.lag("id", back).over(w) if back else F.lit(None),
            "led": F.lead("id", ahead).over(w) if ahead else F.lit(None),
        }

    how = dict(series=["series"], order=["at", "id"], frames=frames, lookback=back, lookahead=ahead)
    cut = O.series_frames(df, chunks=13, **how)
    assert cut.columns == [*df.columns, "mean", "n", "lagged", "led"]
    assert rows(cut) == rows(O.series_frames(df, per_period=True, **how))


def test_chunked_frames_do_not_gather_a_series(spark, many_chunks):
    df = skewed(spark)
    cut = O.series_frames(df, series=["series"], order=["at", "id"], frames=lambda w: {"m": F.avg("v").over(w.rowsBetween(-2, 0))}, lookback=2)
    assert "SinglePartition" not in plan_of(cut)


def test_building_a_chunked_plan_writes_nothing(spark, tmp_path):
    before = set(os.listdir(spark._jvm.java.net.URI(O.shared_dir(spark)).getPath()))
    df = O.row_index(skewed(spark), order=["at", "id"])
    O.running_sums(df.withColumn("one", F.lit(1)), by=["series"], order=["at", "id"], sums=["one"])
    assert set(os.listdir(spark._jvm.java.net.URI(O.shared_dir(spark)).getPath())) == before
    assert "SinglePartition" not in plan_of(O.series_frames(skewed(spark), series=["series"], order=["at", "id"], frames=lambda w: {"m": F.avg("v").over(w.rowsBetween(-2, 0))}, lookback=2))


@pytest.mark.parametrize("chunks", [1, 2, 7, 40])
def test_chunks_are_ranges_with_nulls_first(spark, chunks):
    df = spark.createDataFrame([(None, 1), ("a", None), ("a", 3), ("b", 1), ("b", 2), ("c", 9)] * 20, "s string, n int")
    got = O.range_chunks(df, ["s", "n"], chunks=chunks).orderBy("s", "n").select(O.CHUNK).collect()
    numbers = [r[0] for r in got]
    assert numbers == sorted(numbers) and len(set(numbers)) == min(chunks, 6) or chunks < 7


def test_shared_dir_is_the_sessions(spark):
    assert O.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert O.scratch_path(spark, "x") != O.scratch_path(spark, "x")


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert O.spread(wide, "id") is wide
    assert O.spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_written_cut_prunes_columns_and_keeps_types(spark):
    df = spark.range(5).selectExpr("id", "cast(id as string) s", "timestamp_ntz'2024-01-01 00:00:00.000001' t", "array(id) a")
    cut = O.checkpointed(df)
    assert rows(cut) == rows(df) and cut.dtypes == df.dtypes
    assert "ReadSchema: struct<id:bigint>" in plan_of(cut.select("id"))
    assert rows(O.checkpointed(df.withColumn("nothing", F.lit(None)))) == rows(df.withColumn("nothing", F.lit(None)))


def test_positions_sort_like_their_columns_and_keep_hash_aggregates(spark):
    from voltide.operators import alerts as A
    from voltide.operators import volatility as V

    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'1969-01-01', 5L), (timestamp_ntz'2024-01-01 00:00:00.000001', -7L), (timestamp_ntz'2024-01-01', 9L), (timestamp_ntz'2024-01-01', 10L), (NULL, 1L), (timestamp_ntz'9999-12-31', 9223372036854775807L) AS t(ts, id)")
    placed = [r.id for r in df.orderBy(O.position(df, ["ts", "id"])).collect()]
    assert placed == [r.id for r in df.orderBy("ts", "id").collect()]
    ticks = df.withColumns({"s": F.lit("a"), "v": F.lit(1.0), "metric_name": F.lit("m"), "metric_value": F.lit(1.0)})
    for plan in (plan_of(V.build_bars(ticks, series="s", ts="ts", price="v", order=["ts", "id"], period="hour")), plan_of(A.latest_per_metric(ticks))):
        assert "HashAggregate" in plan and "SortAggregate" not in plan
