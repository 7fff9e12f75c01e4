"""Queries over tables that are folders of part files, as well as single files."""

import os
import shutil

from pyspark.sql import functions as F
from support import SF, rows

from voltide.catalog import load
from voltide.sources import tables as IO


def as_folder(spark, tmp_path, name):
    """A folder of tables in which the named one is a folder of three files."""
    d = tmp_path / "tables"
    shutil.copytree(SF, d, ignore=shutil.ignore_patterns(f"{name}.parquet"))
    spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(f"{d}/{name}.parquet")
    return str(d)


def test_stream_of_a_folder_table(spark, tmp_path):
    run = load()[0]["stream_score"]
    want = rows(run(spark, SF))
    assert len(want) == 87 and rows(run(spark, as_folder(spark, tmp_path, "conversations"))) == want


def test_streams_of_events_in_a_folder(spark, tmp_path):
    d = as_folder(spark, tmp_path, "events")
    for name in ("stream_daily_vote", "stream_metric_breach"):
        want = rows(load()[0][name](spark, SF))
        assert want and rows(load()[0][name](spark, d)) == want


def test_inventory_counts_a_folder_table_once(spark, tmp_path):
    run = load()[0]["file_inventory"]
    assert rows(run(spark, as_folder(spark, tmp_path, "documents"))) == rows(run(spark, SF))


def test_inventory_of_entries(spark, tmp_path):
    d = tmp_path / "in b+c"
    spark.range(5).repartition(2).write.parquet(str(d / "a b+c"))
    spark.range(0).coalesce(1).write.parquet(str(d / "empty"))
    spark.range(3).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(str(d / "deep"))
    got = {r["name"]: r for r in IO.dataset_inventory(spark, str(d)).collect()}
    assert {n: r["rows"] for n, r in got.items()} == {"a b+c": 5, "empty": 0, "deep": 3}
    found = {n: [os.path.join(at, f) for at, _, fs in os.walk(d / n) for f in fs if f.endswith(".parquet")] for n in got}
    assert {n: (r["files"], r["size"]) for n, r in got.items()} == {n: (len(fs), sum(map(os.path.getsize, fs))) for n, fs in found.items()}
