"""Scans, sinks and file management on Spark's own readers and writers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.functions.scalars import parse_date
from voltide.operators.ordering import checkpointed, spread


def wide_schema(slots: int = 25, label: str = "Label") -> T.StructType:
    text = [T.StructField(f"Top{i}", T.StringType()) for i in range(1, slots + 1)]
    return T.StructType([T.StructField("Date", T.StringType()), T.StructField(label, T.IntegerType()), *text])


def scan_csv_wide(spark: SparkSession, path: str, *, schema: T.StructType | None = None, date: str = "Date", multiline: bool = False) -> DataFrame:
    """Wide news CSV with header; an explicit schema saves the inference pass. Dates parsed.

    Files split, so large ones are read by many tasks. ``multiline`` allows line breaks inside quoted
    text, at the price of one task per file.
    """
    raw = spark.read.csv(path, header=True, schema=schema or wide_schema(), multiLine=multiline, escape='"')
    return raw.withColumn(date, parse_date(date))


def sink_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """CSV with header; text keeps its leading and trailing blanks."""
    df.write.mode(mode).csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def scan_parquet(spark: SparkSession, path: str | Sequence[str], *, columns: Sequence[str] | None = None, spread_by: str | None = None) -> DataFrame:
    """A table, or several of one schema. ``spread_by`` names the key that spreads a table of few
    splits over the cores; use it before tokenising or training."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    df = df.select(*columns) if columns else df
    return spread(df, spread_by) if spread_by else df


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of one output partition brought together, so that a write does not leave one small file
    per task and partition. Adaptive execution splits the large ones again: a hot day is written by
    many tasks."""
    return df.hint("rebalance", *keys)


def sink_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    if partition_by:
        gathered(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def sink_by_day(df: DataFrame, path: str, *, date: str = "date") -> None:
    """Write or rewrite only the days in ``df``: running a day again replaces that day."""
    rows = gathered(df, [date])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def sink_predictions_by_day(daily: DataFrame, detailed: DataFrame, path: str, *, date: str = "date") -> None:
    """Daily votes under ``daily/``, one row per headline under ``detailed/``."""
    sink_by_day(daily, f"{path}/daily", date=date)
    sink_by_day(detailed, f"{path}/detailed", date=date)


def scan_recent_by_name(spark: SparkSession, path: str, *, asof: Column | Date, days: int, pattern: str = r".*(\d{4}-\d{2}-\d{2})", **options) -> DataFrame:
    """Rows of the files whose *path* holds a date of the last ``days`` days (the last date in it
    counts); paths without a valid date are skipped. File metadata is constant per file, so the
    filter drops whole files before they are read."""
    df = spark.read.options(recursiveFileLookup=True, **options).parquet(path)
    found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    day = F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date")
    asof = asof if isinstance(asof, Column) else F.lit(asof)
    return df.select("*", day.alias("file_date")).where(F.col("file_date") > F.date_sub(asof, days))


def with_fallback(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The rows of the first frame that has any; all frames empty gives an empty typed frame.

    Each later frame is filtered by "no earlier frame has rows": an existence test that stops at
    the first row.
    """
    out = first
    earlier = [first]
    for df in others:
        unused = [~e.limit(1).exists() for e in earlier]
        cond = unused[0]
        for u in unused[1:]:
            cond = cond & u
        out = out.unionByName(df.where(cond), allowMissingColumns=True)
        earlier.append(df)
    return out


def empty_schema_guard(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the expected columns that are missing, as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def publish_datasets(spark: SparkSession, datasets: dict[str, str], target: str) -> DataFrame:
    """Copy each dataset below ``target``; missing ones are reported and skipped.

    Returns (key, status, rows). The loop is over dataset names; each copy is one Spark job.
    """
    status = {}
    for key, path in datasets.items():
        status[key] = "missing"
        if _exists(spark, path):
            sink_parquet(spark.read.parquet(path), f"{target}/{key}")
            status[key] = "published"
    rows = None
    for key, state in status.items():
        source = spark.read.parquet(f"{target}/{key}") if state == "published" else spark.range(0)
        line = source.agg(F.lit(key).alias("key"), F.lit(state).alias("status"), F.count(F.lit(1)).alias("rows"))
        rows = line if rows is None else rows.unionAll(line)
    return rows


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size, modification time and rows of each file under a path (footer-only scan). The listing as binary
    files, whose content is not read, brings in the files without rows."""
    deep = {"recursiveFileLookup": True}
    held, listed = spark.read.options(**deep).parquet(path), spark.read.options(**deep).format("binaryFile").load(path)
    keys = ["file_path", "file_name", "file_size", "file_modification_time"]
    meta = [df.select(*[f"_metadata.{k}" for k in keys], F.lit(n).alias("n")) for df, n in ((held, 1), (listed, 0))]
    return meta[0].unionByName(meta[1]).groupBy(*keys).agg(F.sum("n").alias("rows"))


def dataset_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, files, size, last modification and rows of each entry of a folder: an entry is a file, or a folder with
    all files below it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    depth = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).depth()
    below = F.split(F.regexp_replace("file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", ""), "/")
    name = F.url_decode(F.replace(F.get(below, depth), F.lit("+"), F.lit("%2B")))
    return (
        file_inventory(spark, path)
        .groupBy(name.alias("name"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("size"), F.max("file_modification_time").alias("modified"), F.sum("rows").alias("rows"))
    )


def metrics_append(metrics: DataFrame, path: str, *, ts: Column, model_version: str = "unknown", run: str | None = None) -> None:
    """Append one row per non-null metric, partitioned by day; creates the table if missing.

    With ``run`` the rows are the partition (day, run), written by dynamic overwrite: a run that comes again
    under its id replaces its rows, also those it left under another day, and no others.
    """
    rows = metrics.select(
        ts.cast("timestamp_ntz").alias("ts"),
        "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"),
        F.lit(model_version).alias("model_version"),
    ).where(F.col("metric_value").isNotNull())
    rows = rows.withColumn("day", F.col("ts").cast("date"))
    if run is None:
        rows.write.mode("append").partitionBy("day").parquet(path)
        return
    # a day's rows of one run are few: one file for each
    kept = checkpointed(rows.withColumn("run", F.lit(run)))
    days = {f"day={r['day']}" for r in kept.select("day").distinct().collect()}
    if days:
        kept.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "run").parquet(path)
    fs, folders = _folders(metrics.sparkSession, f"{path}/day=*/run={_escaped(metrics.sparkSession, run)}")
    for folder in folders:
        if folder.getParent().getName() not in days:
            fs.delete(folder, True)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it into a path, for use in a glob."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in name)


def _folders(spark: SparkSession, glob: str):
    """(file system, folders that match)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, [s.getPath() for s in fs.globStatus(place) or [] if s.isDirectory()]


def metrics_retention(df: DataFrame, *, ts: str, asof: Column, keep: str = "2 MONTHS") -> DataFrame:
    """Rows young enough to keep."""
    return df.where(F.col(ts) >= asof - F.expr(f"INTERVAL {keep}"))


def apply_retention(spark: SparkSession, path: str, target: str, *, ts: str, asof: Column, keep: str = "2 MONTHS") -> DataFrame:
    """Write the kept rows to a new table; the caller swaps the paths."""
    kept = metrics_retention(spark.read.parquet(path), ts=ts, asof=asof, keep=keep)
    sink_parquet(kept, target, partition_by=["day"] if "day" in kept.columns else ())
    return spark.read.parquet(target)


def retention_in_place(spark: SparkSession, path: str, *, ts: str, asof: Column, keep: str = "2 MONTHS", day: str = "day") -> dict[str, int]:
    """Drop the rows that are too old from a table partitioned by ``day`` (and maybe by more below it).

    Whole days go by their folder's name and are not read. Only the day on the border is rewritten, by dynamic
    overwrite of its partitions, and only if it holds rows on both sides. All other files stay as they
    are, so whoever reads them meanwhile goes on. Rows without a time stay, as ``day`` has no date for them.
    Returns how many folders were dropped and how many days rewritten; a second run finds nothing to do.
    """
    edge = spark.range(1).select((asof - F.expr(f"INTERVAL {keep}")).cast("timestamp_ntz").alias("t")).first()["t"]
    if edge is None:
        return {"dropped": 0, "rewritten": 0}
    done = {"dropped": 0, "rewritten": 0}
    border = F.lit(edge).cast("timestamp_ntz")
    on_border = spark.read.parquet(path).where((F.col(day) == border.cast("date")))
    sides = on_border.agg(F.count_if(F.col(ts) < border).alias("old"), F.count_if(F.col(ts) >= border).alias("young")).first()
    if sides["old"] and sides["young"]:
        kept = checkpointed(on_border.where(F.col(ts) >= border))
        below = [c for c in _partition_columns(spark, path) if c != day]
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, *below).parquet(path)
        done["rewritten"] = 1
        if below:  # partitions of the day without young rows were not overwritten
            young = {"/".join([f"{day}={edge.date()}", *[f"{c}={r[c]}" for c in below]]) for r in kept.select(*below).distinct().collect()}
            fs, folders = _folders(spark, f"{path}/{day}={edge.date()}" + "/*" * len(below))
            for folder in folders:
                if "/".join(folder.toString().split("/")[-1 - len(below) :]) not in young:
                    fs.delete(folder, True)
                    done["dropped"] += 1
    last = edge.date() if sides["old"] and not sides["young"] else edge.date() - timedelta(days=1)
    fs, folders = _folders(spark, f"{path}/{day}=*")
    for folder in folders:
        named = folder.getName().split("=", 1)[1]
        if _is_day(named) and Date.fromisoformat(named) <= last:
            fs.delete(folder, True)
            done["dropped"] += 1
    return done


def _is_day(text: str) -> bool:
    try:
        Date.fromisoformat(text)
        return True
    except ValueError:
        return False


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a table, from the names of its first folders."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    while True:
        inner = next((s.getPath() for s in fs.listStatus(place) if s.isDirectory() and "=" in s.getPath().getName()), None)
        if inner is None:
            return out
        out.append(inner.getName().split("=", 1)[0])
        place = inner


def sink_jdbc_metrics(metrics: DataFrame, url: str, *, table: str = "volatility_metrics", properties: dict[str, str] | None = None, connections: int = 8) -> None:
    """Append to a database table over at most ``connections`` connections; Spark creates the table
    if it is missing. The database's driver must be on the class path."""
    rows = metrics.where(F.col("metric_value").isNotNull()).coalesce(connections)
    rows.write.jdbc(url, table, mode="append", properties=properties or {})


def scan_jdbc_metrics(spark: SparkSession, url: str, *, table: str = "volatility_metrics", properties: dict[str, str] | None = None, lower: int, upper: int, key: str = "id", partitions: int = 8) -> DataFrame:
    """The table read in ranges of its key, in parallel; filters are pushed to the database.

    ``lower`` and ``upper`` are the least and the largest key: rows beyond them would pile up in the
    outer ranges.
    """
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties or {})
