"""Ordered computations that never put one whole group into one task.

A plain ``Window.partitionBy(series)`` sorts a series inside a single task. That is fine for
bar tables (one row per series and period, so a series is as long as the calendar), and wrong
for raw rows, where one series may hold a third of the data. The helpers here cut the *total*
order ``(series, order...)`` into range partitions of equal size ("chunks"), work inside a
chunk, and stitch the chunks together through one small row per (series, chunk).

The bounds of the chunks come from a bounded sample of the keys, drawn once by a subquery of the
plan: the chunk of a row is a function of its keys, so all branches agree, nothing has to be written,
and building a plan runs nothing. ``chunks`` says how many there are (by default as many as the session shuffles into).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"

#: Sampled keys for each chunk.
SAMPLE_PER_CHUNK = 60


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, and where that is
    unset a folder in the warehouse, which is shared as well."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        unset = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or unset)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: it survives the loss of executors, cuts the
    lineage, and each branch reads only the columns it needs. Frames that Parquet cannot hold are
    checkpointed row by row."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    if any(isinstance(f.dataType, T.NullType) for f in df.schema.fields):
        return df.checkpoint(eager=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Spread a plain table scan that has fewer splits than the cluster has cores, before CPU-heavy
    work per row. Large tables already come in many splits and pass through without a shuffle.

    Only for scans: counting the partitions of a plan with shuffles would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def chunk_bounds(df: DataFrame, keys: Sequence[str], chunks: int) -> Column:
    """The least keys of all chunks but the first, from a sample of at most ``SAMPLE_PER_CHUNK`` keys a chunk.

    A scalar subquery: it runs when the result is asked for, and where the frame ends in an exchange, that
    exchange is shared with the branches that use the bounds, so the input is computed once. The sample is
    that of the smallest hashes: the same rows whenever and wherever it is drawn, so that branches agree
    even if each draws its own.
    """
    drawn = df.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(SAMPLE_PER_CHUNK * chunks).agg(F.sort_array(F.collect_list(F.struct(*keys))).alias("k"))
    n = F.size("k")
    at = F.transform(F.sequence(F.lit(1), F.lit(chunks - 1)), lambda i: F.floor(n * i / chunks).cast("int"))
    picked = F.when(n > 0, F.array_distinct(F.transform(at, lambda i: F.get("k", i))))
    return drawn.select(picked.alias("bounds")).scalar()


def chunk_of(keys: Sequence[str], bounds: Column) -> Column:
    """How many bounds a row's keys reach: a binary search, nulls first as in a sort."""
    own = F.struct(*keys)

    def halve(range_: Column, _: Column) -> Column:
        low, high = range_["low"], range_["high"]
        mid = F.shiftright(low + high, 1)
        reached = F.get(bounds, mid) <= own
        return F.when(low >= high, range_).when(reached, F.struct((mid + 1).alias("low"), high.alias("high"))).otherwise(F.struct(low.alias("low"), mid.alias("high")))

    n = F.coalesce(F.size(bounds), F.lit(0))
    steps = F.when(n > 0, F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.lit(0).alias("low"), F.greatest(n, F.lit(0)).alias("high"))
    return F.aggregate(steps, start, halve, lambda r: r["low"])


def position(df: DataFrame, order: Sequence[str]) -> Column:
    """One value that sorts like the columns of ``order``.

    A time and an integer key become one decimal number: it fits the buffer of a hash aggregate, where
    a struct would make Spark sort all rows first. A row without a time comes before all others.
    """
    types = dict(df.dtypes)
    if len(order) == 1:
        return F.col(order[0])
    if len(order) == 2 and types[order[0]] in ("timestamp", "timestamp_ntz", "date") and types[order[1]] in ("bigint", "int", "smallint", "tinyint"):
        zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.timestamp_diff("MICROSECOND", zero, F.col(order[0]).cast("timestamp_ntz")).cast("decimal(18,0)")
        placed = micros * F.lit(str(2**63)).cast("decimal(19,0)") + F.coalesce(F.col(order[1]), F.lit(-(2**63))).cast("decimal(19,0)")
        return F.coalesce(placed.cast("decimal(38,0)"), F.lit("-" + "9" * 37).cast("decimal(38,0)"))
    return F.struct(*order)


def range_chunks(df: DataFrame, keys: Sequence[str], chunk: str = CHUNK, chunks: int | None = None) -> DataFrame:
    """Each row with the number of its range of the total order ``keys``."""
    n = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return df.withColumn(chunk, F.lit(0))
    return df.withColumn("_bounds", chunk_bounds(df, keys, n)).withColumn(chunk, chunk_of(keys, F.col("_bounds"))).drop("_bounds")


def partition_ranges(df: DataFrame, keys: Sequence[str], chunk: str = CHUNK) -> DataFrame:
    """The same by Spark's own range partitions, for plans that read the result in one branch only: no
    bounds are drawn beforehand, so building the plan runs nothing."""
    return df.repartitionByRange(*keys).withColumn(chunk, F.spark_partition_id())


def chunk_starts(chunked: DataFrame, by: Sequence[str], sums: Sequence[str], first: str | None = None) -> DataFrame:
    """One row per (group, chunk): sums over the earlier chunks, and over the whole group.

    The windows here run over at most one row per chunk and group.
    """
    aggs = [F.sum(c).alias(f"_sum_{c}") for c in sums]
    if first is not None:
        aggs.append(F.min(first).alias("_first"))
    per_chunk = chunked.groupBy(*by, CHUNK).agg(*aggs)
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    out = {}
    for c in sums:
        out[f"_start_{c}"] = F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0))
        out[f"{c}_total"] = F.sum(f"_sum_{c}").over(whole)
    if first is not None:
        out["_next_first"] = F.lead("_first").over(whole.orderBy(CHUNK))
    return per_chunk.withColumns(out).drop(*[f"_sum_{c}" for c in sums], "_first")


def running_sums(
    df: DataFrame,
    *,
    by: Sequence[str] = (),
    order: Sequence[str],
    sums: Sequence[str],
    next_of: str | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Exact prefix sums over groups of any size.

    Adds ``<c>_before`` (sum of ``c`` over the earlier rows of the group) and ``<c>_total`` for
    each column of ``sums``; with ``next_of``, also ``<next_of>_next``, the following row's value.
    ``order`` must be total within a group, and ``next_of`` its leading column.

    Each chunk gets one extra row in front of its own rows that carries the sums of the chunks
    before it. An ordinary running sum inside the chunk then is the running sum of the group, with
    one shuffle and no join.
    """
    by, order = list(by), list(order)
    chunked = range_chunks(df, [*by, *order], chunks=chunks)
    starts = chunk_starts(chunked, by, sums, first=next_of)
    carried = [f"{c}_total" for c in sums] + (["_next_first"] if next_of is not None else [])
    heads = starts.select(*by, CHUNK, *[F.col(f"_start_{c}").alias(c) for c in sums], *carried, F.lit(0).alias("_row"))
    rows = chunked.withColumn("_row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy(*by, CHUNK).orderBy("_row", *order)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    head = w.rowsBetween(Window.unboundedPreceding, 0)
    out = {f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in sums}
    totals = {f"{c}_total": F.first(f"{c}_total").over(head) for c in sums}
    if next_of is not None:
        out[f"{next_of}_next"] = F.coalesce(F.lead(next_of).over(w), F.first("_next_first").over(head))
    summed = rows.withColumns({**out, **totals}).where(F.col("_row") == 1)
    return summed.select(*df.columns, *out, *totals)


def row_index(df: DataFrame, *, by: Sequence[str] = (), order: Sequence[str], out: str = "row_num") -> DataFrame:
    """1-based position of each row in its group (or in the whole frame), as ``row_number``."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    counted = running_sums(ones, by=by, order=order, sums=["_one"])
    return counted.select(*df.columns, (F.col("_one_before") + 1).alias(out), F.col("_one_total").alias(f"{out}_of"))


Frames = Callable[[Window], dict[str, Column]]
Build = Callable[[DataFrame, list[str]], DataFrame]


def per_series(
    df: DataFrame,
    build: Build,
    *,
    series: Sequence[str],
    order: Sequence[str],
    lookback: int,
    lookahead: int = 0,
    per_period: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Run a per-series computation made of bounded ROWS windows.

    ``build(frame, keys)`` adds columns with windows partitioned by ``keys`` and ordered by
    ``order``; a row's result may depend on at most ``lookback`` rows before it and ``lookahead``
    rows after it, through all its windows together.

    ``per_period=True`` says the frame has at most one row per series and period, so that a series
    is as long as the calendar and fits one task. Raw rows always run in ``chunks``.
    """
    series, order = list(series), list(order)
    if per_period:
        return build(df, series)
    return in_chunks(df, build, series=series, order=order, lookback=lookback, lookahead=lookahead, chunks=chunks)


def series_frames(df: DataFrame, *, series: Sequence[str], order: Sequence[str], frames: Frames, **how) -> DataFrame:
    """``per_series`` for columns over a single window: ``frames(w)`` names and builds them."""
    build = lambda d, keys: d.withColumns(frames(Window.partitionBy(*keys).orderBy(*order)))
    return per_series(df, build, series=series, order=order, **how)


def in_chunks(df: DataFrame, build: Build, *, series: Sequence[str], order: Sequence[str], lookback: int, lookahead: int = 0, chunks: int | None = None) -> DataFrame:
    """``build`` over range partitions of the total order: each chunk also gets copies of the
    ``lookback`` rows before it and the ``lookahead`` rows after it, from as many neighbouring
    chunks as needed, and the copies leave again."""
    series, order = list(series), list(order)
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    chunked = range_chunks(ones, [*series, *order], chunks=chunks)
    per_chunk = chunked.groupBy(*series, CHUNK).agg(F.sum("_one").alias("_n"))
    whole = Window.partitionBy(*series).orderBy(CHUNK)
    before = F.coalesce(F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = per_chunk.withColumn("_start", before).withColumn("_end", F.col("_start") + F.col("_n"))
    copies = []
    if lookback:
        copies.append(_halo(chunked, spans, series, order, lookback, back=True))
    if lookahead:
        copies.append(_halo(chunked, spans, series, order, lookahead, back=False))
    own = chunked.withColumn("_copy", F.lit(False))
    everything = reduce(DataFrame.unionByName, copies, own)
    built = build(everything.drop("_one"), [*series, CHUNK])
    return built.where(~F.col("_copy")).drop("_copy", CHUNK)


def _halo(chunked: DataFrame, spans: DataFrame, series: list[str], order: list[str], rows: int, *, back: bool) -> DataFrame:
    """Copies of the last (first) rows of each chunk, addressed to the later (earlier) chunks
    whose own first (last) row lies within ``rows`` positions."""
    neighbours = Window.partitionBy(*series).orderBy(CHUNK)
    neighbours = neighbours.rowsBetween(1, rows) if back else neighbours.rowsBetween(-rows, -1)
    # every chunk has at least one row, so at most `rows` chunks can be within reach
    reach = spans.withColumn("_targets", F.collect_list(F.struct(F.col(CHUNK).alias("c"), F.col("_start").alias("s"), F.col("_end").alias("e"))).over(neighbours))
    keys = [*series, CHUNK]
    reach = reach.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_start", "_end", "_targets")
    edge_order = [F.col(c).desc() if back else F.col(c).asc() for c in order]
    ranked = chunked.withColumn("_edge", F.row_number().over(Window.partitionBy(*keys).orderBy(*edge_order)))
    edges = ranked.where(F.col("_edge") <= rows)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    placed = edges.join(reach, on, "inner")
    if back:
        position = F.col("_end") - F.col("_edge")
        near = F.filter("_targets", lambda t: t["s"] - position <= rows)
    else:
        position = F.col("_start") + F.col("_edge") - 1
        near = F.filter("_targets", lambda t: position - t["e"] < rows)
    sent = placed.withColumn("_to", F.explode(near))
    return sent.withColumn(CHUNK, F.col("_to.c")).select(*chunked.columns, F.lit(True).alias("_copy"))
