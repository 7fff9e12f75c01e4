"""Wide/tall reshapes, column selection, day slices, positions, samples, set operations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date as Date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import nonblank
from voltide.operators.ordering import row_index

NOT_FEATURES = ("Date", "date", "Headline", "headline", "vol_up")
# Multiplier, offset and modulus of the sampling hash, which uses only integer
# arithmetic so that any SQL engine can repeat it.
SAMPLE_A, SAMPLE_B, SAMPLE_P = 48271, 12345, 2147483647


def label_alias(df: DataFrame, *, out: str = "vol_up", names: Sequence[str] = ("vol_up", "Label"), default: int = 0) -> DataFrame:
    """The label under whichever name it has: the first that exists, else the default."""
    have = [n for n in names if n in df.columns]
    if not have:
        return df.withColumn(out, F.lit(default))
    rest = [c for c in df.columns if c not in have]
    return df.select(*rest, F.col(have[0]).alias(out))


def wide_to_tall(df: DataFrame, *, ids: Sequence[str] | None = None, slots: Sequence[str], value: str = "Headline", slot: str | None = None) -> DataFrame:
    """One row per non-blank headline slot; all other columns repeat. Absent slots are ignored.

    A single Expand with a filter: no shuffle.
    """
    have = [s for s in slots if s in df.columns]
    ids = list(ids) if ids is not None else [c for c in df.columns if c not in slots]
    if not have:
        nothing = df.select(*ids, F.lit(None).cast("string").alias(value)).where(F.lit(False))
        return nothing.withColumn(slot, F.lit(None).cast("string")) if slot else nothing
    name = slot or "_slot"
    tall = df.unpivot(ids, have, name, value).where(nonblank(value))
    return tall if slot else tall.drop(name)


def metrics_pivot(df: DataFrame, *, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long metrics to one column per listed metric (a fixed list: no discovery pass)."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def metrics_unpivot(df: DataFrame, *, ids: Sequence[str], cols: Sequence[str], name: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """One row per non-null metric, as doubles (booleans become 0/1)."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(ids), list(cols), name, value).where(F.col(value).isNotNull())


def select_features(
    df: DataFrame,
    *,
    keep: Sequence[str] = (),
    exclude: Sequence[str] = NOT_FEATURES,
    containing: Sequence[str] = (),
    prefixes: Sequence[str] = (),
    wanted: Sequence[str] = (),
) -> DataFrame:
    """Feature columns by exclusion, by substring or prefix, or those of a list that exist."""

    def chosen(c: str) -> bool:
        if c in keep:
            return True
        if c in exclude:
            return False
        tests = [any(t in c for t in containing)] if containing else []
        tests += [c.startswith(tuple(prefixes))] if prefixes else []
        tests += [c in wanted] if wanted else []
        return any(tests) if tests else True

    return df.select(*[c for c in df.columns if chosen(c)])


def dropna_any(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def dropna_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def day_slice_with_fallback(df: DataFrame, *, date: str, target: Date) -> DataFrame:
    """Rows of the target day; without any, rows of the first day; an error if there are none.

    The day is a scalar subquery over the date column, so nothing passes through the driver.
    """
    exact = F.max(F.when(F.col(date) == F.lit(target), F.col(date)))
    missing = F.raise_error(F.lit("No data available for scoring")).cast("date")
    day = df.agg(F.coalesce(exact, F.min(date), missing).alias("day")).scalar()
    return df.where(F.col(date) == day)


def last_n_dates(df: DataFrame, *, date: str, n: int = 7) -> DataFrame:
    """Rows of the n latest distinct dates: n date values are found, then one comparison."""
    latest = df.select(F.col(date).alias("_day")).distinct().orderBy(F.desc("_day")).limit(n)
    start = latest.agg(F.min("_day")).scalar()
    return df.where(F.col(date) >= start)


def scan_recent_window(df: DataFrame, *, date: str, asof: Column | Date, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the as-of date, lower bound excluded."""
    asof = asof if isinstance(asof, Column) else F.lit(asof)
    return df.where(F.col(date) > F.date_sub(asof, days))


def positional_batches(df: DataFrame, *, order: Sequence[str], size: int = 500, out: str = "period") -> DataFrame:
    """Consecutive periods of ``size`` rows by a distributed row number."""
    return row_index(df, order=order, out="_row").withColumn(out, F.floor((F.col("_row") - 1) / size)).drop("_row", "_row_of")


def sample_order(key: str, seed: int = 0) -> Column:
    """h * (h + A) mod P over h = (key * A + offset of the seed) mod P."""
    offset = (SAMPLE_B + seed * SAMPLE_A * SAMPLE_A) % SAMPLE_P
    h = F.pmod(F.pmod(F.col(key).cast("bigint"), F.lit(SAMPLE_P)) * SAMPLE_A + offset, F.lit(SAMPLE_P))
    return F.pmod(h * (h + SAMPLE_A), F.lit(SAMPLE_P))


def seeded_sample_n(df: DataFrame, *, key: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows (all, if fewer), the same ones on every run: the n smallest hashes."""
    return df.orderBy(sample_order(key, seed), key).limit(n)


def bootstrap_sample(df: DataFrame, *, key: str, n: int = 100, seed: int = 42) -> DataFrame:
    """At least ``n`` rows: exactly n of them, drawn without replacement. Fewer rows: as many as there
    are, drawn with replacement. The same rows on every run; ``draw`` numbers them from 0.

    Only the n candidates of ``seeded_sample_n`` are numbered, in the order of their hashes.
    """
    few = seeded_sample_n(df, key=key, n=n, seed=seed)
    place = F.row_number().over(Window.orderBy(sample_order(key, seed), key)) - 1  # over n rows at most
    placed = few.withColumns({"_place": place, "_size": F.count(F.lit(1)).over(Window.partitionBy())})
    # row i also makes draw i: with all n rows there, itself; else the row that the draw's hash names
    drawn = F.when(F.col("_size") >= n, F.col("_place")).otherwise(F.pmod(sample_order("_place", seed), F.col("_size")))
    draws = placed.select(F.col("_place").alias("draw"), drawn.cast("int").alias("_at"))
    return draws.join(placed, F.col("_at") == F.col("_place")).select(*df.columns, "draw")


def head_n(df: DataFrame, *, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sort_by_date(df: DataFrame, *, order: Sequence[str]) -> DataFrame:
    """Chronological order with a tie-break; range partitioned, so no single task sorts all."""
    return df.orderBy(*order)


def concat_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames; columns by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, with their count."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n_copies")).where(F.col("n_copies") > 1)


def pred_in_like(df: DataFrame, *, col: str, values: Sequence[str] = (), prefix: str | None = None) -> DataFrame:
    """Rows whose column is in the list or starts with the prefix; both reach the scan."""
    hit = F.col(col).isin(*values) if values else F.lit(False)
    if prefix is not None:
        hit = hit | F.col(col).startswith(prefix)
    return df.where(hit)


def class_filter_masks(df: DataFrame, *, y: str, value: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """The value split into one column per true class."""
    return df.withColumns({f"{value}_class_{k}": F.when(F.col(y) == k, F.col(value)) for k in classes})
