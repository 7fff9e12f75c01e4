"""Drift between reference and current data, and data-quality tests.

All columns of a kind are unpivoted into one frame keyed by column name: one job serves them all.
Numeric statistics work on value counts with distributed prefix sums, so neither a popular value
nor a long column ends in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.operators.metrics import duplicated_rows, is_constant
from voltide.operators.ordering import row_index, running_sums

# Thresholds of the drift tests: p-value for the small-sample tests, distance for the
# large-sample ones, share of drifted columns for the data set, floor of the deviation.
P_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
SHARE_THRESHOLD = 0.5
STD_FLOOR = 0.001
KS_TERMS = 100


def two_sided(reference: DataFrame, current: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """(column, value, is_current) of both data sets; ``kind`` is the common value type."""
    def side(df: DataFrame, flag: int) -> DataFrame:
        wide = df.select(*[F.col(c).cast(kind).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "column", "value").withColumn("is_current", F.lit(flag))

    return side(reference, 0).unionAll(side(current, 1)).where(F.col("value").isNotNull())


def value_counts(rows: DataFrame) -> DataFrame:
    now = F.col("is_current").cast("bigint")
    return rows.groupBy("column", "value").agg(F.sum(1 - now).alias("n_ref"), F.sum(now).alias("n_cur"))


def numeric_ranks(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    counts = value_counts(two_sided(reference, current, cols, "double"))
    return running_sums(counts, by=["column"], order=["value"], sums=["n_ref", "n_cur"], next_of="value")


def _cdf_gap() -> Column:
    """|F_ref - F_cur| just after a value."""
    ref = (F.col("n_ref_before") + F.col("n_ref")) / F.nullif(F.col("n_ref_total"), F.lit(0))
    cur = (F.col("n_cur_before") + F.col("n_cur")) / F.nullif(F.col("n_cur_total"), F.lit(0))
    return F.abs(ref - cur)


def ks_p_value(stat: Column, n: Column, m: Column, terms: int = KS_TERMS) -> Column:
    """Asymptotic two-sided p-value, 2 * sum (-1)^(k-1) exp(-2 k^2 x^2), x = D sqrt(nm / (n + m))."""
    x2 = stat * stat * n.cast("double") * m / (n + m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * k * k * x2),
    )
    # for very small x the alternating series has not converged yet; the limit is 1
    return F.when(x2 < 0.0016, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))


def numeric_drift_ks(reference: DataFrame, current: DataFrame, *, cols: Sequence[str], threshold: float = P_THRESHOLD) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value per numeric column."""
    return ks_of(numeric_ranks(reference, current, cols), threshold)


def ks_of(ranks: DataFrame, threshold: float = P_THRESHOLD) -> DataFrame:
    stats = ranks.groupBy("column").agg(F.max(_cdf_gap()).alias("ks"), F.max("n_ref_total").alias("n_ref"), F.max("n_cur_total").alias("n_cur"))
    scored = stats.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    return scored.withColumn("drifted", F.col("p_value") < threshold)


def numeric_drift_wasserstein(reference: DataFrame, current: DataFrame, *, cols: Sequence[str], threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """Wasserstein distance over the reference deviation, per numeric column."""
    return wasserstein_of(numeric_ranks(reference, current, cols), reference, cols, threshold)


def wasserstein_of(ranks: DataFrame, reference: DataFrame, cols: Sequence[str], threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    moved = ranks.groupBy("column").agg(F.coalesce(F.sum(_cdf_gap() * (F.col("value_next") - F.col("value"))), F.lit(0.0)).alias("wasserstein"))
    # the deviation comes from the raw values in one pass (Spark's merge is stable), not from squares
    devs = reference.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in cols]).unpivot([], list(cols), "column", "ref_std")
    scored = moved.join(devs, "column")
    distance = F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(STD_FLOOR))
    return scored.withColumn("distance", distance).withColumn("drifted", F.col("distance") >= threshold)


def categorical_drift(reference: DataFrame, current: DataFrame, *, cols: Sequence[str], threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """Jensen-Shannon distance and chi-square statistic of the category shares per column.

    The counts per (column, category) of both sides come from one aggregate instead of a join.
    """
    counts = value_counts(two_sided(reference, current, cols, "string"))
    return shares_of(counts, threshold)


def shares_of(counts: DataFrame, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("ref_total"), F.sum("n_cur").alias("cur_total"))
    rows = counts.join(totals, "column")
    p, q = F.col("n_ref") / F.nullif(F.col("ref_total"), F.lit(0)), F.col("n_cur") / F.nullif(F.col("cur_total"), F.lit(0))
    mid = (p + q) / 2
    # the chi-square test compares the current counts with the reference shares
    expected = p * F.col("cur_total")
    part = lambda x: F.when(x > 0, x * F.ln(x / mid)).otherwise(0.0)
    agg = rows.groupBy("column").agg(
        F.count(F.lit(1)).alias("categories"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(part(p) + part(q)) / 2)).alias("js_distance"),
        F.sum(F.when(expected > 0, F.pow(F.col("n_cur") - expected, 2) / F.nullif(expected, F.lit(0.0)))).alias("chi_square"),
    )
    return agg.withColumn("drifted", F.col("js_distance") >= threshold)


def _chi2_tail(stat: float | None, dof: float | None) -> float | None:
    """Upper tail of the chi-square distribution (regularised incomplete gamma); unknown stays unknown."""
    if stat is None or dof is None or math.isnan(stat) or math.isnan(dof):
        return None
    if not stat > 0 or not dof > 0:
        return 1.0
    a, x = dof / 2, stat / 2
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # power series for the lower tail
        term = total = 1 / a
        k = a
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - front * total)
    # Lentz's continued fraction for the upper tail
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(T.DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """p-values for a result with one row per column."""
    return pd.Series([_chi2_tail(s, d) for s, d in zip(stat, dof)], dtype="float64")


def target_drift(reference: DataFrame, current: DataFrame, *, target: str, prediction: str | None = None, threshold: float = DISTANCE_THRESHOLD) -> DataFrame:
    """Drift of the class columns of the mapping."""
    cols = [target] + ([prediction] if prediction else [])
    return categorical_drift(reference, current, cols=cols, threshold=threshold)


def column_drift(
    reference: DataFrame, current: DataFrame, *, numeric: Sequence[str] = (), categorical: Sequence[str] = (), text: Sequence[str] = (), key: str | None = None, small: bool = False, **thresholds
) -> DataFrame:
    """One row per column in a common form: (column, test, score, drifted).

    ``small`` picks the small-sample tests (KS and chi-square p-values) in place of the distances. Text columns
    are tested by a classifier of their words; ``key`` names the rows' key, if they have one.
    """
    parts = []
    if numeric and small:
        ks = numeric_drift_ks(reference, current, cols=numeric, **thresholds)
        parts.append(ks.select("column", F.lit("ks_p_value").alias("test"), F.col("p_value").alias("score"), "drifted"))
    elif numeric:
        w = numeric_drift_wasserstein(reference, current, cols=numeric, **thresholds)
        parts.append(w.select("column", F.lit("wasserstein").alias("test"), F.col("distance").alias("score"), "drifted"))
    if categorical and small:
        c = categorical_drift(reference, current, cols=categorical)
        p = c.withColumn("score", chi2_p_value("chi_square", (F.col("categories") - 1).cast("double")))
        parts.append(p.select("column", F.lit("chi_square_p_value").alias("test"), "score", (F.col("score") < thresholds.get("threshold", P_THRESHOLD)).alias("drifted")))
    elif categorical:
        c = categorical_drift(reference, current, cols=categorical, **thresholds)
        parts.append(c.select("column", F.lit("jensen_shannon").alias("test"), F.col("js_distance").alias("score"), "drifted"))
    if text:
        from voltide.operators.text_drift import text_drift

        for c in text:
            found = text_drift(reference, current, text=c, key=key)
            parts.append(found.select("column", F.lit("text_auc").alias("test"), F.col("auc").alias("score"), "drifted"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dataset_drift(columns: DataFrame, *, share: float = SHARE_THRESHOLD) -> DataFrame:
    """Share of drifted columns and whether it reaches the limit, from ``column_drift`` rows."""
    drifted = F.avg(F.col("drifted").cast("double"))
    return columns.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum(F.col("drifted").cast("bigint")).alias("n_drifted"),
        drifted.alias("drift_share"),
        (drifted >= share).alias("data_drift_detected"),
    )


def mean_shift_sigma(reference: DataFrame, current: DataFrame, *, cols: Sequence[str], sigmas: float = 2.0) -> DataFrame:
    """Columns whose mean moved by more than ``sigmas`` reference deviations."""
    rows = two_sided(reference, current, cols, "double")
    ref, cur = F.when(F.col("is_current") == 0, F.col("value")), F.when(F.col("is_current") == 1, F.col("value"))
    stats = rows.groupBy("column").agg(F.avg(ref).alias("ref_mean"), F.stddev_samp(ref).alias("ref_std"), F.avg(cur).alias("cur_mean"))
    shift = F.abs(F.col("cur_mean") - F.col("ref_mean")) / F.nullif(F.col("ref_std"), F.lit(0.0))
    return stats.withColumn("shift", shift).withColumn("shifted", F.col("shift") > sigmas)


def quality_tests(reference: DataFrame, current: DataFrame) -> DataFrame:
    """The quality test suite: (test, value, reference_value, passed).

    Columns with nulls, rows with nulls, constant columns, duplicated rows (none more than in the
    reference), equal column types.
    """
    def facts(df: DataFrame) -> DataFrame:
        cols = df.columns
        plus = lambda xs: reduce(lambda a, b: a + b, xs)
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        found = df.agg(
            plus([(F.count_if(F.col(c).isNull()) > 0).cast("bigint") for c in cols]).alias("columns_with_nulls"),
            F.count_if(any_null).alias("rows_with_nulls"),
            plus([is_constant(c).cast("bigint") for c in cols]).alias("constant_columns"),
        )
        return found.withColumn("duplicated_rows", duplicated_rows(df))

    names = ["columns_with_nulls", "rows_with_nulls", "constant_columns", "duplicated_rows"]
    have = dict(current.dtypes)
    wrong = sum(have.get(c) != t for c, t in reference.dtypes)
    both = facts(current).select(F.lit("value").alias("side"), *names, F.lit(wrong).cast("bigint").alias("column_types"))
    both = both.unionByName(facts(reference).select(F.lit("reference_value").alias("side"), *names, F.lit(0).cast("bigint").alias("column_types")))
    long = both.unpivot(["side"], [*names, "column_types"], "test", "v")
    wide = long.groupBy("test").agg(
        F.max(F.when(F.col("side") == "value", F.col("v"))).alias("value"),
        F.max(F.when(F.col("side") == "reference_value", F.col("v"))).alias("reference_value"),
    )
    return wide.withColumn("passed", F.col("value") <= F.col("reference_value"))


def correlation_tests(df: DataFrame, *, cols: Sequence[str], target: str, prediction: str | None = None) -> DataFrame:
    """Correlation of each feature with the target (and with the prediction)."""
    roles = [target] + ([prediction] if prediction else [])
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in [*roles, *cols]])
    long = wide.unpivot(roles, list(cols), "column", "value")
    aggs = [F.corr("value", target).alias("target_correlation")]
    if prediction:
        aggs.append(F.corr("value", prediction).alias("prediction_correlation"))
    return long.groupBy("column").agg(*aggs)


def period_drift(reference: DataFrame, current: DataFrame, *, col: str, order: Sequence[str], size: int = 500, threshold: float = P_THRESHOLD) -> DataFrame:
    """Drift and range of ``col`` alone for each consecutive period of ``size`` current rows.

    The reference distribution is not copied per period. Both data sets are merged once to read off
    the reference CDF at every current value (and just below it); then each period, at most ``size``
    rows, finds its largest gap: between two of its own values the period's CDF is flat, so the
    extremes sit at its values and just below them.
    """
    rows = current.select(*order, F.col(col).cast("double").alias("value")).where(F.col("value").isNotNull())
    numbered = row_index(rows, order=order, out="_row").withColumn("period", F.floor((F.col("_row") - 1) / size))
    per = numbered.groupBy("period", "value").agg(F.count(F.lit(1)).alias("k"))
    ref = reference.select(F.col(col).cast("double").alias("value")).where(F.col("value").isNotNull())
    ref_counts = ref.groupBy("value").agg(F.count(F.lit(1)).alias("n_ref"))
    # one frame ordered by value: the reference rows of a value come before the periods' rows of that
    # value, and once more after them, so that the two running sums are its CDF at the value and below
    zero = F.lit(0).cast("bigint")
    first = ref_counts.select("value", F.lit(-1).cast("bigint").alias("period"), zero.alias("k"), "n_ref", zero.alias("n_late"))
    last = ref_counts.select("value", F.lit(2**62).alias("period"), zero.alias("k"), zero.alias("n_ref"), F.col("n_ref").alias("n_late"))
    merged = first.unionByName(last).unionByName(per.select("value", "period", "k", zero.alias("n_ref"), zero.alias("n_late")))
    placed = running_sums(merged, order=["value", "period"], sums=["n_ref", "n_late"]).where(F.col("k") > 0)
    total = F.nullif(F.col("n_ref_total"), F.lit(0))
    right, left = F.col("n_ref_before") / total, F.col("n_late_before") / total
    w = Window.partitionBy("period").orderBy("value")
    n = F.sum("k").over(Window.partitionBy("period"))
    upto = F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0))
    gaps = placed.select("period", "k", "value", "n_ref_total", n.alias("n"), F.greatest(F.abs(upto / n - right), F.abs((upto - F.col("k")) / n - left)).alias("gap"))
    stats = gaps.groupBy("period").agg(
        F.max("n").alias("n_rows"),
        (F.sum(F.col("value") * F.col("k")) / F.max("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max("gap").alias("ks"),
        F.max("n_ref_total").alias("_ref"),
    )
    scored = stats.withColumn("p_value", ks_p_value(F.col("ks"), F.col("_ref"), F.col("n_rows")))
    return scored.withColumn("drifted", F.col("p_value") < threshold).drop("_ref")
