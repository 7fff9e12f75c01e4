"""Exact classification metrics as aggregates, per group or over the whole frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.operators.ordering import CHUNK, partition_ranges


def _flag(cond: Column) -> Column:
    return F.coalesce(cond.cast("bigint"), F.lit(0))


def _ratio(num: Column, den: Column) -> Column:
    """num / den, unknown for an empty denominator."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def f1_from(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(_ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0))


def _cells(y: str, yhat: str) -> dict[str, Column]:
    up, said = F.col(y) == 1, F.col(yhat) == 1
    return {
        "tp": F.sum(_flag(up & said)),
        "fp": F.sum(_flag(~up & said)),
        "fn": F.sum(_flag(up & ~said)),
        "tn": F.sum(_flag(~up & ~said)),
    }


def confusion_counts(df: DataFrame, *, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(y, yhat).items()])


def accuracy(df: DataFrame, *, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def f1_score(df: DataFrame, *, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """Binary F1; 0 where it is undefined."""
    counts = confusion_counts(df, y=y, yhat=yhat, by=by)
    return counts.select(*by, f1_from(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def confusion_matrix(df: DataFrame, *, y: str = "y", yhat: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    """All four cells, also the empty ones."""
    cells = [F.struct(F.lit(t).alias(y), F.lit(p).alias(yhat), F.col(n).alias("n")) for t, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]
    counts = confusion_counts(df, y=y, yhat=yhat, by=by)
    return counts.select(*by, F.inline(F.array(*cells)))


def roc_auc(df: DataFrame, *, y: str = "y", score: str = "p", by: Sequence[str] = (), single_class: float | None = None, copies: str | None = None) -> DataFrame:
    """Exact, tie-aware area under the ROC curve (Mann-Whitney).

    Rows first collapse to one per distinct score (map-side), so a hot score costs one row. The
    distinct scores are range-partitioned, each chunk is reduced to (positives, negatives, wins
    inside the chunk), and one row per chunk is stitched. One branch, so it stays lazy.
    ``single_class`` is the value for a group with one class only (null by default); ``copies`` names a
    column that says how many rows a row stands for.
    """
    by = list(by)
    known = df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
    n = F.lit(1) if copies is None else F.col(copies)
    counts = known.groupBy(*by, score).agg(F.sum(_flag(F.col(y) == 1) * n).alias("pos"), F.sum(_flag(F.col(y) != 1) * n).alias("neg"))
    chunked = partition_ranges(counts, [*by, score])
    below = F.sum("neg").over(Window.partitionBy(*by, CHUNK).orderBy(score).rowsBetween(Window.unboundedPreceding, -1))
    ranked = chunked.withColumn("_below", F.coalesce(below, F.lit(0)))
    wins = F.col("pos").cast("double") * (F.col("_below") + F.col("neg") / 2)
    per_chunk = ranked.groupBy(*by, CHUNK).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.sum(wins).alias("_wins"))
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    stitched = per_chunk.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    total_wins = F.sum(F.col("_wins") + F.col("_p").cast("double") * F.col("_offset"))
    pairs = F.sum("_p").cast("double") * F.sum("_n").cast("double")
    area = total_wins / F.nullif(pairs, F.lit(0.0))
    if single_class is not None:
        area = F.coalesce(area, F.lit(single_class))
    return stitched.groupBy(*by).agg(area.alias("auc"))


def same_group(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two results of one row per group side by side; the group of unknown keys matches itself."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in by])
    return left.join(right, on, "left").drop(*[f"_right_{c}" for c in by])


def _joined(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two metric results side by side: by group, or as two one-row frames."""
    if by:
        return same_group(left, right, by)
    name = next(c for c in right.columns)
    return left.withColumn(name, right.scalar())


def classification_scores(df: DataFrame, *, y: str = "y", yhat: str = "yhat", score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, log-loss, AUC and rows per group.

    Log-loss and AUC are over the rows with a label and a score; ``n`` counts all rows.
    """
    by = list(by)
    # least and greatest skip nulls, so an unknown score has to stay out before them
    p = F.when(F.col(score).isNotNull(), F.least(F.greatest(F.col(score), F.lit(1e-15)), F.lit(1 - 1e-15)))
    loss = F.avg(F.when(F.col(y) == 1, -F.ln(p)).when(F.col(y) != 1, -F.ln(1 - p)))
    aggs = [c.alias(n) for n, c in _cells(y, yhat).items()]
    agg = df.groupBy(*by).agg(*aggs, loss.alias("log_loss"), F.count(F.lit(1)).alias("n"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    scores = agg.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(_ratio(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(_ratio(tp, tp + fn), F.lit(0.0)).alias("recall"),
        f1_from(tp, fp, fn).alias("f1"),
        "log_loss",
        "n",
    )
    return _joined(scores, roc_auc(df, y=y, score=score, by=by), by)


def headline_metrics(df: DataFrame, *, y: str = "y", yhat: str = "yhat", score: str = "p") -> DataFrame:
    """Accuracy, F1 and AUC over all rows, as (metric, value)."""
    return classification_scores(df, y=y, yhat=yhat, score=score).select("accuracy", "f1", "auc").unpivot([], ["accuracy", "f1", "auc"], "metric", "value")


VOTE_METHODS = (
    ("mean_proba", "prediction_mean_class", "prediction_mean_proba"),
    ("majority_vote", "prediction_majority_vote", None),
    ("max_proba", "prediction_max_class", "prediction_max_proba"),
)


def vote_method_metrics(daily: DataFrame, *, y: str = "true_label") -> DataFrame:
    """Accuracy, F1 and AUC of the three vote methods; the majority vote has no score, so no AUC."""
    methods = [
        F.struct(F.lit(m).alias("method"), F.col(c).alias("yhat"), (F.col(s) if s else F.lit(None)).cast("double").alias("p"))
        for m, c, s in VOTE_METHODS
    ]
    rows = daily.select(F.col(y).alias("y"), F.inline(F.array(*methods)))
    scores = classification_scores(rows, by=["method"])
    return scores.select("method", "accuracy", "f1", "auc")


def yearly_metrics(df: DataFrame, *, date: str, y: str, yhat: str, score: str) -> DataFrame:
    """Accuracy, AUC and days per year."""
    rows = df.select(F.year(date).alias("year"), F.col(y).alias("y"), F.col(yhat).alias("yhat"), F.col(score).alias("p"))
    scores = classification_scores(rows, by=["year"])
    return scores.select("year", "accuracy", "auc", F.col("n").alias("days"))


def classification_report(df: DataFrame, *, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Per class precision, recall, F1 and support; accuracy; macro and weighted averages.

    The rows collapse to one per (class, predicted class); everything after that is tiny.
    """
    cells = df.groupBy(F.col(y).cast("string").alias("y"), F.col(yhat).cast("string").alias("yhat")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(
        "n",
        (F.col("y") == F.col("yhat")).alias("hit"),
        F.explode(F.array(F.struct(F.col("y").alias("label"), F.lit(True).alias("actual")), F.struct(F.col("yhat").alias("label"), F.lit(False).alias("actual")))).alias("s"),
    )
    actual = F.col("s.actual")
    per = sides.groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.when(actual & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(actual, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~actual, F.col("n")).otherwise(0)).alias("said"),
    )
    tp, support, said = F.col("tp"), F.col("support"), F.col("said")
    classes = per.select(
        "label",
        F.coalesce(_ratio(tp, said), F.lit(0.0)).alias("precision"),
        F.coalesce(_ratio(tp, support), F.lit(0.0)).alias("recall"),
        F.coalesce(_ratio(2 * tp, said + support), F.lit(0.0)).alias("f1"),
        "support",
        "tp",
    )
    share = _ratio(F.sum("tp"), F.sum("support"))
    whole = classes.agg(
        share.alias("acc"),
        F.sum("support").alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )
    line = lambda label, cols: F.struct(F.lit(label).alias("label"), *[F.col(c).alias(n) for c, n in zip(cols, ("precision", "recall", "f1"))], F.col("n").alias("support"))
    averages = whole.select(
        F.inline(
            F.array(
                line("accuracy", ("acc", "acc", "acc")),
                line("macro avg", ("m_precision", "m_recall", "m_f1")),
                line("weighted avg", ("w_precision", "w_recall", "w_f1")),
            )
        )
    )
    return classes.drop("tp").unionByName(averages)


def evaluate_test(df: DataFrame, *, day: str = "date", y: str = "y", proba: str = "p", order: str) -> DataFrame:
    """Headline and daily metrics plus the row and day counts, as (level, metric, value)."""
    from voltide.functions.scalars import class_threshold
    from voltide.operators.votes import daily_vote

    rows = df.withColumn("_yhat", class_threshold(proba))
    daily = daily_vote(rows, day=day, proba=proba, pred="_yhat", label=y, order=order)
    headline = headline_metrics(rows, y=y, yhat="_yhat", score=proba).select(F.lit("headline").alias("level"), "metric", "value")
    methods = vote_method_metrics(daily).unpivot(["method"], ["accuracy", "f1", "auc"], "metric", "value")
    per_day = methods.where(F.col("value").isNotNull()).select(F.concat(F.lit("daily_"), "method").alias("level"), "metric", "value")
    counts = daily.agg(F.count(F.lit(1)).cast("double").alias("num_test_days"), F.sum("num_headlines").cast("double").alias("num_test_headlines"))
    sizes = counts.unpivot([], ["num_test_days", "num_test_headlines"], "metric", "value").select(F.lit("size").alias("level"), "metric", "value")
    return headline.unionByName(per_day).unionByName(sizes)


def baseline_stats(df: DataFrame, *, date: str, y: str) -> DataFrame:
    share = F.avg(F.col(y).cast("double"))
    return df.agg(
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count(F.lit(1)).alias("days"),
        share.alias("positive_share"),
        F.greatest(share, 1 - share).alias("baseline_accuracy"),
    )


def class_distribution(df: DataFrame, col: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of each value, in the whole frame or in each group of ``by``."""
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else counts.agg(F.sum("n")).scalar()  # one row per group and class
    return counts.withColumn("share", F.col("n") / total)


def class_weights(df: DataFrame, *, y: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) and its ratio to the weight of class 0."""
    counts = df.where(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("n"))
    every = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.when(F.col(y) == 0, F.col("n"))).alias("zero"))).scalar()
    weighted = counts.withColumn("_all", every)
    weight = F.col("_all.n") / (F.col("_all.k") * F.col("n"))
    zero = F.col("_all.n") / (F.col("_all.k") * F.col("_all.zero"))
    return weighted.select(y, "n", weight.alias("weight"), (weight / zero).alias("weight_ratio"))


def histogram(df: DataFrame, *, col: str, bins: int = 50, by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum of all rows; counts, or densities per group.

    The edges are a scalar subquery, the counting one aggregate over at most ``bins`` keys a group.
    """
    by = list(by)
    known = df.where(F.col(col).isNotNull())
    edges = known.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))).scalar()
    lo, hi = F.col("_edges.lo"), F.col("_edges.hi")
    width = (hi - lo) / bins
    place = F.when(hi > lo, F.least(F.floor((F.col(col) - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = known.withColumn("_edges", edges).groupBy(*by, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first(width).alias("_width"))
    if not density:
        return counts.select(*by, "bin", "n")
    rows = F.sum("n").over(Window.partitionBy(*by))  # at most `bins` rows a group
    return counts.select(*by, "bin", "n", (F.col("n") / (rows * F.col("_width"))).alias("density"))


#: Rank error of the sketches that bracket a quantile, as a share of the rows.
SKETCH = 10_000


def column_quantile(df: DataFrame, *, cols: Sequence[str], qs: Sequence[float] = (0.05, 0.95), by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles, one row per (group, column, q)."""
    by = list(by)
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(by, list(cols), "column", "value")
    return selected_quantiles(long.where(F.col("value").isNotNull()), by=[*by, "column"], qs=qs)


def selected_quantiles(rows: DataFrame, *, by: Sequence[str], qs: Sequence[float], value: str = "value") -> DataFrame:
    """Exact quantiles of a column by selection in two passes, (by, q, quantile).

    ``percentile`` would hold all distinct values of a group in one buffer, and a ranking would exchange them
    all. Here mergeable sketches bracket each rank first: both ends are values of the data, off by the
    sketch's rank error at most, which the bracket leaves room for. The second pass counts what lies
    below a bracket (one row a task) and keeps the values inside, a few of ten thousand; only these are sorted.
    """
    by = list(by)
    margin = 3.0 / SKETCH
    ends = [min(max(q + side * margin, 0.0), 1.0) for q in qs for side in (-1, 1)]
    sketch = F.percentile_approx(value, F.array(*[F.lit(float(p)) for p in ends]), F.lit(SKETCH))
    brackets = rows.groupBy(*by).agg(F.count(value).alias("_n"), sketch.alias("_ends"))
    # an end at or beyond the data's own ends is none
    end = lambda i: F.when(F.col("_n") > 2 * SKETCH, F.col("_ends")[i]) if 0.0 < ends[i] < 1.0 else F.lit(None).cast("double")
    parts = [F.struct(F.lit(float(q)).alias("q"), end(2 * i).alias("lo"), end(2 * i + 1).alias("hi")) for i, q in enumerate(qs)]
    held = brackets.select(*[F.col(c).alias(f"_b_{c}") for c in by], "_n", F.array(*parts).alias("_parts"))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in by])
    near = rows.join(held, on).select(*by, F.col(value).alias("_v"), "_n", F.explode(F.filter("_parts", lambda p: p["hi"].isNull() | (F.col(value) <= p["hi"]))).alias("_p"))
    # all values below a bracket are one row
    inside = F.when(F.col("_p.lo").isNull() | (F.col("_v") >= F.col("_p.lo")), F.col("_v"))
    counts = near.groupBy(*by, "_n", F.col("_p.q").alias("q"), inside.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by, "q").orderBy(F.asc_nulls_first("value"))
    ranked = counts.withColumns(
        {
            "n_before": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "value_next": F.lead("value").over(w),
            "n_total": F.col("_n"),
        }
    )
    rank = (F.col("n_total") - 1) * F.col("q")
    low, last = F.floor(rank), F.col("n_before") + F.col("n")
    here = ranked.where((F.col("n_before") <= low) & (low < last))
    upper = F.when((low + 1 < last) | F.col("value_next").isNull(), F.col("value")).otherwise(F.col("value_next"))
    return here.select(*by, "q", (F.col("value") + (rank - low) * (upper - F.col("value"))).alias("quantile"))


def metric_stats(df: DataFrame, *, name: str, value: str, ts: str, since: Column) -> DataFrame:
    """Count, minimum, maximum and average per metric after a point in time."""
    return df.where(F.col(ts) > since).groupBy(name).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(value).alias("min_val"),
        F.max(value).alias("max_val"),
        F.avg(value).alias("avg_val"),
    ).orderBy(name)


def metric_avg(df: DataFrame, *, value: str, name: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Average of the named metrics, or of all values."""
    kept = df.where(F.col(name).isin(*names)) if names else df
    return kept.agg(F.avg(value).alias("avg_value"))


def breach_count(df: DataFrame, *, ts: str, asof: Column, window: str, condition: Column) -> DataFrame:
    """Rows in the window before the as-of time that meet the condition."""
    recent = df.where((F.col(ts) > asof - F.expr(f"INTERVAL {window}")) & condition)
    return recent.agg(F.count(F.lit(1)).alias("n_breaches"))


def split_summary(df: DataFrame, *, split: str = "split", date: str = "date") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def null_counts(df: DataFrame, *, only_missing: bool = True) -> DataFrame:
    """Nulls per column in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column", "n_missing")
    return long.where(F.col("n_missing") > 0) if only_missing else long


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row: equal rows have equal digests. Each value is written with its length, so
    values cannot run into each other, and null differs from every text."""
    parts = []
    for c in df.columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.sha2(F.concat(*parts), 256)


def duplicated_rows(df: DataFrame) -> Column:
    """Number of rows that repeat another one, as a scalar subquery.

    Rows with texts are shuffled as digests, not as texts.
    """
    has_text = any(t not in ("int", "bigint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz") for _, t in df.dtypes)
    keyed = df.select(row_digest(df).alias("_digest")) if has_text else df
    groups = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar()


def is_constant(c: str) -> Column:
    """All known values are the same one."""
    return (F.count(c) > 0) & F.min(c).eqNullSafe(F.max(c))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells, constant and empty columns, duplicated rows."""
    cols = df.columns
    total = lambda xs: reduce(lambda a, b: a + b, xs)
    facts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(cols)).alias("n_columns"),
        total([F.count_if(F.col(c).isNull()) for c in cols]).alias("n_missing_cells"),
        total([is_constant(c).cast("int") for c in cols]).alias("n_constant_columns"),
        total([(F.count(c) == 0).cast("int") for c in cols]).alias("n_empty_columns"),
    )
    return facts.withColumn("n_duplicated_rows", duplicated_rows(df))


def column_summary(df: DataFrame, *, cols: Sequence[str]) -> DataFrame:
    """Count, missing, distinct, most common, mean, deviation, minimum, quartiles, maximum of each
    numeric column. The columns are rows of one frame, so there is one job for all of them."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "column", "value")
    basics = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    known = long.where(F.col("value").isNotNull())
    counts = known.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    common = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), "value"))["value"].alias("most_common"), F.count(F.lit(1)).alias("n_distinct"))
    quart = selected_quantiles(known, by=["column"], qs=(0.25, 0.5, 0.75))
    quartiles = quart.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n) for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return basics.join(common, "column", "left").join(quartiles, "column", "left")
