"""The full monitoring report for every period of the current data, in one long frame.

All periods and all numeric columns share one sweep: value counts keyed by (column, value, period) lie in
one order, the reference's counts stand in it once, and their running sums give every period value the
reference's share below it and the mass below it. What belongs to one period then is a window over its own
values (at most ``size`` rows). There is no loop over periods and no copy of the reference per period.

The rows are written once (numbered, reference as period -1), and so is the sweep; all sections read from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.text import tokenize
from voltide.operators.drift import DISTANCE_THRESHOLD, P_THRESHOLD, SHARE_THRESHOLD, STD_FLOOR, ks_p_value
from voltide.operators.metrics import class_distribution, classification_scores, confusion_counts, is_constant, row_digest
from voltide.operators.ordering import checkpointed, row_index, running_sums

REFERENCE = -1
QUARTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))


def described(df: DataFrame, text: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with length, words and share of non-letters of each text column, and their names."""
    out = {}
    for t in text:
        size = F.length(t)
        letters = F.length(F.regexp_replace(F.col(t), r"[^\p{L}]+", ""))
        out[f"{t}_length"] = size.cast("double")
        out[f"{t}_words"] = F.size(tokenize(t)).cast("double")
        out[f"{t}_non_letter_share"] = F.when(size > 0, (size - letters) / size).when(size == 0, 0.0)
    return df.withColumns(out) if out else df, list(out)


def numbered(reference: DataFrame, current: DataFrame, cols: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """``cols`` of both frames with ``period``: consecutive runs of ``size`` current rows, -1 for the reference."""
    placed = row_index(current.select(*dict.fromkeys([*order, *cols])), order=order, out="_row")
    periods = placed.select(F.floor((F.col("_row") - 1) / size).cast("bigint").alias("period"), *cols)
    return checkpointed(periods.unionByName(reference.select(F.lit(REFERENCE).cast("bigint").alias("period"), *cols)))


def long_of(rows: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    wide = rows.select("period", *[F.col(c).cast(kind).alias(c) for c in cols])
    return wide.unpivot(["period"], list(cols), "column", "value")


def swept(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, period, k) of all periods with the reference's rows (``n_ref``) and mass at or below the
    value, and its rows below it (``n_late``), as ``*_before`` and ``*_total``; the reference's own rows have
    ``n_ref`` > 0 and carry the sums before them."""
    counts = checkpointed(long_of(rows, cols, "double").where(F.col("value").isNotNull()).groupBy("column", "value", "period").agg(F.count(F.lit(1)).alias("k")))
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    own = counts.where(F.col("period") != REFERENCE)
    ref = counts.where(F.col("period") == REFERENCE)
    # the reference's rows of a value come before the periods' rows of it, and once more after them
    parts = [
        ref.select("column", "value", F.lit(0).alias("turn"), "period", zero.alias("k"), F.col("k").alias("n_ref"), (F.col("value") * F.col("k")).alias("mass"), zero.alias("n_late")),
        own.select("column", "value", F.lit(1).alias("turn"), "period", "k", zero.alias("n_ref"), none.alias("mass"), zero.alias("n_late")),
        ref.select("column", "value", F.lit(2).alias("turn"), "period", zero.alias("k"), zero.alias("n_ref"), none.alias("mass"), F.col("k").alias("n_late")),
    ]
    merged = reduce(DataFrame.unionByName, parts)
    return checkpointed(running_sums(merged, by=["column"], order=["value", "turn", "period"], sums=["n_ref", "mass", "n_late"]).where(F.col("turn") < 2))


def crossings(sweep: DataFrame, sizes: DataFrame) -> DataFrame:
    """(column, m, j, x, rows, mass): the least reference value whose share reaches j / m, and the reference's rows
    and mass below it. ``sizes`` has the few row counts m of the periods of each column."""
    ref = sweep.where(F.col("n_ref") > 0).join(sizes, "column").withColumn("m", F.explode("sizes"))
    low = F.floor(F.col("n_ref_before") * F.col("m") / F.col("n_ref_total")).cast("bigint") + 1
    high = F.floor((F.col("n_ref_before") + F.col("n_ref")) * F.col("m") / F.col("n_ref_total")).cast("bigint")
    hit = ref.withColumns({"_low": low, "_high": high}).where(F.col("_low") <= F.col("_high"))
    return hit.select("column", "m", F.explode(F.sequence("_low", "_high")).alias("j"), F.col("value").alias("x"), F.col("n_ref_before").alias("x_rows"), F.col("mass_before").alias("x_mass"))


def numeric_facts(sweep: DataFrame, qs: Sequence[float]) -> DataFrame:
    """One row per (column, period): drift distances and the summary of the values."""
    by = Window.partitionBy("column", "period")
    w = by.orderBy("value")
    n = F.col("n_ref_total")
    own = sweep.where(F.col("k") > 0).select(
        "column",
        "period",
        "value",
        "k",
        n.alias("n"),
        F.col("mass_total").alias("mass_all"),
        F.col("n_ref_before").alias("rows"),
        F.col("mass_before").alias("mass"),
        F.col("n_late_before").alias("below"),
        F.sum("k").over(by).alias("m"),
        F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        (F.sum(F.col("value") * F.col("k")).over(by) / F.sum("k").over(by)).alias("mean"),
        F.lead("value").over(w).alias("next"),
        F.lead("n_late_before").over(w).alias("next_below"),
        # the integral of the reference's distribution up to a value
        (F.col("value") * F.col("n_ref_before") / n - F.col("mass_before") / n).alias("area"),
    )
    own = own.withColumn("next_area", F.lead("area").over(w)).withColumn("first", F.row_number().over(w) == 1)
    sizes = own.groupBy("column").agg(F.collect_set("m").alias("sizes"))
    cuts = crossings(sweep, sizes).withColumnsRenamed({"m": "_m", "j": "_j", "column": "_column"})
    crossed = own.join(cuts, (F.col("column") == F.col("_column")) & (F.col("m") == F.col("_m")) & (F.col("upto") == F.col("_j")), "left")
    share, wide = F.col("upto") / F.col("m"), F.col("next") - F.col("value")
    climb = F.col("next_area") - F.col("area")
    at_x = F.col("x") * F.col("x_rows") / F.col("n") - F.col("x_mass") / F.col("n")
    between = (
        F.when(F.col("next").isNull(), 0.0)
        .when(F.col("rows") * F.col("m") >= F.col("upto") * F.col("n"), climb - share * wide)
        .when(F.col("next_below") * F.col("m") <= F.col("upto") * F.col("n"), share * wide - climb)
        .otherwise(share * (F.col("x") - F.col("value")) - (at_x - F.col("area")) + (F.col("next_area") - at_x) - share * (F.col("next") - F.col("x")))
    )
    left = F.when(F.col("first"), F.col("area")).otherwise(0.0)
    right = F.when(F.col("next").isNull(), (F.col("mass_all") - F.col("mass")) / F.col("n") - F.col("value") * (1 - F.col("rows") / F.col("n"))).otherwise(0.0)
    gap = F.greatest(F.abs(share - F.col("rows") / F.col("n")), F.abs((F.col("upto") - F.col("k")) / F.col("m") - F.col("below") / F.col("n")))

    def quantile(q: float) -> Column:
        rank = (F.col("m") - 1) * F.lit(float(q))
        low = F.floor(rank)
        upper = F.when((low + 1 < F.col("upto")) | F.col("next").isNull(), F.col("value")).otherwise(F.col("next"))
        here = (F.col("upto") - F.col("k") <= low) & (low < F.col("upto"))
        return F.max(F.when(here, F.col("value") + (rank - low) * (upper - F.col("value"))))

    spread = F.sqrt(F.sum(F.col("k") * F.pow(F.col("value") - F.col("mean"), 2)) / F.nullif(F.max("m") - 1, F.lit(0)))
    levels = dict([(name, q) for q, name in QUARTILES] + [(f"quantile_{q:.2f}", q) for q in qs])
    return crossed.groupBy("column", "period").agg(
        F.max("n").alias("n_ref"),
        F.max("m").alias("count"),
        F.max(gap).alias("ks"),
        F.greatest(F.lit(0.0), F.sum(between + left + right)).alias("wasserstein"),
        F.max("mean").alias("mean"),
        spread.alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count(F.lit(1)).alias("distinct"),
        F.min(F.struct(-F.col("k"), "value"))["value"].alias("most_common"),
        *[quantile(q).alias(name) for name, q in levels.items()],
    )


def category_facts(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, period, categories, js_distance, chi_square) of the categories' shares against the reference.

    Categories that a period lacks need no rows: together they have one minus the reference's share of those
    that it has, and each adds to both statistics in proportion to its share.
    """
    counts = checkpointed(long_of(rows, cols, "string").where(F.col("value").isNotNull()).groupBy("column", "value", "period").agg(F.count(F.lit(1)).alias("k")))
    known = counts.where(F.col("period") == REFERENCE)
    totals = known.groupBy("column").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_known"))
    own = counts.where(F.col("period") != REFERENCE).withColumn("m", F.sum("k").over(Window.partitionBy("column", "period")))  # at most a period's rows
    both = own.join(known.select("column", "value", F.col("k").alias("k_ref")), ["column", "value"], "left").join(totals, "column", "left")
    p, q = F.coalesce(F.col("k_ref") / F.col("n"), F.lit(0.0)), F.col("k") / F.col("m")
    mid, expected = (p + q) / 2, p * F.col("m")
    part = lambda x: F.when(x > 0, x * F.ln(x / mid)).otherwise(0.0)
    lacking = 1 - F.sum(p)
    return both.groupBy("column", "period").agg(
        (F.coalesce(F.max("n_known"), F.lit(0)) + F.count_if(F.col("k_ref").isNull())).alias("categories"),
        F.when(F.max("n").isNotNull(), F.sqrt(F.greatest(F.lit(0.0), (F.sum(part(p) + part(q)) + F.ln(F.lit(2.0)) * lacking) / 2))).alias("js_distance"),
        F.when(F.max("n").isNotNull(), F.coalesce(F.sum(F.when(expected > 0, F.pow(F.col("k") - expected, 2) / F.nullif(expected, F.lit(0.0)))), F.lit(0.0)) + F.max("m") * lacking).alias("chi_square"),
    )


def lines(df: DataFrame, metrics: dict[str, Sequence[str]], column: Column | None = None) -> DataFrame:
    """(period, section, column, metric, value) rows of the columns named for each section."""
    pairs = [F.struct(F.lit(section).alias("section"), F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value")) for section, names in metrics.items() for m in names]
    named = df.select("period", (F.lit(None).cast("string") if column is None else column).alias("column"), F.inline(F.array(*pairs)))
    return named.select("period", "section", "column", "metric", "value")


def dataset_facts(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    plus = lambda xs: reduce(lambda a, b: a + b, xs)
    facts = rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(cols)).alias("n_columns"),
        plus([F.count_if(F.col(c).isNull()) for c in cols]).alias("n_missing_cells"),
        plus([is_constant(c).cast("int") for c in cols]).alias("n_constant_columns"),
        plus([(F.count(c) == 0).cast("int") for c in cols]).alias("n_empty_columns"),
    )
    groups = rows.select("period", row_digest(rows.select(*cols)).alias("_digest")).groupBy("period", "_digest").agg((F.count(F.lit(1)) - 1).alias("_more"))
    return facts.join(groups.groupBy("period").agg(F.sum("_more").alias("n_duplicated_rows")), "period")


def period_reports(
    reference: DataFrame,
    current: DataFrame,
    *,
    order: Sequence[str],
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    text: Sequence[str] = (),
    target: str,
    prediction: str,
    score: str | None = None,
    size: int = 500,
    qs: Sequence[float] = (0.05, 0.95),
    small: bool = False,
) -> DataFrame:
    """(period, section, column, metric, value) of all periods, and of the reference (-1) where that has a meaning.

    Sections: ``summary`` of the data set; ``drift`` of each column and of the data set (``small``: by p-values of
    the Kolmogorov-Smirnov test, otherwise by Wasserstein distance over the reference's deviation; categories
    by Jensen-Shannon distance); ``columns`` and ``quantiles`` of numeric columns, of the descriptors of
    texts, of target, prediction and score; ``quality``, ``confusion`` and ``balance`` of the classes. A period
    without known values of a column has no drift of it. Values that are unknown are no rows.
    """
    roles = [target, prediction]
    given = list(dict.fromkeys([*numeric, *categorical, *text, *roles, *([score] if score else [])]))
    base = numbered(reference, current, given, order, size)
    rows, descriptors = described(base, text)
    numbers = list(dict.fromkeys([*numeric, *descriptors, *roles, *([score] if score else [])]))
    sweep = swept(rows, numbers)
    facts = checkpointed(numeric_facts(sweep, qs))
    parts = [lines(dataset_facts(base, given), {"summary": ["n_rows", "n_columns", "n_missing_cells", "n_constant_columns", "n_empty_columns", "n_duplicated_rows"]})]
    # columns, quantiles, and the drift of numbers and descriptors
    column, drifting = F.col("column"), F.col("column").isin(*numeric, *descriptors)
    devs = rows.where(F.col("period") == REFERENCE).agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in numbers]).unpivot([], numbers, "column", "ref_std")
    p_value = ks_p_value(F.col("ks"), F.col("n_ref"), F.col("count"))
    moved = facts.join(devs, "column", "left").withColumns({"distance": F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(STD_FLOOR)), "p_value": p_value})
    drifted = F.col("p_value") < P_THRESHOLD if small else F.col("distance") >= DISTANCE_THRESHOLD
    tests = {"ks": F.col("ks"), "p_value": F.col("p_value"), "wasserstein": F.col("wasserstein"), "distance": F.col("distance"), "drifted": drifted.cast("double")}
    moved = moved.withColumns({name: F.when(drifting, value) for name, value in tests.items()})
    summary = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "distinct", "most_common"]
    parts.append(lines(moved, {"columns": summary, "quantiles": [f"quantile_{q:.2f}" for q in qs], "drift": list(tests)}, column))
    missing = rows.groupBy("period").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numbers]).unpivot(["period"], numbers, "column", "missing")
    parts.append(lines(missing.where(F.col("period") != REFERENCE), {"columns": ["missing"]}, column))
    # drift of categories and of the data set
    kinds = category_facts(rows, list(dict.fromkeys([*categorical, *roles]))).withColumn("drifted", (F.col("js_distance") >= DISTANCE_THRESHOLD).cast("double"))
    parts.append(lines(kinds, {"drift": ["categories", "js_distance", "chi_square", "drifted"]}, column))
    # the descriptors of a text are facts about it, not columns of the data set
    flags = moved.where(column.isin(*numeric)).select("period", "drifted").unionByName(kinds.select("period", "drifted")).where(F.col("drifted").isNotNull())
    whole = flags.groupBy("period").agg(F.sum("drifted").alias("n_drifted"), F.avg("drifted").alias("drift_share"), (F.avg("drifted") >= SHARE_THRESHOLD).cast("double").alias("data_drift_detected"))
    parts.append(lines(whole, {"drift": ["n_drifted", "drift_share", "data_drift_detected"]}))
    # classes
    labelled = base.where(F.col(target).isNotNull() & F.col(prediction).isNotNull())
    if score:
        quality = classification_scores(labelled, y=target, yhat=prediction, score=score, by=["period"])
    else:
        quality = classification_scores(labelled.withColumn("_score", F.lit(None).cast("double")), y=target, yhat=prediction, score="_score", by=["period"])
    parts.append(lines(quality, {"quality": ["accuracy", "precision", "recall", "f1", "log_loss", "auc", "n"]}))
    parts.append(lines(confusion_counts(labelled, y=target, yhat=prediction, by=["period"]), {"confusion": ["tn", "fp", "fn", "tp"]}))
    for c in roles:
        shares = class_distribution(base.where(F.col(c).isNotNull()), c, by=["period"])
        parts.append(shares.select("period", F.lit("balance").alias("section"), F.lit(c).alias("column"), F.concat(F.lit("share_"), F.col(c).cast("string")).alias("metric"), F.col("share").alias("value")))
    return reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())
