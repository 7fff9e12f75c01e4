"""From headline probabilities to one prediction per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.functions.scalars import class_threshold, nonblank


def daily_vote(
    df: DataFrame,
    *,
    day: str | Sequence[str] = "date",
    proba: str = "p",
    pred: str | None = None,
    label: str | None = None,
    order: str | None = None,
    tie_up: bool = True,
    inclusive: bool = False,
    cut: float = 0.5,
) -> DataFrame:
    """Mean, majority and maximum vote per day in one map-side-combining aggregate.

    ``tie_up`` counts an even vote as 1; ``inclusive`` puts a probability equal to the cut in
    class 1; ``order`` names the unique key that says which label of the day is the first.
    """
    keys = [day] if isinstance(day, str) else list(day)
    votes = F.col(pred) if pred else class_threshold(proba, cut=cut, inclusive=inclusive)
    aggs = [
        F.avg(proba).alias("prediction_mean_proba"),
        F.sum(votes).alias("_votes"),
        F.max(proba).alias("prediction_max_proba"),
        F.count(F.lit(1)).alias("num_headlines"),
    ]
    if label is not None:
        if order is None:
            raise ValueError("a label needs an order that says which one of the day is the first")
        aggs.insert(0, F.min_by(label, order).alias("true_label"))
    agg = df.groupBy(*keys).agg(*aggs)
    half = F.col("num_headlines") / 2
    majority = F.col("_votes") >= half if tie_up else F.col("_votes") > half
    return agg.select(
        *keys,
        *(["true_label"] if label is not None else []),
        "prediction_mean_proba",
        class_threshold("prediction_mean_proba", cut=cut, inclusive=inclusive).alias("prediction_mean_class"),
        majority.cast("int").alias("prediction_majority_vote"),
        "prediction_max_proba",
        class_threshold("prediction_max_proba", cut=cut, inclusive=inclusive).alias("prediction_max_class"),
        "num_headlines",
    )


def daily_vote_empty(calendar: DataFrame, votes: DataFrame, *, day: str = "date") -> DataFrame:
    """One row per calendar day; a day without headlines gets n = 0, probability .5, classes 0 and
    an error text."""
    joined = calendar.select(day).join(votes, day, "left")
    empty = F.col("num_headlines").isNull()
    defaults = {"num_headlines": 0, "prediction_mean_proba": 0.5, "prediction_mean_class": 0, "prediction_majority_vote": 0, "prediction_max_proba": 0.5, "prediction_max_class": 0}
    filled = joined.withColumn("error", F.when(empty, "No headlines provided"))
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def day_calendar(df: DataFrame, *, date: str, out: str = "date", ahead: int = 0) -> DataFrame:
    """Every day from the first date to ``ahead`` days after the last."""
    span = df.agg(F.min(date).alias("lo"), F.date_add(F.max(date), ahead).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(out))


def api_vote(df: DataFrame, *, group: str, proba: str = "p", digits: int = 4) -> DataFrame:
    """The batch endpoint's rules: classes at >= .5, strict majority, class of the first maximum,
    probabilities rounded. The class is a function of the probability, so the class of the first
    maximum is that of the maximum, whichever headline holds it."""
    agg = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("headlines_count"),
        F.avg(proba).alias("_mean"),
        F.sum(class_threshold(proba, inclusive=True)).alias("_votes"),
        F.max(proba).alias("_max"),
    )
    return agg.select(
        group,
        "headlines_count",
        F.round("_mean", digits).alias("mean_probability"),
        class_threshold("_mean", inclusive=True).alias("mean_prediction"),
        (F.col("_votes") > F.col("headlines_count") / 2).cast("int").alias("majority_vote"),
        class_threshold("_max", inclusive=True).alias("max_prob_class"),
        F.round("_max", digits).alias("max_prob_value"),
    )


def individual_rows(df: DataFrame, *, group: str, proba: str = "p", pos: str, digits: int = 4) -> DataFrame:
    """One row per headline of a request: its position, class and rounded probability. No shuffle, for requests of any
    length."""
    return df.select(group, pos, class_threshold(proba, inclusive=True).alias("prediction"), F.round(proba, digits).alias("probability"))


def individual_arrays(df: DataFrame, *, group: str, proba: str = "p", pos: str, digits: int = 4) -> DataFrame:
    """The classes and rounded probabilities of a request in order of position: one row and one array for each request, as
    the answer to it is one message. Where a group is no message but a day or more, ``individual_rows`` gives the same
    values without bringing them together."""
    items = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(proba).alias("p"))))
    return df.groupBy(group).agg(items.alias("_items")).select(
        group,
        F.transform("_items", lambda x: class_threshold(x["p"], inclusive=True)).alias("individual_predictions"),
        F.transform("_items", lambda x: F.round(x["p"], digits)).alias("individual_probabilities"),
    )


def agreement_rate(df: DataFrame, *, left: str, right: str, out: str = "agreement_rate") -> DataFrame:
    return df.agg(F.avg((F.col(left) == F.col(right)).cast("double")).alias(out))


def group_mean_by_date(df: DataFrame, *, date: str, value: str, out: str = "mean_value") -> DataFrame:
    return df.groupBy(date).agg(F.avg(value).alias(out))


def collect_day_headlines(wide: DataFrame, *, ids: Sequence[str], slots: Sequence[str]) -> DataFrame:
    """The list of a day's non-blank headlines in slot order, built inside the wide row: no
    shuffle, and never longer than the number of slots."""
    texts = F.filter(F.array(*[F.col(s) for s in slots]), nonblank)
    return wide.select(*ids, texts.alias("headlines"))
