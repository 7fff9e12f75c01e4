"""Scalar functions: labels, confidence, calendar, keyword scores, status bands."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists and weights of the rule-based headline score.
UP_WORDS = ["rally", "surge", "soar", "boom", "growth", "rise", "gains", "breakthrough"]
DOWN_WORDS = ["crash", "plummet", "decline", "fall", "crisis", "recession", "drop", "fears"]
CALM_WORDS = ["maintain", "stable", "steady", "unchanged", "holds"]
SIMPLE_WORDS = ["surge", "crash", "soar", "plummet", "rally", "decline", "boom", "crisis"]
VOLATILE_WEIGHT = 0.15
CALM_WEIGHT = 0.1

# Texts of the two classes and of a failed prediction.
TEXT_UP = "Volatility likely to increase"
TEXT_DOWN = "Volatility likely to decrease"
TEXT_ERROR = "Error in prediction"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nonblank(col: str | Column) -> Column:
    """True for text with at least one non-space character (Unicode); null stays null."""
    return _c(col).rlike(r"(?U)\S")


def headline_length(col: str | Column) -> Column:
    return F.length(_c(col))


def word_count(col: str | Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(_c(col), F.lit(r"(?U)\S+"))


def class_threshold(p: str | Column, *, cut: float = 0.5, inclusive: bool = False) -> Column:
    """1 above the cut; ``inclusive`` also takes the cut itself. Null stays null."""
    p = _c(p)
    return (p >= cut if inclusive else p > cut).cast("int")


def confidence(p: str | Column) -> Column:
    return F.abs(_c(p) - 0.5) * 2


def confidence_band(p: str | Column, *, inclusive: bool = True) -> Column:
    """High outside [.3, .7], Medium outside [.4, .6], else Low; edges belong to the outer band
    when ``inclusive``."""
    p = _c(p)
    if inclusive:
        high, medium = (p >= 0.7) | (p <= 0.3), (p >= 0.6) | (p <= 0.4)
    else:
        high, medium = (p > 0.7) | (p < 0.3), (p > 0.6) | (p < 0.4)
    return F.when(high, "High").when(medium, "Medium").when(p.isNotNull(), "Low")


def interpretation(cls: str | Column) -> Column:
    return F.when(_c(cls) == 1, TEXT_UP).otherwise(TEXT_DOWN)


def _hits(text: Column, words: Sequence[str], weight: float) -> Column:
    return reduce(lambda a, b: a + b, [F.when(text.contains(w), F.lit(weight)).otherwise(0.0) for w in words])


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def keyword_score(col: str | Column) -> Column:
    """.5, +.15 per volatile word contained, -.1 per calm word, kept in [0, 1]."""
    text = F.lower(_c(col))
    score = F.lit(0.5) + _hits(text, UP_WORDS + DOWN_WORDS, VOLATILE_WEIGHT) - _hits(text, CALM_WORDS, CALM_WEIGHT)
    return F.when(text.isNotNull(), clamp(score, 0.0, 1.0))


def keyword_score_simple(col: str | Column) -> Column:
    text = F.lower(_c(col))
    return F.when(text.isNotNull(), clamp(F.lit(0.5) + _hits(text, SIMPLE_WORDS, VOLATILE_WEIGHT), 0.1, 0.9))


def day_of_week(date: str | Column) -> Column:
    """Monday = 0."""
    return F.weekday(_c(date))


def calendar_columns(date: str | Column) -> dict[str, Column]:
    date = _c(date)
    return {"dow": day_of_week(date), "month": F.month(date), "quarter": F.quarter(date)}


def one_hot_columns(date: str | Column) -> dict[str, Column]:
    """The fixed 23 columns dow_0..6, month_1..12, quarter_1..4."""
    parts = calendar_columns(date)
    ranges = {"dow": range(7), "month": range(1, 13), "quarter": range(1, 5)}
    return {f"{name}_{k}": (parts[name] == k).cast("int") for name, ks in ranges.items() for k in ks}


def parse_date(col: str | Column, fmt: str | None = None) -> Column:
    """Text to date, null when it does not parse."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("date") if fmt else _c(col).try_cast("date")


def day_text(col: str | Column) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def iso_text(ts: str | Column) -> Column:
    """ISO timestamp with microseconds."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since the epoch with their fraction; a zone-free timestamp is read as UTC."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, _c(ts).cast("timestamp_ntz")) / 1000


def daily_to_annual(days: int = 252) -> Column:
    """Square-root-of-time factor from daily to yearly volatility."""
    return F.sqrt(F.lit(float(days)))
