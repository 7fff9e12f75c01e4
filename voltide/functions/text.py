"""Tokens, stop words, n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Word characters as Unicode letters, digits and underscore.
WORD = r"[\p{L}\p{N}_]+"
#: The production analyzer keeps words of two or more characters.
WORD2 = r"[\p{L}\p{N}_]{2,}"


def tokenize(col: str | Column, pattern: str = WORD) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(F.lower(col), F.lit(pattern), F.lit(0))


def remove_stopwords(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Drop the listed words, keeping repeats and order of the others."""
    if not stopwords:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def bigrams(tokens: Column, joiner: str = " ") -> Column:
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.size(tokens) - 1),
        F.slice(tokens, F.lit(2), F.size(tokens) - 1),
        lambda a, b: F.concat(a, F.lit(joiner), b),
    )
    return F.when(F.size(tokens) >= 2, pairs).otherwise(F.array().cast("array<string>"))


def ngrams(tokens: Column, sizes: tuple[int, int] = (1, 2), joiner: str = " ") -> Column:
    """Single words, then adjacent pairs, as ``sizes`` asks."""
    low, high = sizes
    if not 1 <= low <= high <= 2:
        raise ValueError("n-grams of 1 and 2 words are supported")
    if high == 1:
        return tokens
    return bigrams(tokens, joiner) if low == 2 else F.concat(tokens, bigrams(tokens, joiner))


def english_stopwords(spark: SparkSession) -> list[str]:
    """Spark ML's own English list."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("english")
