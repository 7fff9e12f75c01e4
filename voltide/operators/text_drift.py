"""Drift of a text column: how well its words tell the current rows from the reference rows.

The classifier is linear in the words that a text holds: each word's weight is the logarithm of how much more often it
stands in current rows than in reference rows (naive Bayes over presence, counts raised by one). It is
learned by one count of words over all training rows and applied by one join with a limited list, so it needs no
iterations, no sample and no driver. The score is the exact AUC on the rows held out.

A fifth of the rows is held out, by a digest of the key, or of the text where there is no key: any type of key will do, no
row is left out, and equal keys of both sides fall on the same side of the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.functions.text import tokenize
from voltide.operators.metrics import roc_auc

# With fewer rows than this the AUC must beat 95 % of random scores, otherwise the limit.
FEW_ROWS, LIMIT, DRAWS, PERCENTILE = 1000, 0.55, 1000, 0.95
#: Words with a weight, the most frequent ones: the size of the broadcast list.
TERMS = 1 << 14
HELD_OUT = 5


def text_drift_rows(reference: DataFrame, current: DataFrame, *, text: str, key: str | None = None) -> DataFrame:
    """(id, t, is_current, held_out, words) of all rows: digests of key and text, and the distinct words."""
    body = F.col(text).cast("string")
    name = body if key is None else F.coalesce(F.col(key).cast("string"), body)
    digest = F.md5(F.coalesce(name, F.lit("")))
    side = lambda df, flag: df.select(
        digest.alias("id"),
        F.md5(F.coalesce(body, F.lit(""))).alias("t"),
        F.lit(flag).alias("is_current"),
        (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % HELD_OUT == 0).alias("held_out"),
        F.array_distinct(F.coalesce(tokenize(body), F.array().cast("array<string>"))).alias("words"),
    )
    return side(reference, 0).unionByName(side(current, 1))


def word_weights(train: DataFrame, terms: int = TERMS) -> DataFrame:
    """(term, weight) of the ``terms`` most frequent words of the training rows."""
    now = F.col("is_current").cast("bigint")
    sizes = train.agg(F.struct(F.sum(1 - now).alias("ref"), F.sum(now).alias("cur"))).scalar()
    counts = train.select("is_current", F.explode("words").alias("term")).groupBy("term").agg(F.sum(1 - now).alias("ref"), F.sum(now).alias("cur"))
    top = counts.orderBy(F.desc(F.col("ref") + F.col("cur")), "term").limit(terms).withColumn("_n", sizes)
    share = lambda side: F.ln((F.col(side) + 1.0) / (F.col(f"_n.{side}") + 2))
    return top.select("term", (share("cur") - share("ref")).alias("weight"))


def word_scores(held: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, t, is_current, copies, score): equal rows are one row with its number."""
    # the empty token is no word; it stands for the row itself
    tokens = held.select("id", "t", "is_current", F.explode(F.concat(F.array(F.lit("")), "words")).alias("term"))
    # at most TERMS rows
    joined = tokens.join(F.broadcast(weights), "term", "left")
    sums = joined.groupBy("id", "t", "is_current").agg(F.count_if(F.col("term") == "").alias("copies"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("_sum"))
    # rounded, so that the order of addition makes no ranks
    return sums.select("id", "t", "is_current", "copies", F.round(F.col("_sum") / F.col("copies"), 9).alias("score"))


def random_limit(held: DataFrame, n: Column, draws: int = DRAWS) -> Column:
    """The AUC that ``PERCENTILE`` of random scores of the held-out rows stay below, as a scalar subquery. With
    ``FEW_ROWS`` rows or more it is null, and no row is drawn."""
    few = held.where(n < FEW_ROWS).select("id", "t", "is_current", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
    drawn = few.withColumn("u", F.md5(F.concat_ws("|", F.col("draw").cast("string"), "id", "t", F.col("is_current").cast("string"))))
    return roc_auc(drawn, y="is_current", score="u", by=["draw"]).agg(F.percentile("auc", F.lit(PERCENTILE))).scalar()


def text_drift(reference: DataFrame, current: DataFrame, *, text: str, key: str | None = None, terms: int = TERMS, draws: int = DRAWS) -> DataFrame:
    """(column, n_train, n_test, auc, threshold, drifted). Without held-out rows of both sides the AUC is unknown."""
    rows = text_drift_rows(reference, current, text=text, key=key)
    held, train = rows.where("held_out"), rows.where("not held_out")
    sizes = rows.agg(F.count_if(~F.col("held_out")).alias("n_train"), F.count_if("held_out").alias("n_test"))
    scores = word_scores(held, word_weights(train, terms))
    auc = roc_auc(scores, y="is_current", score="score", copies="copies").scalar()
    n = rows.agg(F.count(F.lit(1))).scalar()
    limit = F.coalesce(random_limit(held, n, draws), F.lit(LIMIT))
    return sizes.select(F.lit(text).alias("column"), "n_train", "n_test", auc.alias("auc"), limit.alias("threshold")).withColumn("drifted", F.col("auc") > F.col("threshold"))
