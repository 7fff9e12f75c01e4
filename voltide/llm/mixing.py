"""Mixing sources to target weights by weighted sampling without replacement.

A document's key is -ln(u) / weight (Efraimidis and Spirakis), u a number in (0, 1) from a digest of its id
and text: the same on every run, wherever the row lies. Better documents have larger weights and tend to
come first. Sources share a budget by weight; none gets more than ``cap`` times its size, and what it cannot
take goes to the others. That is one number: the largest level at which

    (budget - caps of the sources below) / (weights of the rest)

stands when sources are ordered by cap / weight, so prefix sums and one maximum replace the rounds of
sharing again. A source takes whole epochs while they fit into its target; the rest of the target goes to the
documents with the smallest keys, found by prefix sums within the source. The document on the border gives
its first words only, so a source misses its target by less than one word.

The texts are read once, for sizes and digests; only (id, source, size, key) is sorted. The order runs in
ranges of (source, key), so a source with a third of all rows is cut like any other.

* A null text has size 0, takes nothing and is returned with 0. A null source is a source, last in order.
* A null id is allowed. Rows with the same id, text and source are alike: some of them may be taken once more
  than others, and which of them is of no consequence. Ties of keys are settled by id and digest.
* An empty table gives no rows; sizes that are all 0 give targets of 0. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import table, written
from voltide.operators.ordering import row_index, running_sums

WORD = r"[^\x20\x09-\x0D]+"
#: Fixed by the contract: weights of the sources in order, repeating; share of all sizes; epochs at most.
WEIGHTS, BUDGET, CAP = (5, 2, 1), (3, 2), 2
#: Hex digits of the digest that make u.
DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the values alone."""
    digest = F.md5(F.concat_ws("\x1f", *parts))
    return (F.conv(F.substr(digest, F.lit(1), F.lit(DIGITS)), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def sized(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, size, digest, key) of each row. ``weights`` has (doc_id, quality_weight), one positive
    weight an id, 1 for others; it meets the rows after their texts have become sizes and digests."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.md5(text).alias("digest"))
    u = uniform(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("digest"))
    if weights is None:
        return rows.withColumn("key", -F.ln(u))
    known = weights.select("doc_id", F.col("quality_weight").cast("double").alias("_weight"))
    return rows.join(known, "doc_id", "left").select("doc_id", "source", "size", "digest", (-F.ln(u) / F.coalesce("_weight", F.lit(1.0))).alias("key"))


def targets(sources: DataFrame, *, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size); works for any number of sources."""
    named = sources.withColumn("_last", F.col("source").isNull())
    placed = row_index(named, order=["_last", "source"], out="_place")
    share = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int")).cast("bigint")
    shared = placed.select("source", "_last", "source_size", share.alias("w"), (F.col("source_size") * cap).alias("cap")).withColumn("_ratio", F.col("cap") / F.col("w"))
    shared = written(shared, "sources")
    summed = running_sums(shared, order=["_ratio", "_last", "source"], sums=["cap", "w", "source_size"])
    total = F.col("source_size_total") * F.lit(budget[0]) / F.lit(float(budget[1]))
    level = summed.agg(F.max((total - F.col("cap_before")) / (F.col("w_total") - F.col("w_before")))).scalar()
    return shared.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("w")).alias("target"))


def mix(docs: DataFrame, *, quality: DataFrame | None = None, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, cap: int = CAP) -> DataFrame:
    """doc_id, size, source_size, target, taken, and source, key of each row of ``docs``; ``quality`` as in ``sized``."""
    rows = written(sized(docs, quality), "sized")
    wanted = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights=weights, budget=budget, cap=cap)
    wanted = written(wanted, "targets").select(F.col("source").alias("_source"), "source_size", "target")
    ordered = running_sums(rows, by=["source"], order=["key", "doc_id", "digest", "size"], sums=["size"])
    both = ordered.join(wanted, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    epochs = F.least(F.coalesce(epochs, F.lit(0)), F.lit(cap))
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    more = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), rest - F.col("size_before")))
    return both.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + more).cast("bigint").alias("taken"), "source", "key")


def label_weights(labels: DataFrame, *, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """(doc_id, quality_weight) from labels (the best one of a document, if there are several); without a label it is 1."""
    best = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") >= 1, good).when(F.col("quality") < 1, bad).otherwise(1.0).alias("quality_weight"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = label_weights(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), quality=quality).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH best AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
docs AS (SELECT d.doc_id, d.source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest,
  CASE WHEN quality >= 1 THEN 2.0 WHEN quality < 1 THEN 0.5 ELSE 1.0 END AS weight FROM documents d LEFT JOIN best USING (doc_id)),
keyed AS (SELECT *, -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || digest), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) / CAST(weight AS DOUBLE) AS key FROM docs),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
placed AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sources),
leveled AS (SELECT *, sum(source_size) OVER () * 1.5 AS budget, coalesce(sum(2 * source_size) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS ws, sum(w) OVER () AS w_all
  FROM placed WINDOW o AS (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(2.0 * source_size, w * (SELECT max(CAST(budget - caps AS DOUBLE) / CAST(w_all - ws AS DOUBLE)) FROM leveled))::DOUBLE AS target FROM leveled),
ordered AS (SELECT k.*, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS e FROM ordered)
SELECT doc_id, size, source_size, target, CAST(e * size + greatest(0, least(size, floor(target - e * source_size) - before)) AS BIGINT) AS taken FROM epochs
"""
