"""Training, scoring and model bookkeeping on Spark ML."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.functions.scalars import TEXT_ERROR, class_threshold, confidence, interpretation
from voltide.functions.text import WORD2
from voltide.operators.metrics import headline_metrics, roc_auc, vote_method_metrics
from voltide.operators.ordering import shared_dir
from voltide.operators.text_features import vocabulary
from voltide.operators.votes import daily_vote

# The search space (choices, then uniform ranges).
CHOICES = {
    "max_features": [500, 800, 1000, 1500],
    "max_ngram": [1, 2],
    "max_depth": [3, 4, 5, 6, 7],
    "n_estimators": [50, 100, 150, 200],
}
RANGES = {"learning_rate": (0.01, 0.3), "subsample": (0.6, 1.0), "colsample": (0.6, 1.0)}
# Parameters of the default classifier.
DEFAULTS = {"max_features": 1000, "max_ngram": 2, "max_depth": 6, "n_estimators": 100, "learning_rate": 0.1, "subsample": 1.0, "colsample": 1.0}


def word_stages(*, text: str, stopwords: Sequence[str] | None = None) -> list:
    remover = StopWordsRemover(inputCol="_tokens", outputCol="words")
    if stopwords is not None:
        remover = remover.setStopWords(list(stopwords))
    return [RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORD2, gaps=False, toLowercase=True), remover]


def term_stages(max_ngram: int) -> list:
    """Words, or words and adjacent pairs, as column ``_terms``."""
    if max_ngram == 1:
        return [SQLTransformer(statement="SELECT *, words AS _terms FROM __THIS__")]
    return [
        NGram(n=2, inputCol="words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(words, _pairs) AS _terms FROM __THIS__"),
    ]


class TextCounts:
    """Term counts of the training rows over the ``max_features`` most frequent terms, with their IDF weights.

    The vocabulary is the engine's own (pairs of rare words never cross the network, ties are settled) and
    ordered by frequency: its first k terms are the vocabulary of a smaller model, so candidates with fewer terms read
    slices of these counts and no text. The counts are persisted with the ``keep`` columns; the caller lets them go.
    """

    def __init__(self, df: DataFrame, *, text: str, max_features: int, max_ngram: int, stopwords: Sequence[str] | None = None, keep: Sequence[str] = ()):
        wording = word_stages(text=text, stopwords=stopwords)
        words = PipelineModel(stages=wording).transform(df.select(text)).select("words")
        self.terms = [r["term"] for r in vocabulary(words, sizes=(1, max_ngram), joiner=" ", max_features=max_features).collect()] or [""]
        self.stages = [*wording, *term_stages(max_ngram)]
        self.counts = prepared(self.counted(df, keep))
        # Spark's IDF lacks the + 1 of the weights
        self.weights = IDF(inputCol="_counts", outputCol="_idf").fit(self.counts).idf.toArray() + 1.0

    def counted(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The counts of other rows over the same terms."""
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_counts")
        return PipelineModel(stages=[*self.stages, counter]).transform(df).select("_counts", *keep)

    def weighing(self, k: int | None = None) -> PipelineModel:
        """Counts to tf * (idf + 1) of unit length, over the first ``k`` terms."""
        k = min(k or len(self.terms), len(self.terms))
        cut = VectorSlicer(inputCol="_counts", outputCol="_first", indices=list(range(k)))
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.weights[:k]), inputCol="_first", outputCol="_weighted")
        return PipelineModel(stages=[cut, weigh, Normalizer(p=2.0, inputCol="_weighted", outputCol="_text")])

    def vectors(self) -> PipelineModel:
        """From text to unit vectors, as it is saved with a model."""
        counter = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol="_counts")
        weigh = ElementwiseProduct(scalingVec=Vectors.dense(self.weights), inputCol="_counts", outputCol="_weighted")
        return PipelineModel(stages=[*self.stages, counter, weigh, Normalizer(p=2.0, inputCol="_weighted", outputCol="_text")])


def assembler(numeric: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=["_text", *numeric], outputCol="features", handleInvalid="keep")


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(s.vocabulary for s in model.stages if hasattr(s, "vocabulary"))


def fill_numeric(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Trees here have no default direction for missing values: they become 0."""
    return df.fillna(0.0, subset=list(numeric)) if numeric else df


def train_boosted_trees(
    df: DataFrame,
    *,
    text: str,
    label: str,
    numeric: Sequence[str] = (),
    weight: str | None = None,
    stopwords: Sequence[str] | None = None,
    seed: int = 42,
    **params,
) -> PipelineModel:
    """Text and numeric features into gradient-boosted trees with log loss, as one saved pipeline."""
    shared_dir(df.sparkSession)  # boosting checkpoints its residuals there every ten trees
    p = {**DEFAULTS, **params}
    kept = [label, *numeric, *([weight] if weight else [])]
    texts = TextCounts(fill_numeric(df, numeric), text=text, max_features=int(p["max_features"]), max_ngram=int(p["max_ngram"]), stopwords=stopwords, keep=kept)
    matrix = assembler(numeric)
    try:
        rows = matrix.transform(texts.weighing().transform(texts.counts)).select("features", label, *([weight] if weight else []))
        fitted = tree_learner(p, label=label, weight=weight, seed=seed).fit(rows)
    finally:
        texts.counts.unpersist()
    return PipelineModel(stages=[*texts.vectors().stages, matrix, fitted])


def tree_learner(p: dict, *, label: str, weight: str | None = None, seed: int = 42) -> GBTClassifier:
    trees = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        maxDepth=int(p["max_depth"]),
        maxIter=int(p["n_estimators"]),
        stepSize=float(p["learning_rate"]),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy=str(float(p["colsample"])) if float(p["colsample"]) < 1 else "all",
        lossType="logistic",
        seed=seed,
        maxMemoryInMB=512,
    )
    return trees.setWeightCol(weight) if weight else trees


def assemble_features(df: DataFrame, *, text: str, numeric: Sequence[str] = (), max_features: int = 1000, max_ngram: int = 2, stopwords: Sequence[str] | None = None) -> DataFrame:
    """The feature vector (text weights, then the numeric columns) as column ``features``."""
    rows = fill_numeric(df, numeric)
    texts = TextCounts(rows, text=text, max_features=max_features, max_ngram=max_ngram, stopwords=stopwords)
    texts.counts.unpersist()
    built = PipelineModel(stages=[*texts.vectors().stages, assembler(numeric)]).transform(rows)
    return built.select(*rows.columns, "features")


def probability(df: DataFrame, model: PipelineModel) -> DataFrame:
    """The rows with probability ``p`` of class 1; the prediction stays on its row, no join."""
    scored = model.transform(df).withColumn("p", vector_to_array("probability")[1])
    return scored.select(*df.columns, "p")


def with_response(df: DataFrame, p: str = "p") -> DataFrame:
    """Class, confidence and text of a score; a missing score becomes the error row."""
    failed = F.col(p).isNull()
    return df.withColumns(
        {
            "prediction_class": F.coalesce(class_threshold(p), F.lit(0)),
            "prediction_proba": F.coalesce(F.col(p), F.lit(0.5)),
            "confidence": F.coalesce(confidence(p), F.lit(0.0)),
            "interpretation": F.when(failed, TEXT_ERROR).otherwise(interpretation(class_threshold(p))),
            "error": F.when(failed, "no score"),
        }
    )


def score_headlines(df: DataFrame, model: PipelineModel, *, numeric: Sequence[str] = ()) -> DataFrame:
    return with_response(probability(fill_numeric(df, numeric), model)).drop("p")


def score_days(df: DataFrame, model: PipelineModel, *, day: str, label: str, order: str, version: str, asof: Column, numeric: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(daily votes with metadata, detailed rows with the features) for all days of ``df`` at once."""
    detailed = score_headlines(df, model, numeric=numeric)
    daily = daily_vote(detailed, day=day, proba="prediction_proba", pred="prediction_class", label=label, order=order)
    stamped = daily.withColumns({"model_version": F.lit(version), "prediction_timestamp": asof})
    return stamped, detailed.withColumn("model_version", F.lit(version))


def draw_candidates(n: int, *, seed: int = 42) -> list[dict]:
    """Seeded random draws from the search space."""
    rng = random.Random(seed)
    draw = lambda: {**{k: rng.choice(v) for k, v in CHOICES.items()}, **{k: rng.uniform(*r) for k, r in RANGES.items()}}
    return [draw() for _ in range(n)]


def grid_candidates(**lists: Sequence) -> list[dict]:
    return [dict(zip(lists, values)) for values in itertools.product(*lists.values())]


def trial_metrics(scored: DataFrame, *, label: str, day: str, order: str) -> DataFrame:
    """(metric, value) of scored validation rows: headline and daily scores."""
    rows = scored.withColumn("_yhat", class_threshold("p")).select(day, label, order, "p", "_yhat")
    daily = daily_vote(rows, day=day, pred="_yhat", label=label, order=order)
    headline = headline_metrics(rows, y=label, yhat="_yhat").select(F.concat(F.lit("headline_"), "metric").alias("metric"), "value")
    per_method = vote_method_metrics(daily).unpivot(["method"], ["accuracy", "f1", "auc"], "metric", "value")
    days = per_method.select(F.concat_ws("_", F.lit("daily"), "method", "metric").alias("metric"), "value")
    return headline.unionByName(days).where(F.col("value").isNotNull())


class SharedTexts:
    """Training and validation rows of a search as term counts, tokenised once for each n-gram range of the candidates."""

    def __init__(self, train: DataFrame, val: DataFrame, candidates: Sequence[dict], *, text: str, label: str, day: str, order: str, numeric: Sequence[str], stopwords: Sequence[str] | None):
        self.label, self.day, self.order, self.numeric = label, day, order, list(numeric)
        shared_dir(train.sparkSession)
        most: dict[int, int] = {}
        for c in candidates:
            p = {**DEFAULTS, **c}
            most[int(p["max_ngram"])] = max(most.get(int(p["max_ngram"]), 0), int(p["max_features"]))
        self.sides = {}
        for ngram, k in most.items():
            texts = TextCounts(fill_numeric(train, numeric), text=text, max_features=k, max_ngram=ngram, stopwords=stopwords, keep=[label, *numeric])
            self.sides[ngram] = (texts, prepared(texts.counted(fill_numeric(val, numeric), [day, label, order, *numeric])))

    def evaluate(self, params: dict) -> DataFrame:
        """The trial rows of one candidate: its terms are the first of the shared ones."""
        p = {**DEFAULTS, **params}
        texts, checked = self.sides[int(p["max_ngram"])]
        weigh, matrix = texts.weighing(int(p["max_features"])), assembler(self.numeric)
        model = tree_learner(p, label=self.label).fit(matrix.transform(weigh.transform(texts.counts)).select("features", self.label))
        scored = model.transform(matrix.transform(weigh.transform(checked))).withColumn("p", vector_to_array("probability")[1])
        return trial_metrics(scored, label=self.label, day=self.day, order=self.order)

    def release(self) -> None:
        for texts, checked in self.sides.values():
            texts.counts.unpersist()
            checked.unpersist()


def search_hyperparameters(
    train: DataFrame,
    val: DataFrame,
    candidates: Iterable[dict],
    *,
    text: str,
    label: str,
    day: str,
    order: str,
    numeric: Sequence[str] = (),
    stopwords: Sequence[str] | None = None,
    parallel: int = 2,
    halvings: int = 0,
) -> tuple[dict, DataFrame]:
    """Best parameters and the trial log (trial, params, metric, value).

    The texts are read once for all candidates: they share one matrix of term counts for each n-gram range and read
    the slice of their ``max_features``. Candidates run side by side as Spark jobs. With ``halvings`` all of them first
    get a part of their trees (a half for each halving), and the better half goes on with twice as many; the
    last round has all trees of those left. The log names the trees of each trial. A candidate's handful of
    metrics comes to the driver, as the choice between candidates is made there; a failed candidate scores 0 and its
    message is logged. Without any that succeeds the search fails.
    """
    spark, every = train.sparkSession, [{**c} for c in candidates]
    shared = SharedTexts(train, val, every, text=text, label=label, day=day, order=order, numeric=numeric, stopwords=stopwords)

    def attempt(item: tuple[int, dict]) -> list[tuple]:
        trial, params = item
        described = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
        try:
            rows = [(r["metric"], r["value"]) for r in shared.evaluate(params).collect()]
            auc = dict(rows).get("daily_mean_proba_auc", 0.0)
        except Exception as failure:  # noqa: BLE001 - a candidate may fail, the search goes on
            rows, auc = [(f"failed: {type(failure).__name__}: {str(failure)[:200]}", None)], 0.0
        return [(trial, described, m, v) for m, v in [*rows, ("optimization_metric", auc)]]

    log, left = [], list(enumerate(every))
    try:
        for lap in range(halvings, -1, -1):
            trees = {i: max(1, math.ceil(int({**DEFAULTS, **c}["n_estimators"]) / 2**lap)) for i, c in left}
            with ThreadPoolExecutor(parallel) as pool:
                found = [row for rows in pool.map(attempt, [(i, {**c, "n_estimators": trees[i]} if lap else c) for i, c in left]) for row in rows]
            log += found
            if found and all(m.startswith("failed: ") or m == "optimization_metric" for _, _, m, _ in found):
                raise RuntimeError("no candidate succeeded: " + next(m for _, _, m, _ in found))
            objective = {t: v for t, _, m, v in found if m == "optimization_metric"}
            left.sort(key=lambda item: (-objective[item[0]], item[0]))
            if lap:
                left = sorted(left[: math.ceil(len(left) / 2)])
    finally:
        shared.release()
    return left[0][1], spark.createDataFrame(log, "trial bigint, params string, metric string, value double")


def refit_best(train: DataFrame, params: dict, **how) -> PipelineModel:
    return train_boosted_trees(train, **how, **params)


def feature_importance(model: PipelineModel, spark: SparkSession, *, numeric: Sequence[str] = ()) -> DataFrame:
    """(pos, feature, importance) of a fitted pipeline: as many rows as features."""
    from voltide.operators.joins import importance_zip

    names = vocabulary_of(model) + list(numeric)
    weights = model.stages[-1].featureImportances.toArray().tolist()
    pair = spark.createDataFrame([(names, weights)], "names array<string>, weights array<double>")
    return importance_zip(pair, names="names", values="weights")


def top_k_importance(importance: DataFrame, *, k: int = 20, among: Sequence[str] | None = None) -> DataFrame:
    kept = importance.where(F.col("feature").isin(*among)) if among else importance
    return kept.orderBy(F.desc("importance"), "feature").limit(k)


REGISTRY_SCHEMA = "name string, version bigint, stage string, path string, registered_at timestamp_ntz"


def register_model(spark: SparkSession, registry: str, *, name: str, version: int, stage: str, path: str, at) -> None:
    """Append one row to the registry table; promotion is a newer row."""
    spark.createDataFrame([(name, version, stage, path, at)], REGISTRY_SCHEMA).write.mode("append").parquet(registry)


def model_registry(registry: DataFrame, *, name: str, stages: Sequence[str] = ("Production", "Staging")) -> DataFrame:
    """The model to load: the first stage of the list that has one, its latest version.

    A version's current stage is that of its newest row.
    """
    now = registry.where(F.col("name") == name).groupBy("name", "version").agg(F.max_by(F.struct("stage", "path"), "registered_at").alias("_now"))
    rank = F.array_position(F.array(*[F.lit(s) for s in stages]), F.col("_now.stage"))
    placed = now.select("name", "version", F.col("_now.stage").alias("stage"), F.col("_now.path").alias("path"), rank.alias("_rank")).where(F.col("_rank") > 0)
    return placed.orderBy("_rank", F.desc("version")).limit(1).drop("_rank")


def load_registered(spark: SparkSession, registry: str, *, name: str) -> tuple[PipelineModel, int]:
    row = model_registry(spark.read.parquet(registry), name=name).first()
    if row is None:
        raise LookupError(f"no Production or Staging version of {name}")
    return PipelineModel.load(row["path"]), row["version"]


def daily_auc(daily: DataFrame) -> DataFrame:
    """The search objective on its own."""
    return roc_auc(daily, y="true_label", score="prediction_mean_proba")


def prepared(df: DataFrame) -> DataFrame:
    """Training rows kept for the many passes of a search; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
