"""Feature vectors, boosted trees, scoring, search and registry (no SQL form, small settings)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from voltide.catalog.inputs import STOP_SQL, STOPWORDS, preds, tall, target
from voltide.catalog.registry import cte, query, r6, table
from voltide.catalog.scores import ACC, F1, _auc_sql
from voltide.catalog.texts import W2
from voltide.operators import models as ML
from voltide.operators.ordering import scratch_path
from voltide.operators.registry import Registry

SMALL = dict(max_features=100, max_ngram=1, max_depth=3, n_estimators=5)


def headlines(spark, d):
    """Tall rows with two numeric features of the day."""
    days = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("date")).agg(F.avg("value").alias("day_mean"), F.stddev_samp("value").alias("day_std"))
    return tall(spark, d).join(days, "date", "left")


NUMERIC = ["day_mean", "day_std"]
HOW = dict(text="Headline", label="vol_up", numeric=NUMERIC, stopwords=STOPWORDS)


def _split(df):
    cut = F.lit("2024-01-20").cast("date")
    return df.where(F.col("date") <= cut), df.where(F.col("date") > cut)


def _fitted(spark, d):
    train, test = _split(headlines(spark, d))
    return ML.train_boosted_trees(train, **HOW, **SMALL), test


@query(
    f"""SELECT * FROM (WITH tw AS (SELECT doc_id, list_filter(regexp_extract_all(lower(Headline), '{W2}'), lambda x: x NOT IN ({STOP_SQL})) AS w FROM tall),
    tt AS (SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) >= 2 THEN list_transform(list_zip(w[1:len(w) - 1], w[2:len(w)]), lambda z: z[1] || ' ' || z[2]) ELSE [] END)) AS term FROM tw),
    tv AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS pos FROM (SELECT term, count(*) AS n FROM tt GROUP BY term ORDER BY n DESC, term LIMIT 100)),
    tc AS (SELECT doc_id, pos, count(*) AS tf FROM tt JOIN tv USING (term) GROUP BY 1, 2),
    weighed AS (SELECT doc_id, pos, tf * (ln((1.0 + (SELECT count(*) FROM tall)) / (1 + count(*) OVER (PARTITION BY pos))) + 1) AS w FROM tc),
    days AS (SELECT CAST(ts AS DATE) AS date, avg(value) AS day_mean, stddev_samp(value) AS day_std FROM events GROUP BY 1),
    numbers AS (SELECT doc_id, coalesce(day_mean, 0) AS m, coalesce(day_std, 0) AS s FROM tall LEFT JOIN days USING (date))
    SELECT doc_id, CAST(pos AS INTEGER) AS pos, round(value, 6) AS value FROM (
      SELECT doc_id, pos, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM weighed UNION ALL SELECT doc_id, 100, m FROM numbers UNION ALL SELECT doc_id, 101, s FROM numbers) WHERE value <> 0)""",
    "tall",
)
def assemble_features(spark, d):
    """All entries of the vectors: weights of the terms in the order of the vocabulary, then the numbers."""
    from pyspark.ml.functions import vector_to_array

    built = ML.assemble_features(headlines(spark, d), text="Headline", numeric=NUMERIC, max_features=100, stopwords=STOPWORDS)
    entries = built.select("doc_id", F.posexplode(vector_to_array("features")).alias("pos", "value"))
    return entries.where("value <> 0").withColumn("value", F.round("value", 6))


TEST_ROWS = "(SELECT doc_id, date, vol_up FROM tall WHERE date > DATE '2024-01-20')"


@query(f"SELECT doc_id, vol_up, true AS p_in_range, true AS class_fits, true AS confidence_fits, true AS text_fits FROM {TEST_ROWS}", "tall")
def score_headlines_checked(spark, d):
    """Each scored headline holds together: the class, confidence and text follow from the probability."""
    from voltide.functions.scalars import TEXT_DOWN, TEXT_UP

    model, test = _fitted(spark, d)
    p, cls = F.col("prediction_proba"), F.col("prediction_class")
    rows = ML.score_headlines(test, model, numeric=NUMERIC)
    return rows.select(
        "doc_id",
        "vol_up",
        ((p >= 0) & (p <= 1)).alias("p_in_range"),
        (cls == (p > 0.5).cast("int")).alias("class_fits"),
        (F.abs(F.col("confidence") - F.abs(p - 0.5) * 2) < 1e-9).alias("confidence_fits"),
        (F.col("interpretation") == F.when(cls == 1, TEXT_UP).otherwise(TEXT_DOWN)).alias("text_fits"),
    )


@query(
    f"SELECT date, count(*) AS num_headlines, arg_min(vol_up, doc_id) AS true_label, true AS mean_fits, true AS votes_fit, true AS max_fits FROM {TEST_ROWS} GROUP BY date",
    "tall",
)
def score_day_checked(spark, d):
    """Each daily vote equals what its own headline rows give."""
    model, test = _fitted(spark, d)
    daily, detailed = ML.score_days(test, model, day="date", label="vol_up", order="doc_id", version="1", asof=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), numeric=NUMERIC)
    own = detailed.groupBy("date").agg(F.avg("prediction_proba").alias("mean"), F.sum("prediction_class").alias("votes"), F.max("prediction_proba").alias("top"), F.count(F.lit(1)).alias("rows"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    both = daily.join(own, "date")
    return both.select(
        "date",
        "num_headlines",
        "true_label",
        near("prediction_mean_proba", "mean").alias("mean_fits"),
        (F.col("prediction_majority_vote") == (F.col("votes") * 2 >= F.col("rows")).cast("int")).alias("votes_fit"),
        near("prediction_max_proba", "top").alias("max_fits"),
    )


# One tree of depth one over one flag: its leaves are means of the labels, so the scores have a closed form in SQL.
EXACT = dict(text="Headline", label="vol_up", numeric=["flag"], stopwords=[])
STUMP = dict(max_features=5, max_ngram=1, max_depth=1, n_estimators=1)
cte("ex", "SELECT event_id, date, y AS vol_up, CASE WHEN event_id % 4 <> 0 THEN y ELSE 1 - y END AS flag, ts >= TIMESTAMP '2024-01-21' AS test FROM preds", "preds")
cte("ex_leaf", "SELECT flag, 1 / (1 + exp(-2 * avg(2.0 * vol_up - 1))) AS p FROM ex WHERE NOT test GROUP BY flag", "ex")
cte("ex_p", "SELECT event_id, date, vol_up, p, CAST(p > 0.5 AS INTEGER) AS yhat FROM ex JOIN ex_leaf USING (flag) WHERE test", "ex_leaf")
cte("ex_y", "SELECT vol_up AS y, yhat, p FROM ex_p", "ex_p")
cte("ex_daily", "SELECT arg_min(vol_up, event_id) AS y, avg(p) AS p FROM ex_p GROUP BY date", "ex_p")


def _exact_split(spark, d):
    flag = F.when(F.col("event_id") % 4 != 0, F.col("y")).otherwise(1 - F.col("y")).cast("double")
    rows = preds(spark, d).select("event_id", "ts", "date", F.lit("word").alias("Headline"), F.col("y").alias("vol_up"), flag.alias("flag"))
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    return rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)


def _exact_model(spark, d):
    train, test = _exact_split(spark, d)
    return ML.train_boosted_trees(train, **EXACT, **STUMP), test


@query("SELECT event_id, date, vol_up, round(p, 6) AS p FROM ex_p", "ex_p")
def attach_predictions_exact(spark, d):
    """Scores of a fitted model on the rows they belong to, by value."""
    model, test = _exact_model(spark, d)
    return r6(ML.probability(ML.fill_numeric(test, ["flag"]), model).select("event_id", "date", "vol_up", "p"))


def _text_sql() -> str:
    from voltide.functions.scalars import TEXT_DOWN, TEXT_UP

    up, down = (t.replace("'", "''") for t in (TEXT_UP, TEXT_DOWN))
    return f"CASE WHEN yhat = 1 THEN '{up}' ELSE '{down}' END"


@query(f"SELECT event_id, yhat AS prediction_class, round(p, 6) AS prediction_proba, round(abs(p - 0.5) * 2, 6) AS confidence, {_text_sql()} AS interpretation FROM ex_p", "ex_p")
def score_headlines_exact(spark, d):
    model, test = _exact_model(spark, d)
    return r6(ML.score_headlines(test, model, numeric=["flag"]).select("event_id", "prediction_class", "prediction_proba", "confidence", "interpretation"))


@query(
    """SELECT date, count(*) AS num_headlines, arg_min(vol_up, event_id) AS true_label, round(avg(p), 6) AS prediction_mean_proba, CAST(avg(p) > 0.5 AS INTEGER) AS prediction_mean_class,
      CAST(sum(yhat) >= count(*) / 2.0 AS INTEGER) AS prediction_majority_vote, round(max(p), 6) AS prediction_max_proba, CAST(max(p) > 0.5 AS INTEGER) AS prediction_max_class, '3' AS model_version FROM ex_p GROUP BY date""",
    "ex_p",
)
def score_day_exact(spark, d):
    model, test = _exact_model(spark, d)
    daily, _ = ML.score_days(test, model, day="date", label="vol_up", order="event_id", version="3", asof=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), numeric=["flag"])
    return r6(daily.drop("prediction_timestamp"))


@query("SELECT pos, feature, importance FROM (VALUES (0, 'word', CAST(0 AS DOUBLE)), (1, 'flag', CAST(1 AS DOUBLE))) AS t(pos, feature, importance)")
def feature_importance_exact(spark, d):
    """A constant word explains nothing, the flag everything."""
    model, _ = _exact_model(spark, d)
    return ML.feature_importance(model, spark, numeric=["flag"])


@query("SELECT event_id, round(p, 6) AS p, CAST(2 AS BIGINT) AS version FROM ex_p", "ex_p")
def model_registry_exact(spark, d):
    """Two writers' versions, promotion of the better one, and scores of the model that the registry then names."""
    train, test = _exact_split(spark, d)
    registry, at = Registry(spark, scratch_path(spark, "registry")), datetime(2024, 2, 1)
    worse = ML.train_boosted_trees(train.withColumn("vol_up", 1 - F.col("vol_up")), **EXACT, **STUMP)
    for model, auc in ((worse, 0.53), (ML.refit_best(train, STUMP, **EXACT), 0.7)):
        version = registry.register("volatility", model, at=at, about={"auc": auc})
        registry.promote_if_better("volatility", version, at=at)
    loaded, version = registry.load("volatility")
    return r6(ML.probability(ML.fill_numeric(test, ["flag"]), loaded).select("event_id", "p", F.lit(version).cast("bigint").alias("version")))


@query(
    f"""SELECT CAST(0 AS BIGINT) AS trial, metric, round(value, 6) AS value FROM (
      SELECT 'headline_accuracy' AS metric, {ACC.replace('preds', 'ex_y')} AS value FROM ex_y UNION ALL SELECT 'headline_f1', {F1.replace('preds', 'ex_y')} FROM ex_y UNION ALL SELECT 'headline_auc', auc FROM ({_auc_sql('', 'ex_y')}) UNION ALL
      SELECT 'optimization_metric', auc FROM ({_auc_sql('', 'ex_daily')}))""",
    "ex_y",
    "ex_daily",
)
def trial_log_exact(spark, d):
    """The trial's headline scores and its objective, the AUC of the daily mean probability."""
    train, test = _exact_split(spark, d)
    _, log = ML.search_hyperparameters(train, test, [STUMP], day="date", order="event_id", **EXACT)
    return r6(log.where("metric like 'headline_%' or metric = 'optimization_metric'").select("trial", "metric", "value"))




@query()
def train_boosted_trees(spark, d):
    model, _ = _fitted(spark, d)
    return ML.feature_importance(model, spark, numeric=NUMERIC).where(F.col("importance") > 0)


@query()
def score_headlines(spark, d):
    model, test = _fitted(spark, d)
    return ML.score_headlines(test, model, numeric=NUMERIC).drop("Headline")


@query()
def attach_predictions(spark, d):
    """Score columns on the rows they belong to, without a join."""
    model, test = _fitted(spark, d)
    return ML.probability(ML.fill_numeric(test, NUMERIC), model).select("doc_id", "date", "vol_up", "p")


@query()
def score_day(spark, d):
    model, test = _fitted(spark, d)
    daily, _ = ML.score_days(test, model, day="date", label="vol_up", order="doc_id", version="1", asof=F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), numeric=NUMERIC)
    return daily


@query()
def search_hyperparameters(spark, d):
    train, val = _split(headlines(spark, d))
    train, val = ML.prepared(train), ML.prepared(val)
    tried = ML.grid_candidates(max_features=[50, 100], max_ngram=[1], max_depth=[2], n_estimators=[3])
    _, log = ML.search_hyperparameters(train, val, tried, day="date", order="doc_id", **HOW)
    train.unpersist()
    val.unpersist()
    return log


@query()
def trial_log(spark, d):
    """One trial of the search, kept as a table."""
    train, val = _split(headlines(spark, d))
    _, log = ML.search_hyperparameters(train, val, [dict(SMALL, n_estimators=3)], day="date", order="doc_id", **HOW)
    path = scratch_path(spark, "trials")
    log.write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query()
def refit_best(spark, d):
    train, val = _split(headlines(spark, d))
    model = ML.refit_best(train, dict(SMALL, n_estimators=3), **HOW)
    return ML.probability(ML.fill_numeric(val, NUMERIC), model).select("doc_id", "p")


@query()
def feature_importance(spark, d):
    model, _ = _fitted(spark, d)
    return ML.feature_importance(model, spark, numeric=NUMERIC)


@query(
    f"""SELECT CAST(row_number() OVER (ORDER BY n DESC, feature) - 1 AS INTEGER) AS pos, feature FROM (
      SELECT feature, count(*) AS n FROM (SELECT unnest(list_filter(regexp_extract_all(lower(Headline), '{W2}'), lambda x: x NOT IN ({STOP_SQL}))) AS feature FROM tall WHERE date <= DATE '2024-01-20')
      GROUP BY feature ORDER BY n DESC, feature LIMIT 100) UNION ALL SELECT 100, 'day_mean' UNION ALL SELECT 101, 'day_std'""",
    "tall",
)
def importance_zip(spark, d):
    """Names and weights of one fitted model zipped by position: the vocabulary, then the numbers."""
    model, _ = _fitted(spark, d)
    return ML.feature_importance(model, spark, numeric=NUMERIC).select("pos", "feature")


@query()
def top_k_importance(spark, d):
    model, _ = _fitted(spark, d)
    return ML.top_k_importance(ML.feature_importance(model, spark, numeric=NUMERIC), k=20)


@query()
def model_registry(spark, d):
    """Save a fitted model, register and promote it, and score with what the registry names."""
    model, test = _fitted(spark, d)
    base = scratch_path(spark, "models")
    model.write().overwrite().save(f"{base}/v1")
    model.write().overwrite().save(f"{base}/v2")
    entries = [(1, "Staging", 1), (1, "Production", 2), (2, "Staging", 3)]
    for version, stage, hour in entries:
        ML.register_model(spark, f"{base}/registry", name="volatility", version=version, stage=stage, path=f"{base}/v{version}", at=datetime(2024, 2, 1, hour))
    loaded, version = ML.load_registered(spark, f"{base}/registry", name="volatility")
    return ML.score_headlines(test, loaded, numeric=NUMERIC).select("doc_id", "prediction_class", F.lit(version).alias("version"))


@query()
def train_on_features(spark, d):
    """Class weights and leak-free price features go into the same trainer, without text weights of
    any size: the series name is the only word."""
    from voltide.operators.features import technical_features
    from voltide.operators.metrics import class_weights

    rows = technical_features(target(spark, d), lags=(1, 2), mas=(5,)).withColumn("Headline", F.col("series"))
    weights = class_weights(rows, y="vol_up").select(F.col("vol_up").alias("_c"), "weight")
    weighted = rows.join(F.broadcast(weights), F.col("vol_up") == F.col("_c")).drop("_c")
    numeric = [c for c in rows.columns if "_lag_" in c or "_ma_" in c]
    model = ML.train_boosted_trees(weighted, text="Headline", label="vol_up", numeric=numeric, weight="weight", stopwords=[], max_features=20, max_ngram=1, max_depth=3, n_estimators=3)
    return ML.feature_importance(model, spark, numeric=numeric)
