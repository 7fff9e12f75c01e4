"""Versions and promotions with several writers, and a stream that follows the registry."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, SQLTransformer, Tokenizer
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import functions as F
from support import rows

from voltide.operators.ordering import scratch_path
from voltide.operators.registry import LostPromotion, Registry
from voltide.sources.put_once import put_if_absent, records
from voltide.streaming import scoring as S
from voltide.streaming.jobs import read_stream, score_rows

AT = datetime(2024, 2, 1)


@pytest.fixture
def registry(spark):
    return Registry(spark, scratch_path(spark, "registry"))


def test_first_writer_wins_whole(spark):
    path = scratch_path(spark, "once") + "/0000000001.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, {"who": i}), range(16)))
    assert sum(won) == 1
    folder = path.rsplit("/", 1)[0]
    assert records(spark, folder) == {1: {"who": won.index(True)}}


def test_writers_at_once_get_their_own_versions(registry):
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda i: registry.register("m", path=f"p{i}", at=AT), range(12)))
    assert sorted(got) == list(range(1, 13))
    assert {r["path"] for r in registry.versions("m").values()} == {f"p{i}" for i in range(12)}


def test_promotion_is_compare_and_set(registry):
    for i in range(3):
        registry.register("m", path=f"p{i}", at=AT)
    registry.move("m", 1, "Production", at=AT, expected=None)
    registry.move("m", 2, "Production", at=AT, expected=1)
    with pytest.raises(LostPromotion, match="holds version 2, not 1"):
        registry.move("m", 3, "Production", at=AT, expected=1)
    assert registry.current("m") == (2, "p1")
    assert {r.version: r.stage for r in registry.table("m").collect()} == {1: "Archived", 2: "Production", 3: None}
    with pytest.raises(LookupError):
        registry.move("m", 9, "Staging", at=AT)


def test_only_one_of_many_promotions_is_won(registry):
    for i in range(8):
        registry.register("m", path=f"p{i}", at=AT)

    def attempt(version):
        try:
            registry.move("m", version, "Production", at=AT, expected=None)
            return True
        except LostPromotion:
            return False

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(attempt, range(1, 9)))
    assert sum(won) == 1 and registry.holder("m", "Production") == won.index(True) + 1


def test_staging_serves_until_production_is_there(registry):
    with pytest.raises(LookupError):
        registry.current("m")
    registry.register("m", path="a", at=AT, about={"auc": 0.6})
    registry.register("m", path="b", at=AT, about={"auc": 0.55})
    registry.register("m", path="c", at=AT, about={"auc": 0.5})
    registry.move("m", 1, "Staging", at=AT)
    registry.move("m", 2, "Staging", at=AT)
    assert registry.current("m") == (2, "b")
    assert registry.promote_if_better("m", 2, at=AT) and registry.promote_if_better("m", 1, at=AT)
    assert not registry.promote_if_better("m", 3, at=AT) and not registry.promote_if_better("m", 2, at=AT)
    assert registry.current("m") == (1, "a")


def fitted(spark, good):
    """A small pipeline: texts with the word are of class 1."""
    data = spark.createDataFrame([(f"{good} news {i % 3}", 1) if i % 2 else (f"other news {i % 3}", 0) for i in range(40)], "t string, y int")
    filled = SQLTransformer(statement="SELECT *, coalesce(t, '') AS _t FROM __THIS__")
    return Pipeline(stages=[filled, Tokenizer(inputCol="_t", outputCol="_w"), HashingTF(inputCol="_w", outputCol="features", numFeatures=64), LogisticRegression(labelCol="y", maxIter=5)]).fit(data)


def add(spark, folder, ids):
    texts = ["up news 1", "down news 2", "other news 0", None]
    spark.createDataFrame([(i, texts[i % 4]) for i in ids], "id int, t string").coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return read_stream(spark, folder, spark.createDataFrame([], "id int, t string").schema, max_files=1)


def test_version_switch_between_micro_batches(spark, registry):
    folder, target = scratch_path(spark, "in"), scratch_path(spark, "scored")
    models = [fitted(spark, "up"), fitted(spark, "down")]
    for m in models:
        registry.register("m", m, at=AT)
    registry.move("m", 1, "Production", at=AT)
    scorer = S.RegisteredScorer(registry, "m", target, text="t", keep=["id"])
    add(spark, folder, range(0, 8))
    add(spark, folder, range(8, 16))
    S.score_stream(stream(spark, folder), scorer).awaitTermination()
    assert scorer.loads == 1  # two batches, one load
    registry.move("m", 2, "Production", at=AT, expected=1)
    add(spark, folder, range(16, 24))
    S.score_stream(stream(spark, folder), scorer).awaitTermination()
    assert scorer.loads == 2
    everything = spark.read.parquet(folder)
    want = []
    for model, part, version in ((models[0], everything.where("id < 16"), "1"), (models[1], everything.where("id >= 16"), "2")):
        want += rows(score_rows(part, text="t", model=model, version=version).drop("t"))
    assert rows(S.scored(scorer).drop("batch")) == sorted(want, key=repr)


def test_killed_batch_replaces_itself_with_its_own_version(spark, registry):
    folder, target = scratch_path(spark, "in"), scratch_path(spark, "scored")
    for word in ("up", "down"):
        registry.register("m", fitted(spark, word), at=AT)
    registry.move("m", 1, "Production", at=AT)
    add(spark, folder, range(8))

    class Dies(S.RegisteredScorer):
        def __call__(self, batch, batch_id):
            super().__call__(batch, batch_id)
            raise RuntimeError("killed after the write, before the commit")

    how = dict(text="t", keep=["id"])
    with pytest.raises(Exception, match="killed"):
        S.score_stream(stream(spark, folder), Dies(registry, "m", target, **how)).awaitTermination()
    # the version changes, and the batch that had begun keeps its own
    registry.move("m", 2, "Production", at=AT, expected=1)
    scorer = S.RegisteredScorer(registry, "m", target, **how)
    add(spark, folder, range(8, 12))
    S.score_stream(stream(spark, folder), scorer).awaitTermination()
    got = S.scored(scorer)
    assert sorted(r.id for r in got.collect()) == list(range(12))
    assert {(r.batch, r.model_version) for r in got.collect()} == {(0, "1"), (1, "2")}
    assert PipelineModel.load(registry.current("m")[1]) is not None and got.where(F.col("prediction_class").isNull()).count() == 0
