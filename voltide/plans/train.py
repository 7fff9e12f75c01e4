"""Training job: search on the validation split, refit, evaluate, save, register as staging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from voltide.operators import models as ML
from voltide.operators.metrics import evaluate_test
from voltide.operators.ordering import checkpointed


def training_job(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    *,
    text: str,
    label: str,
    day: str,
    order: str,
    numeric: Sequence[str],
    candidates: Iterable[dict],
    model_path: str,
    registry: str,
    name: str,
    version: int,
    at: datetime,
    stopwords: Sequence[str] | None = None,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, trial log, test metrics)."""
    how = dict(text=text, label=label, numeric=numeric, stopwords=stopwords)
    kept, checked = ML.prepared(train), ML.prepared(val)
    try:
        best, log = ML.search_hyperparameters(kept, checked, candidates, day=day, order=order, **how)
        model = ML.refit_best(kept, best, **how)
    finally:
        kept.unpersist()
        checked.unpersist()
    scored = checkpointed(ML.probability(ML.fill_numeric(test, numeric), model).select(day, order, label, "p"))
    metrics = evaluate_test(scored, day=day, y=label, proba="p", order=order)
    model.write().overwrite().save(model_path)
    ML.register_model(train.sparkSession, registry, name=name, version=version, stage="Staging", path=model_path, at=at)
    return model, log, metrics
