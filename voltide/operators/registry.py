"""Model registry on the shared file system: versions and stage changes that two writers cannot mix up.

A version is a file that can be created once, so two writers at a time get two numbers. The stages of a model are
a numbered log of changes, and a change is one more file: it states what the writer believed to be in the stage,
and only one writer can create the next number. Who loses reads the log again; if the stage then holds
something else than expected, the change is refused and the caller is told what holds it now.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from voltide.sources.put_once import numbered, put_if_absent, records

ANY = object()


class LostPromotion(RuntimeError):
    """Somebody else changed the stage first."""


class Registry:
    """The models below ``root``. Reading lists a folder of small files; a model has as many as versions and changes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str, kind: str) -> str:
        return f"{self.root}/{name}/{kind}"

    def model_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/models/{version}"

    def versions(self, name: str) -> dict[int, dict]:
        return records(self.spark, self._folder(name, "versions"))

    def stages(self, name: str) -> dict[int, str]:
        """The current stage of each version that has one."""
        held: dict[int, str] = {}
        for _, change in sorted(records(self.spark, self._folder(name, "stages")).items()):
            if change["replaced"] is not None and held.get(change["replaced"]) == change["stage"]:
                held[change["replaced"]] = "Archived"
            held[change["version"]] = change["stage"]
        return held

    def holder(self, name: str, stage: str) -> int | None:
        """The version in a stage (the newest, if a caller put several there)."""
        return max((v for v, s in self.stages(name).items() if s == stage), default=None)

    def register(self, name: str, model: PipelineModel | None = None, *, path: str | None = None, at: datetime, about: dict | None = None) -> int:
        """A new version; the model is saved under its number. The number is taken before the model is saved, and the
        version counts once a stage names it, so a writer that dies in between leaves a number and no model."""
        n = max(self.versions(name), default=0) + 1
        while True:
            where = path or self.model_path(name, n)
            if put_if_absent(self.spark, numbered(self._folder(name, "versions"), n), {"version": n, "path": where, "at": at, "about": about or {}}):
                break
            n += 1
        if model is not None:
            model.write().overwrite().save(where)
        return n

    def move(self, name: str, version: int, stage: str, *, at: datetime, expected: object = ANY) -> None:
        """Put a version into a stage. What was there is archived if the stage is Production or ``expected`` names it.

        ``expected`` is the version that the caller believes to be in the stage (None: nobody); if another is there, also
        because of a change made meanwhile, ``LostPromotion`` tells which.
        """
        if version not in self.versions(name):
            raise LookupError(f"{name} has no version {version}")
        while True:
            log = records(self.spark, self._folder(name, "stages"))
            now = self.holder(name, stage)
            if expected is not ANY and now != expected:
                raise LostPromotion(f"{name}: {stage} holds version {now}, not {expected}")
            replaced = now if now != version and (stage == "Production" or expected is not ANY) else None
            change = {"version": version, "stage": stage, "replaced": replaced, "at": at}
            if put_if_absent(self.spark, numbered(self._folder(name, "stages"), max(log, default=0) + 1), change):
                return

    def promote_if_better(self, name: str, version: int, *, metric: str = "auc", least: float = 0.52, at: datetime) -> bool:
        """To Production if the metric noted at registration reaches ``least`` and beats the current holder's."""
        known = self.versions(name)
        now = self.holder(name, "Production")
        score = known[version]["about"].get(metric)
        held = known[now]["about"].get(metric) if now is not None else None
        if score is None or score < least or (held is not None and score <= held):
            return False
        self.move(name, version, "Production", at=at, expected=now)
        return True

    def current(self, name: str, stages: Sequence[str] = ("Production", "Staging")) -> tuple[int, str]:
        """(version, path) of the first stage that holds one."""
        for stage in stages:
            version = self.holder(name, stage)
            if version is not None:
                return version, self.versions(name)[version]["path"]
        raise LookupError(f"no {' or '.join(stages)} version of {name}")

    def load(self, name: str, stages: Sequence[str] = ("Production", "Staging")) -> tuple[PipelineModel, int]:
        version, path = self.current(name, stages)
        return PipelineModel.load(path), version

    def table(self, name: str) -> DataFrame:
        """(version, stage, path, about) of all versions; as many rows as there are versions."""
        held = self.stages(name)
        rows = [(v, held.get(v), r["path"], {k: str(x) for k, x in r["about"].items()}) for v, r in sorted(self.versions(name).items())]
        return self.spark.createDataFrame(rows, "version bigint, stage string, path string, about map<string,string>")
