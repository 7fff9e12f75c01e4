"""Alert rules over a stream of metric values, with a state per rule.

A rule is quiet, pending or firing, as its runs of consecutive breaches say; and it has no data after a silence.
Values arrive out of order. They wait in the rule's state, packed, until the watermark has passed
them, and are then walked in order of time and key; a value that comes later than the watermark allows has
been dropped by Spark. One event-time timer per rule wakes it for the next waiting value or the end of the
allowed silence, so rules also change while no value comes.

The stream needs Spark's RocksDB state store, which ``run_alerts`` sets for its query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from voltide.operators.joins import compare
from voltide.streaming.jobs import event_time, run_available

TRANSITIONS = "rule string, severity string, transition string, at timestamp, started timestamp, n_values bigint"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WAITING = np.dtype([("at", "<i8"), ("key", "<i8"), ("breach", "?")])


class Rule:
    """What a rule knows: its severity and hold time, the current run, and the last value's time. Times are microseconds."""

    FIELDS = "severity string, hold bigint, started bigint, n bigint, firing boolean, last bigint, silent boolean"

    def __init__(self, severity, hold, started=None, n=0, firing=False, last=None, silent=False):
        self.severity, self.hold, self.started, self.n, self.firing, self.last, self.silent = severity, hold, started, n, firing, last, silent

    def values(self) -> tuple:
        return (self.severity, self.hold, self.started, self.n, self.firing, self.last, self.silent)

    def silence(self, upto: int, allowed: int) -> Iterator[tuple]:
        """The rule has no data from the end of the allowed silence on, if that lies before ``upto``."""
        if self.last is not None and not self.silent and self.last + allowed < upto:
            self.silent = True
            yield ("nodata", self.last + allowed, self.started, self.n)

    def value(self, at: int, breach: bool, allowed: int) -> Iterator[tuple]:
        """The transitions that one value causes."""
        yield from self.silence(at, allowed)
        if self.silent:
            self.silent = False
            yield ("data", at, self.started, self.n)
        self.last = at
        if breach:
            if self.started is None:
                self.started, self.n, self.firing = at, 0, False
                if self.hold > 0:
                    yield ("pending", at, at, 1)
            self.n += 1
            if not self.firing and at - self.started >= self.hold:
                self.firing = True
                yield ("firing", at, self.started, self.n)
        elif self.started is not None:
            yield ("resolved" if self.firing else "inactive", at, self.started, self.n)
            self.started, self.n, self.firing = None, 0, False


class AlertProcessor(StatefulProcessor):
    def __init__(self, silence_seconds: int):
        self.allowed = silence_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rule = handle.getValueState("rule", Rule.FIELDS)
        self.waiting = handle.getListState("waiting", "packed binary")

    def handleInputRows(self, key, rows, timerValues):
        rule, packs = self._rule(), []
        for batch in rows:
            if rule is None and len(batch):
                rule = Rule(batch["severity"].iloc[0], int(batch["hold"].iloc[0]))
            pack = np.zeros(len(batch), WAITING)
            for name in WAITING.names:
                pack[name] = batch[name].to_numpy()
            packs.append(pack)
        yield from self._walk(key, rule, packs, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._walk(key, self._rule(), [], timerValues)

    def close(self) -> None:
        pass

    def _rule(self):
        return Rule(*self.rule.get()) if self.rule.exists() else None

    def _walk(self, key, rule, packs, timers) -> Iterator[pd.DataFrame]:
        """Values up to the watermark change the rule, the others wait."""
        mark = timers.getCurrentWatermarkInMs() * 1000
        held = [np.frombuffer(p, WAITING) for (p,) in self.waiting.get()] if self.waiting.exists() else []
        rows = np.concatenate([*held, *packs]) if held or packs else np.zeros(0, WAITING)
        rows = rows[np.lexsort((rows["key"], rows["at"]))]
        ready = int(np.searchsorted(rows["at"], mark, side="right"))
        out = [t for row in rows[:ready].tolist() for t in rule.value(row[0], row[2], self.allowed)]
        out += rule.silence(mark, self.allowed)
        left = rows[ready:]
        if len(left):
            self.waiting.put([(left.tobytes(),)])
        else:
            self.waiting.clear()
        self.rule.update(rule.values())
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        wake = [int(left["at"][0])] if len(left) else []
        if rule.last is not None and not rule.silent:
            wake.append(rule.last + self.allowed + 1)
        if wake:
            self.handle.registerTimer(max(min(wake) // 1000 + 1, timers.getCurrentWatermarkInMs() + 1))
        if out:
            time = lambda us: pd.to_datetime(pd.array(us, dtype="Int64"), unit="us")
            yield pd.DataFrame(
                {"rule": key[0], "severity": rule.severity, "transition": [t[0] for t in out], "at": time([t[1] for t in out]), "started": time([t[2] for t in out]), "n_values": [t[3] for t in out]}
            )


def alert_transitions(stream: DataFrame, rules: DataFrame, *, name: str = "metric_name", value: str = "metric_value", ts: str = "ts", key: str = "id", delay: str = "10 minutes", silence_seconds: int = 600) -> DataFrame:
    """Transitions of each rule (append mode): ``pending``, ``firing``, ``resolved`` (after firing), ``inactive`` (after
    pending), ``nodata`` after ``silence_seconds`` without a value and ``data`` with the next one.

    A rule's values are walked by one task, in order, because each state follows from the one before; they weigh 17
    bytes each while they wait. ``rules`` is the short list of a caller; ``for_seconds`` of 0 fires with the first breach. A value that is unknown
    breaks no rule. ``n_values`` counts the breaches of the run so far.
    """
    rows = event_time(stream, ts).withWatermark(ts, delay)
    joined = rows.where(F.col(ts).isNotNull()).select(F.col(name).alias("_name"), F.col(value).alias("_value"), ts, key).join(F.broadcast(rules), F.col("_name") == F.col("metric"), "inner")
    breach = F.coalesce(compare(F.col("op"), F.col("_value"), F.col("threshold")), F.lit(False))
    judged = joined.select("rule", "severity", (F.col("for_seconds") * 1_000_000).cast("bigint").alias("hold"), F.unix_micros(ts).alias("at"), F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"), breach.alias("breach"), ts)
    return judged.groupBy("rule").transformWithStateInPandas(AlertProcessor(silence_seconds), outputStructType=TRANSITIONS, outputMode="Append", timeMode="EventTime")


def run_alerts(transitions: DataFrame, *, target: str | None = None) -> str:
    """Run the stream over what its source holds now; a later call with the same ``target`` goes on from there."""
    spark = transitions.sparkSession
    option = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(option)
    spark.conf.set(option, STATE_STORE)
    try:
        return run_available(transitions, "alerts", target=target)
    finally:
        spark.conf.set(option, before)
