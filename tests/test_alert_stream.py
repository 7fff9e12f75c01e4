"""The stateful alert stream against a plain walk and the batch runs: late rows, silence, restart."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from voltide.operators import alerts as B
from voltide.operators.joins import rule_table
from voltide.operators.ordering import scratch_path
from voltide.streaming import alerting as A
from voltide.streaming.jobs import read_stream

RULES = [("high", "m", "gt", 5.0, 120, "critical"), ("at_once", "m", "gt", 8.0, 0, "warning"), ("other", "n", "lt", 2.0, 60, "info")]
START = datetime(2024, 1, 1)
SCHEMA = "id bigint, ts timestamp_ntz, metric_name string, metric_value double"


def at(seconds):
    return START + timedelta(seconds=seconds)


def walk(events, upto, silence=600):
    """Transitions of (id, second, metric, value) events up to a second, in plain Python."""
    out = []
    for rule, metric, op, limit, hold, severity in RULES:
        started, n, firing, last, silent = None, 0, False, None, False
        rows = sorted((s, i, v) for i, s, m, v in events if m == metric and s is not None and s <= upto)
        for s, i, v in [*rows, (None, None, None)]:
            now = upto if s is None else s
            if last is not None and not silent and last + silence < now:
                out.append((rule, severity, "nodata", last + silence, started, n))
                silent = True
            if s is None:
                break
            if silent:
                out.append((rule, severity, "data", s, started, n))
                silent = False
            last = s
            if v is not None and (v > limit if op == "gt" else v < limit):
                if started is None:
                    started, n, firing = s, 0, False
                    if hold:
                        out.append((rule, severity, "pending", s, s, 1))
                n += 1
                if not firing and s - started >= hold:
                    firing = True
                    out.append((rule, severity, "firing", s, started, n))
            elif started is not None:
                out.append((rule, severity, "resolved" if firing else "inactive", s, started, n))
                started, n, firing = None, 0, False
    return sorted((r, v, t, at(a), None if s is None else at(s), n) for r, v, t, a, s, n in out)


def events(seed, n=300, first=0, step=40):
    rnd = random.Random(seed)
    out, s = [], first
    for i in range(n):
        s += rnd.choice([0, step, step, 3 * step, 20 * step if rnd.random() < 0.1 else step])
        out.append((i, s, rnd.choice("mmmn"), rnd.choice([1.0, 6.0, 9.0, 6.0, None])))
    return out


def add(spark, folder, rows):
    df = spark.createDataFrame([(i, None if s is None else at(s), m, v) for i, s, m, v in rows], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, target, **how):
    stream = read_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    path = A.run_alerts(A.alert_transitions(stream, rule_table(spark, RULES), **how), target=target)
    rows = spark.read.parquet(path).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "started")})
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0], r[1], r[2], r[3], str(r[4]), r[5]))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], str(r[4]), r[5]))


def test_restart_goes_on_and_late_rows_stay_out(spark):
    folder, target = scratch_path(spark, "in"), scratch_path(spark, "alerts")
    one = events(1)
    random.Random(2).shuffle(one)
    add(spark, folder, one)
    last = max(s for _, s, _, _ in one)
    assert run(spark, folder, target) == ordered(walk(one, last - 600))
    # the second part starts before the watermark's end, and holds rows that are too late
    two = [(1000 + i, s, m, v) for i, s, m, v in events(3, 100, first=last - 500)] + [(2000, None, "m", 9.0)]
    late = [(3000 + i, s, "m", 9.0) for i, s in enumerate(range(0, last - 700, 997))]
    add(spark, folder, two + late)
    end = max(s for _, s, _, _ in two if s is not None)
    assert run(spark, folder, target) == ordered(walk(one + two, end - 600))


def test_one_micro_batch_or_many(spark):
    rows = events(4, 200)
    folder, target = scratch_path(spark, "in"), scratch_path(spark, "alerts")
    for k in range(0, 200, 70):
        add(spark, folder, rows[k : k + 70])
        got = run(spark, folder, target, silence_seconds=300)
    assert got == ordered(walk(rows, rows[-1][1] - 600, 300))


def test_runs_are_those_of_the_batch(spark):
    rows = events(5, 250)
    folder = scratch_path(spark, "in")
    add(spark, folder, [*rows, (10_000, rows[-1][1] + 700, "m", 1.0), (10_001, rows[-1][1] + 700, "n", 3.0), (10_002, rows[-1][1] + 1400, "x", 1.0)])
    got = run(spark, folder, scratch_path(spark, "alerts"))
    batch = B.alert_state(spark.read.parquet(folder).where(F.col("metric_name") != "x"), rule_table(spark, RULES)).collect()
    firing = {(r[0], r[4]) for r in got if r[2] == "firing"}
    assert firing == {(r["rule"], r["started"]) for r in batch if r["state"] == "firing"}
    ended = {(r[0], r[4]): r[5] for r in got if r[2] in ("resolved", "inactive")}
    assert ended == {(r["rule"], r["started"]): r["n_values"] for r in batch}


def test_a_value_changes_the_state_alone():
    rule = A.Rule("info", 60_000_000)
    steps = [(0, True), (30, True), (60, True), (61, False), (62, False), (900, True)]
    seen = [[t[0] for t in rule.value(s * 1_000_000, b, 600_000_000)] for s, b in steps]
    assert seen == [["pending"], [], ["firing"], ["resolved"], [], ["nodata", "data", "pending"]]


@pytest.mark.parametrize("silent", [True, False])
def test_silence_is_told_once(silent):
    rule = A.Rule("info", 0, last=0)
    assert [t[:2] for t in rule.silence(11 if silent else 10, 10)] == ([("nodata", 10)] if silent else [])
    assert list(rule.silence(99 if silent else 10, 10)) == []
