"""Text drift: any key, no row lost, exact AUC, a random limit for few rows, and its place in the other drift results."""

import hashlib
import math
import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from support import plan_of

from voltide.operators import drift as D
from voltide.operators import text_drift as T
from voltide.plans.monitor import monitoring_job


def texts(n, seed, extra):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(["oil", "bank", "rates", "Öl", "x1", *extra]) for _ in range(rnd.randint(0, 6))) if i % 9 else None for i in range(n)]


def frame(spark, values, keys=None, kind="bigint"):
    return spark.createDataFrame([(None if keys is None else keys[i], v) for i, v in enumerate(values)], f"k {kind}, t string")


def plain(ref, cur, keyed):
    """AUC and sizes in plain Python; rows are (key, text)."""
    import re

    rows = []
    for side, part in ((0, ref), (1, cur)):
        for k, t in part:
            digest = hashlib.md5((str(k) if keyed and k is not None else t or "").encode()).hexdigest()
            rows.append((int(digest[:8], 16) % 5 == 0, side, set(re.findall(r"\w+", (t or "").lower()))))
    train = [r for r in rows if not r[0]]
    n = Counter(r[1] for r in train)
    seen = Counter((w, r[1]) for r in train for w in r[2])
    weight = lambda w: math.log((seen[w, 1] + 1) / (n[1] + 2)) - math.log((seen[w, 0] + 1) / (n[0] + 2)) if seen[w, 0] + seen[w, 1] else 0.0
    scores = [(r[1], round(sum(map(weight, r[2])), 9)) for r in rows if r[0]]
    pos, neg = [s for y, s in scores if y], [s for y, s in scores if not y]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    return len(train), len(scores), wins / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("kind", ["none", "bigint", "string"])
def test_equals_plain_version_and_loses_no_row(spark, kind):
    ref, cur = texts(150, 1, ["calm"]), texts(140, 2, ["storm", "calm"])
    keys = {"none": None, "bigint": [10**15 + i * 10**14 if i % 11 else None for i in range(150)], "string": [f"id-{i}" if i % 11 else None for i in range(150)]}[kind]
    type_ = "string" if kind == "string" else "bigint"
    a, b = frame(spark, ref, keys, type_), frame(spark, cur, keys, type_)
    got = T.text_drift(a, b, text="t", key=None if kind == "none" else "k").first()
    key = lambda i: None if keys is None else keys[i]
    n_train, n_test, auc = plain([(key(i), t) for i, t in enumerate(ref)], [(key(i), t) for i, t in enumerate(cur)], kind != "none")
    assert (got.n_train, got.n_test) == (n_train, n_test) and n_train + n_test == 290
    assert got.auc == pytest.approx(auc)


def test_copies_count_each_time(spark):
    one = frame(spark, ["a b", "c", "d e f", None] * 30), frame(spark, ["a x", "c", "x"] * 40)
    got = T.text_drift(*one, text="t").first()
    _, _, auc = plain([(None, t) for t in ["a b", "c", "d e f", None] * 30], [(None, t) for t in ["a x", "c", "x"] * 40], False)
    assert got.n_train + got.n_test == 240 and (got.auc == pytest.approx(auc) if auc is not None else got.auc is None)


def test_few_rows_must_beat_random_scores(spark):
    a, b = frame(spark, texts(120, 3, []), list(range(120))), frame(spark, texts(120, 4, []), list(range(200, 320)))
    few = T.text_drift(a, b, text="t", key="k").first()
    # 52 held-out rows: one in twenty random scores reaches .64, which the fixed limit would call drift
    assert 0.6 < few.threshold < 0.7 and few.drifted == (few.auc > few.threshold)
    many = T.text_drift(frame(spark, texts(700, 3, []), list(range(700))), frame(spark, texts(700, 4, ["new"]), list(range(700))), text="t", key="k").first()
    assert many.threshold == 0.55 and many.drifted
    assert T.text_drift(a, b.where("false"), text="t", key="k").first().auc is None
    assert T.text_drift(a.where("false"), b.where("false"), text="t").first().n_test == 0


def test_no_text_is_shuffled_whole(spark):
    plan = plan_of(T.text_drift(frame(spark, texts(50, 5, [])), frame(spark, texts(50, 6, [])), text="t"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_text_counts_in_column_and_data_set_drift(spark):
    a = frame(spark, texts(600, 7, ["calm"]), list(range(600))).withColumn("x", F.col("k") % 10)
    b = frame(spark, texts(600, 8, ["storm"] * 3), list(range(600))).withColumn("x", F.col("k") % 10)
    columns = D.column_drift(a, b, numeric=["x"], text=["t"], key="k")
    assert {(r.column, r.test, r.drifted) for r in columns.collect()} == {("x", "wasserstein", False), ("t", "text_auc", True)}
    whole = D.dataset_drift(columns).first()
    assert (whole.n_columns, whole.n_drifted, whole.data_drift_detected) == (2, 1, True)


def test_monitoring_job_sees_the_text_column(spark, tmp_path):
    def side(n, seed, extra, month):
        rows = [(date(2024, month, 1 + i % 5), i, t, i % 2, (i // 2) % 2, 0.3 + 0.4 * (i % 2), "ab"[i % 2]) for i, t in enumerate(texts(n, seed, extra))]
        return spark.createDataFrame(rows, "date date, id int, t string, y int, yhat int, p double, c string")

    ref, cur = side(600, 9, ["calm"], 1), side(600, 10, ["storm"] * 3, 3)
    how = dict(numeric=["p"], categorical=["c"], y="y", yhat="yhat", score="p", asof=F.lit("2024-04-01 00:00:00").cast("timestamp_ntz"), run="r")
    without = monitoring_job(ref, cur, cur, metrics_path=str(tmp_path / "a"), **how).first()
    with_text = monitoring_job(ref, cur, cur, metrics_path=str(tmp_path / "b"), text=["t"], key="id", **how).first()
    assert without.key_metrics.drift_share == 0.0 and with_text.key_metrics.drift_share == pytest.approx(1 / 3)
