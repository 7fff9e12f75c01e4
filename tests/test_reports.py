"""The full period report: drift of many periods against pairwise computation, and odd inputs."""

import random

import pytest

from voltide.operators import reports as R

SCHEMA = "id int, x double, c string, t string, y int, yhat int, p double"


def frame(spark, n, seed, shift=0.0, empty=0.1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = None if rnd.random() < empty else round(rnd.gauss(shift, 1), 1)
        rows.append((i, x, rnd.choice(["a", "b", "c", None]), rnd.choice(["up 1%", "", None, "down"]), rnd.randint(0, 1), rnd.randint(0, 1), round(rnd.random(), 2)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def distance(a, b):
    """Wasserstein distance and largest gap of two samples."""
    points = sorted({*a, *b})
    cdf = lambda s, v: sum(u <= v for u in s) / len(s)
    area = sum(abs(cdf(a, v) - cdf(b, v)) * (w - v) for v, w in zip(points, points[1:]))
    return area, max(abs(cdf(a, v) - cdf(b, v)) for v in points)


HOW = dict(order=["id"], numeric=["x"], categorical=["c"], text=["t"], target="y", prediction="yhat", score="p")


@pytest.mark.parametrize("seed, size", [(1, 7), (2, 25), (3, 1)])
def test_numeric_drift_of_each_period(spark, many_chunks, seed, size):
    ref, ref_df = frame(spark, 60, seed)
    cur, cur_df = frame(spark, 50, seed + 100, 0.7)
    got = {(r.period, r.section, r.column, r.metric): r.value for r in R.period_reports(ref_df, cur_df, size=size, **HOW).collect()}
    base = [r[1] for r in ref if r[1] is not None]
    for period in range((len(cur) + size - 1) // size):
        own = [r[1] for r in cur[period * size : (period + 1) * size] if r[1] is not None]
        if not own:
            assert (period, "drift", "x", "ks") not in got
            continue
        area, gap = distance(base, own)
        assert got[period, "drift", "x", "wasserstein"] == pytest.approx(area, abs=1e-9)
        assert got[period, "drift", "x", "ks"] == pytest.approx(gap)
        assert got[period, "columns", "x", "count"] == len(own)
        assert got[period, "columns", "x", "missing"] == len(cur[period * size : (period + 1) * size]) - len(own)
        assert got[period, "columns", "x", "distinct"] == len(set(own))
        own = sorted(own)
        at = (len(own) - 1) * 0.95
        low = int(at)
        assert got[period, "quantiles", "x", "quantile_0.95"] == pytest.approx(own[low] + (at - low) * (own[min(low + 1, len(own) - 1)] - own[low]))


def test_sections_and_reference(spark):
    _, ref = frame(spark, 40, 5)
    _, cur = frame(spark, 40, 6)
    rows = R.period_reports(ref, cur, size=20, **HOW).collect()
    keys = {(r.period, r.section, r.column, r.metric) for r in rows}
    assert len(keys) == len(rows) and {r.period for r in rows} == {-1, 0, 1}
    assert {r.section for r in rows} == {"summary", "drift", "columns", "quantiles", "quality", "confusion", "balance"}
    assert {r.section for r in rows if r.period == -1} == {"summary", "quality", "confusion", "balance"}
    assert (0, "drift", "t_length", "ks") in keys and (1, "columns", "t_non_letter_share", "p50") in keys
    # descriptors are no columns of the data set
    assert {r.value for r in rows if r.metric == "n_columns"} == {6}
    share = {r.period: r.value for r in rows if r.metric == "drift_share"}
    flags = [r for r in rows if r.section == "drift" and r.metric == "drifted" and r.column in ("x", "c", "y", "yhat")]
    for period in (0, 1):
        assert share[period] == pytest.approx(sum(r.value for r in flags if r.period == period) / 4)


def test_odd_inputs(spark):
    _, ref = frame(spark, 30, 7)
    none = spark.createDataFrame([], SCHEMA)
    assert {r.period for r in R.period_reports(ref, none, **HOW).collect()} == {-1}
    unknown = spark.createDataFrame([(i, None, None, None, None, None, None) for i in range(3)], SCHEMA)
    got = {(r.section, r.column, r.metric): r.value for r in R.period_reports(ref, unknown, **HOW).where("period = 0").collect()}
    assert got["summary", None, "n_missing_cells"] == 18 and got["columns", "x", "missing"] == 3
    assert got["summary", None, "n_duplicated_rows"] == 2 and not any(s == "drift" for s, _, _ in got)
    # a category that the reference lacks, and one class only
    new = spark.createDataFrame([(i, 1.0, "new", "a", 1, 1, 0.5) for i in range(4)], SCHEMA)
    got = {(r.section, r.column, r.metric): r.value for r in R.period_reports(ref, new, small=True, **HOW).where("period = 0").collect()}
    assert got["drift", "c", "js_distance"] == pytest.approx(0.8325546111576977) and got["drift", "c", "drifted"] == 1.0
    assert ("quality", None, "auc") not in got and got["balance", "y", "share_1"] == 1.0
    without = R.period_reports(ref, new, **{**HOW, "score": None, "text": []}).where("metric = 'accuracy' and period = 0").collect()
    assert [r.value for r in without] == [1.0]
