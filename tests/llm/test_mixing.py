"""Source mixing against a plain version of the sharing rule and of the sampling."""

import random
import re

import pytest
from pyspark.sql import functions as F

from voltide.llm import mixing
from voltide.llm.common import table

SCHEMA = "doc_id bigint, text string, source string"


def shared(sizes, weights=(5, 2, 1), budget=1.5, cap=2):
    """Targets by rounds of sharing again; ``sizes`` by source in order."""
    want = {s: 0.0 for s in sizes}
    open_ = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    left = budget * sum(sizes.values())
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w >= cap * sizes[s]]
        if not full:
            want.update({s: level * w for s, w in open_.items()})
            break
        for s in full:
            want[s] = cap * sizes[s]
            left -= want[s]
            del open_[s]
    return want


def rows_of(seed, n=400, sources=9):
    rnd = random.Random(seed)
    names = [None, "", *(f"s{i}" for i in range(sources - 2))]
    rows = [(i, " ".join(["w"] * rnd.randint(0, 60)), names[min(int(rnd.expovariate(0.5)), sources - 1)]) for i in range(n)]
    rows += [(1000, None, "s1"), (None, "a b c", "s2"), (None, "a b c", "s2"), (7, "x y", "s0"), (7, "x y", "s0"), (8, "\t\n", "empty")]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_epochs(spark, many_chunks, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("target", F.lit("extra")).withColumn("_place", F.lit(1))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in sorted(rows, key=lambda r: (r[2] is None, r[2] or "")):
        sizes[source] = sizes.get(source, 0) + len(re.findall(mixing.WORD, text or ""))
    want = shared(sizes)
    by = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    for source, rs in by.items():
        assert want[source] - 1 < sum(r["taken"] for r in rs) <= want[source] + 1e-6
        # whole epochs first; then the smallest keys, and one document at the border in part
        epochs = int(want[source] // sizes[source]) if sizes[source] else 0
        extra = [(r["key"], r["taken"] - epochs * r["size"], r["size"]) for r in rs if r["size"]]
        assert all(0 <= x <= s for _, x, s in extra)
        taken = sorted(k for k, x, s in extra if x == s)
        assert all(k <= min((k2 for k2, x, s in extra if x == 0), default=k) for k in taken)
        assert sum(0 < x < s for _, x, s in extra) <= 1


def test_reruns_agree_and_weights_matter(spark):
    rows = [(i, "w " * 10, "a" if i < 900 else "b") for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    good = df.where("doc_id % 2 = 0").select("doc_id", F.lit(9).alias("quality_weight"))
    once = sorted(tuple(r) for r in mixing.mix(df, quality=good, budget=(1, 2)).collect())
    assert once == sorted(tuple(r) for r in mixing.mix(df.repartition(13), quality=good, budget=(1, 2)).collect())
    taken = [(r[0], r[4]) for r in once if r[5] == "a"]
    assert sum(t for i, t in taken if i % 2 == 0) > 2 * sum(t for i, t in taken if i % 2)


def test_odd_tables(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    (one,) = mixing.mix(spark.createDataFrame([(1, "word " * 400_000, "a")], SCHEMA)).collect()
    assert (one["size"], one["taken"]) == (400_000, 600_000)


def test_repeated_labels_do_not_multiply(spark):
    docs = spark.createDataFrame(rows_of(4), SCHEMA)
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (7, 0)], "doc_id bigint, quality int")
    weights = mixing.label_weights(labels)
    assert sorted(tuple(r) for r in weights.collect()) == [(1, 2.0), (2, 1.0), (7, 0.5)]
    assert mixing.mix(docs, quality=weights).count() == docs.count()


def test_texts_stay_where_they_are(spark, sf):
    from support import plan_of

    docs = table(spark, sf, "documents")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(mixing.sized(docs, mixing.label_weights(table(spark, sf, "labels"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[: plan.index("Exchange")]
    assert "regexp_count" not in above and "SortMergeJoin" in above


def test_query_keeps_all_documents(spark, sf):
    got = mixing.query(spark, sf)
    assert got.count() == table(spark, sf, "documents").count()
