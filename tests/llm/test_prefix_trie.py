"""The conversation trie against a plain version."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.llm import prefix_trie
from voltide.llm.common import table

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talks(seed, n=400):
    """Conversations from few texts, so that they share beginnings; copies, gaps, nulls, negative ids."""
    rnd = random.Random(seed)
    rows = []
    for c in [*range(n), *range(-70, -1), *(n + 37 * i for i in range(40))]:
        if rnd.random() < 0.1:
            continue
        for t in range(rnd.randint(1, 6)):
            rows.append((c, None if t == 0 and rnd.random() < 0.2 else t, rnd.choice(["user", "bot", None]), rnd.choice(["hello there", "yes", "", None, "a b c", "two  words\n"])))
    rows += [(5000 + i, t, "user", "the same") for i in range(60) for t in range(4)]
    rows += [(9000, t, "user", f"turn {t}") for t in range(700)] + [(9001, t, "user", f"turn {t}") for t in range(650)]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, light, batch", [(1, None, 10_000), (2, 3, 7), (3, 20, 64), (4, 1, 1)])
def test_trie(spark, seed, light, batch):
    rows = talks(seed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = plain(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5), light=light))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute.prefix_trie(rows)


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert plain(prefix_trie.query(spark, sf)) == brute.prefix_trie(rows)


def test_odd_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # one own turn that is dropped, nobody to borrow from: only the root
    alone = next(c for c in range(1, 20) if brute.prefix_trie([(c, 0, "user", "x")])[-1][1] == 0)
    assert plain(prefix_trie.trie(spark.createDataFrame([(alone, 0, "user", "x")], SCHEMA))) == brute.prefix_trie([(alone, 0, "user", "x")])
    # equal turns and repeated rows are turns of their own, in a fixed order; extra columns with names of results do no harm
    rows = [(20, 0, "user", "a"), (20, 0, "user", "a"), (20, 0, "user", "b")]
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(9)).withColumn("p1", F.lit("x"))
    got = plain(prefix_trie.trie(clash))
    assert got == plain(prefix_trie.trie(clash.repartition(3)))
    assert max(r[1] for r in got) == 3
    long = [(40, t, "user", "word " * 300_000) for t in range(3)]
    assert plain(prefix_trie.trie(spark.createDataFrame(long, SCHEMA))) == brute.prefix_trie(long)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (5000, 2)).astype(np.uint64)
    slots = prefix_trie.SlotTable(keys)
    assert sorted(slots.slots(keys)) == list(range(5000))
    assert (slots.slots(keys + np.uint64(1)) == -1).all()
    assert (prefix_trie.SlotTable(keys[:0]).slots(keys) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.concatenate([keys, keys[:1]]))


def test_many_shards_and_hot_beginning(spark, monkeypatch):
    rows = [(c, t, "user", "same" if t < 2 else f"{c % 50} {t}") for c in range(0, 20_000, 20) for t in range(5)]
    monkeypatch.setattr(prefix_trie, "SHARD", 500)
    assert plain(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), light=100)) == brute.prefix_trie(rows)
