import math
import random

import pytest
from pyspark.sql import functions as F
from support import plan_of

from voltide.functions import text as T
from voltide.functions.scalars import headline_length, nonblank, word_count
from voltide.operators import text_features as X


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, "Oil prices rise, oil falls"), (2, "The oil price"), (3, "a"), (4, "")], "id int, t string")


def test_word_functions(spark):
    df = spark.createDataFrame([("Été à la  plage !",), ("   ",), (None,)], "t string")
    got = df.select(T.tokenize("t"), word_count("t"), headline_length("t"), nonblank("t")).collect()
    assert list(got[0][0]) == ["été", "à", "la", "plage"] and got[0][1] == 5 and got[0][2] == len("Été à la  plage !")
    assert list(got[1][0]) == [] and got[1][1] == 0 and got[1][3] is False
    assert got[2][1] is None and got[2][3] is None


def test_ngrams(docs):
    grams = {r.id: list(r.g) for r in docs.select("id", T.ngrams(T.tokenize("t"), (1, 2)).alias("g")).collect()}
    assert grams[2] == ["the", "oil", "price", "the oil", "oil price"]
    assert grams[3] == ["a"] and grams[4] == []


def test_stopwords_keep_repeats(docs):
    got = docs.select(T.remove_stopwords(T.tokenize("t"), ["prices", "the"]).alias("w")).first().w
    assert list(got) == ["oil", "rise", "oil", "falls"]


def test_vocabulary_ties_and_limit(docs):
    got = [(r.term, r.corpus_count) for r in X.top_k_vocabulary(docs, doc="id", text="t", max_features=2, sizes=(1, 1)).collect()]
    assert got == [("oil", 3), ("falls", 1)]


def test_tfidf_by_hand(docs):
    got = {(r.id, r.term): r.weight for r in X.tfidf(docs, doc="id", text="t", max_features=2, sizes=(1, 1)).collect()}
    oil, falls = math.log(5 / 3) + 1, math.log(5 / 2) + 1
    norm = math.hypot(2 * oil, falls)
    assert got == {(1, "oil"): pytest.approx(2 * oil / norm), (1, "falls"): pytest.approx(falls / norm), (2, "oil"): pytest.approx(1.0)}


def test_no_python_in_text_plans(docs):
    plan = plan_of(X.tfidf(docs, doc="id", text="t"))
    assert "Python" not in plan and "TakeOrderedAndProject" in plan


def test_given_stems_and_rule_agree(docs):
    stems = X.stem_table(docs, doc="id", text="t")
    words = lambda **how: sorted((r.id, list(r.words)) for r in X.direction_words(docs, doc="id", text="t", stopwords=["the"], **how).collect() if len(r.words))
    assert words(stems=stems) == words()


def brute_vocabulary(texts, k, joiner):
    from collections import Counter

    count = Counter()
    for words in texts:
        count.update(words)
        count.update(joiner.join(p) for p in zip(words, words[1:]))
    return sorted(count.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("joiner", [" ", "_"])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_pruned_vocabulary_is_exact(spark, joiner, k):
    """Against a plain count, with ties at the edge and words that look like pairs."""
    rng = random.Random(k)
    texts = [[rng.choice(["a", "b", "c", "d", "e", "a_b", "f", "gg", "hh", "zz"]) for _ in range(rng.randint(0, 9))] for _ in range(40)]
    words = spark.createDataFrame(list(enumerate(texts)), "id int, words array<string>")
    got = X.vocabulary(words, sizes=(1, 2), joiner=joiner, max_features=k).collect()
    assert sorted(((r.term, r.corpus_count) for r in got), key=lambda x: (-x[1], x[0])) == brute_vocabulary(texts, k, joiner)


def test_descriptors(spark, docs):
    known = spark.createDataFrame([("oil",)], "term string")
    got = {r.id: r for r in X.text_descriptor_rows(docs, doc="id", text="t", vocabulary=known).collect()}
    assert got[2].oov_share == pytest.approx(2 / 3) and got[2].non_letter_share == pytest.approx(2 / 13)
    assert got[4].oov_share == 0.0 and got[4].non_letter_share == 0.0


def brute_counts(rows):
    from collections import Counter

    out = Counter()
    for doc, words in rows:
        out.update((doc, t) for t in [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))])
    return sorted(((*k, n) for k, n in out.items()), key=repr)


def test_term_counts_of_rows_without_shuffle_of_terms(spark):
    """Ids that repeat, no id, no words, no text; rows of an id that comes once are counted where they are."""
    rng = random.Random(4)
    texts = [(i, " ".join(rng.choice(["aa", "bb", "cc"]) for _ in range((i or 6) % 7))) for i in [*range(1, 30), 5, 6, 6, None, None]]
    df = spark.createDataFrame([*texts, (40, None), (41, "")], "id int, t string")
    got = X.term_counts(df, doc="id", text="t")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_counts([(i, t.split()) for i, t in texts])
    alone = plan_of(X.term_counts(spark.range(9).selectExpr("id", "'aa bb' t"), doc="id", text="t"))
    assert "hashpartitioning(term" not in alone and "partial_sum" in alone and "partial_count" not in alone


def test_pairs_are_joined_with_the_frequent_words_alone(spark, monkeypatch):
    """The written tables that the pairs meet hold the words that may be in the result, not all words."""
    written, cut = [], X.checkpointed
    monkeypatch.setattr(X, "checkpointed", lambda df: written.append(cut(df)) or written[-1])
    texts = [["up", "down"] * 3 + [f"w{i}"] for i in range(50)]
    words = spark.createDataFrame(list(enumerate(texts)), "id int, words array<string>")
    for joiner in (" ", "_"):
        written.clear()
        got = X.vocabulary(words, sizes=(1, 2), joiner=joiner, max_features=2)
        assert sorted(tuple(r) for r in got.collect()) == [("down", 150), ("up", 150)]
        assert max(t.count() for t in written) == 52 and sorted(r.term for r in written[1].collect()) == ["down", "up"]


@pytest.mark.parametrize("k", [1, 3, 8, 1000])
def test_pairs_that_spell_the_same_term(spark, k):
    """a_b and c, a and b_c, and the word a_b_c are one term; words with several or outer joiners."""
    rng = random.Random(k)
    texts = [[rng.choice(["a", "b", "c", "a_b", "b_c", "a_b_c", "_", "_a", "b_", "a__b"]) for _ in range(rng.randint(0, 12))] for _ in range(60)]
    words = spark.createDataFrame(list(enumerate(texts)), "id int, words array<string>")
    top = brute_vocabulary(texts, k, "_")
    got = X.vocabulary(words, sizes=(1, 2), joiner="_", max_features=k).collect()
    assert sorted(((r.term, r.corpus_count) for r in got), key=lambda x: (-x[1], x[0])) == top
    chosen = {t for t, _ in top}
    counts = X.count_vocabulary(words, doc="id", sizes=(1, 2), joiner="_", max_features=k)
    want = [(i, t, n) for i, ws in enumerate(texts) for t, n in brute_vocabulary([ws], 10**6, "_") if t in chosen]
    assert sorted(tuple(r) for r in counts.collect()) == sorted(want)


def test_stems_of_words(spark):
    words = ["sings", "singing", "beds", "asings", "singly", "es", "", "edlyed", "cities"]
    df = spark.createDataFrame([(words,)], "words array<string>")
    one_by_one = [r.s for r in df.select(F.explode("words").alias("w")).select(X.suffix_stem(F.col("w")).alias("s")).collect()]
    assert df.select(X.stemmed("words")).first()[0] == one_by_one


def test_weights_share_one_exchange_of_the_counts(spark, docs):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = X.count_terms(docs.select("id", F.explode(T.tokenize("t")).alias("term")), doc="id")
        assert "ReusedExchange" in plan_of(X.weigh(counts, docs, doc="id"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
