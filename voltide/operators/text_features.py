"""Term counts, vocabulary, TF-IDF and text descriptors as relational operations.

Every function that needs a vocabulary reads the words twice or more, for the vocabulary and for the
counts. They are written once, as arrays, and read again: that is cheaper than tokenising again, and much
cheaper than shuffling every (document, n-gram) pair only to drop all but the chosen terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.text import WORD, WORD2, ngrams, remove_stopwords, tokenize
from voltide.operators.metrics import same_group, selected_quantiles
from voltide.operators.ordering import checkpointed


def doc_words(df: DataFrame, *, doc: str, text: str, stopwords: Sequence[str] = (), pattern: str = WORD2) -> DataFrame:
    """(doc, words) with the stop words out."""
    return df.select(doc, remove_stopwords(tokenize(text, pattern), stopwords).alias("words"))


def explode_terms(words: DataFrame, *, doc: str, sizes: tuple[int, int] = (1, 2), joiner: str = " ") -> DataFrame:
    """One row per n-gram occurrence."""
    return explode_known(words, ngrams(F.col("words"), sizes, joiner), "term", doc)


def explode_known(df: DataFrame, array: Column, name: str, *keep: str) -> DataFrame:
    """``explode`` of an expensive array. For a plain ``explode`` the optimizer adds a filter on the
    array's size and evaluates the tokeniser again for it; the outer form with a filter on the
    element afterwards evaluates it once."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def adjacent(words: DataFrame, *keep: str) -> DataFrame:
    """One row per word ``a`` with the word ``b`` after it, null for the last one."""
    placed = words.select(*keep, "words", F.posexplode_outer("words").alias("at", "a")).where(F.col("a").isNotNull())
    return placed.select(*keep, "a", F.get("words", F.col("at") + 1).alias("b"))


def run_lengths(array: Column) -> Column:
    """The distinct elements of an array as ``term`` with their number as ``tf``: the array is sorted inside the
    row and its runs are measured."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        tf = lambda at, at_next: (F.coalesce(at_next, F.size(s)) - at).cast("bigint")
        each = lambda b: F.transform(b, lambda at, k: F.struct(F.get(s, at).alias("term"), tf(at, F.get(b, k + 1)).alias("tf")))
        return F.when(F.size(s) > 0, F.get(F.transform(F.array(starts), each), F.lit(0)))

    # an array of one: its element is computed once and bound to the name
    return F.get(F.transform(F.array(F.sort_array(array)), runs), F.lit(0))


def count_by_row(df: DataFrame, array: Column, *, doc: str) -> DataFrame:
    """Count of each element in each document, as ``count_terms`` gives, without a shuffle of the elements.

    A row counts its own elements. Only documents of several rows, and rows without an id, need the counts
    of different rows added; the ids that repeat are found by a count of the ids alone.
    """
    n = df.groupBy(doc).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col(doc).isNotNull())
    repeated = checkpointed(n.select(doc))

    def counted(rows: DataFrame) -> DataFrame:
        return explode_known(rows, run_lengths(array), "_c", doc).select(doc, "_c.term", "_c.tf")

    alone = df.where(F.col(doc).isNotNull()).join(repeated, doc, "left_anti")
    others = df.join(repeated, doc, "left_semi").unionByName(df.where(F.col(doc).isNull()))
    added = counted(others).groupBy(doc, "term").agg(F.sum("tf").alias("tf"))
    return counted(alone).unionByName(added)


def count_terms(terms: DataFrame, *, doc: str) -> DataFrame:
    """Count of each term in each document; a frequent term is spread over its documents."""
    return terms.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_counts(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("corpus_count"))


def top_terms(counts: DataFrame, max_features: int) -> DataFrame:
    """The terms with the largest corpus counts; ties go to the smaller term."""
    return counts.orderBy(F.desc("corpus_count"), "term").limit(max_features)


def vocabulary(words: DataFrame, *, sizes: tuple[int, int], joiner: str, max_features: int) -> DataFrame:
    """The most frequent n-grams with their corpus counts.

    A pair is never more frequent than either of its words, and the ``max_features``-th word bounds
    the list from below. So only pairs of two words at least that frequent can get in, and all
    others leave before they are counted or shuffled: without this, nearly every distinct pair of
    the corpus would cross the network. A word that contains the joiner may look like a pair, and pairs of
    such words may look like others; see ``lookalikes``.

    The threshold is a scalar subquery and the joins carry no hint. The frequent words are few, but only
    their table shows it: they are written first, so that the plan knows their size and all pairs need not be
    shuffled for the join. Tokens hold no white space, so a blank as the joiner leaves no look-alikes.
    """
    if sizes != (1, 2):
        return top_terms(corpus_counts(explode_known(words, ngrams(F.col("words"), sizes, joiner), "term")), max_features)
    single = checkpointed(corpus_counts(explode_known(words, F.col("words"), "term")))
    edge = top_terms(single, max_features).agg(F.when(F.count(F.lit(1)) == max_features, F.min("corpus_count")).otherwise(F.lit(0)).alias("least"))
    often = F.col("corpus_count") >= edge.scalar()
    frequent = checkpointed(single.where(often))
    pairs = adjacent(words).where(F.col("b").isNotNull())
    kept = frequent
    if joiner.isspace():
        for side in ("a", "b"):
            pairs = pairs.join(frequent.select(F.col("term").alias(side)), side, "left_semi")
    else:
        spelled = checkpointed(lookalikes(single, edge.scalar(), joiner))
        for side in ("a", "b"):
            pairs = pairs.join(frequent.select(F.col("term").alias(side), F.lit(1).alias(f"in_{side}")), side, "left")
        pairs = pairs.join(spelled.select("a", "b", F.lit(1).alias("in_words")), ["a", "b"], "left")
        unclear = F.col("a").contains(joiner) | F.col("b").contains(joiner)
        pairs = pairs.where((F.col("in_a").isNotNull() & F.col("in_b").isNotNull()) | F.col("in_words").isNotNull() | unclear)
        kept = single.where(often | F.col("term").contains(joiner))
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("corpus_count"))
    joined = counted.select(F.concat("a", F.lit(joiner), "b").alias("term"), "corpus_count")
    together = kept.unionByName(joined).groupBy("term").agg(F.sum("corpus_count").alias("corpus_count"))
    return top_terms(together, max_features)


def lookalikes(single: DataFrame, least: Column, joiner: str) -> DataFrame:
    """(a, b) of the words that a pair may spell and that may reach the threshold together with it.

    A pair of words without the joiner spells a word with one joiner in it, and no other pair spells that. The pair
    occurs as often as the rarer of its words at most, which bounds the count of word and pair. Pairs of words that
    hold the joiner themselves may spell the same in several ways: the caller keeps them all.
    """
    parts = F.split(F.col("term"), "\\Q" + joiner + "\\E")
    whole = F.size(parts) == 2
    split = single.where(whole).select(F.get(parts, F.lit(0)).alias("a"), F.get(parts, F.lit(1)).alias("b"), F.col("corpus_count").alias("n"))
    for side in ("a", "b"):
        split = split.join(single.select(F.col("term").alias(side), F.col("corpus_count").alias(f"n_{side}")), side)
    return split.where(F.col("n") + F.least("n_a", "n_b") >= least).select("a", "b")


def count_vocabulary(words: DataFrame, *, doc: str, sizes: tuple[int, int], joiner: str, max_features: int) -> DataFrame:
    """Counts per document of the ``max_features`` most frequent terms: the others are dropped
    before the shuffle.

    With pairs, each word is looked up once, with the word after it only if a chosen pair begins with it; no
    pair is spelled out for that. A term with several joiners may be several pairs.
    """
    chosen = vocabulary(words, sizes=sizes, joiner=joiner, max_features=max_features).select("term")
    if sizes != (1, 2):
        return count_terms(explode_terms(words, doc=doc, sizes=sizes, joiner=joiner).join(chosen, "term", "inner"), doc=doc)
    parts, cut = F.split("term", f"\\Q{joiner}\\E"), F.col("cut")
    side = lambda start, n: F.array_join(F.slice(parts, start, n), joiner)
    cuts = chosen.where(F.size(parts) > 1).select("term", F.explode(F.sequence(F.lit(1), F.size(parts) - 1)).alias("cut"))
    pairs = cuts.select(side(F.lit(1), cut).alias("_first"), side(cut + 1, F.size(parts) - cut).alias("b"), F.col("term").alias("_pair"))
    heads = chosen.select(F.col("term").alias("a"), F.col("term").alias("_word"), F.lit(None).cast("string").alias("_first"))
    heads = heads.unionByName(pairs.select(F.col("_first").alias("a"), F.lit(None).cast("string").alias("_word"), "_first"))
    heads = heads.groupBy("a").agg(F.max("_word").alias("_word"), F.max("_first").alias("_first"))
    hits = adjacent(words, doc).join(heads, "a").join(pairs, ["_first", "b"], "left")
    return count_terms(explode_known(hits, F.array("_word", "_pair"), "term", doc), doc=doc)


def term_counts(df: DataFrame, *, doc: str, text: str, sizes: tuple[int, int] = (1, 2), joiner: str = " ", **how) -> DataFrame:
    return count_by_row(doc_words(df, doc=doc, text=text, **how), ngrams(F.col("words"), sizes, joiner), doc=doc)


def top_k_vocabulary(df: DataFrame, *, doc: str, text: str, max_features: int = 1000, sizes: tuple[int, int] = (1, 2), joiner: str = " ", **how) -> DataFrame:
    words = doc_words(df, doc=doc, text=text, **how)
    return vocabulary(checkpointed(words) if sizes == (1, 2) else words, sizes=sizes, joiner=joiner, max_features=max_features)


def count_vectorize(df: DataFrame, *, doc: str, text: str, max_features: int = 1000, sizes: tuple[int, int] = (1, 2), joiner: str = " ", **how) -> DataFrame:
    words = checkpointed(doc_words(df, doc=doc, text=text, **how))
    return count_vocabulary(words, doc=doc, sizes=sizes, joiner=joiner, max_features=max_features)


def tfidf(df: DataFrame, *, doc: str, text: str, max_features: int = 1000, **how) -> DataFrame:
    """tf * (ln((1 + n) / (1 + df)) + 1), every document scaled to length 1."""
    counts = count_vectorize(df, doc=doc, text=text, max_features=max_features, **how)
    return weigh(counts, df, doc=doc)


def weigh(counts: DataFrame, docs: DataFrame, *, doc: str) -> DataFrame:
    """TF-IDF weights from term counts; ``docs`` gives the number of documents.

    The documents of a term are counted by ``tf``, which is 1 or more: both uses of the counts then need the same
    columns and share one exchange.
    """
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    spread_of = counts.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("doc_freq"))
    idf = spread_of.select("term", (F.ln((1 + n_docs) / (1 + F.col("doc_freq"))) + 1).alias("idf"))
    raw = counts.join(idf, "term", "inner").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc)))  # as many rows as the vocabulary has terms
    return raw.select(doc, "term", (F.col("_w") / norm).alias("weight"))


def stem_dictionary(df: DataFrame, *, doc: str, text: str, stems: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    """Tokens with their stems. Each *distinct* token is mapped once through the (token, stem)
    table, and tokens missing there keep their form. Returns (doc, pos, token, stem)."""
    words = doc_words(df, doc=doc, text=text, stopwords=stopwords, pattern=WORD)
    tokens = words.select(doc, F.posexplode_outer("words").alias("pos", "token")).where(F.col("pos").isNotNull())
    joined = tokens.join(stems, "token", "left")
    return joined.select(doc, "pos", "token", F.coalesce("stem", "token").alias("stem"))


def distinct_tokens(df: DataFrame, *, doc: str, text: str) -> DataFrame:
    return explode_known(df, F.array_distinct(tokenize(text, WORD)), "token").distinct()


def suffix_stem(token: Column) -> Column:
    """A small English suffix rule, used where no (token, stem) table is given."""
    cut = cut_suffix(token)
    return F.when(F.length(cut) < 3, token).otherwise(cut)


def cut_suffix(token: Column) -> Column:
    return F.when(F.length(token) <= 4, token).otherwise(F.regexp_replace(token, r"(ings?|edly|ed|ly|ies|es|s)$", ""))


def stemmed(words: str) -> Column:
    """``suffix_stem`` of each word of an array column; the pattern runs once a word."""
    return F.zip_with(words, F.transform(words, cut_suffix), lambda token, cut: F.when(F.length(cut) < 3, token).otherwise(cut))


def stem_table(df: DataFrame, *, doc: str, text: str) -> DataFrame:
    return distinct_tokens(df, doc=doc, text=text).select("token", suffix_stem(F.col("token")).alias("stem"))


def direction_words(df: DataFrame, *, doc: str, text: str, stems: DataFrame | None = None, stopwords: Sequence[str] = ()) -> DataFrame:
    """(doc, words) of the second analyzer: all words, stop words out, stems.

    Without a (token, stem) table the suffix rule works inside the row. With one, the stems of a
    document come back together in order of position: as many as the document has words.
    """
    if stems is None:
        plain = doc_words(df, doc=doc, text=text, stopwords=stopwords, pattern=WORD)
        return plain.select(doc, stemmed("words").alias("words"))
    tokens = stem_dictionary(df, doc=doc, text=text, stems=stems, stopwords=stopwords)
    placed = tokens.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("pos", "stem"))).alias("_placed"))
    return placed.select(doc, F.col("_placed.stem").alias("words"))


def direction_analyzer_tfidf(df: DataFrame, *, doc: str, text: str, stems: DataFrame | None = None, stopwords: Sequence[str] = (), max_features: int = 800) -> DataFrame:
    """TF-IDF over single stems and adjacent pairs joined by ``_``."""
    words = checkpointed(direction_words(df, doc=doc, text=text, stems=stems, stopwords=stopwords))
    counts = count_vocabulary(words, doc=doc, sizes=(1, 2), joiner="_", max_features=max_features)
    return weigh(counts, df, doc=doc)


def unknown_words(vocabulary: DataFrame, words: str, out: str) -> StopWordsRemover:
    """A transformer that leaves the words that are not in the vocabulary, by a hash set inside the row.

    The vocabulary is a limited list (a ``top_k_vocabulary`` result): it is part of the plan.
    """
    terms = [r["term"] for r in vocabulary.select("term").distinct().collect()]
    return StopWordsRemover(inputCol=words, outputCol=out, stopWords=terms or [""], caseSensitive=True)


def text_descriptor_rows(df: DataFrame, *, doc: str, text: str, keep: Sequence[str] = (), vocabulary: DataFrame | None = None) -> DataFrame:
    """Length, share of non-letters and, with a vocabulary, share of unknown words per text; no shuffle."""
    letters = F.length(F.regexp_replace(F.col(text), r"[^\p{L}]+", ""))
    size = F.length(text)
    shares = {
        "text_length": size.cast("double"),
        "non_letter_share": F.when(size > 0, (size - letters) / size).otherwise(0.0),
    }
    cols = [doc, *keep, *[c.alias(n) for n, c in shares.items()]]
    if vocabulary is None:
        return df.select(*cols)
    words = df.select(*cols, F.coalesce(tokenize(text, WORD), F.array().cast("array<string>")).alias("_words"))
    missing = unknown_words(vocabulary, "_words", "_unknown").transform(words)
    share = F.coalesce(F.size("_unknown") / F.nullif(F.size("_words"), F.lit(0)), F.lit(0.0))
    return missing.select(doc, *keep, *shares, share.alias("oov_share"))


def text_descriptors(df: DataFrame, *, doc: str, text: str, by: Sequence[str] = (), vocabulary: DataFrame | None = None, qs: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Distribution of the descriptors: rows, mean, maximum and exact quantiles per descriptor. The texts are
    read once, into a narrow table of their descriptors. The vocabulary is a ``top_k_vocabulary`` result."""
    by = list(by)
    names = ["text_length", "non_letter_share"] + (["oov_share"] if vocabulary is not None else [])
    rows = checkpointed(text_descriptor_rows(df, doc=doc, text=text, keep=by, vocabulary=vocabulary).select(*by, *names))
    long = rows.unpivot(by, names, "column", "value").where(F.col("value").isNotNull())
    keys = [*by, "column"]
    basics = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    quantiles = selected_quantiles(long, by=keys, qs=qs)
    wide = quantiles.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(f"p{int(q * 100):02d}") for q in qs])
    return same_group(basics, wide, keys)
