"""Tokens, n-grams, vocabulary and TF-IDF over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.catalog.inputs import STOP_SQL, STOPWORDS
from voltide.catalog.registry import cte, query, r6
from voltide.functions import text as T
from voltide.operators import text_features as X
from voltide.sources.tables import scan_parquet

W1, W2 = "[\\p{L}\\p{N}_]+", "[\\p{L}\\p{N}_]{2,}"
K = 500

cte("words", f"SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{W2}'), lambda x: x NOT IN ({STOP_SQL})) AS w FROM documents")
cte(
    "terms",
    """SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) >= 2 THEN list_transform(list_zip(w[1:len(w) - 1], w[2:len(w)]), lambda z: z[1] || ' ' || z[2]) ELSE [] END)) AS term FROM words""",
    "words",
)
cte("vocab", f"SELECT term, count(*) AS corpus_count FROM terms GROUP BY term ORDER BY corpus_count DESC, term LIMIT {K}", "terms")
cte("counts", "SELECT doc_id, term, count(*) AS tf FROM terms JOIN vocab USING (term) GROUP BY 1, 2", "vocab")


def docs(spark, d, *more):
    return scan_parquet(spark, f"{d}/documents.parquet", columns=["doc_id", "text", *more], spread_by="doc_id")


@query(f"SELECT doc_id, regexp_extract_all(lower(text), '{W1}') AS tokens FROM documents")
def tokenize_words(spark, d):
    return docs(spark, d).select("doc_id", T.tokenize("text").alias("tokens"))


@query("SELECT doc_id, w AS tokens FROM words", "words")
def remove_stopwords(spark, d):
    rows = docs(spark, d)
    return rows.select("doc_id", T.remove_stopwords(T.tokenize("text", T.WORD2), STOPWORDS).alias("tokens"))


@query(
    """SELECT doc_id, list_concat(w, CASE WHEN len(w) >= 2 THEN list_transform(list_zip(w[1:len(w) - 1], w[2:len(w)]), lambda z: z[1] || '_' || z[2]) ELSE [] END) AS ngrams FROM words""",
    "words",
)
def ngrams_1_2(spark, d):
    rows = docs(spark, d)
    words = rows.select("doc_id", T.remove_stopwords(T.tokenize("text", T.WORD2), STOPWORDS).alias("w"))
    return words.select("doc_id", T.ngrams(F.col("w"), (1, 2), "_").alias("ngrams"))


@query("SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2", "terms")
def term_counts(spark, d):
    return X.term_counts(docs(spark, d), doc="doc_id", text="text", stopwords=STOPWORDS)


@query("SELECT term, corpus_count FROM vocab", "vocab")
def top_k_vocabulary(spark, d):
    return X.top_k_vocabulary(docs(spark, d), doc="doc_id", text="text", stopwords=STOPWORDS, max_features=K)


@query("SELECT doc_id, term, tf FROM counts", "counts")
def count_vectorize(spark, d):
    return X.count_vectorize(docs(spark, d), doc="doc_id", text="text", stopwords=STOPWORDS, max_features=K)


WEIGHED = """SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM (
  SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + count(*) OVER (PARTITION BY term))) + 1) AS w FROM {src})"""


@query(WEIGHED.format(src="counts"), "counts")
def tfidf(spark, d):
    return r6(X.tfidf(docs(spark, d), doc="doc_id", text="text", stopwords=STOPWORDS, max_features=K))


def _stem_sql(t: str) -> str:
    cut = f"regexp_replace({t}, '(ings?|edly|ed|ly|ies|es|s)$', '')"
    return f"CASE WHEN length({t}) <= 4 OR length({cut}) < 3 THEN {t} ELSE {cut} END"


cte("tokens1", f"SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{W1}'), lambda x: x NOT IN ({STOP_SQL})) AS w FROM documents")
cte("stems", f"SELECT doc_id, pos, token, {_stem_sql('token')} AS stem FROM (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM tokens1)", "tokens1")
cte(
    "stem_terms",
    "SELECT doc_id, stem AS term FROM stems UNION ALL SELECT doc_id, term FROM (SELECT doc_id, stem || '_' || lead(stem) OVER (PARTITION BY doc_id ORDER BY pos) AS term FROM stems) WHERE term IS NOT NULL",
    "stems",
)
cte(
    "stem_counts",
    f"SELECT doc_id, term, count(*) AS tf FROM stem_terms WHERE term IN (SELECT term FROM stem_terms GROUP BY term ORDER BY count(*) DESC, term LIMIT {K}) GROUP BY 1, 2",
    "stem_terms",
)


@query("SELECT doc_id, CAST(pos AS INTEGER) AS pos, token, stem FROM stems", "stems")
def stem_dictionary(spark, d):
    rows = docs(spark, d)
    table_ = X.stem_table(rows, doc="doc_id", text="text")
    return X.stem_dictionary(rows, doc="doc_id", text="text", stems=table_, stopwords=STOPWORDS)


@query(WEIGHED.format(src="stem_counts"), "stem_counts")
def direction_analyzer_tfidf(spark, d):
    return r6(X.direction_analyzer_tfidf(docs(spark, d), doc="doc_id", text="text", stopwords=STOPWORDS, max_features=K))


cte("known", f"SELECT term FROM (SELECT unnest(regexp_extract_all(lower(text), '{W1}')) AS term FROM documents WHERE lang = 'en') GROUP BY term ORDER BY count(*) DESC, term LIMIT {K}")
cte(
    "oov",
    f"""SELECT doc_id, avg(CAST(k.term IS NULL AS DOUBLE)) AS oov_share FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{W1}')) AS term FROM documents) t LEFT JOIN known k USING (term) GROUP BY doc_id""",
    "known",
)
cte(
    "descr_long",
    f"""SELECT lang, 'text_length' AS "column", CAST(length(text) AS DOUBLE) AS v FROM documents UNION ALL
      SELECT lang, 'non_letter_share', CASE WHEN length(text) > 0 THEN (length(text) - length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))) / length(text) ELSE 0 END FROM documents UNION ALL
      SELECT lang, 'oov_share', coalesce(oov_share, 0) FROM documents LEFT JOIN oov USING (doc_id)""",
    "oov",
)


@query(
    """SELECT lang, "column", count(*) AS n, round(avg(v), 6) AS mean, round(max(v), 6) AS max, round(quantile_cont(v, 0.05), 6) AS p05, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95
    FROM descr_long GROUP BY 1, 2""",
    "descr_long",
)
def text_descriptors(spark, d):
    rows = docs(spark, d, "lang")
    english = rows.where(F.col("lang") == "en")
    vocabulary = X.top_k_vocabulary(english, doc="doc_id", text="text", sizes=(1, 1), pattern=T.WORD, max_features=K)
    return r6(X.text_descriptors(rows, doc="doc_id", text="text", by=["lang"], vocabulary=vocabulary))
