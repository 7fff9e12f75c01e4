"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, n_tokens). Contents are normalised
to their UTF-8 bytes (null: empty; the model's own normaliser runs inside the encoder, so nothing
more may be folded before it), the tokenizer digest is that of its file. Digests are joined to the
cache, one row of each missing content is encoded, and the new counts are appended. Only digests
move in the joins; the text moves once, and only for contents that the cache lacks.

Copies, repeated rows and null ids share their content's count. An empty table leaves the cache as
it is. Rows of the cache that were appended twice (two jobs at a time) are equal and count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import NO_ID, slices, table
from voltide.operators.ordering import scratch_path

CACHE = "content binary, tokenizer string, n_tokens bigint"
#: Digests that a task remembers (some 10 MB). Where the rows come sorted, equal ones follow each other anyway.
SEEN = 100_000


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(path: str):
    """Counts of a list of texts, without special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def encoder(path: str):
    """Rows of (content, text) to counts. Rows with the same id and text are alike up to here and meet in one task (in
    a few, if adaptive execution splits it): the first one is encoded, the others leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        seen: set[bytes] = set()
        for part in slices(batches, limit=1 << 20):
            if len(seen) > SEEN:
                seen = {part.column("content")[0].as_py()} & seen
            fresh = [i for i, c in enumerate(part.column("content").to_pylist()) if not (c in seen or seen.add(c))]
            if not fresh:
                continue
            part = part.take(pa.array(fresh))
            n = count(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(n, pa.int64())], names=["content", "n_tokens"])

    return run


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer; a cache that does not exist yet is empty."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE).select("content", "n_tokens")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def rows_of_misses(docs: DataFrame, missing: DataFrame) -> DataFrame:
    """(content, text) of one row of each missing content (and of its copies with the same id). Rows are met by their id
    and a hash of their text, so rows without an id, or with a repeated one, do not meet each other."""
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))
    at = missing.select("content", F.col("_at._id").alias("_id"), F.col("_at._hash").alias("_hash"))
    return texts.join(at, ["_id", "_hash"]).select("content", "text")


def token_counts(docs: DataFrame, tokenizer_path: str, *, cache: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; the cache at ``cache`` grows by the misses."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.unhex(F.sha2(text.cast("binary"), 256))
    keyed = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), content.alias("content"))
    known = cached_counts(spark, cache, version)
    at = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_hash"))
    placed = docs.select(content.alias("content"), at.alias("_at"))
    misses = placed.groupBy("content").agg(F.min("_at").alias("_at")).join(known, "content", "left_anti")
    # one row of each missing content; rows that repeat its id and text are dropped by their digest before they are stored
    chosen = rows_of_misses(docs, misses).where(F.unhex(F.sha2(F.col("text").cast("binary"), 256)) == F.col("content"))
    fresh = chosen.select("content", "text").mapInArrow(encoder(tokenizer_path), "content binary, n_tokens bigint")
    fresh.dropDuplicates(["content"]).select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = cached_counts(spark, cache, version)
    out = keyed.join(counts, "content", "left")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), cache=scratch_path(spark, "token-cache"))
