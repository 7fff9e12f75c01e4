"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its words and of their character n-grams,
hashed into a fixed number of rows; a word that repeats the one before it adds the vector of that
word pair's kind. A softmax over two classes sits on top. Training is plain
stochastic gradient descent in numpy over a bounded sample of labelled rows (``max_rows``, chosen by
a hash of the id). Scoring is linear in the vectors, so each distinct word has one number, and a
document's score follows from its word counts; texts are read whole.

Null texts are empty. An empty text has no features and gets the bias alone. Without labelled rows,
or with labels of one class only, the score is the share of label 1 among them (0.5 without any).
Repeated rows get equal scores; ids that are null are held out. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import operator
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import lean_stream, mix, slices, table

BUCKETS, DIM, NGRAMS = 1 << 16, 12, (2, 3, 4)
#: The row after the hashed ones belongs to word pairs of equal words; it counts as often as a word has n-grams.
SAME, SAME_COUNT = BUCKETS, 16
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words of a task's table before it starts afresh, bytes of text in a slice, and characters of new words in one
#: numpy step: only the memory of a task.
MEMO = 200_000
SLICE = 1 << 20
RUN = 1 << 18


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed rows of the words and of their character n-grams, word after word, and how many each has."""
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    rows = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words), np.int64, len(words))]
    owners = [np.arange(len(words))]
    for n in NGRAMS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - n + 1 + k]
        inside = owner[: len(h)] == owner[n - 1 :]
        rows.append((mix(h[inside]) % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[: len(h)][inside])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(words))


def document(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of a text and their shares."""
    words = WORD.findall(text or "")
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = Counter(words)
    rows, n = features(list(counts))
    share = np.bincount(rows, np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), n), BUCKETS + 1)
    share[SAME] = SAME_COUNT * sum(map(operator.eq, words, words[1:]))
    ids = np.flatnonzero(share)
    return ids, share[ids] / share.sum()


def train(texts: list[str], labels: list[int], *, epochs: int = 6, rate: float = 0.6, seed: int = 7) -> dict:
    """The fitted model: one number a feature row, and a bias (difference of the two classes)."""
    y = np.asarray(labels, np.int64)
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1e-6) / (len(y) + 2e-6) if len(y) else 0.5
        p = min(max(p, 1e-3), 1 - 1e-3)
        return {"word": np.zeros(BUCKETS + 1), "bias": float(np.log(p / (1 - p)))}
    docs = [document(t) for t in texts]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM))
    out, bias = rng.normal(0, 0.1, (2, DIM)), np.zeros(2)
    weight = len(y) / (2.0 * np.bincount(y, minlength=2))
    weight = np.sqrt(weight)
    steps, step = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids, share = docs[i]
            lr = rate * (1 - step / steps)
            step += 1
            h = share @ vectors[ids] if len(ids) else np.zeros(DIM)
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]]
            if len(ids):
                # each feature moves by its share, scaled up as most shares are tiny
                vectors[ids] -= lr * np.outer(np.minimum(share * 50, 1.0), p @ out)
            out -= lr * np.outer(p, h)
            bias -= lr * 0.1 * p
    return {"word": vectors @ (out[1] - out[0]), "bias": float(bias[1] - bias[0])}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, *, label: str, max_rows: int) -> list:
    """At most ``max_rows`` (text, label) rows outside the held-out fold, by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # at most max_rows narrow rows: the size of the broadcast is bounded
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("_y").alias("_y"))
    return sorted(rows.collect(), key=lambda r: r["doc_id"])


class Scorer:
    """Scores of texts, with the sum of the feature values of each distinct word kept for the task."""

    def __init__(self, model: dict):
        self.value, self.bias = model["word"], model["bias"]
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.total, self.count = np.zeros(0), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Sums of the words that are new in the table, in runs of bounded length."""
        fresh = list(itertools.islice(self.index, len(self.total), None))
        ends = np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh)))
        totals, counts, k = [self.total], [self.count], 0
        while k < len(fresh):
            before = ends[k - 1] if k else 0
            stop = max(k + 1, int(np.searchsorted(ends, before + RUN, side="right")))
            rows, n = features(fresh[k:stop])
            starts = np.concatenate([[0], np.cumsum(n)])
            sums = np.concatenate([[0.0], np.cumsum(self.value[rows])])
            totals.append(sums[starts[1:]] - sums[starts[:-1]])
            counts.append(n)
            k = stop
        self.total, self.count = np.concatenate(totals), np.concatenate(counts)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The scores of all texts, read in runs of words; a run may end inside a text."""
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []  # (text, words of it in this run)
        carry = (-1, "")  # the text and the word that the run before ended with

        def flush():
            if len(self.index) > MEMO:
                self._clear()
            before = self.index.setdefault(carry[1], len(self.index)) if carry[0] == owners[0][0] else -1
            ids = np.fromiter((self.index.setdefault(w, len(self.index)) for w in words), np.int64, len(words))
            self._learn()
            doc = np.repeat([d for d, _ in owners], [n for _, n in owners])
            same = np.zeros(len(ids), bool)
            same[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
            same[0] = ids[0] == before
            repeats = SAME_COUNT * np.bincount(doc[same], minlength=len(texts))
            return sums + np.bincount(doc, self.total[ids], len(texts)) + repeats * self.value[SAME], counts + np.bincount(doc, self.count[ids], len(texts)).astype(np.int64) + repeats

        for d, text in enumerate(texts):
            found = WORD.finditer(text.as_py() or "")
            while some := [m[0] for m in itertools.islice(found, RUN // 8)]:
                words += some
                owners.append((d, len(some)))
                if len(words) >= RUN // 8:
                    sums, counts = flush()
                    carry, words, owners = (d, words[-1]), [], []
        if words:
            sums, counts = flush()
        return 1 / (1 + np.exp(-np.clip(self.bias + sums / np.maximum(counts, 1), -30, 30)))


def scorer(model: dict):
    """A function for mapInArrow that replaces the text by its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = Scorer(model)
        for batch in slices(batches, limit=SLICE):
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, pa.field("score", pa.float64()), pa.array(table_.scores(batch.column("text"))))

    return run


def classify(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = 3000, threshold: float = 0.3) -> DataFrame:
    """doc_id, text dropped, score of label 1 and the class at ``threshold`` for each row of ``docs``."""
    sample = labelled_sample(docs, labels, label=label, max_rows=max_rows)
    model = train([r["text"] for r in sample], [r["_y"] for r in sample])
    rows = docs.select(F.col("doc_id"), F.col("text"))
    scored = rows.mapInArrow(lean_stream(scorer(model)), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = 3000, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    sample = labelled_sample(docs, labels, label=label, max_rows=max_rows)
    model = train([r["text"] for r in sample], [r["_y"] for r in sample])

    def run(batches):
        table_ = Scorer(model)
        for batch in slices(batches, limit=SLICE):
            yield batch.filter(pa.array(table_.scores(batch.column("text")) >= threshold))

    return docs.mapInArrow(lean_stream(run), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
