"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors (``2 * sqrt(n)``, at most ``max_pivots``). A vector is known
by its nearest pivots in order; it is posted to the inverted files of the first ``posts`` of them,
and each file is cut into blocks. A query reads the files of its first ``probes`` pivots, ranks each
block by the footrule distance of the pivot orders, and reranks the best ``open_share`` of it (``least``
rows at least) by exact inner products in double precision.

How far a query reads follows the data: of at most ``checked`` queries, chosen by a hash, the true neighbours
are found by one pass over all vectors. ``probes`` grows until the files it covers hold enough of them, and
``open_share`` doubles until a search for these queries finds the share ``recall``; the given values are
the least. In the worst case every file is read and opened whole, which is exact.

Equal vectors are indexed once and expanded afterwards, so a vector that a third of the rows share
costs one posting. Rows stream through a block in batches, so no list of queries is held. Vectors that
are null, zero, of another length than the sample, or hold null or non-finite parts take no part, nor
do rows without an id; repeated rows count once. With fewer than ``k`` candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltide.llm.common import table, written

#: Places of a pivot order that are kept.
DEPTH = 96


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, fine) & F.exists(v, lambda x: x != 0)).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).distinct()


def orders(x: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The nearest pivots of each row, by angle, nearest first."""
    s = x @ pivots.T
    depth = min(depth, s.shape[1])
    top = np.argpartition(-s, depth - 1, axis=1)[:, :depth] if depth < s.shape[1] else np.tile(np.arange(depth), (len(x), 1))
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)


def poster(pivots: np.ndarray, files: int, blocks: int, side: int, kind: str):
    """Rows (pivot, block, side, id, order, v): side 0 goes to one block of each file, side 1 to all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 2000):
                batch = whole.slice(k, 2000)
                x = np.stack(batch.column("v").to_numpy(zero_copy_only=False)).astype(np.float64)
                order = orders(x, pivots, max(DEPTH, files))
                ids = np.asarray(batch.column("id"))
                n = min(files, order.shape[1])
                for b in range(blocks if side else 1):
                    block = np.full(len(ids), b) if side else ids % blocks
                    cols = [np.repeat(a, n) for a in (block, ids)]
                    packed = [pa.array([r.tobytes() for r in np.repeat(a, n, axis=0)], pa.binary()) for a in (order[:, :DEPTH].astype("<i2"), x.astype(kind))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(order[:, :n].ravel(), pa.int32()), pa.array(cols[0], pa.int64()), pa.array(np.full(len(ids) * n, side), pa.int32()), pa.array(cols[1], pa.int64()), *packed],
                        names=["pivot", "block", "side", "id", "ord", "v"],
                    )

    return run


def searcher(n_pivots: int, k: int, open_share: float, least: int, kind: str):
    """Over rows sorted by (pivot, block, side): the index rows of a block come first, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, block = None, [], None
        for batch in batches:
            key = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("pivot", "block", "side")])
            ids = np.asarray(batch.column("id"))
            if not len(ids):
                continue
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            out = [[], [], []]
            for a, b in zip([0, *edges], [*edges, len(ids)]):
                here = (key[0, a], key[1, a])
                if here != place:
                    place, parts, block = here, [], None
                x = np.stack([np.frombuffer(r.as_py(), kind) for r in batch.column("v")[a:b]]).astype(np.float64)
                order = np.stack([np.frombuffer(r.as_py(), "<i2") for r in batch.column("ord")[a:b]])
                if key[2, a] == 0:
                    parts.append((ids[a:b], x, order))
                    continue
                if not parts:
                    continue
                if block is None:
                    c_ids, c_x, c_order = (np.concatenate(p) for p in zip(*parts))
                    rank = np.full((len(c_ids), n_pivots), c_order.shape[1], np.int16)
                    np.put_along_axis(rank, c_order.astype(np.int64), np.arange(c_order.shape[1], dtype=np.int16)[None], 1)
                    # a missing pivot counts as the first place after the known ones
                    tail = (c_order.shape[1] - np.arange(c_order.shape[1])).sum()
                    block = (c_ids, c_x, rank, tail)
                c_ids, c_x, rank, tail = block
                depth = order.shape[1]
                for i in range(b - a):
                    seen = rank[:, order[i]]
                    near = np.abs(seen - np.arange(depth, dtype=np.int16)).sum(axis=1, dtype=np.int32)
                    # pivots that only the indexed vector lists
                    foot = near + tail - (depth - seen).sum(axis=1, dtype=np.int32)
                    m = min(len(c_ids), max(least, int(open_share * len(c_ids))))
                    take = np.lexsort((c_ids, foot))[:m] if m < len(c_ids) else np.arange(m)
                    score = c_x[take] @ x[i]
                    best = take[np.lexsort((c_ids[take], -score))[: k + 1]]
                    out[0].append(np.full(len(best), ids[a + i]))
                    out[1].append(c_ids[best])
                    out[2].append(np.einsum("ij,j->i", c_x[best], x[i]))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["q", "c", "score"])

    return run


def true_neighbours(ids: np.ndarray, x: np.ndarray, k: int):
    """The ``k`` + 1 best rows of a task for each query (``ids``, ``x``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, score = np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0))
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                new = x @ np.stack(batch.column("v").to_numpy(zero_copy_only=False)).astype(np.float64).T
                score = np.concatenate([score, new], 1)
                c = np.concatenate([c, np.tile(np.asarray(batch.column("id")), (len(ids), 1))], 1)
                best = np.lexsort((c, -score), axis=1)[:, : k + 1]
                c, score = np.take_along_axis(c, best, 1), np.take_along_axis(score, best, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, c.shape[1])), pa.array(c.ravel()), pa.array(score.ravel())], names=["q", "c", "score"])

    return run


def nearest(
    vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", posts: int = 5, probes: int = 64, open_share: float = 0.25, least: int = 200, max_pivots: int = 4096, block_rows: int = 4000, recall: float = 0.95, checked: int = 200
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows where ``is_query`` (a condition on ``id``) holds."""
    rows = usable(vectors, id_col, vector_col)
    same = Window.partitionBy("v").orderBy("id")
    # only the k + 1 smallest ids of equal vectors can be in a result; the limit runs below the shuffle
    ranked = written(rows.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).withColumn("class", F.min("id").over(Window.partitionBy("v"))), "classes")
    classes = ranked.where("r = 1").select("id", "v")
    n = classes.count()
    size = min(max_pivots, max(1, int(2 * n**0.5)))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(size).collect()
    dims = [len(r["v"]) for r in sample]
    dim = max(set(dims), key=lambda d: (dims.count(d), d)) if dims else 0
    pivots = np.array([r["v"] for r in sample if len(r["v"]) == dim], np.float64).reshape(-1, max(dim, 1))
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-300)
    classes = classes.where(F.size("v") == dim)
    asked = rows.where(is_query).join(classes.withColumnRenamed("id", "class"), "v").select(F.col("id").alias("query_id"), "class")
    queries = classes.join(asked.select(F.col("class").alias("id")).distinct(), "id", "left_semi")
    if not len(pivots):
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("class").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    kind = "<f4" if dict(classes.dtypes)["v"] == "array<float>" else "<f8"
    blocks = max(1, -(-n * posts // (len(pivots) * block_rows)))
    schema = "pivot int, block bigint, side int, id bigint, ord binary, v binary"
    hit = "q bigint, c bigint, score double"
    per_query = Window.partitionBy("q").orderBy(F.desc("score"), "c")

    def top_of(hits: DataFrame) -> DataFrame:
        return hits.dropDuplicates(["q", "c"]).withColumn("r", F.row_number().over(per_query)).where(F.col("r") <= k + 1)

    def search(queries: DataFrame, probes: int, open_share: float) -> DataFrame:
        index = classes.mapInArrow(poster(pivots, posts, blocks, 0, kind), schema)
        both = index.unionByName(queries.mapInArrow(poster(pivots, probes, blocks, 1, kind), schema))
        met = both.repartition("pivot", "block").sortWithinPartitions("pivot", "block", "side")
        return top_of(met.mapInArrow(searcher(len(pivots), k, open_share, least, kind), hit))

    # where every file is read and opened whole, there is nothing to measure
    some = queries.orderBy(F.xxhash64("id"), "id").limit(checked).collect() if n > least or len(pivots) > probes else []
    if some:
        probe = queries.sparkSession.createDataFrame([(r["id"], r["v"]) for r in some], classes.select("id", "v").schema)
        ids, x = np.array([r["id"] for r in some], np.int64), np.array([r["v"] for r in some], np.float64)
        truth = [(r["q"], r["c"]) for r in top_of(classes.select("id", "v").mapInArrow(true_neighbours(ids, x, k), hit)).collect()]
        # at most checked * (k + 1) ids: the size of the broadcast is bounded
        met_ids = queries.sparkSession.createDataFrame([(c,) for c in sorted({c for _, c in truth})], "id bigint")
        vector = {r["id"]: r["v"] for r in classes.join(F.broadcast(met_ids), "id").collect()}
        place = np.argsort(orders(x, pivots, len(pivots)), axis=1)
        row = {i: j for j, i in enumerate(ids.tolist())}
        posted = orders(np.array([vector[c] for _, c in truth], np.float64), pivots, posts)
        # how many files a query must read to meet each of its true neighbours
        need = np.sort(place[np.array([row[q] for q, _ in truth])[:, None], posted].min(axis=1) + 1)
        probes = max(probes, int(need[min(len(need) - 1, int(np.ceil((1 + recall) / 2 * len(need))) - 1)]))
        known = set(truth)
        while open_share < 1 and len(known & {(r["q"], r["c"]) for r in search(probe, probes, open_share).select("q", "c").collect()}) < recall * len(known):
            open_share = min(1.0, 2 * open_share)
    best = search(queries, probes, open_share)
    expanded = best.select("q", "c", "score").join(ranked.select(F.col("class").alias("c"), F.col("id").alias("vec_id")), "c")
    # rows of one query class: k + 1 classes of k + 1 rows at most
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = expanded.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    out = asked.join(answers.select(F.col("q").alias("class"), "vec_id", "score"), "class").where(F.col("vec_id") != F.col("query_id"))
    return out.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
