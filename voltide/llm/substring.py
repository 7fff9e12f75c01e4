"""Substring dedup by hashed windows: words in a stretch of ``window`` words that an earlier document has.

This is not relative Lempel-Ziv factoring: no reference text is indexed and no greedy longest factor is
taken against a place of it. Phrases (a seed of ``SEED`` words, chosen by each window among its words, and
the windows around it) are dealt to blocks by their seed. Equal windows have equal seeds, so all windows
that can be equal meet in one block, which finds the least document id of each by its digests; a window
whose document has a larger id is a hit. Neighbouring hits of a phrase are sent as one span; they may stem
from different documents. Phrases overlap by ``window - 1`` words, so every window lies whole in a
phrase, nothing is lost at their borders, and the spans of a document are joined at the end. Greedy
factors would remove the same words (a factor counts from ``window`` words on, so each of its windows is a
hit), but would move the words of all phrases instead of their digests.

Seeds that only one document has are dropped before texts move. Equal phrases are joined in each
task: only the one with the smallest id is sent. A window is known by two
64-bit digests of its own, besides its seed.

Null and empty texts have no words. A null id is not smaller than any other, so its document is never
a reference. Repeated rows and ties (equal ids) do not remove each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import NO_ID, mix, partitions, row_key, slices, table
from voltide.llm.packed import anchors, by_document, pack, part_of, rolling, runs_of, shared_anchors, spots_of, unpack
from voltide.llm.words import WORD, word_hashes

SEED = 5
#: Windows that a task gathers before it sends blocks.
RUN = 1_000_000
#: Windows that a block compares at a time; those of one seed stay together.
STEP = 100_000


def finder(window: int):
    reach = window - SEED + 1

    def find(part: pa.RecordBatch):
        values, starts = word_hashes(part.column("text"))
        padded = np.concatenate([values, np.zeros(reach + SEED, np.uint64)])
        order = rolling(padded, SEED)
        ends = np.repeat(starts[1:], np.diff(starts))
        place, first, last = anchors(order[: len(values) + reach], ends, window, reach)
        doc = np.searchsorted(starts, place, side="right") - 1
        owner = np.asarray(part.column("k1")).view(np.uint64)[doc]
        return order[place], owner, doc, np.stack([place, first, last], 1) - starts[doc][:, None]

    return find


def grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorting order, group of each sorted row) by the columns, the last one first."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


class Phrases:
    def __init__(self, parts: int):
        self.parts = parts
        self.clear()

    def clear(self) -> None:
        self.rows, self.keys, self.n, self.n_keys = [], [], 0, 0

    def add(self, seed, doc, first, count, digest, keys) -> None:
        self.rows.append((seed, doc + self.n_keys, first, count, digest))
        self.keys.append(keys)
        self.n_keys += len(keys)
        self.n += len(digest)

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        if not self.n:
            return
        seed, doc, first, count, digest = (np.concatenate([r[i] for r in self.rows]) for i in range(5))
        keys = np.concatenate(self.keys)
        ids = keys[doc, 0]
        starts = np.cumsum(count) - count
        # two signatures of a phrase: its windows in their order
        nth = (np.arange(len(digest)) - np.repeat(starts, count)).astype(np.uint64)
        sig = [np.add.reduceat(mix(digest[:, i] ^ mix(nth + np.uint64(salt))), starts) for i, salt in enumerate((1, 99))]
        sig = [s ^ mix(count.astype(np.uint64)) for s in sig]
        earliest = np.where(ids == NO_ID, np.iinfo(np.int64).max, ids)
        order, group = grouped(seed, *sig)
        least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, earliest[order])
        mine = np.empty(len(seed), np.int64)
        mine[order] = least[group]
        done = earliest > mine
        # one of the equal phrases with the smallest id is enough as a reference, but each waits for its answer
        part = (seed >> np.uint64(32)).astype(np.int64) * self.parts >> 32
        left = np.flatnonzero(~done)
        left = left[np.argsort(part[left], kind="stable")]
        for p, a, b in runs_of(part[left]):
            pick = left[a:b]
            used, doc_of = np.unique(doc[pick], return_inverse=True)
            windows = np.repeat(starts[pick] - (np.cumsum(count[pick]) - count[pick]), count[pick]) + np.arange(count[pick].sum())
            yield p, pack(seed=seed[pick], doc=doc_of.astype(np.uint32), first=first[pick].astype(np.uint32), count=count[pick].astype(np.uint8), digest=digest[windows], keys=keys[used])
        if done.any():
            docs, at = np.unique(doc[done], return_inverse=True)
            to = part_of(keys[docs], self.parts)
            spans = np.stack([first[done], first[done] + count[done] - 1], 1).astype(np.int32)
            order = np.argsort(to[at], kind="stable")
            for p, a, b in runs_of(to[at][order]):
                pick = order[a:b]
                used, doc_of = np.unique(at[pick], return_inverse=True)
                yield p, pack(done=True, doc=doc_of.astype(np.uint32), spans=spans[pick], keys=keys[docs[used]])


def factored(whole: pa.Table) -> pa.Table:
    """One reference block: the factors of all phrases with its seeds, by document."""
    out = []
    blocks = []
    for blob in whole.column("blob"):
        b = unpack(blob.as_py())
        if b.get("done"):
            out += by_document(b["doc"], b["spans"], b["keys"])
        else:
            blocks.append(b)
    if blocks:
        base = np.cumsum([0] + [len(b["keys"]) for b in blocks])
        keys = np.concatenate([b["keys"] for b in blocks])
        seed, first, count = (np.concatenate([b[c] for b in blocks]) for c in ("seed", "first", "count"))
        doc = np.concatenate([b["doc"].astype(np.int64) + s for b, s in zip(blocks, base)])
        digest = np.concatenate([b["digest"] for b in blocks])
        del blocks
        rank = np.where(keys[doc, 0] == NO_ID, np.iinfo(np.int64).max, keys[doc, 0])
        starts = np.cumsum(count, dtype=np.int64) - count
        by_seed = np.argsort(seed, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], seed[by_seed][1:] != seed[by_seed][:-1]]))
        before = np.concatenate([[0], np.cumsum(count[by_seed], dtype=np.int64)])
        # the first seed of each stretch of windows
        edges = edges[np.unique(before[edges] // STEP, return_index=True)[1]]
        docs, spans = [], []
        for a, b in zip(edges, [*edges[1:], len(by_seed)]):
            mine = by_seed[a:b]
            n = count[mine].astype(np.int64)
            phrase = np.repeat(mine, n)
            nth = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
            marks = digest[starts[phrase] + nth]
            order, group = grouped(marks[:, 0], marks[:, 1], seed[phrase])
            least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, group, rank[phrase[order]])
            hit = np.empty(len(phrase), bool)
            hit[order] = rank[phrase[order]] > least[group]
            # runs of hits inside a phrase are its factors
            w = np.flatnonzero(hit)
            if len(w):
                new = np.concatenate([[True], (w[1:] != w[:-1] + 1) | (phrase[w[1:]] != phrase[w[:-1]])])
                x = w[new]
                y = w[np.concatenate([np.flatnonzero(new)[1:], [len(w)]]) - 1]
                docs.append(doc[phrase[x]])
                spans.append(np.stack([first[phrase[x]] + nth[x], first[phrase[y]] + nth[y]], 1).astype(np.int32))
        if docs:
            out += by_document(np.concatenate(docs), np.concatenate(spans), keys)
    return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["k1", "k2", "span"])


def dedup(docs: DataFrame, *, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and ``spans`` (binaries of 32-bit pairs: first and last start of windows met earlier) of each row."""
    parts = partitions(docs.sparkSession)
    # both joins take all columns, so that the texts cross the network once
    rows = row_key(docs, id_col, text_col, F.col(id_col).cast("bigint").alias("id"))
    live = shared_anchors(rows.select("k1", "k2", "text"), finder(window), single=False)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(parts)

        def flush():
            out = list(phrases.blocks())
            phrases.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["part", "blob"])

        for part in slices(batches, limit=1 << 20):
            values, starts = word_hashes(part.column("text"))
            seeds = rolling(values, SEED)
            digests = np.stack([rolling(values, window, 0xD6E8FEB86659FD93), rolling(mix(values), window, 0xC2B2AE3D27D4EB4F)], 1)
            spots = [spots_of(b) + s for b, s in zip(part.column("spots").to_pylist(), starts)]
            doc = np.repeat(np.arange(len(spots)), [len(s) for s in spots])
            spots = np.concatenate(spots)
            count = spots[:, 2] - spots[:, 1] + 1
            windows = np.repeat(spots[:, 1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            keys = np.stack([np.asarray(part.column("k1")), np.asarray(part.column("k2"))], 1)
            phrases.add(seeds[spots[:, 0]], doc, spots[:, 1] - starts[doc], count, digests[windows], keys)
            if phrases.n > RUN:
                yield flush()
        yield flush()

    sent = rows.join(live, ["k1", "k2"]).mapInArrow(send, "part int, blob binary")
    found = sent.repartition(parts, "part").groupBy("part").applyInArrow(factored, "k1 bigint, k2 bigint, span binary")
    spans = found.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans"))
    return rows.join(spans, ["k1", "k2"], "left")


def report(window: int, texts: bool):
    from voltide.llm.suffix_dedup import removed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for row in part.to_pylist():
                words = WORD.findall(row["text"])
                spans = removed(len(words), row["spans"], window)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept = " ".join(kept + words[at:])
                out.append((row["id"], len(words), sum(b - a for a, b in spans), hashlib.sha256(kept.encode()).hexdigest(), *([[{"start": a, "end": b} for a, b in spans], kept] if texts else [])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"][: 6 if texts else 4]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds[: len(names)])], names=names)

    return run


def without_repeats(docs: DataFrame, *, window: int = 13) -> DataFrame:
    """As the query, with the removed spans (of words) and the remaining text of each row."""
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>, kept string"
    return dedup(docs, window=window).mapInArrow(report(window, True), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), window=13).mapInArrow(report(13, False), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM docs, unnest(range(1, len(ws) - 11)) AS t(i)),
earliest AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
hits AS (SELECT doc_id, i FROM windows JOIN earliest USING (k) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM hits, range(0, 13) AS r(o)),
words AS (SELECT doc_id, i, ws[i] AS w FROM docs, unnest(range(1, len(ws) + 1)) AS t(i)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS s FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
