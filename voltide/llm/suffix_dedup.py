"""Suffix-array dedup: which bytes lie in a string of ``length`` bytes that starts anywhere else, too.

The suffixes at the anchors of ``packed`` (windows of ``length`` bytes, choosing among ``REACH`` places) are
sorted by a distributed merge sort. A suffix is its ``length`` bytes to the right, then the bytes to the left
that its windows reach, backwards. Each task sorts runs of its suffixes, joins equal ones, and sends the
runs front-coded (length of the common prefix with the one before, and the rest), cut at splitters
taken from a sample. Each part merges its runs with a loser tree that knows the common prefixes: two
heads are only compared from where their known prefixes end, and not at all if these differ in length.

The merged order gives, for each suffix, its longest match: equal ones or a neighbour that shares all
``length`` bytes to the right and ``x`` to the left decide all windows up to ``x`` before it. Windows that
could only match a suffix with a shorter right part lie next to each other in the order; the task compares
their contents (128-bit digests), and where such a stretch touches the end of a part, the digests meet in
one more exchange. A splitter is a suffix of the corpus and ends the part before it, too, so neighbours
across a border are not missed.

Null and empty texts have no bytes and keep the digest of nothing. Texts shorter than ``length`` stay
whole. Repeated rows are copies of each other and lose what they share. Null ids are kept as they are.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import bytes_of, partitions, row_key, slices, table, written
from voltide.llm.packed import anchors, by_document, pack, rolling, runs_of, shared_anchors, spots_of, unpack

GRAM, REACH = 8, 256
#: Suffixes of one sorted run.
RUN = 60_000
PAD = b"\xff"  # no byte of UTF-8


def finder(length: int):
    context = length - REACH + 1

    def find(part: pa.RecordBatch):
        data, offsets = bytes_of(part.column("text"))
        size = np.diff(offsets)
        # a tail, so that hashes of full length exist at all places; no window reaches into it
        padded = np.concatenate([data, np.zeros(length + REACH + GRAM, np.uint8)])
        ends = np.repeat(offsets[1:], size)
        place, first, last = anchors(rolling(padded, GRAM)[: len(data) + REACH], ends, length, REACH)
        h = rolling(padded, context)[place]
        doc = np.searchsorted(offsets, place, side="right") - 1
        spots = np.stack([place, first, last], 1) - offsets[doc][:, None]
        return h, np.zeros(len(h), np.uint64), doc, spots

    return find


def suffixes(data: bytes, spots: np.ndarray, length: int) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
    """(suffix, (place, nearest, farthest window before it)) of a document's anchors."""
    for place, first, last in spots.tolist():
        yield data[place : place + length].ljust(length, PAD) + data[first:place][::-1], (place, place - last, place - first)


def common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix; the first ``at`` bytes are known to be equal."""
    n = min(len(a), len(b))
    while at < n:
        x, y = a[at : at + 48], b[at : at + 48]
        if x != y:
            for p, q in zip(x, y):
                if p != q:
                    return at
                at += 1
            return at
        at += len(x) if len(x) <= len(y) else len(y)
    return n


def front_coded(keys: list[bytes], refs: list[list[tuple]], docs: list[tuple[int, int]]) -> bytes:
    shared = [0] + [common(a, b, 0) for a, b in zip(keys, keys[1:])]
    flat = np.array([r for rs in refs for r in rs], np.int64).reshape(-1, 4)
    used, doc = np.unique(flat[:, 0], return_inverse=True)
    return pack(
        shared=np.array(shared, np.uint16), size=np.array([len(k) for k in keys], np.uint16), tails=b"".join(k[s:] for k, s in zip(keys, shared)),
        count=np.array([len(r) for r in refs], np.uint32), doc=doc.astype(np.uint32), spots=flat[:, 1:].astype(np.int32), docs=np.array([docs[i] for i in used], np.int64).reshape(-1, 2),
    )


class Run:
    """A front-coded run that is read from front to back."""

    def __init__(self, blob: bytes):
        x = unpack(blob)
        self.shared, self.size, self.tails = x["shared"].tolist(), x["size"].tolist(), x["tails"]
        ends = np.cumsum(x["count"])
        self.refs = [(int(e - c), int(e)) for c, e in zip(x["count"], ends)]
        self.doc, self.spots, self.docs = x["doc"], x["spots"], x["docs"]
        self.at, self.byte, self.key = -1, 0, b""
        self.next()

    def next(self) -> bool:
        """The next suffix; what it shares with the one before is known, not compared."""
        self.at += 1
        if self.at >= len(self.shared):
            self.key = None
            return False
        s = self.shared[self.at]
        n = self.size[self.at] - s
        self.key = self.key[:s] + self.tails[self.byte : self.byte + n]
        self.byte += n
        return True


class LoserTree:
    """Merges runs. Of each head it knows the prefix that it shares with the winner it last lost to or followed."""

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self.known = [0] * len(runs)
        self.width = 1
        while self.width < len(runs):
            self.width *= 2
        self.losers = [-1] * self.width
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.width:
            i = node - self.width
            return i if i < len(self.runs) else -1
        won, lost = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = lost
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's known prefix becomes the one it shares with the winner."""
        if a < 0 or self.runs[a].key is None:
            return b, a
        if b < 0 or self.runs[b].key is None:
            return a, b
        ka, kb = self.known[a], self.known[b]
        if ka != kb:
            return (a, b) if ka > kb else (b, a)
        x, y = self.runs[a].key, self.runs[b].key
        n = common(x, y, ka)
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            self.known[b] = n
            return a, b
        self.known[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[bytes, int, Run, int]]:
        """(suffix, prefix shared with the one before, its run, its place there)."""
        while self.winner >= 0 and self.runs[self.winner].key is not None:
            w = self.winner
            run = self.runs[w]
            yield run.key, self.known[w], run, run.at
            if run.next():
                self.known[w] = run.shared[run.at]
            node = (self.width + w) // 2
            while node:
                w, self.losers[node] = self._play(w, self.losers[node])
                node //= 2
            self.winner = w


def resolve(part: int, last_part: bool, blobs: list[bytes], sentinel: tuple | None, length: int):
    """Of one part: (k1, k2, first window, last window) found; windows by content that other parts may have,
    too; suffixes of a block that goes on in another part; what the blocks at the two ends share with the
    suffixes before and after them."""
    runs = [Run(b) for b in blobs]
    if sentinel is not None:
        key, (k1, k2, place, near, far) = sentinel
        runs.append(Run(front_coded([key], [[(0, place, near, far)]], [(k1, k2)])))
    keys: list[bytes] = []
    shared: list[int] = []
    refs: list[list[tuple]] = []
    for key, known, run, at in LoserTree(runs):
        a, b = run.refs[at]
        own = [(run.docs[d], s) for d, s in zip(run.doc[a:b].tolist(), run.spots[a:b].tolist())]
        if keys and known == len(key) == len(keys[-1]):
            refs[-1] += own
        else:
            keys.append(key)
            shared.append(known)
            refs.append(own)
    shared.append(0)
    found: list[tuple] = []
    for i, key in enumerate(keys):
        reach = len(key) - length if len(refs[i]) > 1 else max(shared[i], shared[i + 1]) - length
        for (k1, k2), (place, near, far) in refs[i]:
            if reach >= near:
                found.append((k1, k2, place - min(far, reach), place - near))
    # blocks of suffixes that share all ``length`` bytes to the right
    n = len(keys)
    edges = [0, *[i for i in range(1, n) if shared[i] < length], n]
    blocks = list(zip(edges, edges[1:]))
    left_cut, right_cut = part > 0, not last_part
    ends = (UNKNOWN if right_cut and len(blocks) == 1 else shared[blocks[0][1]], UNKNOWN if left_cut and len(blocks) == 1 else shared[blocks[-1][0]])
    # what each suffix shares with the first and the last one of the part
    to_first, to_last = [length] * n, [length] * n
    for i in range(1, n):
        to_first[i] = min(to_first[i - 1], shared[i])
        to_last[n - 1 - i] = min(to_last[n - i], shared[n - i])
    least = length - REACH + 1
    pending: list[tuple] = []
    border: dict[bytes, tuple] = {}
    seen: dict[bytes, tuple] = {}
    for x, (a, b) in enumerate(blocks):
        if shared[a] < least:
            seen.clear()
        cut = part if left_cut and x == 0 else part + 1 if right_cut and x == len(blocks) - 1 else -1
        outer = max(shared[a], shared[b])
        for m in range(a, b):
            (k1, k2), (place, near, far) = refs[m][0]
            if cut >= 0:
                pending.append((keys[m], k1, k2, place, near, far, cut))
                continue
            reach = max(to_first[m] if left_cut else 0, to_last[m] if right_cut else 0)
            for d in range(max(near, length - outer), far + 1):
                here = (k1, k2, place - d, place - d)
                mark = window_digest(keys[m], far, d, length)
                other = seen.setdefault(mark, here)
                if other is not here:
                    found += [other, here]
                if d >= length - reach:
                    # one window of each content speaks for all that this part has, as these know of each other
                    border.setdefault(mark, here)
    return found, border, pending, ends


#: A block that goes on beyond a part.
UNKNOWN = -1


def window_digest(key: bytes, far: int, d: int, length: int) -> bytes:
    """The content of the window that starts ``d`` bytes before the suffix."""
    return hashlib.blake2b(key[length : length + d][::-1] + key[: length - d], digest_size=16).digest()


def outer_of_cuts(ends: dict[int, tuple[int, int]], parts: int, length: int) -> list[int]:
    """For the block at each cut: what it shares at most with a suffix outside it. ``ends`` has, for each
    part, what its first block shares with the next and its last block with the one before."""
    out = [0] * (parts + 1)
    for cut in range(1, parts):
        p = cut - 1
        while p >= 0 and ends.get(p, (0, length - 1))[1] == UNKNOWN:
            p -= 1
        before = ends.get(p, (0, length - 1))[1] if p >= 0 else 0
        p = cut
        while p < parts and ends.get(p, (length - 1, 0))[0] == UNKNOWN:
            p += 1
        after = ends.get(p, (length - 1, 0))[0] if p < parts else 0
        out[cut] = max(before, after)
    return out


def packed_windows(windows: dict[bytes, tuple], parts: int) -> list[tuple[int, bytes]]:
    """Blocks of windows (digest to k1, k2, start, ...), cut by digest."""
    if not windows:
        return []
    marks = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, 2)
    refs = np.array([w[:3] for w in windows.values()], np.int64)
    part = (marks[:, 0] >> np.uint64(32)).astype(np.int64) * parts >> 32
    order = np.argsort(part, kind="stable")
    return [(p, pack(marks=marks[order[a:b]], refs=refs[order[a:b]])) for p, a, b in runs_of(part[order])]


def met_again(whole: pa.Table) -> pa.Table:
    """Of one part's windows those whose content stands at two places, as (k1, k2, span) by document."""
    blocks = [unpack(b.as_py()) for b in whole.column("blob")]
    marks, refs = (np.concatenate([b[c] for b in blocks]) for c in ("marks", "refs"))
    order = np.lexsort((*refs.T, *marks.T))
    marks, refs = marks[order], refs[order]
    same = (marks[1:] == marks[:-1]).all(axis=1)
    group = np.concatenate([[0], np.cumsum(~same)])
    twice = np.zeros(group[-1] + 1, bool)
    twice[group[1:][same & (refs[1:] != refs[:-1]).any(axis=1)]] = True
    refs = refs[twice[group]]
    keys, doc = np.unique(refs[:, :2], axis=0, return_inverse=True)
    out = list(by_document(doc.ravel(), refs[:, [2, 2]].astype(np.int32), keys))
    return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["k1", "k2", "span"])


def expander(outer: list[int], length: int, parts: int):
    """The windows of the blocks at the cuts: blocks (part, blob) with one of each content, and (k1, k2, span)
    of those that the task has met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        twice: dict[tuple, set] = {}
        for batch in batches:
            for r in batch.to_pylist():
                for d in range(max(r["near"], length - outer[r["cut"]]), r["far"] + 1):
                    here = (r["k1"], r["k2"], r["place"] - d)
                    other = seen.setdefault(window_digest(r["key"], r["far"], d, length), here)
                    if other != here:
                        for k1, k2, start in (other, here):
                            twice.setdefault((k1, k2), set()).add(start)
        out = [(p, blob, None, None, None) for p, blob in packed_windows(seen, parts)]
        out += [(None, None, *k, np.repeat(np.array(sorted(v), "<i4"), 2).tobytes()) for k, v in twice.items()]
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["part", "blob", "k1", "k2", "span"])

    return run


def dedup(docs: DataFrame, *, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, k1, k2, text and ``spans`` (binaries of 32-bit pairs: first and last start of repeated windows) of each row."""
    assert length > REACH + GRAM
    spark = docs.sparkSession
    rows = row_key(docs, id_col, text_col)
    parts = partitions(spark)
    live = shared_anchors(rows, finder(length), single=True)
    texts = written(rows.join(live, ["k1", "k2"]), "repeated")

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for row in part.to_pylist():
                spots = spots_of(row["spots"])
                pick = spots[row["k2"] % 7 :: max(1, len(spots) // 2)][:2]
                out += [(k, row["k1"], row["k2"], *s) for k, s in suffixes(row["text"].encode(), pick, length)]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["key", "k1", "k2", "place", "near", "far"])

    # only the cuts of the sort come from this sample
    n = texts.count()
    few = texts.sample(min(1.0, 12.0 * parts / max(n, 1)), seed=1).mapInArrow(sampled, "key binary, k1 bigint, k2 bigint, place int, near int, far int").collect()
    few = sorted({bytes(r["key"]): (bytes(r["key"]), tuple(r)[1:]) for r in few}.values())
    cuts = [few[len(few) * i // parts] for i in range(1, parts)] if len(few) >= parts else []
    bounds = [c[0] for c in cuts]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        refs: list[tuple] = []
        ids: list[tuple[int, int]] = []

        def flush():
            order = sorted(range(len(keys)), key=keys.__getitem__)
            one: list[bytes] = []
            all_refs: list[list[tuple]] = []
            for o in order:
                if one and one[-1] == keys[o]:
                    all_refs[-1].append(refs[o])
                else:
                    one.append(keys[o])
                    all_refs.append([refs[o]])
            at = [0, *[bisect.bisect_left(one, b) for b in bounds], len(one)]
            out = [(p, front_coded(one[a:b], all_refs[a:b], ids)) for p, (a, b) in enumerate(zip(at, at[1:])) if b > a]
            keys.clear(), refs.clear(), ids.clear()
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["part", "blob"])

        for part in slices(batches):
            for row in part.to_pylist():
                for key, spot in suffixes(row["text"].encode(), spots_of(row["spots"]), length):
                    keys.append(key)
                    refs.append((len(ids), *spot))
                    if len(keys) >= RUN:
                        ids.append((row["k1"], row["k2"]))
                        yield flush()
                ids.append((row["k1"], row["k2"]))
        yield flush()

    def merge(whole: pa.Table) -> pa.Table:
        p = whole.column("part")[0].as_py()
        found, border, pending, ends = resolve(p, p == len(cuts), whole.column("blob").to_pylist(), cuts[p] if p < len(cuts) else None, length)
        by_doc: dict[tuple, list] = {}
        for k1, k2, a, b in found:
            by_doc.setdefault((int(k1), int(k2)), []).append((a, b))
        out = [(0, None, *k, np.unique(np.array(v, "<i4"), axis=0).tobytes(), 0, 0, 0, 0) for k, v in by_doc.items()]
        out += [(1, key, int(k1), int(k2), None, *rest) for key, k1, k2, *rest in pending]
        out += [(3, blob, 0, 0, None, q, 0, 0, 0) for q, blob in packed_windows(border, parts)]
        out.append((2, None, 0, 0, None, p, *ends, 0))
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), *[pa.int32()] * 4)
        return pa.table([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["kind", "key", "k1", "k2", "span", "place", "near", "far", "cut"])

    sent = texts.mapInArrow(send, "part int, blob binary")
    met = written(sent.repartition(parts, "part").groupBy("part").applyInArrow(merge, "kind int, key binary, k1 bigint, k2 bigint, span binary, place int, near int, far int, cut int"), "matches")
    # one row for each part
    ends = {r["place"]: (r["near"], r["far"]) for r in met.where("kind = 2").select("place", "near", "far").collect()}
    outer = outer_of_cuts(ends, len(cuts) + 1, length)
    cut = met.where("kind = 1").select("key", "k1", "k2", "place", "near", "far", "cut")
    cut = written(cut.mapInArrow(expander(outer, length, parts), "part int, blob binary, k1 bigint, k2 bigint, span binary"), "cuts")
    border = met.where("kind = 3").select(F.col("place").alias("part"), F.col("key").alias("blob")).unionByName(cut.where(F.col("blob").isNotNull()).select("part", "blob"))
    border = border.repartition(parts, "part").groupBy("part").applyInArrow(met_again, "k1 bigint, k2 bigint, span binary")
    spans = met.where("kind = 0").select("k1", "k2", "span").unionByName(cut.where(F.col("span").isNotNull()).select("k1", "k2", "span")).unionByName(border)
    spans = spans.groupBy("k1", "k2").agg(F.collect_list("span").alias("spans"))
    return row_key(docs, id_col, text_col, F.col(id_col).cast("bigint").alias("id")).join(spans, ["k1", "k2"], "left")


def removed(size: int, blobs: list[bytes] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered units from the starts of repeated windows."""
    if not blobs:
        return []
    starts = np.frombuffer(b"".join(blobs), "<i4").reshape(-1, 2).astype(np.int64)
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts[:, 0], 1)
    np.add.at(change, np.minimum(starts[:, 1] + length, size), -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(change)[:size] > 0).astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def report(length: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for row in part.to_pylist():
                data = row["text"].encode()
                spans = removed(len(data), row["spans"], length)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                out.append((row["id"], len(data), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest(), *([[{"start": a, "end": b} for a, b in spans], kept] if texts else [])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"][: 7 if texts else 5]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds[: len(names)])], names=names)

    return run


def without_repeats(docs: DataFrame, *, length: int = 400) -> DataFrame:
    """As the query, with the removed spans and the remaining bytes of each row."""
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return dedup(docs, length=length).mapInArrow(report(length, True), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(table(spark, sf_dir, "documents"), length=400)
    return found.mapInArrow(report(400, False), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
