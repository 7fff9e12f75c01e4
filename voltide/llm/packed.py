"""Exchange of packed blocks, and the first step of the three exact duplicate searches: anchors.

An anchor stands for the windows that choose it: of the places a window of fixed length covers, it
takes the one with the least hash (the leftmost of equals). The choice depends on the window's content
alone, so equal windows choose the same place of it and share the context around it. Anchors whose
context occurs only once in the corpus therefore stand for windows without a partner, and
``shared_anchors`` drops them: each task sorts its anchors' context hashes, keeps those it has seen
with two owners (and sends one entry for all of them), and sends the others as compressed blocks, cut by
hash. What is left goes back to the documents in blocks, too, cut by document: no exchange has a row for
each document and part. Hashes only decide what may be dropped, so a collision costs time and never a result;
therefore ``SENT`` bits of them are enough.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.common import lean, lean_stream, mix, partitions

#: Anchors that a task gathers before it sends blocks.
RUN = 500_000
#: Bits of a context hash that are sent: of a thousand million different ones, one in a thousand meets another.
SENT = 40


def pack(**arrays) -> bytes:
    """Arrays as compressed bytes; the bytes of 64-bit numbers are stored plane by plane."""
    out = {}
    for name, a in arrays.items():
        if isinstance(a, np.ndarray):
            a = np.ascontiguousarray(a)
            out[name] = (a.dtype.str, a.shape, np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())
        else:
            out[name] = a
    return zstandard.compress(pickle.dumps(out, 5), 3)


def unpack(blob: bytes) -> dict:
    out = {}
    for name, x in pickle.loads(zstandard.decompress(blob)).items():
        if isinstance(x, tuple):
            kind, shape, data = x
            size = np.dtype(kind).itemsize
            x = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(shape)
        out[name] = x
    return out


def steps(h: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, whose upper bytes are zero."""
    return np.diff(h >> np.uint64(64 - SENT), prepend=np.uint64(0))


def rolling(values: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hashes (modulo 2**64) of all stretches of ``length`` values, scattered."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = np.full(len(values) + 1, base | 1, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    back = np.full(n, pow(base | 1, -1, 1 << 64), np.uint64)
    back[0] = 1
    return mix((sums[length:] - sums[:n]) * np.cumprod(back, dtype=np.uint64))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbouring values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:]) if len(values) > done else values[:0]
        done *= 2
    rest = width - done
    if rest:
        values = np.minimum(values[:-rest], values[rest:]) if len(values) > rest else values[:0]
    return values


def anchors(order: np.ndarray, ends: np.ndarray, window: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of all anchors of texts that stand one after another.

    ``order`` has a hash for each place; a window of ``window`` units that starts at ``i`` chooses among
    ``i .. i + reach - 1``. ``ends`` has, for each unit, the end of its text.
    """
    spot = (order & ~np.uint64(0xFFFFFFFF)) | np.arange(len(order), dtype=np.uint64)
    chosen = (least(spot, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = min(len(chosen), len(ends))
    start = np.flatnonzero(np.arange(n) + window <= ends[:n])
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    place = chosen[start]
    new = np.flatnonzero((place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new, [len(start)]]) - 1
    return place[first], start[first], start[last]


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Gathered:
    """What a task has found so far, and the blocks it sends."""

    def __init__(self, parts: int, single: bool):
        self.parts, self.single = parts, single
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.facts: list[bytes] = []
        self.n_keys = self.n = 0

    def add(self, h, owner, doc, spots, keys) -> None:
        """Context hashes, their owners, the document (an index into ``keys``) and the numbers of each anchor."""
        h = h & ~np.uint64((1 << (64 - SENT)) - 1)
        self.rows.append((h, owner, (doc + self.n_keys).astype(np.uint32), spots.astype(np.int32)))
        self.keys.append(keys)
        self.n_keys += len(keys)
        self.n += len(h)

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        keys = np.concatenate(self.keys) if self.keys else np.zeros((0, 2), np.int64)
        if self.facts:
            to = part_of(keys, self.parts)
            for p in np.unique(to):
                yield int(p), pack(keys=keys[to == p], fact=[self.facts[i] for i in np.flatnonzero(to == p)])
        if not self.n:
            return
        h, owner, doc, spots = (np.concatenate([r[i] for r in self.rows]) for i in range(4))
        self.rows.clear()
        order = np.lexsort((owner, h))
        h, owner, doc, spots = h[order], owner[order], doc[order], spots[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        last = np.concatenate([first[1:], [len(h)]]) - 1
        met = (last > first) if self.single else owner[first] != owner[last]
        part = (h >> np.uint64(32)).astype(np.int64) * self.parts >> 32
        here = met[group]
        for p, a, b in runs_of(part):
            open_ = a + np.flatnonzero(~here[a:b])
            heads = first[group[a] : group[b - 1] + 1]
            known = h[heads[met[group[a] : group[b - 1] + 1]]]
            used, doc_of = np.unique(doc[open_], return_inverse=True)
            owners = np.zeros(len(used), np.uint64)
            owners[doc_of] = owner[open_]  # all anchors of a document have one owner
            yield p, pack(steps=steps(h[open_]), owners=owners, doc=doc_of.astype(np.uint32), spots=spots[open_], keys=keys[used], known=steps(known))
        # the known ones go to the parts by document, so that none gets them all
        yield from dealt(doc[here], spots[here], keys, self.parts)


def runs_of(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of equal values in a sorted array."""
    edges = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]]) if len(x) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(x[a]), int(a), int(b)


def by_document(doc: np.ndarray, spots: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(doc, kind="stable")
    doc, spots = doc[order], spots[order]
    edges = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]])
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            k1, k2 = keys[doc[a]]
            yield int(k1), int(k2), spots[a:b].astype("<i4").tobytes()


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that gathers what belongs to a document; copies of a text are documents of their own."""
    k1, k2 = keys[:, 0].astype(np.uint64), keys[:, 1].astype(np.uint64)
    return (mix(k1 ^ mix(k2)) >> np.uint64(32)).astype(np.int64) * parts >> 32


def dealt(doc: np.ndarray, spots: np.ndarray, keys: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Blocks (part, blob) of anchors, cut by document."""
    used, at = np.unique(doc, return_inverse=True)
    to = part_of(keys[used], parts)
    order = np.lexsort((at, to[at]))
    for p, a, b in runs_of(to[at[order]]):
        pick = order[a:b]
        mine, n = np.unique(at[pick], return_counts=True)
        yield p, pack(count=n.astype(np.uint32), spots=spots[pick], keys=keys[used[mine]])


def part_table(out: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["part", "blob"])


def known_twice(blocks: list[dict], low: int, high: int, single: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(block, its anchors whose context has been met with two owners), for contexts of ``low`` to below ``high``."""
    edges = [np.searchsorted(b["h"], np.array([low, high], np.uint64)) for b in blocks]
    known = np.unique(np.concatenate([b["known"][slice(*np.searchsorted(b["known"], np.array([low, high], np.uint64)))] for b in blocks]))
    h = np.concatenate([b["h"][x:y] for b, (x, y) in zip(blocks, edges)])
    if not len(h):
        return
    owner = np.concatenate([b["owners"][b["doc"][x:y]] for b, (x, y) in zip(blocks, edges)])
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(h)]]) - 1
    met = (last > first) if single else owner[first] != owner[last]
    met |= np.isin(h[first], known)
    live = np.zeros(len(h), bool)
    live[order] = met[np.cumsum(new) - 1]
    done = 0
    for k, (x, y) in enumerate(edges):
        yield k, x + np.flatnonzero(live[done : done + y - x])
        done += y - x


def merged(parts: int, single: bool):
    """For one part: blocks of the anchors whose context has been met with two owners, cut by document. Contexts are sorted
    a stretch of hashes at a time, of about ``RUN`` anchors."""

    def run(whole: pa.Table) -> pa.Table:
        p = whole.column("part")[0].as_py()
        blocks, out = [], []
        for blob in whole.column("blob"):
            blob = blob.as_py()
            b = unpack(blob)
            if "steps" in b:
                b |= {"h": np.cumsum(b.pop("steps"), dtype=np.uint64), "known": np.cumsum(b["known"], dtype=np.uint64)}
                blocks.append(b)
            else:
                # cut by document already
                out.append((p, blob))
        heads = [b["h"] for b in blocks if len(b["h"])]
        if heads:
            low, high = min(int(h[0]) for h in heads), max(int(h[-1]) for h in heads) + 1
            n = -(-sum(map(len, heads)) // RUN)
            base = np.cumsum([0] + [len(b["keys"]) for b in blocks])
            docs, spots = [], []
            for i in range(n):
                for k, live in known_twice(blocks, low + (high - low) * i // n, low + (high - low) * (i + 1) // n, single):
                    docs.append((blocks[k]["doc"][live] + base[k]).astype(np.uint32))
                    spots.append(blocks[k]["spots"][live])
            keys = np.concatenate([b["keys"] for b in blocks])
            blocks.clear()
            out += dealt(np.concatenate(docs), np.concatenate(spots), keys, parts)
        return part_table(out)

    return run


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key, the different keys)."""
    order = np.lexsort(keys.T)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]).any(axis=1)
    number = np.empty(len(s), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, s[new]


def by_key(whole: pa.Table) -> pa.Table:
    """(k1, k2, spots) of the documents of one part."""
    blocks = [unpack(b.as_py()) for b in whole.column("blob")]
    number, keys = numbered(np.concatenate([b["keys"] for b in blocks]))
    doc = np.repeat(number, np.concatenate([b["count"] for b in blocks]))
    spots = np.concatenate([b["spots"] for b in blocks])[np.argsort(doc, kind="stable")]
    ends = np.cumsum(np.bincount(doc, minlength=len(keys))) * spots.itemsize * spots.shape[1]
    blobs = pa.Array.from_buffers(pa.large_binary(), len(keys), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(spots.astype("<i4"))])
    return pa.table([pa.array(keys[:, 0]), pa.array(keys[:, 1]), blobs.cast(pa.binary())], names=["k1", "k2", "spots"])


def facts_by_key(whole: pa.Table) -> pa.Table:
    """(k1, k2, fact, found) of the rows of one part: ``found`` anchors are shared."""
    blocks = [unpack(b.as_py()) for b in whole.column("blob")]
    number, keys = numbered(np.concatenate([b["keys"] for b in blocks]))
    n = np.concatenate([b.get("count", np.zeros(len(b["keys"]))) for b in blocks])
    found = np.bincount(number, n, len(keys)).astype(np.int64)
    fact = np.concatenate([np.full(len(b["keys"]), "fact" in b) for b in blocks])
    rows = keys[number[fact]]
    return pa.table([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array([f for b in blocks for f in b.get("fact", ())], pa.binary()), pa.array(found[number[fact]])], names=["k1", "k2", "fact", "found"])


def shared_anchors(rows: DataFrame, find: Callable[[pa.RecordBatch], Found], *, single: bool, facts: bool = False) -> DataFrame:
    """(k1, k2, spots) of the anchors whose context occurs with at least two owners.

    ``rows`` has k1, k2, text; ``find`` returns for a slice of them (context hash, owner, row, three
    numbers) of its anchors. ``single``: each occurrence is an owner of its own. ``spots`` is a
    binary with three 32-bit numbers an anchor. With ``facts``, ``find`` also returns a binary for each
    row and no numbers of anchors; the result is then (k1, k2, fact, found) of each row, ``found`` being
    the number of such anchors that its key has.
    """
    from voltide.llm.common import slices

    parts = partitions(rows.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Gathered(parts, single)

        def flush():
            out = part_table(list(gathered.blocks()))
            gathered.clear()
            return out.to_batches()

        for part in slices(batches, limit=1 << 20):
            h, owner, doc, spots, *fact = find(part)
            keys = np.stack([np.asarray(part.column("k1")), np.asarray(part.column("k2"))], 1)
            gathered.add(h, owner, doc, spots, keys)
            gathered.facts += fact[0] if fact else []
            if gathered.n > RUN:
                yield from flush()
        yield from flush()

    blocks = rows.mapInArrow(lean_stream(send), "part int, blob binary")
    live = blocks.repartitionById(parts, "part").groupBy("part").applyInArrow(lean(merged(parts, single)), "part int, blob binary").repartitionById(parts, "part").groupBy("part")
    return live.applyInArrow(lean(facts_by_key), "k1 bigint, k2 bigint, fact binary, found bigint") if facts else live.applyInArrow(lean(by_key), "k1 bigint, k2 bigint, spots binary")


def spots_of(blob: bytes) -> np.ndarray:
    """The anchors of one document, in order, without repeats."""
    return np.unique(np.frombuffer(blob, "<i4").reshape(-1, 3), axis=0).astype(np.int64)
