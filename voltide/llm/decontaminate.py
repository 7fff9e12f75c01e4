"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into overlapping segments of ``SEGMENT`` characters (a shorter item is one
segment). A region of a document matches a segment if their edit distance is at most ``m // RATE``. By
the q-gram lemma such a region shares at least ``m - Q + 1 - k * Q`` q-grams with the segment, all
within ``k + 1`` neighbouring diagonals; shared q-grams are counted in overlapping bands of diagonals,
bands that reach the bound are kept, and a banded alignment verifies them. Fixed segments start every
``SEGMENT // 2`` characters. Where none of an item matches, every stretch of ``SEGMENT`` characters of it is
tried in the same way: its q-grams are those of the fixed segments. Items for which the bound is not
positive (20 to 23 characters) are filtered by grams of ``SHORT`` characters, of which one edit leaves one.

``edits`` is the least of the fixed segments that match and ``n_segments`` their number; where only stretches
between them match, it is the least of those, and ``n_segments`` is 0. Both sides are lower-cased and their white space is folded to single blanks. Items are taken in blocks
of about ``block_chars`` characters, so what a task holds is bounded however large the benchmark is;
each block meets all documents. Items shorter than ``Q`` characters are too short to be evidence and
never match. An item without an id cannot be reported, but ``clean`` removes the documents that hold it. Null and empty texts match nothing; repeated rows, ties and null ids are treated alike;
an empty benchmark or table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import mix, slices, table

Q, SHORT, SEGMENT, RATE = 12, 10, 64, 20
BITS = 24
#: Characters whose grams are hashed and looked up at a time; only the size of temporary arrays.
STEP = 1 << 17
SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    return SPACE.sub(" ", (text or "").lower()).strip()


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams (``SHORT`` or ``Q`` characters), by doubling."""
    c = codes.astype(np.uint64) + np.uint64(1)
    prime = [np.uint64(pow(0x100000001B3, 1 << i, 1 << 64)) for i in range(3)]
    h2 = c[:-1] * prime[0] + c[1:]
    h4 = h2[:-2] * prime[1] + h2[2:]
    h8 = h4[:-4] * prime[2] + h4[4:]
    n = len(codes) - q + 1
    return mix(h8[:n] * prime[2] + (h4 if q == Q else h2)[8 : 8 + n])


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def bound(size, q: int):
    """How many grams a segment shares with a region within its edits, at least."""
    return size - q + 1 - size // RATE * q


class Index:
    """The segments of some items and where their q-grams stand."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q):
        self.q = q
        self.segments: list[tuple[int | None, np.ndarray]] = []
        self.texts: list[tuple[int | None, np.ndarray]] = []
        hashes, owner, at, text_of, start, short = [], [], [], [], [], []
        for item, text in items:
            codes = codes_of(normal(text))
            if len(codes) < Q:
                continue
            if q == Q and bound(len(codes), Q) <= 0:
                short.append((item, text))
                continue
            last = max(0, len(codes) - SEGMENT)
            for s in sorted({*range(0, last, SEGMENT // 2), last}):
                seg = codes[s : s + SEGMENT]
                h = grams(seg, q)
                hashes.append(h)
                owner.append(np.full(len(h), len(self.segments)))
                at.append(np.arange(len(h)))
                text_of.append(len(self.texts))
                start.append(s)
                self.segments.append((item, seg))
            self.texts.append((item, codes))
        #: The items whose edits may leave no gram of ``Q`` characters.
        self.short = Index(short, SHORT) if short else None
        self.text_of, self.start = np.array(text_of, np.int64), np.array(start, np.int64)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.h, self.owner, self.at = h[order], cat(owner, np.int64)[order], cat(at, np.int64)[order]
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.h >> np.uint64(64 - BITS)).astype(np.int64)] = True
        self.size = np.array([len(s) for _, s in self.segments], np.int64)
        self.edits = self.size // RATE

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(segment, place in the segment, place in ``codes``) of all shared grams."""
        found = []
        for start in range(0, len(codes) - self.q + 1, STEP):
            h = grams(codes[start : start + STEP + self.q - 1], self.q)
            hit = np.flatnonzero(self.seen[(h >> np.uint64(64 - BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.h, h[hit], "left"), np.searchsorted(self.h, h[hit], "right")
            n = hi - lo
            found.append(np.stack([hit[n > 0] + start, lo[n > 0], n[n > 0]]))
        hit, lo, n = np.concatenate(found, 1)
        entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.owner[entry], self.at[entry], np.repeat(hit, n)

    def regions(self, hits: tuple[np.ndarray, np.ndarray, np.ndarray], doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, segment, lowest diagonal of the band) of the bands that reach the bound."""
        seg, at, pos = hits
        if not len(seg):
            return
        diagonal = pos - at + SEGMENT
        k = self.edits[seg]
        least = bound(self.size[seg], self.q)
        step = k + 1
        # two neighbouring steps make a band, so the diagonals of any region lie inside one band
        band = diagonal // step
        key = np.concatenate([np.stack([seg, band], 1), np.stack([seg, band - 1], 1)])
        distinct, first, count = np.unique(key, axis=0, return_index=True, return_counts=True)
        ok = count >= np.concatenate([least, least])[first]
        where = np.concatenate([pos, pos])[first]
        for (s, b), p in zip(distinct[ok], where[ok]):
            yield int(doc[p]), int(s), int(b * (self.edits[s] + 1) - SEGMENT)

    def stretches(self, hits: tuple[np.ndarray, np.ndarray, np.ndarray], doc: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(document, text of an item, starts in it, lowest diagonal of each one's band): of each document and longer text
        all stretches of ``SEGMENT`` characters whose shared grams in a band reach the bound."""
        seg, at, pos = hits
        long = np.array([len(t) for _, t in self.texts], np.int64) > SEGMENT
        k, span, least = SEGMENT // RATE, SEGMENT - self.q, int(bound(SEGMENT, self.q))
        keep = long[self.text_of[seg]] if len(seg) else np.zeros(0, bool)
        seg, at, pos = seg[keep], at[keep], pos[keep]
        # segments overlap, so a gram of a text may have been met in several of them
        rows = np.unique(np.stack([self.text_of[seg], pos, self.start[seg] + at], 1), axis=0)
        text, pos, at = rows.T
        band = (pos - at) // (k + 1)
        text, pos, at = (np.concatenate([a, a]) for a in (text, pos, at))
        band = np.concatenate([band, band - 1])
        order = np.lexsort([at, band, text])
        text, pos, at, band = text[order], pos[order], at[order], band[order]
        # the bound is reached between a shared gram and the one that comes least - 1 later
        a = np.arange(max(0, len(at) - least + 1))
        b = a + least - 1
        a = a[(text[a] == text[b]) & (band[a] == band[b]) & (at[b] - at[a] <= span)]
        b = a + least - 1
        size = np.array([len(t) for _, t in self.texts], np.int64)
        low, high = np.maximum(at[b] - span, 0), np.minimum(at[a], size[text[a]] - SEGMENT)
        # a start is tried with the first gram that it holds
        before = np.where((a > 0) & (text[a - 1] == text[a]) & (band[a - 1] == band[a]) & (doc[pos[a - 1]] == doc[pos[a]]), at[a - 1] + 1, 0)
        low = np.maximum(low, before)
        n = np.maximum(high - low + 1, 0)
        start = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found = np.stack([np.repeat(doc[pos[a]], n), np.repeat(text[a], n), start, np.repeat(band[a] * (k + 1), n) + start], 1)
        found = np.unique(found, axis=0)
        edge = np.flatnonzero((found[1:, :2] != found[:-1, :2]).any(axis=1)) + 1
        for x, y in zip([0, *edge], [*edge, len(found)]):
            if y > x:
                yield int(found[x, 0]), int(found[x, 1]), found[x:y, 2], found[x:y, 3]

    def nearest(self, text: np.ndarray, t: int, starts: np.ndarray, lows: np.ndarray) -> int:
        """The least edit distance of the stretches at ``starts`` of item text ``t`` to regions that start within their bands."""
        k, best = SEGMENT // RATE, SEGMENT
        width = 2 * (k + 1) + 2 * k + 1
        col, far = np.arange(width), SEGMENT + 1
        for x in range(0, len(starts), 2000):
            part = self.texts[t][1][starts[x : x + 2000, None] + np.arange(SEGMENT)]
            place = (lows[x : x + 2000] - k)[:, None] + np.arange(SEGMENT + width + 1)
            inside = (place >= 0) & (place <= len(text))
            padded = np.where((place >= 0) & (place < len(text)), text[np.clip(place, 0, len(text) - 1)], np.uint32(0xFFFFFFFF))
            row = np.where(inside[:, :width], 0, far)
            for i in range(SEGMENT):
                same = row + (padded[:, i : i + width] != part[:, i : i + 1])
                gone = np.concatenate([row[:, 1:], np.full((len(row), 1), far)], 1) + 1
                new = np.where(inside[:, i + 1 : i + 1 + width], np.minimum(same, gone), far)
                row = np.minimum.accumulate(new - col, axis=1) + col
            best = min(best, int(row.min()))
        return best

    def distance(self, text: np.ndarray, s: int, low: int) -> tuple[int, int]:
        """The least edit distance of segment ``s`` to a region that starts within the band, and where it ends."""
        seg, k = self.segments[s][1], int(self.edits[s])
        first, width = low - k, 2 * (k + 1) + 2 * k + 1
        far = len(seg) + 1
        col = np.arange(width)
        inside = lambda i: (first + i + col >= 0) & (first + i + col <= len(text))
        row = np.where(inside(0), 0, far)  # a region may start anywhere in the band
        padded = np.full(len(seg) + width + 1, 0xFFFFFFFF, np.uint32)
        a, b = max(first, 0), min(first + len(padded), len(text))
        if b > a:
            padded[a - first : b - first] = text[a:b]
        for i, c in enumerate(seg):
            # the column of row i + 1 stands one character further to the right
            same = row + (padded[i : i + width] != c)
            gone = np.append(row[1:], far) + 1
            new = np.where(inside(i + 1), np.minimum(same, gone), far)
            row = np.minimum.accumulate(new - col) + col
        end = int(row.argmin())
        return int(row[end]), first + len(seg) + end


def leaks(index: Index, texts: list[str], *, every_start: bool = False) -> list[list[tuple[int, int, int]]]:
    """For each normalised text (item, least edits, segments that match), by item; with ``every_start`` also the items
    of which only a stretch between the fixed segments matches, with 0 segments."""
    out: list[dict[int | None, list[int]]] = [{} for _ in texts]
    # with so wide a gap, hits of two texts never share a band
    gap = "\0" * SEGMENT
    whole = codes_of("".join(t + gap for t in texts))
    if len(whole) >= index.q and len(index.segments):
        size = np.array([len(t) for t in texts])
        ends = np.cumsum(size + SEGMENT)
        starts = ends - size - SEGMENT
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), ends - starts)
        done: dict[tuple[int, int], tuple[int, int]] = {}
        hits = index.hits(whole)
        for d, s, low in index.regions(hits, doc):
            edits, _ = index.distance(whole[starts[d] : starts[d] + size[d]], s, low - int(starts[d]))
            if edits <= index.edits[s]:
                done[d, s] = min(done.get((d, s), (edits, 0)), (edits, 0))
        for (d, s), (edits, _) in done.items():
            best = out[d].setdefault(index.segments[s][0], [edits, 0])
            best[0], best[1] = min(best[0], edits), best[1] + 1
        met = [set(x) for x in out]
        for d, t, at, low in index.stretches(hits, doc) if every_start else ():
            item = index.texts[t][0]
            if item not in met[d]:
                edits = index.nearest(whole[starts[d] : starts[d] + size[d]], t, at, low - int(starts[d]))
                if edits <= SEGMENT // RATE:
                    best = out[d].setdefault(item, [edits, 0])
                    best[0] = min(best[0], edits)
    if index.short is not None:
        for x, more in zip(out, leaks(index.short, texts)):
            for item, edits, n in more:
                best = x.setdefault(item, [edits, 0])
                best[0], best[1] = min(best[0], edits), best[1] + n
    return [sorted(((i, e, n) for i, (e, n) in x.items()), key=lambda r: (r[0] is None, r)) for x in out]


def item_blocks(benchmark: DataFrame, block_chars: int, *, unnamed: bool = False) -> Iterator[Index]:
    """The items, some at a time: each block is read when its turn comes. ``unnamed`` adds those without an id."""
    items = benchmark.where((F.col("item_id").isNotNull() | F.lit(unnamed)) & F.col("text").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // block_chars)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        yield Index(sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r)))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, edits, n_segments) of each document and benchmark item that it holds."""
    schema = "doc_id bigint, item_id bigint, edits int, n_segments int"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def finder(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, limit=4 << 20):
                found = leaks(index, [normal(t) for t in part.column("text").to_pylist()], every_start=True)
                hits = [(d, *x) for d, xs in zip(part.column("doc_id").to_pylist(), found) for x in xs]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in hits], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "edits", "n_segments"])

        return run

    frames = [rows.mapInArrow(finder(index), schema) for index in item_blocks(benchmark, block_chars)]
    return reduce(DataFrame.unionByName, frames) if frames else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, *, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""

    def keeper(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, limit=4 << 20):
                found = leaks(index, [normal(t) for t in part.column("text").to_pylist()], every_start=True)
                yield part.filter(pa.array([not x for x in found]))

        return run

    for index in item_blocks(benchmark, block_chars, unnamed=True):
        docs = docs.mapInArrow(keeper(index), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
