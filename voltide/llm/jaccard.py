"""N-gram Jaccard join by a token-group matrix.

Two documents link when the sets of their ``n``-word shingles have a Jaccard similarity of at least
``percent`` hundredths. Equal sets are one class; the join runs over the different sets.

1. Sets that can have a partner. In any order of the tokens, two linked sets share ``l`` tokens among
   their first ``size - ceil(t * size) + l`` (prefix filter with ``l = size // 10 + 1``). The order puts
   tokens that are common in a bounded sample last. Sets with too few prefix tokens that another set
   has in its prefix, too, drop out before anything else moves.
2. Groups. Each set is compared with the up to ``OWNERS`` sets that own most of its tokens first. Sets with
   few tokens of their own come first: of many near copies, the one that differs least from the others
   owns the tokens of all. Linked sets are a group, and no pair inside it is looked at again. The same
   exchange tells which tokens more than ``COMMON`` sets have, exactly.
3. The matrix. For each group the union of its members' prefix tokens is kept, in the order that puts
   those common tokens last; the overlap of a query with a group is bounded by what they share. Only
   qualifying groups of other sets are opened, by the members of the smaller one of two groups: they come
   in blocks of ``BLOCK`` members with the union of all their tokens, a query must overlap the union by
   ``t * size``, and is then compared with the members exactly, up to the first link of the two groups:
   as groups are connected, further ones tell nothing new.
4. Classes of links are connected components (alternating large and small stars), of sets within
   groups and of groups within classes.

A query only meets the groups it qualifies for, hot groups are spread over blocks, the queries of a hot
block over its copies of ``ASKING`` queries each, and queries stream through a block, so no task holds a whole group. Tokens are 64-bit hashes of the words.

Null and empty texts have an empty set and link with nothing; a text with fewer than ``n`` words has
one shingle. Repeated rows and copies share a class. The class id is the smallest id in it; null
ids count only where a class has no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import NO_ID, few_files, lean, lean_stream, mix, partitions, row_key, slices, table, written
from voltide.llm.packed import pack, part_table, rolling, runs_of, shared_anchors, unpack
from voltide.llm.words import word_hashes

BLOCK = 64
ASKING = 1024
#: Share of a set, in tenths, that the prefixes of groups are longer than they must be: the longer, the fewer candidates.
TENTHS = 3
#: Sets that a set is compared with first; and as many own a token.
OWNERS = 3
#: A token that more sets than this have comes last in the order of the second prefix filter.
COMMON = 40
#: Of the bitmap that tells which texts may have a partner: 1 MB.
BITS = 1 << 23


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    values, starts = word_hashes(texts, lower=True)
    all_ = rolling(values, n)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= n:
            out.append(np.unique(all_[a : b - n + 1]))
        elif b > a:
            out.append(rolling(values[a:b], int(b - a), 0xA24BAED4963EE407) + np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def at_least(size: int, percent: int) -> int:
    return -(-size * percent // 100)


def matches(size: int, tenths: int = 1) -> int:
    return size * tenths // 10 + 1


def prefix(tokens: np.ndarray, hot: np.ndarray, percent: int, tenths: int = 1) -> np.ndarray:
    """The first tokens of a set in the common order: rare ones by hash, then those of ``hot`` by hash."""
    size = len(tokens)
    if not size:
        return tokens
    take = min(size, size - at_least(size, percent) + matches(size, tenths))
    common = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens if len(hot) else np.zeros(size, bool)
    return np.concatenate([tokens[~common], tokens[common]])[:take]


def shared(size: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int, tenths: int) -> np.ndarray:
    """How many tokens the prefixes of a set and of a linked one of ``low`` to ``high`` tokens share at least. Of the overlap
    ``o`` only what stands behind a prefix can be missing, and the overlap is met in the same order from both sides:
    the less of ``o - at_least(s) + matches(s)`` of the two. For the other one this is taken without rounding, where it
    is linear in its size, so that it is least at one end."""
    low, high = np.maximum(low, at_least(size, percent)), np.minimum(high, size * 100 // percent)
    overlap = -(-percent * (size + low) // (100 + percent))
    own = overlap - np.maximum(0, at_least(size, percent) - matches(size, tenths))
    unit = 1000 * (100 + percent)
    other = [(1000 * percent * (size + s) + (100 + percent) * (100 * tenths - 10 * percent) * s - unit) // unit + 1 for s in (low, high)]
    return np.minimum(np.minimum(overlap, own), np.minimum(*other))


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def common_tokens(docs: DataFrame, n: int, sample_docs: int) -> np.ndarray:
    """Tokens that at least 3 in ``sample_docs`` sampled documents have; a bounded list."""
    ids = docs.select("k1", "k2").distinct().orderBy(F.xxhash64("k1", "k2")).limit(sample_docs)
    # at most sample_docs ids: the size of the broadcast is bounded
    chosen = docs.join(F.broadcast(ids), ["k1", "k2"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=1 << 20):
            for s in shingle_sets(part.column("text"), n):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["h"])

    counts = chosen.distinct().mapInArrow(lean_stream(run), "h bigint").groupBy("h").count().where("count >= 3")
    top = counts.orderBy(F.desc("count"), "h").limit(200_000).select("h").toPandas()["h"].to_numpy(np.int64)
    return np.sort(top.view(np.uint64))


def components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b), root being the least node, by alternating stars."""
    current = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark, size = None, current.count()
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = small.select("u", F.col("m").alias("v"))
        current = written(few_files(moved.unionByName(kept).distinct(), size), "edges")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == mark:
            break
        mark, size = state, state[0]
    else:
        raise RuntimeError("the components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def possible(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose k2 may be among those of ``wanted``, told by a bitmap of ``BITS`` bits: the same for any input, broadcast
    in pieces of 4 KB. It only keeps texts that no one asks for off the network; a join decides."""
    bit = F.pmod("k2", F.lit(BITS)) + 1
    bitmap = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    at = F.bitmap_bit_position(bit).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bitmap), "bucket").where(F.getbit(byte, at % 8) == 1).select(*rows.columns)


class Postings:
    """Prefix tokens of a task's sets, sent to the parts that own them."""

    def __init__(self, parts: int):
        self.parts = parts
        self.clear()

    def clear(self) -> None:
        self.h: list[np.ndarray] = []
        self.sets: list[tuple] = []
        self.n = 0

    def add(self, tokens: np.ndarray, *row) -> None:
        self.h.append(tokens)
        self.sets.append(row)
        self.n += len(tokens)

    def blocks(self) -> pa.Table:
        out = []
        if self.n:
            h = np.concatenate(self.h)
            at = np.repeat(np.arange(len(self.h)), [len(x) for x in self.h])
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            part = (h >> np.uint64(32)).astype(np.int64) * self.parts >> 32
            edge = np.searchsorted(part, np.arange(self.parts + 1))
            for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
                if b > a:
                    used, local = np.unique(at[a:b], return_inverse=True)
                    out.append((p, pack(h=h[a:b], at=local.astype(np.uint32), sets=np.array([self.sets[i] for i in used], np.int64))))
        self.clear()
        return part_table(out)


def postings(whole: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sets, tokens, token of each entry, set of each entry) of one part; tokens of a single entry are left out."""
    sets, hs, ats, n = [], [], [], 0
    for blob in whole.column("blob"):
        b = unpack(blob.as_py())
        hs.append(b["h"])
        ats.append(b["at"].astype(np.int64) + n)
        sets.append(b["sets"])
        n += len(b["sets"])
    h, at = np.concatenate(hs), np.concatenate(ats)
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
    h, at = h[many], at[many]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    return np.concatenate(sets), h[new], np.cumsum(new) - 1, at


def short(name: bytes) -> int:
    """The number that stands for a set or group while candidates are counted. Two that shared one would
    share their candidates, too: more to compare, nothing lost."""
    return int.from_bytes(name[:8], "little", signed=True)


def names_of(numbers: np.ndarray, known: np.ndarray | None = None) -> pa.Array:
    """``short`` turned back to the first 8 bytes of the name; null where not ``known``."""
    raw = numbers.astype("<i8").tobytes()
    return pa.array([raw[i : i + 8] if known is None or known[i // 8] else None for i in range(0, len(raw), 8)], pa.binary())


def to_sets(parts: int, sets: np.ndarray, **columns: np.ndarray) -> list[tuple[int, bytes]]:
    """Blocks (part, blob) of rows about ``sets``, cut by set."""
    to = (mix(sets.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) * parts >> 32
    order = np.lexsort((sets, to))
    return [(p, pack(set=sets[order[a:b]], **{k: v[order[a:b]] for k, v in columns.items()})) for p, a, b in runs_of(to[order])]


def totals(blocks: list[dict], other: str) -> tuple[np.ndarray, ...]:
    """(set, other, sum of n, row of the first) over blocks, sorted by set and other."""
    a, b, n = (np.concatenate([x[k] for x in blocks]) for k in ("set", other, "n"))
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[first], b[first], np.add.reduceat(n.astype(np.int64), first), order[first]


def first_owners(parts: int):
    """For each set of one part: how many of its tokens each first owner has (the ``OWNERS`` sets with the token that have
    the least share of tokens of their own), and which of its tokens more than ``COMMON`` sets have; blocks cut by set."""

    def run(whole: pa.Table) -> pa.Table:
        sets, tokens, group, at = postings(whole)
        names, one, rank = np.unique(sets[:, 0], return_index=True, return_inverse=True)
        place = np.empty(len(names), np.int64)
        place[np.lexsort((names, sets[one, 1]))] = np.arange(len(names))
        has = rank[at]
        order = np.lexsort((place[has], group))
        n = np.bincount(group, minlength=len(tokens))
        start = np.cumsum(n) - n
        pairs: list[np.ndarray] = []
        for k in range(OWNERS):
            there = n[group] > k
            a, b = has[there], has[order[start[group[there]] + k]]
            before = place[b] < place[a]
            pairs = [_summed([*pairs, a[before] * len(names) + b[before]])]
        flat = pairs[0]
        out = to_sets(parts, names[flat["k"] // len(names)], owner=names[flat["k"] % len(names)], n=flat["n"].astype(np.uint32))
        hot = n[group] > COMMON
        return part_table(out + to_sets(parts, sets[at[hot], 0], hot=tokens[group[hot]]))

    return run


def best_owner(whole: pa.Table) -> pa.Table:
    """(a, b, n, hot) of each set of one part: up to ``OWNERS`` first owners with most of its tokens and their number, a row
    each; in a row of their own its common tokens."""
    blocks = [unpack(b.as_py()) for b in whole.column("blob")]
    pairs, hots = [b for b in blocks if "owner" in b], [b for b in blocks if "hot" in b]
    a = b = n = np.zeros(0, np.int64)
    common = {}
    if pairs:
        a, b, n, _ = totals(pairs, "owner")
        order = np.lexsort((-b, -n, a))
        a, b, n = a[order], b[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        best = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a)))) < OWNERS
        a, b, n = a[best], b[best], n[best]
    if hots:
        of, tokens = (np.concatenate([x[k] for x in hots]) for k in ("set", "hot"))
        order = np.argsort(of, kind="stable")
        common = {k: tokens[order[x:y]].tobytes() for k, x, y in runs_of(of[order])}
    sets = np.concatenate([a, np.array([*common], np.int64)])
    owned = np.arange(len(sets)) < len(a)
    more = [0] * len(common)
    return pa.table([names_of(sets), names_of(np.concatenate([b, np.array(more, np.int64)]), owned), pa.array([*n.tolist(), *more], pa.int64()), pa.array([None] * len(a) + [*common.values()], pa.binary())], names=["a", "b", "n", "hot"])


def qualifying(parts: int, percent: int):
    """For each set of one part: how many of its tokens stand in the union of each group after its own that is open
    to its size; blocks cut by set. Groups are ordered by their number of members, where that is given: a link between
    two groups is found by the members of the smaller one."""

    def run(whole: pa.Table) -> pa.Table:
        sets, tokens, group, at = postings(whole)
        names, one, own = np.unique(sets[:, 1], return_index=True, return_inverse=True)
        size, low, high = sets[:, 2] * 100, sets[one, 4] * percent, sets[one, 5] * 100
        place = np.empty(len(names), np.int64)
        place[np.lexsort((names, sets[one, 6:].sum(axis=1)))] = np.arange(len(names))
        # the different groups of each token
        has = np.unique(group * len(names) + own[at])
        of, has = has // len(names), has % len(names)
        n = np.bincount(of, minlength=len(tokens))
        start = np.cumsum(n) - n
        at, group = at[n[group] > 1], group[n[group] > 1]
        step = np.cumsum(n[group]) // 500_000
        pairs: list[np.ndarray] = []
        held = 0
        for _, a, b in runs_of(step):
            q, k = at[a:b], n[group[a:b]]
            g = has[np.repeat(start[group[a:b]] - (np.cumsum(k) - k), k) + np.arange(k.sum())]
            q = np.repeat(q, k)
            fits = (place[own[q]] < place[g]) & (low[g] <= size[q]) & (size[q] // 100 * percent <= high[g])
            pairs.append(q[fits] * len(names) + g[fits])
            held += len(pairs[-1])
            if held > 1_000_000:
                pairs, held = [_summed(pairs)], 0
        flat = _summed(pairs)
        q, g = flat["k"] // max(len(names), 1), flat["k"] % max(len(names), 1)
        need = np.maximum(sets[q, 3], shared(sets[q, 2], sets[one[g], 4], sets[one[g], 5], percent, TENTHS))
        return part_table(to_sets(parts, sets[q, 0], g=names[g], n=flat["n"].astype(np.uint32), need=need.astype(np.uint32)))

    return run


def enough(whole: pa.Table) -> pa.Table:
    """(q, g) of one part's sets with enough tokens in the union of a group."""
    blocks = [unpack(b.as_py()) for b in whole.column("blob")]
    q, g, n, row = totals(blocks, "g")
    met = n >= np.concatenate([b["need"] for b in blocks])[row]
    return pa.table([names_of(q[met]), names_of(g[met])], names=["q", "g"])


COUNT = np.dtype([("k", np.int64), ("n", np.int64)])


def _summed(pairs: list[np.ndarray]) -> np.ndarray:
    """Counts of keys; plain key arrays count one each, summed ones what they hold."""
    k = np.concatenate([p["k"] if p.dtype == COUNT else p for p in pairs]) if pairs else np.zeros(0, np.int64)
    w = np.concatenate([p["n"] if p.dtype == COUNT else np.ones(len(p), np.int64) for p in pairs]) if pairs else np.zeros(0, np.int64)
    key, at = np.unique(k, return_inverse=True)
    out = np.zeros(len(key), COUNT)
    out["k"] = key
    np.add.at(out["n"], at, w)
    return out


def opened(n: int, percent: int):
    """Over rows (g, block, copy, side, of, text) in that order: a block's members come first, then its queries stream by.
    One (of, g) for all queries of a group that has a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, members, union, met = None, [], None, None
        for part in slices(batches, limit=1 << 20):
            sets = shingle_sets(part.column("text"), n)
            out = []
            for g, b, c, side, of, tokens in zip(*(part.column(x).to_pylist() for x in ("g", "block", "copy", "side", "of")), sets):
                if (g, b, c) != place:
                    place, members, union, met = (g, b, c), [], None, None
                if side == 0:
                    members.append(tokens)
                    continue
                if not members or of == met:
                    continue
                if union is None:
                    union = np.unique(np.concatenate(members))
                # no member can share more with the query than the union of all does
                if 100 * len(np.intersect1d(tokens, union, assume_unique=True)) < percent * len(tokens):
                    continue
                if any(linked(tokens, t, percent) for t in members):
                    met = of
                    out.append((of, g))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def verify(texts: DataFrame, candidates: DataFrame, groups: DataFrame, n: int, percent: int) -> DataFrame:
    """The links (of, g) as (a, b) between candidates (q, of, g), ``of`` being the group of ``q``, and the members (id, g) of their
    groups: one, or one for each block, for all links between two groups."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    copies = F.ceil(F.col("asking") / ASKING).cast("int")
    sizes = groups.groupBy("g").agg(F.count("*").alias("size")).join(candidates.groupBy("g").agg(F.count("*").alias("asking")), "g")
    number = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    inside = groups.join(sizes, "g").select("id", "g", F.pmod(F.hash("id"), blocks).alias("block"), number(copies).alias("copy"), F.lit(0).alias("side"), F.col("g").alias("of"))
    asking = candidates.join(sizes, "g").select(F.col("q").alias("id"), "g", number(blocks).alias("block"), F.pmod(F.hash("of"), copies).alias("copy"), F.lit(1).alias("side"), "of")
    where = ["g", "block", "copy"]
    rows = inside.unionByName(asking).join(texts, "id").select(*where, "side", "of", "text")
    met = rows.repartition(*where).sortWithinPartitions(*where, "side", "of")
    return met.mapInArrow(lean_stream(opened(n, percent)), "a binary, b binary")


def link_classes(docs: DataFrame, *, n: int = 5, percent: int = 75, sample_docs: int = 4000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, k1, k2, n_shingles, component_id and class of each row. The class is its set of shingles or, of linked sets, the
    least: unlike component_id it is known for rows without an id, too, and null only for texts without shingles."""
    parts = partitions(docs.sparkSession)
    rows = row_key(docs, id_col, text_col)
    hot = common_tokens(rows.select("k1", "k2", "text"), n, sample_docs)

    def find(part: pa.RecordBatch):
        sets = shingle_sets(part.column("text"), n)
        heads = [prefix(s, hot, percent) for s in sets]
        marks = [digest(s) for s in sets]
        doc = np.repeat(np.arange(len(sets)), [len(x) for x in heads])
        owner = np.array([int.from_bytes(m[:8], "little") for m in marks], np.uint64)[doc]
        facts = [b"s" + len(s).to_bytes(7, "big") + (m if len(s) else b"") for s, m in zip(sets, marks)]
        # a prefix has the least tokens of its set: mixed, they fall on all parts alike
        return mix(np.concatenate(heads)), owner, doc, np.zeros((len(doc), 0), np.int32), facts

    # of each row its size, its set, and how many of its prefix tokens another set has in its prefix
    each = written(shared_anchors(rows.select("k1", "k2", "text"), find, single=False, facts=True).select(
        F.when(F.col("k1") != NO_ID, F.col("k1")).alias("id"), "k1", "k2", "found",
        F.conv(F.hex(F.substring("fact", 2, 7)), 16, 10).cast("bigint").alias("n_shingles"),
        F.when(F.octet_length("fact") > 8, F.substring("fact", 9, 16)).alias("set"),
    ), "sets")
    reps = each.where(F.col("set").isNotNull()).groupBy("set").agg(F.min(F.struct("k1", "k2", "found")).alias("at"), F.min("id").alias("least"), F.max("n_shingles").alias("size"))
    # matches() of the smallest partner that a set can have
    need = F.floor(F.ceil(F.col("size") * percent / 100) / 10) + 1
    # of its prefix, how many in a thousand tokens it has to itself
    take = F.least("size", F.col("size") - F.ceil(F.col("size") * percent / 100) + F.floor(F.col("size") / 10) + 1)
    away = F.floor((take - F.col("at.found")) * 1000 / take).cast("bigint")
    left = reps.where(F.col("at.found") >= need).select(F.col("set").alias("id"), "at.k1", "at.k2", "size", need.alias("need"), away.alias("away"))
    texts = written(possible(rows.select("k1", "k2", "text"), left).join(left, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("id", "size", "need", "away", "text"), "candidates")

    def sender(whole_sets: bool):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = Postings(parts)
            for part in slices(batches, limit=1 << 20):
                rows = [[short(x) for x in part.column(c).to_pylist()] if c in ("id", "g") else part.column(c).to_pylist() for c in part.schema.names if c not in ("hot", "text")]
                sets = shingle_sets(part.column("text"), n)
                if not whole_sets:
                    last = [np.sort(np.frombuffer(x or b"", np.uint64)) for x in part.column("hot").to_pylist()]
                    sets = [mix(prefix(t, x, percent, TENTHS)) for t, x in zip(sets, last)]  # alike on all parts
                for tokens, *row in zip(sets, *rows):
                    out.add(tokens, *row)
                if out.n > 1_000_000:
                    yield from out.blocks().to_batches()
            yield from out.blocks().to_batches()

        return lean_stream(send)

    def by_part(sent: DataFrame):
        return sent.repartitionById(parts, "part").groupBy("part")

    blocks = "part int, blob binary"
    name = lambda of, to: texts.select(F.col("id").alias(of), F.substring("id", 1, 8).alias(to))
    owners = by_part(texts.select("id", "away", "text").mapInArrow(sender(True), blocks)).applyInArrow(lean(first_owners(parts)), blocks)
    owners = written(by_part(owners).applyInArrow(lean(best_owner), "a binary, b binary, n bigint, hot binary"), "owners")
    last = owners.where(F.col("hot").isNotNull()).join(name("id", "a"), "a").select("id", "hot")
    best = owners.where(F.col("b").isNotNull()).join(texts.select(F.col("id").alias("q"), "size", F.substring("id", 1, 8).alias("a")), "a")
    likely = best.where(F.col("n") * 2 >= F.col("size")).select("q", "b").join(name("g", "b"), "b").select("q", F.col("q").alias("of"), "g")
    alone = texts.select("id", F.col("id").alias("g"))
    star = verify(texts.select("id", "text"), likely, alone, n, percent)
    groups = texts.select("id").join(components(star).withColumnRenamed("node", "id"), "id", "left")
    groups = written(few_files(groups.select("id", F.coalesce("root", "id").alias("g")), texts.count()), "groups")

    # a group is open to sizes that some member can link with
    reach = groups.join(texts.select("id", "size"), "id").groupBy("g").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.count("*").alias("members"))
    placed = groups.join(reach, "g").join(last, "id", "left")
    sent = texts.join(placed, "id").select("id", "g", "size", "need", "low", "high", "members", "hot", "text").mapInArrow(sender(False), blocks)
    met = by_part(by_part(sent).applyInArrow(lean(qualifying(parts, percent)), blocks)).applyInArrow(lean(enough), "q binary, g binary")
    tops = groups.select(F.col("g").alias("top"), F.substring("g", 1, 8).alias("g")).distinct()
    asked = groups.select(F.substring("id", 1, 8).alias("q"), F.col("id").alias("set"), F.col("g").alias("of"))
    chosen = written(met.join(asked, "q").join(tops, "g").select(F.col("set").alias("q"), "of", F.col("top").alias("g")), "chosen")
    wider = components(verify(texts.select("id", "text"), chosen, groups, n, percent)).select(F.col("node").alias("g"), "root")
    roots = groups.join(wider, "g", "left").select(F.col("id").alias("set"), F.coalesce("root", "g").alias("root"))
    class_of = reps.select("set", "least").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    lowest = class_of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = class_of.join(lowest, "root").select("set", "root", "component_id")
    return each.join(named, "set", "left").select("id", "k1", "k2", "n_shingles", F.coalesce("component_id", "id").alias("component_id"), F.col("root").alias("class"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the one with the smallest id (of repeated rows one stays).
    Rows without an id stand for a class only if none of its rows has one; texts without shingles all stay."""
    classes = link_classes(docs, **how)
    # the least row of a class, combined on the map side
    order = F.struct(F.col("id").isNull().alias("no_id"), "k1", "k2")
    best = classes.where("n_shingles > 0").groupBy("class").agg(F.min(order).alias("best")).select("best.k1", "best.k2")
    empty = classes.where("n_shingles = 0").select("k1", "k2").distinct()
    k1, k2 = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.withColumns({"__key1": k1, "__key2": k2})
    keep = lambda d, k: d.join(k.select(F.col("k1").alias("__key1"), F.col("k2").alias("__key2")), ["__key1", "__key2"], "left_semi")
    first = keep(keyed, best).dropDuplicates(["__key1", "__key2"])
    return first.unionByName(keep(keyed, empty)).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
