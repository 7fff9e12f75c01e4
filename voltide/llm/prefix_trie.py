"""Conversation prefix trie in flat node tables addressed by minimal perfect hashes.

Every distinct sequence of first turns is a node. A conversation's turns become a chain of 128-bit prefix
digests (two sums modulo 2^64 of scattered (turn digest, place) pairs), computed while its rows stream past
in order; texts never leave the scan. Distinct digests are enumerated by a hash aggregate, which also says
whether two different (parent, depth, words) met in one digest; then the job stops instead of merging them.

The trie is cut where it gets narrow. Nodes with more than ``light`` members are heavy; they are connected
to the root, at most (turns + conversations) / light of them exist, and ``light`` grows with the table so
that they stay below ``HEAVY``. What hangs below a heavy node is a light subtree: it goes to one shard,
where a minimal perfect hash gives every digest its slot. The slot keeps the digest, so that a digest that
is not in the shard is recognised. Counts are scattered into flat arrays by slot, parents are slots, and
leaves and saved tokens are added to the parents from the deepest level up. The heavy top is one more such
table, fed with sums over the subtrees.

A third of all conversations may share turns or be copies: they are heavy nodes or counts, never rows of one
group. The ids that end in a heavy node are sorted by ranges, packed to long strings and hashed as a stream.
A shard holds the nodes of at most ``light`` conversations for each of its subtrees. Rows of one conversation
pass one task as a stream.

* Rows without a ``conv_id`` belong to no conversation and are left out. A null role or text is empty.
* Rows with the same turn are ordered by the digest of role and text; repeated rows are turns of their own.
* ``c - c % 20`` has the sign rule of SQL: -25 belongs to -20.
* An empty table has no conversation and no node. Extra columns are ignored.
* Two different texts with one digest (2^-128 for a pair) would be taken for equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import mix, partitions, table, written

WORD = r"[^\x20\x09-\x0D]+"
#: Least members of a heavy node, and how many heavy nodes there may be.
LIGHT = 4096
HEAVY = 1 << 17
#: Nodes of a shard, on average.
SHARD = 200_000
#: Characters of one packed string of ids.
PACK = 1 << 16
EMPTY = hashlib.sha256(b"").hexdigest()
CHAIN = "conv_id bigint, depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, words bigint, ends bigint, heavy boolean, r1 bigint, r2 bigint"
NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
STEPS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


class SlotTable:
    """A minimal perfect hash of distinct 128-bit keys: n keys have the slots 0 to n - 1.

    Keys are thrown into a bit array of twice their number; those alone in their bit stay, the others go to
    the next level. The slot is the rank of the bit. ``slots`` compares the key kept in the slot, so a key
    that was not in the set gives -1.
    """

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        left, self.levels, before = keys, [], 0
        while len(left):
            if len(self.levels) > 60:
                raise ValueError("keys are not distinct")
            at = self._at(left, len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(at, minlength=2 * len(left) + 1) == 1
            rank = np.cumsum(alone) - 1 + before
            self.levels.append((alone, rank))
            before += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros((self.n, 2), np.uint64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1)
        return (mix(keys[:, 0] + salt * (keys[:, 1] | np.uint64(1))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._at(keys[todo], level, len(alone))
            hit = alone[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        found = self._slots(keys)
        if self.n:
            found[(self.keys[found] != keys).any(1)] = -1
        return found


def turns(conversations: DataFrame) -> DataFrame:
    """The rows as digests, dealt by the group of twenty conversations, the one that lends its turns first."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    c = F.col("conv_id").cast("bigint")
    lender = c - c % 20
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        lender.alias("b"),
        c.alias("c"),
        (lender != c).alias("borrows"),
        F.col("turn").alias("turn"),
        F.xxhash64(role, text).alias("d1"),
        F.xxhash64(F.lit("second"), text, role).alias("d2"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        # a lender borrows from itself: nothing changes
        F.when(lender == c, 0).otherwise(F.crc32(c.cast("string")) % 4).alias("h"),
    )
    n = partitions(conversations.sparkSession)
    return rows.repartition(n, "b").sortWithinPartitions("b", "borrows", "c", F.asc_nulls_first("turn"), "d1", "d2").drop("turn", "borrows")


def chains(heavy: np.ndarray | None):
    """The stream of sorted turns as the stream of prefix digests of the rebuilt conversations.

    What is kept between batches: the last node (it may turn out not to be the end of its conversation), the
    number of own turns read, and the first three turns of the lending conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = None if heavy is None else SlotTable(heavy)
        conv = base = None
        seen = 0  # own turns of conv before this batch
        lent = (np.zeros((3, 3), np.uint64), 0)
        last = None  # columns of the node that is held back
        for batch in batches:
            if not batch.num_rows:
                continue
            b, c, d1, d2, words, h = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("b", "c", "d1", "d2", "words", "h"))
            n = len(c)
            new = np.ones(n, bool)
            new[1:] = c[1:] != c[:-1]
            fresh = new.copy()
            fresh[0] = c[0] != conv
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            own = np.arange(n) - start
            if not fresh[0]:
                own[start == 0] += seen
            # first turns of the lenders of the batch
            group = np.cumsum(np.concatenate([[0], b[1:] != b[:-1]]))
            heads, length = np.zeros((group[-1] + 1, 3, 3), np.uint64), np.zeros(group[-1] + 1, np.int64)
            if base == b[0]:
                heads[0], length[0] = lent
            lends = np.flatnonzero((b == c) & (own < 3))
            heads[group[lends], own[lends]] = np.stack([d1[lends], d2[lends], words[lends]], 1).astype(np.uint64)
            np.maximum.at(length, group[lends], own[lends] + 1)
            m = np.minimum(h, length[group])
            # root and lent turns come with the first own turn; own turns from h on follow
            firsts = np.flatnonzero(fresh)
            count = m[firsts] + 1
            row = np.repeat(firsts, count)
            depth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            turn = heads[group[row], np.maximum(depth - 1, 0)]
            mine = np.flatnonzero(own >= h)
            row = np.concatenate([row, mine])
            turn = np.concatenate([turn, np.stack([d1[mine], d2[mine], words[mine]], 1).astype(np.uint64)])
            depth = np.concatenate([depth, m[mine] + own[mine] - h[mine] + 1])
            order = np.lexsort((depth, row))  # a row's lent turns are shallower than the row itself
            row, turn, depth = row[order], turn[order], depth[order]
            conv, base, seen = c[-1], b[-1], int(own[-1]) + 1
            lent = (heads[-1], length[-1])
            if not len(row):
                continue
            root = depth == 0
            value = mix(turn[:, :2] + depth[:, None].astype(np.uint64) * STEPS)
            value[root] = 0
            first = np.flatnonzero(root)
            sums = np.cumsum(value, axis=0, dtype=np.uint64)
            at = np.searchsorted(first, np.arange(len(row)), side="right") - 1  # -1: still the conversation before
            back = np.zeros((len(row), 2), np.uint64)
            back[at >= 0] = sums[first[at[at >= 0]]]
            if last is not None:
                back[at < 0] = np.uint64(0) - last["p"][0]
            p = sums - back
            cols = {"conv": c[row], "depth": depth, "p": p, "words": np.where(root, 0, turn[:, 2].astype(np.int64))}
            q = np.zeros_like(p)
            q[1:] = p[:-1]
            if last is not None:
                q[0] = last["p"][0]
            q[root] = 0
            cols["q"] = q
            high = np.zeros(len(row), bool) if top is None else top.slots(p) >= 0
            cols["heavy"] = high
            # the first light node of a conversation is the top of its subtree
            before = np.concatenate([[False if last is None else bool(last["heavy"][0])], high[:-1]])
            tops = ~high & (root | before)
            which = np.maximum.accumulate(np.where(tops, np.arange(len(row)), -1))
            cols["r"] = p[np.maximum(which, 0)]
            if last is not None:
                cols["r"][which < 0] = last["r"][0]
            if last is not None:
                cols = {k: np.concatenate([last[k], v]) for k, v in cols.items()}
            last = {k: v[-1:] for k, v in cols.items()}
            ends = cols["conv"][:-1] != cols["conv"][1:]
            yield nodes({k: v[:-1] for k, v in cols.items()}, ends)
        if last is not None:
            yield nodes(last, np.ones(1, bool))

    return run


def nodes(cols: dict, ends: np.ndarray) -> pa.RecordBatch:
    signed = lambda x, i: np.ascontiguousarray(x[:, i]).view(np.int64)
    p, q, r = cols["p"], cols["q"], cols["r"]
    out = [cols["conv"], cols["depth"], signed(p, 0), signed(p, 1), signed(q, 0), signed(q, 1), cols["words"], ends.astype(np.int64), cols["heavy"], signed(r, 0), signed(r, 1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=[x.split()[0] for x in CHAIN.split(", ")])


def distinct_nodes(chain: DataFrame, *more) -> DataFrame:
    """One row of each prefix digest; ``same`` says that all its members agree about depth, words and parent."""
    facts = ["depth", "q1", "q2", "words"]
    agree = F.lit(True)
    for x in facts:
        agree = agree & (F.min(x) == F.max(x))
    return chain.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"), *[F.min(x).alias(x) for x in facts], F.sum("ends").alias("n_ends"), agree.alias("same"), *more)


def keys(frame: dict, a: str, b: str) -> np.ndarray:
    return np.stack([frame[a].view(np.uint64), frame[b].view(np.uint64)], 1)


def upwards(parent: np.ndarray, depth: np.ndarray, *sums: np.ndarray) -> None:
    """Add each slot's sums to its parent's, the deepest slots first."""
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        for s in sums:
            np.add.at(s, parent[level], s[level])


def shard(heavy: dict):
    """Finished nodes of the light subtrees of one shard, with what they add to the heavy node above them."""
    names = NODE + ", q1 bigint, q2 bigint, top boolean"

    def run(group: pa.Table) -> pa.Table:
        cols = {c: group.column(c).to_numpy().copy() for c in group.column_names if c != "same"}
        if not all(group.column("same").to_pylist()):
            raise ValueError("two prefixes have one digest")
        is_node = cols["kind"] == 0
        node = {k: v[is_node] for k, v in cols.items()}
        slots = SlotTable(keys(node, "p1", "p2"))
        at = slots.slots(keys(node, "p1", "p2"))
        flat = {}
        for k in ("conv", "depth", "words", "n", "q1", "q2"):
            flat[k] = np.empty(slots.n, np.int64)
            flat[k][at] = node[k]
        q = keys(flat, "q1", "q2")
        parent = slots.slots(q)
        parent[flat["depth"] == 0] = -1
        children = np.bincount(parent[parent >= 0], minlength=slots.n)
        leaves, saved = (children == 0).astype(np.int64), (flat["n"] - 1) * flat["words"]
        upwards(parent, flat["depth"], leaves, saved)
        above = SlotTable(heavy["p"])
        owner = np.empty(above.n, np.int64)
        owner[above.slots(heavy["p"])] = heavy["conv"]
        top = (parent < 0) & (flat["depth"] > 0)
        conv = np.where(parent >= 0, flat["conv"][parent], 0)
        conv[top] = owner[above.slots(q[top])]
        end = {k: v[~is_node] for k, v in cols.items()}
        digests = np.full(slots.n, EMPTY, object)
        place = slots.slots(keys(end, "p1", "p2"))
        order = np.lexsort((end["conv"], place))
        for run_ in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            if len(run_):
                digests[place[run_[0]]] = hashlib.sha256(",".join(map(str, end["conv"][run_].tolist())).encode()).hexdigest()
        out = [flat["conv"], flat["depth"], pa.array(conv, mask=flat["depth"] == 0), flat["n"], children, leaves, saved, pa.array(digests, pa.string()), flat["q1"], flat["q2"], top]
        return pa.Table.from_arrays([pa.array(x) for x in out], names=[x.split()[0] for x in names.split(", ")])

    return run, names


def top_nodes(heavy: dict):
    """The heavy nodes from the sums over the subtrees below them; at most ``HEAVY`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = [{c: batch.column(c).to_numpy() for c in ("q1", "q2", "children", "leaves", "saved")} for batch in batches]
        cols = {c: np.concatenate([b[c] for b in below]) for c in below[0]}
        slots = SlotTable(heavy["p"])
        at = slots.slots(heavy["p"])
        flat = {}
        for k in ("conv", "depth", "words", "n"):
            flat[k] = np.empty(slots.n, np.int64)
            flat[k][at] = heavy[k]
        q = np.empty((slots.n, 2), np.uint64)
        q[at] = heavy["q"]
        parent = slots.slots(q)
        parent[flat["depth"] == 0] = -1
        children, leaves, saved = np.bincount(parent[parent >= 0], minlength=slots.n), np.zeros(slots.n, np.int64), (flat["n"] - 1) * flat["words"]
        place = slots.slots(keys(cols, "q1", "q2"))
        for total, more in ((children, "children"), (leaves, "leaves"), (saved, "saved")):
            np.add.at(total, place, cols[more])
        leaves[children == 0] = 1
        upwards(parent, flat["depth"], leaves, saved)
        conv = pa.array(np.where(parent >= 0, flat["conv"][parent], 0), mask=parent < 0)
        p = slots.keys.view(np.int64)
        out = [flat["conv"], flat["depth"], conv, flat["n"], children, leaves, saved, p[:, 0].copy(), p[:, 1].copy()]
        names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "p1", "p2"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    return run, NODE.rsplit(", ", 1)[0] + ", p1 bigint, p2 bigint"


def packed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, id) rows as (node, first id, ids joined by commas)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        p1, p2, ids = (batch.column(c).to_numpy() for c in ("p1", "p2", "conv_id"))
        cuts = np.flatnonzero((p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
        out = []
        for a, z in zip([0, *cuts], [*cuts, len(ids)]):
            for i in range(a, z, PACK // 16):
                some = ids[i : min(i + PACK // 16, z)]
                out.append((int(p1[a]), int(p2[a]), int(some[0]), ",".join(map(str, some.tolist()))))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["p1", "p2", "first", "ids"])


def hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packs of each node, in order, through one running hash."""
    node = state = None
    done = lambda: pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["p1", "p2", "ends_sha256"])
    for batch in batches:
        for p1, p2, _, ids in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if node != (p1, p2):
                if node is not None:
                    yield done()
                node, state = (p1, p2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if node is not None:
        yield done()


def ends_of_heavy(chain: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) of heavy nodes in which conversations end."""
    rows = chain.where("heavy and ends = 1").select("p1", "p2", "conv_id")
    packs = rows.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id").mapInArrow(packed_ids, "p1 bigint, p2 bigint, first bigint, ids string")
    return packs.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(hashed_ids, "p1 bigint, p2 bigint, ends_sha256 string")


def trie(conversations: DataFrame, *, light: int | None = None) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (columns as in ``NODE``)."""
    spark = conversations.sparkSession
    total = 2 * conversations.count()  # turns and conversations, at most
    light = light or max(LIGHT, total // HEAVY)
    rows = turns(conversations.select("conv_id", "turn", "role", "text"))
    found = distinct_nodes(rows.mapInArrow(chains(None), CHAIN)).where(F.col("n") > light).toPandas()
    if not found["same"].all():
        raise ValueError("two prefixes have one digest")
    cols = {c: found[c].to_numpy(np.int64) for c in ("p1", "p2", "q1", "q2", "conv", "depth", "words", "n")}
    heavy = {"p": keys(cols, "p1", "p2"), "q": keys(cols, "q1", "q2"), **{c: cols[c] for c in ("conv", "depth", "words", "n")}}
    chain = written(rows.mapInArrow(chains(heavy["p"]), CHAIN), "chains")
    low = chain.where("not heavy")
    top = F.pmod(F.xxhash64("r1", "r2"), F.lit(max(1, total // SHARD)))
    wanted = ["shard", "kind", "p1", "p2", "q1", "q2", "depth", "words", "n", "conv", "same"]
    inner = distinct_nodes(low, F.min("r1").alias("r1"), F.min("r2").alias("r2")).withColumn("shard", top).withColumn("kind", F.lit(0))
    zero = F.lit(0).cast("bigint")
    ends = low.where("ends = 1").select(top.alias("shard"), F.lit(1).alias("kind"), "p1", "p2", zero.alias("q1"), zero.alias("q2"), zero.alias("depth"), zero.alias("words"), zero.alias("n"), F.col("conv_id").alias("conv"), F.lit(True).alias("same"))
    run, schema = shard(heavy)
    done = inner.select(*wanted).unionByName(ends).groupBy("shard").applyInArrow(run, schema)
    names = [x.split()[0] for x in NODE.split(", ")]
    if not len(cols["p1"]):
        return done.select(*names)
    done = written(done, "nodes")
    below = done.where("top").groupBy("q1", "q2").agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    # a row of nothing for the root, which is heavy if any node is: the task has input in any case
    below = below.unionByName(spark.range(1).select(*[zero.alias(c) for c in below.columns]))
    run, schema = top_nodes(heavy)
    high = below.repartition(1).mapInArrow(run, schema).join(ends_of_heavy(chain), ["p1", "p2"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    return done.select(*names).unionByName(high.select(*names))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
