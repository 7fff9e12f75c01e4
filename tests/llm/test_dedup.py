"""Suffix-array dedup, substring dedup and the Jaccard join against plain versions."""

import random
import tracemalloc

import brute
import numpy as np
import pyarrow as pa
import pytest

from voltide.llm import jaccard, packed, substring, suffix_dedup
from voltide.llm.common import lean, table

SCHEMA = "doc_id bigint, text string"


def plain(df, n):
    return sorted((tuple(r)[:n] for r in df.collect()), key=repr)


def pieces(seed):
    """Texts put together from shared pieces, with copies, periods, nulls, ties and texts near the window length."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcd é") for _ in range(rnd.randint(0, 1500))) for _ in range(8)]
    rows = []
    for i in range(40):
        cuts = [rnd.randint(0, 800) for _ in range(rnd.randint(0, 4))]
        rows.append((i, "".join(rnd.choice(base)[a : a + rnd.randint(200, 900)] for a in cuts)))
    rows += [(100, "a" * 2500), (101, None), (102, ""), (103, "ab" * 700), (None, rows[3][1]), (None, rows[3][1]), (104, "x" * 399), (105, "x" * 400), (106, "x" * 400)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, length, parts", [(1, 400, 3), (2, 300, 1), (3, 400, 7)])
def test_suffix_dedup(spark, seed, length, parts):
    rows = pieces(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert plain(suffix_dedup.without_repeats(df, length=length), 5) == brute.repeated_bytes(rows, length)


def test_suffix_dedup_hot_passage_over_many_parts(spark):
    """A passage in most documents, each with other neighbours, so that its suffixes cross the cuts."""
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    hot = word(460)
    rows = [(i, word(rnd.randint(0, 300)) + hot[rnd.randint(0, 30) : 460 - rnd.randint(0, 40)] + word(rnd.randint(0, 300))) for i in range(120)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(6)
        assert plain(suffix_dedup.without_repeats(df), 5) == brute.repeated_bytes(rows, 400)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_suffix_query_on_documents(spark, sf, rows_of):
    rows = rows_of(table(spark, sf, "documents"))
    assert plain(suffix_dedup.query(spark, sf), 5) == brute.repeated_bytes(rows, 400)


def test_loser_tree_merges_and_knows_prefixes():
    rnd = random.Random(3)
    runs = [sorted({bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 30))}) for _ in range(5)]
    tree = suffix_dedup.LoserTree([suffix_dedup.Run(suffix_dedup.front_coded(r, [[(0, 0, 0, 0)]] * len(r), [(0, 0)])) for r in runs])
    out, known = zip(*[(k, n) for k, n, *_ in tree])
    assert list(out) == sorted(k for r in runs for k in r)
    assert list(known[1:]) == [suffix_dedup.common(a, b, 0) for a, b in zip(out, out[1:])]


def sentences(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "a"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(0, 300))] for _ in range(10)]
    rows = []
    for i in range(60):
        t = []
        for a in [rnd.randint(0, 150) for _ in range(rnd.randint(0, 6))]:
            t += rnd.choice(base)[a : a + rnd.randint(5, 60)]
        rows.append((i, " ".join(t)))
    rows += [(100, "a " * 400), (101, None), (102, " \n"), (103, "ab cd " * 90), (None, rows[3][1]), (None, rows[3][1]), (3, rows[3][1]), (104, "x " * 12), (105, "x " * 13), (106, "x\t" * 13), (-5, rows[7][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, parts", [(1, 4), (2, 1), (3, 7)])
def test_substring_dedup(spark, seed, parts):
    rows = sentences(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert plain(substring.without_repeats(df), 4) == brute.repeated_words(rows)


def test_substring_query_on_documents(spark, sf, rows_of):
    rows = rows_of(table(spark, sf, "documents"))
    assert plain(substring.query(spark, sf), 4) == brute.repeated_words(rows)


def test_substring_windows_whose_digests_share_40_bits(spark):
    """Windows of 13 words that differ in the last one, with the same seed and the same upper 40 bits of the first digest."""
    start = " ".join(f"p{i}" for i in range(12))
    ends = ["x1330242", "x2432135", "x499623", "x2152478", "x1088183", "x1547510"]
    rows = [(i, f"{start} {w}") for i, w in enumerate(ends)] + [(10, f"{start} {ends[1]}")]
    got = {r["doc_id"]: r["n_removed"] for r in substring.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: 0 for i in range(6)} | {10: 13}


def near_copies(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["é", "A"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 200))] for _ in range(20)]
    rows = []
    for i in range(200):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        if rnd.random() < 0.3:
            t += rnd.choice(base)[: rnd.randint(0, 40)]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(t)))
    return rows + [(1001, None), (1002, ""), (1003, "  "), (1004, "a b"), (1005, "A  b"), (1006, "a b c"), (1007, "x " * 30), (1008, "x " * 31)]


@pytest.mark.parametrize("seed, sample", [(1, 4000), (2, 50)])
def test_jaccard_classes(spark, seed, sample):
    rows = near_copies(seed)
    got = jaccard.link_classes(spark.createDataFrame(rows, SCHEMA).repartition(4), sample_docs=sample)
    assert sorted(tuple(r) for r in got.select("id", "n_shingles", "component_id").collect()) == brute.components(rows)


def test_jaccard_query_on_documents(spark, sf, rows_of):
    rows = rows_of(table(spark, sf, "documents"))
    assert sorted(tuple(r) for r in jaccard.query(spark, sf).collect()) == brute.components(rows)


def test_one_of_each_keeps_the_first_and_all_empty_texts(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "s"), (2, text + " end", "s"), (2, text + " end", "s"), (None, text, "s"), (7, None, "s"), (8, "", "s"), (9, "other words", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, set string")
    got = sorted(tuple(r) for r in jaccard.one_of_each(df).select("doc_id", "set").collect())
    assert got == [(2, "s"), (7, "s"), (8, "s"), (9, "t")]


def test_one_of_each_keeps_every_class_without_an_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (None, texts[1] + " end"), (None, "few words"), (4, texts[3] + " end"), (None, None)]
    got = jaccard.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    one = [r["text"] for r in got if r["text"] and r["text"].startswith("b")]
    assert len(one) == 1 and one[0] in (texts[1], texts[1] + " end")
    rest = sorted((tuple(r) for r in got if r["text"] not in one), key=repr)
    assert rest == sorted([(None, texts[0]), (None, texts[2]), (4, texts[3] + " end"), (None, "few words"), (None, None)], key=repr)


def test_components_of_long_chains(spark):
    edges = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(200)] + [(b"z1", b"z0"), (b"q", b"q")]
    got = dict(tuple(map(bytes, r)) for r in jaccard.components(spark.createDataFrame(edges, "a binary, b binary")).collect())
    assert got == {f"{i:04d}".encode(): b"0000" for i in range(1, 201)} | {b"z1": b"z0"}


@pytest.mark.parametrize("run", [suffix_dedup.without_repeats, substring.without_repeats, jaccard.link_classes])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
    assert len(run(spark.createDataFrame([(1, None)], SCHEMA)).collect()) == 1


def test_extra_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b", 1, "x", b"y", 3)], "doc_id bigint, text string, k1 int, spans string, blob binary, id int")
    for run in (suffix_dedup.without_repeats, substring.without_repeats, jaccard.link_classes):
        assert run(df).count() == 1


def test_blocks_survive_packing():
    import numpy as np

    got = packed.unpack(packed.pack(a=np.array([1, 2**63], np.uint64), b=np.zeros((0, 3), np.int32), c=[1, "x"]))
    assert got["a"].tolist() == [1, 2**63] and got["b"].shape == (0, 3) and got["c"] == [1, "x"]


def test_suffix_dedup_of_planted_passages_around_the_length(spark):
    """Passages of over 50 words: what has 400 bytes and more in common leaves, what has less stays whole."""
    rnd = random.Random(11)
    text = lambda words, n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(n)) for _ in range(words))
    short, border, long = text(57, 6), text(57, 6) + "z", text(80, 6)
    assert (len(short), len(border), len(long)) == (398, 399, 559)
    rows = []
    for i, passage in enumerate((short, border, long)):
        # the words around a passage differ, so nothing but the passage is shared
        rows += [(10 * i + k, f"{text(20, 5)}{'(<['[k]}{passage}{')>]'[k]}{text(20, 5)}") for k in range(3)]
    rows += [(100, text(200, 5)), (101, f"^{long[:400]}~"), (102, f"#{border}!"), (103, f"%{border}!")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = plain(suffix_dedup.without_repeats(df), 5)
    assert got == brute.repeated_bytes(rows, 400)
    removed = {r[0]: r[2] for r in got}
    assert [removed[i] for i in (0, 1, 2, 10, 11, 12, 100)] == [0] * 7
    assert [removed[i] for i in (20, 21, 22)] == [559] * 3 and removed[101] == 400
    assert removed[102] == removed[103] == 400


def test_shared_anchors_go_back_in_blocks():
    """However many documents share anchors, a part sends one block for each part, not a row for each document."""
    keys = np.stack([np.arange(200), np.arange(200) * 7], 1)
    blobs = []
    for half in (keys[:100], keys[100:]):
        sent = packed.Gathered(4, False)
        h = np.tile(np.arange(1, 4, dtype=np.uint64) << np.uint64(40), 100)
        sent.add(h, np.repeat(half[:, 0], 3).astype(np.uint64), np.repeat(np.arange(100), 3), np.tile(np.array([[1, 0, 1], [5, 4, 5], [9, 8, 9]]), (100, 1)), half)
        blobs += sent.blocks()
    out = [r for p in range(4) if (mine := [b for b in blobs if b[0] == p]) for r in packed.merged(4, False)(packed.part_table(mine)).to_pylist()]
    assert len(out) <= len(blobs)
    found = {}
    for p in range(4):
        for r in packed.by_key(packed.part_table([(p, r["blob"]) for r in out if r["part"] == p])).to_pylist():
            found[r["k1"], r["k2"]] = packed.spots_of(r["spots"]).tolist()
    assert found == {tuple(k): [[1, 0, 1], [5, 4, 5], [9, 8, 9]] for k in keys.tolist()}


def test_substring_texts_cross_the_network_once(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(20)], SCHEMA)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = substring.dedup(df)
        assert len(found.collect()) == 20
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_jaccard_candidates_come_from_one_side_in_blocks():
    """Forty sets in groups of their own that share all tokens: each pair of groups once, and a block for each part."""
    tokens = np.arange(30, dtype=np.uint64) << np.uint64(56)
    sent = jaccard.Postings(3)
    for i in range(40):
        sent.add(tokens, i * 10**15, i * 10**15, 30, 3, 30, 30)
    table_ = sent.blocks()
    blobs = list(zip(table_.column("part").to_pylist(), table_.column("blob").to_pylist()))
    met = [jaccard.qualifying(3, 75)(packed.part_table([b for b in blobs if b[0] == p])) for p in sorted({b[0] for b in blobs})]
    assert all(m.num_rows <= 3 for m in met)
    rows = [r for m in met for r in m.to_pylist()]
    pairs = [tuple(r.values()) for p in sorted({r["part"] for r in rows}) for r in jaccard.enough(packed.part_table([(p, r["blob"]) for r in rows if r["part"] == p])).to_pylist()]
    assert sorted((jaccard.short(q), jaccard.short(g)) for q, g in pairs) == [(i * 10**15, j * 10**15) for i in range(40) for j in range(i + 1, 40)]


def test_jaccard_sends_few_texts_without_a_partner(spark):
    rows = spark.range(2000).selectExpr("id AS k1", "xxhash64(id) AS k2", "'t' AS text")
    kept = {r["k1"] for r in jaccard.possible(rows, rows.where("k1 < 50")).collect()}
    assert set(range(50)) <= kept and len(kept) < 100


def test_jaccard_rows_of_near_copies_do_not_grow_with_their_pairs(spark, monkeypatch):
    """Of 240 copies with one to nine words changed, many pairs link and many do not: one link for two groups, few candidates."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for i in range(240):
        t = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4, 5, 9])):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    components, written, links, made = jaccard.components, jaccard.written, [], {}

    def counted(edges, **how):
        links.append(edges.count())
        return components(edges, **how)

    def kept(df, name):
        out = written(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "components", counted)
    monkeypatch.setattr(jaccard, "written", kept)
    got = jaccard.link_classes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    expected = brute.components(rows)
    assert sorted(tuple(r) for r in got.select("id", "n_shingles", "component_id").collect()) == expected
    assert 20 < len({r[2] for r in expected}) < 120
    assert sum(links) <= 4 * len(rows) and made["chosen"] <= 4 * len(rows)


def test_jaccard_bound_of_shared_prefix_tokens_holds_for_linked_sets():
    """Linked sets share at least the tokens of their prefixes that the bound asks for, whatever their order."""
    rnd = np.random.default_rng(3)
    met = 0
    for _ in range(4000):
        percent = int(rnd.choice([50, 75, 90]))
        size, tenths = int(rnd.integers(1, 80)), int(rnd.integers(1, 5))
        a = rnd.choice(200, size, replace=False)
        drop = int(rnd.integers(0, max(1, size // 4) + 1))
        b = np.concatenate([a[drop:], 200 + rnd.choice(100, int(rnd.integers(0, 12)), replace=False)])
        order = rnd.permutation(300).astype(np.uint64)
        a, b = np.sort(order[a]), np.sort(order[b])
        if not len(b) or not jaccard.linked(a, b, percent):
            continue
        met += 1
        hot = np.sort(rnd.choice(300, 60, replace=False)).astype(np.uint64)
        both = len(np.intersect1d(*(jaccard.prefix(x, hot, percent, tenths) for x in (a, b))))
        for low, high in ((len(b), len(b)), (1, 300), (len(b) - 2, len(b) + 5)):
            assert both >= jaccard.shared(np.array([len(a)]), np.array([low]), np.array([high]), percent, tenths)[0]
    assert met > 500


def test_few_edges_are_few_files(spark, many_chunks):
    """Each file of a local folder makes its executor start processes; rounds over a few edges wrote one for each partition."""
    rnd = random.Random(4)
    edges = [(i, rnd.randrange(i)) for i in range(1, 400) if i % 50]
    root = {}
    for a, b in edges:
        root[a] = root.get(b, b)
    got = jaccard.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(8))
    assert {r["node"]: r["root"] for r in got.collect()} == root
    assert len(got.inputFiles()) == 1


def anchor_table(rnd, n_blocks, n, keys, parts=1):
    """Blocks of anchors of one part, as tasks send them, and the same anchors as (context, owner, key)."""
    blobs, plain_rows = [], []
    for k in range(n_blocks):
        gathered = packed.Gathered(parts, False)
        h = rnd.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
        if plain_rows:
            again = np.concatenate([r[0] for r in plain_rows])
            h[: n // 4] = rnd.choice(again, n // 4)
        doc = np.sort(rnd.integers(0, keys, n))
        owner = (doc + 7 * (k % 3)).astype(np.uint64)
        own = np.stack([np.arange(keys) + k * keys, np.arange(keys) * 3], 1).astype(np.int64)
        plain_rows.append((h, owner, own[doc]))
        gathered.add(h, owner, doc, np.zeros((n, 0), np.int32), own)
        blobs += gathered.blocks()
    return packed.part_table(blobs), [np.concatenate([r[i] for r in plain_rows]) for i in range(3)]


def found_by_key(out):
    found = {}
    for blob in out.column("blob"):
        b = packed.unpack(blob.as_py())
        for key, count in zip(b["keys"].tolist(), b["count"].tolist()):
            found[tuple(key)] = found.get(tuple(key), 0) + count
    return found


@pytest.mark.parametrize("run", [37, 1000, 500_000])
def test_anchors_met_with_two_owners_by_stretches(run, monkeypatch):
    """The stretches of hashes in which a part is sorted do not change which anchors are found."""
    whole, (h, owner, keys) = anchor_table(np.random.default_rng(run), 6, 600, 40)
    monkeypatch.setattr(packed, "RUN", run)
    owners, expected = {}, {}
    for x, o in zip((h >> np.uint64(64 - packed.SENT)).tolist(), owner.tolist()):
        owners.setdefault(x, set()).add(o)
    for x, key in zip((h >> np.uint64(64 - packed.SENT)).tolist(), keys.tolist()):
        if len(owners[x]) > 1:
            expected[tuple(key)] = expected.get(tuple(key), 0) + 1
    assert len(expected) > 30
    assert found_by_key(packed.merged(3, False)(whole)) == expected


def test_memory_of_a_part_of_anchors_follows_its_blocks(monkeypatch):
    """Of a large part only a stretch is sorted at a time: sorting all of it took 114 bytes an anchor, this takes 25."""
    monkeypatch.setattr(packed, "RUN", 20_000)
    n = 40 * 10_000
    whole, _ = anchor_table(np.random.default_rng(1), 40, 10_000, 200)
    tracemalloc.start()
    try:
        packed.merged(3, False)(whole)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60 * n


def test_prefix_tokens_fall_on_all_parts_alike(spark, monkeypatch):
    """A prefix has the least hashes of its set; cut by range, the first third of the parts got nearly all of them."""

    class Sent(Exception):
        pass

    def caught(rows, find, **how):
        raise Sent(find)

    monkeypatch.setattr(jaccard, "shared_anchors", caught)
    rnd = random.Random(5)
    texts = [" ".join(str(rnd.randrange(1000)) for _ in range(300)) for _ in range(200)]
    with pytest.raises(Sent) as sent:
        jaccard.link_classes(spark.createDataFrame(list(enumerate(texts)), SCHEMA))
    h = sent.value.args[0](pa.record_batch([pa.array(texts)], names=["text"]))[0]
    parts = np.bincount((h >> np.uint64(32)).astype(np.int64) * 20 >> 32, minlength=20)
    assert parts.max() < 1.3 * parts.mean()


def test_freed_memory_goes_back():
    """What a group has freed must not stay with the Python worker, where it would stand beside the next step's memory."""

    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    kept = []

    def run(whole):
        # below the size that has a mapping of its own; what is kept is at the end and holds the heap up
        held = [np.ones(7_000) for _ in range(6_000)]
        kept.append(held[-1])
        during.append(resident())
        return whole

    during = []
    lean(run)(pa.table({"a": [1]}))
    assert resident() < during[0] - 200_000_000
