"""The other training-data operators against plain versions, libraries, round trips and held-out rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.llm import bpe, decontaminate, neighbours, quality, secrets, token_counts, warc
from voltide.llm.common import table
from voltide.operators.ordering import scratch_path

SCHEMA = "doc_id bigint, text string"
ODD = ["", None, " ", "a", "Hello <|startoftext|>World<|endoftext|> a<|endoftext|>b", "ΑΣΣ ΟΔΟΣ ﬁ é é x　y\x1cz\x85q ª º µ ß ÿ ×÷", "don't I'LL 123 ½ ２ x_y", "aaaa" * 500, "İstanbul ẞ", "😀👍🏽 </w> a</w>b", "日本語テキスト 한국어", "​́abc", "\x01\x7f"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)


# quality classifier


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.query(spark, sf).join(table(spark, sf, "labels"), "doc_id").toPandas()
    assert all(got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id])
    held = got[got.held_out]
    assert len(held) > 30 and (held.predicted == held.quality).mean() > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_quality_edge_cases(spark):
    docs = docs_of(spark, ODD).unionByName(spark.createDataFrame([(None, "x"), (3, "a")], SCHEMA))
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in got)
    none = quality.classify(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    extra = docs.withColumn("score", F.lit("keep me"))
    assert quality.keep_good(extra, labels.where("false")).select("score").distinct().collect()[0][0] == "keep me"
    assert quality.classify(docs.where("false"), labels).count() == 0


def test_quality_learns_repetition_and_kind():
    good = [f"the cat number {i} sat on a mat near house {i % 7} and slept" for i in range(60)]
    bad = [f"buy{i} buy{i} buy{i} buy{i} buy{i} buy{i}" for i in range(60)]
    model = quality.train(good + bad, [1] * 60 + [0] * 60)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a cat sat near the house and slept", "new new new new new new"])], names=["text"])
    a, b = next(quality.scorer(model)(iter([batch]))).column("score").to_pylist()
    assert a > 0.5 > b


def test_quality_scores_are_averages_of_the_features(monkeypatch):
    """The memoised scorer against the features of ``document``, with tables and runs that end within texts."""
    rng = np.random.default_rng(1)
    model = {"word": rng.normal(0, 1, quality.BUCKETS + 1), "bias": 0.1}
    words = ["a", "bb", "straße", "日本", "x" * 40, "a", "👍"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 50, 700)] + [None, "new " * 300, " ".join(f"w{i}" for i in range(500))]
    for run, memo in ((1 << 18, 200_000), (64, 5)):
        monkeypatch.setattr(quality, "RUN", run)
        monkeypatch.setattr(quality, "MEMO", memo)
        import pyarrow as pa

        got = quality.Scorer(model).scores(pa.array([*texts, *texts]))
        for score, text in zip(got, [*texts, *texts]):
            ids, share = quality.document(text)
            assert score == pytest.approx(1 / (1 + np.exp(-(model["bias"] + share @ model["word"][ids]))))


def test_quality_of_long_and_repeated_rows(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(200_000))), (1, "a b"), (1, "a b"), (2, "a b")]
    got = quality.classify(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(2, 1), (1, 0)], "doc_id bigint, quality int")).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) <= 2


# WARC


def test_warc_round_trip(spark):
    html = ["<p>one</p>", "<p>é 😀</p>", "", None, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb", "<p>one</p>", "<p>one</p>", "z" * 200_000]
    rows = [(i, f"http://h/{i}?a=b", h, "extra") for i, h in enumerate(html)] + [(20, None, "<p>one</p>", ""), (None, "http://h/x y\r\nz", "q", ""), (5, "http://h/5?a=b", "<p>one</p>", "extra")]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id int, url string, html string, rid string"), path, records_per_file=5)
    got = warc.captures(warc.read_records(spark, path)).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = (r["response"]["payload"] if r["record_type"] == "response" else r["referred"]["payload"]) or ""
        want = {(p, h or "") for p, _, h, _ in rows}
        assert (r["page_id"], payload) in want
        assert r["request"] is not None and len(r["metadata"]) == 1
        digest = r["response"]["payload_digest"]
        assert digest == warc.sha1_base32(payload.encode())
    by = Counter((r["page_id"], r["record_type"], r["referred"] and r["referred"]["page_id"]) for r in got)
    assert by[20, "response", None] == 1 and by[5, "revisit", 20] == 2 and by[0, "revisit", 20] == 1
    assert by[2, "revisit", 3] == 1 and by[3, "response", None] == 1


def test_warc_below_the_least_size_all_are_responses(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string"), path, min_bytes=3)
    got = sorted((r["page_id"], r["record_type"]) for r in warc.captures(warc.read_records(spark, path)).collect())
    assert got == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_concurrent_to_in_either_direction(spark):
    rows = [("c1", "response", "r1", None, "t", None, 1, "D", "p"), ("r1", "request", None, None, "t", None, None, None, None), ("m1", "metadata", "c1", None, "t", 7, None, None, None), ("m2", "metadata", "gone", None, "t", 8, None, None, None)]
    got = warc.captures(spark.createDataFrame(rows, warc.RECORDS)).collect()
    assert len(got) == 1 and got[0]["request"]["record_id"] == "r1" and got[0]["page_id"] == 7


def test_warc_of_an_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.captures(warc.read_records(spark, path)).count() == 0


# BPE


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    return path, Tokenizer.from_file(path)


def test_bpe_equals_the_library(spark, sf, rows_of):
    path, tok = library("word_bpe_49k.json")
    rows = rows_of(table(spark, sf, "documents")) + list(enumerate(ODD, 10**6))
    got = {r["doc_id"]: r for r in bpe.encode_documents(spark.createDataFrame(rows, SCHEMA), path).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = tok.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == want and got[i]["n_tokens"] == len(want)
        assert got[i]["decoded"] == tok.decode(want, skip_special_tokens=False)


def test_bpe_query_digests(spark, sf, rows_of):
    _, tok = library("word_bpe_49k.json")
    got = {r["doc_id"]: r for r in bpe.query(spark, sf).collect()}
    for i, t in rows_of(table(spark, sf, "documents"))[:60]:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_random_letters():
    import random

    path, tok = library("word_bpe_49k.json")
    rnd, enc = random.Random(1), bpe.loaded(path)
    words = ["".join(rnd.choice("thenrasiouedgly'0!") for _ in range(rnd.randint(1, 24))) for _ in range(5000)]
    assert [enc.encode(w).tolist() for w in words] == [x.ids for x in tok.encode_batch(words, add_special_tokens=False)]


# token counts


def test_token_counts_equal_the_library_and_fill_the_cache(spark, rows_of, sf):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = rows_of(table(spark, sf, "documents"))[:80] + list(enumerate(ODD, 10**6)) + [(None, "copy"), (None, "copy"), (1, "copy"), (7, "<s></s><unk>")]
    df, cache = spark.createDataFrame(rows, SCHEMA), scratch_path(spark, "cache")
    got = token_counts.token_counts(df, path, cache=cache, limit=100).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 100) for i, t in rows), key=key)
    assert sorted(map(tuple, got), key=key) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t in rows})
    again = token_counts.token_counts(df.unionByName(spark.createDataFrame([(9, "something new")], SCHEMA)), path, cache=cache).collect()
    assert len(again) == len(rows) + 1 and spark.read.parquet(cache).count() == stored.count() + 1
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.token_counts(df, other, cache=cache).where("n_tokens is null").count() == 0
    assert token_counts.token_counts(df.where("false"), path, cache=cache).count() == 0


def test_missing_texts_without_ids_do_not_meet_each_other(spark):
    import public_tokenizers

    rows = [(None, f"text number {i}") for i in range(300)] + [(7, f"other text {i}") for i in range(300)]
    df, seen, plain = spark.createDataFrame(rows, SCHEMA), [], token_counts.rows_of_misses
    try:
        token_counts.rows_of_misses = lambda *a: seen.append(plain(*a).count()) or plain(*a)
        got = token_counts.token_counts(df, public_tokenizers.path("piece_bpe_32k.model"), cache=scratch_path(spark, "cache"))
    finally:
        token_counts.rows_of_misses = plain
    assert got.where("n_tokens > 0").count() == 600 and seen == [600]


# secrets


def plain_secrets(text):
    out = []
    for k, pattern, least, g in ((0, r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2), (1, r"AKIA[A-Z0-9]+", 20, 0), (2, r"[0-9a-f]+", 24, 0)):
        for m in re.finditer(pattern, text, re.A | (re.I if k == 0 else 0)):
            if len(m[g]) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


TRICKY = ["token=abc secret=token:abcdefgh", "PASSWORD: \"x1y2z3w4\" api-key=1 apikey='qwerty'", "AKIAAKIA" + "X" * 14, "AKIA" + "A1" * 8, "f" * 23 + " " + "0" * 24, "ſecret=abcdefgh toKen=abcdefgh", "é" * 5 + "secret = abc.def", "deadbeef" * 9 + "g"]


def test_base_spans(spark):
    rows = list(enumerate(ODD + TRICKY))
    got = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, t in rows:
        want = plain_secrets(t or "")
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(k == x[1] for x in want) for k in range(3))
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(got[i]["spans"].split(",")) or not joined


def test_secret_query_on_documents(spark, sf, rows_of):
    got = {r["doc_id"]: r["base_sha256"] for r in secrets.query(spark, sf).collect()}
    for i, t in rows_of(table(spark, sf, "documents")):
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in plain_secrets(t))
        assert got[i] == hashlib.sha256(joined.encode()).hexdigest()


def test_network_keeps_the_recall_and_redaction_keeps_rows(spark):
    import random

    rnd = random.Random(4)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    texts = [f"some words password={hexes(20)} and more" if i % 2 else f"see page www.example.com/article-{i:04d} today" for i in range(300)]
    net = secrets.train(texts)
    found = secrets.found(texts, net)
    assert all(f for i, f in enumerate(found) if i % 2)
    assert sum(bool(f) for i, f in enumerate(found) if not i % 2) <= 3
    df = spark.createDataFrame([(i, t, len(t), "x") for i, t in enumerate(texts)] + [(999, None, None, "x")], "doc_id bigint, text string, n_chars bigint, spans string")
    got = {r["doc_id"]: r for r in secrets.redact(df).collect()}
    assert len(got) == 301 and got[999]["text"] is None and got[1]["spans"] == "x"
    assert "password=" not in got[1]["text"] and got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == texts[2]


def test_threshold_is_the_quantile_that_keeps_the_recall():
    net = secrets.Network()
    # the raw score of a row is its first value; four hard positives lie among 2,000 negatives
    net.raw = lambda x: x[:, 0].astype(float)
    x = np.concatenate([np.linspace(-4, 1, 2000), [-1, 0, 0.5, 1, 3, 4]])[:, None]
    y = np.repeat([0, 1], [2000, 6])
    net.calibrate(x, y, 0.95)
    scores = net.score(x)
    assert net.threshold < 0.5 and (scores[y == 1] >= net.threshold).mean() >= 0.95
    assert net.precision == (y[scores >= net.threshold]).mean()


def test_partly_covered_candidates_are_scored():
    net = secrets.Network()
    net.raw, net.threshold = lambda x: np.ones(len(x)), 0.5
    key = "ZxY" + "a1" * 12 + "GHIJKLMNOP99"
    text = f"see {key} and {'b2' * 12} here"
    assert secrets.found([text], net) == [[(4, 3, 4 + len(key)), (7, 2, 31), (text.index("b2"), 2, text.index(" here"))]]


def test_nothing_to_learn_from():
    assert secrets.train([]) is None and secrets.train(["no candidate here"]) is None


def test_network_learns_from_every_document(spark, monkeypatch):
    """All candidates with their numbers, beyond any bound on documents; several parts; the same network again."""
    import random

    rnd = random.Random(8)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(20))
    texts = [f"some words password={key()} and more" if i % 2 else f"see page www.example.com/article-{i:04d} today" for i in range(4000)] + ["copy token=0123456789abcdef01 copy"] * 30
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate([*texts, None, ""])], "doc_id bigint, text string").repartition(5)
    want = {}
    for t in texts:
        for w, y in secrets.labelled(t):
            want[w.tobytes(), y] = want.get((w.tobytes(), y), 0) + 1
    rows = secrets.training_rows(df)
    assert {(bytes(r["x"]), r["y"]): r["n"] for r in rows.collect()} == want and sum(want.values()) == 4030
    monkeypatch.setattr(secrets, "PART_ROWS", 1500)
    nets = [secrets.fitted(df.repartition(n)) for n in (3, 6)]
    assert all((a == b).all() for a, b in zip(nets[0].p, nets[1].p)) and nets[0].threshold == nets[1].threshold
    found = secrets.found(texts, nets[0])
    assert sum(any(k == 3 for _, k, _ in f) for f in found[:4000:2]) <= 20
    hits = [nets[0].score(np.stack([w for w, y in secrets.labelled(t) if y])) >= nets[0].threshold for t in texts if "=" in t]
    assert np.mean(hits) >= 0.9


def test_calibration_on_a_table_is_that_on_arrays(spark):
    rng = np.random.default_rng(2)
    net, plain = secrets.Network(), secrets.Network()
    x = rng.integers(32, 127, (300, secrets.LEFT + secrets.BODY + secrets.RIGHT)).astype(np.uint8)
    y, n = (rng.random(300) < 0.3).astype(int), rng.integers(1, 9, 300)
    plain.calibrate(np.repeat(x, n, 0), np.repeat(y, n), 0.95)
    rows = spark.createDataFrame([(bytes(a), int(b), int(c)) for a, b, c in zip(x, y, n)], "x binary, y int, n bigint")
    secrets.calibrate_on(net, rows, 0.95)
    assert np.allclose([net.slope, net.shift, net.threshold, net.precision], [plain.slope, plain.shift, plain.threshold, plain.precision], atol=1e-5)


# neighbours


def exact(rows, k=20):
    x = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and all(a is not None and np.isfinite(a) for a in v) and any(v)}
    out = {}
    for q in x:
        if q % 20 == 0:
            out[q] = sorted(((-float(x[q] @ x[c]), c) for c in x if c != q))[:k]
    return out


def check_neighbours(got, want):
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {q for q, w in want.items() if w}
    hits = total = 0
    for q, w in want.items():
        mine = sorted(by.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(w) + 1))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len({m[1] for m in mine} & {c for _, c in w})
        total += len(w)
    return hits / max(total, 1)


def test_recall_on_the_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    assert check_neighbours(neighbours.query(spark, sf).collect(), exact(rows)) >= 0.95


def test_neighbour_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(a) for a in np.float32(rng.normal(size=8))]) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(200, 330)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0, None] + [1.0] * 6), (None, rows[5][1]), (420, [float("inf")] + [1.0] * 7), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("clash"))
    got = neighbours.nearest(df, F.col("id") % 20 == 0).collect()
    assert check_neighbours(got, exact(dict((i, v) for i, v in rows if i is not None).items())) >= 0.95
    copies = [r["vec_id"] for r in got if r["query_id"] == 200 and (r["vec_id"] == 3 or 200 <= r["vec_id"] < 330)]
    assert copies and copies == [3, *range(201, 330)][: len(copies)]


def test_recall_where_the_index_leaves_out_files_and_rows(spark):
    x = np.float32(np.random.default_rng(1).normal(size=(9000, 48)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(df, F.col("id") % 300 == 0, posts=2, probes=16, least=20).select("query_id", "vec_id").collect()
    score = x[::300].astype(float) @ x.T.astype(float)
    score[np.arange(30), np.arange(0, 9000, 300)] = -np.inf
    want = {(300 * q, int(c)) for q, row in enumerate(score) for c in np.argsort(-row)[:20]}
    recall = len({tuple(r) for r in got} & want) / len(want)
    print("recall", recall)
    assert len(got) == 600 and recall >= 0.9


def test_few_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert neighbours.nearest(spark.createDataFrame([], schema), F.col("id") % 20 == 0).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0])], schema), F.col("id") % 20 == 0).collect() == []
    two = neighbours.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], schema), F.col("id") % 20 == 0).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 11.0)]


# decontamination


def edit_distance_inside(segment, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(segment, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j - 1] + (c != d), last[j] + 1, row[-1] + 1))
    return min(row)


def plain_leaks(text, items):
    text, out = decontaminate.normal(text), []
    for item, t in items:
        t = decontaminate.normal(t)
        if len(t) < decontaminate.Q:
            continue
        last = max(0, len(t) - decontaminate.SEGMENT)
        segments = [t[s : s + decontaminate.SEGMENT] for s in sorted({*range(0, last, decontaminate.SEGMENT // 2), last})]
        hits = [d for s in segments if (d := edit_distance_inside(s, text)) <= len(s) // decontaminate.RATE]
        if hits:
            out.append((item, min(hits), len(hits)))
    return sorted(out)


def test_leaks_against_plain_alignment():
    import random

    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 30)))) for i in range(12)] + [(50, "tiny")]
    texts = ["", "x"]
    for _ in range(40):
        t = " ".join(word() for _ in range(rnd.randint(0, 30)))
        p = list(rnd.choice(items)[1])
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 8])):
            k = rnd.randrange(len(p))
            p[k : k + 1] = rnd.choice(["", "Z", p[k] + "q"])
        cut = rnd.randrange(max(1, len(p) // 3))
        texts.append(t + " " + "".join(p)[cut:] + " " + t[::-1])
    index = decontaminate.Index(items)
    assert decontaminate.leaks(index, [decontaminate.normal(t) for t in texts]) == [plain_leaks(t, items) for t in texts]


def test_leaks_look_up_a_stretch_of_characters_at_a_time(monkeypatch):
    """What a slice of texts takes is a few numbers a character, and a passage over the border of two stretches is found."""
    rnd = np.random.default_rng(8)
    word = lambda: "".join(map(chr, rnd.integers(97, 123, 7)))
    words = [word() for _ in range(3000)]
    item = " ".join(words[:40])
    index = decontaminate.Index([(1, item)])
    texts = [" ".join(rnd.choice(words[40:], 400)) for _ in range(300)]
    texts[7] += " " + item
    tracemalloc.start()
    try:
        got = decontaminate.leaks(index, texts, every_start=True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [i for i, x in enumerate(got) if x] == [7]
    assert peak < 24 * sum(map(len, texts))
    for step in (50, 64, 1001):
        monkeypatch.setattr(decontaminate, "STEP", step)
        assert decontaminate.leaks(index, texts[5:9], every_start=True) == got[5:9]


def test_leaks_at_every_start():
    import random

    rnd = random.Random(6)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    limit = lambda n: n // decontaminate.RATE
    items = [(i, letters(rnd.randint(65, 400))) for i in range(6)] + [(10 + n, letters(n)) for n in range(20, 24)]
    texts, wanted = [letters(50) + items[0][1][40:120] + letters(70)], 0
    for _ in range(60):
        t = rnd.choice(items)[1]
        a = rnd.randint(0, max(0, len(t) - 64))
        p = list(t[a : a + rnd.randint(60, 95)])
        for _ in range(rnd.choice([0, 1, 2, 3, 4])):
            k = rnd.randrange(len(p))
            p[k : k + 1] = rnd.choice(["", "Z", p[k] + "q"])
        texts.append(letters(rnd.randint(0, 200)) + "".join(p) + letters(rnd.randint(0, 200)))
    texts.append(letters(30) + items[-1][1][:11] + "Z" + items[-1][1][12:] + letters(30))
    got = decontaminate.leaks(decontaminate.Index(items), [decontaminate.normal(t) for t in texts], every_start=True)
    assert [r[0] for r in got[0]] == [0] and [r[0] for r in got[-1]] == [items[-1][0]]
    for text, mine in zip(texts, got):
        text = decontaminate.normal(text)
        want = {}
        for i, t in items:
            # only items that share eight characters can be near
            if any(t[s : s + 8] in text for s in range(len(t) - 7)):
                best = min(edit_distance_inside(t[s : s + 64], text) for s in range(max(1, len(t) - 63)))
                if best <= limit(min(len(t), 64)):
                    want[i] = best
        assert {i for i, _, _ in mine} == set(want)
        assert all(e == want[i] if n == 0 else want[i] <= e <= limit(64) for i, e, n in mine)
        wanted += sum(n == 0 for _, _, n in mine)
    assert wanted > 5


def test_clean_removes_items_without_an_id(spark):
    item = "The quick brown fox jumps over the lazy dog while seventeen small birds sing in the old apple tree."
    docs = spark.createDataFrame([(1, "intro " + item), (2, "nothing of the kind")], SCHEMA)
    bench = spark.createDataFrame([(None, item), (None, "another item that nobody quotes, but long enough")], "item_id bigint, text string")
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_contaminated_and_clean(spark):
    item = "The quick brown fox jumps over the lazy dog while seventeen small birds sing in the old apple tree."
    docs = spark.createDataFrame([(1, "intro " + item.upper() + " outro", 1), (2, "nothing of the kind", 2), (3, None, 3), (None, item, 4), (None, item, 4), (5, item.replace("seventeen", "seventen").replace(" ", "\n "), 5)], "doc_id bigint, text string, edits int")
    bench = spark.createDataFrame([(7, item, "x"), (8, None, ""), (None, item, ""), (9, "short", "")], "item_id bigint, text string, doc_id string")
    for size in (4_000_000, 40):
        got = sorted((tuple(r)[:3] for r in decontaminate.contaminated(docs, bench, block_chars=size).collect()), key=repr)
        assert got == sorted([(1, 7, 0), (None, 7, 0), (None, 7, 0), (5, 7, 1)], key=repr)
        assert sorted(r["edits"] for r in decontaminate.clean(docs, bench, block_chars=size).collect()) == [2, 3]
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0
    assert decontaminate.clean(docs, bench.where("false")).count() == 6
    assert decontaminate.contaminated(docs.where("false"), bench).count() == 0


# pipeline


def test_pipeline(spark, sf, rows_of):
    import brute

    import corpus_pipeline as cp

    docs = table(spark, sf, "documents")
    columns, frames = docs.columns, []
    for _, stage in cp.STAGES[:4]:
        docs = cp.written(stage(spark, docs, sf), "stage")
        assert docs.columns == columns
        frames.append(rows_of(docs))
    good, single, clean, safe = frames
    assert {i for i, _ in single} == {i for i, _, c in brute.components(good) if i == c}
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    index = decontaminate.Index(items)
    assert {i for i, _ in clean} == {i for i, t in single if not decontaminate.leaks(index, [decontaminate.normal(t)])[0]}
    assert len(safe) == len(clean) and not any(plain_secrets(t) for _, t in safe)
    path, tok = library("word_bpe_49k.json")
    out = {r["doc_id"]: r["ids"] for r in cp.run(spark, sf).collect()}
    assert {i: tok.encode(t, add_special_tokens=False).ids for i, t in safe} == out


def test_labels_and_entry():
    import __spark_entry__ as e

    fns, sqls = e.queries(), e.oracle_sql()
    assert sorted(int(k[2:].split("_")[0]) for k in fns if re.match(r"op\d+_", k)) == list(range(1, 14))
    assert "pipeline" in fns and set(sqls) <= set(fns)


def test_token_counts_encode_repeated_rows_once(monkeypatch):
    """What the encoder writes is what it has encoded: one row of each content, however often it comes."""
    import public_tokenizers
    import pyarrow as pa

    texts = [f"text number {i % 7}" for i in range(500)]
    batches = [pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(t.encode()).digest() for t in part]), pa.array(part)], names=["content", "text"]) for part in (texts[:300], texts[300:], ["text number 1"] * 40)]
    path = public_tokenizers.path("piece_bpe_32k.model")
    out = [r for b in token_counts.encoder(path)(iter(batches)) for r in b.to_pylist()]
    assert len(out) == 7 and len({r["content"] for r in out}) == 7
    # a table of digests that is full starts afresh; equal rows that follow each other are still encoded once
    monkeypatch.setattr(token_counts, "SEEN", 2)
    out = [r for b in token_counts.encoder(path)(iter([batches[2]] * 3)) for r in b.to_pylist()]
    assert len(out) == 1
