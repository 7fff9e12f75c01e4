"""Secret scans: fixed patterns, and a character convolutional network over every candidate.

Base findings come from three patterns. A candidate is a run of at least 16 key characters with a
digit in it; the network (numpy: character vectors, one convolution, maximum over positions, logistic
output) reads each candidate with the characters around it, longer ones in overlapping pieces of which
the most suspicious counts. It is trained on labelled findings: the candidates of all documents, positive
where a base pattern found them. Equal candidates in equal surroundings become one row with its number,
which is its weight. Training runs in rounds on Spark: in a round each part of the rows makes one pass from the
network of the round before, and the parts' networks are averaged by their weight. A quarter of the rows of each
class, by a hash, is kept out of training. The scores are calibrated on all of those, and the threshold is the
highest one that keeps ``recall`` of the positives there; ``Network.precision`` is the share of positives among
the rows kept out that reach it.
The network reads every candidate that base spans do not cover whole and adds spans of kind ``cnn``, which
may overlap base spans; base spans always stay.

Null and empty texts have no spans. With fewer than four positive or negative candidates nothing
can be learnt and only base spans are returned. Repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import slices, table, written

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A match is a whole run of hex digits, so the short ones need not be matched to be dropped.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ("assign", "access", "hex", "cnn")
LEFT, BODY, RIGHT = 24, 40, 8
WIDTH, FILTERS, VECTOR = 5, 16, 8
EPOCHS, RATE = 10, 3e-3
#: Rows of a training part while there are few parts. Their number is bounded, as the driver averages one
#: network of a few thousand numbers for each; with more rows the parts grow.
PART_ROWS, MAX_PARTS = 4096, 256


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in RUN.finditer(text) if any(c.isdigit() for c in m[0])]


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Character classes around the candidate, in pieces that overlap by half."""
    out = []
    for at in range(start, max(start + 1, end - BODY // 2), BODY // 2):
        left, body, right = text[max(0, at - LEFT) : at], text[at : min(end, at + BODY)], text[at + BODY : at + BODY + RIGHT] if at + BODY < end else text[end : end + RIGHT]
        s = left.rjust(LEFT, "\0") + body.ljust(BODY, "\0") + right.ljust(RIGHT, "\0")
        codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
        out.append(np.where(codes < 127, codes, 127).astype(np.uint8))
    return out


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, 0.3, (128, VECTOR)), rng.normal(0, 0.15, (WIDTH * VECTOR, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, FILTERS), np.zeros(1)]
        self.slope, self.shift, self.threshold, self.precision = 1.0, 0.0, 2.0, 1.0

    def _forward(self, x: np.ndarray):
        chars, conv, cb, w, b = self.p
        e = chars[x]
        n = x.shape[1] - WIDTH + 1
        cols = np.concatenate([e[:, k : k + n] for k in range(WIDTH)], axis=2)
        h = cols @ conv + cb
        at = h.argmax(axis=1)
        top = np.take_along_axis(h, at[:, None, :], 1)[:, 0]
        return cols, at, top, np.maximum(top, 0) @ w + b[0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = [self._forward(x[k : k + 1024])[3] for k in range(0, len(x), 1024)]
        return np.concatenate(out) if out else np.zeros(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))

    def one_pass(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, moments: tuple, rng) -> tuple:
        """One pass of Adam over the rows in random order; returns the moments and the number of steps."""
        m, v, t = [a.copy() for a in moments[0]], [a.copy() for a in moments[1]], moments[2]
        order = rng.permutation(len(y))
        for k in range(0, len(y), 64):
            i = order[k : k + 64]
            cols, at, top, z = self._forward(x[i])
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) * weight[i] / len(i)
            chars, conv, cb, w, b = self.p
            g_top = np.outer(d, w) * (top > 0)
            picked = np.take_along_axis(cols, at[:, :, None], 1)  # row, filter, inputs
            g_conv = np.einsum("nf,nfi->if", g_top, picked)
            g_cols = g_top[:, :, None] * conv.T[None]
            g_chars = np.zeros_like(chars)
            spots = np.take_along_axis(x[i][:, None, :], (at[:, :, None] + np.arange(WIDTH)), 2)
            np.add.at(g_chars, spots, g_cols.reshape(*g_cols.shape[:2], WIDTH, VECTOR))
            grads = [g_chars, g_conv, g_top.sum(0), np.maximum(top, 0).T @ d, np.array([d.sum()])]
            t += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                self.p[j] = self.p[j] - RATE * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
        return m, v, t

    def start(self) -> tuple:
        return [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0

    def fit(self, x: np.ndarray, y: np.ndarray, *, epochs: int = EPOCHS, seed: int = 5) -> None:
        """On rows at hand."""
        rng, moments = np.random.default_rng(seed), self.start()
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        for _ in range(epochs):
            moments = self.one_pass(x, y, weight, moments, rng)

    def pack(self, moments: tuple) -> np.ndarray:
        return np.concatenate([a.ravel() for part in (self.p, *moments[:2]) for a in part])

    def unpack(self, numbers: np.ndarray) -> tuple[list, list]:
        """Takes the weights of a packed network and returns its moments."""
        shapes = [a.shape for a in self.p] * 3
        ends = np.cumsum([int(np.prod(n)) for n in shapes])
        parts = [a.reshape(n) for a, n in zip(np.split(numbers, ends[:-1]), shapes)]
        self.p = parts[:5]
        return parts[5:10], parts[10:]

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Platt scaling by Newton steps, then the highest threshold that keeps the recall."""
        z, a, b = self.raw(x), 1.0, 0.0
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            g, s = p - target, p * (1 - p) + 1e-9
            hess = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
            step = np.linalg.solve(hess, [(g * z).sum(), g.sum()])
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        self.slope, self.shift = max(float(a), 1e-3), float(b)
        scores = self.score(x)
        hits = np.sort(scores[y == 1])
        self.threshold = float(hits[len(hits) - int(np.ceil(recall * len(hits)))])
        self.precision = float(y[scores >= self.threshold].mean())


def labelled(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """Each candidate with its surroundings, and whether a base pattern found it."""
    base = base_spans(text)
    for s, e in candidates(text):
        yield windows(text, s, e)[0], int(any(a < e and s < b for a, _, b in base))


def train(texts: list[str], *, recall: float = 0.95) -> Network | None:
    """The network fitted to the candidates of texts at hand; None if a class is missing."""
    xs: list[list[np.ndarray]] = [[], []]
    for text in texts:
        for window, label in labelled(text):
            xs[label].append(window)
    if min(len(xs[0]), len(xs[1])) < 4:
        return None
    x = np.stack(xs[0] + xs[1])
    y = np.repeat([0, 1], [len(xs[0]), len(xs[1])])
    order = np.random.default_rng(11).permutation(len(y))
    # a quarter of each class, so that there is always a recall to hold
    test = np.zeros(len(y), bool)
    for c in (0, 1):
        mine = order[y[order] == c]
        test[mine[: len(mine) // 4]] = True
    kept, rest = order[test[order]], order[~test[order]]
    net = Network()
    net.fit(x[rest], y[rest])
    net.calibrate(x[kept], y[kept], recall)
    return net


def covered(start: int, end: int, base: list[tuple[int, int, int]]) -> bool:
    """Whether the (sorted) base spans together cover all of a stretch."""
    for a, _, b in base:
        if a > start:
            break
        start = max(start, b)
    return start >= end


def found(texts: list[str], net: Network | None) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of each text."""
    base = [base_spans(t) for t in texts]
    if net is None:
        return base
    rows, at = [], []
    for i, t in enumerate(texts):
        for s, e in candidates(t):
            if not covered(s, e, base[i]):
                w = windows(t, s, e)
                rows += w
                at += [(i, s, e)] * len(w)
    best: dict[tuple[int, int, int], float] = {}
    for key, p in zip(at, net.score(np.stack(rows)) if rows else []):
        best[key] = max(best.get(key, 0.0), p)
    for (i, s, e), p in best.items():
        if p >= net.threshold:
            base[i].append((s, 3, e))
    return [sorted(b) for b in base]


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def training_rows(docs: DataFrame) -> DataFrame:
    """(x, y, n, h): the different labelled candidates of all documents, how often each comes, and a hash of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [(w.tobytes(), y) for t in part.column("text").to_pylist() if t for w, y in labelled(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())], names=["x", "y"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "x binary, y int")
    return found.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64("x", "y"))


def arrays(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y and n of rows in a fixed order."""
    t = t.sort_by([("x", "ascending"), ("y", "ascending")])
    x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.uint8).reshape(t.num_rows, -1)
    return x, t.column("y").to_numpy().astype(float), t.column("n").to_numpy().astype(float)


def fit_rounds(rows: DataFrame, *, seed: int = 5) -> Network:
    """The network trained on all rows (x, y, n, h), each weighing as often as it comes and both classes the same."""
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("n1")).first()
    parts = min(MAX_PARTS, -(-size["rows"] // PART_ROWS))
    each = [size["rows"] * 0.5 / max(size["n"] - size["n1"], 1), size["rows"] * 0.5 / max(size["n1"], 1)]
    placed = rows.select("x", "y", "n", F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int").alias("part"))
    net = Network()
    state, steps = net.pack(net.start()), 0

    def round_of(epoch: int, state: np.ndarray, steps: int):
        def run(t):
            part = t.column("part")[0].as_py()
            x, y, n = arrays(t)
            weight = n * np.where(y == 1, each[1], each[0])
            local = Network()
            m, v, done = local.one_pass(x, y, weight, (*local.unpack(state), steps), np.random.default_rng([seed, epoch, part]))
            return pa.table({"part": pa.array([part], pa.int32()), "weight": pa.array([weight.sum()]), "steps": pa.array([done], pa.int64()), "state": pa.array([local.pack((m, v)).tolist()], pa.list_(pa.float64()))})

        return run

    for epoch in range(EPOCHS):
        run = round_of(epoch, state, steps)
        got = sorted(placed.groupBy("part").applyInArrow(run, "part int, weight double, steps bigint, state array<double>").collect(), key=lambda r: r["part"])
        state = sum(r["weight"] * np.array(r["state"]) for r in got) / sum(r["weight"] for r in got)
        steps = max(r["steps"] for r in got)
    net.unpack(state)
    return net


def nth_smallest(rows: DataFrame, value: str, n: str, rank: int) -> float:
    """The value at a rank (from 0) of the rows, each counted ``n`` times: exact, by bins that narrow."""
    edges = rows.agg(F.min(value), F.max(value)).first()
    low, high, below = edges[0], edges[1], 0
    while low < high:
        bin_ = F.least(F.floor((F.col(value) - low) / (high - low) * 1024), F.lit(1023))
        inside = rows.where((F.col(value) >= low) & (F.col(value) <= high))
        for r in sorted(inside.groupBy(bin_.alias("bin")).agg(F.sum(n).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()):
            if below + r["n"] > rank:
                low, high = r["low"], r["high"]
                break
            below += r["n"]
    return low


def calibrate_on(net: Network, rows: DataFrame, recall: float) -> None:
    """As ``Network.calibrate`` does, on a table of rows (x, y, n) of any size. Sums are decimal, so that they do not
    depend on the order of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([pa.array(net.raw(x)), b.column("y"), b.column("n")], names=["z", "y", "n"])

    held = written(rows.select("x", "y", "n").mapInArrow(run, "z double, y int, n bigint"), "held")
    z, n, positive = F.col("z"), F.col("n"), F.col("y") == 1
    counts = held.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("n1")).first()
    target = F.when(positive, (counts["n1"] + 1) / (counts["n1"] + 2)).otherwise(1 / (counts["n"] - counts["n1"] + 2))
    total = lambda c: F.sum((n * c).cast("decimal(30,12)")).cast("double")
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.least(F.greatest(a * z + b, F.lit(-30.0)), F.lit(30.0))))
        g, s = p - target, p * (1 - p) + 1e-9
        gz, g1, szz, sz, s1 = held.agg(total(g * z), total(g), total(s * z * z), total(s * z), total(s)).first()
        step = np.clip(np.linalg.solve(np.array([[szz + 1e-3, sz], [sz, s1 + 1e-3]]), [gz, g1]), -1, 1)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    net.slope, net.shift = max(float(a), 1e-3), float(b)
    least = nth_smallest(held.where(positive), "z", "n", counts["n1"] - int(np.ceil(recall * counts["n1"])))
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.slope * least + net.shift, -30, 30))))
    reach = held.where(z >= least).agg(F.sum(F.col("n") * F.col("y")).alias("n1"), F.sum("n").alias("n")).first()
    net.precision = reach["n1"] / reach["n"]


def fitted(docs: DataFrame, *, recall: float = 0.95) -> Network | None:
    """The network, trained and calibrated on the candidates of all documents; None if a class is missing."""
    rows = written(training_rows(docs), "candidates")
    about = {r["y"]: r for r in rows.groupBy("y").agg(F.sum("n").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")).collect()}
    if any(y not in about or about[y]["n"] < 4 for y in (0, 1)):
        return None
    # a quarter of the hashes; at least one row of each class on either side, and a single one on both
    held, used = F.lit(False), F.lit(False)
    for y, r in about.items():
        kept_out = F.col("h") <= max(-(2**63) + 2**62, r["low"])
        one = r["low"] == r["high"]
        held |= (F.col("y") == y) & (F.lit(True) if one else kept_out & (F.col("h") < r["high"]))
        used |= (F.col("y") == y) & (F.lit(True) if one else ~kept_out | (F.col("h") == r["high"]))
    net = fit_rounds(rows.where(used))
    calibrate_on(net, rows.where(held), recall)
    return net


def scan(docs: DataFrame, **how) -> DataFrame:
    """doc_id, counts of base findings, their digest, and all spans of each row."""
    net = fitted(docs, **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            spans = found(texts, net)
            base = [[x for x in s if x[1] < 3] for s in spans]
            counts = [pa.array([sum(x[1] == k for x in b) for b in base], pa.int64()) for k in range(3)]
            digest = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, digest, pa.array(map(joined, spans), pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[SECRET]", **how) -> DataFrame:
    """The rows of ``docs`` with each span replaced by ``mark``; rows, order of columns and other values stay."""
    net = fitted(docs, **how)

    def clean(text: str, spans) -> str:
        out, at = [], 0
        for s, _, e in spans:
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            spans = found([t or "" for t in texts], net)
            new = pa.array([t if not s else clean(t, s) for t, s in zip(texts, spans)], pa.string())
            yield part.set_column(part.schema.get_field_index("text"), pa.field("text", pa.string()), new)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
