"""BPE encoding and decoding for vocabularies with word ends.

Encoding: a text is cut at its special strings, normalised and split into pieces by the tokenizer
file's own rules; each piece is encoded by a backtracking search over longest token matches. All
matches come from an Aho-Corasick automaton; a token may follow another only if the pair is
compatible, which a table of the merges at both edges of each token tells, and a bit field of dead
positions bounds the work by the length of the piece. Decoding gathers the
bytes of all tokens from one buffer by an offset table.

White space ends a piece and is dropped, so a text is a sequence of runs without blanks, and each
distinct run is encoded once per task. Null and empty texts have no tokens.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import slices, table

#: A character of the private area marks the end of a word.
END = "\ue000"
RUN = re.compile(r"[^ \t\n\r]+")
#: Printable ASCII and the letters of Latin-1, whose lower-case forms are single letters in composed form.
PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
#: Entries of each of a worker's two tables before they start afresh.
MEMO = 600_000
#: A worker's encoders by path.
LOADED: dict[str, Encoder] = {}


def loaded(path: str) -> Encoder:
    if path not in LOADED:
        LOADED[path] = Encoder(path)
    return LOADED[path]


class Runs(dict):
    """Encoded runs; a run is encoded when it is first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, run: str) -> bytes:
        got = self.encode(run)
        if len(run) < 60:
            if len(self) > MEMO:
                self.clear()
            self[run] = got
        return got


class Encoder:
    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rules = Tokenizer.from_file(path)
        self.normalise = rules.normalizer.normalize_str
        self.split = rules.pre_tokenizer.pre_tokenize_str
        self.suffix = spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.ids = {self._in(t): i for t, i in spec["model"]["vocab"].items()}
        self.rank = {(self.ids[self._in(a)], self.ids[self._in(b)]): i for i, (a, b) in enumerate(pairs)}
        self.made = {i: self.ids[self._in(a) + self._in(b)] for i, (a, b) in enumerate(pairs)}
        #: Of a token: the two that its last merge joins, and that merge's rank.
        self.parts: dict[int, tuple[int, int, int]] = {}
        auto = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if self._builds(t, i):  # a token that its own merges do not build is never the result
                auto.add_word(t, (i, len(t)))
        auto.make_automaton()
        self.auto = auto
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.pieces: dict[str, bytes] = {}
        self.runs = Runs(self.run)
        self.latin = {c: self.split(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c != "\u00f7"}
        names = sorted({**{i: t for t, i in spec["model"]["vocab"].items()}, **{i: t for t, i in self.special.items()}}.items())
        self.table = OffsetTable(names)

    def _in(self, token: str) -> str:
        """Inside, the mark of a word's end is one character."""
        return token[: -len(self.suffix)] + END if token.endswith(self.suffix) else token

    def _builds(self, s: str, token: int) -> bool:
        """Whether merging the characters of ``s`` by rank, leftmost first, ends in ``token``; notes the last merge."""
        parts = [self.ids[c] for c in (list(s[:-2]) + [s[-2:]] if s.endswith(END) and len(s) > 1 else list(s))]
        while len(parts) > 1:
            best, i = min((self.rank.get(ab, 1 << 60), i) for i, ab in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                return False
            last = (parts[i], parts[i + 1], best)
            parts[i : i + 2] = [self.made[best]]
        if len(s) > 1 and not (len(s) == 2 and s.endswith(END)):
            self.parts[token] = last
        return parts == [token]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge while ``token`` is built, each with the rank of the merge that ends it."""
        out, ends = [], 1 << 60
        while True:
            out.append((token, ends))
            if token not in self.parts:
                return out[::-1]
            a, b, ends = self.parts[token]
            token = b if side else a

    def compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` followed by ``b`` stays as it is: no merge over their border comes before the merges
        that replace the two tokens at it. Of equal merges the left one comes first."""
        right, left = self.right.get(a), self.left.get(b)
        if right is None:
            right = self.right[a] = self._edge(a, 1)
        if left is None:
            left = self.left[b] = self._edge(b, 0)
        rank, i, j = self.rank, 0, 0
        while True:
            x, x_ends = right[i]
            y, y_ends = left[j]
            r = rank.get((x, y))
            if r is not None and r < x_ends and r <= y_ends:
                return False
            if x_ends <= y_ends:
                if x_ends == 1 << 60:
                    return True
                i += 1
            else:
                j += 1

    def piece(self, piece: str) -> list[int]:
        """The tokens of one piece: the longest matches from the left if each pair is compatible, else by backtracking."""
        s = piece + END
        out, at = [], 0
        for end, (i, n) in self.auto.iter_long(s):
            if end - n + 1 != at or (out and not self.compatible(out[-1], i)):
                break
            out.append(i)
            at = end + 1
        return out if at == len(s) else self._backtrack(s)

    def _backtrack(self, s: str) -> list[int]:
        matches: list[list[tuple[int, int]]] = [[] for _ in range(len(s))]
        for end, (i, n) in self.auto.iter(s):
            matches[end - n + 1].append((n, i))
        for m in matches:
            m.sort()
        dead, out, at = bytearray(len(s) + 1), [], 0
        choice = [len(matches[0]) - 1]
        while at < len(s):
            k, found = choice[-1], False
            while k >= 0:
                n, i = matches[at][k]
                if not dead[at + n] and (not out or self.compatible(out[-1][1], i)):
                    found = True
                    break
                k -= 1
            if found:
                choice[-1] = k
                out.append((n, i))
                at += n
                choice.append(len(matches[at]) - 1 if at < len(s) else -1)
                continue
            if not out:
                raise ValueError("a character without a token")
            # compatible tokens up to here are the only ones, so no other way leads on from here either
            dead[at] = 1
            choice.pop()
            at -= out.pop()[0]
            choice[-1] -= 1
        return [i for _, i in out]

    def _piece_bytes(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            got = np.asarray(self.piece(piece), "<u4").tobytes()
            if len(piece) < 60:
                if len(self.pieces) > MEMO:
                    self.pieces.clear()
                self.pieces[piece] = got
        return got

    def run(self, run: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without blanks, tabs and line ends."""
        if not PLAIN.fullmatch(run) or "<|" in run:
            return self._general(run)
        # Latin letters: the same pieces as by the general rules, without their cost
        low = run.lower()
        pieces = PIECES.findall(low)
        if not low.isascii():
            pieces = ["".join([self.latin.get(c, c) for c in p]) for p in pieces]
        return b"".join(map(self._piece_bytes, pieces))

    def _general(self, run: str) -> bytes:
        out, start = [], 0
        for m in [*self.cut.finditer(run), None]:
            out += [self._piece_bytes(p) for p, _ in self.split(self.normalise(run[start : m.start() if m else len(run)]))]
            if m:
                out.append(np.asarray([self.special[m[0]]], "<u4").tobytes())
                start = m.end()
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.runs.__getitem__, RUN.findall(text or ""))), "<u4")


class OffsetTable:
    """The bytes of all tokens in one buffer, each followed by a blank, and where each starts."""

    def __init__(self, names: list[tuple[int, str]]):
        parts = [b""] * (names[-1][0] + 1)
        for i, t in names:
            parts[i] = t.encode() + b" "
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by blanks, as a tokenizer without a decoder joins them."""
        out = []
        for k in range(0, len(ids), 1 << 18):
            part = ids[k : k + (1 << 18)]
            first, n = self.starts[part], self.starts[part + np.uint32(1)] - self.starts[part]
            shift = first - (np.cumsum(n) - n)
            out.append(self.data[np.repeat(shift, n) + np.arange(int(n.sum()))].tobytes())
        return b"".join(out)[:-1]


def coder(path: str, *what: str):
    """A function for mapInArrow: doc_id, n_tokens and the named columns of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = loaded(path)
        for part in slices(batches, limit=2 << 20):
            ids = [enc.encode(t.as_py()) for t in part.column("text")]
            text = [enc.table.decode(i) for i in ids]
            n = np.array([len(i) for i in ids], np.int64)
            cols = [part.column("doc_id"), pa.array(n)]
            for name in what:
                if name == "ids":
                    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32)))
                elif name == "decoded":
                    cols.append(pa.array([t.decode() for t in text], pa.string()))
                else:
                    cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in (text if name == "decoded_sha256" else [i.tobytes() for i in ids])], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", *what])

    return run


KINDS = {"ids": "array<int>"}


def coded(docs: DataFrame, path: str, *what: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(coder(path, *what), ", ".join(["doc_id bigint", "n_tokens bigint", *[f"{c} {KINDS.get(c, 'string')}" for c in what]]))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded text of each row."""
    return coded(docs, path, "ids", "decoded")


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the decoded text of each row."""
    return coded(docs, path, "ids", "decoded_sha256")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text of each row."""
    return coded(docs, path, "ids_sha256", "decoded_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
