"""Phrase collocations mined by Rabin-Karp fingerprints.

Prefix polynomials (numpy, modulo 2^64) over the bytes give every word its hash, and prefix polynomials over
the word hashes give every n-gram its fingerprint by one subtraction and one product, with the language
mixed in. Tasks count fingerprints before the shuffle, so neither a frequent phrase nor a language with a third
of all rows weighs more than its distinct fingerprints.

A phrase is not more frequent than its parts. So words come first, then pairs of frequent words, then
phrases of three to five words all of whose pairs are frequent; what may be frequent is known to the tasks as
a bit map of fingerprints. It has 16 bits for each frequent one and ``BITS`` at most; a fuller map lets more
fingerprints into the shuffle and changes no count.

The last pass finds the occurrences of frequent fingerprints again. Each points to its words in the text of
its slice; occurrences with one fingerprint are compared with the text at the first pointer, those that differ
are told apart, and only then is the phrase written out, once for each slice that holds it. The final counts
are sums by phrase, not by fingerprint: a collision of fingerprints can cost a row of the shuffle, never a result.

* A null text is empty, a null language is ``und`` (one group with rows that say ``und``).
* Repeated rows and copies count each time. Ids are not used. Extra columns are ignored.
* An empty table, or one without a frequent phrase, gives no rows. Long texts are read whole.
* Ties of the score at the limit are settled by frequency, then by the phrase in byte order.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.llm.common import bytes_of, mix, slices, table, written
from voltide.llm.words import BASE, LOWER

LONGEST = 5
#: Bits of the map of frequent fingerprints, at most (32 MB).
BITS = 1 << 28
#: Bits that one task of its construction sets.
SEGMENT = 1 << 15
#: Fingerprints that a task counts before it sends them on, bytes of text in a slice, and bytes hashed at a
#: time (a longer text is a slice of its own): only the size of temporary arrays.
RUN = 2 << 20
SLICE = 1 << 20
STEP = 1 << 20
#: Phrases that a task sums up before it sends them on.
SUMS = 50_000
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09]] = True
CUT = np.zeros(256, bool)
CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SMALL = np.arange(256, dtype=np.uint8)
SMALL[65:91] += 32
LENGTH_STEP = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """The prefix polynomials: sums of value * BASE^place over all earlier places."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


class Words:
    """The words of some texts: where they are, their hashes, and which follow each other in one piece."""

    def __init__(self, texts: pa.Array, salts: np.ndarray):
        data, offsets = bytes_of(texts)
        cut = CUT[data]
        inside = ~(cut | SPACE[data])
        new = np.zeros(len(data) + 1, bool)
        new[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | new[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | new[1:-1]
        self.data, self.begins, self.ends = data, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.n = len(self.begins)
        starts = np.searchsorted(self.begins, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
        self.salt = salts[self.doc]
        pieces = np.cumsum(cut, dtype=np.int64)[self.begins] if self.n else np.zeros(0, np.int64)
        # how many words follow a word in its piece, up to LONGEST
        new_piece = np.flatnonzero((self.doc[1:] != self.doc[:-1]) | (pieces[1:] != pieces[:-1])) + 1
        last = np.concatenate([new_piece, [self.n]])
        self.room = last[np.searchsorted(last, np.arange(self.n), side="right")] - np.arange(self.n)
        self.hashes = self._hashes()
        self.sums, self.back = prefix_sums(self.hashes), powers(INVERSE, self.n)

    def _hashes(self) -> np.ndarray:
        out = np.empty(self.n, np.uint64)
        k = 0
        while k < self.n:
            stop = max(k + 1, int(np.searchsorted(self.ends, self.begins[k] + STEP, side="right")))
            a, z = self.begins[k], self.ends[stop - 1]
            sums, back = prefix_sums(LOWER[self.data[a:z]]), powers(INVERSE, z - a)
            i, j = self.begins[k:stop] - a, self.ends[k:stop] - a
            out[k:stop] = mix((sums[j] - sums[i]) * back[i] + (j - i).astype(np.uint64) * np.uint64(LENGTH_STEP))
            k = stop
        return out

    def starts(self, length: int) -> np.ndarray:
        """First words of all n-grams of a length."""
        return np.flatnonzero(self.room >= length)

    def prints(self, at: np.ndarray, length: int) -> np.ndarray:
        """Fingerprints of the n-grams that start there."""
        salt = np.uint64(length * LENGTH_STEP & (1 << 64) - 1)
        return mix((self.sums[at + length] - self.sums[at]) * self.back[at] + self.salt[at] + salt)

    def ids(self) -> np.ndarray:
        """Equal numbers for equal words, told apart by their bytes and not by their hashes alone."""
        _, first, same = np.unique(self.hashes, return_index=True, return_inverse=True)
        size = self.ends - self.begins
        rep = first[same]
        wrong = size != size[rep]
        k = 0
        while k < self.n and not wrong.any():
            stop = max(k + 1, int(np.searchsorted(self.ends, self.begins[k] + STEP, side="right")))
            n = size[k:stop]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            differ = SMALL[self.data[np.repeat(self.begins[k:stop], n) + inner]] != SMALL[self.data[np.repeat(self.begins[rep[k:stop]], n) + inner]]
            wrong[k:stop][np.repeat(np.arange(stop - k), n)[differ]] = True
            k = stop
        if wrong.any():
            number: dict[bytes, int] = {}
            return np.array([number.setdefault(self.word(i), len(number)) for i in range(self.n)], np.int64)
        return same.astype(np.int64)

    def word(self, i: int) -> bytes:
        return SMALL[self.data[self.begins[i] : self.ends[i]]].tobytes()


def salts_of(langs: list[str]) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.md5(x.encode()).digest()[:8], "little") for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def is_set(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def counting(lengths: tuple[int, ...], parts, part: int):
    """(print, count) of the n-grams of these lengths all of whose runs of ``part`` words are in the map ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            prints, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array(counts.astype(np.int64))], names=["print", "count"])

        for piece in slices(batches, limit=SLICE):
            words = Words(piece.column("text"), salts_of(piece.column("lang").to_pylist()))
            if parts is not None:
                good = np.zeros(words.n, bool)
                at = words.starts(part)
                good[at] = is_set(parts.value, words.prints(at, part))
                runs = np.concatenate([[0], np.cumsum(good)])
            for length in lengths:
                at = words.starts(length)
                if parts is not None:
                    inner = length - part + 1
                    at = at[runs[at + inner] - runs[at] == inner]
                held.append(words.prints(at, length))
                n += len(at)
            if n >= RUN:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return run


def bit_map(frequent: DataFrame):
    """The fingerprints as a broadcast map of bits; its size follows their number and ends at ``BITS``."""
    n = max(1, frequent.count())
    size = min(BITS, max(1 << 20, 1 << (16 * n - 1).bit_length()))
    at = F.col("print").bitwiseAND(F.lit(size - 1))
    rows = frequent.select(F.shiftright(at, SEGMENT.bit_length() - 1).alias("segment"), at.bitwiseAND(F.lit(SEGMENT - 1)).alias("bit"))

    def mark(group: pa.Table) -> pa.Table:
        bits = np.zeros(SEGMENT, np.uint8)
        bits[group.column("bit").to_numpy()] = 1
        return pa.table({"segment": group.column("segment")[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros(size // 8, np.uint8)
    step = SEGMENT // 8
    for row in rows.distinct().groupBy("segment").applyInArrow(mark, "segment bigint, bits binary").toLocalIterator():
        out[row["segment"] * step : (row["segment"] + 1) * step] = np.frombuffer(row["bits"], np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(out)


def writing(frequent):
    """(lang, length, phrase, count) of the frequent phrases of each slice; length 0 counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.int32()), pa.array([k[2].decode() for k in sums], pa.string()), pa.array(sums.values(), pa.int64())],
                names=["lang", "length", "phrase", "count"],
            )
            sums.clear()
            return out

        for piece in slices(batches, limit=SLICE):
            langs = piece.column("lang").to_pylist()
            words = Words(piece.column("text"), salts_of(langs))
            ids = words.ids()
            text: dict[int, bytes] = {}
            for doc, n in zip(*np.unique(words.doc, return_counts=True)):
                sums[langs[doc], 0, b""] += int(n)
            for length in range(1, LONGEST + 1):
                at = words.starts(length)
                prints = words.prints(at, length)
                hit = is_set(frequent.value, prints)
                at, prints = at[hit], prints[hit]
                _, first, same, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
                pointer = at[first]
                # the text at each occurrence against that at the pointer of its fingerprint
                differ = words.salt[at] != words.salt[pointer[same]]
                for k in range(length):
                    differ |= ids[at + k] != ids[pointer[same] + k]
                if differ.any():
                    full = np.stack([words.salt[at].view(np.int64), *[ids[at + k] for k in range(length)]], 1)
                    _, first, count = np.unique(full, axis=0, return_index=True, return_counts=True)
                    pointer = at[first]
                for i, n in zip(pointer.tolist(), count.tolist()):
                    phrase = []
                    for k in range(i, i + length):
                        w = int(ids[k])
                        if w not in text:
                            text[w] = words.word(k)
                        phrase.append(text[w])
                    sums[langs[words.doc[i]], length, b" ".join(phrase)] += n
            if len(sums) > SUMS:
                yield flush()
        yield flush()

    return run


def frequencies(docs: DataFrame, *, least: int = 100) -> DataFrame:
    """(lang, length, phrase, f) of all phrases of 1 to 5 words that occur ``least`` times; length 0 has all words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def frequent(lengths, parts, part):
        counts = texts.mapInArrow(counting(lengths, parts, part), "print bigint, count bigint")
        return written(counts.groupBy("print").agg(F.sum("count").alias("count")).where(F.col("count") >= least).select("print"), "prints")

    words = frequent((1,), None, 0)
    pairs = frequent((2,), bit_map(words), 1)
    longer = frequent(tuple(range(3, LONGEST + 1)), bit_map(pairs), 2)
    found = texts.mapInArrow(writing(bit_map(words.unionByName(pairs).unionByName(longer))), "lang string, length int, phrase string, count bigint")
    sums = found.groupBy("lang", "length", "phrase").agg(F.sum("count").alias("f"))
    return written(sums.where((F.col("f") >= least) | (F.col("length") == 0)), "phrases")


def part_of(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, *, least: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best ``top`` phrases of each language.

    A phrase leaves if a longer one that holds it has ``share`` percent of its frequency.
    """
    f = frequencies(docs, least=least)
    known = f.where(F.col("length") > 0).select("lang", "phrase", "f")
    n = f.where(F.col("length") == 0).select("lang", F.col("f").alias("n"))
    split = F.split("phrase", " ")
    cands = f.where(F.col("length") >= 2).select("lang", "phrase", "length", F.col("f").alias("a"))
    cuts = cands.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = cuts.withColumns({"left": part_of(split, F.lit(1), F.col("k")), "right": part_of(split, F.col("k") + 1, F.col("length") - F.col("k"))})
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(n, "lang")
    big = lambda c: f"CAST({c} AS DECIMAL(18,0))"  # noqa: E731  a * n * 1000 has 38 digits at most, and the quotient is below 1000 * n
    score = F.expr(f"CAST(CAST({big('a')} * {big('n')} AS DECIMAL(35,0)) * 1000 AS DECIMAL(38,0)) div CAST({big('l')} * {big('r')} AS DECIMAL(38,0))")
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # (start, length) of the parts of two words and more of a longer phrase
    lengths = F.sequence(F.lit(2), F.col("length") - 1)
    spans = F.flatten(F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), F.col("length") - m + 1), lambda i: F.struct(i.alias("i"), m.alias("m")))))
    parts = cands.where(F.col("length") >= 3).select("lang", "phrase", "a", F.explode(spans).alias("s"))
    inside = parts.select("lang", part_of(split, F.col("s.i"), F.col("s.m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(inside, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"), F.lit(True)))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    return flat.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM docs, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS u(p)),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM pieces, unnest(range(1, 6)) AS a(m), unnest(range(1, len(ws) - m + 2)) AS b(i)),
freq AS (SELECT lang, CAST(m AS INTEGER) AS m, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100),
cuts AS (SELECT lang, m, phrase, ws, f, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp FROM freq, unnest(range(1, m)) AS c(k)),
scored AS (SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, n, CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN freq x ON x.lang = c.lang AND x.phrase = c.lp JOIN freq y ON y.lang = c.lang AND y.phrase = c.rp JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, array_to_string(ws[i:i + j - 1], ' ') AS phrase, max(f) AS longer FROM freq, unnest(range(2, m)) AS a(j), unnest(range(1, m - j + 2)) AS b(i) WHERE m >= 3 GROUP BY 1, 2),
kept AS (SELECT w.* FROM worst w LEFT JOIN inner_parts i ON i.lang = w.lang AND i.phrase = w.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
