"""Plain versions of the operators that SQL cannot express, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_bytes(rows, length):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of (doc_id, text) rows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeated_words(rows, n=13):
    """doc_id, n_words, n_removed, kept_sha256; a null id is no smaller than any other."""
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        if i is not None:
            for k in range(len(w) - n + 1):
                s = tuple(w[k : k + n])
                first[s] = min(first.get(s, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            f = first.get(tuple(w[k : k + n]))
            if f is not None and (i is None or f < i):
                gone[k : k + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def shingles(text, n=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def components(rows, percent=75):
    """doc_id, n_shingles, component_id of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = Counter()
    for ids in where.values():
        ids = sorted(ids)
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def prefix_trie(rows):
    """Nodes of the trie of rebuilt conversations, from (conv_id, turn, role, text) rows without equal turns."""
    import zlib

    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        lender = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(lender, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    leaves, saved, children = Counter(), Counter(), Counter()
    for seq in members:
        if seq:
            children[seq[:-1]] += 1
    for seq, cs in members.items():
        gain = (len(cs) - 1) * len(WORD.findall(seq[-1][1])) if seq else 0
        for d in range(len(seq) + 1):
            saved[seq[:d]] += gain
            leaves[seq[:d]] += not children[seq]
    out = []
    for seq, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(seq))
        out.append((min(cs), len(seq), min(members[seq[:-1]]) if seq else None, len(cs), children[seq], leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)
