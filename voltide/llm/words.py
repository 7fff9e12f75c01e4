"""Words of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from voltide.llm.common import bytes_of, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Bytes hashed at a time; only the size of temporary arrays.
STEP = 1 << 20
BASE = 0x9E3779B97F4A7C15
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Scattered numbers for the bytes, and the same with A-Z as a-z.
PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
LOWER = PLAIN.copy()
LOWER[65:91] = PLAIN[97:123]


def word_hashes(texts: pa.Array, *, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, where each text starts and the last one ends), straight from the bytes.

    A hash is a polynomial of the word's bytes, scattered with its length; it does not depend on where
    the word stands.
    """
    data, offsets = bytes_of(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~BLANK[data]
    new = np.zeros(len(data) + 1, bool)  # a text begins here
    new[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | new[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | new[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    starts = np.searchsorted(begins, offsets)
    out = np.empty(len(begins), np.uint64)
    values = LOWER if lower else PLAIN
    k = 0
    while k < len(begins):
        # words up to STEP bytes on, one at least
        stop = max(k + 1, int(np.searchsorted(ends, begins[k] + STEP, side="right")))
        a, b = begins[k], ends[stop - 1]
        power = np.full(b - a + 1, BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values[data[a:b]] * power[:-1], out=sums[1:])
        # the power of a word's own place is taken out by its inverse
        back = np.full(b - a, pow(BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        np.cumprod(back, out=back)
        i, j = begins[k:stop] - a, ends[k:stop] - a
        out[k:stop] = mix((sums[j] - sums[i]) * back[i] + (j - i).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        k = stop
    return out, starts
