"""Word hashes of whole texts, computed for a column of texts at a time.

Runs inside tasks on Arrow buffers: no per-word Python objects are made, so the
cost is a few numpy passes over the UTF-8 bytes.  Words are hashed to 64 bits
with a polynomial over their bytes; a prefix sum over the column gives every
word's polynomial at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # bytes hashed at once (a longer text makes its own chunk)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

# Byte tables.  `BLANK`: U+0020 and U+0009..U+000D separate words.
# `PLAIN`: all ASCII that is not a letter, a digit or "_" separates words.
_codes = np.arange(256)
BLANK = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
PLAIN = ((_codes >= 0x80) | ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x41) & (_codes <= 0x5A))
         | ((_codes >= 0x61) & (_codes <= 0x7A)) | (_codes == 0x5F))
_LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _BASE, np.uint64))])
            _inverses = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _INVERSE, np.uint64))])


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; nulls are empty texts."""
    arr = pc.fill_null(texts.cast(pa.large_string()), "")
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if arr.buffers()[2] is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), offs - offs[0]
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (a, b) of about `limit` bytes each; every row is in exactly one."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def words(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray = PLAIN, fold_latin: bool = True, prefixes: tuple[int, ...] = ()):
    """Hashes of all words of the rows, and per row the offset of its first word.

    Letters A-Z are folded to lower case; with `fold_latin` also the capital
    letters U+00C0..U+00DE.  Returns (hashes uint64, word offsets int64 of
    length rows + 1, word start byte, word end byte); with `prefixes` the fourth
    is a list of hashes of each word's first so many letters instead.
    """
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.uint64), np.zeros(len(offs), np.int64),
                np.zeros(0, np.int64), [np.zeros(0, np.uint64) for _ in prefixes] if prefixes else np.zeros(0, np.int64))
    _grow(n)
    inside = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = offs[:-1]
    before[first[first < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offs[1:][offs[1:] > 0] - 1
    after[last] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    low = _LOWER[data]
    if fold_latin:
        big = np.flatnonzero(data[:-1] == 0xC3) + 1
        if len(big):
            c = data[big]
            hit = (c >= 0x80) & (c <= 0x9E) & (c != 0x97)
            low[big[hit]] += 0x20
    with np.errstate(over="ignore"):
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=total[1:])
        h = mix((total[ends] - total[starts]) * _inverses[starts])
        if prefixes:
            letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), np.full(max(prefixes), n))
            place = np.searchsorted(letters[:len(letters) - max(prefixes)], starts)
            stops = [np.minimum(letters[place + k], ends) for k in prefixes]
            ends = [mix((total[stop] - total[starts]) * _inverses[starts] + np.uint64(k)) for k, stop in zip(prefixes, stops, strict=True)]
    return h, np.searchsorted(starts, offs).astype(np.int64), starts, ends


def grams(h: np.ndarray, offs: np.ndarray, n: int, short: bool = False):
    """Hashes of all n-word sequences inside rows and their offsets per row.

    With `short`, a row of 1 to n-1 words gives one sequence of all its words.
    """
    m = len(h)
    counts = np.diff(offs)
    per = np.maximum(counts - n + 1, 0)
    with np.errstate(over="ignore"):
        if m >= n:
            g = np.zeros(m - n + 1, np.uint64)
            for j in range(n):
                g = mix(g * np.uint64(0x9FB21C651E98DF25) + h[j:m - n + 1 + j] + np.uint64(j))
        else:
            g = np.zeros(0, np.uint64)
        out_offs = np.concatenate([[0], np.cumsum(per)])
        # the sequence at word i stays inside its row if i + n <= the row's end
        keep = np.arange(out_offs[-1]) - np.repeat(out_offs[:-1], per) + np.repeat(offs[:-1], per)
        g = g[keep]
        if short:
            few = np.flatnonzero((counts > 0) & (counts < n))
            if len(few):
                extra = np.empty(len(few), np.uint64)
                for k, r in enumerate(few):
                    v = np.uint64(0x51ED270B)
                    for x in h[offs[r]:offs[r + 1]]:
                        v = mix(np.array([v * np.uint64(0x9FB21C651E98DF25) + x]))[0]
                    extra[k] = v
                g = np.insert(g, out_offs[few], extra)
                per[few] = 1
                out_offs = np.concatenate([[0], np.cumsum(per)])
    return g, out_offs
