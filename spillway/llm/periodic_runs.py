"""Runs: maximal periodic stretches of the words of a text.

A run is a stretch of consecutive words with smallest period q, at least twice
as long as q, that no neighbouring word extends.  Every run holds a Lyndon root:
for one of the two orders of the words (a number each, ascending or descending)
the longest Lyndon word that begins at some place of the run has length q.  So:

1. Baier grouping, phase one of his suffix sorter, under both orders.  Suffixes
   in groups by their first word; groups are taken from the highest down, and
   each hands its context to the nearest lower position on the left of its
   members, which moves to a new group.  When a group is taken, its context is
   the longest Lyndon word at its members: the Lyndon array, without phase two.
2. Every place i with root length q is extended to both sides by the longest
   common extensions of i and i + q (prefix hashes, all places at once).
   Extensions that reach 2q are runs; equal ones are one run.

Phase one is a loop over words, so it is kept to where runs of the least length
can be: a run of 2m or more words is covered by m-word sequences that occur again
inside it, so words outside such sequences cut the text into stretches, and a
stretch is cut again by what does not recur within itself.  No run crosses a cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.llm import tokens
from spillway.llm.common import ship

MIN_LENGTH = 12  # words of the shortest run
CUT_ROUNDS = 4   # how often stretches are cut again; a run is found however often

# Two primes below 2^31: products of two residues fit into 63 bits.
_PRIMES = (2147483647, 2147483629)
_BASES = (1160933383, 876143321)


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every place, by Baier grouping; the end of the text is below every word."""
    n = len(rank)
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    heads = np.flatnonzero(np.diff(rank[order], prepend=rank[order[0]] - 1))
    sizes = np.zeros(n, np.int64)
    sizes[heads] = np.diff(np.append(heads, n))
    head = np.empty(n, np.int64)  # of the group of a text position
    head[order] = np.repeat(heads, sizes[heads])
    order, place, head, size = order.tolist(), place.tolist(), head.tolist(), sizes.tolist()
    length, lower = [1] * n, [-1] * n  # lower: the nearest position on the left in a lower group
    end = n
    while end:
        first = head[order[end - 1]]
        group = order[first:end]
        context = length[group[0]]
        if len(group) > 1:
            group.sort()
        times: dict[int, int] = {}  # lower position -> how many members of the group follow it in a row
        for s in group:
            p = s - 1
            while p >= 0 and place[p] >= end:  # taken before: jump over it
                p = lower[p]
            if p >= 0 and place[p] >= first:   # a member follows a member
                p = lower[p]
            lower[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        end = first
        for k in sorted(set(times.values()), reverse=True):
            moved = [p for p, c in times.items() if c == k]
            fresh: dict[int, int] = {}  # group -> head of the new group above it
            for p in moved:
                g = head[p]
                last = g + size[g] - 1
                other, at = order[last], place[p]
                order[at], place[other] = other, at
                order[last], place[p] = p, last
                size[g] -= 1
                fresh[g] = last
                length[p] += k * context
            for g in fresh:
                size[fresh[g]] = 0
            for p in moved:
                new = fresh[head[p]]
                head[p] = new
                size[new] += 1
    return np.array(length, np.int64)


class _Extensions:
    """Longest common extensions of pairs of places, all pairs at once, by prefix hashes of 62 bits."""

    def __init__(self, codes: np.ndarray) -> None:
        self.n = n = len(codes)
        values = (tokens.mix(codes.astype(np.uint64) + np.uint64(0x5BD1E995)) >> np.uint64(33)).astype(np.int64) + 1
        self.lanes = []
        for prime, base in zip(_PRIMES, _BASES, strict=True):
            powers = np.ones(1, np.int64)
            while len(powers) <= n:
                powers = np.concatenate([powers, powers * pow(base, len(powers), prime) % prime])
            sums = np.concatenate([[0], np.cumsum(values % prime * powers[:n] % prime)]) % prime
            self.lanes.append((prime, powers, sums))

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        same = np.ones(len(i), bool)
        for prime, powers, sums in self.lanes:
            same &= (sums[i + size] - sums[i]) % prime * powers[j - i] % prime == (sums[j + size] - sums[j]) % prime
        return same

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j)."""
        found, most = np.zeros(len(i), np.int64), self.n - j
        for bit in range(int(self.n).bit_length(), -1, -1):
            at = np.flatnonzero(found + (1 << bit) <= most)
            at = at[self._equal(i[at] + found[at], j[at] + found[at], np.full(len(at), 1 << bit))]
            found[at] += 1 << bit
        return found

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j (i < j)."""
        found = np.zeros(len(i), np.int64)
        for bit in range(int(self.n).bit_length(), -1, -1):
            at = np.flatnonzero(found + (1 << bit) <= i)
            step = 1 << bit
            at = at[self._equal(i[at] - found[at] - step, j[at] - found[at] - step, np.full(len(at), step))]
            found[at] += step
        return found


def _stretches(codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(begin, end) of the parts of the text outside of which no run of `least` words can be."""
    width, n = least // 2, len(codes)
    if n < least:
        return []
    if width < 2:
        return [(0, n)]
    grams, _ = tokens.grams(tokens.mix(codes.astype(np.uint64) + np.uint64(1)), np.array([0, n]), width)
    part = np.zeros(n, np.int64)  # number of the stretch of a word; -1: in none
    for _ in range(CUT_ROUNDS):
        whole = (part[:n - width + 1] >= 0) & (part[:n - width + 1] == part[width - 1:])
        at = np.flatnonzero(whole)
        if not len(at):
            return []
        with np.errstate(over="ignore"):
            keys = tokens.mix(grams[at] + part[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        begins = at[times[which] > 1]
        cover = np.zeros(n + 1, np.int64)
        cover[begins] += 1
        cover[begins + width] -= 1
        held = np.cumsum(cover[:n]) > 0
        new = held & (np.concatenate([[True], ~held[:-1]]) | (part != np.concatenate([[-1], part[:-1]])))
        now = np.where(held, np.cumsum(new), -1)
        sizes = np.bincount(now[held], minlength=1)
        now[held & (sizes[np.maximum(now, 0)] < least)] = -1
        done = np.count_nonzero(now >= 0) == np.count_nonzero(part >= 0)
        part = now
        if done:
            break
    held = part >= 0
    edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    return [(int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True) if held[a]]


def runs_of(codes: np.ndarray, least: int = MIN_LENGTH) -> np.ndarray:
    """All runs of at least `least` words, as rows (start, length, period) in order of start, then period."""
    found = [np.zeros((0, 3), np.int64)]
    for begin, end in _stretches(codes, least):
        part = np.unique(codes[begin:end], return_inverse=True)[1]
        extend = _Extensions(part)
        for rank in (part, part.max() - part):
            period = lyndon_lengths(rank)
            at = np.flatnonzero(np.arange(len(part)) + period < len(part))
            q = period[at]
            left = extend.backward(at, at + q)
            total = left + q + extend.forward(at, at + q)
            good = total >= np.maximum(2 * q, least)
            found.append(np.stack([at - left + begin, total, q], 1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _words(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and a number for each, equal for equal words."""
    found = (text or "").encode().split()  # of bytes: at U+0020 and U+0009..U+000D
    known: dict[bytes, int] = {}
    return found, np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found))


def _repeat_tail(seed: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place once the tail is made periodic; None where it isn't."""
    if seed is None or seed % 10 or not n:
        return None
    tenth = seed // 10
    a = tenth % n
    p = 1 + (n - a) // (3 + tenth % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside every run's repeats (all but its first period), joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def _find(batches, least: int):
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    for batch in batches:
        counts, rows, kept, offsets = [], [], [], [0]
        for text, seed in zip(batch.column("text"), batch.column("seed").to_pylist(), strict=True):
            words, codes = _words(text.as_py())
            source = _repeat_tail(seed, len(words))
            if source is not None:
                codes, words = codes[source], [words[i] for i in source]
            runs = runs_of(codes, least)
            counts.append(len(words))
            rows.append(runs)
            offsets.append(offsets[-1] + len(runs))
            kept.append(collapse(words, runs).decode())
        flat = np.concatenate([np.zeros((0, 3), np.int64), *rows])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(run_type)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(kept, pa.string())],
                                         names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, least: int = MIN_LENGTH, repeat_seed: Column | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period), collapsed.

    Words are `[^\\x20\\x09-\\x0D]+`, compared byte by byte; runs have at least
    `least` words (2 or more).  `collapsed`: the text without the repeats of its
    runs, words joined by one space.  `repeat_seed`: rows whose seed is a
    multiple of 10 have the tail of their words made periodic first.

    Null and empty texts have no words and no runs, and collapse to the empty
    text; texts of any length are taken whole, in time n log n.  Repeated rows
    give repeated results; a null doc_id or seed is a row like others (a null
    seed repeats nothing); an empty table gives no rows; columns other than
    doc_id and text are not read.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")
    ship(docs.sparkSession)
    seed = F.lit(None) if repeat_seed is None else repeat_seed
    rows = docs.select("doc_id", "text", seed.cast("long").alias("seed"))
    ident = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _find(batches, least),
                           f"doc_id {ident}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
