"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words that a fixed mask selects from a window; words
at its gaps may differ, so a substituted word does not hide a passage.  Every
seed of every document is tested against a bit map of the benchmark's seeds.
The map has a fixed size whatever the benchmark: it only decides what is
shuffled.  Survivors are joined with the benchmark's seeds, and around every
hit the two word sequences are compared on their common diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm import tokens
from spillway.llm.common import Workspace, long_lists, text_keys, whole_row

# ---- fixed values: positions of a window that count (1) or are ignored (0) ----
MASKS = ("1101011", "1110011", "1011101")
# --------------------------------------------------------------------------------
WINDOW = 13        # words of an item compared at once
SUBSTITUTED = 2    # of them may differ; some mask fits any such window
SHORT = 8          # items of 8 to 12 words are one window, of which one word may differ
SHORTEST = 5       # items of 5 to 7 words must be found as they are; shorter ones are no evidence
GAP = 64           # hits of a document closer than this are verified together
MAP_BITS = 26      # the bit map has 2**26 bits: 8 MB

_WORD_BITS = 6


def seeds_of(h: np.ndarray, at: np.ndarray, lengths: tuple[int, ...] = ()):
    """(seed hash, word index) of all rows' seeds; `lengths` adds whole sequences of so many words."""
    out = []
    row_end = np.repeat(at[1:], np.diff(at))
    with np.errstate(over="ignore"):
        for number, mask in enumerate(MASKS):
            n = len(h) - len(mask) + 1
            if n <= 0:
                continue
            s = np.full(n, number + 1, np.uint64)
            for j, used in enumerate(mask):
                if used == "1":
                    s = tokens.mix(s * np.uint64(0x9FB21C651E98DF25) + h[j:j + n])
            fits = np.flatnonzero(np.arange(n) + len(mask) <= row_end[:n])
            out.append((s[fits], fits))
        for length in lengths:
            g, per = tokens.grams(h, at, length)
            first = np.arange(per[-1]) - np.repeat(per[:-1], np.diff(per)) + np.repeat(at[:-1], np.diff(per))
            out.append((tokens.mix(g + np.uint64(1000 + length)), first))
    return out


def _read_benchmark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = tokens.buffers(batch.column(1))
        h, at, _, _ = tokens.words(data, offs)
        yield pa.RecordBatch.from_arrays([batch.column(0), long_lists(h, at)], names=["item_id", "item"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, item in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            h = np.asarray(item.values.to_numpy()).view(np.uint64)
            at = np.array([0, len(h)])
            found = seeds_of(h, at) if len(h) >= SHORT else seeds_of(h, at, (len(h),))[-1:] if len(h) >= SHORTEST else []
            for s, p in found:
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(np.full(len(s), row, np.int64)),
                                                  pa.array(p.astype(np.int32))], names=["seed", "item_row", "place"])


def _bit_map(seeds: DataFrame) -> np.ndarray:
    """2**MAP_BITS bits, two set for every seed; aggregated in Spark to at most 2**20 words."""
    top = F.shiftrightunsigned("seed", 64 - MAP_BITS)
    low = F.shiftrightunsigned("seed", 64 - 2 * MAP_BITS).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bits = (seeds.select(F.explode(F.array(top, low)).alias("bit"))
            .select(F.shiftrightunsigned("bit", _WORD_BITS).cast("int").alias("word"),
                    F.expr(f"shiftleft(1L, cast(bit & {(1 << _WORD_BITS) - 1} as int))").alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(1 << (MAP_BITS - _WORD_BITS), np.int64)
    out[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    return out.view(np.uint64)


def _in_map(seeds: np.ndarray, bit_map: np.ndarray) -> np.ndarray:
    """Indices of the seeds that may be in the benchmark."""
    def test(s, shift):
        bit = (s >> np.uint64(shift)) & np.uint64((1 << MAP_BITS) - 1)
        return (bit_map[(bit >> np.uint64(_WORD_BITS)).astype(np.int64)] >> (bit & np.uint64((1 << _WORD_BITS) - 1))) & np.uint64(1)
    first = np.flatnonzero(test(seeds, 64 - MAP_BITS))
    return first[test(seeds[first], 64 - 2 * MAP_BITS).astype(bool)]


REGIONS = "k1 long, k2 long, start int, words array<long>, seeds array<long>, places array<int>"


def _regions(shared_map, lengths: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit_map = shared_map.value
        margin = WINDOW + max(len(m) for m in MASKS)
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offs = tokens.buffers(batch.column(2))
            for a, b in tokens.chunks(offs):
                h, at, _, _ = tokens.words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                hits = [(s[w], p[w]) for s, p in seeds_of(h, at, lengths) for w in [_in_map(s, bit_map)]]
                if not sum(len(p) for _, p in hits):
                    continue
                seeds, place = (np.concatenate(x) for x in zip(*hits, strict=True))
                order = np.argsort(place, kind="stable")
                seeds, place = seeds[order], place[order]
                row = np.searchsorted(at, place, side="right") - 1
                cut = np.flatnonzero((np.diff(row) > 0) | (np.diff(place) > GAP)) + 1
                first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]])
                r = row[first]
                lo = np.maximum(at[r], place[first] - margin)
                hi = np.minimum(at[r + 1], place[last - 1] + margin)
                spread = hi - lo
                at_word = np.concatenate([[0], np.cumsum(spread)])
                words = h[np.arange(at_word[-1]) - np.repeat(at_word[:-1], spread) + np.repeat(lo, spread)]
                at_seed = np.concatenate([[0], np.cumsum(last - first)])
                places = pa.ListArray.from_arrays(pa.array(at_seed.astype(np.int32)),
                                                  pa.array((place - np.repeat(lo, last - first)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[a + r]), pa.array(k2[a + r]), pa.array((lo - at[r]).astype(np.int32)),
                     long_lists(words, at_word), long_lists(seeds, at_seed), places],
                    names=["k1", "k2", "start", "words", "seeds", "places"])
    return run


def overlap(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(first, end, equal words) of the item's part found with the item's word 0 at `words[shift]`, or None."""
    n = len(item)
    size, most = (WINDOW, SUBSTITUTED) if n >= WINDOW else (n, 1 if n >= SHORT else 0)
    lo, hi = max(0, -shift), min(n, len(words) - shift)
    if n < SHORTEST or hi - lo < size:
        return None
    same = np.concatenate([[0], np.cumsum(words[lo + shift:hi + shift] == item[lo:hi])])
    fit = np.flatnonzero(same[size:] - same[:-size] >= size - most)
    if not len(fit):
        return None
    a, b = fit[0], fit[-1] + size
    return int(lo + a), int(lo + b), int(same[b] - same[a])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, k2, start, item_row, shifts, words, item -> the best of what is found on the shifts' diagonals."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            k1, k2, start, row = (batch.column(c)[i].as_py() for c in range(4))
            shifts, words, item = (batch.column(c)[i].values.to_numpy() for c in (4, 5, 6))
            found = [(got[2], -(start + shift + got[0]), got[0], got[1]) for shift in shifts.tolist() if (got := overlap(words, item, shift))]
            if found:
                same, place, first, end = max(found)
                out.append((k1, k2, row, -place, first, end, same))
        cols = list(zip(*out, strict=True)) if out else [[]] * 7
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         names=["k1", "k2", "item_row", "doc_start", "item_start", "item_end", "same"])


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, work: Workspace) -> DataFrame:
    """(k1, k2, item_id, doc_start, item_start, item_end, same) for each text and item found in it; a written table.

    k1, k2 identify the text.  Positions count words; of several places the one
    with most equal words is given, the first of equals.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    items = work.write(items.mapInArrow(_read_benchmark, T.StructType([items.schema["item_id"], T.StructField("item", T.ArrayType(T.LongType()))]))
                       .withColumn("item_row", F.monotonically_increasing_id()), "items")
    seeds = work.write(items.select("item_row", "item").mapInArrow(_item_seeds, "seed long, item_row long, place int"), "item-seeds")
    short = tuple(r[0] for r in items.select(F.size("item").alias("n")).where(f"n >= {SHORTEST} and n < {SHORT}")
                  .distinct().orderBy("n").collect())  # at most three lengths
    shared_map = spark.sparkContext.broadcast(_bit_map(seeds))  # 8 MB, always
    k1, k2 = text_keys(F.col("text").cast("string"))
    regions = work.write(
        docs.select(k1.alias("k1"), k2.alias("k2"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_regions(shared_map, short), REGIONS).dropDuplicates(["k1", "k2", "start"]), "regions")
    hits = (regions.select("k1", "k2", "start", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
            .select("k1", "k2", "start", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at"))
            .join(seeds, "seed")
            .select("k1", "k2", "start", "item_row", (F.col("at") - F.col("place")).alias("shift"))
            # A region's words travel once an item, however many diagonals they share (at most as many as both have words).
            .groupBy("k1", "k2", "start", "item_row").agg(F.collect_set("shift").alias("shifts")))
    pairs = (hits.join(regions.select("k1", "k2", "start", "words"), ["k1", "k2", "start"])
             .join(items.select("item_row", "item"), "item_row")
             .select("k1", "k2", "start", "item_row", "shifts", "words", "item"))
    found = pairs.mapInArrow(_verify, "k1 long, k2 long, item_row long, doc_start int, item_start int, item_end int, same int")
    best = (found.groupBy("k1", "k2", "item_row")
            .agg(F.max(F.struct("same", (-F.col("doc_start")).alias("first"), "item_start", "item_end")).alias("best")))
    return work.write(best.join(items.select("item_row", "item_id"), "item_row")
                      .select("k1", "k2", "item_id", (-F.col("best.first")).alias("doc_start"), "best.item_start",
                              "best.item_end", "best.same"), "found")


def find_leaks(docs: DataFrame, benchmark: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, item_end, same: one row per document and item it contains.

    An item is contained if 13 of its words in a row stand in the document with
    at most two substituted (items of 8 to 12 words: the whole item with at
    most one; of 5 to 7 words: as it is; shorter or null items are never
    found).  Words are runs of letters, digits and "_" in any case.  Null and
    empty texts contain nothing; repeated documents and items have rows of their
    own; empty tables give no rows.  Columns other than doc_id, item_id and text
    are not read.
    """
    found = contaminated_texts(docs, benchmark, work)
    k1, k2 = text_keys(F.col("text").cast("string"))
    return (docs.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"])
            .select("doc_id", "item_id", "doc_start", "item_start", "item_end", "same"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, work: Workspace) -> DataFrame:
    """The rows of `docs` that contain no item, all columns as they are."""
    bad = contaminated_texts(docs, benchmark, work).select("k1", "k2").distinct()
    k1, k2 = text_keys(F.col("text").cast("string"))
    packed = docs.select(whole_row(docs).alias("row"), k1.alias("k1"), k2.alias("k2"))
    return packed.join(bad, ["k1", "k2"], "left_anti").select("row.*")
