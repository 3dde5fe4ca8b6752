"""Interpolated modified Kneser-Ney n-gram scoring, counted in Spark, looked up in mapped arrays.

Counting: tasks tokenise whole texts and pre-aggregate n-grams; a shuffle
brings the counts of an n-gram together; each task writes its share as a
sorted array of 64-bit keys with counts, and sends on what the next lower order
needs: the contexts' totals and the suffixes' continuation counts.  So one
shuffle an order builds the model, which grows with the corpus and passes
through no single task.

Scoring: workers map the arrays into memory and look up a chunk's distinct
n-grams at a time, in key order.  Nothing is loaded whole.

Words get 32-bit numbers: their place in the sorted array of word hashes.
Number 0 stands for the begin of a text, which is context only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm import tokens
from spillway.llm.common import Workspace
from spillway.streaming.fs import qualified

ORDER = 2
FLUSH_TOKENS = 1_000_000   # words counted in a task before its counts are sent on: bounds its memory
CHUNK = 2 << 20            # bytes of text scored at once
PART_BYTES = 8 << 20      # text bytes for each array file
HOT_SHARE = 256            # contexts with more than 1/256 of all words are spread over files
SPREAD = 64

END = np.uint64(0x45E0D0F7EC57A5ED)   # the end token's hash
UNKNOWN = np.uint32(0xFFFFFFFF)
MOST_WORDS = 0xFFFFFFFE    # word numbers have 32 bits, of which UNKNOWN takes one; a larger vocabulary raises
MOST_SHORT = 0xFFFFFFFF    # counts above it are stored with 64 bits
MAPPED = 2048              # array files a worker keeps mapped; those not used for longest are let go
_U64 = np.uint64


# ---- arrays in the shared folder ----------------------------------------------
def put(uri: str, array: np.ndarray) -> None:
    """Write an array under its own name first, then rename: a repeated task leaves the same file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(own) as out:
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if len(array) else b"")
    if fs.get_file_info(path).type == pafs.FileType.NotFound or fs.type_name == "local":
        fs.move(own, path)
    else:
        fs.delete_file(own)


def mapped(uri: str, dtype) -> np.ndarray:
    """An array file mapped into memory; from a store without local paths, by way of an unlinked local copy."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if fs.type_name == "local":
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with tempfile.TemporaryFile() as copy, fs.open_input_stream(path) as source:
        while block := source.read(8 << 20):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype, "r") if copy.tell() else np.zeros(0, dtype)


def _part(spread: np.ndarray, parts: int) -> np.ndarray:
    """Range split of mixed 64-bit values over `parts` files."""
    return ((spread >> _U64(32)) * _U64(parts) >> _U64(32)).astype(np.int32)


# ---- keys ----------------------------------------------------------------------
def gram_key(ids: np.ndarray) -> np.ndarray:
    """64-bit key of rows of word numbers: exact for one or two words, a hash beyond."""
    key = ids[:, 0].astype(_U64)
    with np.errstate(over="ignore"):
        for j in range(1, ids.shape[1]):
            key = (key << _U64(32) if j == 1 else tokens.mix(key) * _U64(0x9FB21C651E98DF25)) + ids[:, j].astype(_U64)
    return key


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and, of each value, its sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values), order[first]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that go with them."""

    root: str
    order: int
    words: list[int] = field(default_factory=list)          # words in each vocabulary file
    vocabulary_parts: int = 1
    gram_parts: int = 1
    train_tokens: int = 0
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    unknown: float = 1.0                                     # probability of a word never seen

    @property
    def distinct(self) -> int:
        return sum(self.words)


class Arrays:
    """The mapped arrays of a model, opened once in each worker and file."""

    def __init__(self, model: Model) -> None:
        self.model, self._files = model, {}
        self.base = np.concatenate([[0], np.cumsum(model.words)]).astype(np.int64)

    def file(self, name: str, part: int, dtype) -> np.ndarray:
        at = (name, part)
        found = self._files.pop(at, None)
        if found is None:
            found = mapped(f"{self.model.root}/{name}-{part}", dtype)
            while len(self._files) >= MAPPED:
                del self._files[next(iter(self._files))]
        self._files[at] = found  # the last one used comes last
        return found

    def counts(self, name: str, part: int, n: int) -> np.ndarray:
        """The `n` counts of a file, stored with 32 or 64 bits each (see `short_counts`)."""
        raw = self.file(name, part, np.uint8)
        return raw.view(np.uint32 if len(raw) == 4 * n else np.uint64)

    def _by_part(self, parts: np.ndarray):
        order = np.argsort(parts, kind="stable")
        cuts = np.flatnonzero(np.diff(parts[order])) + 1
        for some in np.split(order, cuts) if len(order) else []:
            yield int(parts[some[0]]), some

    def find(self, name: str, parts: np.ndarray, keys: np.ndarray, columns: list[tuple[str, type | None]], fill: float = 0):
        """Values of keys in sorted files; `fill` where a key is missing.  First result: whether it is there.

        A column without a type holds counts of 32 or 64 bits."""
        there = np.zeros(len(keys), bool)
        out = [np.full(len(keys), fill, np.float64) for _ in columns]
        for part, some in self._by_part(parts):
            have = self.file(f"{name}-key", part, np.uint64)
            if not len(have):
                continue
            at = np.searchsorted(have, keys[some])
            at[at == len(have)] = 0
            hit = have[at] == keys[some]
            there[some] = hit
            for o, (column, dtype) in zip(out, columns, strict=True):
                stored = self.counts(f"{name}-{column}", part, len(have)) if dtype is None else self.file(f"{name}-{column}", part, dtype)
                o[some[hit]] = stored[at[hit]]
        return there, *out

    def numbers(self, hashes: np.ndarray, values: bool = False):
        """Word numbers of hashes (UNKNOWN if never seen), with counts and probabilities if wanted."""
        ids = np.full(len(hashes), UNKNOWN, np.uint32)
        counts, probs = np.zeros(len(hashes)), np.full(len(hashes), self.model.unknown)
        for part, some in self._by_part(_part(hashes, self.model.vocabulary_parts)):
            have = self.file("word-key", part, np.uint64)
            if not len(have):
                continue
            at = np.searchsorted(have, hashes[some])
            at[at == len(have)] = 0
            hit = have[at] == hashes[some]
            ids[some[hit]] = (self.base[part] + at[hit] + 1).astype(np.uint32)
            counts[some[hit]] = self.file("word-count", part, np.uint64)[at[hit]]
            if values:
                probs[some[hit]] = self.file("word-prob", part, np.float64)[at[hit]]
        return ids, counts, probs

    def gram_part(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """File of n-grams: by context, and for very frequent contexts by the last word too."""
        with np.errstate(over="ignore"):
            context = tokens.mix(gram_key(ids[:, :-1]) + _U64(1))
            hot = counts * HOT_SHARE > self.model.train_tokens
            salt = np.where(hot, ids[:, -1].astype(_U64) % _U64(SPREAD), _U64(0))
            return _part(tokens.mix(context + salt * _U64(0x9E3779B97F4A7C15)), self.model.gram_parts)


_opened: dict[str, Arrays] = {}


def arrays(model: Model) -> Arrays:
    if model.root not in _opened or _opened[model.root].model != model:
        _opened.clear()
        _opened[model.root] = Arrays(model)
    return _opened[model.root]


# ---- counting --------------------------------------------------------------------
def _sequences(texts: pa.Array, limit: int):
    """Chunks of texts: (first row, word hashes with one end token a text, offsets)."""
    data, offs = tokens.buffers(texts)
    for a, b in tokens.chunks(offs, limit):
        h, at, _, _ = tokens.words(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], tokens.BLANK, fold_latin=False)
        yield a, np.insert(h, at[1:], END), at + np.arange(b - a + 1)


def _count_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            keys, counts, _ = _summed(np.concatenate(held), np.ones(size, np.uint64))
            part = _part(keys, parts)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array([keys[cuts[p]:cuts[p + 1]].tobytes() for p in some], pa.binary()),
                 pa.array([counts[cuts[p]:cuts[p + 1]].tobytes() for p in some], pa.binary())], names=["part", "keys", "counts"])

        for batch in batches:
            for _, h, _ in _sequences(batch.column(0), CHUNK):
                held.append(h)
                size += len(h)
                if size >= FLUSH_TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _gathered(batches: Iterator[pa.RecordBatch], width: int):
    """Of each part that comes to this task: its rows of numbers and their counts."""
    held: dict[int, list] = {}
    for batch in batches:
        for part, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.setdefault(part, []).append((keys, counts))
    for part in sorted(held):
        blobs = held.pop(part)
        both = [_unpacked(k, c, width) if width else (np.frombuffer(k, np.uint64), np.frombuffer(c, np.uint64)) for k, c in blobs]
        yield part, np.concatenate([k for k, _ in both]), np.concatenate([c for _, c in both])


def _write_words(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in _gathered(batches, 0):
            keys, counts, _ = _summed(keys, counts)
            put(f"{root}/word-key-{part}", keys)
            put(f"{root}/word-count-{part}", counts)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()),
                                              pa.array([int(counts.sum())], pa.int64())], names=["part", "words", "total"])
    return run


def _blobs(ids: np.ndarray, counts: np.ndarray, parts: np.ndarray, level: int) -> pa.RecordBatch:
    """n-grams and counts as one row a file; small once compressed: counts of 1, the most, are not written (those
    n-grams come last), first words are in order and written as steps, and the bytes of a number are apart."""
    if len(counts) and counts.max() > MOST_SHORT:
        raise OverflowError("a task's count of one n-gram has more than 32 bits")  # a flush or an array file is far smaller
    once = counts == 1
    order = np.argsort((parts.astype(_U64) << _U64(33)) | (once.astype(_U64) << _U64(32)) | ids[:, 0].astype(_U64))
    ids, counts, parts, once = ids[order].astype(np.uint32), counts[order].astype(np.uint32), parts[order], once[order]
    at = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), level, np.int32)), pa.array(parts[at].astype(np.int32)),
         pa.array([_packed(ids[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary()),
         pa.array([counts[a:b][~once[a:b]].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())],
        names=["level", "part", "keys", "counts"])


def _packed(ids: np.ndarray) -> bytes:
    steps = ids.copy()
    steps[1:, 0] -= ids[:-1, 0]  # modulo 2^32
    return steps.view(np.uint8).T.tobytes()


def _unpacked(keys: bytes, counts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.ascontiguousarray(np.frombuffer(keys, np.uint8).reshape(4 * width, -1).T).view(np.uint32)
    ids[:, 0] = np.cumsum(ids[:, 0], dtype=np.uint32)
    several = np.frombuffer(counts, np.uint32)
    return ids, np.concatenate([several.astype(_U64), np.ones(len(ids) - len(several), _U64)])


def short_counts(counts: np.ndarray) -> np.ndarray:
    """Counts as they are stored: 32 bits each where all fit, else 64."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() <= MOST_SHORT else np.uint64)


def _distinct_grams(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, total, at = _summed(gram_key(ids), counts)
    return ids[at], total


def _ending(stream: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """(len(last), n): the n numbers of the stream that end at each place."""
    out = np.empty((len(last), n), stream.dtype)
    for j in range(n):
        out[:, j] = stream[last - (n - 1 - j)]
    return out


def _count_grams(model: Model, level: int):
    """n-grams of the highest order; of a lower one, those that start with number 0 at a text's begin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = arrays(model)
        held, size = [], 0

        def flush():
            ids = np.concatenate([i for i, _ in held])
            places = np.concatenate([p for _, p in held])
            # A word at place p (from 1) of its text closes an n-gram of min(p + 1, order) words.
            last = np.flatnonzero(places >= level - 1 if level == model.order else places == level - 1)
            if len(last):
                grams, counts = _distinct_grams(_ending(ids, last, level), np.ones(len(last), np.uint64))
                _, before, _ = known_counts(known, grams[:, -2])
                yield _blobs(grams, counts, known.gram_part(grams, before), level)

        for batch in batches:
            for _, h, at in _sequences(batch.column(0), CHUNK):
                distinct, back = np.unique(h, return_inverse=True)
                numbers = known.numbers(distinct)[0][back]
                held.append((np.insert(numbers, at[:-1], np.uint32(0)),
                             np.arange(len(h) + len(at) - 1) - np.repeat(at[:-1] + np.arange(len(at) - 1), np.diff(at) + 1)))
                size += len(h)
                if size >= FLUSH_TOKENS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()
    return run


def known_counts(known: Arrays, ids: np.ndarray):
    """(numbers, counts, None) by number; 0 and unknown words count as 0."""
    counts = np.zeros(len(ids))
    place = ids.astype(np.int64) - 1
    real = np.flatnonzero((ids > 0) & (ids != UNKNOWN))
    part = np.searchsorted(known.base, place[real], side="right") - 1
    for p, some in known._by_part(part.astype(np.int32)):
        counts[real[some]] = known.file("word-count", p, np.uint64)[place[real[some]] - known.base[p]]
    return ids, counts, None


def _write_grams(model: Model, level: int):
    """Write this task's n-grams of `level`; send on context totals, count frequencies and suffixes.

    Output kinds: "context" (key, total, n1, n2, n3), "count" (key: the count, n1: how many),
    "suffix" (blobs for the next lower order).
    """
    name = f"gram{level}"

    def rows(kind, keys, total, n1, n2, n3):
        n = len(keys)
        none = pa.nulls(n, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.string()), pa.array(keys.view(np.int64)), *(pa.array(np.asarray(x, np.int64)) for x in (total, n1, n2, n3)),
             pa.nulls(n, pa.int32()), none, none], names=_LEVEL_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = arrays(model)
        for part, ids, counts in _gathered(batches, level):
            ids, counts = _distinct_grams(ids, counts)
            put(f"{model.root}/{name}-key-{part}", gram_key(ids))
            put(f"{model.root}/{name}-count-{part}", short_counts(counts))
            one, two, more = (counts == 1), (counts == 2), (counts >= 3)
            keys, *sums, _ = _summed(gram_key(ids[:, :-1]), counts.astype(np.int64), one.astype(np.int64), two.astype(np.int64),
                                     more.astype(np.int64))
            yield rows("context", keys, *sums)
            few = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]
            yield rows("count", np.arange(1, 5, dtype=np.uint64), np.zeros(4), few, np.zeros(4), np.zeros(4))
            # How many different words stand before a suffix; n-grams are distinct, so each counts once.
            suffix, n = _distinct_grams(ids[:, 1:], np.ones(len(ids), np.uint64))
            if level > 2:
                _, before, _ = known_counts(known, suffix[:, -2])
                to = known.gram_part(suffix, before)
            else:
                to = (np.searchsorted(known.base, suffix[:, 0].astype(np.int64) - 1, side="right") - 1).astype(np.int32)
            blobs = _blobs(suffix, n, to, level - 1)
            m = blobs.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(["suffix"] * m, pa.string()), *([pa.nulls(m, pa.int64())] * 5),
                                              *blobs.columns[1:]], names=_LEVEL_COLUMNS)
    return run


_LEVEL_COLUMNS = ["kind", "key", "total", "n1", "n2", "n3", "part", "keys", "counts"]
_LEVEL = "kind string, key long, total long, n1 long, n2 long, n3 long, part int, keys binary, counts binary"


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4.

    Where too few counts leave a discount out of bounds, half of the count's upper bound stands in.
    """
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = []
    for i, (here, after) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = i - (i + 1) * y * after / here if here else -1.0
        out.append(d if 0 < d <= i else i / 2)
    return tuple(out)


def _write_contexts(model: Model, level: int):
    d1, d2, d3 = model.discounts[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            part = batch.column(0).to_numpy()
            cols = np.stack([c.to_numpy() for c in batch.columns[1:]])
            for p in np.unique(part):
                held.setdefault(int(p), []).append(cols[:, part == p])
        for p in sorted(held):
            key, total, n1, n2, n3 = np.concatenate(held.pop(p), axis=1)
            order = np.argsort(key.view(np.uint64), kind="stable")
            put(f"{model.root}/ctx{level}-key-{p}", key.view(np.uint64)[order])
            put(f"{model.root}/ctx{level}-total-{p}", total[order].astype(np.float64))
            put(f"{model.root}/ctx{level}-weight-{p}", ((d1 * n1 + d2 * n2 + d3 * n3) / total)[order].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([len(order)], pa.int64())], names=["part", "contexts"])
    return run


def _write_unigrams(model: Model, total: int, weight: float):
    d = np.array([0.0, *model.discounts[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.concatenate([[0], np.cumsum(model.words)])
        for part, ids, counts in _gathered(batches, 1):
            seen = np.zeros(model.words[part], np.int64)
            np.add.at(seen, ids[:, 0].astype(np.int64) - 1 - base[part], counts.astype(np.int64))
            put(f"{model.root}/word-prob-{part}",
                np.maximum(seen - d[np.minimum(seen, 3)], 0) / total + weight / (model.distinct + 1))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], names=["part"])
    return run


def _seen_counts(model: Model):
    """Unigram continuation counts: their sum and how many are 1, 2, 3, 4 or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.concatenate([[0], np.cumsum(model.words)])
        for part, ids, counts in _gathered(batches, 1):
            seen = np.zeros(model.words[part], np.int64)
            np.add.at(seen, ids[:, 0].astype(np.int64) - 1 - base[part], counts.astype(np.int64))
            few = np.bincount(np.minimum(seen, 5), minlength=6)[1:5]
            yield pa.RecordBatch.from_arrays([pa.array([int(seen.sum())], pa.int64()), pa.array([int((seen >= 3).sum())], pa.int64()),
                                              *(pa.array([int(x)], pa.int64()) for x in few)],
                                             names=["total", "more", "n1", "n2", "n3", "n4"])
    return run


def train(texts: DataFrame, work: Workspace, order: int = ORDER) -> Model:
    """Count the model of a one-column table of texts (null: empty) and write its arrays."""
    if order < 2:
        raise ValueError("order must be at least 2")
    size = texts.agg(F.sum(F.octet_length(F.col(texts.columns[0])) + 1)).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    model = Model(qualified(work.spark, work.path("arrays")), order, vocabulary_parts=max(1, parts // 4), gram_parts=parts)

    def dealt(blobs: DataFrame, n: int) -> DataFrame:
        return blobs.select("part", "keys", "counts").repartition(n, "part")

    counted = texts.mapInArrow(_count_words(model.vocabulary_parts), "part int, keys binary, counts binary")
    words = work.write(dealt(counted, model.vocabulary_parts).mapInArrow(_write_words(model.root), "part int, words long, total long"), "words")
    # One row a file; a part that no word falls into has no file and no row.
    found = {r["part"]: r for r in words.collect()}
    model.words = [found[p]["words"] if p in found else 0 for p in range(model.vocabulary_parts)]
    model.train_tokens = sum(r["total"] for r in found.values())
    if model.distinct > MOST_WORDS:
        raise OverflowError(f"{model.distinct} distinct words; word numbers have 32 bits")
    _fill(model, "word", ("key", np.uint64), ("count", np.uint64), parts=[p for p in range(model.vocabulary_parts) if p not in found])
    if not model.train_tokens:
        return model

    lower: DataFrame | None = None
    for level in range(order, 1, -1):
        blobs = texts.mapInArrow(_count_grams(model, level), "level int, part int, keys binary, counts binary")
        if lower is not None:
            blobs = blobs.select("part", "keys", "counts").union(lower)
        out = work.write(dealt(blobs, model.gram_parts).mapInArrow(_write_grams(model, level), _LEVEL), f"level-{level}")
        found_parts = _present(model, f"gram{level}-key", model.gram_parts)
        _fill(model, f"gram{level}", ("key", np.uint64), ("count", np.uint32), parts=sorted(set(range(model.gram_parts)) - found_parts))
        model.discounts[level] = discounts({r["key"]: r["n"] for r in out.where("kind = 'count'").groupBy("key")
                                            .agg(F.sum("n1").alias("n")).collect()})
        contexts = (out.where("kind = 'context'").groupBy("key")
                    .agg(*(F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3")))
                    .withColumn("part", _context_part(model.gram_parts)))
        work.write(contexts.select("part", "key", "total", "n1", "n2", "n3").repartition(model.gram_parts, "part")
                   .mapInArrow(_write_contexts(model, level), "part int, contexts long"), f"contexts-{level}")
        found_parts = _present(model, f"ctx{level}-key", model.gram_parts)
        _fill(model, f"ctx{level}", ("key", np.uint64), ("total", np.float64), ("weight", np.float64),
              parts=sorted(set(range(model.gram_parts)) - found_parts))
        lower = out.where("kind = 'suffix'").select("part", "keys", "counts")

    n = max(1, model.vocabulary_parts)
    got = (dealt(lower, n).mapInArrow(_seen_counts(model), "total long, more long, n1 long, n2 long, n3 long, n4 long")
           .agg(*(F.sum(c).alias(c) for c in ("total", "more", "n1", "n2", "n3", "n4"))).first())
    d1, d2, d3 = model.discounts[1] = discounts({i: got[f"n{i}"] for i in range(1, 5)})
    weight = (d1 * got["n1"] + d2 * got["n2"] + d3 * got["more"]) / got["total"]
    model.unknown = weight / (model.distinct + 1)
    work.write(dealt(lower, n).mapInArrow(_write_unigrams(model, got["total"], weight), "part int"), "unigrams")
    return model


def _present(model: Model, name: str, parts: int) -> set[int]:
    fs, path = pafs.FileSystem.from_uri(model.root)
    infos = fs.get_file_info([f"{path}/{name}-{p}" for p in range(parts)])
    return {p for p, i in enumerate(infos) if i.type == pafs.FileType.File}


def _fill(model: Model, name: str, *columns: tuple[str, type], parts: list[int]) -> None:
    """Empty files for parts that got no key."""
    for p in parts:
        for column, dtype in columns:
            put(f"{model.root}/{name}-{column}-{p}", np.zeros(0, dtype))


def _context_part(parts: int) -> Column:
    """File of a context: a multiplicative hash of its key in Spark's integers; `_context_parts` does the same."""
    return F.pmod(F.col("key").bitwiseXOR(F.shiftrightunsigned("key", 32)), F.lit(parts)).cast("int")


def _context_parts(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys ^ (keys >> _U64(32))).view(np.int64) % np.int64(parts)).astype(np.int32)


# ---- scoring ---------------------------------------------------------------------
def token_probabilities(known: Arrays, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability, training count) of every token of a chunk of texts."""
    model = known.model
    distinct, back = np.unique(h, return_inverse=True)
    ids, counts, probs = known.numbers(distinct, values=True)
    number, count, p = ids[back], counts[back], probs[back]
    place = np.arange(len(h)) - np.repeat(at[:-1], np.diff(at)) + 1  # from 1, behind the begin
    stream = np.insert(number, at[:-1], np.uint32(0))
    seen = np.insert(count, at[:-1], 0.0)
    where = np.arange(len(h)) + np.repeat(np.arange(1, len(at)), np.diff(at))
    for level in sorted(set(model.discounts) - {1}):  # none where nothing was learned
        use = np.flatnonzero(place >= level - 1)
        grams = _ending(stream, where[use], level)
        fine = (grams[:, :-1] != UNKNOWN).all(axis=1)
        use, grams = use[fine], grams[fine]
        if not len(use):
            break
        keys = gram_key(grams)
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        ids = grams[first]
        context = gram_key(ids[:, :-1])
        c_keys, c_back = np.unique(context, return_inverse=True)
        there, total, weight = known.find(f"ctx{level}", _context_parts(c_keys, model.gram_parts), c_keys,
                                          [("total", np.float64), ("weight", np.float64)])
        _, n = known.find(f"gram{level}", known.gram_part(ids, seen[where[use[first]] - 1]), distinct, [("count", None)])
        d = np.array([0.0, *model.discounts[level]])[np.minimum(n, 3).astype(np.int64)]
        there, total, weight = there[c_back], total[c_back], weight[c_back]
        own = np.where(there, np.maximum(n - d, 0) / np.maximum(total, 1), 0.0)
        weight = np.where(there, weight, 1.0)  # a context never seen leaves the lower order as it is
        p[use] = own[back] + weight[back] * p[use]
    return p, count


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = arrays(model)
        unseen = model.train_tokens + 0.5 * (model.distinct + 1)
        for batch in batches:
            for a, h, at in _sequences(batch.column(batch.num_columns - 1), CHUNK):
                p, count = token_probabilities(known, h, at)
                n = np.diff(at)
                sums = [np.add.reduceat(x, at[:-1]) for x in (np.log10(p), np.log10((count + 0.5) / unseen), (count > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(a, len(n)) for c in batch.columns[:-1]), pa.array(n.astype(np.int64)), pa.array(sums[2].astype(np.int64)),
                     pa.array(np.full(len(n), model.train_tokens, np.int64)), pa.array(sums[1]), pa.array(sums[0])],
                    names=[*batch.schema.names[:-1], "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of `docs` but its last, the text, then n_tokens, n_known, train_tokens, base_score, score.

    A text's tokens are its words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case
    and one end.  base_score: add-half unigram log10 probability; score: the
    model's.  Null and empty texts have the end token only; without training
    texts every token has probability 1.
    """
    add = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("train_tokens", T.LongType()),
           ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    return docs.mapInArrow(_score(model), T.StructType([*docs.schema.fields[:-1], *(T.StructField(*x) for x in add)]))


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32(doc_id as text) mod 5 equals the remainder; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def score_documents(docs: DataFrame, work: Workspace, order: int = ORDER, remainder: int = 1) -> DataFrame:
    """doc_id, held_out and `score`'s columns for every document; the model learns from those not held out.

    Documents with a null id are scored and learned from.  Repeated rows count
    as often as they stand; an empty table gives no rows; columns other than
    doc_id and text are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select("doc_id", held_out(F.col("doc_id"), remainder).alias("held_out"), text)
    return score(rows, train(rows.where("not held_out").select("text"), work, order))
