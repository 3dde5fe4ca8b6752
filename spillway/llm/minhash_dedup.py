"""Near-duplicate documents: ProbMinHash signatures, banding, exact verification.

A text's weighted five-word shingles (weight: how often each stands in it) each
start a Poisson process whose rate is the weight; every arrival falls on a
random component of the signature, and the earliest arrival's shingle is the
component's value.  A process ends once its next arrival is later than the
latest component, so long texts cost little more than one draw a shingle.  Two
signatures agree in a component with the probability Jaccard similarity of the
weighted sets.  Bands of the signature are the candidates' buckets; candidates
whose signatures are too far apart are dropped, the others verified exactly.

Texts with the same words are one class.  The classes of a bucket are compared
in blocks, by their signatures: first the strongest agreements that would
connect them are verified, then every pair that is still in two components.  So
no link that could join two groups is lost, and a large group of near copies is
not written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spillway.llm import tokens
from spillway.llm.common import Workspace, long_lists, sorted_groups, text_keys, whole_row
from spillway.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 42, 6     # a pair at 0.8 misses all bands with probability (1 - 0.8**6)**42 = 3e-6
SIGNATURE = BANDS * ROWS
ERRORS = 3.5            # signatures may fall short of the similarity by so many standard errors: one pair at 0.8 in 4,000 does
BLOCK = 1024            # members of a bucket compared at once
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / 9007199254740992.0)


def probminhash(items: np.ndarray, weights: np.ndarray, offs: np.ndarray, size: int) -> np.ndarray:
    """(rows, size) signatures of weighted sets given flat with row offsets; empty sets give zeros.

    All rows of the batch advance together, one arrival of every element that
    is still active at a time.
    """
    rows = len(offs) - 1
    best = np.full(rows * size, np.inf)
    sign = np.zeros(rows * size, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(offs))
    latest = np.full(rows, np.inf)
    at = np.zeros(len(items))
    state, now, turn = items, np.arange(len(items)), 0
    with np.errstate(over="ignore"):
        while len(now):
            turn += 1
            draw = tokens.mix(state[now] + _GOLDEN * np.uint64(turn))
            at[now] -= np.log(_uniform(draw)) / weights[now]
            now = now[at[now] < latest[row[now]]]  # early termination
            if not len(now):
                break
            draw = tokens.mix(tokens.mix(state[now] + _GOLDEN * np.uint64(turn)) + np.uint64(1))
            part = row[now] * size + ((draw >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(best, part, at[now])
            won = at[now] == best[part]
            sign[part[won]] = state[now[won]]
            hit = np.unique(row[now[won]])
            latest[hit] = best.reshape(rows, size)[hit].max(axis=1)
    return sign.reshape(rows, size)


def weighted_shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: distinct shingles (sorted), their counts, offsets; and two hashes of all its words in order."""
    h, at, _, _ = tokens.words(data, offs)
    g, per = tokens.grams(h, at, SHINGLE, short=True)
    rows = len(offs) - 1
    row = np.repeat(np.arange(rows), np.diff(per))
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(g)))
    offsets = np.searchsorted(row[first], np.arange(rows + 1))
    with np.errstate(over="ignore"):
        place = np.arange(len(h), dtype=np.uint64) - np.repeat(at[:-1], np.diff(at)).astype(np.uint64)
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens.mix(h + tokens.mix(place * _GOLDEN + np.uint64(s))))])
                for s in (3, 5)]
        keys = [s[at[1:]] - s[at[:-1]] for s in sums]
    return g[first], counts, offsets, keys[0], keys[1]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, r1, r2, text -> doc_id, r1, r2, w1, w2, sign: one byte for each component."""
    for batch in batches:
        data, offs = tokens.buffers(batch.column(3))
        for a, b in tokens.chunks(offs):
            part = batch.slice(a, b - a)
            items, counts, at, w1, w2 = weighted_shingles(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
            sign = (probminhash(items, counts.astype(np.float64), at, SIGNATURE) & np.uint64(255)).astype(np.uint8)
            some = np.diff(at) > 0
            # Without a word there is no shingle: such texts are equal only as texts.
            w1 = np.where(some, w1.view(np.int64), part.column(1).to_numpy())
            w2 = np.where(some, w2.view(np.int64), part.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(2), pa.array(w1), pa.array(w2),
                 pa.array([x.tobytes() if y else None for x, y in zip(sign, some, strict=True)], pa.binary())],
                names=["doc_id", "r1", "r2", "w1", "w2", "sign"])


def least_agreement(similarity: float) -> int:
    """Components in which two similar enough texts agree at least (bytes agree by chance once in 256)."""
    p = similarity + (1 - similarity) / 256
    return int(np.ceil(SIGNATURE * p - ERRORS * np.sqrt(SIGNATURE * p * (1 - p))))


def _signs(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SIGNATURE)


def _agreements(x: np.ndarray) -> np.ndarray:
    """(rows, rows) numbers of equal components; SIGNATURE is under 256."""
    if len(x) <= 64:
        return (x[:, None] == x[None]).sum(axis=2, dtype=np.uint8)
    out = np.zeros((len(x), len(x)), np.uint8)
    for c in np.ascontiguousarray(x.T):
        out += c[:, None] == c[None, :]
    return out


def _first_shared(signs: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first band in which each pair of signatures agrees."""
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 20_000):
        same = (signs[a[i:i + 20_000]] == signs[b[i:i + 20_000]]).reshape(-1, BANDS, ROWS).all(axis=2)
        out[i:i + 20_000] = same.argmax(axis=1)
    return out


def _strongest(agree: np.ndarray, group: np.ndarray) -> list[tuple[int, int]]:
    """A forest that joins the groups along their highest agreements (0: none), at most one edge fewer than groups."""
    group = np.unique(group, return_inverse=True)[1]
    edges: list[tuple[int, int]] = []
    while True:
        out = np.where(group[:, None] != group[None, :], agree, 0)
        to = out.argmax(axis=1)
        best = out[np.arange(len(group)), to]
        if not best.any():
            return edges
        order = np.lexsort((best, group))
        last = order[np.flatnonzero(np.append(np.diff(group[order]) > 0, True))]  # each group's strongest row
        for i in last[best[last] > 0]:
            a, b = group[i], group[to[i]]
            if a != b:
                edges.append((int(i), int(to[i])))
                group[group == b] = a


def _blocks(least: int, every: bool):
    """Sorted bucket, i, j, cid, component, side, sign, band -> pairs (a, b) to verify.

    `every`: all pairs in two components that agree well enough; else a forest
    of the strongest.  Each pair comes from the first band it shares.  A forest's
    edge left out so is spanned by the forest of that earlier bucket, which holds
    both its ends, along agreements at least as strong.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, 3):
            cid, component, side = (rows.column(c).to_numpy() for c in ("cid", "component", "side"))
            if len(cid) < 2:
                continue
            signs = _signs(rows.column("sign"))
            agree = _agreements(signs)
            agree[agree < least] = 0
            if rows.column("i")[0] != rows.column("j")[0]:
                agree[side[:, None] == side[None, :]] = 0
            if every:
                agree[component[:, None] == component[None, :]] = 0
                a, b = np.nonzero(np.triu(agree))
            else:
                a, b = np.array(_strongest(agree, component), np.int64).reshape(-1, 2).T
            here = _first_shared(signs, a, b) == rows.column("band")[0].as_py()
            a, b = a[here], b[here]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(cid[a], cid[b])), pa.array(np.maximum(cid[a], cid[b]))], names=["a", "b"])
    return run


def _shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid, text -> cid, items, counts."""
    for batch in batches:
        data, offs = tokens.buffers(batch.column(1))
        for a, b in tokens.chunks(offs):
            items, counts, at, _, _ = weighted_shingles(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
            flat = pa.array(counts.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), long_lists(items, at),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat)], names=["cid", "items", "counts"])


def probability_jaccard(x: np.ndarray, xw: np.ndarray, y: np.ndarray, yw: np.ndarray) -> float:
    """Sum over common items i of 1 / sum over j of max(x_j / x_i, y_j / y_i); items sorted."""
    if not len(x) or not len(y):
        return 0.0
    every = np.union1d(x, y)
    a, b = np.zeros(len(every)), np.zeros(len(every))
    a[np.searchsorted(every, x)] = xw
    b[np.searchsorted(every, y)] = yw
    common = (a > 0) & (b > 0)
    pairs, many = np.unique(np.stack([a[common], b[common]], axis=1), axis=0, return_counts=True)
    return float(sum(n / np.maximum(a / p, b / q).sum() for (p, q), n in zip(pairs, many, strict=True)))


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [(c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets.to_numpy()[0]) if len(c) else (None, None)
                    for c in batch.columns[2:]]
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, xw, y, yw = (flat[at[i]:at[i + 1]] for flat, at in cols)
                keep[i] = probability_jaccard(x, xw, y, yw) >= similarity - 1e-12
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))
    return run


class _Search:
    """The candidate search of one run: bucket members, verified links, components so far."""

    def __init__(self, docs: DataFrame, work: Workspace, similarity: float) -> None:
        self.docs, self.work, self.similarity, self.least = docs, work, similarity, least_agreement(similarity)
        signed = docs.select("doc_id", "r1", "r2", "text").mapInArrow(
            _sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, r1 long, r2 long, w1 long, w2 long, sign binary")
        self.signed = work.write(signed, "signed")
        self.classes = work.write(
            self.signed.groupBy("w1", "w2").agg(F.first("r1").alias("r1"), F.first("r2").alias("r2"), F.first("sign").alias("sign"))
            .withColumn("cid", F.monotonically_increasing_id()), "classes")
        bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                            lambda i: F.xxhash64(i, F.substring("sign", i * ROWS + 1, F.lit(ROWS))))
        members = self.classes.where("sign is not null").select("cid", F.posexplode(bands).alias("band", "bucket"))
        crowded = members.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
        self.members = work.write(members.join(crowded, "bucket").select("bucket", "band", "cid", "crowd"), "members")
        self.signs = self.classes.select("cid", "sign")

    def shingles(self) -> DataFrame:
        """Weighted shingles of every class that shares a bucket."""
        wanted = self.members.select("cid").distinct().join(self.classes.select("cid", "r1", "r2"), "cid")
        texts = self.docs.select("r1", "r2", "text").join(wanted, ["r1", "r2"]).select("cid", "text")
        per = texts.mapInArrow(_shingle, "cid long, items array<long>, counts array<int>")
        return self.work.write(per.groupBy("cid").agg(F.first("items").alias("items"), F.first("counts").alias("counts")), "shingles")

    def verified(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that are similar enough."""
        left = sets.select(F.col("cid").alias("a"), F.col("items").alias("x"), F.col("counts").alias("xw"))
        right = sets.select(F.col("cid").alias("b"), F.col("items").alias("y"), F.col("counts").alias("yw"))
        full = pairs.distinct().join(left, "a").join(right, "b").select("a", "b", "x", "xw", "y", "yw")
        return self.work.write(full.mapInArrow(_verify(self.similarity), "a long, b long"), name)

    def open_buckets(self, groups: DataFrame) -> DataFrame:
        """Members of buckets that hold several components and more than the one pair that was compared."""
        placed = (self.members.where("crowd > 2").select("bucket", "band", "cid", "crowd").join(groups, "cid", "left")
                  .select("bucket", "band", "cid", "crowd", F.coalesce("component", "cid").alias("component")))
        mixed = placed.groupBy("bucket").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q")
        return placed.join(mixed.select("bucket"), "bucket", "left_semi")

    def in_blocks(self, opened: DataFrame, every: bool) -> DataFrame:
        """Pairs to verify, from comparing blocks of buckets; all pairs of blocks, or each block in itself and with the first."""
        count = F.ceil(F.col("crowd") / BLOCK).cast("int")
        block = F.pmod(F.xxhash64("cid"), count).cast("int")
        others = F.sequence(F.lit(0), F.col("count") - 1)
        if not every:
            others = F.when(F.col("block") == 0, others).otherwise(F.array(F.lit(0), F.col("block")))
        dealt = (opened.withColumns({"count": count, "block": block}).withColumn("other", F.explode(others))
                 .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "cid", "component", (F.col("block") > F.col("other")).alias("side"), "band")
                 .join(self.signs, "cid").select("bucket", "i", "j", "cid", "component", "side", "sign", "band"))
        return (dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
                .mapInArrow(_blocks(self.least, every), "a long, b long"))

    def run(self) -> DataFrame:
        """(cid, component) of all classes that have a link."""
        sets = self.shingles()
        apart = self.members.withColumn("component", F.col("cid"))
        edges = self.verified(self.in_blocks(apart, every=False), sets, "strongest")
        groups = components(edges, self.work, "groups-1").withColumnRenamed("id", "cid")
        rest = self.verified(self.in_blocks(self.open_buckets(groups), every=True), sets, "rest")
        return components(groups.select("cid", "component").union(rest), self.work, "groups-2").withColumnRenamed("id", "cid")


def _keyed(docs: DataFrame) -> DataFrame:
    r1, r2 = text_keys(F.col("text"))
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumns({"r1": r1, "r2": r2})


def grouped_documents(docs: DataFrame, work: Workspace, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, r1, r2, group): every row with its group; a written table.

    r1, r2 identify the text.  Rows are in one group if their texts have equal
    words in order, or are connected by probability Jaccard >= similarity of
    their weighted shingles (1 to 4 words are one shingle).  Texts without any
    word are equal only as texts; empty and null texts get the null group and are
    near-duplicates of nothing.
    """
    search = _Search(_keyed(docs), work, similarity)
    found = search.run()
    of_class = search.classes.select("w1", "w2", "cid").join(found, "cid", "left") \
        .select("w1", "w2", F.coalesce("component", "cid").alias("group"))
    e1, e2 = text_keys(F.lit(""))
    return work.write(search.signed.select("doc_id", "r1", "r2", "w1", "w2").join(of_class, ["w1", "w2"])
                      .select("doc_id", "r1", "r2", F.when(~((F.col("r1") == e1) & (F.col("r2") == e2)), F.col("group")).alias("group")),
                      "grouped")


def _ident() -> list:
    return [F.col("doc_id").isNull().alias("gone"), F.col("doc_id").alias("doc_id"), F.col("r1").alias("r1"), F.col("r2").alias("r2")]


def near_duplicates(docs: DataFrame, work: Workspace, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, group_id, group_size, kept: one row per document.

    group_id: the smallest doc_id of the group (null if none has an id); kept:
    this row is the one that stays: the smallest doc_id, null ids last, ties by
    text.  Of rows equal in doc_id and text one stays, but each has its row
    here, all of them kept.  Empty and null texts are groups of their own and
    kept.  An empty table gives no rows.  Columns other than doc_id and text
    are not read.
    """
    rows = grouped_documents(docs, work, similarity)
    best = rows.where("group is not null").groupBy("group").agg(
        F.min("doc_id").alias("group_id"), F.count("*").alias("group_size"), F.min(F.struct(*_ident())).alias("best"))
    joined = rows.join(best, "group", "left")
    kept = F.col("group").isNull() | F.struct(*_ident()).eqNullSafe(F.col("best"))
    return joined.select("doc_id", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"))


def deduplicate(docs: DataFrame, work: Workspace, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, one of each group, all columns as they are; empty and null texts stay."""
    rows = grouped_documents(docs, work, similarity)
    ident = F.struct(*_ident())
    winners = work.write(
        rows.where("group is not null").groupBy("group", ident.alias("ident")).agg(F.count("*").alias("times"))
        .groupBy("group").agg(F.min(F.struct("ident", "times")).alias("w")).select("w.ident.*", "w.times"), "winners")
    r1, r2 = text_keys(F.col("text").cast("string"))
    packed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("row_id"), r1.alias("r1"), r2.alias("r2"))
    e1, e2 = text_keys(F.lit(""))
    empty = (F.col("r1") == e1) & (F.col("r2") == e2)

    def chosen(some: DataFrame) -> DataFrame:
        some = some.select(F.col("doc_id").alias("win_id"), F.col("r1").alias("win1"), F.col("r2").alias("win2"))
        return packed.join(some, F.col("row_id").eqNullSafe(F.col("win_id")) & (F.col("r1") == F.col("win1"))
                           & (F.col("r2") == F.col("win2")), "left_semi")

    once = chosen(winners.where("times = 1")).select("row.*")
    again = chosen(winners.where("times > 1")).groupBy("row_id", "r1", "r2").agg(F.first("row").alias("row")).select("row.*")
    return once.union(again).union(packed.where(empty).select("row.*"))
