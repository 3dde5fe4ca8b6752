"""Embedding near-duplicates: p-stable Euclidean hashing, then exact cosine.

Equal vectors are one class and are never paired with each other.  Class
vectors, normalised, get in each of L tables a bucket of k quantised random
projections.  Inside a bucket all pairs are compared in double precision by
block products, so links are counted without being written down; a pair that
meets in several tables is counted in the first only.  Buckets larger than a
block are split into pairs of blocks over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm.common import Workspace
from spillway.llm.graph import components

THRESHOLD = 0.9
WIDTH = 2.0          # quantisation step; unit vectors at the threshold are 0.447 apart
RECALL = 0.97        # least chance that a pair exactly at the threshold meets in some table
OCCUPANCY = 128      # unrelated vectors wanted per bucket: k grows with the logarithm of the input
BLOCK = 1024         # vectors of a bucket compared in one task
SEED = 20240229


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors so far apart fall into one cell of a projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def tables_for(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(projections per table, tables) for n vectors."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    k = max(2, math.ceil(math.log(max(n, 2) / OCCUPANCY) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log(1 - near ** k)))


def _projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, WIDTH, k * tables)


def bucket_hashes(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """(rows, tables) 64-bit bucket hashes of unit vectors."""
    a, b = _projections(unit.shape[1], k, tables)
    cells = np.floor((unit @ a + b) / WIDTH).astype(np.int64).reshape(len(unit), tables, k)
    salt = np.random.default_rng([SEED, k, unit.shape[1]]).integers(1, 1 << 62, k, dtype=np.int64) | 1
    with np.errstate(over="ignore"):
        h = (cells * salt).sum(axis=2).astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(29))).view(np.int64)


def units(vectors: pa.ListArray) -> list[np.ndarray]:
    """The rows, which may differ in length, scaled to length one in double precision."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    offs = vectors.offsets.to_numpy() - vectors.offsets.to_numpy()[0]
    out = []
    for a, b in zip(offs[:-1], offs[1:], strict=True):
        v = flat[a:b]
        v = v / max(np.abs(v).max(), 1e-300)  # squares neither overflow nor vanish
        out.append(v / math.sqrt(float(v @ v)))
    return out


def _hash_rows(k: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            rows = units(batch.column(1))
            for dim in sorted({len(v) for v in rows}):
                at = [i for i, v in enumerate(rows) if len(v) == dim]
                h = bucket_hashes(np.array([rows[i] for i in at]), k, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[at], tables)), pa.array(np.full(h.size, dim, np.int32)),
                     pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))), pa.array(h.ravel())],
                    names=["cid", "dim", "tab", "bucket"])
    return run


def _local_components(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable inside the block, for every row of a symmetric link matrix."""
    label, seen = ids.copy(), np.zeros(len(ids), bool)
    for i in np.argsort(ids):
        if seen[i]:
            continue
        reach = np.zeros(len(ids), bool)
        reach[i] = True
        edge = reach.copy()
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reach
            reach |= edge
        label[reach] = ids[i]
        seen |= reach
    return label


def _compare(k: int, tables: int, threshold: float):
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("label", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        empty = schema.empty_table()
        if group.num_rows < 2:
            return empty
        ids, n, side = (group.column(c).to_numpy() for c in ("cid", "n", "side"))
        table = int(group.column("tab")[0].as_py())
        i, j = int(group.column("i")[0].as_py()), int(group.column("j")[0].as_py())
        unit = np.array(units(group.column("embedding").chunk(0)))
        linked = unit @ unit.T >= threshold
        if i == j:
            np.fill_diagonal(linked, False)
        else:
            linked &= side[:, None] != side[None, :]
        a, b = np.nonzero(linked)
        if not len(a):
            return empty
        if table:  # a pair that met in an earlier table was counted there
            rows = np.unique(a)
            h = np.zeros((len(ids), tables), np.int64)
            h[rows] = bucket_hashes(unit[rows], k, tables)
            old = np.zeros(len(a), bool)
            for t in range(table):
                old |= h[a, t] == h[b, t]
            linked[a[old], b[old]] = False
        links = linked @ n
        rows = np.flatnonzero(links)
        if not len(rows):
            return empty
        label = _local_components(linked[np.ix_(rows, rows)], ids[rows])
        return pa.table([pa.array(ids[rows]), pa.array(links[rows].astype(np.int64)), pa.array(label)], schema=schema)
    return run


def near_duplicates(vectors: DataFrame, work: Workspace, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    n_links: other rows linked directly (cosine >= threshold, equal vectors
    included); component_id: smallest vec_id reachable; kept: whether that is
    the row's own id.  Vectors that are null, empty, zero or have null or
    non-finite components link with nothing and are their own component;
    vectors of different lengths never link.  Rows with a null id are compared
    like others, with component_id null if no row they reach has an id; such a row
    is kept.  Repeated rows are rows of their own.  An empty table gives no
    rows; columns other than vec_id and embedding are not read.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")) \
        if dict(vectors.dtypes)["embedding"] != "array<double>" else vectors.select("vec_id", "embedding")
    fine = F.coalesce((F.size("embedding") > 0)
                      & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("fine", fine)
    # The aggregation collapses equal vectors on the map side; ids are fixed by the write.
    classes = work.write(rows.where("fine").groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
                         .withColumn("cid", F.monotonically_increasing_id()), "classes")
    k, tables = tables_for(classes.count(), threshold, recall)
    hashed = work.write(classes.select("cid", "embedding").mapInArrow(
        _hash_rows(k, tables), "cid long, dim int, tab int, bucket long"), "hashed")
    crowded = (hashed.groupBy("dim", "tab", "bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
               .withColumn("blocks", F.ceil(F.col("crowd") / BLOCK).cast("int")))
    # Row of block b goes to the pairs (b, j) and (i, b): every two blocks of a bucket meet once.
    placed = (hashed.join(crowded, ["dim", "tab", "bucket"])
              .withColumn("b", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
              .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("cid", "dim", "tab", "bucket", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"),
                      (F.col("b") > F.col("o")).alias("side")))
    partial = work.write(
        placed.join(classes.select("cid", "n", "embedding"), "cid")
        .groupBy("dim", "tab", "bucket", "i", "j")
        .applyInArrow(_compare(k, tables, threshold), "cid long, links long, label long"), "partial")
    counts = partial.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(partial.select("cid", "label").where("cid <> label"), work, "component")
    rated = (classes.join(counts, "cid", "left")
             .join(groups.withColumnRenamed("id", "cid"), "cid", "left")
             .select("cid", "embedding", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "cid").alias("component")))
    names = rated.groupBy("component").agg(F.min("first").alias("component_id"))
    rated = work.write(rated.join(names, "component").select("embedding", "n_links", "component_id"), "rated")
    found = rows.where("fine").join(rated, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
