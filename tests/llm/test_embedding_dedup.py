import math
from collections import Counter

import numpy as np
import pytest

from spillway.llm import embedding_dedup as e
from spillway.llm.common import Workspace

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    """vec_id, n_links, component_id, kept by comparing all pairs in double precision."""
    n = len(rows)
    unit = [np.asarray(np.asarray(v, np.float32), np.float64) if usable(v) else None for _, v in rows]
    unit = [None if u is None else u / np.linalg.norm(u / np.abs(u).max()) / np.abs(u).max() for u in unit]
    linked = [[a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9
               for b in range(n)] for a in range(n)]
    seen, out = {}, []
    for a in range(n):
        if a in seen:
            continue
        group, edge = {a}, [a]
        while edge:
            edge = [b for x in edge for b in range(n) if linked[x][b] and not (b in group or group.add(b))]
        ids = [rows[x][0] for x in group if rows[x][0] is not None]
        seen.update({x: min(ids) if ids else None for x in group})
    for a in range(n):
        out.append((rows[a][0], sum(linked[a]), seen[a], rows[a][0] == seen[a]))
    return out


def clusters(seed, dim, sizes, spread):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        c = rng.standard_normal(dim)
        out += [(c + rng.standard_normal(dim) * spread * np.linalg.norm(c) / math.sqrt(dim)).astype(np.float32).tolist() for _ in range(size)]
    return out


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    return [tuple(r) for r in e.near_duplicates(df, Workspace(spark, "t")).collect()]


def test_cases(spark):
    v = clusters(1, 8, [1], 0)[0]
    rows = [(5, v), (3, v), (5, v), (7, [2 * x for x in v]), (8, [-x for x in v]), (None, v), (None, None), (10, None), (11, []), (12, [0.0] * 8),
            (13, [1.0, None] + [0.0] * 6), (14, [float("nan")] * 8), (15, [float("inf")] + [1.0] * 7), (16, [1.0, 2.0]), (17, [1.0, 2.1]),
            (18, [1e-30, 2e-30]), (19, [1e30, 2e30])]
    assert Counter(run(spark, rows)) == Counter(brute(rows))
    assert run(spark, []) == []
    extra = spark.createDataFrame([(1, v, 1, 2, 3), (2, v, 1, 2, 3)], SCHEMA + ", cid int, bucket int")
    assert e.near_duplicates(extra, Workspace(spark, "t")).count() == 2


@pytest.mark.parametrize("block", [1024, 16])
def test_clusters_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", block)
    vectors = clusters(2, 32, [1] * 60 + [2] * 10 + [90, 25], 0.15)
    rows = [(1000 - i, v) for i, v in enumerate(vectors)] + [(2000 + i, vectors[100]) for i in range(40)]
    assert Counter(run(spark, rows)) == Counter(brute(rows))


def test_recall_at_the_threshold(spark):
    """Pairs a little above the threshold: at least nine in ten are found, and none below it."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a, b = rng.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cos = 0.902 if i < 300 else 0.898
        rows += [(2 * i, a.astype(np.float32).tolist()), (2 * i + 1, (cos * a + math.sqrt(1 - cos * cos) * b).astype(np.float32).tolist())]
    got = {r[0]: r for r in run(spark, rows)}
    assert sum(got[2 * i][1] for i in range(300)) >= 270
    assert all(got[2 * i][1] == 0 for i in range(300, 400))


def test_parameters_grow_with_the_logarithm():
    (k1, t1), (k2, t2) = e.tables_for(10_000), e.tables_for(10_000_000)
    assert k1 < k2 < 3 * k1 and t1 < t2
    near = e.collision(math.sqrt(0.2))
    for k, t in ((k1, t1), (k2, t2)):
        assert 1 - (1 - near ** k) ** t >= e.RECALL


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = Counter(tuple(r) for r in e.near_duplicates(df, Workspace(spark, "t")).collect())
    assert got == Counter(brute([(r["vec_id"], r["embedding"]) for r in df.collect()]))
