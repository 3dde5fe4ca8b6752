import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from spillway.llm import minhash_dedup as m
from spillway.llm.common import Workspace
from tests.llm.helpers import clashing, documents


def words(text):
    return tuple(re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (text or "").lower()))


def shingles(w):
    return Counter(w[i:i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else Counter([w] if w else [])


def jaccard(a, b):
    """Probability Jaccard by its definition."""
    every = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in set(a) & set(b))


def brute_groups(rows):
    """Group of each (doc_id, text): equal words, equal texts without words, or similarity of 0.8."""
    texts = sorted({t or "" for _, t in rows})
    key = {t: words(t) or ("text", t) for t in texts}
    sets = {t: shingles(words(t)) for t in texts}
    up = {t: t for t in texts}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if key[a] == key[b] or (sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8):
                up[root(a)] = root(b)
    return {t: root(t) for t in texts}


def check(rows, result):
    group = brute_groups(rows)
    members = defaultdict(list)
    for i, t in rows:
        if t:
            members[group[t]].append((i is None, i, t))
    got = Counter((r["doc_id"], r["group_id"], r["group_size"]) for r in result)
    want = Counter()
    for i, t in rows:
        some = members[group[t]] if t else [(i is None, i, t)]
        ids = [x for _, x, _ in some if x is not None]
        want[(i, min(ids) if ids else None, len(some))] += 1
    assert got == want
    kept = [r for r in result if r["kept"]]
    assert {r["doc_id"] for r in kept} >= {min(i for _, i, _ in s if i is not None) for s in members.values() if any(x[1] is not None for x in s)}
    return group


def variants(seed, base, count, edits):
    """Copies of a text with 0 to `edits` words replaced."""
    rng = random.Random(seed)
    w = [f"b{base}w{rng.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(count):
        v = list(w)
        for _ in range(rng.randrange(edits + 1)):
            v[rng.randrange(len(v))] = f"e{seed}{i}{rng.randrange(99)}"
        out.append(" ".join(v))
    return out


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_cases(spark, wrap):
    docs = wrap(documents(spark))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, m.near_duplicates(docs, Workspace(spark, "t")).collect())
    kept = m.deduplicate(docs, Workspace(spark, "t"))
    assert kept.columns == docs.columns
    texts = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    group = brute_groups(rows)
    assert Counter(group[t] for _, t in texts.elements() if t) == Counter({group[t]: 1 for _, t in rows if t})
    assert texts[(3, None)] == texts[(4, "")] == texts[(None, None)] == 1  # nothing equals an empty text
    assert m.near_duplicates(documents(spark, []), Workspace(spark, "t")).count() == 0
    assert m.deduplicate(documents(spark, []), Workspace(spark, "t")).count() == 0


def test_groups_of_near_copies_equal_brute_force(spark):
    """Chains of edits on both sides of the threshold, repeated words, copies; blocks smaller than the groups."""
    rows = [(i, t) for i, t in enumerate(variants(1, 0, 60, 8) + variants(2, 1, 30, 3) + variants(3, 2, 20, 14)
                                         + ["the same word again and again " * k for k in (3, 4, 5, 9, 10)] + ["a b c"] * 3)]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    block, m.BLOCK = m.BLOCK, 16
    try:
        result = m.near_duplicates(docs, Workspace(spark, "t")).collect()
        check(rows, result)
        kept = m.deduplicate(docs, Workspace(spark, "t")).collect()
    finally:
        m.BLOCK = block
    group = brute_groups(rows)
    first = {}
    for i, t in rows:
        first.setdefault(group[t], i)
    assert {r["doc_id"] for r in kept} == set(first.values()) and len(kept) == len(first)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    for overlap, weights in ((0.9, 1), (0.5, 4), (0.8, 9)):
        n = 300
        x = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64)
        a, b = x[:n], np.concatenate([x[:int(n * overlap)], x[n:n + n - int(n * overlap)]])
        aw, bw = rng.integers(1, weights + 1, n).astype(float), rng.integers(1, weights + 1, n).astype(float)
        sa, sb = np.argsort(a), np.argsort(b)
        a, aw, b, bw = a[sa], aw[sa], b[sb], bw[sb]
        s = m.probminhash(np.concatenate([a, b]), np.concatenate([aw, bw]), np.array([0, n, 2 * n]), 4096)
        want = jaccard(Counter(dict(zip(a.tolist(), aw))), Counter(dict(zip(b.tolist(), bw))))
        assert m.probability_jaccard(a, aw, b, bw) == pytest.approx(want)
        assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / 4096) ** 0.5 + 1e-9
    one = m.probminhash(np.array([7], np.uint64), np.ones(1), np.array([0, 0, 1]), 64)
    assert (one[0] == 0).all() and (one[1] == 7).all()


def test_forest_follows_the_strongest():
    agree = np.array([[0, 9, 0, 3], [9, 0, 8, 0], [0, 8, 0, 0], [3, 0, 0, 0]], np.uint8)
    assert sorted(tuple(sorted(e)) for e in m._strongest(agree.copy(), np.arange(4))) == [(0, 1), (0, 3), (1, 2)]
    assert m._strongest(agree.copy(), np.array([5, 5, 5, 5])) == []


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(rows, m.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), Workspace(spark, "t")).collect())
