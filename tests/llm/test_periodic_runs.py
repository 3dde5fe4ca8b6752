import hashlib
import re
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spillway.llm import periodic_runs as pr
from spillway.llm.queries import op12_periodic_runs
from tests.llm.helpers import CASES, clashing, documents, plain


def brute_runs(w, least=12):
    """Every period by itself: the longest stretches whose words q apart are identical; a stretch counts for its smallest q."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= 2 * q and not any(start >= a and end <= b and q % p == 0 for (a, b), p in found.items()):
                found[(start, end)] = min(q, found.get((start, end), q))
            i = j
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= least)


def brute_lyndon(w):
    n = len(w)
    return [next((j for j in range(i + 1, n) if w[j:] < w[i:]), n) - i for i in range(n)]


def rows(found):
    return [tuple(int(x) for x in r) for r in found]


SMALL = st.one_of(st.lists(st.integers(0, 1), max_size=60), st.lists(st.integers(0, 3), max_size=40),
                  st.lists(st.lists(st.integers(0, 2), max_size=5).flatmap(lambda u: st.integers(1, 4).map(lambda k: u * k)), max_size=8)
                  .map(lambda parts: [x for p in parts for x in p]))


@settings(max_examples=400, deadline=None)
@given(SMALL.filter(len))
def test_lyndon_lengths_by_definition(w):
    assert pr.lyndon_lengths(np.array(w)).tolist() == brute_lyndon(w)


@settings(max_examples=400, deadline=None)
@given(SMALL, st.sampled_from([2, 3, 5, 12]))
def test_runs_by_definition(w, least):
    assert rows(pr.runs_of(np.array(w, np.int64), least)) == brute_runs(w, least)


def test_structured_texts():
    thue = [bin(i).count("1") % 2 for i in range(512)]
    fib = [0]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    fib = b
    for w in (thue, fib, [7] * 300, list(range(50)) * 3 + [1], [1, 2] * 20 + [3] + [1, 2] * 20):
        assert rows(pr.runs_of(np.array(w), 4)) == brute_runs(w, 4)
        assert pr.lyndon_lengths(np.unique(w, return_inverse=True)[1]).tolist() == brute_lyndon(w)


def test_long_texts_take_little_time():
    rng = np.random.default_rng(1)
    long = 200_000
    begin = time.monotonic()
    assert rows(pr.runs_of(np.zeros(long, np.int64))) == [(0, long, 1)]
    once = np.arange(long // 2)
    assert rows(pr.runs_of(np.concatenate([once, once]))) == [(0, long, long // 2)]
    pr.runs_of(rng.integers(0, 2, long))
    pr.runs_of(np.array([bin(i).count("1") % 2 for i in range(long)]))
    assert time.monotonic() - begin < 60


def brute_document(doc_id, text):
    """The result row by definition, words and all."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute_runs([codes[w] for w in words])
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def ordered(found):
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_query_equals_definition(spark, scratch):
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [(i, " ".join(f"w{(i * j) % 23}" for j in range(10 + i % 90)), "en", "s", 0) for i in range(60)]
    texts += [(i, " one  two\tthree\x1ffour\r\nfive six seven eight nine ten " * (1 + i % 3), "fr", "t", 0) for i in planted]
    given_rows = [r for r in CASES if not r[1] or len(r[1]) < 10_000] + texts
    documents(spark, given_rows).write.parquet(f"{scratch}/documents.parquet")
    got = op12_periodic_runs(spark, scratch).select(*COLUMNS).collect()
    assert ordered(map(tuple, got)) == ordered(brute_document(r[0], r[1]) for r in given_rows)


def test_given_documents_equal_definition(spark):
    sf = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 4000").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in op12_periodic_runs(spark, sf).collect()}
    for r in texts:
        assert got[r["doc_id"]] == brute_document(r["doc_id"], r["text"])


def test_odd_cases(spark):
    found = pr.find_runs(documents(spark))
    assert found.count() == len(CASES)
    assert plain(pr.find_runs(clashing(documents(spark)))) == plain(found)
    assert pr.find_runs(documents(spark, [])).count() == 0
    empty = found.where("doc_id = 3").first()
    assert (empty["n_words"], empty["runs"], empty["collapsed"]) == (0, [], "")
