import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from spillway.llm import language_model as lm
from spillway.llm.common import Workspace
from spillway.llm.queries import op4_kneser_ney
from tests.llm.helpers import clashing, documents


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


class Brute:
    """Interpolated modified Kneser-Ney by its definition, in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.unigrams = Counter(w for t in texts for w in words(t))
        self.total = sum(self.unigrams.values())
        self.counts = {n: Counter() for n in range(1, order + 1)}
        for t in texts:
            s = ["<s>", *words(t)]
            for i in range(1, len(s)):
                n = min(order, i + 1)
                self.counts[n][tuple(s[i - n + 1:i + 1])] += 1
        for n in range(order, 1, -1):
            for gram in self.counts[n]:
                self.counts[n - 1][gram[1:]] += 1
        self.d, self.context = {}, {}
        for n, grams in self.counts.items():
            self.d[n] = lm.discounts(Counter(min(c, 5) for c in grams.values()))
            stats = defaultdict(lambda: [0, 0.0])
            for gram, c in grams.items():
                stats[gram[:-1]][0] += c
                stats[gram[:-1]][1] += self.d[n][min(c, 3) - 1]
            self.context[n] = stats

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(self.unigrams) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.context[n]:
            return lower
        total, held = self.context[n][gram[:-1]]
        c = self.counts[n].get(gram, 0)
        return max(c - self.d[n][min(c, 3) - 1], 0) / total * (c > 0) + held / total * lower

    def score(self, text):
        s = ["<s>", *words(text)]
        return sum(math.log10(self.p(tuple(s[max(0, i - self.order + 1):i + 1]))) for i in range(1, len(s)))

    def row(self, text):
        w = words(text)
        base = sum(math.log10((self.unigrams[x] + 0.5) / (self.total + 0.5 * (len(self.unigrams) + 1))) for x in w)
        return len(w), sum(self.unigrams[x] > 0 for x in w), self.total, base, self.score(text)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def compare(docs, got, order):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    brute = Brute([t for i, t in rows if not held(i)], order)
    found = defaultdict(list)
    for r in got.collect():
        found[r["doc_id"]].append(r)
    assert sum(map(len, found.values())) == len(rows)
    for i, t in rows:
        want = brute.row(t)
        r = min(found[i], key=lambda r: (r["n_tokens"] != want[0], abs(r["score"] - want[4])))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), *want[:3])
        assert r["base_score"] == pytest.approx(want[3], rel=1e-9) and r["score"] == pytest.approx(want[4], rel=1e-9)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_given_documents_equal_the_definition(spark, order, monkeypatch):
    monkeypatch.setattr(lm, "PART_BYTES", 1 << 16)     # many files
    monkeypatch.setattr(lm, "HOT_SHARE", 1 << 10)      # contexts spread over files
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    compare(docs, lm.score_documents(docs, Workspace(spark, "t"), order), order)


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_cases(spark, wrap):
    docs = wrap(documents(spark))
    compare(docs, lm.score_documents(docs, Workspace(spark, "t")), 2)
    assert lm.score_documents(docs.limit(0), Workspace(spark, "t")).count() == 0


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(99) if held(i))
    r = lm.score_documents(documents(spark, [(only, "a b", "en", "s", 3)]), Workspace(spark, "t")).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) == (True, 3, 0, 0, 0.0)


def test_probabilities_sum_to_one():
    brute = Brute(["a b a b c", "a b d", "b c"], 3)
    for context in ([], ["a"], ["<s>"], ["a", "b"], ["x", "b"]):
        seen = sum(brute.p((*context, w)) for w in brute.unigrams)
        assert seen + brute.p((*context, "never")) == pytest.approx(1)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in op4_kneser_ney(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_shuffle_records_are_small_and_exact(width):
    """n-grams seen once take no bytes for their counts; what comes out is what went in."""
    rng = np.random.default_rng(width)
    ids = np.unique(rng.integers(0, 2**32, (5000, width), np.uint32), axis=0)
    counts = np.where(np.arange(len(ids)) % 10 == 0, 3 + np.arange(len(ids)), 1).astype(np.uint64)
    counts[0] = 2**32 - 1
    parts = (ids[:, -1] % 3).astype(np.int32)
    batch = lm._blobs(ids, counts, parts, width)
    few = int((counts > 1).sum())
    assert sum(len(b) for c in ("keys", "counts") for b in batch.column(batch.schema.get_field_index(c)).to_pylist()) == ids.nbytes + 4 * few
    want = {(p, *i): c for p, i, c in zip(parts.tolist(), ids.tolist(), counts.tolist())}
    got = {(p, *i): c for p, k, n in lm._gathered([batch.select(["part", "keys", "counts"])], width) for i, c in zip(k.tolist(), n.tolist())}
    assert got == want


def test_counts_above_32_bits_stay_whole(tmp_path):
    few, many = np.array([1, 7, 2**32 - 1], np.uint64), np.array([1, 2**32, 2**40 + 3], np.uint64)
    model = lm.Model(f"file://{tmp_path}", 2, words=[3])
    for part, counts in enumerate((few, many)):
        lm.put(f"{model.root}/gram2-key-{part}", np.array([10, 20, 30], np.uint64))
        lm.put(f"{model.root}/gram2-count-{part}", lm.short_counts(counts))
    assert lm.short_counts(few).itemsize == 4 and lm.short_counts(many).itemsize == 8
    known = lm.Arrays(model)
    keys = np.array([10, 20, 30, 40], np.uint64)
    for part, counts in enumerate((few, many)):
        there, got = known.find("gram2", np.full(4, part, np.int32), keys, [("count", None)])
        assert there.tolist() == [True, True, True, False]
        assert got.tolist() == [*map(float, counts), 0.0]


def test_too_many_words_or_too_large_a_blob_raise(spark, monkeypatch):
    monkeypatch.setattr(lm, "MOST_WORDS", 2)
    texts = spark.createDataFrame([("one two three",)], "text string")
    with pytest.raises(OverflowError):
        lm.train(texts, Workspace(spark, "t"))
    with pytest.raises(OverflowError):
        lm._blobs(np.array([[1, 2]], np.uint32), np.array([2**32], np.uint64), np.array([0]), 2)


def test_mapped_files_are_bounded(tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "MAPPED", 4)
    model = lm.Model(f"file://{tmp_path}", 2, words=[1] * 12, vocabulary_parts=12)
    for p in range(12):
        lm.put(f"{model.root}/word-key-{p}", np.array([p], np.uint64))
    known = lm.Arrays(model)
    for _ in range(3):
        for p in range(12):
            assert known.file("word-key", p, np.uint64).tolist() == [p]
            assert len(known._files) <= 4
