import zlib

import pytest

from spillway.llm import sharding
from spillway.llm.common import Workspace
from spillway.llm.queries import op8_shards
from tests.llm.helpers import clashing, documents


def brute(rows, shards):
    """(doc_id, size, crc, shard, slot) of (doc_id, text) rows."""
    slim = sorted(((i is None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows))
    total, before, out, slots = sum(r[3] for r in slim), 0, [], {}
    for gone, i, crc, size in slim:
        shard = min((2 * before + size) * shards // (2 * total), shards - 1)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((None if gone else i, size, crc, shard, slots[shard]))
        before += size
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *(x or 0 for x in r)))


@pytest.mark.parametrize("shards", [1, 3, 40])
@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
def test_cases_equal_a_running_sum(spark, shards, wrap):
    docs = wrap(documents(spark))
    got = [tuple(r) for r in sharding.manifest(docs, shards, Workspace(spark, "t")).collect()]
    assert order(got) == order(brute([(r["doc_id"], r["text"]) for r in docs.collect()], shards))
    placed = sharding.shard_documents(docs, shards, Workspace(spark, "t"))
    assert placed.columns[:-1] == docs.columns
    assert placed.columns[-1] == ("_shard" if "shard" in docs.columns else "shard")
    name = placed.columns[-1]
    where = {}
    for r in placed.collect():
        where.setdefault((r["doc_id"], r["text"]), set()).add(r[name])
    assert all(len(s) == 1 for s in where.values()) and placed.count() == 12
    first = {(i, c): s for i, _, c, s, _ in reversed(brute([(r["doc_id"], r["text"]) for r in docs.collect()], shards))}
    assert {k: {first[(k[0], zlib.crc32((k[1] or "").encode()))]} for k in where} == where


def test_empty_table(spark):
    docs = documents(spark, [])
    assert sharding.manifest(docs, 5, Workspace(spark, "t")).count() == 0
    assert sharding.shard_documents(docs, 5, Workspace(spark, "t")).count() == 0


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = op8_shards(spark, sf).collect()
    want = brute([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 40)
    assert order([(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in rows]) == order(want)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
