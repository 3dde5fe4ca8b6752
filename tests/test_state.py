"""Folds of the state tables."""

import pytest
from pyspark.sql import functions as F

from spillway.sinks.file_log import write_table_batch
from spillway.streaming import fs, state

GROUP = "t_g"


def _batch(spark, root, b, partitions=3):
    audit = spark.sql(f"""select 'r' as run_id, 't' as topic, cast(id as int) as partition, 'consumer' as client_type, 5L as n, 0L as rejected,
        {b}L * 5 as from_offset, {b + 1}L * 5 as until_offset, timestamp_seconds({b}) as at, 1L as bytes, 2L as took_ms from range({partitions})""")
    commits = spark.sql(f"select 't' as topic, cast(id as int) as partition, {b + 1}L * 5 as next_offset, timestamp_seconds({b}) as at from range({partitions})")
    write_table_batch(audit, f"{root}/audit", GROUP, 0, b)
    write_table_batch(commits, f"{root}/commits", GROUP, 0, b)


def _files(spark, root):
    return len(spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/audit-folded").inputFiles())


def _sums(spark, root):
    a = state.read_table(spark, root, "audit", GROUP)
    c = state.read_table(spark, root, "commits", GROUP)
    return (a.agg(F.sum("n")).first()[0], a.select("batch_id", "partition").distinct().count(), c.groupBy("partition").agg(F.max("next_offset").alias("x")).agg(F.min("x")).first()[0])


def test_folds_hold_each_row_once(spark, scratch, monkeypatch):
    monkeypatch.setattr(state, "FAN_IN", 3)
    for b in range(8):
        _batch(spark, scratch, b)
        assert state.fold(spark, scratch, GROUP, 0) == (b if b % 2 else None)  # two at a time
        assert _sums(spark, scratch) == (15 * (b + 1), 3 * (b + 1), 5 * (b + 1))
    raw = spark.read.schema(state.AUDIT).option("recursiveFileLookup", "true").parquet(f"{scratch}/audit-folded")
    assert raw.count() == 24  # no row twice: the three small folds went when they became one
    assert [(f[0], f[1], f[2]) for f in state._folds(spark, scratch, "audit", GROUP, 0)] == [(0, 5, 1), (6, 7, 0)]
    assert _files(spark, scratch) == 2 and fs.child_values(spark, f"{scratch}/audit/group={GROUP}/generation=0", "batch_id") == []


@pytest.mark.parametrize("step", ["before the second table", "before the folders are deleted"])
def test_a_crash_in_a_fold_shows_nothing_twice(spark, scratch, monkeypatch, step):
    for b in range(3):
        _batch(spark, scratch, b)
    want, calls = _sums(spark, scratch), []

    def crash(*args, **kw):
        calls.append(1)
        raise RuntimeError("crash")
    with monkeypatch.context() as m:
        if step == "before the second table":
            written = state._write_fold
            m.setattr(state, "_write_fold", lambda *a: crash() if a[2] == "commits" else written(*a))
        else:
            m.setattr(state.fs, "delete", crash)
        with pytest.raises(RuntimeError):
            state.fold(spark, scratch, GROUP, 0)
    assert calls and _sums(spark, scratch) == want
    _batch(spark, scratch, 3)
    assert state.fold(spark, scratch, GROUP, 0) == 3
    assert _sums(spark, scratch) == (60, 12, 20)
    _batch(spark, scratch, 2)  # a folded batch that is replayed adds nothing
    assert _sums(spark, scratch) == (60, 12, 20)
