"""The manifest of a file log, streams of offset ranges, and folds under a reader."""

import pytest
from pyspark.sql import functions as F

from helpers import log_rows, make_log
from spillway.options import TransferOptions
from spillway.sinks.file_log import write_log_batch
from spillway.sources.manifest import ManifestLog
from spillway.sources.topic_log import read_file_log
from spillway.streaming import fs
from spillway.streaming.transfer import Transfer, run_transfer


def _append(spark, root, b, rows, group="producer"):
    write_log_batch(make_log(spark, rows).coalesce(1), root, group, 0, b, "snappy")


def _opts(scratch, **kw):
    return TransferOptions(**(dict(topic="t", source=f"{scratch}/src", destination=f"{scratch}/dst", state_path=f"{scratch}/state",
                                   destination_partitions=3, start_at="earliest", offset_ranges=True) | kw))


def _payloads(df):
    return sorted((bytes(r.key), bytes(r.value)) for r in df.select("key", "value").collect())


def _exact(df):
    return sorted((r.partition, r.offset, bytes(r.key), bytes(r.value)) for r in df.collect())


def test_refresh_reads_each_batch_once_whatever_the_order(spark, scratch):
    log = ManifestLog(spark, scratch, "t", f"{scratch}/elsewhere")
    _append(spark, scratch, 1, log_rows("t", 0, 10, 5), "late writer")
    assert log.refresh().newest == {0: 15}
    _append(spark, scratch, 0, log_rows("t", 1, 0, 4))
    assert log.refresh().newest == {0: 15, 1: 4}
    _append(spark, scratch, 0, log_rows("t", 0, 0, 10), "late writer")  # an older batch that appears later
    now = log.refresh()
    assert now.newest == {0: 15, 1: 4} and len(now.segments) == 3
    assert log.refresh() == now  # nothing new: no version
    got = log.read_ranges([(0, 8, 12), (1, 3, 9), (2, 0, 5)])
    assert sorted((r.partition, r.offset) for r in got.collect()) == [(0, 8), (0, 9), (0, 10), (0, 11), (1, 3)]
    assert log.read_ranges([]).count() == 0


def test_only_folders_with_the_range_are_read(spark, scratch):
    log = ManifestLog(spark, scratch, "t")
    for b in range(6):
        _append(spark, scratch, b, log_rows("t", 0, b * 10, 10))
    log.refresh()
    got = log.read_ranges([(0, 25, 38)])
    assert {f.split("batch_id=")[1].split("/")[0] for f in got.inputFiles()} == {"2", "3"}
    plan = got._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "GreaterThanOrEqual(offset,25)" in plan and "LessThan(offset,38)" in plan


def test_read_limit_counts_records(spark, scratch):
    rows = log_rows("t", 0, 0, 50) + log_rows("t", 1, 0, 20) + log_rows("t", 2, 0, 3)
    _append(spark, f"{scratch}/src", 0, rows)
    t = run_transfer(spark, _opts(scratch, read_limit=16))
    sizes = [r.n for r in t.audit().where("client_type = 'consumer'").groupBy("batch_id").agg(F.sum("n").alias("n")).orderBy("batch_id").collect()]
    assert sizes == [16, 16, 16, 16, 9]
    assert _payloads(read_file_log(spark, f"{scratch}/dst", "t")) == sorted((k, v) for _, _, _, k, v, _ in rows)


def test_start_at_newest_and_restart(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 10))
    run_transfer(spark, _opts(scratch, start_at="latest"))
    assert not fs.exists(spark, f"{scratch}/dst")
    new = log_rows("t", 0, 10, 5) + log_rows("t", 4, 0, 3)
    _append(spark, f"{scratch}/src", 1, new)
    t = run_transfer(spark, _opts(scratch, start_at="latest"))
    assert _payloads(read_file_log(spark, f"{scratch}/dst", "t")) == sorted((k, v) for _, _, _, k, v, _ in new)
    assert {r.partition: r.n for r in t.commits().groupBy("partition").agg(F.max("next_offset").alias("n")).collect()} == {0: 15, 4: 3}


def test_killed_batch_asks_for_the_same_offsets(spark, scratch):
    rows = log_rows("t", 0, 0, 20) + log_rows("t", 1, 0, 10)
    _append(spark, f"{scratch}/src", 0, rows[:25])

    class Killed(Transfer):
        def _after_sink(self, batch_id):
            if batch_id == 1:
                raise RuntimeError("killed")
    t = Killed(spark, _opts(scratch, read_limit=10))
    t.start("available_now")
    with pytest.raises(Exception, match="killed"):
        t.finish()
    before = _exact(read_file_log(spark, f"{scratch}/dst", "t"))
    _append(spark, f"{scratch}/src", 1, rows[25:])
    run_transfer(spark, _opts(scratch, read_limit=10))
    after = read_file_log(spark, f"{scratch}/dst", "t")
    assert set(before) <= set(_exact(after)) and len(before) == 20
    assert _payloads(after) == sorted((k, v) for _, _, _, k, v, _ in rows)


def test_a_running_copy_sees_new_batches(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 4))
    t = Transfer(spark, _opts(scratch, flush_interval_ms=300))
    t.start()
    t.query.processAllAvailable()
    _append(spark, f"{scratch}/src", 1, log_rows("t", 0, 4, 3))
    t.finish(timeout=12)
    t.stop()
    assert read_file_log(spark, f"{scratch}/dst", "t").count() == 7


def test_chained_copy_across_folds_equals_the_source(spark, scratch):
    rows = log_rows("t", 0, 0, 40) + log_rows("t", 1, 0, 20)
    first = _opts(scratch, read_limit=4, keep_manifest=True, fold_batches=3)
    hop = _opts(scratch, source=f"{scratch}/dst", destination=f"{scratch}/dst2", group_suffix="hop", state_path=f"{scratch}/state2", read_limit=7)
    for b in range(3):
        _append(spark, f"{scratch}/src", b, rows[b * 20:(b + 1) * 20])
        run_transfer(spark, first)
        run_transfer(spark, hop)  # reads between folds, and records that were folded before it came
        log = read_file_log(spark, f"{scratch}/dst", "t")
        assert _payloads(log) == sorted((k, v) for _, _, _, k, v, _ in rows[:(b + 1) * 20])
    assert _payloads(read_file_log(spark, f"{scratch}/dst2", "t")) == sorted((k, v) for _, _, _, k, v, _ in rows)
    now = ManifestLog(spark, f"{scratch}/dst", "t").load()
    assert max(s.level for s in now.segments) >= 2 and len(now.segments) < 7
    live = fs.child_values(spark, f"{scratch}/dst/topic=t/group=t_spillway/generation=0", "batch_id")
    assert len(live) <= 6  # of 15 batches; the last fold's stay until the next one


def test_batch_reads_agree_before_and_after_a_fold(spark, scratch):
    for b in range(4):
        _append(spark, scratch, b, log_rows("t", 0, b * 5, 5) + log_rows("u", 0, b, 1))
    log = ManifestLog(spark, scratch, "t")
    before = _exact(read_file_log(spark, scratch, "t"))
    now = log.fold(4)
    assert [s.level for s in now.segments] == [1] and now.segments[0].covers == (("producer", 0, 0, 3),)
    assert _exact(read_file_log(spark, scratch, "t")) == before
    assert read_file_log(spark, scratch, "u").count() == 4
    assert _exact(log.read_ranges([(0, 0, 100)])) == before
    assert log.refresh() == now  # folders that a fold replaced are no new batches
