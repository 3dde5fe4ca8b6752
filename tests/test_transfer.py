"""Delivery properties of the streaming copy."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import log_rows, make_log
from spillway.operators import records
from spillway.operators.budget import BudgetExceeded
from spillway.options import TransferOptions
from spillway.plans.copy import plan_copy_batch
from spillway.sinks.file_log import write_log_batch
from spillway.sources.topic_log import read_file_log
from spillway.streaming.metric_sink import read_points
from spillway.streaming.transfer import Transfer, run_transfer


def _append(spark, root, batch_id, rows):
    """One more file in the source log (as a producer's batch would be)."""
    write_log_batch(make_log(spark, rows).coalesce(1), root, "producer", 0, batch_id, "snappy")


def _rows(partition, start, n, topic="t", value=None):
    return log_rows(topic, partition, start, n, value=value or (lambda o: f"v{o}".encode()))


def _opts(scratch, **kw):
    base = dict(topic="t", source=f"{scratch}/src", destination=f"{scratch}/dst", state_path=f"{scratch}/state",
                destination_partitions=4)
    base.update(kw)
    return TransferOptions(**base)


def _sent(spark, scratch):
    return read_file_log(spark, f"{scratch}/dst", "t")


def _multiset(df):
    return sorted((r.topic, bytes(r.key), bytes(r.value)) for r in df.select("topic", "key", "value").collect())


def _expected(spark, rows):
    return _multiset(records.null_to_empty(records.record_projection(make_log(spark, rows))))


def test_drain_from_earliest_copies_everything_once(spark, scratch):
    rows = _rows(0, 0, 30) + _rows(1, 0, 20)
    _append(spark, f"{scratch}/src", 0, rows[:25])
    _append(spark, f"{scratch}/src", 1, rows[25:])
    t = run_transfer(spark, _opts(scratch, start_at="earliest", read_limit=1))
    assert len(t.batches) == 2
    out = _sent(spark, scratch)
    assert _multiset(out) == _expected(spark, rows)
    # destination offsets: unique and increasing per destination partition
    per = out.groupBy("partition").agg(F.count("*").alias("n"), F.countDistinct("offset").alias("d")).collect()
    assert all(r.n == r.d for r in per)
    # commits after the sink: the last position of every source partition
    last = {r.partition: r.next_offset for r in
            t.commits().groupBy("partition").agg(F.max("next_offset").alias("next_offset")).collect()}
    assert last == {0: 30, 1: 20}
    audit = t.audit()
    assert audit.where("client_type = 'consumer'").agg(F.sum("n")).first()[0] == 50
    assert audit.where("client_type = 'producer'").agg(F.sum("n")).first()[0] == 50


def test_latest_start_skips_the_backlog_then_copies_new_records(spark, scratch):
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 10))
    t = run_transfer(spark, _opts(scratch))  # start at newest: nothing to send
    assert not os.path.exists(f"{scratch}/dst")  # nothing at or after the start: nothing written
    seeds = t.commits().where("batch_id = -1").collect()
    assert [(r.partition, r.next_offset) for r in seeds] == [(0, 10)]
    new = _rows(0, 10, 5) + _rows(2, 0, 3)  # a partition that appeared later starts at 0
    _append(spark, f"{scratch}/src", 1, new)
    run_transfer(spark, _opts(scratch))
    assert _multiset(_sent(spark, scratch)) == _expected(spark, new)


def _killed_at(batch):
    class Killed(Transfer):
        def _after_sink(self, batch_id):
            if batch_id == batch:
                raise RuntimeError("killed between sink and commit")
    return Killed


def _exact(df):
    return sorted((r.partition, r.offset, bytes(r.key), bytes(r.value)) for r in df.collect())


@pytest.mark.parametrize("batch", [0, 1])
def test_kill_after_sink_then_restart_changes_nothing_that_was_sent(spark, scratch, batch):
    """Also for a reader of the destination that looked in between."""
    rows = _rows(0, 0, 12) + _rows(1, 0, 12)
    for b in range(3):
        _append(spark, f"{scratch}/src", b, rows[b * 8:(b + 1) * 8])
    t = _killed_at(batch)(spark, _opts(scratch, start_at="earliest", read_limit=1))
    t.start("available_now")
    with pytest.raises(StreamingQueryException):
        t.finish()
    before = _exact(_sent(spark, scratch))
    assert len(before) == 8 * (batch + 1)
    hop = TransferOptions(topic="t", source=f"{scratch}/dst", destination=f"{scratch}/dst2", state_path=f"{scratch}/state2",
                          destination_partitions=4, start_at="earliest", group_suffix="hop")
    run_transfer(spark, hop)
    t2 = run_transfer(spark, _opts(scratch, start_at="earliest", read_limit=1))
    assert t2.batches[0] == batch  # the unfinished batch is replayed under its own id
    after = _exact(_sent(spark, scratch))
    assert set(before) <= set(after) and len(after) == 24
    assert _multiset(_sent(spark, scratch)) == _expected(spark, rows)
    run_transfer(spark, hop)
    assert _multiset(read_file_log(spark, f"{scratch}/dst2", "t")) == _expected(spark, rows)
    assert t2.audit().groupBy("client_type").agg(F.sum("n").alias("n")).where("n <> 24").count() == 0


def test_first_batch_with_records_is_replay_safe_after_empty_ones(spark, scratch):
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 6))
    o = _opts(scratch)
    run_transfer(spark, o)                                    # newest: a batch without records
    _append(spark, f"{scratch}/src", 1, _rows(0, 6, 6))
    t = Transfer(spark, o)
    t._after_sink = lambda batch_id: 1 / 0
    t.start("available_now")
    with pytest.raises(StreamingQueryException):
        t.finish()
    before = _exact(_sent(spark, scratch))
    run_transfer(spark, o)
    assert _exact(_sent(spark, scratch)) == before and len(before) == 6


def test_every_start_is_seeded_from_one_record(spark, scratch):
    """A crash right after the record: the restart seeds from it, and lag tells the truth."""
    from spillway.plans.monitoring import copy_lag
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 10) + _rows(1, 0, 4))
    for start_at, lag in (("latest", {0: 3, 1: 0}), ("earliest", {0: 13, 1: 4})):
        o = _opts(scratch, start_at=start_at, state_path=f"{scratch}/{start_at}")
        t = Transfer(spark, o)
        t._seed = lambda starts: (_ for _ in ()).throw(RuntimeError("crash"))
        with pytest.raises(RuntimeError):
            t._freeze_start()
        _append(spark, f"{scratch}/src", 1, _rows(0, 10, 3))
        again = Transfer(spark, o)
        again._freeze_start()
        assert again.generation == 0
        assert {r.partition: r.lag for r in copy_lag(spark, o).collect()} == lag
        run_transfer(spark, o)
        assert {r.lag for r in copy_lag(spark, o).collect()} == {0}


def test_kafka_positions_are_seeded_from_the_checkpoint(spark, scratch):
    import os
    t = Transfer(spark, _opts(scratch, source="broker:9092", source_format="kafka"))
    t.seed_from_checkpoint()  # nothing known yet
    os.makedirs(f"{t.checkpoint}/sources/0")
    with open(f"{t.checkpoint}/sources/0/0", "w") as f:
        f.write('v1\n{"t":{"0":400,"1":7}}')
    t.seed_from_checkpoint()
    assert {(r.partition, r.next_offset, r.batch_id) for r in t.commits().collect()} == {(0, 400, -1), (1, 7, -1)}


def test_reset_skips_the_gap_and_keeps_the_old_generation(spark, scratch):
    src = f"{scratch}/src"
    _append(spark, src, 0, _rows(0, 0, 5))
    run_transfer(spark, _opts(scratch))                   # generation 0 starts at 5
    a = _rows(0, 5, 3)
    _append(spark, src, 1, a)
    run_transfer(spark, _opts(scratch))                   # copies a
    gap = _rows(0, 8, 4)
    _append(spark, src, 2, gap)
    t = run_transfer(spark, _opts(scratch, reset=True))   # generation 1 starts at 12: gap skipped
    assert t.generation == 1
    c = _rows(0, 12, 2)
    _append(spark, src, 3, c)
    run_transfer(spark, _opts(scratch))                   # generation 1 resumes
    assert _multiset(_sent(spark, scratch)) == _expected(spark, a + c)
    dst = read_file_log(spark, f"{scratch}/dst", "t", keep_layout=True)
    assert {r.generation for r in dst.select("generation").distinct().collect()} == {0, 1}
    gens = {r.generation: r.m for r in t.commits().groupBy("generation").agg(F.max("next_offset").alias("m")).collect()}
    assert gens == {0: 8, 1: 14}


def test_budget_trips_at_max_plus_one_and_restart_goes_on(spark, scratch):
    bad = lambda o: b"x" * 20  # noqa: E731 - rejected by the predicate
    good = lambda o: b"ok"
    src = f"{scratch}/src"
    _append(spark, src, 0, _rows(0, 0, 3, value=bad))     # 3 rejects: total 3 <= 3
    _append(spark, src, 1, _rows(0, 3, 1, value=bad))     # 4 > 3: this batch finishes and commits
    _append(spark, src, 2, _rows(0, 4, 2, value=good))    # the next batch refuses to start
    o = _opts(scratch, start_at="earliest", read_limit=1, reject_when="length(value) > 8", max_errors=3)
    t = Transfer(spark, o)
    t.start("available_now")
    with pytest.raises(BudgetExceeded, match="max_errors=3"):
        t.finish()
    assert t.batches == [0, 1] and t.rejected_total == 4
    assert t.quarantined().count() == 4
    t2 = run_transfer(spark, o)  # new run, fresh budget, continues behind the rejected records
    assert t2.batches == [2]
    assert _multiset(_sent(spark, scratch)) == _expected(spark, _rows(0, 4, 2, value=good))


def test_budget_not_tripped_at_exactly_max(spark, scratch):
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 3, value=lambda o: b"x" * 20))
    t = run_transfer(spark, _opts(scratch, start_at="earliest", reject_when="length(value) > 8", max_errors=3))
    assert t.rejected_total == 3


def test_stream_equals_batch(spark, scratch):
    rows = _rows(0, 0, 40) + _rows(1, 0, 25) + _rows(2, 0, 7)
    for b in range(4):
        _append(spark, f"{scratch}/src", b, rows[b * 18:(b + 1) * 18])
    run_transfer(spark, _opts(scratch, start_at="earliest", read_limit=1))
    batch = plan_copy_batch(make_log(spark, rows), 4).records
    cols = ("topic", "partition", "key", "value")
    norm = lambda df: sorted(tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r)
                             for r in df.select(*cols).collect())
    assert norm(_sent(spark, scratch)) == norm(batch)


def test_metric_points_are_written_per_batch(spark, scratch):
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 9))
    run_transfer(spark, _opts(scratch, start_at="earliest", metrics_path=f"{scratch}/metrics", host="h"))
    pts = read_points(spark, f"{scratch}/metrics").where("measurement = 'rps_stats'")
    by_type = {r.ct: r.s for r in pts.select(F.col("tags")["clientType"].alias("ct"),
                                             F.col("fields")["rps"].alias("v"))
               .groupBy("ct").agg(F.sum("v").alias("s")).collect()}
    assert by_type == {"consumer": 9, "producer": 9}


def test_preserve_nulls_keeps_tombstones(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 3, key=lambda o: None, value=lambda o: None))
    run_transfer(spark, _opts(scratch, start_at="earliest", preserve_nulls=True))
    out = _sent(spark, scratch).collect()
    assert len(out) == 3 and all(r.value is None and r.key is None for r in out)


def test_frozen_start_is_not_recomputed_after_a_crash(spark, scratch):
    """A crash after the start snapshot is frozen and before any batch: records
    that arrive meanwhile must still be copied on restart."""
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 6))
    t = Transfer(spark, _opts(scratch))
    t._freeze_start()  # the process dies here
    new = _rows(0, 6, 4)
    _append(spark, f"{scratch}/src", 1, new)
    run_transfer(spark, _opts(scratch))
    assert _multiset(_sent(spark, scratch)) == _expected(spark, new)


def test_interval_trigger_runs_until_stopped(spark, scratch):
    """A copy on the flush-interval trigger keeps running; stop() ends it."""
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 5))
    t = Transfer(spark, _opts(scratch, start_at="earliest", flush_interval_ms=200))
    q = t.start()
    q.processAllAvailable()
    more = _rows(0, 5, 5)
    _append(spark, f"{scratch}/src", 1, more)
    q.processAllAvailable()
    assert q.isActive
    t.stop()
    assert not q.isActive
    assert _multiset(_sent(spark, scratch)) == _expected(spark, _rows(0, 0, 10))


def test_bounded_copy_writes_records_audit_commits_and_quarantine(spark, scratch):
    from spillway.functions import group_name
    from spillway.plans.copy import copy_bounded
    rows = _rows(0, 0, 12, topic="a", value=lambda o: b"x" * (o % 12)) + _rows(1, 0, 5, topic="b")
    end = copy_bounded(make_log(spark, rows), 4, f"{scratch}/dst", f"{scratch}/state", group_name("topic", "s"),
                       reject_when="length(value) > 8")
    assert end == {"a": 3, "b": 2}  # ceil(12 / 4) and ceil(5 / 4) slots per destination partition
    sent = read_file_log(spark, f"{scratch}/dst")
    assert sent.count() == 17 - 3  # values of length 9, 10, 11 are rejected
    audit = spark.read.parquet(f"{scratch}/state/audit")
    got = {(r.group, r.client_type): (r.n, r.r) for r in
           audit.groupBy("group", "client_type").agg(F.sum("n").alias("n"), F.sum("rejected").alias("r")).collect()}
    assert got == {("a_s", "consumer"): (12, 3), ("a_s", "producer"): (9, 0),
                   ("b_s", "consumer"): (5, 0), ("b_s", "producer"): (5, 0)}
    commits = {(r.group, r.partition): r.next_offset for r in spark.read.parquet(f"{scratch}/state/commits").collect()}
    assert commits == {("a_s", 0): 12, ("b_s", 1): 5}
    assert spark.read.parquet(f"{scratch}/state/quarantine").count() == 3


def test_copy_started_before_the_topic_has_records(spark, scratch):
    """A new topic starts at offset 0: everything written after the copy starts
    is copied."""
    t = run_transfer(spark, _opts(scratch))
    assert t.batches == []
    rows = _rows(0, 0, 7) + _rows(3, 0, 2)
    _append(spark, f"{scratch}/src", 0, rows)
    run_transfer(spark, _opts(scratch))
    assert _multiset(_sent(spark, scratch)) == _expected(spark, rows)


def test_a_destination_log_is_a_valid_source(spark, scratch):
    """Chained copies A -> B -> C: the destination's layout and offsets make it
    a topic log another copy can read."""
    rows = _rows(0, 0, 20) + _rows(1, 0, 13) + _rows(2, 0, 4)
    _append(spark, f"{scratch}/src", 0, rows)
    run_transfer(spark, _opts(scratch, start_at="earliest"))
    hop = TransferOptions(topic="t", source=f"{scratch}/dst", destination=f"{scratch}/dst2",
                          state_path=f"{scratch}/state2", destination_partitions=3, start_at="earliest",
                          group_suffix="hop")
    run_transfer(spark, hop)
    assert _multiset(read_file_log(spark, f"{scratch}/dst2", "t")) == _expected(spark, rows)
    b = read_file_log(spark, f"{scratch}/dst", "t")
    assert b.select("partition", "offset").distinct().count() == b.count()


def test_kafka_destination_branch(spark, scratch, monkeypatch):
    """The Kafka sink itself needs the connector; everything around it is
    exercised by capturing what would be handed to it."""
    import spillway.streaming.transfer as tr
    captured = f"{scratch}/captured"

    def fake_kafka_write(records, opts):
        assert records.columns == ["topic", "partition", "offset", "key", "value", "timestamp"]
        records.select("topic", "partition", "key", "value").write.mode("append").parquet(captured)

    monkeypatch.setattr(tr, "write_kafka_batch", fake_kafka_write)
    rows = _rows(0, 0, 9) + _rows(1, 0, 4)
    _append(spark, f"{scratch}/src", 0, rows)
    t = run_transfer(spark, _opts(scratch, start_at="earliest", destination="broker:9092",
                                  destination_format="kafka"))
    assert _multiset(spark.read.parquet(captured)) == _expected(spark, rows)
    prod = t.audit().where("client_type = 'producer'").collect()
    assert sum(r.n for r in prod) == 13 and all(r.from_offset is None and r.until_offset is None for r in prod)


def test_kafka_source_branch(spark, scratch, monkeypatch):
    """With a Kafka source the start is the connector's `startingOffsets`: no
    snapshot is frozen and no scan predicate is added.  The stream is replaced
    by a file-log stream of the same rows (the connector is not installed)."""
    import spillway.streaming.transfer as tr
    rows = _rows(0, 0, 6) + _rows(1, 0, 3)
    _append(spark, f"{scratch}/src", 0, rows)

    def fake_source(spark_, opts, stream=False):
        assert opts.source_format == "kafka" and stream
        return read_file_log(spark_, f"{scratch}/src", opts.topic, stream=True)

    monkeypatch.setattr(tr, "topic_source", fake_source)
    t = tr.Transfer(spark, _opts(scratch, source="broker:9092", source_format="kafka"))
    t.start("available_now")
    t.finish()
    assert t._start is None and t._scan_filter is None
    assert spark.read.parquet(f"{scratch}/state/generations").where("partition >= 0").count() == 0
    assert _multiset(_sent(spark, scratch)) == _expected(spark, rows)


def test_request_stop_ends_a_running_copy(spark, scratch):
    import threading
    _append(spark, f"{scratch}/src", 0, _rows(0, 0, 5))
    t = Transfer(spark, _opts(scratch, start_at="earliest", flush_interval_ms=200))
    t.start()
    t.query.processAllAvailable()
    threading.Timer(1.0, t.request_stop).start()  # as a signal handler would
    t.finish()
    assert not t.query.isActive
    assert _sent(spark, scratch).count() == 5


def test_folded_batches_read_the_same_and_the_copy_goes_on(spark, scratch):
    from spillway.plans.monitoring import copy_lag
    from spillway.streaming import fs
    from spillway.streaming.state import fold, read_table

    def totals(t):
        rows = t.audit().groupBy("client_type").agg(F.sum("n").alias("n"), F.max("until_offset").alias("u")).collect()
        return sorted((r.client_type, r.n, r.u) for r in rows), \
            {r.partition: r.lag for r in copy_lag(spark, t.opts).collect()}

    rows = _rows(0, 0, 12) + _rows(1, 0, 12)
    for b in range(4):
        _append(spark, f"{scratch}/src", b, rows[b * 6:(b + 1) * 6])
    o = _opts(scratch, start_at="earliest", read_limit=1)
    t = run_transfer(spark, o)
    before = totals(t)
    assert fold(spark, t.root, t.group, 0, least=100) is None
    assert fold(spark, t.root, t.group, 0) == 3 and totals(t) == before
    assert fs.child_values(spark, t.folder(f"{scratch}/state/audit", 0).rsplit("/", 1)[0], "batch_id") == []
    # A folded batch that comes back (replayed, or left by a crash before the delete) adds nothing.
    t._write_table("audit", t.audit().drop("group", "generation", "batch_id"), 3)
    assert totals(t) == before
    more = _rows(0, 12, 5)
    for b in range(3):
        _append(spark, f"{scratch}/src", 4 + b, more[b:b + 1] if b < 2 else more[2:])
    again = run_transfer(spark, _opts(scratch, start_at="earliest", read_limit=1, fold_batches=2))
    assert again.batches == [4, 5, 6]
    sent = _sent(spark, scratch)
    assert _multiset(sent) == _expected(spark, rows + more)
    assert sent.select("partition", "offset").distinct().count() == 29
    assert read_table(spark, t.root, "audit", t.group).where("client_type = 'consumer'").agg(F.sum("n")).first()[0] == 29
    assert fold(spark, t.root, t.group, 0, least=1) == 6 and totals(again)[0][0][1] == 29


class _Signalled(Transfer):
    """Asked to stop in the middle of its first batch."""

    def _after_sink(self, batch_id):
        self.request_stop()


@pytest.mark.parametrize("offset_ranges", [False, True])
def test_requested_stop_ends_between_batches(spark, scratch, offset_ranges):
    rows = _rows(0, 0, 12) + _rows(1, 0, 12)
    for b in range(3):
        _append(spark, f"{scratch}/src", b, rows[b * 8:(b + 1) * 8])
    o = _opts(scratch, start_at="earliest", read_limit=8 if offset_ranges else 1, offset_ranges=offset_ranges, flush_interval_ms=200)
    t = _Signalled(spark, o)
    t.start()
    t.finish()
    assert t.batches == [0] and not t.query.isActive
    assert t.audit().where("client_type = 'consumer'").agg(F.sum("n")).first()[0] == 8 == _sent(spark, scratch).count()
    assert t.commits().agg(F.sum("next_offset")).first()[0] == 8
    again = run_transfer(spark, o)
    assert again.batches[0] == 1  # nothing to replay
    assert _multiset(_sent(spark, scratch)) == _expected(spark, rows)


def test_requested_stop_after_a_failed_record_ends_the_batch(spark, scratch):
    rows = _rows(0, 0, 12)
    _append(spark, f"{scratch}/src", 0, rows)
    o = _opts(scratch, start_at="earliest", reject_when="value = 'v3'", flush_interval_ms=200)
    t = _Signalled(spark, o)
    t.start()
    t.finish()
    assert t.batches == [] and t.commits().where("batch_id >= 0").count() == 0 and t.audit().count() == 0
    again = run_transfer(spark, o)
    assert again.batches == [0] and _sent(spark, scratch).count() == 11
    assert again.commits().agg(F.max("next_offset")).first()[0] == 12
