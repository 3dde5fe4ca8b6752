"""Failed records are tried again in later batches, sent once, dead after the last attempt."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import log_rows, make_log
from spillway.options import TransferOptions
from spillway.sinks.file_log import write_log_batch
from spillway.sources.topic_log import read_file_log
from spillway.streaming.attempts import next_attempts, read_attempts
from spillway.streaming.transfer import Transfer, run_transfer

# Of every 10 records of a partition, one fails once, one twice and one always.
FAILS = "substring(decode(value, 'UTF-8'), -1) = '3' and attempt <= 1 or substring(decode(value, 'UTF-8'), -1) = '5' and attempt <= 2 or substring(decode(value, 'UTF-8'), -1) = '7'"


def _opts(scratch, **kw):
    base = dict(topic="t", source=f"{scratch}/src", destination=f"{scratch}/dst", state_path=f"{scratch}/state", destination_partitions=4,
                start_at="earliest", offset_ranges=True, retry_failed=True, max_retry=2, reject_when=FAILS, max_errors=1000)
    return TransferOptions(**(base | kw))


def _source(spark, scratch, first=0, n=40, batch_id=0):
    rows = log_rows("t", 0, first, n) + log_rows("t", 1, first, n)
    write_log_batch(make_log(spark, rows).coalesce(1), f"{scratch}/src", "p", 0, batch_id, "snappy")
    return rows


def _check(spark, scratch, t, rows):
    out = read_file_log(spark, f"{scratch}/dst", "t")
    want = sorted(r[4] for r in rows if not r[4].endswith(b"7"))
    assert sorted(bytes(r.value) for r in out.collect()) == want
    assert out.select("partition", "offset").distinct().count() == len(want)
    dead = t.quarantined().collect()
    assert sorted((r.partition, r.offset, r.attempt) for r in dead) == sorted((p, o, 3) for _, p, o, *_ in rows if o % 10 == 7)
    audit = {r.client_type: (r.n, r.rejected) for r in t.audit().groupBy("client_type").agg(F.sum("n").alias("n"), F.sum("rejected").alias("rejected")).collect()}
    assert audit == {"consumer": (len(rows), len(dead)), "producer": (len(want), 0)}


def test_sent_once_or_dead_after_the_last_attempt(spark, scratch):
    rows = _source(spark, scratch)
    t = run_transfer(spark, _opts(scratch, max_errors=8))  # 24 records fail at least once; the budget counts the 8 that fail for good
    _check(spark, scratch, t, rows)
    made = spark.read.parquet(t.attempts).groupBy("partition", "offset").agg(F.max("attempt").alias("n")).collect()
    assert {(r.partition, r.offset): r.n for r in made} == {(p, o): {3: 2, 5: 3, 7: 3}[o % 10] for _, p, o, *_ in rows if o % 10 in (3, 5, 7)}
    # the source's positions go on past records that wait
    assert {r.next_offset for r in t.commits().groupBy("partition").agg(F.max("next_offset").alias("next_offset")).collect()} == {40}


class _Dies(Transfer):
    at = 1  # it sends records that waited

    def _after_sink(self, batch_id):
        if batch_id == self.at:
            raise RuntimeError("killed")


def test_a_killed_batch_loses_and_repeats_nothing(spark, scratch):
    rows = _source(spark, scratch)
    killed = _Dies(spark, _opts(scratch))
    killed.start("available_now")
    with pytest.raises(StreamingQueryException):
        killed.finish()
    _check(spark, scratch, run_transfer(spark, _opts(scratch)), rows)


def test_no_retries_and_a_backlog_of_failures_only(spark, scratch):
    _source(spark, scratch)
    t = run_transfer(spark, _opts(scratch, max_retry=0))
    assert t.quarantined().count() == 24 and read_file_log(spark, f"{scratch}/dst", "t").count() == 56
    all_fail = run_transfer(spark, _opts(scratch, reject_when="attempt <= 1", state_path=f"{scratch}/b", destination=f"{scratch}/dst2"))
    assert read_file_log(spark, f"{scratch}/dst2", "t").count() == 80 and all_fail.rejected_total == 0


def test_waits_double(spark):
    failed = make_log(spark, log_rows("t", 0, 0, 4)).withColumn("attempt", (F.col("offset") + 1).cast("int"))
    got = {r.offset: (r.attempt, r.due) for r in next_attempts(failed, 10, 3).collect()}
    assert got == {0: (2, 11), 1: (3, 12), 2: (4, 14)}
    assert read_attempts(spark, "/nowhere", []).count() == 0


def test_options(scratch):
    with pytest.raises(ValueError):
        _opts(scratch, offset_ranges=False)
    with pytest.raises(ValueError):
        _opts(scratch, max_retry=-1)
