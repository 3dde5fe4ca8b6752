from pyspark.sql import functions as F

from helpers import as_set, log_rows, make_log
from spillway.operators import records
from spillway.plans.copy import plan_copy_batch
from spillway.sinks.file_log import write_topic_log
from spillway.sources.topic_log import read_file_log


def test_topic_filter_and_projection(spark):
    log = make_log(spark, log_rows("a", 0, 0, 5) + log_rows("b", 1, 0, 3))
    out = records.record_projection(records.topic_filter(log, "a"))
    assert out.columns == ["topic", "key", "value"]
    assert out.count() == 5
    assert {r.topic for r in out.collect()} == {"a"}


def test_null_to_empty_makes_empty_bytes_not_null(spark):
    log = make_log(spark, log_rows("a", 0, 0, 4, key=lambda o: None, value=lambda o: None if o % 2 else b"x"))
    out = records.null_to_empty(records.record_projection(log)).collect()
    assert all(r.key == bytearray(b"") for r in out)
    assert sorted(bytes(r.value) for r in out) == [b"", b"", b"x", b"x"]
    kept = records.null_to_empty(records.record_projection(log), preserve_nulls=True).collect()
    assert all(r.key is None for r in kept)


def test_round_robin_is_even_and_stateless(spark):
    log = make_log(spark, log_rows("a", 3, 0, 1000))
    placed = records.place_round_robin(log, 4)
    counts = {r["dst_partition"]: r["count"] for r in placed.groupBy("dst_partition").count().collect()}
    assert counts == {0: 250, 1: 250, 2: 250, 3: 250}
    again = records.place_round_robin(log, 4)
    a = sorted((r.offset, r.dst_partition) for r in placed.collect())
    b = sorted((r.offset, r.dst_partition) for r in again.collect())
    assert a == b
    # consecutive offsets go to consecutive partitions, ignoring the key
    first = [r.dst_partition for r in placed.orderBy("offset").limit(5).collect()]
    assert first == [3, 0, 1, 2, 3]


def test_fan_out_keeps_the_multiset(spark):
    log = make_log(spark, log_rows("a", 0, 0, 100) + log_rows("a", 1, 0, 100))
    sent = plan_copy_batch(log, 4).records.select("topic", "partition", "key", "value")
    assert as_set(records.fan_out(sent, 3), ("topic", "partition", "key", "value")) == \
        as_set(sent, ("topic", "partition", "key", "value"))
    assert records.fan_out(sent, 3).rdd.getNumPartitions() == 3
    assert records.fan_out(sent, None) is sent


def test_rejects_count_null_as_not_rejected(spark):
    log = make_log(spark, log_rows("a", 0, 0, 10, value=lambda o: None if o < 3 else (b"x" * o)))
    plan = plan_copy_batch(log, 4, reject_when="length(value) > 8")
    assert plan.records.count() == 9 and plan.rejected.count() == 1
    assert plan.rejected.first().offset == 9


def test_payload_edge_cases_survive_the_file_log(spark, scratch):
    payloads = [None, b"", b"\x00", b"\xff\xfe", b"\x00" * (1 << 20)]
    rows = [("edge", 0, i, p, p, log_rows("edge", 0, i, 1)[0][5]) for i, p in enumerate(payloads)]
    log = make_log(spark, rows)
    write_topic_log(log, scratch)
    back = read_file_log(spark, scratch, "edge").orderBy("offset").collect()
    assert [None if r.value is None else bytes(r.value) for r in back] == payloads
    assert [None if r.key is None else bytes(r.key) for r in back] == payloads
    sent = records.null_to_empty(records.record_projection(read_file_log(spark, scratch, "edge")))
    got = sorted(bytes(r.value) for r in sent.collect())
    assert got == sorted([b"", b"", b"\x00", b"\xff\xfe", b"\x00" * (1 << 20)])


def test_topic_filter_prunes_folders(spark, scratch):
    log = make_log(spark, log_rows("a", 0, 0, 5) + log_rows("b", 0, 0, 5))
    write_topic_log(log, scratch)
    plan = read_file_log(spark, scratch, "a").where(F.col("offset") >= 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan
    assert "GreaterThanOrEqual(offset,2)" in plan
