import time

from pyspark.sql import functions as F

from helpers import log_rows, make_log
from spillway.operators import metrics, points
from spillway.options import TransferOptions
from spillway.plans import monitoring
from spillway.plans.monitoring import Monitor
from spillway.sinks.file_log import write_log_batch
from spillway.streaming.metric_sink import read_points, write_points
from spillway.streaming.progress import BATCH_GAUGES, batch_gauges, parse_offsets
from spillway.streaming.transfer import Transfer, run_transfer


def _append(spark, root, b, rows):
    write_log_batch(make_log(spark, rows).coalesce(1), root, "producer", 0, b, "snappy")


def _opts(scratch, **kw):
    return TransferOptions(**(dict(topic="t", source=f"{scratch}/src", destination=f"{scratch}/dst", state_path=f"{scratch}/state",
                                   destination_partitions=4, host="h") | kw))


def _points(spark, scratch):
    return points.explode_points(read_points(spark, f"{scratch}/metrics"))


def _once_a_second(rates):
    """(series -> sum), after checking that each series has one row a second without gaps."""
    rows = rates.groupBy("series").agg(F.count("*").alias("n"), F.count_distinct("time").alias("d"), F.sum("value").alias("s"),
                                       (F.unix_seconds(F.max("time").cast("timestamp")) - F.unix_seconds(F.min("time").cast("timestamp"))).alias("span"))
    got = rows.collect()
    assert all(r.n == r.d == r.span + 1 for r in got), got
    return {r.series: r.s for r in got}


def test_lag_follows_the_copy(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 10) + log_rows("t", 1, 0, 4))
    run_transfer(spark, _opts(scratch))  # starts at newest: seeded positions, lag 0
    lag = {r.partition: (r.lag, r.has_position) for r in monitoring.copy_lag(spark, _opts(scratch), partitions=3).collect()}
    assert lag == {0: (0, True), 1: (0, True), 2: (0, False)}
    _append(spark, f"{scratch}/src", 1, log_rows("t", 0, 10, 6))  # arrives, not yet copied
    lag = {r.partition: r.lag for r in monitoring.copy_lag(spark, _opts(scratch)).collect()}
    assert lag == {0: 6, 1: 0}
    run_transfer(spark, _opts(scratch))
    assert {r.lag for r in monitoring.copy_lag(spark, _opts(scratch)).collect()} == {0}


def test_a_running_copy_emits_all_points(spark, scratch):
    """kafka_stats, rps_stats and system_stats while it runs; each second of a series once, over ticks and restarts."""
    o = _opts(scratch, start_at="earliest", metrics_path=f"{scratch}/metrics", monitor_seconds=0.3, flush_interval_ms=200, read_limit=1)
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 10) + log_rows("t", 1, 0, 4))
    t = Transfer(spark, o)
    t.start()
    t.query.processAllAvailable()
    time.sleep(2.5)  # idle seconds
    assert t.query.isActive and _points(spark, scratch).where("field = 'rps'").count() > 0  # written while it runs
    _append(spark, f"{scratch}/src", 1, log_rows("t", 0, 10, 6))
    t.query.processAllAvailable()
    t.stop()
    ticks = read_points(spark, f"{scratch}/metrics").where("measurement = 'rps_stats'").select("batch_id").distinct().count()
    assert ticks > 1
    _append(spark, f"{scratch}/src", 2, log_rows("t", 1, 4, 5))
    run_transfer(spark, o)  # another run of the same generation
    p = _points(spark, scratch)
    assert _once_a_second(p.where("field = 'rps'")) == {f"rps_stats,clientType={c},host=h,topic=t": 25 for c in ("consumer", "producer")}
    lag = {r.series: (r.value, r.time) for r in p.where("field = 'newestOffset'").orderBy("time").collect()}
    assert {v for v, _ in lag.values()} == {16, 9}
    assert p.where("measurement = 'kafka_stats'").groupBy("series", "field", "time").count().where("count > 1").count() == 0
    system = {r.field for r in p.where("measurement = 'system_stats'").collect()}
    assert system == {*BATCH_GAUGES, "in_flight"}


def test_repeated_ticks_add_nothing(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 20))
    t = run_transfer(spark, _opts(scratch, start_at="earliest"))
    m = Monitor(spark, _opts(scratch, metrics_path=f"{scratch}/metrics"), t)
    end = int(time.time()) + 2
    assert m.tick(end) and not m.tick(end) and not m.tick(end - 1)
    sums = _once_a_second(_points(spark, scratch).where("field = 'rps'"))
    assert set(sums.values()) == {20}
    again = Monitor(spark, _opts(scratch, metrics_path=f"{scratch}/metrics"), t)  # a new process goes on where it ended
    assert not again.tick(end) and again.tick(end + 3)
    assert _once_a_second(_points(spark, scratch).where("field = 'rps'")) == sums


def test_two_copies_write_one_table(spark, scratch):
    for topic in ("t", "u"):
        _append(spark, f"{scratch}/src{topic}", 0, log_rows(topic, 0, 0, 7))
        run_transfer(spark, _opts(scratch, topic=topic, source=f"{scratch}/src{topic}", start_at="earliest", metrics_path=f"{scratch}/metrics"))
    sums = _once_a_second(_points(spark, scratch).where("field = 'rps'"))
    assert sums == {f"rps_stats,clientType={c},host=h,topic={x}": 7 for c in ("consumer", "producer") for x in "tu"}
    p = read_points(spark, f"{scratch}/metrics")
    before = p.count()
    write_points(p.where("measurement = 'rps_stats'").limit(0), f"{scratch}/metrics", "other", 0)
    assert read_points(spark, f"{scratch}/metrics").count() == before


def test_newest_offsets_are_read_from_new_files_only(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 5) + log_rows("t", 1, 0, 2))
    t = run_transfer(spark, _opts(scratch, start_at="earliest"))
    m = Monitor(spark, _opts(scratch, metrics_path=f"{scratch}/metrics"), t)
    newest = lambda k: {r.partition: r.newest_offset for r in m._newest(k).collect()}
    assert newest(0) == {0: 5, 1: 2}
    time.sleep(1.1)
    _append(spark, f"{scratch}/src", 1, log_rows("t", 1, 2, 9))
    assert newest(1) == {0: 5, 1: 11}
    assert newest(2) == {0: 5, 1: 11}


def test_dense_series_see_rows_that_came_later(spark, scratch):
    """No cached table answers for an older state of the audit."""
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 20))
    o = _opts(scratch, start_at="earliest")
    run_transfer(spark, o)
    total = lambda: metrics.dense_throughput(monitoring.audit_of(spark, o)).agg(F.sum("records")).first()[0]
    assert total() == 40
    _append(spark, f"{scratch}/src", 1, log_rows("t", 0, 20, 5))
    run_transfer(spark, o)
    assert total() == 50 and metrics.in_flight(monitoring.audit_of(spark, o)).agg(F.max("in_flight")).first()[0] == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_newest_from_progress_parses_kafka_offsets(spark):
    progress = {"sources": [{"latestOffset": '{"t": {"0": 12, "1": 3}}'}, {"latestOffset": None}]}
    got = sorted((r.topic, r.partition, r.newest_offset)
                 for r in monitoring.newest_from_progress(spark, progress).collect())
    assert got == [("t", 0, 12), ("t", 1, 3)] == sorted(parse_offsets('{"t": {"1": 3, "0": 12}}'))


def test_batch_gauges_feed_system_points(spark, scratch):
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 20))
    _append(spark, f"{scratch}/src", 1, log_rows("t", 0, 20, 20))
    t = run_transfer(spark, _opts(scratch, start_at="earliest", read_limit=1))
    g = batch_gauges(t.audit(), "h")
    assert g.count() == 2
    assert g.agg(F.sum("records")).first()[0] == 40
    assert g.agg(F.sum("bytes")).first()[0] == sum(len(f"v{o}") + len(f"k{o}") for o in range(40))
    assert g.agg(F.min("took_ms")).first()[0] > 0
    sampled = metrics.gauge_sample(g, ["host"], list(BATCH_GAUGES), "at", "batch_id", 60)
    p = points.system_points(sampled, "h", BATCH_GAUGES).first()
    assert p.measurement == "system_stats" and set(p.fields) == set(BATCH_GAUGES)


def test_gauges_are_of_the_last_batch_since_the_last_sample(spark, scratch):
    """A batch that an earlier tick of the minute covered is sampled; a minute without batches gives 0."""
    _append(spark, f"{scratch}/src", 0, log_rows("t", 0, 0, 20))
    t = run_transfer(spark, _opts(scratch, start_at="earliest"))
    m = Monitor(spark, _opts(scratch, metrics_path=f"{scratch}/metrics"), t)
    begin = m.gauged = m.until  # as if sampled when the copy began
    assert m.tick(int(time.time()) + 2) and m.gauged == begin and m.tick(begin + 60) and m.tick(begin + 120)
    records = _points(spark, scratch).where("measurement = 'system_stats' and field = 'records'").orderBy("time").collect()
    assert [r.value for r in records] == [20, 0]
