import datetime as dt

from spillway.operators import points
from spillway.sinks.file_log import write_partitioned
from spillway.streaming import fs, metric_sink
from spillway.streaming.metric_sink import read_points, write_points


def test_points_and_series_keys(spark):
    lag = spark.createDataFrame([("g", "t", 3, 5, 9)],
                                "group string, topic string, partition int, current_offset long, newest_offset long")
    rates = spark.createDataFrame([("t", "consumer", dt.datetime(2024, 1, 1, 0, 0, 1), 42)],
                                  "topic string, client_type string, time timestamp, records long")
    pts = points.to_points(points.kafka_stats_points(lag, "h", dt.datetime(2024, 1, 1, 0, 0, 0, 700000)),
                           points.rps_points(rates, "h"))
    rows = sorted((r.series, r.field, r.value, r.time) for r in points.explode_points(pts).collect())
    assert rows == [
        ("kafka_stats,consumer_group_name=g,host=h,partition=3,topic=t", "currentOffset", 5, dt.datetime(2024, 1, 1)),
        ("kafka_stats,consumer_group_name=g,host=h,partition=3,topic=t", "newestOffset", 9, dt.datetime(2024, 1, 1)),
        ("rps_stats,clientType=consumer,host=h,topic=t", "rps", 42, dt.datetime(2024, 1, 1, 0, 0, 1)),
    ]


def test_system_points_have_one_field_per_gauge(spark):
    s = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 2)], "time timestamp, mallocs long, frees long")
    p = points.system_points(s, "h", ["mallocs", "frees"]).first()
    assert p.measurement == "system_stats" and dict(p.fields) == {"mallocs": 1, "frees": 2}
    assert dict(p.tags) == {"host": "h"}


def _sets(spark, n=3):
    """A point of kafka_stats, n of rps_stats and n of system_stats."""
    lag = spark.createDataFrame([("g", "t", 0, 5, 9)],
                                "group string, topic string, partition int, current_offset long, newest_offset long")
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(n)]
    rates = spark.createDataFrame([("t", "consumer", t, 42) for t in at], "topic string, client_type string, time timestamp, records long")
    gauges = spark.createDataFrame([(t, 7) for t in at], "time timestamp, mallocs long")
    return points.to_points(points.kafka_stats_points(lag, "h", at[0]), points.rps_points(rates, "h"), points.system_points(gauges, "h", ["mallocs"]))


def _counts(spark, path):
    return {(r.measurement, r.writer, r.batch_id): r["count"] for r in read_points(spark, path).groupBy("measurement", "writer", "batch_id").count().collect()}


def test_known_measurements_are_not_sorted_by_folder(spark, scratch, monkeypatch):
    """A `partitionBy` write keeps a task's points in a sort; only points of other measurements may go that way."""
    sorted_rows = []

    def seen(df, *args):
        sorted_rows.extend(r.measurement for r in df.collect())
        write_partitioned(df, *args)
    monkeypatch.setattr(metric_sink, "write_partitioned", seen)
    other = spark.sql("select 'other' as measurement, map('host', 'h') as tags, map('f', 1L) as fields, timestamp'2024-01-01' as time "
                      "union all select null, map('host', 'h'), map('f', 2L), timestamp'2024-01-01'")
    write_points(points.to_points(_sets(spark), other), f"{scratch}/points", "w", 0)
    assert sorted(sorted_rows, key=str) == [None, "other"]
    assert _counts(spark, f"{scratch}/points") == {("kafka_stats", "w", 0): 1, ("rps_stats", "w", 0): 3, ("system_stats", "w", 0): 3,
                                                   ("other", "w", 0): 1, (None, "w", 0): 1}
    assert not [n for n in fs.child_names(spark, f"{scratch}/points") if n.startswith(".staged")]


def test_a_batch_written_again_replaces_what_it_has(spark, scratch):
    path, writer = f"{scratch}/points", "a_b=c/d-g0"  # a name that folder names escape
    for batch in (0, 1):
        write_points(_sets(spark), path, writer, batch)
    write_points(_sets(spark, 2).where("measurement != 'kafka_stats'"), path, writer, 1)
    whole = {("kafka_stats", writer, 0): 1, ("rps_stats", writer, 0): 3, ("system_stats", writer, 0): 3}
    again = {("kafka_stats", writer, 1): 1, ("rps_stats", writer, 1): 2, ("system_stats", writer, 1): 2}
    assert _counts(spark, path) == whole | again
    write_points(_sets(spark).limit(0), path, writer, 0)
    assert _counts(spark, path) == whole | again
    row = read_points(spark, path).where("measurement = 'rps_stats' and batch_id = 0").orderBy("time").first()
    assert (row.tags, row.fields, row.time) == ({"host": "h", "topic": "t", "clientType": "consumer"}, {"rps": 42}, dt.datetime(2024, 1, 1))
