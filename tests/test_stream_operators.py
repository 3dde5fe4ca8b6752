"""Operators marked "B S" give the same result on a stream as on batch data."""

from pyspark.sql import functions as F

from helpers import log_rows, make_log
from spillway.operators import metrics, points, records
from spillway.sinks.file_log import write_log_batch
from spillway.sources.topic_log import read_file_log


def _log_files(spark, root):
    rows = log_rows("a", 0, 0, 40, value=lambda o: None if o % 7 == 0 else f"v{o}".encode()) + \
        log_rows("a", 1, 0, 25) + log_rows("b", 0, 0, 10)
    for b in range(3):
        write_log_batch(make_log(spark, rows[b * 25:(b + 1) * 25]).coalesce(1), root, "p", 0, b, "snappy")
    return rows


def _run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def _norm(df, cols):
    return sorted(tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r)
                  for r in df.select(*cols).collect())


def test_record_operators_stream_equals_batch(spark, scratch):
    _log_files(spark, scratch)

    def ops(log):
        return records.null_to_empty(
            records.place_round_robin(records.topic_filter(log, "a"), 4)
            .select("topic", F.col("dst_partition").alias("partition"), "key", "value"))

    stream = read_file_log(spark, scratch, "a", stream=True, max_files_per_trigger=1)
    got = _run(ops(stream), "rec_ops")
    batch = ops(read_file_log(spark, scratch))
    cols = ["topic", "partition", "key", "value"]
    assert _norm(got, cols) == _norm(batch, cols)


def test_rejects_and_points_on_a_stream(spark, scratch):
    _log_files(spark, scratch)
    stream = read_file_log(spark, scratch, stream=True, max_files_per_trigger=1)
    bad = stream.where(records.reject_flag("length(value) > 2"))
    assert _run(bad, "rejected_s").count() == read_file_log(spark, scratch).where("length(value) > 2").count()
    audit = stream.select("topic", F.lit("consumer").alias("client_type"), F.lit(1).cast("long").alias("n"),
                          F.col("timestamp").alias("at"))
    rates = _run(metrics.throughput(audit, 10), "rates_s", "complete")
    batch_audit = read_file_log(spark, scratch).select(
        "topic", F.lit("consumer").alias("client_type"), F.lit(1).cast("long").alias("n"), F.col("timestamp").alias("at"))
    cols = ["topic", "client_type", "time", "records"]
    assert _norm(rates, cols) == _norm(metrics.throughput(batch_audit, 10), cols)
    pts = _run(points.rps_points(metrics.throughput(audit, 10), "h"), "pts_s", "complete")
    assert pts.count() == rates.count()


def test_gauge_sample_on_a_stream(spark, scratch):
    _log_files(spark, scratch)
    stream = read_file_log(spark, scratch, stream=True, max_files_per_trigger=1).select(
        F.col("topic").alias("host"), "timestamp", "offset", F.length("value").alias("size"))
    got = _run(metrics.gauge_sample(stream, ["host"], ["size"], "timestamp", "offset", 60), "gauge_s", "complete")
    batch = read_file_log(spark, scratch).select(
        F.col("topic").alias("host"), "timestamp", "offset", F.length("value").alias("size"))
    want = metrics.gauge_sample(batch, ["host"], ["size"], "timestamp", "offset", 60)
    assert _norm(got, ["host", "time", "size"]) == _norm(want, ["host", "time", "size"])
