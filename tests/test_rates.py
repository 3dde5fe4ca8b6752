"""Streaming rates equal the batch rates; idle seconds are closed; a repeated batch of points adds nothing."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException

from spillway.operators import metrics
from spillway.streaming import rates
from spillway.streaming.metric_sink import read_points

T0 = 1_700_000_015  # not on a minute
SCHEMA = "topic string, client_type string, n long, at timestamp"


def _audit(spark, rows):
    return spark.createDataFrame([(t, c, n, dt.datetime.fromtimestamp(s, dt.timezone.utc)) for t, c, n, s in rows], SCHEMA)


def _chunks(spark, scratch, parts, since, lateness, chunk=60):
    for rows in parts:
        _audit(spark, rows).write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{scratch}/in")
        (rates.closed_chunks(stream, since, lateness, chunk).writeStream.option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
         .format("parquet").start(f"{scratch}/out").awaitTermination())
    return {(r.topic, r.client_type, r.start): [int(v) for v in r.records.split(",")] for r in spark.read.parquet(f"{scratch}/out").collect()}


def test_late_and_shuffled_rows_equal_the_batch_result(spark, scratch):
    rnd = random.Random(5)
    rows = [("a", "consumer", 2, T0)] + [(t, c, rnd.randint(0, 5), T0 + rnd.choice([0, 7, 8, 100, 4000, 9000]) + rnd.randint(0, 50) + rnd.random() * 0.9)
                                         for t, c in [("a", "consumer"), ("a", "producer"), ("b", "consumer")] for _ in range(200)]
    arrive = sorted((s + rnd.random() * 119, (t, c, n, s)) for t, c, n, s in rows)
    cut = len(arrive) // 2
    parts = [[r for _, r in arrive[:cut]], [r for _, r in arrive[cut:]], [("a", "consumer", 0, T0 + 9500)]]
    for p in parts:
        rnd.shuffle(p)
    got = _chunks(spark, scratch, parts, T0, "120 seconds")
    last = (T0 + 9050) // 60 * 60
    want = {(r.topic, r.client_type, int(r.start.replace(tzinfo=dt.timezone.utc).timestamp())): [int(v) for v in r.records.split(",")]
            for r in metrics.packed_throughput(_audit(spark, rows)).collect()}
    first = T0 - T0 % 60
    # the batch result begins and ends in the middle of a chunk, with the first and the last second
    for (t, c, s), v in want.items():
        whole = got[t, c, s]
        at = T0 - first if s == first else 0
        assert whole[at:at + len(v)] == v and sum(whole) == sum(v)
    assert sorted({s for *_, s in got if s <= last}) == list(range(first, last + 1, 60))
    assert all(sum(v) == 0 for (*_, s), v in got.items() if s > last)


def test_rows_behind_the_watermark_are_not_counted(spark, scratch):
    parts = [[("a", "consumer", 1, T0), ("a", "consumer", 1, T0 + 300)], [("a", "consumer", 50, T0 + 1), ("a", "consumer", 7, T0 + 295)],
             [("a", "consumer", 0, T0 + 1000)]]
    got = _chunks(spark, scratch, parts, T0, "10 seconds", 1)
    assert {s - T0: v[0] for (*_, s), v in got.items() if v[0]} == {0: 1, 295: 7, 300: 1}
    assert sorted(s for *_, s in got) == list(range(T0, T0 + 990))


def test_points_of_a_killed_query_are_written_once(spark, scratch, monkeypatch):
    _audit(spark, [("a", "consumer", 3, T0), ("a", "producer", 3, T0 + 4), ("a", "consumer", 0, T0 + 20)]).write.parquet(f"{scratch}/in")
    spark.createDataFrame([(dt.datetime.fromtimestamp(T0 + 40, dt.timezone.utc),)], "at timestamp").write.parquet(f"{scratch}/beats")

    def run():
        q = rates.start_point_query(spark.readStream.schema(SCHEMA).parquet(f"{scratch}/in"), f"{scratch}/points", "w", "h", T0, f"{scratch}/ck",
                                    beats=spark.readStream.schema("at timestamp").parquet(f"{scratch}/beats"), trigger={"availableNow": True})
        q.awaitTermination()
    write = rates.write_points

    def dies(rows, path, writer, batch_id):
        write(rows, path, writer, batch_id)
        if batch_id == 1:
            raise RuntimeError("killed between the write and the commit")
    monkeypatch.setattr(rates, "write_points", dies)
    with pytest.raises(StreamingQueryException):
        run()
    assert read_points(spark, f"{scratch}/points").count() > 0
    monkeypatch.setattr(rates, "write_points", write)
    run()
    rows = read_points(spark, f"{scratch}/points").collect()
    per = sorted((r.tags["clientType"], int(r.time.replace(tzinfo=dt.timezone.utc).timestamp()) - T0, r.fields["rps"]) for r in rows)
    # one row per series and second, up to where the beat moved the watermark
    assert per == [(c, s, 3 if (c, s) in (("consumer", 0), ("producer", 4)) else 0) for c in ("consumer", "producer") for s in range(30)]
