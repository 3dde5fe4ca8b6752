import datetime as dt
import random
from collections import defaultdict

from spillway.operators import metrics

T0 = dt.datetime(2024, 1, 1)


def _audit(spark, rnd_seed=3, n=400):
    rnd = random.Random(rnd_seed)
    rows = []
    for _ in range(n):
        t = T0 + dt.timedelta(seconds=rnd.randint(0, 300), microseconds=rnd.randint(0, 999999))
        rows.append((rnd.choice(["a", "b"]), rnd.choice(["consumer", "producer"]), rnd.randint(1, 5), t))
    return rows, spark.createDataFrame(rows, "topic string, client_type string, n long, at timestamp")


def _bucket(t, s):
    e = int((t - T0).total_seconds() // s) * s
    return T0 + dt.timedelta(seconds=e)


def test_throughput_matches_brute_force(spark):
    rows, audit = _audit(spark)
    expect = defaultdict(int)
    for topic, ct, n, t in rows:
        expect[(topic, ct, _bucket(t, 1))] += n
    got = {(r.topic, r.client_type, r.time): r.records for r in metrics.throughput(audit, 1).collect()}
    assert got == dict(expect)


def test_dense_throughput_fills_every_second(spark):
    rows, audit = _audit(spark, n=50)
    expect = defaultdict(int)
    for topic, ct, n, t in rows:
        expect[(topic, ct, _bucket(t, 1))] += n
    lo = min(_bucket(t, 1) for *_, t in rows)
    hi = max(_bucket(t, 1) for *_, t in rows)
    keys = {(topic, ct) for topic, ct, _, _ in rows}
    full = {}
    s = lo
    while s <= hi:
        for k in keys:
            full[(*k, s)] = expect.get((*k, s), 0)
        s += dt.timedelta(seconds=1)
    got = {(r.topic, r.client_type, r.time): r.records for r in metrics.dense_throughput(audit, 1).collect()}
    assert got == full


def test_in_flight_is_the_running_queue_length(spark):
    rows, audit = _audit(spark)
    delta = defaultdict(int)
    for topic, ct, n, t in rows:
        delta[(topic, _bucket(t, 30))] += n if ct == "consumer" else -n
    got = {(r.topic, r.time): r.in_flight for r in metrics.in_flight(audit, 30).collect()}
    for topic in ("a", "b"):
        run = 0
        times = sorted(t for (tp, t) in got if tp == topic)
        for t in times:
            run += delta.get((topic, t), 0)
            assert got[(topic, t)] == run
        assert times == [times[0] + dt.timedelta(seconds=30 * i) for i in range(len(times))]


def test_gauge_sample_takes_latest_by_sequence(spark):
    rows = [("h1", T0 + dt.timedelta(seconds=s), float(v), q)
            for s, v, q in [(1, 5, 10), (2, 7, 30), (3, 6, 20), (61, 1, 40), (62, 2, 35)]]
    df = spark.createDataFrame(rows, "host string, at timestamp, v double, seq long")
    got = {r.time: r.v for r in metrics.gauge_sample(df, ["host"], ["v"], "at", "seq", 60).collect()}
    assert got == {T0: 7.0, T0 + dt.timedelta(seconds=60): 1.0}


def test_partition_lag_and_total(spark):
    newest = spark.createDataFrame([("a", 0, 10), ("a", 1, 5), ("a", 2, 0)],
                                   "topic string, partition int, newest_offset long")
    committed = spark.createDataFrame([("a", 0, 7)], "topic string, partition int, next_offset long")
    lag = metrics.partition_lag(newest, committed, "a_g")
    got = {r.partition: (r.current_offset, r.lag, r.has_position) for r in lag.collect()}
    assert got == {0: (7, 3, True), 1: (0, 5, False), 2: (0, 0, False)}
    tot = metrics.total_lag(lag).first()
    assert (tot.group, tot.total_lag, tot.partitions) == ("a_g", 8, 3)


def test_in_flight_does_not_count_failed_records(spark):
    rows = [("a", "consumer", 5, 2, T0 + dt.timedelta(seconds=1)),   # 5 read, 2 failed at once
            ("a", "producer", 1, 0, T0 + dt.timedelta(seconds=40)),
            ("a", "producer", 2, 0, T0 + dt.timedelta(seconds=70))]
    audit = spark.createDataFrame(rows, "topic string, client_type string, n long, rejected long, at timestamp")
    got = [r.in_flight for r in metrics.in_flight(audit, 30).orderBy("time").collect()]
    assert got == [3, 2, 0]
