"""Scale properties of physical plans (read from the final adaptive plan)."""

from helpers import log_rows, make_log
from spillway.options import TransferOptions
from spillway.plans import copy
from spillway.plans.copy import plan_counted
from spillway.sinks.file_log import write_log_batch
from spillway.sources.topic_log import read_file_log
from spillway.streaming.transfer import run_transfer


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _final(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _final(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return node  # keep the stage node: its kind says shuffle or broadcast
    return node


def shuffles_outside_broadcast(plan) -> list[str]:
    """Names of shuffle nodes that are not inside a broadcast subtree."""
    out = []

    def walk(node, under_broadcast):
        node = _final(node)
        name = node.getClass().getSimpleName()
        b = under_broadcast or "Broadcast" in name
        if not b and ("ShuffleExchange" in name or name == "ShuffleQueryStageExec"):
            out.append(name)
        inner = node.plan() if name.endswith("QueryStageExec") else None
        for c in ([inner] if inner is not None else _children(node)):
            walk(c, b)

    walk(plan, False)
    return out


def test_copy_moves_no_record_even_with_a_hot_partition(spark, scratch):
    rows = log_rows("t", 0, 0, 3000) + [r for p in range(1, 9) for r in log_rows("t", p, 0, 700)]
    write_log_batch(make_log(spark, rows), scratch, "p", 0, 0, "snappy")
    rows, plan = plan_counted(read_file_log(spark, scratch), 24)
    assert len(rows) == 9
    records = plan.records
    records.write.format("noop").mode("overwrite").save()
    plan = records._jdf.queryExecution().executedPlan()
    assert shuffles_outside_broadcast(plan) == []
    assert "BroadcastHashJoin" in plan.toString()
    grouped = records.groupBy("partition").count()
    grouped.write.format("noop").mode("overwrite").save()
    assert shuffles_outside_broadcast(grouped._jdf.queryExecution().executedPlan())  # the check can fail
    per = {r.partition: r["count"] for r in grouped.collect()}
    assert max(per.values()) - min(per.values()) <= 9  # round robin spreads the hot partition


def test_slots_join_without_a_broadcast_beyond_the_limit(spark, scratch, monkeypatch):
    """The same records and offsets on both sides of the broadcast's size check."""
    rows = [r for p in range(9) for r in log_rows("t", p, 3 * p, 200)]
    write_log_batch(make_log(spark, rows), scratch, "p", 0, 0, "snappy")
    show = lambda: sorted((r.partition, r.offset, bytes(r.value)) for r in plan_counted(read_file_log(spark, scratch), 4)[1].records.collect())
    hinted = show()
    monkeypatch.setattr(copy, "SLOT_BROADCAST_LIMIT", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, plan = plan_counted(read_file_log(spark, scratch), 4)
        assert "Broadcast" not in plan.records._jdf.queryExecution().executedPlan().toString()
        assert show() == hinted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _count(df, word):
    return df._jdf.queryExecution().executedPlan().toString().count(word)


def test_lag_reads_the_log_twice_and_budget_once(spark, scratch):
    """Lag: one aggregate for positions, one for the topic names of the partition list."""
    from spillway.operators import budget, metrics, positions
    write_log_batch(make_log(spark, log_rows("t", 0, 0, 20) + log_rows("u", 1, 0, 9)), scratch, "p", 0, 0, "snappy")
    log = read_file_log(spark, scratch)
    lag = metrics.lag_of_log(log, positions.partition_list(log, 3), "2024-01-01 00:00:05", "g")
    assert _count(lag, "FileScan") == 2 and _count(lag, "Exchange hash") <= 3
    trips = budget.budget_trips(log, ["topic"], "offset", 10)
    assert _count(trips, "FileScan") == 1 and _count(trips, "Exchange hash") == 1 and _count(trips, "WindowGroupLimit") >= 1


def test_frozen_start_reaches_the_stream_scan(spark, scratch, capsys):
    src = f"{scratch}/src"
    write_log_batch(make_log(spark, log_rows("t", 0, 0, 20)).coalesce(1), src, "p", 0, 0, "snappy")
    o = TransferOptions(topic="t", source=src, destination=f"{scratch}/dst", state_path=f"{scratch}/st",
                        destination_partitions=4)
    run_transfer(spark, o)
    write_log_batch(make_log(spark, log_rows("t", 0, 20, 5)).coalesce(1), src, "p", 0, 1, "snappy")
    t = run_transfer(spark, o)
    t.query.explain(True)
    out = capsys.readouterr().out
    assert "(offset" in out and ">= 20" in out and "DataFilters" in out


def test_range_pass_reads_no_payload(spark, scratch):
    """Offset ranges come from two columns; payload columns only where the reject predicate names them."""
    write_log_batch(make_log(spark, log_rows("t", 0, 0, 20)), scratch, "p", 0, 0, "snappy")
    log = read_file_log(spark, scratch, "t")

    def columns(ranges):
        plan = ranges._jdf.queryExecution().executedPlan().toString()
        return set(plan.split("ReadSchema: struct<")[1].split(">")[0].replace(":", ",").split(",")[::2])
    assert columns(copy.plan_copy_batch(log, 4).ranges) == {"partition", "offset"}
    assert columns(copy.plan_copy_batch(log, 4, reject_when="length(value) > 8").ranges) == {"partition", "offset", "value"}


def test_bytes_of_a_batch_come_from_its_write(spark, scratch):
    write_log_batch(make_log(spark, log_rows("t", 0, 0, 30) + log_rows("t", 1, 0, 5)), f"{scratch}/src", "p", 0, 0, "snappy")
    o = TransferOptions(topic="t", source=f"{scratch}/src", destination=f"{scratch}/dst", state_path=f"{scratch}/st", start_at="earliest",
                        destination_partitions=4, reject_when="length(value) > 2", max_errors=100)
    t = run_transfer(spark, o)
    size = sum(len(f"k{i}") + len(f"v{i}") for i in [*range(30), *range(5)])
    assert t.live == {"records": 35, "bytes": size, "rejected": 20}
    rows = t.audit().where("bytes is not null").collect()
    assert [(r.client_type, r.partition, r.bytes) for r in rows] == [("consumer", 0, size)]


def test_dense_metrics_read_the_audit_little_more_often_than_throughput(spark, scratch):
    """Scans that run (reused exchanges don't): dense series and records in flight pack one aggregate of the audit."""
    from spillway.operators import metrics
    write_log_batch(make_log(spark, log_rows("t", 0, 0, 50) + log_rows("u", 1, 0, 9)), scratch, "p", 0, 0, "snappy")
    log = read_file_log(spark, scratch)
    audit = log.selectExpr("topic", "'consumer' as client_type", "1L as n", "0L as rejected", "timestamp as at")

    def read(df):
        tracker = spark.sparkContext._jsc.sc()
        group = f"scans-{id(df)}"
        spark.sparkContext.setJobGroup(group, group)
        df.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
        return sum(tracker.statusStore().stageData(s, False, None, False, None).apply(0).inputRecords() for s in stages
                   if tracker.statusStore().stageData(s, False, None, False, None).size())
    assert read(metrics.throughput(audit)) == 59
    assert read(metrics.dense_throughput(audit)) <= 2 * 59
    assert read(metrics.in_flight(audit)) <= 2 * 59
