"""The registered queries: one per operator of the inventory, each over the
whole of the given tables (the `events` table turned into a topic log, see
`spillway.sources.fixtures`).  Each takes (spark, sf_dir) and returns a
DataFrame whose column names match the DuckDB oracle in `oracle_queries.py`.

Report conventions: payloads are shown as text, times as TIMESTAMP_NTZ (UTC
wall clock), so that results compare with a zone-less engine.
"""

from __future__ import annotations

import dataclasses
import functools
import time
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.functions import as_text, group_name, to_ntz, truncate_time, whole_div
from spillway.operators import budget, flush, metrics, points, positions, records
from spillway.options import TransferOptions
from spillway.plans.copy import plan_copy_batch, plan_counted
from spillway.plans.monitoring import Monitor, copy_lag
from spillway.schema import ATTEMPTS, AUDIT, TOPIC_LOG
from spillway.session import ensure_utc, under_state
from spillway.sinks.file_log import write_log_batch, write_partitioned, write_topic_log
from spillway.sources import fixtures as fx
from spillway.sources.topic_log import read_file_log
from spillway.streaming import fs
from spillway.streaming.budgets import client_budgets
from spillway.streaming.metric_sink import read_points, write_points
from spillway.streaming.rates import closed_chunks
from spillway.streaming.transfer import Transfer, read_commits, run_transfers

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
CLICK = "click"
POINT_HOST = "spillway-host"
FAN_OUT_WRITERS = 4
THROUGHPUT_SECONDS = 1
DENSE_SECONDS = 1
IN_FLIGHT_SECONDS = 30
GAUGE_SECONDS = 60
BUDGET = 10
LATE_SECONDS = 3600       # how late an audit row may come
PART_SECONDS = 864_000    # of audit that arrive together
RETRIES = 2               # attempts after the first
FAILS_AT = f"{fx.REJECT_WHEN} and attempt <= second(timestamp) % 5"  # how often a record fails depends on the record
FLUSH_SIZE = 20           # records in a flush group
FLUSH_SECONDS = 86_400    # the fixture has few records a second


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return fx.events_log(spark, sf_dir)


def _show(df: DataFrame, *cols: str) -> DataFrame:
    """Payload columns as text."""
    return df.select(*[as_text(c).alias(c) if c in ("key", "value") else F.col(c) for c in cols])


def _scratch(spark: SparkSession, name: str) -> str:
    return under_state(spark, "spillway-queries", f"{name}-{uuid.uuid4().hex[:12]}")


def _stored(log: DataFrame) -> DataFrame:
    return positions.committed_offsets(positions.stored_positions(log, fx.FIXTURE_SUFFIX, fx.STORED_BEFORE))


def _start(log: DataFrame) -> DataFrame:
    return positions.as_start(positions.newest_offsets(log, before=fx.STORED_BEFORE))


def _listed(log: DataFrame) -> DataFrame:
    return positions.partition_list(log, fx.LISTED_PARTITIONS)


# ---- S: sources and positions ---------------------------------------------

def q_topic_source(spark, sf_dir):
    """The log written as a file log and read back through the source."""
    root = _scratch(spark, "topic_source")
    write_topic_log(_log(spark, sf_dir), root)
    back = read_file_log(spark, root)
    return _show(back.withColumn("timestamp", to_ntz("timestamp")),
                 "topic", "partition", "offset", "key", "value", "timestamp")


def q_start_position(spark, sf_dir):
    """Records a copy started at the stored-positions time would send."""
    log = _log(spark, sf_dir)
    return _show(positions.apply_start(log, _start(log)), "topic", "partition", "offset", "key", "value")


def q_reset_position(spark, sf_dir):
    """S3: copies of every topic are reset while records wait: the gap from the
    stored position to the newest offset is skipped for good."""
    root = _scratch(spark, "reset_position")
    log = _log(spark, sf_dir)
    _append_source(log.where(_before(fx.STORED_BEFORE)), root, 0)
    _run_copies(spark, root)
    _append_source(log.where(_before(fx.RESET_AT) & ~_before(fx.STORED_BEFORE)), root, 1)
    stored = positions.committed_offsets(read_commits(spark, f"{root}/state/commits").where("generation = 0"))
    _run_copies(spark, root, start_at="latest", reset=True)
    record = spark.read.parquet(f"{root}/state/generations").where("generation = 1 and partition >= 0")
    snap = record.select("topic", "partition", F.col("start_offset").alias("newest_offset"))
    return positions.reset_position(stored, snap, generation=1)


def q_newest_offsets(spark, sf_dir):
    """Log-end offset of every listed partition, empty ones included."""
    log = _log(spark, sf_dir)
    return positions.newest_offsets(log, _listed(log))


def q_committed_offsets(spark, sf_dir):
    """Stored position per (group, topic, partition)."""
    return _stored(_log(spark, sf_dir))


# ---- P / D: records --------------------------------------------------------

def q_topic_filter(spark, sf_dir):
    return _show(records.topic_filter(_log(spark, sf_dir), CLICK), "topic", "partition", "offset", "key", "value")


def q_record_projection(spark, sf_dir):
    return _show(records.record_projection(_log(spark, sf_dir)), "topic", "key", "value")


def q_null_to_empty(spark, sf_dir):
    return _show(records.null_to_empty(records.record_projection(_log(spark, sf_dir))), "topic", "key", "value")


def q_group_name(spark, sf_dir):
    topics = _log(spark, sf_dir).select("topic").distinct()
    return topics.select("topic", group_name("topic", fx.FIXTURE_SUFFIX).alias("group"))


def q_truncate_time(spark, sf_dir):
    log = _log(spark, sf_dir)
    return log.select("topic", "partition", "offset", to_ntz(truncate_time("timestamp")).alias("time"))


def q_round_robin_partition(spark, sf_dir):
    placed = records.place_round_robin(_log(spark, sf_dir), fx.FIXTURE_PARTITIONS)
    return placed.select("topic", F.col("partition").alias("source_partition"), "offset",
                         F.col("dst_partition").alias("partition"))


def _copy_all(log: DataFrame) -> DataFrame:
    placed = records.place_round_robin(log, fx.FIXTURE_PARTITIONS)
    sent = placed.select("topic", F.col("dst_partition").alias("partition"), "key", "value")
    return records.null_to_empty(sent)


def q_fan_out(spark, sf_dir):
    return _show(records.fan_out(_copy_all(_log(spark, sf_dir)), FAN_OUT_WRITERS), "topic", "partition", "key", "value")


# ---- K: sinks and delivery ---------------------------------------------------

def q_topic_sink(spark, sf_dir):
    """K1: one batch of a copy of the whole log, written to a file log with
    destination offsets and read back."""
    root = _scratch(spark, "topic_sink")
    _, plan = plan_counted(_log(spark, sf_dir), fx.FIXTURE_PARTITIONS)
    write_log_batch(plan.records, root, "copy", 0, 0)
    return _show(read_file_log(spark, root), "topic", "partition", "offset", "key", "value")


def q_failed_records(spark, sf_dir):
    """K4: per topic, records sent and records rejected by the predicate."""
    log = _log(spark, sf_dir).withColumn("_r", records.reject_flag(fx.REJECT_WHEN))
    return log.groupBy("topic").agg(
        F.sum((~F.col("_r")).cast("long")).alias("sent"), F.sum(F.col("_r").cast("long")).alias("rejected"))


def q_commit_position(spark, sf_dir):
    """K5: commit rows of a copy started at the stored-positions snapshot:
    the seed (batch -1) and the positions after one batch."""
    log = _log(spark, sf_dir)
    start = _start(log)
    plan = plan_copy_batch(log, fx.FIXTURE_PARTITIONS, start=start)
    group = group_name("topic", fx.FIXTURE_SUFFIX)
    seed = start.select(group.alias("group"), "topic", "partition", F.lit(-1).cast("long").alias("batch_id"),
                        F.col("start_offset").alias("next_offset"))
    done = plan.commits.select(group.alias("group"), "topic", "partition", F.lit(0).cast("long").alias("batch_id"),
                               "next_offset")
    return seed.unionByName(done).withColumn("generation", F.lit(0))


def _before(when: str):
    return F.col("timestamp") < F.to_timestamp(F.lit(when))


def _append_source(log: DataFrame, root: str, batch_id: int) -> None:
    write_topic_log(log, f"{root}/source", batch_id=batch_id)


def _copies(spark, root: str, **options) -> list[TransferOptions]:
    """One copy per topic of the source (names only, as a broker's topic list), from the earliest offset."""
    topics = [r.topic for r in read_file_log(spark, f"{root}/source").select("topic").distinct().collect()]
    given = {"start_at": "earliest", "state_path": f"{root}/state", "source": f"{root}/source", "destination": f"{root}/dest"}
    return [TransferOptions(topic=t, **(given | options)) for t in sorted(topics)]


def _run_copies(spark, root: str, **options) -> list[Transfer]:
    return run_transfers(spark, _copies(spark, root, **options))


def _whole_source(spark, sf_dir, name: str) -> str:
    root = _scratch(spark, name)
    _append_source(_log(spark, sf_dir), root, 0)
    return root


# The audit and commit queries copy with the reject predicate and a budget that
# cannot trip (every record may fail), so that every record is accounted for.
NO_BUDGET = 1 << 62
ALL_COUNTED = {"read_limit": 1, "reject_when": fx.REJECT_WHEN, "max_errors": NO_BUDGET}


def _audit_of(spark, root: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(f"{root}/state/audit")


def q_copy_audit(spark, sf_dir):
    """K4 + K5 + M1 from the engine itself: the audit totals of streaming
    copies of every topic (one file per batch), per group and client type."""
    root = _whole_source(spark, sf_dir, "copy_audit")
    _run_copies(spark, root, **ALL_COUNTED)
    return _audit_of(spark, root).groupBy("group", "client_type").agg(F.sum("n").cast("long").alias("n"),
                                                                      F.sum("rejected").cast("long").alias("rejected"))


def q_copy_commits(spark, sf_dir):
    """S5 after K5: stored positions of those copies, per partition."""
    root = _whole_source(spark, sf_dir, "copy_commits")
    _run_copies(spark, root, **ALL_COUNTED)
    return (positions.committed_offsets(read_commits(spark, f"{root}/state/commits"))
            .select("group", "topic", "partition", "next_offset"))


def q_retry_records(spark, sf_dir):
    """K3 + K4: copies whose failed records are tried again in later batches: attempts made per record, records dead
    after the last one, and what was sent according to the destination and to the audit."""
    root = _whole_source(spark, sf_dir, "retry_records")
    _run_copies(spark, root, offset_ranges=True, reject_when=FAILS_AT, retry_failed=True, max_retry=RETRIES, max_errors=NO_BUDGET)
    fs.mkdirs(spark, f"{root}/state/quarantine")
    place = ["topic", "partition", "offset"]
    tried = spark.read.schema(ATTEMPTS).parquet(f"{root}/state/attempts").groupBy(*place).agg(F.max("attempt").alias("tried"))
    dead = spark.read.schema(TOPIC_LOG).parquet(f"{root}/state/quarantine").select(*place, F.lit(True).alias("dead"))
    records = (read_file_log(spark, f"{root}/source").select(*place).join(tried, place, "left").join(dead, place, "left")
               .groupBy("topic", F.coalesce("tried", F.lit(1)).alias("attempts"), F.coalesce("dead", F.lit(False)).alias("dead"))
               .agg(F.count("*").alias("records")))
    sent = read_file_log(spark, f"{root}/dest").groupBy("topic").agg(
        F.count("*").alias("sent"), F.count_distinct("partition", "offset").alias("sent_offsets"))
    audit = _audit_of(spark, root).groupBy("topic").agg(
        F.sum(F.when(F.col("client_type") == "producer", F.col("n"))).alias("produced"), F.sum("rejected").alias("rejected"))
    return records.join(sent, "topic").join(audit, "topic")


class _Killed(Transfer):
    """A copy that dies between the sink and the positions of its first batch."""

    def _after_sink(self, batch_id: int) -> None:
        raise RuntimeError("killed between the sink and the commits")


def q_copy_replay(spark, sf_dir):
    """K1 + K5: every copy is killed after the sink of its first batch and run
    again: the destination with its offsets, as if nothing had happened."""
    root = _whole_source(spark, sf_dir, "copy_replay")
    for o in _copies(spark, root):
        killed = _Killed(spark, o)
        killed.start("available_now")
        try:
            killed.finish()
        except StreamingQueryException:
            pass
    _run_copies(spark, root)
    return _show(read_file_log(spark, f"{root}/dest"), "topic", "partition", "offset", "key", "value")


def q_copy_lag(spark, sf_dir):
    """M3 of real copies that began at the newest offsets, after more records came."""
    root = _scratch(spark, "copy_lag")
    log = _log(spark, sf_dir)
    _append_source(log.where(_before(fx.STORED_BEFORE)), root, 0)
    done = _run_copies(spark, root, start_at="latest")
    _append_source(log.where(~_before(fx.STORED_BEFORE)), root, 1)
    lags = [copy_lag(spark, t.opts) for t in done]
    return functools.reduce(DataFrame.unionByName, lags)


def q_copy_points(spark, sf_dir):
    """T2 of real copies with their monitors: what the points add up to, and
    whether every series has one point a second without gaps."""
    root = _whole_source(spark, sf_dir, "copy_points")
    _run_copies(spark, root, read_limit=1, metrics_path=f"{root}/points", host=POINT_HOST, monitor_seconds=0.5)
    rates = points.explode_points(read_points(spark, f"{root}/points")).where("field = 'rps'")
    seconds = F.unix_seconds(F.max("time").cast("timestamp")) - F.unix_seconds(F.min("time").cast("timestamp")) + 1
    return rates.groupBy("series").agg(F.sum("value").cast("long").alias("records"),
                                       (F.count("*") == F.count_distinct("time")).alias("no_duplicate"),
                                       (F.count_distinct("time") == seconds).alias("no_gap"))


def q_drain_stop(spark, sf_dir):
    """Copies of every topic run until the source is drained and then stop:
    what they read and sent, and what is left."""
    root = _whole_source(spark, sf_dir, "drain_stop")
    done = _run_copies(spark, root)
    counts = _audit_of(spark, root).groupBy("topic").agg(
        F.sum(F.when(F.col("client_type") == "consumer", F.col("n"))).alias("consumed"),
        F.sum(F.when(F.col("client_type") == "producer", F.col("n"))).alias("produced"))
    left = functools.reduce(DataFrame.unionByName, [metrics.total_lag(copy_lag(spark, t.opts)) for t in done])
    running = F.create_map(*[x for t in done for x in (F.lit(t.opts.topic), F.lit(t.query.isActive))])
    return counts.join(left.select("topic", "total_lag"), "topic").select(
        "topic", "consumed", "produced", F.col("total_lag").alias("waiting"), running[F.col("topic")].alias("running"))


DAYS_A_FILE = 5


def _filed_source(spark, sf_dir, name: str) -> str:
    """The log as one file for each topic and five days."""
    root = _scratch(spark, name)
    log = _log(spark, sf_dir)
    days = (log.withColumns({"group": F.lit("seed"), "generation": F.lit(0), "batch_id": whole_div(F.dayofyear("timestamp").cast("long"), DAYS_A_FILE)})
            .repartition("topic", "batch_id"))
    write_partitioned(days, f"{root}/source", ["topic", "group", "generation", "batch_id"])
    return root


def q_read_limit(spark, sf_dir):
    """One file in each micro-batch: the records of every batch, from the audit."""
    root = _filed_source(spark, sf_dir, "read_limit")
    _run_copies(spark, root, read_limit=1)
    read = _audit_of(spark, root).where("client_type = 'consumer'")
    return (read.groupBy("topic", "batch_id").agg(F.sum("n").cast("long").alias("records"), F.count("*").alias("partitions"))
            .select("topic", "records", "partitions"))


def q_flush_policy(spark, sf_dir):
    """K2: copies on the flush-interval trigger: no two batches begin in one interval."""
    root = _whole_source(spark, sf_dir, "flush_policy")
    interval = 1000
    running = [Transfer(spark, o) for o in _copies(spark, root, read_limit=1, flush_interval_ms=interval)]
    for t in running:
        t.start("interval")
    for t in running:
        t.query.processAllAvailable()
        t.stop()
    batches = (_audit_of(spark, root).where("client_type = 'consumer'").groupBy("topic", "batch_id")
               .agg(F.sum("n").alias("n"), whole_div(F.unix_millis(F.min("at")), interval).alias("slot")))
    return batches.groupBy("topic").agg(F.sum("n").cast("long").alias("records"),
                                        (F.count_distinct("slot") == F.count("*")).alias("one_batch_an_interval"))


def q_flush_interval(spark, sf_dir):
    """K2: the same over a source of several files a topic, one file a batch: how many batches there were, too."""
    root = _filed_source(spark, sf_dir, "flush_interval")
    interval = 1000
    running = [Transfer(spark, o) for o in _copies(spark, root, read_limit=1, flush_interval_ms=interval)]
    for t in running:
        t.start("interval")
    for t in running:
        t.query.processAllAvailable()
        t.stop()
    batches = (_audit_of(spark, root).where("client_type = 'consumer'").groupBy("topic", "batch_id")
               .agg(F.sum("n").alias("n"), whole_div(F.unix_millis(F.min("at")), interval).alias("slot")))
    return batches.groupBy("topic").agg(F.sum("n").cast("long").alias("records"), F.count("*").alias("batches"),
                                        (F.count_distinct("slot") == F.count("*")).alias("one_batch_an_interval"))


def q_flush_groups(spark, sf_dir):
    """K2: groups closed at a number of records or at the end of the interval."""
    grouped = flush.flush_groups(_log(spark, sf_dir), FLUSH_SIZE, FLUSH_SECONDS)
    return grouped.groupBy("topic", "interval", "flush_group").agg(
        F.count("*").alias("records"), F.min(F.struct("partition", "offset")).alias("first")).select(
        "topic", "interval", "flush_group", "records", F.col("first.partition").alias("first_partition"), F.col("first.offset").alias("first_offset"))


def q_record_limit(spark, sf_dir):
    """Copies by offset ranges, at most so many records a batch: the records of every batch, from the audit."""
    root = _whole_source(spark, sf_dir, "record_limit")
    _run_copies(spark, root, offset_ranges=True, read_limit=_share(spark, root))
    read = _audit_of(spark, root).where("client_type = 'consumer'")
    return read.groupBy("topic", "batch_id").agg(F.sum("n").cast("long").alias("records"))


def _share(spark, root: str) -> int:
    """A limit that makes some batches of a topic at any size of the log: a twelfth of all records."""
    return read_file_log(spark, f"{root}/source").count() // 12 + 1


class _Signalled(Transfer):
    """A copy that is asked to stop while its first batch runs."""

    def _after_sink(self, batch_id: int) -> None:
        self.request_stop()


def q_drain_signal(spark, sf_dir):
    """Copies are asked to stop in mid-batch.  Without a failed record the batch ends and commits and no further
    one begins; with one it stops at once.  Then they are run again: all records are there, once."""
    root = _whole_source(spark, sf_dir, "drain_signal")
    limit = _share(spark, root)
    out = []
    for failed in (False, True):
        mine = {"state_path": f"{root}/state-{failed}", "destination": f"{root}/dest-{failed}", "offset_ranges": True, "read_limit": limit}
        if failed:
            mine |= {"reject_when": fx.REJECT_WHEN, "max_errors": NO_BUDGET}
        copies = [_Signalled(spark, o) for o in _copies(spark, root, **mine)]
        for t in copies:
            t.start("interval")
        for t in copies:
            t.finish()
        found = {}
        for t in copies:
            read = t.audit().where("client_type = 'consumer'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            stored = positions.committed_offsets(t.commits()).agg(F.sum("next_offset")).first()[0]
            sent = read_file_log(spark, t.opts.destination, t.opts.topic).count()
            found[t.opts.topic] = (read, stored, sent == stored, t.query.isActive)
        _run_copies(spark, root, **(mine | {"read_limit": None}))
        for topic, row in found.items():
            out.append((topic, failed, *row, read_file_log(spark, f"{root}/dest-{failed}", topic).count()))
    return spark.createDataFrame(out, "topic string, failed boolean, read long, committed long, sent_is_committed boolean, running boolean, at_last long")


class _FailsOnce(Monitor):
    """A monitor whose first write fails."""

    failed = False

    def _write(self, rows: DataFrame, number: int) -> None:
        if not self.failed:
            self.failed = True
            raise RuntimeError("the metric store is away")
        super()._write(rows, number)


def q_monitor_lag(spark, sf_dir):
    """S4 + M3 + T2: a monitor's first tick fails, more records come, by another writer too, and its next tick
    writes the lag of every partition."""
    root = _scratch(spark, "monitor_lag")
    log = _log(spark, sf_dir)
    _append_source(log.where(_before(fx.STORED_BEFORE)), root, 0)
    done = _run_copies(spark, root)
    monitors = [_FailsOnce(spark, dataclasses.replace(t.opts, metrics_path=f"{root}/points", host=POINT_HOST), t) for t in done]
    now = int(time.time())
    for m in monitors:
        try:
            m.tick(now + 2)
        except RuntimeError:
            pass
    _append_source(log.where(_before(fx.RESET_AT) & ~_before(fx.STORED_BEFORE)), root, 7)
    write_topic_log(log.where(~_before(fx.RESET_AT)), f"{root}/source", group="other writer", batch_id=0)
    for m in monitors:
        m.tick(now + 4)
    rows = read_points(spark, f"{root}/points").where("measurement = 'kafka_stats'")
    return rows.select(F.col("tags")["topic"].alias("topic"), F.col("tags")["partition"].cast("int").alias("partition"),
                       F.col("fields")["currentOffset"].alias("current_offset"), F.col("fields")["newestOffset"].alias("newest_offset"))


def q_fold_chain(spark, sf_dir):
    """K1: copies whose destination is folded as they run, and copies of that destination by offset ranges: what
    arrives at the second one."""
    root = _whole_source(spark, sf_dir, "fold_chain")
    ranged = {"offset_ranges": True, "read_limit": _share(spark, root)}
    _run_copies(spark, root, keep_manifest=True, fold_batches=2, **ranged)
    _run_copies(spark, root, source=f"{root}/dest", destination=f"{root}/second", group_suffix="second", **ranged)
    return _show(read_file_log(spark, f"{root}/second"), "topic", "key", "value")


def q_delivery_options(spark, sf_dir):
    """K3: the codec of the destination's files, from their names, with the records in them."""
    root = _whole_source(spark, sf_dir, "delivery_options")
    _run_copies(spark, root)
    sent = spark.read.parquet(f"{root}/dest").select("topic", F.regexp_extract("_metadata.file_name", r"\.(\w+)\.parquet$", 1).alias("codec"))
    return sent.groupBy("topic", "codec").agg(F.count("*").alias("records"))


def q_error_budget(spark, sf_dir):
    """Per user, the error event that goes over a budget of 10."""
    events = fx.table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return budget.budget_trips(events, ["user_id"], "event_id", BUDGET)


def q_client_budgets(spark, sf_dir):
    """C1 in a stream: one budget per user over error events that arrive in three parts, with a restart behind the
    first; the event that goes over, per user."""
    root = _scratch(spark, "client_budgets")
    errors = fx.table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("user_id", "event_id", "ts")
    late, later = (F.lit(day).cast("timestamp_ntz") for day in (fx.STORED_BEFORE, fx.RESET_AT))
    schema = errors.schema
    for part in (errors.where(F.col("ts") < late), errors.where((F.col("ts") >= late) & (F.col("ts") < later)), errors.where(F.col("ts") >= later)):
        part.write.mode("append").parquet(f"{root}/errors")
        stream = spark.readStream.schema(schema).parquet(f"{root}/errors")
        (client_budgets(stream, "user_id", "event_id", BUDGET).writeStream.option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).format("parquet").start(f"{root}/trips").awaitTermination())
    return spark.read.parquet(f"{root}/trips")


# ---- M: metrics ----------------------------------------------------------------

def _audit(spark, sf_dir):
    return fx.replay_audit(_log(spark, sf_dir))


def q_throughput(spark, sf_dir):
    return metrics.throughput(_audit(spark, sf_dir), THROUGHPUT_SECONDS)


def q_dense_throughput(spark, sf_dir):
    """M2 at its cadence of one second, idle seconds included; reported as one
    row a minute that holds the minute's values in order."""
    return metrics.packed_throughput(_audit(spark, sf_dir), DENSE_SECONDS)


def _lag(log: DataFrame) -> DataFrame:
    return metrics.lag_of_log(log, _listed(log), fx.STORED_BEFORE, group_name("topic", fx.FIXTURE_SUFFIX))


def q_partition_lag(spark, sf_dir):
    return _lag(_log(spark, sf_dir))


def q_total_lag(spark, sf_dir):
    return metrics.total_lag(_lag(_log(spark, sf_dir)))


def q_stream_throughput(spark, sf_dir):
    """M1 + M2 as a stream: the audit arrives in parts, up to an hour late and in no order, with restarts between the
    parts; a row behind the last second lets the last minute close."""
    root = _scratch(spark, "stream_throughput")
    audit = _audit(spark, sf_dir).select("topic", "client_type", "n", "at")
    late = F.pmod(F.xxhash64("topic", "client_type", "at"), F.lit(LATE_SECONDS))
    parts = audit.withColumn("part", whole_div(F.unix_seconds("at") + late, PART_SECONDS))
    write_partitioned(parts, f"{root}/parts", ["part"])
    span = audit.agg(F.unix_seconds(F.min("at")).alias("lo"), F.unix_seconds(F.max("at")).alias("hi")).first()
    end = audit.limit(1).select("topic", "client_type", F.lit(0).cast("long").alias("n"),
                                F.timestamp_seconds(F.lit((span["hi"] or 0) + LATE_SECONDS + 2 * metrics.DENSE_CHUNK)).alias("at"))
    found = sorted(int(n) for n in fs.child_values(spark, f"{root}/parts", "part"))
    for part in [spark.read.schema(audit.schema).parquet(f"{root}/parts/part={n}") for n in found] + [end]:
        part.write.mode("append").parquet(f"{root}/audit")
        chunks = closed_chunks(spark.readStream.schema(audit.schema).parquet(f"{root}/audit"), span["lo"] or 0, f"{LATE_SECONDS} seconds")
        (chunks.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .format("parquet").start(f"{root}/closed").awaitTermination())
    closed = spark.read.parquet(f"{root}/closed").where(F.col("start") <= F.lit(span["hi"]))
    return closed.select("topic", "client_type", F.timestamp_seconds("start").cast("timestamp_ntz").alias("start"), "records")


def q_in_flight(spark, sf_dir):
    return metrics.in_flight(_audit(spark, sf_dir), IN_FLIGHT_SECONDS)


def q_gauge_sample(spark, sf_dir):
    ensure_utc(spark)
    return _gauges(spark, sf_dir)


# ---- T: points ---------------------------------------------------------------

def _gauges(spark, sf_dir) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    return metrics.gauge_sample(events.withColumn("host", F.col("user_id").cast("string")),
                                ["host"], ["value"], "ts", "event_id", GAUGE_SECONDS)


def _points(spark, sf_dir) -> DataFrame:
    log = _log(spark, sf_dir)
    lag_points = points.kafka_stats_points(_lag(log), POINT_HOST, F.to_timestamp(F.lit(fx.STORED_BEFORE)))
    rate_points = points.rps_points(metrics.throughput(fx.replay_audit(log), THROUGHPUT_SECONDS), POINT_HOST)
    # system_stats: one point per host and minute; the gauge is the latest value, as an integer field
    samples = _gauges(spark, sf_dir).withColumn("value", F.floor("value").cast("long"))
    system = points.system_points(samples, F.col("host"), ["value"])
    return points.to_points(lag_points, rate_points, system)


def q_to_points(spark, sf_dir):
    return points.explode_points(_points(spark, sf_dir))


def q_metric_sink(spark, sf_dir):
    root = _scratch(spark, "metric_sink")
    write_points(_points(spark, sf_dir), root, "catalog", 0)
    return points.explode_points(read_points(spark, root))


QUERIES: dict[str, Query] = {
    "topic_source": q_topic_source,
    "start_position": q_start_position,
    "reset_position": q_reset_position,
    "newest_offsets": q_newest_offsets,
    "committed_offsets": q_committed_offsets,
    "topic_filter": q_topic_filter,
    "record_projection": q_record_projection,
    "null_to_empty": q_null_to_empty,
    "group_name": q_group_name,
    "truncate_time": q_truncate_time,
    "round_robin_partition": q_round_robin_partition,
    "fan_out": q_fan_out,
    "topic_sink": q_topic_sink,
    "failed_records": q_failed_records,
    "commit_position": q_commit_position,
    "error_budget": q_error_budget,
    "client_budgets": q_client_budgets,
    "drain_stop": q_drain_stop,
    "read_limit": q_read_limit,
    "copy_audit": q_copy_audit,
    "copy_commits": q_copy_commits,
    "copy_replay": q_copy_replay,
    "retry_records": q_retry_records,
    "copy_lag": q_copy_lag,
    "copy_points": q_copy_points,
    "flush_policy": q_flush_policy,
    "flush_interval": q_flush_interval,
    "flush_groups": q_flush_groups,
    "record_limit": q_record_limit,
    "drain_signal": q_drain_signal,
    "monitor_lag": q_monitor_lag,
    "fold_chain": q_fold_chain,
    "delivery_options": q_delivery_options,
    "throughput": q_throughput,
    "dense_throughput": q_dense_throughput,
    "partition_lag": q_partition_lag,
    "total_lag": q_total_lag,
    "stream_throughput": q_stream_throughput,
    "in_flight": q_in_flight,
    "gauge_sample": q_gauge_sample,
    "to_points": q_to_points,
    "metric_sink": q_metric_sink,
}
