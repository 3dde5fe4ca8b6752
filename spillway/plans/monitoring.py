"""Monitoring of a copy: the reference's lag, rate and gauge points, from the
copy's own tables.

    newest offsets of the source (S4) + stored positions of the group (S5)
        -> partition lag (M3) -> kafka_stats points (T1)
    audit rows of closed seconds -> throughput (M1), dense (M2) -> rps_stats points
    audit rows -> gauges of the last batch, records in flight (M5, M6) -> system_stats points
        -> one write to the metric table (T2) per tick

`Monitor` runs beside a copy.  A tick covers the seconds since the last one up
to the first second that a batch may still add to, idle seconds included, and
remembers where it ended; so every second of every series is written once,
whatever the number of ticks, restarts or batches in a second.  Newest offsets
come from the manifest of the source (`Transfer.source_ends`), which has an entry
for each batch folder: a tick reads the folders that came since, in whatever order
they appeared, and a tick that fails loses none of them.
"""

from __future__ import annotations

import datetime as _dt
import logging
import threading
import time

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.operators import metrics, points, positions
from spillway.options import TransferOptions
from spillway.schema import CONSUMER, PRODUCER
from spillway.session import under_state
from spillway.sources.topic_log import read_file_log, topic_source
from spillway.streaming import fs
from spillway.streaming.metric_sink import write_points
from spillway.streaming.progress import BATCH_GAUGES, batch_gauges, parse_offsets
from spillway.streaming.state import read_table

GAUGE_SECONDS = 60   # cadence of system_stats, as the reference's
TICKS = "until long, gauged long, in_flight long"
KEPT_TICKS = 2       # records of ticks; only the last complete one is read
OFFSETS = "topic string, partition int, newest_offset long"

_log = logging.getLogger(__name__)


def _root(spark: SparkSession, opts: TransferOptions) -> str:
    return (opts.state_path or under_state(spark, "spillway")).rstrip("/")


def commits_of(spark: SparkSession, opts: TransferOptions) -> DataFrame:
    return read_table(spark, _root(spark, opts), "commits", opts.group)


def audit_of(spark: SparkSession, opts: TransferOptions) -> DataFrame:
    return read_table(spark, _root(spark, opts), "audit", opts.group)


def newest_from_progress(spark: SparkSession, progress: dict) -> DataFrame:
    """Newest offsets as a Kafka source reports them in a query's progress
    (`latestOffset` = {topic: {partition: offset}}): broker metadata, one row
    per partition, no scan of the topic."""
    rows = []
    for src in progress.get("sources", []):
        latest = src.get("latestOffset")
        if isinstance(latest, str):
            rows += parse_offsets(latest)
    return spark.createDataFrame(rows, OFFSETS)


def copy_lag(spark: SparkSession, opts: TransferOptions, newest: DataFrame | None = None,
             partitions: int | None = None) -> DataFrame:
    """M3 for a copy: every partition of the source topic with its stored
    position and lag.  `newest` defaults to a scan of the source (file log);
    on Kafka pass `newest_from_progress(...)`.  `partitions` lists partitions
    0..n-1 even when empty."""
    if newest is None:
        src = topic_source(spark, opts, stream=False)
        listed = positions.partition_list(src, partitions) if partitions else None
        newest = positions.newest_offsets(src, listed)
    committed = positions.committed_offsets(commits_of(spark, opts))
    return metrics.partition_lag(newest, committed, opts.group)


class Monitor:
    """Writes the points of one copy while it runs (and once more when it ends)."""

    def __init__(self, spark: SparkSession, opts: TransferOptions, transfer) -> None:
        if not opts.metrics_path:
            raise ValueError("metrics_path is not set")
        self.spark, self.opts, self.transfer = spark, opts, transfer
        self.writer = f"{opts.group}-g{transfer.generation}"
        self.root = f"{_root(spark, opts)}/monitor/group={opts.group}/generation={transfer.generation}"
        self.ticks = max((int(t) for t in fs.child_values(spark, self.root, "tick")
                          if fs.exists(spark, f"{self.root}/tick={t}/_SUCCESS")), default=-1)
        opened = int(transfer._opened_at.timestamp())  # noqa: SLF001 - of the same package
        self.until, self.gauged, self.in_flight = opened, opened - GAUGE_SECONDS, 0
        if self.ticks >= 0:
            last = spark.read.schema(TICKS).parquet(f"{self.root}/tick={self.ticks}").first()
            self.until, self.gauged, self.in_flight = (last[c] for c in ("until", "gauged", "in_flight"))
        self._ended = threading.Event()
        self._thread: InheritableThread | None = None

    # ---- newest offsets ---------------------------------------------------
    def _newest(self, _tick: int | None = None) -> DataFrame:
        """Newest offsets, of whatever tick; a table of one row per partition."""
        if self.opts.source_format == "kafka":
            return newest_from_progress(self.spark, self.transfer.query.lastProgress or {})
        return self.spark.createDataFrame([(self.opts.topic, p, end) for p, end in self.transfer.source_ends().items()], OFFSETS)

    # ---- one tick -----------------------------------------------------------
    def tick(self, until: int | None = None) -> bool:
        """Write the points of the seconds from the last tick to `until` (exclusive); False if there are none."""
        until = self.transfer.open_second() if until is None else until
        if until <= self.until:
            return False
        number, host, topic = self.ticks + 1, self.opts.host, self.opts.topic
        # One clock for all: epoch seconds.
        second = F.unix_seconds("at")
        closed = audit_of(self.spark, self.opts).where((F.col("generation") == self.transfer.generation) & (second < until))
        audit = closed.where(second >= self.until)
        rates = metrics.throughput(audit, 1)
        zeros = (self.spark.range(self.until, until)
                 .select(F.lit(topic).alias("topic"), F.explode(F.array(F.lit(CONSUMER), F.lit(PRODUCER))).alias("client_type"),
                         F.timestamp_seconds("id").cast("timestamp_ntz").alias("time"), F.lit(0).cast("long").alias("records")))
        dense = rates.unionByName(zeros).groupBy("topic", "client_type", "time").agg(F.sum("records").alias("records"))
        at = _dt.datetime.fromtimestamp(until, _dt.timezone.utc)
        self.transfer.seed_from_checkpoint()
        lag = copy_lag(self.spark, self.opts, self._newest()) if self._has_positions() else None
        sets = [points.rps_points(dense, host)]
        if lag is not None:
            sets.append(points.kafka_stats_points(lag, host, F.lit(at)))
        moved = audit.agg(F.sum(F.when(F.col("client_type") == CONSUMER, F.col("n") - F.col("rejected"))
                                .otherwise(-F.col("n"))).alias("n")).first()["n"]
        in_flight, gauged = self.in_flight + int(moved or 0), self.gauged
        if until - self.gauged >= GAUGE_SECONDS:
            # The last batch since the last sample: a tick may be shorter than the time between two batches.
            last = batch_gauges(closed.where(second >= self.gauged), host).agg(*(F.max_by(g, "batch_id").alias(g) for g in BATCH_GAUGES))
            sample = last.select(*(F.coalesce(g, F.lit(0)).alias(g) for g in BATCH_GAUGES), F.lit(in_flight).cast("long").alias("in_flight"))
            sets.append(points.system_points(sample, host, [*BATCH_GAUGES, "in_flight"], F.lit(at)))
            gauged = until
        self._write(points.to_points(*sets), number)
        self.spark.createDataFrame([(until, gauged, in_flight)], TICKS).coalesce(1) \
            .write.mode("overwrite").parquet(f"{self.root}/tick={number}")
        for old in map(int, fs.child_values(self.spark, self.root, "tick")):
            if old <= number - KEPT_TICKS:
                fs.delete(self.spark, f"{self.root}/tick={old}")
        self.ticks, self.until, self.gauged, self.in_flight = number, until, gauged, in_flight
        return True

    def _write(self, rows: DataFrame, number: int) -> None:
        write_points(rows, self.opts.metrics_path, self.writer, number)

    def _has_positions(self) -> bool:
        return fs.exists(self.spark, fs.partition_folder(self.spark, f"{_root(self.spark, self.opts)}/commits", group=self.opts.group))

    # ---- beside a copy --------------------------------------------------------
    def start(self) -> None:
        self._thread = InheritableThread(target=self._run, daemon=True)
        self._thread.start()

    def _run(self) -> None:
        while not self._ended.wait(self.opts.monitor_seconds):
            try:
                self.tick()
            except Exception:  # noqa: BLE001 - as the reference: logged; the next tick covers these seconds too
                _log.exception("monitoring tick failed")

    def finish(self) -> None:
        """Stop, and write the seconds up to now; the copy must have ended."""
        self._ended.set()
        if self._thread is not None:
            self._thread.join()
        until = int(time.time()) + 1
        self.tick(until)
        time.sleep(max(0.0, until - time.time()))  # a copy that starts now begins behind what was written
