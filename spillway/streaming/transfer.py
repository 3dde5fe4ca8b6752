"""The continuous copy as one Structured Streaming query.

    source stream --foreachBatch--> sink, then audit, commits, quarantine

* Generations (S2, S3, S5): a new checkpoint is opened by one durable record,
  written before anything else of it: the source's start offsets, the
  destination's next free offset and the time.  Positions are seeded from it as
  batch -1, for every kind of start.  A restart goes on with the newest record;
  a reset opens the next one.  Old generations' folders are never deleted.
* Start (S2): "latest" starts at the newest offsets, frozen in the record
  (recomputing them on a restart would skip what arrived between); "earliest"
  at 0.  On Kafka `startingOffsets` does the same, and the seeds are read from
  the first offsets in the query's checkpoint.
* Delivery (K1, K5): a batch's folder appears whole, and a replayed batch keeps
  the folders that are already there.  Destination offsets depend on the
  generation's record and on the audit of earlier batches of it, never on what
  an unfinished batch left behind.  So a replay changes nothing that a reader of
  the destination may have seen; positions are committed after the sink
  (at-least-once on Kafka, exactly once on a file log).
* Failed records (K4): records matching `reject_when` are not sent; they are
  counted in the audit table and kept in a quarantine table.
* Retries (K3, K4): with `retry_failed` a record that fails is tried again in
  later batches, from an attempt log that the query reads as its second source,
  and counts as failed after its last attempt (`spillway.streaming.attempts`).
* Error budget (C1): the reject total of this run is one number kept on the
  driver.  It is checked *before* each batch: the batch that goes over the
  limit is finished and committed, the next refuses to start, so a restart (a
  new run, a fresh budget) goes on behind it instead of replaying it forever.
  `finish()` checks once more after the query ends; both raise `BudgetExceeded`.
* Drain (C2): `trigger="available_now"` runs until the source is empty and
  stops.  A requested stop (a signal) lets the batch that runs finish and commit,
  and no further one begin, so nothing is left to replay; if a record of this run
  has failed, it stops at once.  `stop()` stops at once, too (an unfinished batch is
  replayed on restart).
* Batches (C3): nothing of a batch is cached; its source is read once for the
  offset ranges and once for the write.  `read_limit` bounds records (Kafka, and
  with `offset_ranges` a file log) or files, `batch_bytes` the bytes of a file
  log's batch.
* Offset ranges (S1, C3): with `offset_ranges` the stream carries a range a
  partition and each batch reads its records from the folders that the manifest
  names.  Starts are ranges, too: nothing is scanned for them, no join filters them.
"""

from __future__ import annotations

import datetime as _dt
import functools
import logging
import threading
import time
import uuid

from pyspark import InheritableThread
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spillway.operators.budget import BudgetExceeded, over_budget
from spillway.operators.positions import as_start, newest_offsets, seed_rows
from spillway.operators.records import fan_out
from spillway.options import TransferOptions
from spillway.plans.copy import Observed, plan_counted, with_gauges
from spillway.schema import GENERATIONS, PRODUCER
from spillway.session import under_state
from spillway.sinks.file_log import run_concurrently, write_kafka_batch, write_log_batch, write_once, write_table_batch
from spillway.sources.manifest import ManifestLog, kept_beside, own_folder
from spillway.sources.ranges import read_range_stream
from spillway.sources.topic_log import read_file_log, topic_source
from spillway.streaming import fs
from spillway.streaming.attempts import dead_letters, next_attempts, read_attempts, retry, with_waiting
from spillway.streaming.progress import first_offsets
from spillway.streaming.state import fold, read_table


_log = logging.getLogger(__name__)
POLL_SECONDS = 1.0


class _Stopped(Exception):
    """Raised in a batch that may not begin, or not go on, once a stop was requested."""


class Transfer:
    """One copy of one topic.  `start()` returns the running StreamingQuery."""

    def __init__(self, spark: SparkSession, opts: TransferOptions):
        self.spark = spark
        self.opts = opts
        self.root = (opts.state_path or under_state(spark, "spillway")).rstrip("/")
        self.group = opts.group
        self.run_id = uuid.uuid4().hex
        self.rejected_total = 0
        self.batches: list[int] = []
        self.generation = self._pick_generation()
        self._start: DataFrame | None = None
        self._scan_filter = None
        self._base = 0                              # the destination's next free offset when the generation began
        self._opened_at: _dt.datetime | None = None
        self._next: tuple[int, int] | None = None  # (next batch id, destination base)
        self.query: StreamingQuery | None = None
        self._trip: BudgetExceeded | None = None
        self._stop_requested = False
        self.live: dict[str, int] | None = None  # records, bytes and failed records of the batch written last
        self._rejected_now = 0         # of the batch that runs
        self._gate = threading.Lock()  # no batch begins once it is closed
        self._closed = self._busy = self._refused = False
        self._drains = False
        self._index: ManifestLog | None = None
        self._ended = threading.Event()
        self._clock_lock = threading.Lock()
        self._running_at: _dt.datetime | None = None  # begin of the batch that runs now
        self._monitor = None

    # ---- folders -------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def folder(self, table_root: str, batch_id: int, **first) -> str:
        return fs.partition_folder(self.spark, table_root, **first, group=self.group, generation=self.generation,
                                   batch_id=batch_id)

    @property
    def checkpoint(self) -> str:
        return f"{self.path('checkpoints')}/group={self.group}/generation={self.generation}"

    @property
    def attempts(self) -> str:
        """The attempt log of this generation (`retry_failed`)."""
        return fs.partition_folder(self.spark, self.path("attempts"), group=self.group, generation=self.generation)

    @property
    def record_path(self) -> str:
        return f"{self.path('generations')}/group={self.group}/generation={self.generation}"

    @property
    def index(self) -> ManifestLog:
        """The manifest of the source file log: its writer's, else one of this copy's own."""
        if self._index is None:
            o = self.opts
            self._mine = not kept_beside(self.spark, o.source, o.topic)
            folder = fs.partition_folder(self.spark, self.path("source-manifests"), group=self.group)
            self._index = ManifestLog(self.spark, o.source, o.topic, folder if self._mine else own_folder(self.spark, o.source, o.topic))
        return self._index

    def source_ends(self) -> dict[int, int]:
        """Partition -> newest offset of the source file log; reads what came since it was asked last."""
        index = self.index
        return (index.refresh() if self._mine else index.load()).newest

    # ---- generations ---------------------------------------------------
    def _pick_generation(self) -> int:
        """The newest recorded generation, or the next one where none is recorded or a reset is asked for."""
        root = f"{self.path('generations')}/group={self.group}"
        gens = [int(g) for g in fs.child_values(self.spark, root, "generation")
                if fs.exists(self.spark, f"{root}/generation={g}/_SUCCESS")]
        if not gens:
            return 0
        return max(gens) + 1 if self.opts.reset else max(gens)

    def _freeze_start(self) -> None:
        """Open the generation (or reload its record), then seed its positions."""
        o = self.opts
        if not fs.exists(self.spark, f"{self.record_path}/_SUCCESS"):
            starts = self._start_offsets()
            own = self.spark.createDataFrame(
                [(o.topic, -1, None, self._destination_end(), o.start_at, _dt.datetime.now(_dt.timezone.utc))], GENERATIONS)
            known = starts.select("topic", "partition", "start_offset").withColumns(
                {"base": F.lit(None).cast("long"), "start_at": F.lit(None).cast("string"), "opened_at": F.lit(None).cast("timestamp")})
            known.unionByName(own).coalesce(1).write.mode("overwrite").parquet(self.record_path)
        record = self.spark.read.schema(GENERATIONS).parquet(self.record_path)
        own = record.where("partition = -1").first()
        self._base, self._opened_at = int(own["base"]), own["opened_at"]
        starts = record.where("partition >= 0").select("topic", "partition", "start_offset")
        if o.source_format == "file":
            self._seed(starts)
            if o.offset_ranges:
                self._starts = {r["partition"]: r["start_offset"] for r in starts.collect()}  # one row per partition
            elif own["start_at"] == "latest":
                self._start = starts
                self._scan_filter = self._start_predicate()

    def _start_offsets(self) -> DataFrame:
        """(topic, partition, start_offset) of the partitions the source has now; none on Kafka."""
        o = self.opts
        if o.source_format == "kafka" or not fs.exists(self.spark, f"{o.source.rstrip('/')}/topic={o.topic}"):
            return self.spark.createDataFrame([], "topic string, partition int, start_offset long")
        if o.offset_ranges:
            ends = self.source_ends()
            return self.spark.createDataFrame([(o.topic, p, e if o.start_at == "latest" else 0) for p, e in ends.items()],
                                              "topic string, partition int, start_offset long")
        log = read_file_log(self.spark, o.source, o.topic)
        if o.start_at == "earliest":
            return log.select("topic", "partition").distinct().withColumn("start_offset", F.lit(0).cast("long"))
        return as_start(newest_offsets(log))

    def _seed(self, starts: DataFrame) -> None:
        write_once(self.spark, self.folder(self.path("commits"), -1), lambda: write_table_batch(
            seed_rows(starts, self.group, self.generation), self.path("commits"), self.group, self.generation, -1))

    def seed_from_checkpoint(self) -> None:
        """Kafka: seed the positions with the offsets the query began at, once its checkpoint names them."""
        if self.opts.source_format != "kafka" or fs.exists(self.spark, self.folder(self.path("commits"), -1)):
            return
        found = first_offsets(self.spark, self.checkpoint)
        if found:
            self._seed(self.spark.createDataFrame(found, "topic string, partition int, start_offset long"))

    def _start_predicate(self):
        """A constant predicate implied by the frozen start, for the parquet
        scan: row groups wholly before the smallest start are skipped by their
        footer statistics instead of being read and dropped by the join.
        Partitions not in the record (created later) start at 0.  The exact
        filter stays the join.  One row per partition is read here."""
        known = self._start.collect()
        if not known:
            return None
        return (F.col("offset") >= F.lit(min(r["start_offset"] for r in known))) | ~F.col("partition").isin(
            [r["partition"] for r in known])

    @functools.cached_property
    def destination_manifest(self) -> ManifestLog:
        return ManifestLog(self.spark, self.opts.destination, self.opts.topic)

    # ---- destination base ------------------------------------------------
    def _audit_end(self, condition) -> int:
        """The largest destination slot that audit rows of this group reserved."""
        rows = self.audit().where(F.col("client_type") == PRODUCER).where(condition)
        return int(rows.agg(F.max("until_offset")).first()[0] or 0)

    def _destination_end(self) -> int:
        """The next free destination offset when a generation begins."""
        if self.opts.destination_format != "file" or not fs.exists(self.spark, self.opts.destination):
            return 0
        if self.opts.keep_manifest:
            there = max(self.destination_manifest.refresh().newest.values(), default=0)
        else:
            last = read_file_log(self.spark, self.opts.destination, self.opts.topic).agg(F.max("offset")).first()[0]
            there = 0 if last is None else int(last) + 1
        return max(there, self._audit_end(F.col("generation") < self.generation))

    def _destination_base(self, batch_id: int) -> int:
        """Next free destination offset before `batch_id`: from the record and
        the audit of this generation's earlier batches only.  Read once per
        run; afterwards carried on the driver as one number."""
        if self._next is not None and self._next[0] == batch_id:
            return self._next[1]
        earlier = (F.col("generation") == self.generation) & (F.col("batch_id") < batch_id)
        return max(self._base, self._audit_end(earlier) if batch_id else 0)

    # ---- one micro-batch -------------------------------------------------
    def _batch(self, df: DataFrame, batch_id: int) -> None:
        if over_budget(self.rejected_total, self.opts.max_errors):
            self._trip = self._over()
            raise self._trip
        with self._gate:
            if self._closed or self._stop_requested:
                self._refused = True
                raise _Stopped("no batch begins after a requested stop")
            self._busy = True
        with self._clock_lock:
            self._running_at = _dt.datetime.now(_dt.timezone.utc)
        try:
            log, waited = df, []
            if self.opts.offset_ranges:
                told = df.distinct().collect()  # one row per partition, and one per folder of the attempt log
                log = self.index.read_ranges([tuple(r)[:3] for r in told if r["partition"] is not None])
                waited = [r["waiting"] for r in told if r["partition"] is None]
            self._copy(log, batch_id, self._running_at, waited)
        finally:
            self._rejected_now = 0
            with self._clock_lock:
                self._running_at = None
            with self._gate:
                self._busy = False

    def _go_on(self) -> None:
        """A stop after a failed record ends the batch where it is (C2): it is replayed on restart."""
        if self._stop_requested and self.rejected_total + self._rejected_now > 0:
            self._refused = True
            raise _Stopped("stopped at once: records of this run have failed")

    def _copy(self, df: DataFrame, batch_id: int, began: _dt.datetime, waited: list[int]) -> None:
        o, begin, observed, counts = self.opts, time.monotonic(), Observed(), None
        self.seed_from_checkpoint()
        base, at = self._destination_base(batch_id), F.lit(began).cast("timestamp")
        if o.retry_failed:
            df = df.withColumn("attempt", F.lit(1))
        rows, plan = plan_counted(df, o.destination_partitions, self._start, o.reject_when, o.preserve_nulls, base, at, observed)
        failed, width = sum(r["rejected"] or 0 for r in rows), sum(r["_span"] for r in rows)
        again = None
        if waited:
            again = retry(read_attempts(self.spark, self.attempts, waited), batch_id, o.max_retry, o.reject_when,
                          o.destination_partitions, o.preserve_nulls, base + width, at)
        tries = o.retry_failed and o.max_retry > 0
        rejected = (0 if tries else failed) + (again.dead if again else 0)
        self._rejected_now = int(rejected)
        self._go_on()
        if rows or again:  # else nothing at or after the start position
            sent = [plan.records] if rows else []
            if again and again.records is not None:
                sent.append(again.records)
            if sent:
                records = fan_out(functools.reduce(DataFrame.unionByName, sent), o.producer_concurrency)
                if o.destination_format != "file":
                    write_kafka_batch(records, o)
                    written = True
                else:
                    written = write_once(self.spark, self.folder(o.destination, batch_id, topic=o.topic), lambda: write_log_batch(
                        records, o.destination, self.group, self.generation, batch_id, o.compression))
                counts = observed.get() if written and rows else None
            self._after_sink(batch_id)
            self._go_on()
            self.live = counts or self.live
            audit = plan.audit.withColumn("rejected", F.lit(0).cast("long")) if tries else plan.audit
            audit = with_gauges(audit, rows, counts)
            if again:
                audit = audit.unionByName(with_gauges(again.audit, [], None))
            audit = audit.withColumns({"took_ms": F.lit(round((time.monotonic() - begin) * 1000)).cast("long"), "run_id": F.lit(self.run_id)})
            if o.destination_format == "kafka":  # the broker assigns destination offsets
                planned_only = F.col("client_type") == PRODUCER
                audit = (audit.withColumn("from_offset", F.when(~planned_only, F.col("from_offset")))
                              .withColumn("until_offset", F.when(~planned_only, F.col("until_offset"))))
            tables = {"audit": audit, "commits": plan.commits.withColumn("generation", F.lit(self.generation))}
            lost = plan.rejected
            if o.retry_failed:
                lost = plan.rejected.unionByName(again.failed) if again else plan.rejected
                if tries and failed or again and again.waiting:
                    waiting = next_attempts(lost, batch_id, o.max_retry)
                    tables["attempts"] = waiting.unionByName(again.later) if again else waiting
                lost = dead_letters(lost, o.max_retry)
            if o.quarantine and rejected:
                tables["quarantine"] = lost
            # After the sink, the state tables are independent small writes: run
            # them as concurrent jobs (a failed batch is replayed; tables already
            # there stay).
            run_concurrently([lambda t=t, d=d: self._write_table(t, d, batch_id) for t, d in tables.items()])
            if o.keep_manifest:
                self.destination_manifest.refresh()
        self.rejected_total, self._rejected_now = self.rejected_total + int(rejected), 0
        self._next = (batch_id + 1, base + int(width) + (again.width if again else 0))
        self.batches.append(batch_id)
        if len(self.batches) % o.fold_batches == 0:
            fold(self.spark, self.root, self.group, self.generation)
            if o.keep_manifest:
                self.destination_manifest.fold(o.fold_batches, o.compression)

    def _write_table(self, table: str, rows: DataFrame, batch_id: int) -> None:
        write_once(self.spark, self.folder(self.path(table), batch_id), lambda: write_table_batch(
            rows, self.path(table), self.group, self.generation, batch_id))

    def _over(self) -> BudgetExceeded:
        return BudgetExceeded(f"{self.rejected_total} failed records in run {self.run_id} > max_errors={self.opts.max_errors}")

    def open_second(self) -> int:
        """The first second (epoch) that a batch may still add records to."""
        with self._clock_lock:
            return int((self._running_at or _dt.datetime.now(_dt.timezone.utc)).timestamp())

    def _after_sink(self, batch_id: int) -> None:
        """Called between the sink write and the commits; a failure here is
        the worst case for delivery (tests override it)."""

    # ---- life cycle ------------------------------------------------------
    def start(self, trigger: str = "interval") -> StreamingQuery:
        """trigger: "interval" (every flush interval), "available_now" (drain
        and stop) or "once"."""
        if self.opts.source_format == "file":
            # A topic with no records yet is an empty folder (as a created,
            # empty Kafka topic): the stream then picks files up as they come.
            fs.mkdirs(self.spark, f"{self.opts.source.rstrip('/')}/topic={self.opts.topic}")
        self._freeze_start()
        if self.opts.offset_ranges:
            self.source_ends()
            stream = read_range_stream(self.spark, self.index.folder, self._starts, self.opts.read_limit)
            if self.opts.retry_failed:
                stream = with_waiting(stream, self.attempts)
            # A drain is one batch after the other until nothing waits (the trigger of Spark would end after one).
            self._drains = trigger in ("available_now", "once")
        else:
            stream = topic_source(self.spark, self.opts, stream=True)
        if self._scan_filter is not None:
            stream = stream.where(self._scan_filter)
        w = stream.writeStream.queryName(f"copy_{self.group}_{self.generation}") \
            .option("checkpointLocation", self.checkpoint).foreachBatch(self._batch)
        if self._drains:
            w = w.trigger(processingTime="0 seconds")
        elif trigger == "available_now":
            w = w.trigger(availableNow=True)
        elif trigger == "once":
            w = w.trigger(once=True)
        else:
            w = w.trigger(processingTime=self.opts.trigger_interval)
        self.query = w.start()
        if self.opts.offset_ranges and self._mine and not self._drains:
            InheritableThread(target=self._follow, daemon=True).start()
        if self.opts.metrics_path:
            from spillway.plans.monitoring import Monitor
            self._monitor = Monitor(self.spark, self.opts, self)
            self._monitor.start()
        return self.query

    def _follow(self) -> None:
        """Keep this copy's own manifest of the source up to date, so that the stream sees new offsets."""
        while not self._ended.wait(self.opts.flush_interval_ms / 2000):
            try:
                self.index.refresh()
            except Exception:  # noqa: BLE001 - the next round reads the same folders
                _log.exception("reading new batches of the source failed")

    def request_stop(self) -> None:
        """Ask `finish()` to stop the query at the end of the batch that runs, or at once
        if a record has failed (safe from a signal handler: no lock, no call into the JVM)."""
        self._stop_requested = True

    def _close_between_batches(self) -> bool:
        """Let no further batch begin; whether none runs now."""
        with self._gate:
            self._closed = not self._busy
            return self._closed

    def finish(self, timeout: float | None = None) -> None:
        """Wait for the query to end, then check the budget once more (the last
        batch may have gone over with no next batch to refuse).  Waits in
        short steps so that `request_stop()` is honoured."""
        try:
            if self.query is not None:
                if self._drains and not self._stop_requested:
                    self.query.processAllAvailable()
                    self.request_stop()
                until = None if timeout is None else time.monotonic() + timeout
                while not self.query.awaitTermination(POLL_SECONDS if until is None else max(0.01, min(POLL_SECONDS, until - time.monotonic()))):
                    failed = self.rejected_total + self._rejected_now > 0 and not self._drains
                    if self._stop_requested and (failed or self._close_between_batches()):
                        self.query.stop()
                    elif until is not None and time.monotonic() >= until:
                        break
        except StreamingQueryException:
            if self._trip is not None:
                raise self._trip from None
            if not self._refused:
                raise
        finally:
            self._ended.set()
            self._end_monitor()
        if over_budget(self.rejected_total, self.opts.max_errors):
            raise self._over()

    def stop(self) -> None:
        self._ended.set()
        if self.query is not None:
            self.query.stop()
        self._end_monitor()

    def _end_monitor(self) -> None:
        if self._monitor is not None and not (self.query is not None and self.query.isActive):
            monitor, self._monitor = self._monitor, None
            monitor.finish()

    # ---- tables ----------------------------------------------------------
    def audit(self) -> DataFrame:
        return read_table(self.spark, self.root, "audit", self.group)

    def commits(self) -> DataFrame:
        return read_table(self.spark, self.root, "commits", self.group)

    def quarantined(self) -> DataFrame:
        return self.spark.read.parquet(self.path("quarantine")).where(F.col("group") == self.group)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    from spillway.schema import COMMITS
    return spark.read.schema(COMMITS).parquet(path)


def run_transfer(spark: SparkSession, opts: TransferOptions, trigger: str = "available_now") -> Transfer:
    """Start a copy, wait for it (drain) and check the budget."""
    t = Transfer(spark, opts)
    t.start(trigger)
    t.finish()
    return t


def run_transfers(spark: SparkSession, opts: list[TransferOptions],
                  trigger: str = "available_now") -> list[Transfer]:
    """Several copies (one topic each, as the reference runs one topic per
    process) as concurrent streaming queries of one session; waits for all."""
    ts = [Transfer(spark, o) for o in opts]
    for t in ts:
        t.start(trigger)
    errors = []
    for t in ts:
        try:
            t.finish()
        except Exception as e:  # finish the others, then report
            errors.append(e)
    if errors:
        raise errors[0]
    return ts
