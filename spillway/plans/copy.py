"""One batch of a copy: what it sends, what it rejects, what it audits and
commits.  Used by the stream (one micro-batch inside `foreachBatch`) and by the
bounded copy of a log slice.

Destination offsets.  A file-log destination needs offsets, as a broker would
assign them.  They are computed without an exchange of the records: with
round-robin placement, source partition s sends every N-th of its offsets to
each destination partition, so a record's index among those sent by s to its
destination is floor((offset - first_offset_of_s) / N).  Each source partition
gets a slot range of ceil(len_s / N) per destination partition, placed after the
slot ranges of the partitions before it.  Offsets are therefore unique and
increasing per destination partition, the same whenever the batch is planned
with the same base, and the only table that moves is one row per source
partition (bounded by the topic's partition count).  Like a broker's, they may have holes (rejected records,
uneven tails).
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from spillway.functions import null_to_empty, whole_div
from spillway.operators.positions import apply_start
from spillway.operators.records import reject_flag
from spillway.schema import CONSUMER, PRODUCER


@dataclasses.dataclass
class CopyBatch:
    records: DataFrame   # destination rows: topic, partition, offset, key, value, timestamp
    rejected: DataFrame  # failed source rows: topic, partition, offset, key, value, timestamp (and attempt, if the log has it)
    audit: DataFrame     # AUDIT without run/group/generation/batch columns
    commits: DataFrame   # topic, partition, next_offset, at
    ranges: DataFrame    # per source partition: from/until offsets, n, rejected, slot span


class Observed:
    """Counts of a batch taken from its write: records and payload bytes read, records failed.

    They ride on the plan that writes the records, so no other pass reads the payload.
    """

    def __init__(self) -> None:
        self._seen = Observation()

    def on(self, placed: DataFrame) -> DataFrame:
        size = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("key", "value")]
        return placed.observe(self._seen, F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(size[0] + size[1]), F.lit(0)).alias("bytes"),
                              F.coalesce(F.sum(F.col("_rejected").cast("long")), F.lit(0)).alias("rejected"))

    def get(self) -> dict[str, int]:
        """The counts; once the write has ended."""
        return self._seen.get


# Most source partitions whose slot table is broadcast.  The table has one row
# per (topic, partition) present in the batch, so this is a bound on the topic's
# partition count, not on data; above it the slots join by a shuffle instead.
SLOT_BROADCAST_LIMIT = 100_000


def plan_ranges(src: DataFrame, partitions: int) -> DataFrame:
    """Per source partition of a batch: offset range, counts, slot span and
    slot start.  One row per (topic, partition) present.  Of the payload, only
    columns that the reject predicate names are read."""
    ranges = (src.groupBy("topic", "partition")
              .agg(F.min("offset").alias("from_offset"),
                   (F.max("offset") + 1).alias("until_offset"),
                   F.count(F.lit(1)).alias("n"),
                   F.sum(F.col("_rejected").cast("long")).alias("rejected"))
              .withColumn("_span", whole_div(F.col("until_offset") - F.col("from_offset") + (partitions - 1), partitions)))
    before = Window.partitionBy("topic").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("_slot", F.coalesce(F.sum("_span").over(before), F.lit(0)).cast("long"))


def plan_copy_batch(log: DataFrame, partitions: int, start: DataFrame | None = None,
                    reject_when: str | Column | None = None, preserve_nulls: bool = False,
                    base: int | Column = 0, at: Column | None = None,
                    broadcast_slots: bool = False, ranges: DataFrame | None = None, observed: Observed | None = None) -> CopyBatch:
    """Plan one batch over `log` (TOPIC_LOG rows, any number of topics).

    `base`: the destination's next free offset for these topics (same for
    every destination partition, see the module doc).  `at`: batch time.
    `broadcast_slots`: broadcast the per-partition slot table (for callers that
    counted it, up to `SLOT_BROADCAST_LIMIT`); else Spark decides by its size.  `ranges`: the range
    table of this batch when the caller already has it (the stream holds it as
    driver-side metadata, as Spark's Kafka source holds offset ranges).  `observed`
    is filled by the write of the records.
    """
    at = F.current_timestamp() if at is None else at
    base_c = F.lit(base) if isinstance(base, int) else base
    src = apply_start(log, start).withColumn("_rejected", reject_flag(reject_when))

    ranges = plan_ranges(src, partitions) if ranges is None else ranges
    slots = ranges.select("topic", "partition", "from_offset", "_slot")
    slots = F.broadcast(slots) if broadcast_slots else slots

    placed = (src.join(slots, ["topic", "partition"])
              .withColumn("_dst", F.pmod(F.col("offset") + F.col("partition"), F.lit(partitions)).cast("int"))
              .withColumn("_dst_offset", (base_c + F.col("_slot")
                                          + whole_div(F.col("offset") - F.col("from_offset"), partitions)).cast("long")))

    if observed is not None:
        placed = observed.on(placed)
    key, value = (F.col("key"), F.col("value")) if preserve_nulls else (null_to_empty("key"), null_to_empty("value"))
    records = placed.where(~F.col("_rejected")).select(
        "topic", F.col("_dst").alias("partition"), F.col("_dst_offset").alias("offset"),
        key.alias("key"), value.alias("value"), at.alias("timestamp"))
    attempt = ["attempt"] if "attempt" in src.columns else []
    rejected = src.where(F.col("_rejected")).select("topic", "partition", "offset", "key", "value", "timestamp", *attempt)

    # Audit rows come from the range table alone (no pass over the records):
    # per source partition, what the consumer read, and what the producer sent
    # (read - rejected) with the destination slot range those records went to.
    consumer = ranges.select("topic", "partition", F.lit(CONSUMER).alias("client_type"),
                             "n", "rejected", "from_offset", "until_offset")
    producer = ranges.select("topic", "partition", F.lit(PRODUCER).alias("client_type"),
                             (F.col("n") - F.coalesce("rejected", F.lit(0))).cast("long").alias("n"),
                             F.lit(0).cast("long").alias("rejected"),
                             (base_c + F.col("_slot")).cast("long").alias("from_offset"),
                             (base_c + F.col("_slot") + F.col("_span")).cast("long").alias("until_offset"))
    audit = consumer.unionByName(producer).withColumn("at", at)
    commits = ranges.select("topic", "partition", F.col("until_offset").alias("next_offset"), at.alias("at"))
    return CopyBatch(records, rejected, audit, commits, ranges)


def plan_counted(log: DataFrame, partitions: int, start: DataFrame | None = None,
                 reject_when: str | Column | None = None, preserve_nulls: bool = False,
                 base: int | Column = 0, at: Column | None = None, observed: Observed | None = None) -> tuple[list, CopyBatch]:
    """The range table of a batch as rows (one per source partition, as Spark's
    Kafka source holds offset ranges on the driver), and the batch planned with
    it as a local table: its writes share it, and the slot broadcast is checked
    against its exact size."""
    planned = plan_copy_batch(log, partitions, start, reject_when, preserve_nulls, base, at)
    rows = planned.ranges.collect()
    local = log.sparkSession.createDataFrame(rows, planned.ranges.schema, verifySchema=False)
    return rows, plan_copy_batch(log, partitions, start, reject_when, preserve_nulls, base, at,
                                 broadcast_slots=len(rows) <= SLOT_BROADCAST_LIMIT, ranges=local, observed=observed)


def with_gauges(audit: DataFrame, rows: list, counts: dict[str, int] | None, took_ms: int | None = None) -> DataFrame:
    """Audit rows with the batch's payload bytes, on the row of the first partition read (null: its write was not
    observed, because a batch that is repeated keeps what was written), and its duration, on every row."""
    first = min(((r["topic"], r["partition"]) for r in rows), default=("", -1))
    here = (F.col("client_type") == CONSUMER) & (F.col("topic") == first[0]) & (F.col("partition") == first[1])
    size = F.lit(None if counts is None else counts["bytes"]).cast("long")
    return audit.withColumn("bytes", F.when(here, size)).withColumn("took_ms", F.lit(took_ms).cast("long"))


def copy_bounded(log: DataFrame, partitions: int, destination: str, state: str, group: str | Column,
                 generation: int = 0, batch_id: int = 0, start: DataFrame | None = None,
                 reject_when: str | Column | None = None, preserve_nulls: bool = False, base: int = 0,
                 compression: str = "gzip") -> dict[str, int]:
    """Copy a bounded slice of a log as one batch: records to the destination
    file log, then quarantine, audit and commits under `state`.  The range
    table (one row per source partition) is read once to the driver and shared
    by the four writes as a local table.  Returns, per topic, the destination's
    next free offset (`base` + the slots reserved)."""
    from spillway.sinks.file_log import run_concurrently, write_log_batch, write_table_batch
    observed = Observed()
    rows, plan = plan_counted(log, partitions, start, reject_when, preserve_nulls, base, observed=observed)
    if not rows:
        return {}
    write_log_batch(plan.records, destination, group, generation, batch_id, compression)
    audit = with_gauges(plan.audit, rows, observed.get())
    tables = [lambda: write_table_batch(audit, f"{state}/audit", group, generation, batch_id),
              lambda: write_table_batch(plan.commits, f"{state}/commits", group, generation, batch_id)]
    if any(r["rejected"] for r in rows):
        tables.append(lambda: write_table_batch(plan.rejected, f"{state}/quarantine", group, generation, batch_id))
    run_concurrently(tables)
    ends: dict[str, int] = {}
    for r in rows:
        ends[r["topic"]] = ends.get(r["topic"], base) + r["_span"]
    return ends
