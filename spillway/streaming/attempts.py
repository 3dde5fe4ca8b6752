"""K3/K4: records that fail are tried again before they count as failed.

The reference's producer sends a record up to `max_retry` times more.  Here a failed
record goes to an *attempt log* under the copy's state, which is a second source of
the copy's own query: what a batch leaves there arrives with a later batch, exactly
once and over restarts, because the query's checkpoint holds what it has read of the
log.  After the k-th attempt, made by batch b, the next one is due in batch
b + 2^(k-1); a batch that reads the record before writes it on.  A record that fails
for the (max_retry + 1)-th time is dead: it is counted, and kept in the quarantine table.

The stream carries only the names of the log's folders; the batch reads the records on
executors.  The log holds failed records only, so the copy path stays as it is.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.operators.numbering import sequence_within
from spillway.operators.records import reject_flag
from spillway.plans.copy import SLOT_BROADCAST_LIMIT, plan_copy_batch
from spillway.schema import ATTEMPTS, CONSUMER, PRODUCER
from spillway.streaming import fs

RANGES = "topic string, partition int, from_offset long, until_offset long, n long, rejected long, _span long, _slot long"
LONGEST_WAIT = 20  # the wait between two attempts doubles up to 2^20 batches


@dataclasses.dataclass
class Retried:
    """What a batch does with the records that waited."""

    records: DataFrame | None   # those sent now, as destination rows
    audit: DataFrame            # AUDIT rows of them and of the dead ones
    failed: DataFrame           # those that failed again: ATTEMPTS without due, with the attempt just made
    later: DataFrame            # those not due yet: ATTEMPTS
    width: int                  # destination offsets taken
    dead: int                   # failed for the last time
    waiting: int                # failed again, or not due yet


def with_waiting(ranges: DataFrame, folder: str) -> DataFrame:
    """The stream of offset ranges, with rows of null ranges that name in `waiting` a batch whose failed records are to be read."""
    spark = ranges.sparkSession
    fs.mkdirs(spark, folder)
    schema = T.StructType([*ATTEMPTS.fields, T.StructField("batch_id", T.LongType())])
    # Files are never too old to be read: a copy may have been away for long.
    log = spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(folder)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranges.schema.fields]
    return ranges.withColumn("waiting", F.lit(None).cast("long")).unionByName(log.select(*rest, F.col("batch_id").alias("waiting")))


def read_attempts(spark: SparkSession, folder: str, batches: list[int]) -> DataFrame:
    paths = [f"{folder}/batch_id={b}" for b in sorted(batches)]
    return spark.read.schema(ATTEMPTS).parquet(*paths) if paths else spark.createDataFrame([], ATTEMPTS)


def next_attempts(failed: DataFrame, batch_id: int, max_retry: int) -> DataFrame:
    """ATTEMPTS rows of the failed records that have an attempt left."""
    wait = F.expr(f"shiftleft(1L, least(attempt - 1, {LONGEST_WAIT}))")
    return (failed.where(F.col("attempt") <= max_retry).withColumn("due", F.lit(batch_id) + wait)
            .withColumn("attempt", F.col("attempt") + 1).select(*ATTEMPTS.names))


def dead_letters(failed: DataFrame, max_retry: int) -> DataFrame:
    return failed.where(F.col("attempt") > max_retry)


def retry(waiting: DataFrame, batch_id: int, max_retry: int, reject_when: str | Column | None, partitions: int,
          preserve_nulls: bool, base: int, at: Column) -> Retried:
    """Plan the attempts of one batch over `waiting` (ATTEMPTS rows).

    Those sent get destination offsets from `base` on: numbered by source
    partition and offset among themselves, then placed as the records of a batch are.
    """
    is_due = F.col("due") <= batch_id
    due = waiting.where(is_due).withColumn("_fails", reject_flag(reject_when))
    last = F.col("attempt") > max_retry
    fate = waiting.withColumn("_fails", is_due & reject_flag(reject_when)).groupBy("topic", "partition").agg(
        F.count_if(F.col("_fails") & last).alias("dead"), F.count_if(F.col("_fails") & ~last | ~is_due).alias("waiting"),
        F.count_if(is_due & ~F.col("_fails")).alias("sent")).collect()  # one row per source partition
    gone = [(r["topic"], r["partition"], CONSUMER, 0, r["dead"]) for r in fate if r["dead"]]
    audit = (waiting.sparkSession.createDataFrame(gone, "topic string, partition int, client_type string, n long, rejected long")
             .withColumns({"from_offset": F.lit(None).cast("long"), "until_offset": F.lit(None).cast("long"), "at": at}))
    records, ranges, width = None, [], 0
    for r in sorted((r for r in fate if r["sent"]), key=lambda r: (r["topic"], r["partition"])):
        span = -(-r["sent"] // partitions)
        ranges.append((r["topic"], r["partition"], 0, r["sent"], r["sent"], 0, span, width))
        width += span
    if ranges:
        sent = sequence_within(due.where("not _fails"), ["topic", "partition"], "offset", "_at")
        plan = plan_copy_batch(sent.withColumn("offset", F.col("_at")).drop("_at", "_fails", "due", "attempt"), partitions,
                               preserve_nulls=preserve_nulls, base=base, at=at, broadcast_slots=len(ranges) <= SLOT_BROADCAST_LIMIT,
                               ranges=waiting.sparkSession.createDataFrame(ranges, RANGES))
        records = plan.records
        audit = audit.unionByName(plan.audit.where(F.col("client_type") == PRODUCER))
    return Retried(records, audit, due.where("_fails").drop("_fails", "due"), waiting.where(~is_due), width,
                   sum(r["dead"] for r in fate), sum(r["waiting"] for r in fate))
