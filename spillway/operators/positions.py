"""Offsets: newest per partition (S4), start position (S2), reset (S3),
stored positions (S5) and the seeds of a new generation (K5).

Every table here has one row per (topic, partition), so its size is bounded by
the partition count of the topic, never by the number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.functions import group_name


def partition_list(topics: DataFrame, partitions: int) -> DataFrame:
    """(topic, partition) for partitions 0..n-1 of each topic in `topics`."""
    return (topics.select("topic").distinct()
            .select("topic", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("partition"))
            .withColumn("partition", F.col("partition").cast("int")))


def newest_offsets(log: DataFrame, partitions: DataFrame | None = None,
                   before: str | Column | None = None) -> DataFrame:
    """Per partition the log-end offset (last offset + 1).

    With `partitions` (topic, partition) every listed partition appears, empty
    ones with 0.  With `before`, only records older than that time count: the
    snapshot a copy started at that moment would have frozen.
    """
    src = log if before is None else log.where(
        F.col("timestamp") < (F.to_timestamp(F.lit(before)) if isinstance(before, str) else before))
    ends = src.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("newest_offset"))
    if partitions is None:
        return ends
    return (partitions.select("topic", "partition")
            .join(ends, ["topic", "partition"], "left")
            .select("topic", "partition",
                    F.coalesce("newest_offset", F.lit(0)).cast("long").alias("newest_offset")))


def apply_start(log: DataFrame, start: DataFrame | None) -> DataFrame:
    """Keep records at or after the start position of their partition.

    `start` (topic, partition, start_offset) is the frozen newest-offset
    snapshot of the generation; a partition absent from it (created later)
    starts at 0.  `None` = from the beginning.
    """
    if start is None:
        return log
    return (log.join(start.select("topic", "partition", "start_offset"), ["topic", "partition"], "left")
            .where(F.col("offset") >= F.coalesce("start_offset", F.lit(0)))
            .drop("start_offset"))


def as_start(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("topic", "partition", F.col("newest_offset").alias("start_offset"))


def reset_position(stored: DataFrame, reset_snapshot: DataFrame, generation: int) -> DataFrame:
    """S3: a reset discards the stored position and starts the new generation at
    the newest offset at reset time.  Reports, per partition, the new start and
    the records skipped for good (the gap between the two)."""
    return (reset_snapshot.join(stored.select("topic", "partition", "next_offset"),
                                ["topic", "partition"], "left")
            .select("topic", "partition",
                    F.lit(generation).cast("int").alias("generation"),
                    F.col("newest_offset").alias("start_offset"),
                    F.greatest(F.col("newest_offset") - F.coalesce("next_offset", F.lit(0)),
                               F.lit(0)).cast("long").alias("skipped")))


def seed_rows(start: DataFrame, group: str, generation: int, at: Column | None = None) -> DataFrame:
    """K5: a new generation is seeded with its start snapshot as batch -1, so a
    fresh copy does not report the whole log as lag."""
    return start.select(F.lit(group).alias("group"), F.lit(generation).cast("int").alias("generation"),
                        "topic", "partition", F.col("start_offset").alias("next_offset"),
                        F.lit(-1).cast("long").alias("batch_id"),
                        (at if at is not None else F.current_timestamp()).alias("at"))


def committed_offsets(commits: DataFrame) -> DataFrame:
    """Per (group, topic, partition) the stored position, within the latest
    generation of each group (an older generation's position is void after a
    reset)."""
    # Collapse first (partial aggregation: one row per generation and
    # partition), then pick the latest generation on that small table.
    per_gen = (commits.groupBy("group", "generation", "topic", "partition")
               .agg(F.max("next_offset").alias("next_offset")))
    latest = Window.partitionBy("group")
    return (per_gen.withColumn("_latest", F.max("generation").over(latest))
            .where(F.col("generation") == F.col("_latest")).drop("_latest"))


def stored_positions(log: DataFrame, suffix: str, before: str) -> DataFrame:
    """Commit rows of a copy that ran over every record before `before` in
    daily batches (batch_id = day of month - 1), generation 0."""
    day = (F.dayofmonth("timestamp") - 1).cast("long")
    return (log.where(F.col("timestamp") < F.to_timestamp(F.lit(before)))
            .groupBy("topic", "partition", day.alias("batch_id"))
            .agg((F.max("offset") + 1).alias("next_offset"))
            .select(group_name("topic", suffix).alias("group"), F.lit(0).cast("int").alias("generation"),
                    "topic", "partition", "next_offset", "batch_id",
                    F.to_timestamp(F.lit(before)).alias("at")))

