"""Record-level operators of the copy path: P1-P3, D1, D2, K4.

Each takes and returns a DataFrame, so it runs unchanged on a stream, on a
micro-batch inside `foreachBatch`, and on bounded data.  All are narrow
(no exchange) except `fan_out`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.functions import null_to_empty as _null_to_empty
from spillway.functions import round_robin


def topic_filter(log: DataFrame, topic: str) -> DataFrame:
    """Only the configured topic.  On a file log `topic` is a directory, so
    this prunes folders; on Kafka it is the `subscribe` option."""
    return log.where(F.col("topic") == F.lit(topic))


def record_projection(log: DataFrame) -> DataFrame:
    """What is sent - topic, key, value.  Source partition, offset,
    timestamp and headers are dropped; the destination topic has the same name."""
    return log.select("topic", "key", "value")


def null_to_empty(records: DataFrame, preserve_nulls: bool = False) -> DataFrame:
    """Null key/value become empty bytes (the reference's behaviour);
    `preserve_nulls=True` keeps tombstones."""
    if preserve_nulls:
        return records
    return (records.withColumn("key", _null_to_empty("key"))
                   .withColumn("value", _null_to_empty("value")))


def place_round_robin(log: DataFrame, partitions: int, out: str = "dst_partition") -> DataFrame:
    """Destination partition chosen in turn, ignoring the key."""
    return log.withColumn(out, round_robin("offset", "partition", partitions))


def fan_out(df: DataFrame, writers: int | None) -> DataFrame:
    """M readers feed n writers; order is not kept.  `None` keeps the read
    parallelism (no exchange); a number adds one round-robin exchange."""
    return df if writers is None else df.repartition(writers)


def reject_flag(predicate: str | Column | None) -> Column:
    """K4: true for a record that fails.  A null predicate result (e.g. a null
    value) counts as not rejected."""
    if predicate is None:
        return F.lit(False)
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(p, F.lit(False))
