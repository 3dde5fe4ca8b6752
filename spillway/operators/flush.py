"""K2: flush groups, closed at a number of records or at the end of an interval.

A producer sends what it holds once it has `size` records, and at the latest when
the interval ends.  Over a log that is: the position of a record among those of
its topic and interval, divided by the size.  The position is a prefix count over
the interval's partitions (one row each) plus the place inside the partition,
which is numbered in slices of offsets; no interval is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spillway.functions import second_bucket, whole_div
from spillway.operators.numbering import sequence_within


def flush_groups(log: DataFrame, size: int, seconds: int, time: str = "timestamp") -> DataFrame:
    """The log with `interval` (start, epoch seconds) and `flush_group` (from 0 in each topic and interval).

    Records of an interval are taken by partition and offset, as they lie in the
    log; every group has `size` records but the last of an interval.
    """
    if size <= 0 or seconds <= 0:
        raise ValueError("size and seconds must be positive")
    keys = ["topic", "interval", "partition"]
    timed = log.withColumn("interval", second_bucket(time, seconds))
    counts = timed.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("topic", "interval").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = sequence_within(timed, keys, "offset", "_place").join(bases, keys)
    return (placed.withColumn("flush_group", whole_div(F.col("_before") + F.col("_place"), size).cast("long"))
            .drop("_before", "_place"))
