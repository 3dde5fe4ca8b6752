"""Metrics about a copy (M1-M6) as ordinary DataFrames.

Inputs are engine tables (audit, commits) or any table of the same shape.  The
rule throughout: collapse records to one row per (series, time bucket) with a
partial aggregate *before* anything that orders or spans a series, so the work
after the first exchange grows with the time span, not with the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.functions import second_bucket, whole_div

# Buckets of a dense series that are built in one row (a minute of seconds).
DENSE_CHUNK = 60


def _epoch_to_ntz(c):
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def bucket_counts(audit: DataFrame, keys: Sequence[str], seconds: int,
                  value: str = "n", time: str = "at") -> DataFrame:
    """sum(value) per (keys, bucket start as epoch seconds)."""
    return (audit.groupBy(*keys, second_bucket(time, seconds).alias("_bucket"))
            .agg(F.sum(value).cast("long").alias("records")))


def throughput(audit: DataFrame, seconds: int = 1, keys: Sequence[str] = ("topic", "client_type"),
               value: str = "n", time: str = "at") -> DataFrame:
    """M1: records per tumbling processing-time bucket, summed over writers,
    per (topic, client_type).  With 1-second buckets `records` is the
    reference's rps."""
    return (bucket_counts(audit, keys, seconds, value, time)
            .select(*keys, _epoch_to_ntz("_bucket").alias("time"), "records"))


def _packed(counts: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """(keys, _chunk, _found, _first, _last, _total): the given buckets of a chunk as a map, from one aggregate."""
    entry = F.struct(F.col("_bucket").alias("key"), F.col("records").alias("value"))
    return (counts.groupBy(*keys, whole_div(F.col("_bucket"), seconds * DENSE_CHUNK).alias("_chunk"))
            .agg(F.map_from_entries(F.collect_list(entry)).alias("_found"), F.min("_bucket").alias("_first"),
                 F.max("_bucket").alias("_last"), F.sum("records").alias("_total")))


def _dense(counts: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """(keys, _chunk, _from, _values, _total): per series and chunk of the span, the first bucket and the values in order.

    The span and the series come from the packed chunks, too (one row a series),
    and read the same columns of them: Spark runs their exchange once, so the
    audit is read as often as `throughput` reads it.  Chunks grow to buckets
    inside a row: zeros are neither shuffled nor summed.
    """
    step = seconds * DENSE_CHUNK
    packed = _packed(counts, keys, seconds)
    # The size and the total are asked for so that no branch prunes the packed columns and plans another exchange.
    series = packed.groupBy(*keys).agg(F.min("_first").alias("_lo"), F.max("_last").alias("_hi"), F.max(F.size("_found")).alias("_most"),
                                       F.count("_total").alias("_some")).where("_most > 0 and _some > 0")
    span = series.agg(F.struct(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).alias("span"))
    grid = (series.select(*keys).withColumn("_span", span.scalar())
            .select(*keys, F.col("_span.lo").alias("_lo"), F.col("_span.hi").alias("_hi"))
            .withColumn("_chunk", F.explode(F.sequence(whole_div(F.col("_lo"), step), whole_div(F.col("_hi"), step)))))
    # A chunk grows sixtyfold behind this, so the number of tasks is set: small rows would be coalesced into one.
    writers = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = grid.repartition(writers, *keys, "_chunk")
    found = grid.join(packed, [*keys, "_chunk"], "left")
    first = F.greatest("_lo", F.col("_chunk") * step)
    last = F.least("_hi", F.col("_chunk") * step + (step - seconds))
    buckets = F.sequence(first, last, F.lit(seconds).cast("long"))
    zero = F.lit(0).cast("long")
    return found.select(*keys, "_chunk", first.alias("_from"), F.coalesce("_total", zero).alias("_total"),
                        F.transform(buckets, lambda t: F.coalesce(F.try_element_at("_found", t), zero)).alias("_values"))


def _exploded(dense: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """(keys, _chunk, _bucket, records)"""
    return (dense.select(*keys, "_chunk", "_from", F.posexplode_outer("_values").alias("_at", "records"))  # inner would evaluate the values twice
            .select(*keys, "_chunk", (F.col("_from") + F.col("_at") * seconds).alias("_bucket"), "records"))


def densify(counts: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """(keys, _bucket, records) -> the same with every bucket of the span of all series.

    Lazy and stateless: nothing is cached and no job runs here, so a plan built
    later sees what the tables hold then.  The span is a scalar subquery.
    """
    return _exploded(_dense(counts, keys, seconds), keys, seconds).drop("_chunk")


def dense_throughput(audit: DataFrame, seconds: int = 1,
                     keys: Sequence[str] = ("topic", "client_type"),
                     value: str = "n", time: str = "at") -> DataFrame:
    """M2: as M1, but an idle bucket still reports 0, as the reference's
    per-second loop always writes."""
    counts = bucket_counts(audit, keys, seconds, value, time)
    return (densify(counts, keys, seconds)
            .select(*keys, _epoch_to_ntz("_bucket").alias("time"), "records"))


def partition_lag(newest: DataFrame, committed: DataFrame, group: str | Column) -> DataFrame:
    """M3: per partition of the topic, newest - committed.  Partitions without
    a stored position are kept (lag from 0, `has_position` false).  Both inputs
    have one row per partition; `committed` holds the positions of one group."""
    c = committed.select("topic", "partition", "next_offset")
    joined = newest.select("topic", "partition", "newest_offset").join(c, ["topic", "partition"], "left")
    return _lag_columns(joined, group)


def _lag_columns(joined: DataFrame, group: str | Column) -> DataFrame:
    grp = F.lit(group) if isinstance(group, str) else group
    return joined.select(
        grp.alias("group"), "topic", "partition",
        F.coalesce("next_offset", F.lit(0)).cast("long").alias("current_offset"),
        F.col("newest_offset").cast("long").alias("newest_offset"),
        (F.col("newest_offset") - F.coalesce("next_offset", F.lit(0))).cast("long").alias("lag"),
        F.col("next_offset").isNotNull().alias("has_position"))


def total_lag(lag: DataFrame) -> DataFrame:
    """M4: lag summed over the partitions of a (group, topic)."""
    return (lag.groupBy("group", "topic")
            .agg(F.sum("lag").cast("long").alias("total_lag"),
                 F.count(F.lit(1)).alias("partitions")))


def in_flight(audit: DataFrame, seconds: int = 30, keys: Sequence[str] = ("topic",),
              time: str = "at") -> DataFrame:
    """M5: records read and not yet sent, sampled at the end of every
    `seconds` bucket (the reference logs its queue length each 30 s).

    A failed record leaves the queue when it fails, so it is not in flight:
    per bucket, (consumed - rejected) - produced is summed first; the running
    total over the dense bucket series is then the queue length at each
    sample.  Without a `rejected` column, nothing is rejected."""
    rejected = F.coalesce(F.col("rejected"), F.lit(0)) if "rejected" in audit.columns else F.lit(0)
    delta = F.when(F.col("client_type") == "consumer", F.col("n") - rejected).otherwise(-F.col("n"))
    counts = (audit.groupBy(*keys, second_bucket(time, seconds).alias("_bucket"))
              .agg(F.sum(delta).cast("long").alias("records")))
    # A running total of one long series: of the chunks before (one row per chunk), and inside the chunk's row.
    dense = _dense(counts, keys, seconds)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    empty = F.struct(F.col("_base").alias("sum"), F.array().cast("array<bigint>").alias("out"))
    running = F.aggregate("_values", empty, lambda acc, v: F.struct(
        (acc["sum"] + v).alias("sum"), F.array_append(acc["out"], acc["sum"] + v).alias("out")), lambda acc: acc["out"])
    based = dense.withColumn("_base", F.coalesce(F.sum("_total").over(before), zero)).withColumn("_values", running)
    return (_exploded(based, keys, seconds)
            .select(*keys, _epoch_to_ntz("_bucket").alias("time"), F.col("records").cast("long").alias("in_flight")))


def packed_throughput(audit: DataFrame, seconds: int = 1, keys: Sequence[str] = ("topic", "client_type")) -> DataFrame:
    """M2 with one row per (keys, chunk of `DENSE_CHUNK` buckets): the values in time order, comma-joined."""
    dense = _dense(bucket_counts(audit, keys, seconds), keys, seconds)
    return dense.select(*keys, _epoch_to_ntz(F.col("_chunk") * (seconds * DENSE_CHUNK)).alias("start"),
                        F.array_join(F.transform("_values", lambda v: v.cast("string")), ",").alias("records"))


def lag_of_log(log: DataFrame, partitions: DataFrame, before: str, group: str | Column) -> DataFrame:
    """M3 over a log whose stored positions are "everything older than `before`":
    newest offset and stored position from one aggregate over the log."""
    old = F.col("timestamp") < F.to_timestamp(F.lit(before))
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("newest_offset"),
                                                 (F.max(F.when(old, F.col("offset"))) + 1).alias("next_offset"))
    all_parts = (partitions.select("topic", "partition").join(ends, ["topic", "partition"], "left")
                 .withColumn("newest_offset", F.coalesce("newest_offset", F.lit(0))))
    return _lag_columns(all_parts, group)


def gauge_sample(gauges: DataFrame, keys: Sequence[str], values: Sequence[str],
                 time: str, seq: str, seconds: int = 60) -> DataFrame:
    """M6: one sample per (keys, `seconds` bucket) holding the latest value of
    each gauge (latest = highest `seq`).  `max_by` aggregates partially on the
    map side, so a busy host does not land in one task."""
    latest = [F.max_by(F.col(v), F.col(seq)).alias(v) for v in values]
    return (gauges.groupBy(*keys, second_bucket(time, seconds).alias("_bucket")).agg(*latest)
            .select(*keys, _epoch_to_ntz("_bucket").alias("time"), *values))
