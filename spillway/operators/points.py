"""Metric rows -> points (measurement, tags, fields, time).

The three measurements of the reference, with its tag and field names.  One
departure: `partition` is a tag here, not a field, so that the points of the
partitions of one group stay separate series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.functions import series_key, truncate_time

# Fixed values that must equal the reference's: measurement, tag and field names.
KAFKA_STATS = "kafka_stats"
RPS_STATS = "rps_stats"
SYSTEM_STATS = "system_stats"
MEASUREMENTS = (KAFKA_STATS, RPS_STATS, SYSTEM_STATS)
TAG_HOST = "host"
TAG_GROUP = "consumer_group_name"
TAG_TOPIC = "topic"
TAG_PARTITION = "partition"
TAG_CLIENT_TYPE = "clientType"
FIELD_CURRENT = "currentOffset"
FIELD_NEWEST = "newestOffset"
FIELD_RPS = "rps"


def _time(t) -> Column:
    """Point time at second precision: a column name, a Column, a datetime
    literal, or None for now (the reference stamps points with wall clock)."""
    if t is None:
        c = F.current_timestamp()
    elif isinstance(t, str):
        c = F.col(t)
    elif isinstance(t, Column):
        c = t
    else:
        c = F.lit(t)
    return truncate_time(c.cast("timestamp")).alias("time")


def _host(host: str | Column) -> Column:
    return host if isinstance(host, Column) else F.lit(host)


def kafka_stats_points(lag: DataFrame, host: str | Column, time: str | Column | None = None) -> DataFrame:
    """Lag rows (group, topic, partition, current_offset, newest_offset) -> points."""
    return lag.select(
        F.lit(KAFKA_STATS).alias("measurement"),
        F.create_map(F.lit(TAG_HOST), _host(host),
                     F.lit(TAG_GROUP), F.col("group"),
                     F.lit(TAG_TOPIC), F.col("topic"),
                     F.lit(TAG_PARTITION), F.col("partition").cast("string")).alias("tags"),
        F.create_map(F.lit(FIELD_CURRENT), F.col("current_offset").cast("long"),
                     F.lit(FIELD_NEWEST), F.col("newest_offset").cast("long")).alias("fields"),
        _time(time))


def rps_points(rates: DataFrame, host: str | Column, time: str | Column = "time") -> DataFrame:
    """Throughput rows (topic, client_type, time, records) -> points."""
    return rates.select(
        F.lit(RPS_STATS).alias("measurement"),
        F.create_map(F.lit(TAG_HOST), _host(host),
                     F.lit(TAG_TOPIC), F.col("topic"),
                     F.lit(TAG_CLIENT_TYPE), F.col("client_type")).alias("tags"),
        F.create_map(F.lit(FIELD_RPS), F.col("records").cast("long")).alias("fields"),
        _time(time))


def system_points(samples: DataFrame, host: str | Column, gauges: Sequence[str],
                  time: str | Column = "time") -> DataFrame:
    """Gauge samples (one row per host and minute) -> points with one field per gauge."""
    kv = []
    for g in gauges:
        kv += [F.lit(g), F.col(g).cast("long")]
    return samples.select(
        F.lit(SYSTEM_STATS).alias("measurement"),
        F.create_map(F.lit(TAG_HOST), _host(host)).alias("tags"),
        F.create_map(*kv).alias("fields"),
        _time(time))


def to_points(*parts: DataFrame) -> DataFrame:
    """Union of point sets (same POINTS schema)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def explode_points(points: DataFrame) -> DataFrame:
    """One row per field: (measurement, series, field, value, time), where
    `series` is the line-protocol series key `measurement,k=v,...`."""
    return points.select("measurement", series_key("measurement", "tags").alias("series"),
                         F.explode("fields").alias("field", "value"),
                         F.col("time").cast("timestamp_ntz").alias("time"))
