"""What Spark says about a running copy: offsets its Kafka source began at, and
the newest it knows; and gauges of the copy's batches from its audit table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.schema import CONSUMER
from spillway.streaming import fs

# Gauges of one batch (integers, as point fields are).
BATCH_GAUGES = ("records", "bytes", "rejected", "took_ms")


def parse_offsets(text: str) -> list[tuple[str, int, int]]:
    """(topic, partition, offset) of {topic: {partition: offset}} as JSON."""
    return [(topic, int(p), int(o)) for topic, parts in json.loads(text).items() if isinstance(parts, dict)
            for p, o in parts.items()]


def first_offsets(spark: SparkSession, checkpoint: str) -> list[tuple[str, int, int]]:
    """The offsets a Kafka query began at, from its checkpoint; empty before they are written.

    One row per partition of the topic."""
    path = f"{checkpoint}/sources/0/0"
    if not fs.exists(spark, path):
        return []
    lines = [r[0] for r in spark.read.text(path).collect()]
    return [x for line in lines if line.startswith("{") for x in parse_offsets(line)]


def batch_gauges(audit: DataFrame, host: str) -> DataFrame:
    """(host, at, batch_id, records, bytes, rejected, took_ms): one row per batch of an audit table."""
    read = audit.where(F.col("client_type") == CONSUMER)
    return (read.groupBy("generation", "batch_id", "at")
            .agg(F.sum("n").alias("records"), F.sum("bytes").alias("bytes"), F.sum("rejected").alias("rejected"),
                 F.max("took_ms").alias("took_ms"))
            .select(F.lit(host).alias("host"), "at", "batch_id", *(F.coalesce(g, F.lit(0)).cast("long").alias(g) for g in BATCH_GAUGES)))
