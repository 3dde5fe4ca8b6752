"""Schemas of the topic log and of the tables the engine writes."""

from __future__ import annotations

from pyspark.sql import types as T

# One record of a partitioned, append-only topic.  It is the subset of the
# columns Spark's Kafka source yields, so the same code runs on Kafka, on a
# parquet file log and on bounded batch data.
TOPIC_LOG = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), False),
])

# The parquet file log keeps `topic` as a directory (topic=<name>/), so a topic
# filter prunes whole folders; the files hold the other columns.
FILE_LOG_DATA = T.StructType([f for f in TOPIC_LOG.fields if f.name != "topic"])

COMMITS = T.StructType([
    T.StructField("group", T.StringType(), False),
    T.StructField("generation", T.IntegerType(), False),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("next_offset", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("at", T.TimestampType(), False),
])

AUDIT = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("group", T.StringType(), False),
    T.StructField("generation", T.IntegerType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("client_type", T.StringType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("rejected", T.LongType(), False),
    T.StructField("from_offset", T.LongType(), True),
    T.StructField("until_offset", T.LongType(), True),
    T.StructField("at", T.TimestampType(), False),
    T.StructField("bytes", T.LongType(), True),     # payload bytes read by the batch, on one of its consumer rows
    T.StructField("took_ms", T.LongType(), True),   # from the batch's begin to the end of its sink write
])

# What a checkpoint generation starts from, written once before anything else of
# it: one row per source partition known then, and one with partition -1 for
# the generation itself.
GENERATIONS = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("start_offset", T.LongType(), True),
    T.StructField("base", T.LongType(), True),          # the destination's next free offset
    T.StructField("start_at", T.StringType(), True),
    T.StructField("opened_at", T.TimestampType(), True),
])

# A record that waits for its next attempt (`retry_failed`): its place in the source, the number of that attempt and
# the first batch that may make it.
ATTEMPTS = T.StructType([
    *TOPIC_LOG.fields,
    T.StructField("attempt", T.IntegerType(), False),
    T.StructField("due", T.LongType(), False),
])

POINTS = T.StructType([
    T.StructField("measurement", T.StringType(), False),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("fields", T.MapType(T.StringType(), T.LongType()), False),
    T.StructField("time", T.TimestampType(), False),
])

CONSUMER = "consumer"
PRODUCER = "producer"
