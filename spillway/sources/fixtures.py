"""Topic logs derived from the driver's tables.

The reference ships no data; its data model is a partitioned topic of
(key, value) byte records.  These functions turn the given tables into such
logs, the same way in Spark and in the DuckDB oracle (see FIXTURES.md).  The
work grows with the tables: nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.operators.numbering import sequence_within
from spillway.options import DEFAULT_GROUP_SUFFIX

# Fixed values of the fixture: the reference's trial topic has 24 partitions.
FIXTURE_PARTITIONS = 24
FIXTURE_SUFFIX = DEFAULT_GROUP_SUFFIX  # the default consumer-group suffix
# Stored positions / start snapshot: newest offset among records before this time.
STORED_BEFORE = "2024-01-20 00:00:00"
# Reset time used by the reset fixture: a later snapshot.
RESET_AT = "2024-01-25 00:00:00"
# Partitions listed by the partition-list fixture: 0..26, so 24..26 are empty.
LISTED_PARTITIONS = 27
# Reject predicate of the failed-records fixture.
REJECT_WHEN = "length(value) > 8"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def topic_log_from_events(events: DataFrame) -> DataFrame:
    """TOPIC_LOG from `events`.

    topic = event_type; partition = user_id % 24; offset = position in the
    partition by event_id; key = user_id as text (null when event_id % 10 = 0);
    value = props (null when event_id % 17 = 0); timestamp = ts.
    """
    base = events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % F.lit(FIXTURE_PARTITIONS)).cast("int").alias("partition"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None))
         .otherwise(F.col("user_id").cast("string")).cast("binary").alias("key"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None))
         .otherwise(F.col("props")).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id"),
    )
    log = sequence_within(base, ["topic", "partition"], "event_id", "offset")
    return log.select("topic", "partition", "offset", "key", "value", "timestamp")


def topic_log_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """The wide bench log: one topic `lineitem`, key l_orderkey, value the whole
    row as JSON, partition l_orderkey % 24, offsets by (l_orderkey, l_linenumber)."""
    base = lineitem.select(
        F.lit("lineitem").alias("topic"),
        (F.col("l_orderkey") % F.lit(FIXTURE_PARTITIONS)).cast("int").alias("partition"),
        F.col("l_orderkey").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*lineitem.columns)).cast("binary").alias("value"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_ord"),
    )
    return (sequence_within(base, ["topic", "partition"], "_ord", "offset")
            .select("topic", "partition", "offset", "key", "value", "timestamp"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_log_from_events(table(spark, sf_dir, "events"))


# Flush interval of the replayed copy, in seconds (the reference's 10,000 ms).
FLUSH_SECONDS = 10


def replay_audit(log: DataFrame, reject_when: str = REJECT_WHEN,
                 flush_seconds: int = FLUSH_SECONDS) -> DataFrame:
    """Audit rows of a copy that read each record at its timestamp and sent it
    at the next flush tick; records failing `reject_when` are counted as
    rejected and never sent.  One row per record (n = 1): the metric operators
    sum, so per-record and per-batch audit rows give the same results."""
    from spillway.functions import next_tick
    from spillway.operators.records import reject_flag
    flag = reject_flag(reject_when)
    read = log.select("topic", "partition", F.lit("consumer").alias("client_type"),
                      F.lit(1).cast("long").alias("n"), flag.cast("long").alias("rejected"),
                      F.col("timestamp").alias("at"))
    sent = log.where(~flag).select("topic", "partition", F.lit("producer").alias("client_type"),
                                   F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("rejected"),
                                   next_tick("timestamp", flush_seconds).alias("at"))
    return read.unionByName(sent)
