"""The topic source, on a parquet file log or on Kafka, batch or stream.

File-log layout (written by `spillway.sinks.file_log`), one folder per batch of
one writer::

    <root>/topic=<t>/group=<g>/generation=<n>/batch_id=<b>/part-*.parquet

The files hold (partition, offset, key, value, timestamp), sorted by
(partition, offset).  `topic` is a directory, so a topic filter prunes folders;
a start position or offset range is pushed into the parquet scan as min/max
statistics.  Writers own disjoint (group, generation, batch_id) folders and
replace them whole, which is what makes a replayed batch harmless.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.options import TransferOptions
from spillway.schema import FILE_LOG_DATA, TOPIC_LOG

LAYOUT = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("group", T.StringType(), True),
    T.StructField("generation", T.IntegerType(), True),
    T.StructField("batch_id", T.LongType(), True),
])

FILE_LOG_SCHEMA = T.StructType(list(FILE_LOG_DATA.fields) + list(LAYOUT.fields))
_TOPIC_FOLDER_SCHEMA = T.StructType(list(FILE_LOG_DATA.fields) + [f for f in LAYOUT.fields if f.name != "topic"])
LOG_COLUMNS = [f.name for f in TOPIC_LOG.fields]


def read_file_log(spark: SparkSession, path: str, topic: str | None = None,
                  stream: bool = False, max_files_per_trigger: int | None = None,
                  keep_layout: bool = False, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Read a file log as TOPIC_LOG rows (optionally with the writer columns).

    A batch read of one topic includes folders that its writer has folded.  A stream's micro-batch is bounded by files or by bytes (files win)."""
    def bounded(reader):
        if max_files_per_trigger:
            return reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger)) if max_bytes_per_trigger else reader

    if stream and topic is not None:
        # A topic stream lists only the topic's own folder (the file stream
        # source takes no basePath, so `topic` is added back as a literal).
        reader = bounded(spark.readStream.schema(_TOPIC_FOLDER_SCHEMA))
        df = reader.parquet(f"{path.rstrip('/')}/topic={topic}").withColumn("topic", F.lit(topic))
    else:
        reader = spark.readStream if stream else spark.read
        reader = reader.schema(FILE_LOG_SCHEMA)
        if stream:
            reader = bounded(reader)
        df = reader.parquet(path)
        if topic is not None:
            df = df.where(F.col("topic") == F.lit(topic))
            if not stream and not keep_layout:
                df = _with_folds(spark, path, topic, df)
    cols = LOG_COLUMNS + ([f.name for f in LAYOUT.fields if f.name != "topic"] if keep_layout else [])
    return df.select(*cols)


def _with_folds(spark: SparkSession, path: str, topic: str, live: DataFrame) -> DataFrame:
    """The batch folders of a log that no fold stands for, and its folded folders."""
    from spillway.sources.manifest import folded_parts
    folded, covered = folded_parts(spark, path, topic)
    if not folded:
        return live
    rows = spark.read.schema(FILE_LOG_DATA).parquet(*folded).withColumn("topic", F.lit(topic))
    return live.where(~covered).select(*LOG_COLUMNS).unionByName(rows.select(*LOG_COLUMNS))


def kafka_source_options(opts: TransferOptions) -> dict[str, str]:
    """Options of Spark's Kafka source for a copy.

    `startingOffsets=latest` is the reference's start for a group without a
    stored position; Spark applies it only when the checkpoint is new, and
    resumes from the checkpoint otherwise (S2).  A reset (S3) is a new
    checkpoint generation, so it starts at latest again.
    """
    o = {
        "kafka.bootstrap.servers": opts.source,
        "subscribe": opts.topic,
        "startingOffsets": opts.start_at,
        "failOnDataLoss": str(opts.fail_on_data_loss).lower(),
        "minPartitions": str(opts.consumer_concurrency),
        "kafka.client.id": f"{opts.group}_consumer",
    }
    if opts.read_limit is not None:
        o["maxOffsetsPerTrigger"] = str(opts.read_limit)
    o.update(dict(opts.extra_source_options))
    return o


def read_kafka(spark: SparkSession, opts: TransferOptions, stream: bool = True) -> DataFrame:
    """TOPIC_LOG rows from Kafka (needs the spark-sql-kafka connector)."""
    reader = spark.readStream if stream else spark.read
    o = kafka_source_options(opts)
    if not stream:
        o.pop("maxOffsetsPerTrigger", None)
        o["startingOffsets"] = "earliest"
        o["endingOffsets"] = "latest"
    df = reader.format("kafka").options(**o).load()
    return df.select("topic", "partition", "offset", "key", "value", "timestamp")


def topic_source(spark: SparkSession, opts: TransferOptions, stream: bool = False) -> DataFrame:
    """S1 + P1: the configured topic from the configured source."""
    if opts.source_format == "kafka":
        return read_kafka(spark, opts, stream)
    return read_file_log(spark, opts.source, opts.topic, stream=stream,
                         max_files_per_trigger=opts.read_limit, max_bytes_per_trigger=opts.batch_bytes)
