"""K1/K3: writing topic records and engine tables, replay-safe.

Every write names its (group, generation, batch_id) folder.  The folder appears
whole, by one rename at the end of its write (dynamic partition overwrite), so a
folder that is there is complete: a copy that repeats a batch after a failure
keeps it as it is (`write_once`), and what has already been read from it stays
true.  On a store whose renames are not atomic a half-made folder may be kept;
use a committer that writes folders whole there.  Batch ids start at 0 again in
every new checkpoint, which is why the generation is part of the folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.options import CLIENT_ID, TransferOptions
from spillway.streaming import fs

WRITER_COLUMNS = ("group", "generation", "batch_id")


def _tag(df: DataFrame, group: str | Column, generation: int, batch_id: int) -> DataFrame:
    """Writer columns; `group` may be a column (one group per topic)."""
    return (df.withColumn("group", group if isinstance(group, Column) else F.lit(group))
              .withColumn("generation", F.lit(generation).cast("int"))
              .withColumn("batch_id", F.lit(batch_id).cast("long")))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      compression: str = "snappy") -> None:
    """Replace only the folders present in `df` under `path`."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(*partition_by)
       .parquet(path))


def write_folder(df: DataFrame, root: str, folder: str, compression: str = "snappy") -> None:
    """Replace one folder under `root`, as `write_partitioned` does when `df` has the rows of that folder alone, without
    its sort by folder: the rows go to a hidden folder, which becomes `folder` by one rename.  No rows: `folder` stays."""
    spark = df.sparkSession
    staged = f"{root.rstrip('/')}/.staged-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", compression).parquet(staged)
        if not spark.read.schema(df.schema).parquet(staged).isEmpty():
            fs.replace(spark, staged, folder)
    finally:
        fs.delete(spark, staged)


def write_log_batch(records: DataFrame, root: str, group: str | Column, generation: int, batch_id: int,
                    compression: str = "gzip") -> None:
    """Append one batch of log records (topic, partition, offset, key, value,
    timestamp) to a file log.  Rows are sorted by (partition, offset) inside
    each task (no exchange) so readers can skip row groups by offset; the
    folder columns lead the sort, so the writer adds no sort of its own."""
    out = _tag(records.select("topic", "partition", "offset", "key", "value", "timestamp"),
               group, generation, batch_id).sortWithinPartitions("topic", *WRITER_COLUMNS, "partition", "offset")
    write_partitioned(out, root, ["topic", *WRITER_COLUMNS], compression)


def write_topic_log(log: DataFrame, root: str, group: str = "seed", generation: int = 0,
                    batch_id: int = 0, compression: str = "snappy") -> None:
    """Write a whole TOPIC_LOG DataFrame as one batch of a file log."""
    write_log_batch(log, root, group, generation, batch_id, compression)


def write_table_batch(rows: DataFrame, root: str, group: str | Column, generation: int,
                      batch_id: int) -> None:
    """Append one batch of an engine table (audit, commits, quarantine)."""
    write_partitioned(_tag(rows.drop(*WRITER_COLUMNS), group, generation, batch_id),
                      root, list(WRITER_COLUMNS))


def write_once(spark: SparkSession, folder: str, write: Callable[[], None]) -> bool:
    """Run `write` unless its folder is already there; says whether it ran."""
    if fs.exists(spark, folder):
        return False
    write()
    return True


def kafka_sink_options(opts: TransferOptions) -> dict[str, str]:
    """K2/K3 on Spark's Kafka sink: gzip, leader-only acknowledgement, the
    reference's retry count and client id, and the flush interval as linger.
    (`batch.size` counts bytes, so the reference's 500 messages has no equal.)
    """
    o = {
        "kafka.bootstrap.servers": opts.destination,
        "topic": opts.topic,
        "kafka.compression.type": "gzip",
        "kafka.acks": "1",
        "kafka.retries": str(opts.max_retry),
        "kafka.client.id": CLIENT_ID,
        "kafka.linger.ms": str(opts.flush_interval_ms),
    }
    o.update(dict(opts.extra_sink_options))
    return o


def write_kafka_batch(records: DataFrame, opts: TransferOptions) -> None:
    """K1 on Kafka: (topic, partition, key, value); the explicit partition
    column keeps the round-robin placement (the producer would hash the key)."""
    (records.select("topic", F.col("partition").cast("int"), "key", "value")
     .write.format("kafka").options(**kafka_sink_options(opts)).save())



def run_concurrently(writes: list[Callable[[], None]]) -> None:
    """Run independent writes as concurrent Spark jobs and re-raise the first
    failure.  Used for the small state tables of a batch, which a failed batch
    rewrites whole on replay anyway.  `InheritableThread` carries the caller's
    Spark job properties (a streaming query's job group), so stopping the query
    cancels these jobs too."""
    if len(writes) <= 1:
        for w in writes:
            w()
        return
    errors: list[BaseException] = []

    def run(w: Callable[[], None]) -> None:
        try:
            w()
        except BaseException as e:  # noqa: BLE001 - re-raised below
            errors.append(e)

    threads = [InheritableThread(target=run, args=(w,)) for w in writes]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
