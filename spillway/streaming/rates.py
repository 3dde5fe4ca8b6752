"""M1/M2 as a stream: records per second of an audit stream, idle seconds included.

The audit stream has a watermark.  Each Arrow batch adds up its rows by series and second
before the exchange, so a busy series is a few rows; keyed state adds them up over batches
and emits a chunk of seconds once the watermark is behind it.  A timer closes the chunks in
which nothing came.  Rows later than the watermark allows are not counted; all others are,
in whatever order they arrive, so the result is that of `metrics.packed_throughput` over
the same rows.  The state of a series is the seconds of its open chunks.  (Spark refuses
keyed state behind a streaming aggregate in append mode, so the sums are taken there.)

Nothing closes while no row comes.  `beats` is a stream of times that moves the watermark
on: Spark's `rate` source beside a running copy.

`start_point_query` is T2 as a query of its own (in place of a thread beside the copy):
each of its batches writes the points of the seconds it closed, under its batch id, so a
batch that is repeated after a failure replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from spillway.operators import points
from spillway.operators.metrics import DENSE_CHUNK
from spillway.options import METRIC_FLUSH_SECONDS
from spillway.schema import AUDIT
from spillway.streaming.metric_sink import write_points

LATENESS = "10 seconds"
ROWS = 10_000  # rows of an output frame


def _functions(since: int, chunk: int):
    """The two functions that run in Python workers; made here, so that a worker needs no module of this package."""
    import pandas as pd

    def sums(frames):
        for f in frames:
            yield f.groupby(["topic", "client_type", "at"], dropna=False, as_index=False)["n"].sum()

    def close(key, frames, state):
        if key[0] is None:  # beats
            return
        start, seconds, n = state.get if state.exists else (since - since % chunk, [], [])
        found = dict(zip(seconds, n, strict=True))
        for f in frames:
            for second, records in zip(f["second"].tolist(), f["n"].tolist(), strict=True):
                found[second] = found.get(second, 0) + records
        closed = state.getCurrentWatermarkMs() // 1000
        until = max(start, closed - closed % chunk)
        idle, busy = ",".join(["0"] * chunk), {s - s % chunk for s in found}
        for first in range(start, until, chunk * ROWS):
            starts = range(first, min(until, first + chunk * ROWS), chunk)
            values = [",".join(str(found.get(s, 0)) for s in range(c, c + chunk)) if c in busy else idle for c in starts]
            yield pd.DataFrame({"topic": key[0], "client_type": key[1], "start": list(starts), "records": values})
        left = {s: v for s, v in found.items() if s >= until}
        state.update((until, list(left), list(left.values())))
        state.setTimeoutTimestamp((until + chunk) * 1000)

    return sums, close


def closed_chunks(audit: DataFrame, since: int, lateness: str = LATENESS, chunk: int = DENSE_CHUNK, beats: DataFrame | None = None) -> DataFrame:
    """A stream of audit rows (topic, client_type, n, at) -> (topic, client_type, start, records).

    A row is `chunk` whole seconds from `start` (epoch seconds, a multiple of `chunk`): the values in time order,
    comma-joined, as `packed_throughput` has them.  Every series begins with the chunk of the second `since`,
    which no row may precede, and has a row for each chunk behind which the watermark is.  `beats`: a stream with a
    column `at`.
    """
    sums, close = _functions(since, chunk)
    rows = audit.select("topic", "client_type", F.date_trunc("second", "at").alias("at"), "n")
    if beats is not None:
        none = F.lit(None).cast("string")
        rows = rows.unionByName(beats.select(none.alias("topic"), none.alias("client_type"), "at", F.lit(0).cast("long").alias("n")))
    slim = "topic string, client_type string, at timestamp, n long"
    counted = rows.mapInPandas(sums, slim).withWatermark("at", lateness).withColumn("second", F.unix_seconds("at"))
    return counted.groupBy("topic", "client_type").applyInPandasWithState(
        close, "topic string, client_type string, start long, records string",
        "start long, seconds array<long>, n array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def audit_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The audit rows under `folder` (a copy's `audit`) as a stream, in batches of their own."""
    return spark.readStream.schema(AUDIT).parquet(folder)


def start_point_query(audit: DataFrame, path: str, writer: str, host: str, since: int, checkpoint: str, lateness: str = LATENESS,
                      beats: DataFrame | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Write the rps_stats points of an audit stream to the point table, every 5 s unless `trigger` says otherwise."""
    def write(closed: DataFrame, batch_id: int) -> None:
        seconds = closed.select("topic", "client_type", F.timestamp_seconds("start").cast("timestamp_ntz").alias("time"),
                                F.col("records").cast("long").alias("records"))
        write_points(points.rps_points(seconds, host), path, writer, batch_id)

    stream = closed_chunks(audit, since, lateness, 1, beats)
    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"processingTime": f"{METRIC_FLUSH_SECONDS} seconds"})).start())
