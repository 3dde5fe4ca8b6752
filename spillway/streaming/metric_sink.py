"""The metric sink.

The reference collects points and writes them together every 5 seconds; a
failed write is logged and lost.  Here points are a table (POINTS schema,
partitioned by measurement and by writer batch).  A writer names itself and the
batch; writing a batch again replaces it, so a failed write is retried, not
lost.  The writer of a running copy is `spillway.plans.monitoring.Monitor`:
its name holds the group and the generation, and each of its batches covers
seconds that no other batch covers, so a table has one row per series and time.

Spark sorts what it writes with `partitionBy` by the folder columns, and a point
with its two maps is some thirty times as large in that sort as its row in the
shuffle before.  The folder of a known measurement is therefore written by a job
of its own, straight from the rows and without a sort.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.operators.points import MEASUREMENTS
from spillway.schema import POINTS
from spillway.sinks.file_log import run_concurrently, write_folder, write_partitioned
from spillway.streaming import fs

POINT_FILE = T.StructType(list(POINTS.fields) + [
    T.StructField("writer", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])


def write_points(points: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Replace the points of (writer, batch_id); one folder per measurement.

    A measurement without points in `points` keeps what it has.  `points` is
    read once per measurement; a branch of a union whose measurement is a
    literal is run by its own job alone."""
    rows = points.select(*[f.name for f in POINTS.fields])
    spark = rows.sparkSession

    def one(measurement: str) -> None:
        folder = fs.partition_folder(spark, path, measurement=measurement, writer=writer, batch_id=batch_id)
        write_folder(rows.where(F.col("measurement") == measurement).drop("measurement"), path, folder)

    def rest() -> None:
        other = rows.where(~F.coalesce(F.col("measurement").isin(*MEASUREMENTS), F.lit(False)))
        write_partitioned(other.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long")),
                          path, ["measurement", "writer", "batch_id"])

    run_concurrently([*(functools.partial(one, m) for m in MEASUREMENTS), rest])


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POINT_FILE).parquet(path)
