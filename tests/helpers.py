"""Hand-written topic logs for property tests."""

from __future__ import annotations

import datetime as dt

from spillway.schema import TOPIC_LOG

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def log_rows(topic: str, partition: int, start: int, n: int, key=lambda o: f"k{o}".encode(),
             value=lambda o: f"v{o}".encode(), t0: dt.datetime = T0, step_s: int = 1):
    return [(topic, partition, o, key(o), value(o), t0 + dt.timedelta(seconds=o * step_s))
            for o in range(start, start + n)]


def make_log(spark, rows):
    return spark.createDataFrame(rows, TOPIC_LOG)


def as_set(df, cols=("topic", "key", "value")):
    return sorted(tuple(bytes(v) if isinstance(v, (bytes, bytearray)) else v for v in r)
                  for r in df.select(*cols).collect())
