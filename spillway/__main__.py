"""Run a copy from the command line (e.g. under spark-submit).

    python -m spillway --topic t --source /logs/src --destination /logs/dst [--reset-offset] ...

The flags mirror the reference's where they have a Spark meaning; the copy
itself is `spillway.streaming.transfer.Transfer`.  Credentials are never printed.
"""

from __future__ import annotations

import argparse
import signal
import sys

from spillway.options import (DEFAULT_FLUSH_INTERVAL_MS, DEFAULT_GROUP_SUFFIX, DEFAULT_MAX_ERRORS,
                              DEFAULT_MAX_RETRY, TransferOptions)


def parse(argv: list[str]) -> tuple[TransferOptions, str]:
    p = argparse.ArgumentParser(prog="spillway", description="Copy one topic from one log to another.")
    p.add_argument("--topic", required=True)
    p.add_argument("--source", required=True, help="file-log folder, or Kafka bootstrap servers")
    p.add_argument("--destination", required=True, help="file-log folder, or Kafka bootstrap servers")
    p.add_argument("--source-format", choices=("file", "kafka"), default="file")
    p.add_argument("--destination-format", choices=("file", "kafka"), default="file")
    p.add_argument("--cg-name-suffix", default=DEFAULT_GROUP_SUFFIX)
    p.add_argument("--state-path", default=None, help="default: <spark.checkpoint.dir>/spillway")
    p.add_argument("--read-limit", type=int, default=None,
                   help="records (Kafka) or files (file log) per micro-batch; unset by default")
    p.add_argument("--max-errors", type=int, default=DEFAULT_MAX_ERRORS)
    p.add_argument("--max-retry", type=int, default=DEFAULT_MAX_RETRY)
    p.add_argument("--flush-interval", type=int, default=DEFAULT_FLUSH_INTERVAL_MS, help="ms")
    p.add_argument("--reset-offset", action="store_true")
    p.add_argument("--start-at", choices=("latest", "earliest"), default="latest")
    p.add_argument("--destination-partitions", type=int, default=24)
    p.add_argument("--producer-concurrency", type=int, default=None)
    p.add_argument("--consumer-concurrency", type=int, default=4)
    p.add_argument("--reject-when", default=None, help="SQL predicate of records that fail")
    p.add_argument("--metrics-path", default=None)
    p.add_argument("--trigger", choices=("interval", "available_now", "once"), default="interval")
    a = p.parse_args(argv)
    opts = TransferOptions(
        topic=a.topic, source=a.source, destination=a.destination, source_format=a.source_format,
        destination_format=a.destination_format, group_suffix=a.cg_name_suffix, state_path=a.state_path,
        read_limit=a.read_limit, max_errors=a.max_errors, max_retry=a.max_retry,
        flush_interval_ms=a.flush_interval, reset=a.reset_offset, start_at=a.start_at,
        destination_partitions=a.destination_partitions, producer_concurrency=a.producer_concurrency,
        consumer_concurrency=a.consumer_concurrency, reject_when=a.reject_when, metrics_path=a.metrics_path)
    return opts, a.trigger


def main(argv: list[str] | None = None) -> int:
    opts, trigger = parse(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from spillway.session import configure
    from spillway.streaming.transfer import Transfer
    spark = configure(SparkSession.builder.appName(f"spillway-{opts.group}")).getOrCreate()
    t = Transfer(spark, opts)
    t.start(trigger)
    # SIGINT / SIGTERM stop the query; a batch cut short is replayed from the
    # checkpoint on the next start (nothing queued is lost, unlike a process
    # that exits with records in memory).
    for sig in (signal.SIGINT, signal.SIGTERM):
        signal.signal(sig, lambda *_: t.request_stop())
    t.finish()
    return 0


if __name__ == "__main__":
    sys.exit(main())
