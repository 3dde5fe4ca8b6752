"""Options of a copy, as one frozen dataclass.

The reference takes 18 command-line flags; the ones that shape data or delivery
are kept here under plain names.  Its defaults are kept where they carry
meaning; the source and destination are given, never defaulted.
"""

from __future__ import annotations

import dataclasses
import socket

DEFAULT_GROUP_SUFFIX = "spillway"
CLIENT_ID = "spillway_copy"
DEFAULT_BATCH_BYTES = 64 << 30
# Fixed values that must equal the reference's.
DEFAULT_MAX_ERRORS = 10
DEFAULT_MAX_RETRY = 5
DEFAULT_FLUSH_INTERVAL_MS = 10000
DEFAULT_CONSUMER_CONCURRENCY = 4
METRIC_FLUSH_SECONDS = 5
HOST_FALLBACK = "N/A"


def host_name() -> str:
    try:
        return socket.gethostname() or HOST_FALLBACK
    except OSError:
        return HOST_FALLBACK


@dataclasses.dataclass(frozen=True)
class TransferOptions:
    """Everything one copy needs.

    source / destination: a parquet file-log folder, or Kafka bootstrap servers
    when the matching ``*_format`` is ``"kafka"``.
    state_path: where checkpoints, frozen start positions, commits, audit and
    quarantine live; ``None`` = under the session's checkpoint dir.
    read_limit: records per micro-batch (Kafka, and a file log read by offset
    ranges) or files (a file log read as files); unset by default, as the
    reference's buffer bounds memory, not rate.
    offset_ranges: read a file log by offset ranges from its manifest instead of
    file by file (`spillway.sources.ranges`).
    retry_failed: a record that fails is sent again in later batches, up to
    `max_retry` times, before it counts as failed; `reject_when` may name the
    number of the `attempt` (from 1).  Needs offset_ranges.
    keep_manifest: keep a manifest of the destination file log and fold its
    batch folders; its readers must read by offset ranges.
    batch_bytes: source bytes per micro-batch of a file log while read_limit is
    unset, so that a backlog of any size is copied in bounded batches.
    fold_batches: after so many batches the audit and commit folders are folded into one.
    monitor_seconds: how often points are written when metrics_path is set.
    producer_concurrency: ``None`` keeps the read parallelism for the write (no
    exchange); a number adds one round-robin exchange to that many writers.
    """

    topic: str
    source: str
    destination: str
    source_format: str = "file"
    destination_format: str = "file"
    group_suffix: str = DEFAULT_GROUP_SUFFIX
    state_path: str | None = None
    read_limit: int | None = None
    offset_ranges: bool = False
    keep_manifest: bool = False
    batch_bytes: int = DEFAULT_BATCH_BYTES
    fold_batches: int = 1000
    monitor_seconds: float = METRIC_FLUSH_SECONDS
    max_errors: int = DEFAULT_MAX_ERRORS
    max_retry: int = DEFAULT_MAX_RETRY
    retry_failed: bool = False
    flush_interval_ms: int = DEFAULT_FLUSH_INTERVAL_MS
    reset: bool = False
    # "latest" is the reference's start for a group without a stored position;
    # "earliest" copies the backlog too (the historical transfer it plans).
    start_at: str = "latest"
    compression: str = "gzip"
    consumer_concurrency: int = DEFAULT_CONSUMER_CONCURRENCY
    producer_concurrency: int | None = None
    destination_partitions: int = 24
    preserve_nulls: bool = False
    reject_when: str | None = None
    quarantine: bool = True
    # Records that aged out of the source before they were copied end the copy
    # with an error; False skips them (the copy is then not complete).
    fail_on_data_loss: bool = True
    metrics_path: str | None = None
    host: str = dataclasses.field(default_factory=host_name)
    extra_source_options: tuple[tuple[str, str], ...] = ()
    extra_sink_options: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if not self.topic:
            raise ValueError("topic is required")
        for name in ("source_format", "destination_format"):
            if getattr(self, name) not in ("file", "kafka"):
                raise ValueError(f"{name} must be 'file' or 'kafka'")
        if self.offset_ranges and self.source_format != "file" or self.keep_manifest and self.destination_format != "file":
            raise ValueError("offset_ranges and keep_manifest are for file logs")
        if self.retry_failed and not self.offset_ranges:
            raise ValueError("retry_failed needs offset_ranges")
        if self.max_retry < 0:
            raise ValueError("max_retry must be >= 0")
        if self.start_at not in ("latest", "earliest"):
            raise ValueError("start_at must be 'latest' or 'earliest'")
        if self.max_errors < 0:
            raise ValueError("max_errors must be >= 0")
        if self.read_limit is not None and self.read_limit <= 0:
            raise ValueError("read_limit must be positive")
        if self.fold_batches <= 0:
            raise ValueError("fold_batches must be positive")
        if self.batch_bytes <= 0:
            raise ValueError("batch_bytes must be positive")
        if self.destination_partitions <= 0:
            raise ValueError("destination_partitions must be positive")
        if self.flush_interval_ms <= 0:
            raise ValueError("flush_interval_ms must be positive")
        if self.producer_concurrency is not None and self.producer_concurrency <= 0:
            raise ValueError("producer_concurrency must be positive")

    @property
    def group(self) -> str:
        """Consumer group name, ``<topic>_<suffix>``."""
        return f"{self.topic}_{self.group_suffix}"

    @property
    def trigger_interval(self) -> str:
        return f"{self.flush_interval_ms} milliseconds"

    def __repr__(self) -> str:  # never print credentials that may sit in extra options
        hidden = {"extra_source_options", "extra_sink_options"}
        shown = ", ".join(f"{f.name}={getattr(self, f.name)!r}"
                          for f in dataclasses.fields(self) if f.name not in hidden)
        return f"TransferOptions({shown}, ...)"
