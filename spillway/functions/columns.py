from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_bytes() -> Column:
    """A zero-length BINARY literal (not null)."""
    return F.unhex(F.lit(""))


def null_to_empty(c: str | Column) -> Column:
    """A null key or value becomes empty bytes.

    The reference passes both through a string conversion whose nil is "", so a
    tombstone stops being one on the way.
    """
    return F.coalesce(_c(c), empty_bytes())


def as_text(c: str | Column) -> Column:
    """Show a BINARY payload as text in reports (UTF-8; bytes are never altered
    on the copy path itself)."""
    return _c(c).cast("string")


def group_name(topic: str | Column, suffix: str | Column) -> Column:
    """Consumer group ``<topic>_<suffix>``."""
    return F.concat_ws("_", _c(topic), suffix if isinstance(suffix, Column) else F.lit(suffix))


def to_ntz(c: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (wall clock in the session zone, UTC here)."""
    return _c(c).cast("timestamp_ntz")


def truncate_time(c: str | Column) -> Column:
    """P5: metric time at second precision, kept in the input's timestamp type."""
    col = _c(c)
    return F.date_trunc("second", col)


def whole_div(c: Column, n: int) -> Column:
    """Whole-number quotient of a non-negative BIGINT or an exact multiple of n (`div`: no double on the way)."""
    return F.call_function("div", c, F.lit(n).cast("long"))


def second_bucket(c: str | Column, seconds: int) -> Column:
    """Start of the fixed ``seconds``-wide bucket holding a timestamp, as epoch
    seconds (BIGINT).  Integer arithmetic: no struct, no zone, stays in codegen."""
    m = F.unix_micros(_c(c).cast("timestamp"))
    return whole_div(m - F.pmod(m, F.lit(1_000_000 * seconds)), 1_000_000)


def next_tick(c: str | Column, seconds: int) -> Column:
    """The first multiple of ``seconds`` at or after a timestamp (a flush tick)."""
    m = F.unix_micros(_c(c).cast("timestamp"))
    return F.timestamp_micros(m + F.pmod(-m, F.lit(1_000_000 * seconds)))


def round_robin(offset: str | Column, source_partition: str | Column, n: int) -> Column:
    """Destination partition, ignoring the key.

    ``pmod(offset + source_partition, n)`` walks the destination partitions in
    turn along each source partition, so it is even, stateless and the same when
    a batch is replayed.  (Row numbers and monotonically increasing ids are
    refused on streams, and would change on replay.)
    """
    return F.pmod(_c(offset) + _c(source_partition), F.lit(n)).cast("int")


def series_key(measurement: str | Column, tags: str | Column) -> Column:
    """Line-protocol series key: ``measurement,k1=v1,k2=v2`` with tags sorted."""
    pairs = F.transform(F.map_entries(_c(tags)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat_ws(",", _c(measurement), F.array_join(F.array_sort(pairs), ","))
