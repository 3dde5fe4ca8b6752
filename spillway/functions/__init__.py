"""Column expressions.  All are built-in Spark functions, so they stay inside
whole-stage codegen; none needs a Python UDF."""

from spillway.functions.columns import (  # noqa: F401
    as_text,
    empty_bytes,
    group_name,
    next_tick,
    null_to_empty,
    round_robin,
    second_bucket,
    series_key,
    to_ntz,
    truncate_time,
    whole_div,
)
