"""Positions within a group, without putting a whole group in one task.

A log assigns each record of a partition the next offset; an error budget needs
the n-th failure of a scope.  Both are "position of a row within its group".
`row_number()` over `Window.partitionBy(group)` would sort a whole group in one
task; if one partition or scope holds a third of all rows, that task holds a
third of the data.  Here the group is cut into fixed-width ranges of the order
column first:

1. every row is numbered inside its (group, range) slice - one hash exchange on
   (group, range), so a hot group is spread over as many tasks as it has slices;
2. slice sizes are counted with a partial (map-side) aggregate;
3. each slice's base is the running total of the sizes of the slices before it
   (a window over the small slice table: one row per slice, not per record);
4. the bases are joined back on (group, range).  The numbered side already has
   that partitioning, so only the small side moves (or is broadcast by AQE).

Per-task work is bounded: the numbering window sorts at most `slice_width`
rows (order values are unique within a group), and the base window of one group
holds at most (order range of the group / slice_width) narrow rows - about a million for
dense offsets or event ids of a trillion-row log.  Nothing else is per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spillway.functions import whole_div

DEFAULT_SLICE_WIDTH = 1 << 20


def sequence_within(df: DataFrame, group: Sequence[str], order: str, out: str,
                    slice_width: int = DEFAULT_SLICE_WIDTH) -> DataFrame:
    """Add ``out`` = 0-based position of each row within ``group`` by ``order``.

    ``order`` must be an integral column, unique within a group (for a stable
    numbering on replay).  A slice holds at most ``slice_width`` consecutive
    order values, which bounds the rows one task sorts when order values are
    unique.
    """
    group = list(group)
    sliced = df.withColumn("_slice", whole_div(F.col(order).cast("long"), slice_width))
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(order)) - 1)
    sizes = sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (local.join(bases, [*group, "_slice"])
            .withColumn(out, (F.col("_base") + F.col("_local")).cast("long"))
            .drop("_slice", "_local", "_base"))
