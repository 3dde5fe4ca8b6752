"""The error budget.

The reference counts errors per client for the life of the process and stops
when the count goes over the maximum: the (max+1)-th error trips it.  In batch
form that is "the (max+1)-th failure of each scope": a row number compared with
max + 1, for which Spark keeps only the first max + 1 rows of each scope on the
map side, so a scope with very many failures costs no more than the others.  In a stream it is a running total
of rejected records for the run, kept on the driver as one number per batch
(see `spillway.streaming.transfer`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class BudgetExceeded(RuntimeError):
    """Raised when a copy has seen more failed records than it may."""


def budget_trips(failures: DataFrame, scope: Sequence[str], seq: str, max_errors: int) -> DataFrame:
    """Per scope that goes over the budget, the failure that trips it.

    Output: scope columns, `seq` of the tripping failure, `nth` (= max+1)."""
    order = Window.partitionBy(*scope).orderBy(seq)
    return (failures.select(*scope, seq).withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") == max_errors + 1)
            .select(*scope, seq, F.col("nth").cast("long").alias("nth")))


def over_budget(rejected_total: int, max_errors: int) -> bool:
    return rejected_total > max_errors
