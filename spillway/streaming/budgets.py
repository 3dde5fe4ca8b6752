"""C1 in a stream: one error budget per client, in keyed state.

The state of a client is how many of its records have failed so far.  It lives in
the query's checkpoint, so a restart goes on with the same budgets; clients that have
used theirs up don't touch the others'.  Before the rows of a batch meet in their
client's task, each Arrow batch keeps what can matter of a client: how many failed and
the first few of them; so a client that holds most of a batch is a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from spillway.options import DEFAULT_MAX_ERRORS


def _functions(key: str, order: str, most: int):
    """The two functions that run in Python workers; made here, so that a worker needs no module of this package."""
    import pandas as pd

    def first_of(frames):
        for f in frames:
            rows = f.sort_values(order, kind="stable")
            sizes = rows.groupby(key)[order].transform("size")
            at = rows.groupby(key).cumcount()
            yield rows.assign(n=sizes.where(at == 0, 0))[at <= most]

    def count(client, frames, state):
        seen = state.get[0] if state.exists else 0
        total, first = 0, []
        for f in frames:
            total += int(f["n"].sum())
            first = sorted(first + f[order].tolist())[:most + 1]  # no later one can be the one that goes over
        state.update((seen + total,))
        if seen <= most < seen + total:
            yield pd.DataFrame({key: [client[0]], order: [first[most - seen]], "nth": [most + 1]})

    return first_of, count


def client_budgets(failed: DataFrame, key: str, order: str, max_errors: int = DEFAULT_MAX_ERRORS) -> DataFrame:
    """A stream of failed records -> (key, order, nth): per client the record that goes over its budget, once.

    Records count in the order of the batches, and inside a batch by `order` (a
    long, unique for a client).  Records without a client have no budget.
    """
    if max_errors < 0:
        raise ValueError("max_errors must be >= 0")
    first_of, count = _functions(key, order, max_errors)
    slim = failed.select(key, order).where(failed[key].isNotNull())
    counted = slim.mapInPandas(first_of, T.StructType([*slim.schema.fields, T.StructField("n", T.LongType())]))
    out = T.StructType([*slim.schema.fields, T.StructField("nth", T.LongType())])
    return counted.groupBy(key).applyInPandasWithState(count, out, "seen long", "append", GroupStateTimeout.NoTimeout)
