"""Spark-native topic copy and copy metrics.

Main entry points::

    from spillway import TransferOptions, Transfer, run_transfer
    from spillway.operators import records, positions, metrics, points, budget
    from spillway.plans.copy import plan_copy_batch, copy_bounded
    from spillway.plans.monitoring import copy_lag, write_monitoring_points
"""

from spillway.options import TransferOptions  # noqa: F401


def __getattr__(name):  # lazy: importing the package does not start a JVM
    if name in ("Transfer", "run_transfer", "run_transfers"):
        from spillway.streaming import transfer
        return getattr(transfer, name)
    raise AttributeError(name)
