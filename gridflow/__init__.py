"""gridflow: metered power networks and IoT device twins on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame built from native
Spark expressions (windows, joins, aggregates). Stateful streaming forms live in
``gridflow.streaming``. Named, runnable queries over the driver tables live in
``gridflow.plans.catalog``.
"""

from gridflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
