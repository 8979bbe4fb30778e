"""Named queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the gridflow operator on the
views of ``gridflow.sources.views``; ``ORACLE[name]`` is SQL computing the same
result on the raw driver tables (views inlined from ``oracle_views``). Column
names agree on both sides.
"""

from __future__ import annotations

from gridflow.plans.named import ORACLE, QUERIES, register  # noqa: F401
from gridflow.plans.queries import billing_q, registry_q, charge_q, twin_q, topology_q, stream_q, log_q  # noqa: F401,E402
