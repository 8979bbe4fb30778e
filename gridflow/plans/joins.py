"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it is checked to hold at most so many rows and bytes.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20
FIXED_BYTES = 16   # of a column in a row, besides what a string or binary value holds


def checked_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` if it holds at most ``max_rows`` rows and ``max_bytes`` bytes of values.

    The check reads at most ``max_rows + 1`` rows. Beyond the bounds the DataFrame is returned unchanged
    and the planner (AQE with runtime sizes) picks a shuffle join.
    """
    size = F.lit(FIXED_BYTES * len(dim.columns)).cast("long")
    for c, kind in dim.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
        elif not kind.startswith(("int", "bigint", "smallint", "tinyint", "boolean", "double", "float", "date", "timestamp", "decimal")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0))
    n, held = dim.limit(max_rows + 1).select(size.alias("_size")).agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first()
    return F.broadcast(dim) if n <= max_rows and held <= max_bytes else dim
