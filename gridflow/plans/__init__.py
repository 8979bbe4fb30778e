"""Plan-level building blocks: skew-safe ordered scans, checked joins, plan checks,
and the catalog of named queries over the driver tables."""
