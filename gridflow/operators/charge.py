"""District balance and clamped accumulator charge.

The accumulator follows ``charge = max(0, charge + x)``. Its closed form is
``S_n - least(0, min_{k<=n} S_k)`` with ``S`` the running sum of ``x`` (the
Lindley recursion), so the whole history is two running window aggregates.
Readings are first reduced to one row per (district, step): districts are few
and therefore hot, and the reduction is partial-aggregated map-side, so no task
ever sees a district's raw readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflow import config as C

# power in hundredths may carry six decimals of its own (``parse.EXACT``)
DEC = "decimal(38,6)"
POWER, MS = "decimal(28,6)", "decimal(20,0)"


def batch_balance(readings: DataFrame, step_ms: int) -> DataFrame:
    """Per district and event-time step: summed power, reading count, max time."""
    step = F.floor(F.col("t") / F.lit(step_ms)).cast("long")
    return (readings.where(F.col("district_id").isNotNull() & F.col("v100").isNotNull()
                           & F.col("t").isNotNull())
                    .groupBy("district_id", step.alias("step"))
                    .agg(F.sum("v100").alias("balance_v100"),
                         F.count(F.lit(1)).alias("num_measurements"),
                         F.max("t").alias("max_t")))


def clamped_running_sum(df: DataFrame, key: str, order: str, x: str, out: str) -> DataFrame:
    """Add ``out`` = max(0, previous + x) accumulated per ``key`` in ``order``
    (exact decimals, closed form)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = F.sum(F.col(x).cast(DEC)).over(w)
    return (df.withColumn("_S", s)
              .withColumn(out, F.col("_S") - F.least(F.lit(0).cast(DEC), F.min("_S").over(w)))
              .drop("_S"))


def district_charge(readings: DataFrame, step_ms: int = C.MS_PER_HOUR) -> DataFrame:
    """Accumulator charge per district after each event-time step.

    Each step integrates its summed power over the time between the previous
    and the current maximum event time (the clock never moves back); the first
    step integrates nothing, and a non-positive clock counts as never seen.
    """
    b = batch_balance(readings, step_ms)
    w = Window.partitionBy("district_id").orderBy("step")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("clock", F.max("max_t").over(run))
    b = b.withColumn("prev_clock", F.lag("clock").over(w))
    x = F.when(F.col("prev_clock") > 0,
               (F.col("balance_v100").cast(POWER) * (F.col("clock") - F.col("prev_clock")).cast(MS)).cast(DEC)) \
         .otherwise(F.lit(0).cast(DEC))
    b = clamped_running_sum(b.withColumn("_x", x), "district_id", "step", "_x", "_charge")
    return b.select(
        "district_id", "step",
        (F.col("balance_v100") / F.lit(100.0)).alias("batch_balance_kw"),
        "num_measurements", F.col("clock").alias("max_event_ms"),
        (F.col("_charge").cast("double") / F.lit(float(C.CENTI_KW_MS_PER_KWH))).alias("charge_kwh"))


def district_balance_step(values: DataFrame) -> DataFrame:
    """Sum of member values per (district, step) (partial + final aggregate)."""
    return values.groupBy("district", "step").agg(
        F.sum("v100").alias("balance_v100"), F.count(F.lit(1)).alias("members"))


def step_charge(balances: DataFrame, key: str = "district", order: str = "step",
                balance: str = "balance_v100") -> DataFrame:
    """Fixed-step charge: each step adds balance / 60 (kW over one minute), clamped at 0."""
    b = clamped_running_sum(balances, key, order, balance, "_charge")
    return b.withColumn("charge_kwh", F.col("_charge").cast("double")
                        / F.lit(100.0 * C.STEP_HOURS_DIVISOR)).drop("_charge")


# fixed value: the text form of a charge update
CHARGE_UPDATE_FORMAT = "district=%s batchBalance=%.2fkW numMeasurements=%d accumulatorCharge=%.4fkWh"


def charge_update_text(updates: DataFrame) -> DataFrame:
    """One line per charge update, fixed decimals (2 for power, 4 for energy)."""
    return updates.select("district_id", "step", F.format_string(
        CHARGE_UPDATE_FORMAT, F.col("district_id"), F.col("batch_balance_kw"), F.col("num_measurements"),
        F.col("charge_kwh")).alias("text"))
