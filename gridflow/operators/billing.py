"""Count-window billing of readings per node.

Input ``readings``: off, node_id, node_type, district_id, v100 (centi-kW), t (ms).
Energy is kept as an exact integer (centi-kW x ms) and converted to kWh once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.functions.expr import cost_from_energy, kwh, tariff_hundredths
from gridflow.operators.parse import keyed_log
from gridflow.plans.ordered import ordered_scan


def energy_integration(readings: DataFrame, **split) -> DataFrame:
    """Per reading: |power| x time since the node's previous reading in arrival
    order (0 for the first reading or when the clock did not advance).

    Adds pos (1-based arrival position per node), prev_t, dt_ms, energy (centi-kW x ms).
    """
    s = ordered_scan(readings, ["node_id"], "off", position="pos", lags={"t": "prev_t"}, **split)
    dt = F.greatest(F.coalesce(F.col("t") - F.col("prev_t"), F.lit(0)), F.lit(0))
    return (s.withColumn("dt_ms", dt.cast("long"))
             .withColumn("energy", F.abs(F.col("v100")) * F.col("dt_ms")))


def tariff_cost(integrated: DataFrame) -> DataFrame:
    """Cost of each reading's energy at its node type's tariff."""
    return integrated.select(
        "off", "node_id", "node_type", "energy",
        kwh(F.col("energy")).alias("energy_kwh"),
        (F.col("energy") * tariff_hundredths(F.col("node_type"))).alias("cost_num"),
        cost_from_energy(F.col("energy"), F.col("node_type")).alias("cost"),
    )


def running_window_energy(integrated: DataFrame, size: int = C.BILLING_WINDOW_SIZE) -> DataFrame:
    """After each reading: its billing window, position k in the window and the
    energy accumulated in the window so far."""
    win = F.floor((F.col("pos") - 1) / size).cast("long")
    w = (Window.partitionBy("node_id", "window_no").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (integrated.withColumn("window_no", win)
                      .withColumn("k", ((F.col("pos") - 1) % size + 1).cast("int"))
                      .withColumn("window_energy", F.sum("energy").over(w))
                      .withColumn("window_energy_kwh", kwh(F.col("window_energy"))))


def billing_windows(readings: DataFrame, size: int = C.BILLING_WINDOW_SIZE, **split) -> DataFrame:
    """One billing record per complete window of ``size`` readings per node.

    Type and district are the last reading's; period start / end are the first
    and last readings' times in arrival order; incomplete windows emit nothing.
    ``off`` is the arrival position of the reading that closed the window.
    """
    e = energy_integration(readings, **split).withColumn(
        "window_no", F.floor((F.col("pos") - 1) / size).cast("long"))
    g = (e.groupBy("node_id", "window_no")
          .agg(F.count(F.lit(1)).alias("n"),
               F.sum("energy").alias("energy"),
               F.max_by("node_type", "pos").alias("node_type"),
               F.max_by("district_id", "pos").alias("district_id"),
               F.min_by("t", "pos").alias("period_start"),
               F.max_by("t", "pos").alias("period_end"),
               F.max("off").alias("off"))
          .where(F.col("n") == size))
    return g.select(
        "off", "node_id", "window_no", "node_type", "district_id",
        F.col("energy").alias("energy_ckwms"),
        kwh(F.col("energy")).alias("total_energy_kwh"),
        (F.col("energy") * tariff_hundredths(F.col("node_type"))).alias("cost_num"),
        cost_from_energy(F.col("energy"), F.col("node_type")).alias("cost"),
        F.col("n").cast("int").alias("measurement_count"),
        "period_start", "period_end",
    )


# ---- billing records: bills as they are stored -------------------------------------

# fixed values: JSON names of a record's fields
RECORD_FIELDS = {"type": "type", "nodeId": "node_id", "nodeType": "node_type", "districtId": "district_id",
                 "totalEnergyKwh": "total_energy_kwh", "cost": "cost", "measurementCount": "measurement_count",
                 "periodStart": "period_start", "periodEnd": "period_end"}
RECORD_JSON = ("type string, nodeId string, nodeType string, districtId string, totalEnergyKwh double, cost double, "
               "measurementCount int, periodStart long, periodEnd long")


def billing_records(bills: DataFrame, topic: str = "billing-records") -> DataFrame:
    """Bills as the log records (topic, off, key, value) that the billing service publishes."""
    return keyed_log(bills.withColumn("type", F.lit(C.BILLING_EVENT_TYPE)), "node_id", RECORD_FIELDS, topic)


def bills_of_records(log: DataFrame, **split) -> DataFrame:
    """Stored billing records (off, value) in the columns of ``billing_windows``.

    A node's records are numbered in arrival order by an ordered scan that splits hot nodes. Energy and cost come
    back in whole units (1 / 3.6e8 kWh and a hundredth of a rate of that), which a stored double names exactly
    up to 2^51 units, so sums do not depend on their order. Records of another type are ignored; a missing or
    infinite amount counts as 0."""
    d = log.select("off", F.from_json("value", RECORD_JSON).alias("d")).where(F.col("d.type") == C.BILLING_EVENT_TYPE)
    r = d.select("off", *[F.col(f"d.{n}").alias(c) for n, c in RECORD_FIELDS.items() if c != "type"])
    r = ordered_scan(r, ["node_id"], "off", position="_pos", **split)

    def units(c: str, per: float) -> F.Column:
        whole = F.when(F.isnan(c) | (F.abs(c) > 1e25), None).otherwise(F.round(F.col(c) * F.lit(per)))
        return F.coalesce(whole.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))

    per = float(C.CENTI_KW_MS_PER_KWH)
    return r.select("off", "node_id", (F.col("_pos") - 1).alias("window_no"), "node_type", "district_id",
                    units("total_energy_kwh", per).alias("energy_ckwms"), "total_energy_kwh",
                    units("cost", per * 100.0).alias("cost_num"), "cost", "measurement_count", "period_start", "period_end")


def billing_history(bills: DataFrame) -> DataFrame:
    """Bills of each node numbered 1..n in arrival order.

    The k-th bill of a node closes its k-th count window, so the number is
    window_no + 1: no extra ordered pass over the bills is needed (``bills_of_records`` numbers stored ones).
    """
    return bills.withColumn("history_no", (F.col("window_no") + 1).cast("long"))


def node_billing_totals(bills: DataFrame) -> DataFrame:
    """Per node: number of bills, total energy and total cost (exact sums, decimal(38,0))."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c)
    g = bills.groupBy("node_id").agg(F.count(F.lit(1)).alias("bills"), total("energy_ckwms"), total("cost_num"))
    return g.select("node_id", "bills", "energy_ckwms", "cost_num",
                    kwh(F.col("energy_ckwms").cast("double")).alias("total_energy_kwh"),
                    (F.col("cost_num").cast("double") / F.lit(float(C.CENTI_KW_MS_PER_KWH) * 100.0) + F.lit(0.0)).alias("total_cost"))


def node_last_billing_type(bills: DataFrame) -> DataFrame:
    """Latest node type and district per node seen in the billing records."""
    g = bills.groupBy("node_id").agg(
        F.max_by(F.struct("node_type", "district_id"), "off").alias("s"))
    return g.select("node_id", F.col("s.node_type").alias("node_type"),
                    F.col("s.district_id").alias("district_id"))
