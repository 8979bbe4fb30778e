"""Read-side reports over current nodes and billing records.

Reports use the node's *current* owner and district (not the ones stamped on
the bills), and only bills of nodes that exist now.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.functions.expr import kwh
from gridflow.operators.billing import billing_history, node_billing_totals

PANEL_PARTS = 8   # into which the history of a node is dealt
_COST_DIV = float(C.CENTI_KW_MS_PER_KWH) * 100.0


def _cost(num_col: str) -> F.Column:
    return F.col(num_col) / F.lit(_COST_DIV) + F.lit(0.0)


def user_panel(nodes: DataFrame, bills: DataFrame) -> DataFrame:
    """Every owner's nodes, each with its numbered billing history (left outer:
    a node without bills appears once with null bill columns).

    Bills are the large side and may have a hot node, so its history is dealt out over ``PANEL_PARTS`` parts by
    number, and each node stands once in every part. A node's bills are numbered from 1 without a gap: it
    has none exactly if the part of number 1 has none, so only there a node without a match is kept."""
    h = billing_history(bills).select(F.col("node_id").alias("_bill_of"), "history_no", "total_energy_kwh", "cost", "measurement_count",
                                      "period_end", F.pmod(F.col("history_no"), F.lit(PANEL_PARTS)).cast("int").alias("_of_part"))
    n = nodes.where(F.col("owner_id").isNotNull()).select(
        "owner_id", "node_id", "node_type", "district_id", F.explode(F.sequence(F.lit(0), F.lit(PANEL_PARTS - 1))).alias("_part"))
    j = n.join(h, (F.col("node_id") == F.col("_bill_of")) & (F.col("_part") == F.col("_of_part")), "left")
    return j.where(F.col("_bill_of").isNotNull() | (F.col("_part") == 1 % PANEL_PARTS)).drop("_bill_of", "_part", "_of_part")


def user_total_cost(nodes: DataFrame, bills: DataFrame) -> DataFrame:
    """Per owner and node, and per owner overall: bills, energy and cost.

    Bills are first reduced to one row per node, so the rollup runs over
    (owner, node) rows only; ``node_id`` is null on the owner total rows.
    """
    t = node_billing_totals(bills).select("node_id", "bills", "energy_ckwms", "cost_num")
    j = (nodes.where(F.col("owner_id").isNotNull()).select("owner_id", "node_id")
              .join(t, "node_id", "left"))
    r = (j.rollup("owner_id", "node_id")
          .agg(F.coalesce(F.sum("bills"), F.lit(0)).alias("bills"),
               F.coalesce(F.sum(F.col("energy_ckwms").cast("decimal(38,0)")), F.lit(0)).alias("e"),
               F.coalesce(F.sum(F.col("cost_num").cast("decimal(38,0)")), F.lit(0)).alias("c"),
               F.grouping_id().alias("g"))
          .where(F.col("g") < 3))
    return r.select("owner_id", "node_id",
                    F.when(F.col("g") == 0, F.lit("node")).otherwise(F.lit("user")).alias("level"),
                    F.col("bills").cast("long").alias("bills"),
                    kwh(F.col("e").cast("double")).alias("energy_kwh"),
                    (F.col("c").cast("double") / F.lit(_COST_DIV) + F.lit(0.0)).alias("cost"))


def district_summary(nodes: DataFrame, bills: DataFrame) -> DataFrame:
    """Per district: current node count (nodes without bills included), total
    energy and cost of their bills (0.0 when none), districts in order.

    Bills are pre-aggregated per node before the join, so the node count is not
    inflated by the number of bills.
    """
    t = node_billing_totals(bills).select("node_id", "energy_ckwms", "cost_num")
    j = nodes.select("node_id", "district_id").join(t, "node_id", "left")
    g = j.groupBy("district_id").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum(F.col("energy_ckwms").cast("decimal(38,0)")), F.lit(0)).alias("e"),
        F.coalesce(F.sum(F.col("cost_num").cast("decimal(38,0)")), F.lit(0)).alias("c"))
    return (g.select("district_id", "nodes",
                     kwh(F.col("e").cast("double")).alias("energy_kwh"),
                     (F.col("c").cast("double") / F.lit(_COST_DIV) + F.lit(0.0)).alias("cost"))
             .orderBy("district_id"))


def state_counts(users: DataFrame, nodes: DataFrame, bills: DataFrame) -> DataFrame:
    """Entities recovered by replay: users, nodes, billing records."""
    def c(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("entity"), "n")
    return c(users, "users").unionByName(c(nodes, "nodes")).unionByName(c(bills, "billing_records"))
