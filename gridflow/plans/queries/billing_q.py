"""Billing queries: energy integration, count windows, tariff, history, totals."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridflow.operators import billing as B
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.sources import views as V

RATE = "(case node_type when 'CONSUMER' then 25 when 'PRODUCER' then -10 else 0 end)"

# readings with arrival position, previous time and integrated energy
INTEG = """
integ as (
  select *, row_number() over w as pos, lag(t) over w as prev_t
  from measurements window w as (partition by node_id order by off)),
energy as (
  select *, greatest(coalesce(t - prev_t, 0), 0) as dt_ms,
         abs(v100) * greatest(coalesce(t - prev_t, 0), 0) as energy,
         (pos - 1) // 5 as window_no
  from integ)"""

BILLS = f"""
bills_raw as (
  select max(off) as off, node_id, window_no, arg_max(node_type, pos) as node_type,
         arg_max(district_id, pos) as district_id, cast(sum(energy) as bigint) as energy_ckwms,
         count(*) as n, arg_min(t, pos) as period_start, arg_max(t, pos) as period_end
  from energy group by node_id, window_no having count(*) = 5),
bills as (
  select off, node_id, window_no, node_type, district_id, energy_ckwms,
         energy_ckwms / 3.6e8 as total_energy_kwh,
         energy_ckwms * {RATE} as cost_num,
         energy_ckwms * {RATE} / 3.6e10 + 0.0 as cost,
         cast(n as integer) as measurement_count, period_start, period_end
  from bills_raw)"""


def bills_sql_prefix(*extra_views: str) -> str:
    return with_views("measurements", *extra_views) + "," + INTEG + "," + BILLS


def bills(spark, sf):
    return B.billing_windows(V.measurements(spark, sf))


@register("billing_windows", bills_sql_prefix() + """
select off, node_id, window_no, node_type, district_id, energy_ckwms, total_energy_kwh,
       cost_num, cost, measurement_count, period_start, period_end from bills""")
def billing_windows(spark, sf):
    return bills(spark, sf)


@register("energy_integration", with_views("measurements") + "," + INTEG + """
select off, node_id, t, pos, prev_t, dt_ms, energy from energy""")
def energy_integration(spark, sf):
    return B.energy_integration(V.measurements(spark, sf)).select(
        "off", "node_id", "t", "pos", "prev_t", "dt_ms", "energy")


@register("tariff_cost", with_views("measurements") + "," + INTEG + f"""
select off, node_id, node_type, energy, energy / 3.6e8 as energy_kwh,
       energy * {RATE} as cost_num, energy * {RATE} / 3.6e10 + 0.0 as cost
from energy""")
def tariff_cost(spark, sf):
    return B.tariff_cost(B.energy_integration(V.measurements(spark, sf)))


@register("running_window_energy", with_views("measurements") + "," + INTEG + """
select off, node_id, pos, window_no, cast((pos - 1) % 5 + 1 as integer) as k,
       cast(sum(energy) over (partition by node_id, window_no order by pos
                              rows between unbounded preceding and current row) as bigint) as window_energy,
       sum(energy) over (partition by node_id, window_no order by pos
                         rows between unbounded preceding and current row) / 3.6e8 as window_energy_kwh
from energy""")
def running_window_energy(spark, sf):
    r = B.running_window_energy(B.energy_integration(V.measurements(spark, sf)))
    return r.select("off", "node_id", "pos", "window_no", "k", "window_energy", "window_energy_kwh")


@register("billing_history", bills_sql_prefix() + """
select node_id, window_no + 1 as history_no, off, total_energy_kwh, cost, measurement_count, period_end
from bills""")
def billing_history(spark, sf):
    return B.billing_history(bills(spark, sf)).select(
        "node_id", "history_no", "off", "total_energy_kwh", "cost", "measurement_count", "period_end")


@register("node_billing_totals", bills_sql_prefix() + """
select node_id, count(*) as bills, cast(sum(energy_ckwms) as bigint) as energy_ckwms,
       cast(sum(cost_num) as bigint) as cost_num, sum(energy_ckwms) / 3.6e8 as total_energy_kwh,
       sum(cost_num) / 3.6e10 + 0.0 as total_cost
from bills group by node_id""")
def node_billing_totals(spark, sf):
    t = B.node_billing_totals(bills(spark, sf))
    return t.withColumns({c: F.col(c).cast("long") for c in ("energy_ckwms", "cost_num")})


@register("node_last_billing_type", bills_sql_prefix() + """
select node_id, arg_max(node_type, off) as node_type, arg_max(district_id, off) as district_id
from bills group by node_id""")
def node_last_billing_type(spark, sf):
    return B.node_last_billing_type(bills(spark, sf))
