"""Charge and sliding-window queries over the measurements view."""

from __future__ import annotations

from gridflow import config as C
from gridflow.operators import charge as G
from gridflow.operators import windows as W
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.sources import views as V

STEP_MS = C.MS_PER_HOUR   # event-time step of the charge integration on the sparse driver data

BATCH = f"""
bb as (select district_id, cast(floor(t / {STEP_MS}) as bigint) as step, sum(v100) as balance_v100,
              count(*) as num_measurements, max(t) as max_t
       from measurements group by all)"""


@register("batch_balance", with_views("measurements") + "," + BATCH + """
select district_id, step, cast(balance_v100 as bigint) as balance_v100, num_measurements, max_t from bb""")
def batch_balance(spark, sf):
    return G.batch_balance(V.measurements(spark, sf), STEP_MS)


DISTRICT_CHARGE_SQL = with_views("measurements") + "," + BATCH + """,
c1 as (select *, max(max_t) over (partition by district_id order by step rows between unbounded preceding and current row) as clock
       from bb),
c2 as (select *, lag(clock) over (partition by district_id order by step) as prev_clock from c1),
c3 as (select *, case when prev_clock > 0 then cast(balance_v100 as hugeint) * (clock - prev_clock) else 0 end as x from c2),
c4 as (select *, sum(x) over (partition by district_id order by step rows between unbounded preceding and current row) as s
       from c3),
c5 as (select *, s - least(0, min(s) over (partition by district_id order by step
                                          rows between unbounded preceding and current row)) as charge from c4)
select district_id, step, balance_v100 / 100.0 as batch_balance_kw, num_measurements, clock as max_event_ms,
       cast(charge as double) / 3.6e8 as charge_kwh
from c5"""


@register("district_charge", DISTRICT_CHARGE_SQL)
def district_charge(spark, sf):
    return G.district_charge(V.measurements(spark, sf), STEP_MS)


@register("district_balance_step", with_views("ring_values") + """
select district, step, cast(sum(v100) as bigint) as balance_v100, count(*) as members from ring_values group by district, step""")
def district_balance_step(spark, sf):
    return G.district_balance_step(V.ring_values(spark, sf))


@register("step_charge", with_views("measurements") + "," + BATCH + """,
s1 as (select *, sum(balance_v100) over (partition by district_id order by step
                   rows between unbounded preceding and current row) as s from bb)
select district_id, step, cast(balance_v100 as bigint) as balance_v100,
       cast(s - least(0, min(s) over (partition by district_id order by step
                       rows between unbounded preceding and current row)) as double) / 6000.0 as charge_kwh
from s1""")
def step_charge(spark, sf):
    b = G.batch_balance(V.measurements(spark, sf), STEP_MS).select("district_id", "step", "balance_v100")
    return G.step_charge(b, key="district_id", order="step")


def _sliding_sql(window_ms: int, slide_ms: int) -> str:
    k = window_ms // slide_ms
    return with_views("measurements") + f""",
ex as (select m.*, (floor(t / {slide_ms}) - r.k) * {slide_ms} as ws
       from measurements m, range(0, {k}) r(k))
select district_id, cast(ws as bigint) as window_start_ms, cast(ws + {window_ms} as bigint) as window_end_ms,
       sum(v100) / (cast(count(v100) as double) * 100.0) as avg_balance_kw,
       sum(v100) / 100.0 as total_balance_kw, count(node_id) as num_measurements
from ex where t >= ws and t < ws + {window_ms} group by district_id, ws"""


@register("sliding_balance", _sliding_sql(120_000, 30_000))
def sliding_balance(spark, sf):
    return W.sliding_balance(V.measurements(spark, sf))


@register("sliding_balance_6h", _sliding_sql(6 * 3_600_000, 3_600_000))
def sliding_balance_6h(spark, sf):
    return W.sliding_balance(V.measurements(spark, sf), "6 hours", "1 hour")


@register("charge_update_text", DISTRICT_CHARGE_SQL.replace(
    """select district_id, step, balance_v100 / 100.0 as batch_balance_kw, num_measurements, clock as max_event_ms,
       cast(charge as double) / 3.6e8 as charge_kwh
from c5""", """select district_id, step,
       printf('district=%s batchBalance=%.2fkW numMeasurements=%d accumulatorCharge=%.4fkWh',
              district_id, balance_v100 / 100.0, num_measurements, cast(charge as double) / 3.6e8) as text
from c5"""))
def charge_update_text(spark, sf):
    return G.charge_update_text(G.district_charge(V.measurements(spark, sf), STEP_MS))
