"""Streaming forms run end to end over the driver tables.

Each query lands the events table in parts, in order of arrival, and runs the continuous operator over each
part on one checkpoint, as a service that is stopped and resumed; it returns what the operator emitted or
holds as a batch DataFrame. The number of parts follows the table (``tables.in_parts``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridflow.operators import parse as P
from gridflow.operators import windows as Wn
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.plans.queries.billing_q import bills_sql_prefix
from gridflow.plans.queries.charge_q import DISTRICT_CHARGE_SQL, STEP_MS, _sliding_sql
from gridflow.plans.queries.registry_q import NODE_COMMANDS_SQL
from gridflow import config as C
from gridflow.plans.queries.twin_q import LIVE, LIVE_PERIOD_MS, LIVE_TICK_MS, REG, TP, _registry
from gridflow.sources import views as V
from gridflow.streaming import continuous as Co
from gridflow.streaming import sinks as S
from gridflow.streaming import stateful as St
from gridflow.streaming import steps
from gridflow.streaming import tables as Tb

BILL_COLS = ["off", "node_id", "window_no", "node_type", "district_id", "energy_ckwms", "total_energy_kwh",
             "cost_num", "cost", "measurement_count", "period_start", "period_end"]
BILLS_SQL = bills_sql_prefix() + f"""
select {', '.join(BILL_COLS)} from bills"""


def _events(spark, sf):
    return V._events(spark, sf)


def _emitted(spark, base, schema):
    return S.read_output(spark, f"{base}/out", schema).drop("batch_id")


def _bills_schema(spark):
    return spark.createDataFrame([], "off long, node_id string, window_no long, node_type string, district_id string, energy_ckwms long, "
                                 "total_energy_kwh double, cost_num long, cost double, measurement_count int, period_start long, period_end long").schema


@register("billing_stream", BILLS_SQL)
def billing_stream(spark, sf):
    s = S.stream_session(spark)
    base = Tb.in_parts(V.measurements(s, sf), "off", "billing_stream", Co.billing)
    return _emitted(s, base, _bills_schema(s)).select(*BILL_COLS)


class _Fault(Exception):
    pass


@register("billing_after_fault", BILLS_SQL)
def billing_after_fault(spark, sf):
    """Billing whose second micro-batch fails behind its writes and before its commit, and is run again on
    the same checkpoint: each bill comes once."""
    s, failed = S.stream_session(spark), []

    def after(batch: int) -> None:
        if batch == 1 and not failed:
            failed.append(batch)
            raise _Fault("lost between the writes and the commit")

    def run(stream, base):
        try:
            Co.billing(stream, base, after=after)
        except Exception:  # noqa: BLE001  (the engine wraps the step's exception)
            if failed != [1]:
                raise
            failed.append("resumed")
            Co.billing(stream, base, after=after)

    base = Tb.in_parts(V.measurements(s, sf), "off", "billing_after_fault", run)
    if failed != [1, "resumed"]:
        raise RuntimeError("the fault did not happen")
    return _emitted(s, base, _bills_schema(s)).select(*BILL_COLS)


SLIDE_MS, WINDOW_MS, DELAY_MS = 30_000, 120_000, 30_000


@register("sliding_balance_stream", _sliding_sql(WINDOW_MS, SLIDE_MS))
def sliding_balance_stream(spark, sf):
    """The watermarked aggregate in update mode; its updates' last row per window."""
    s = S.stream_session(spark)

    def run(stream, base):
        df = Wn.sliding_balance(stream, watermark="30 seconds")
        S.finish(S.update_sink(df, "", f"{base}/out", f"{base}/checkpoint"))

    m = V.measurements(s, sf)
    base = Tb.in_parts(m, "off", "sliding_balance_stream", run)
    rows = S.read_output(s, f"{base}/out", Wn.sliding_balance(m).schema)
    return S.latest_of(rows, ["district_id", "window_start_ms"])


@register("update_sink", _sliding_sql(WINDOW_MS, SLIDE_MS))
def update_sink(spark, sf):
    """Windows upserted batch by batch into a keyed table that is compacted on the way."""
    s = S.stream_session(spark)
    run = lambda stream, base: Co.sliding(stream, base, WINDOW_MS, SLIDE_MS, DELAY_MS, compact_every=2)
    base = Tb.in_parts(V.measurements(s, sf), "off", "update_sink", run)
    return Co.window_rows(Co.window_table(s, base, compact_every=2).current(), WINDOW_MS)


# Every seventh reading arrives late, behind as many rows as a fifth of the table.
LATE_EVERY = 7
ARRIVED = with_views("measurements") + f""",
arr as (select *, off + case when off % {LATE_EVERY} = 0 then (select max(off) // 5 from measurements) else 0 end as arrival from measurements),
sp as (select max(arrival) + 1 as span, max(arrival) as last from arr),
pt as (select arr.*, arrival * {Tb.PARTS_SQL} // span as part from arr, sp),
wm as (select part, max(max(t)) over (order by part rows between unbounded preceding and 1 preceding) - {DELAY_MS} as wm from pt group by part),
marked as (select pt.*, coalesce((t // {SLIDE_MS}) * {SLIDE_MS} + {WINDOW_MS} <= wm.wm, false) as late from pt join wm on wm.part = pt.part)"""


def _late_run(spark, sf, name):
    s = S.stream_session(spark)
    m = V.measurements(s, sf)
    behind = (m.agg(F.max("off")).first()[0] or 0) // 5
    arrival = F.col("off") + F.when(F.col("off") % LATE_EVERY == 0, behind).otherwise(0)
    run = lambda stream, base: Co.sliding(stream, base, WINDOW_MS, SLIDE_MS, DELAY_MS)
    return s, m, Tb.in_parts(m.withColumn("arrival", arrival), "arrival", name, run)


@register("late_readings", ARRIVED + """
select off, node_id, district_id, v100, t, cast(part as bigint) as batch from marked where late""")
def late_readings(spark, sf):
    """The readings that came behind the watermark, each with its micro-batch: the side output."""
    s, m, base = _late_run(spark, sf, "late_readings")
    return S.read_output(s, f"{base}/late", m.schema).select(
        "off", "node_id", "district_id", "v100", "t", F.col("batch_id").cast("long").alias("batch"))


@register("on_time_balance", ARRIVED + f""",
ex as (select m.*, (floor(t / {SLIDE_MS}) - r.k) * {SLIDE_MS} as ws from marked m, range(0, {WINDOW_MS // SLIDE_MS}) r(k) where not late)
select district_id, cast(ws as bigint) as window_start_ms, cast(ws + {WINDOW_MS} as bigint) as window_end_ms,
       sum(v100) / (cast(count(v100) as double) * 100.0) as avg_balance_kw, sum(v100) / 100.0 as total_balance_kw,
       count(node_id) as num_measurements
from ex where t >= ws and t < ws + {WINDOW_MS} group by district_id, ws""")
def on_time_balance(spark, sf):
    """Sliding balances over out-of-order micro-batches, without the late readings."""
    s, _, base = _late_run(spark, sf, "on_time_balance")
    return Co.window_rows(Co.window_table(s, base).current(), WINDOW_MS)


@register("charge_stream", with_views("measurements") + f""",
sp as (select max(off) + 1 as span, max(off) as last from measurements),
b as (select district_id, off * {Tb.PARTS_SQL} // span as k, sum(v100) as bal, count(*) as n, max(t) as mx from measurements, sp group by all),
c as (select *, max(mx) over (partition by district_id order by k) as clock from b),
d as (select *, lag(clock) over (partition by district_id order by k) as prev from c),
x as (select *, case when prev > 0 then cast(bal as hugeint) * (clock - prev) else 0 end as x from d),
s as (select *, sum(x) over (partition by district_id order by k) as s from x),
f as (select *, s - least(0, min(s) over (partition by district_id order by k)) as charge from s)
select district_id, bal / 100.0 as batch_balance_kw, n as num_measurements, clock as max_event_ms,
       cast(charge as double) / 3.6e8 as charge_kwh
from f qualify row_number() over (partition by district_id order by k desc) = 1""")
def charge_stream(spark, sf):
    s = S.stream_session(spark)
    base = Tb.in_parts(V.measurements(s, sf), "off", "charge_stream", Co.charge)
    return steps.charge_rows(Co.charge_table(s, base).current())


def _live_stream(events):
    msgs = V.topic_messages_of(events)
    tp = P.topic_parse(msgs)
    act = tp.where(F.col("kind").isin("parent", "msg")).select("node_id", "off", "t")
    return St.liveness_stream(act, V.period_changes_of(msgs), watermark="0 seconds",
                              default_period_ms=LIVE_PERIOD_MS, tick_ms=LIVE_TICK_MS)


def _live_run(stream, base):
    S.finish(S.update_sink(_live_stream(stream), "", f"{base}/out", f"{base}/checkpoint", output_mode="append"))


def _stateful_session(spark):
    # without the count of its rows, which is a metric only, the store looks no key up before it writes it
    return S.stream_session(spark, spark__sql__streaming__stateStore__providerClass=St.ROCKSDB_PROVIDER,
                            spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows="false")


@register("liveness_stream", with_views("topic_messages", "period_changes") + "," + TP + "," + LIVE + """
select node_id, tick_ms, event, last_seen_ms, period_ms from live""")
def liveness_stream(spark, sf):
    s = _stateful_session(spark)
    return _emitted(s, Tb.in_parts(_events(s, sf), "event_id", "liveness_stream", _live_run), St.LIVE_OUT)


@register("twin_state_stream", with_views("topic_messages", "period_changes") + "," + TP + "," + REG + "," + LIVE + f""",
pu as (select node_id, off, payload as parent from tp where kind = 'parent' and node_id in (select node_id from reg)),
allp as (select distinct node_id, cast(-1 as bigint) as off, case when node_id = '1' then 'root' else '1' end as parent
         from pu union all select * from pu),
rk as (select *, row_number() over (partition by node_id order by off desc) as r from allp),
par as (select node_id, max(case when r = 1 then parent end) as parent, max(case when r = 2 then parent end) as hist_1,
               max(case when r = 3 then parent end) as hist_2, max(case when r = 4 then parent end) as hist_3
        from rk where r <= 4 group by node_id),
per as (select node_id, arg_max(period_ms, off) as period_ms from period_changes
        where node_id in (select node_id from reg) group by node_id),
cr as (select node_id, arg_max(event = 'crash', tick_ms) as crashed from live
       where node_id in (select node_id from reg) group by node_id)
select reg.node_id, coalesce(par.parent, case when reg.node_id = '1' then 'root' else '1' end) as parent,
       par.hist_1, par.hist_2, par.hist_3, cast(coalesce(per.period_ms, {C.DEFAULT_PERIOD_MS}) as bigint) as period_ms,
       coalesce(cr.crashed, false) as crashed
from reg left join par on par.node_id = reg.node_id left join per on per.node_id = reg.node_id
left join cr on cr.node_id = reg.node_id
where par.node_id is not null or per.node_id is not null or cr.node_id is not null""")
def twin_state_stream(spark, sf):
    """Two services: the liveness check publishes crash / recovered events; the twins fold them with parent
    updates and period changes."""
    s = _stateful_session(spark)
    registry = _registry(s, sf)

    def run(stream, base):
        _live_run(stream, base)
        msgs = V.topic_messages_of(stream)
        tp = P.topic_parse(msgs)
        parents = tp.where(F.col("kind") == "parent").select(
            "node_id", F.lit("parent").alias("kind"), F.col("off").alias("ord"), F.col("payload").alias("value"))
        periods = V.period_changes_of(msgs).select(
            "node_id", F.lit("period").alias("kind"), F.col("off").alias("ord"), F.col("period_ms").cast("string").alias("value"))
        live = s.readStream.schema(St.LIVE_OUT).parquet(f"{base}/out").select(
            "node_id", F.col("event").alias("kind"), F.col("tick_ms").alias("ord"), F.lit(None).cast("string").alias("value"))
        Co.twins(parents.unionByName(periods).unionByName(live), registry, f"{base}/twin")

    base = Tb.in_parts(_events(s, sf), "event_id", "twin_state_stream", run)
    return Co.twin_table(s, f"{base}/twin").current()


@register("district_charge_stream", DISTRICT_CHARGE_SQL)
def district_charge_stream(spark, sf):
    """The event-time charge; a closing row behind the input lets the last steps out."""
    s = _stateful_session(spark)
    m = V.measurements(s, sf)

    def run(stream, base):
        S.finish(S.update_sink(St.district_charge_stream(stream, step_ms=STEP_MS), "", f"{base}/out", f"{base}/checkpoint", output_mode="append"))

    return _emitted(s, Tb.in_parts(m, "off", "district_charge_stream", run, end=St.closing(m, STEP_MS)), St.STEP_CHARGE_OUT)


@register("node_commands_stream", NODE_COMMANDS_SQL)
def node_commands_stream(spark, sf):
    s = S.stream_session(spark)
    run = lambda stream, base: Co.node_commands(stream, V.user_events_of, V.node_commands_of, base)
    base = Tb.in_parts(_events(s, sf), "event_id", "node_commands_stream", run)
    schema = s.createDataFrame([], "off long, node_id string, user_id string, op string, accepted boolean, reason string, event_type string").schema
    return _emitted(s, base, schema)
