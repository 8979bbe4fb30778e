"""Device-twin queries over the topic_messages / serial_lines views."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.operators import parse as P
from gridflow.operators import twin as W
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.sources import views as V

# Driver events are sparse (about one per node every few hours), so liveness
# runs with scaled durations: period 1 h, ticks every 30 min.
LIVE_PERIOD_MS = 3_600_000
LIVE_TICK_MS = 1_800_000

TP = """
tp as (select off, t, split_part(topic, '/', 2) as node_id, split_part(topic, '/', 3) as kind, payload, topic
       from topic_messages where regexp_full_match(topic, 'iot/[^/]+/(parent|msg|crash|recovered|period)'))"""

REG = """
reg_n as (select max(try_cast(split_part(topic, '/', 2) as integer)) as mx from topic_messages),
reg as (select cast(i as varchar) as node_id, case when i <= (mx + 1) // 2 then 'local' else 'remote' end as location
        from (select unnest(range(1, mx + 1)) as i, mx from reg_n))"""

LIVE = f"""
act as (select node_id, off, t, 0 as kind, t as seen, cast(null as bigint) as per from tp where kind in ('parent', 'msg')),
pc as (select node_id, off, t, 1 as kind, cast(null as bigint) as seen, cast(period_ms as bigint) as per from period_changes),
lrows as (select * from act union all select * from pc),
hz as (select max(t) as h from lrows),
ls as (select *, lead(t) over w as next_t, last_value(seen ignore nulls) over wf as last_seen,
              last_value(per ignore nulls) over wf as p
       from lrows window w as (partition by node_id order by t, kind, off),
                         wf as (partition by node_id order by t, kind, off rows between unbounded preceding and current row)),
seg as (select node_id, last_seen, coalesce(case when p <> 0 then p end, {LIVE_PERIOD_MS}) as period_ms,
               coalesce(next_t, (select h from hz) + 1) as e, cast(ceil(t / {LIVE_TICK_MS}) as bigint) * {LIVE_TICK_MS} as t0
        from ls where last_seen is not null),
seg2 as (select *, (cast(floor((last_seen + period_ms * 3) / {LIVE_TICK_MS}) as bigint) + 1) * {LIVE_TICK_MS} as tc
         from seg where t0 < e),
cand as (select node_id, t0 as tick_ms, (t0 - last_seen) > period_ms * 3 as bad, last_seen, period_ms from seg2
         union all select node_id, tc, true, last_seen, period_ms from seg2 where tc > t0 and tc < e),
fl as (select *, lag(bad) over (partition by node_id order by tick_ms) as pb from cand),
live as (select node_id, tick_ms, case when bad then 'crash' else 'recovered' end as event,
                last_seen as last_seen_ms, period_ms from fl where bad <> coalesce(pb, false))"""

SERIAL = r"""
sl as (select off, t, node_id, 0 as seq, 'parent' as kind,
              regexp_extract(line, 'PARENT_CHANGE:\s*([0-9a-fA-F:]+)', 1) as value from serial_lines
       union all
       select off, t, node_id, 1, 'msg', regexp_extract(line, 'MSG_SENT:\s*(\d+)', 1) from serial_lines),
slp as (select off, t, node_id, seq, kind, value, concat('iot/', node_id, '/', kind) as topic from sl where value <> ''),
idx as (select lower(ipv6) as addr_lc, arg_min(node_id, pos) as resolved_id from twin_nodes where ipv6 is not null group by 1),
pr as (select slp.off, slp.t, slp.node_id, slp.seq, slp.kind, slp.topic,
              case when slp.kind = 'parent' then coalesce(idx.resolved_id, slp.value) else slp.value end as payload
       from slp left join idx on slp.kind = 'parent' and lower(slp.value) = idx.addr_lc)"""

PARSE_INT = "try_cast(regexp_extract(ltrim(payload), '^([+-]?[0-9]+)', 1) as bigint)"


def _tp(spark, sf):
    return P.topic_parse(V.topic_messages(spark, sf))


def _activity(tp):
    return tp.where(F.col("kind").isin("parent", "msg")).select("node_id", "off", "t")


def _live(spark, sf):
    return W.liveness_events(_activity(_tp(spark, sf)), V.period_changes(spark, sf),
                             default_period_ms=LIVE_PERIOD_MS, tick_ms=LIVE_TICK_MS)


def _registry(spark, sf):
    n = (V.topic_messages(spark, sf)
          .agg(F.max(F.get(F.split("topic", "/"), 1).try_cast("int")).alias("n")).first()["n"])
    return W.twin_registry(spark, int(n or 0), remote=True)


def _parent_updates(tp):
    return tp.where(F.col("kind") == "parent").select("node_id", "off", F.col("payload").alias("parent"))


# ---- logs and parsing ------------------------------------------------------------

@register("parse_measurement", with_views("measurements") + """
select off, node_id, node_type, district_id, v100 / 100.0 as value, t as timestamp from measurements""")
def parse_measurement(spark, sf):
    p = P.parse_measurement(P.measurement_record(V.measurements(spark, sf)))
    return p.select("off", "node_id", "node_type", "district_id", "value", "timestamp")


@register("typed_projection", with_views("measurements") + """
select off, node_id, node_type, district_id, v100, t from measurements""")
def typed_projection(spark, sf):
    p = P.typed_projection(P.parse_measurement(P.measurement_record(V.measurements(spark, sf))))
    return p.select("off", "node_id", "node_type", "district_id", "v100", "t")


@register("topic_filter", with_views("topic_messages") + """
select off, topic, payload from topic_messages where regexp_full_match(topic, 'iot/[^/]+/parent')""")
def topic_filter(spark, sf):
    return P.topic_parse(V.topic_messages(spark, sf), ("iot/+/parent",)).select("off", "topic", "payload")


@register("topic_parse", with_views("topic_messages") + "," + TP + """
select off, node_id, kind, payload from tp""")
def topic_parse(spark, sf):
    return _tp(spark, sf).select("off", "node_id", "kind", "payload")


@register("serial_line_parse", with_views("serial_lines", "twin_nodes") + "," + SERIAL + """
select off, t, node_id, seq, kind, value, topic from slp""")
def serial_line_parse(spark, sf):
    return P.serial_line_parse(V.serial_lines(spark, sf))


@register("parent_resolve", with_views("serial_lines", "twin_nodes") + "," + SERIAL + """
select off, t, node_id, seq, kind, topic, payload from pr""")
def parent_resolve(spark, sf):
    return W.parent_resolve(P.serial_line_parse(V.serial_lines(spark, sf)), V.twin_nodes(spark))


@register("flat_field_extract", with_views("topic_messages") + "," + TP + f"""
select off, kind, case when kind = 'parent' then node_id else '' end as node_id_field,
       case when kind = 'parent' then payload else '' end as new_parent_id,
       case when kind = 'msg' then node_id else '' end as from_node_id,
       case when kind = 'msg' then coalesce(cast({PARSE_INT} as varchar), '') else '' end as seq_num
from tp where kind in ('parent', 'msg')""")
def flat_field_extract(spark, sf):
    return P.flat_field_extract(P.http_bodies(_tp(spark, sf)))


PERIOD_NORM = """
pn as (select pm.off, pm.node_id, pm.payload,
              case when a.node_id is null then 'no address' when p is null or p <= 0 then 'invalid payload'
                   else 'sent' end as status, p
       from period_messages pm left join (select node_id from twin_nodes group by node_id
                                          having arg_min(ipv6, pos) is not null and arg_min(ipv6, pos) <> '') a
         on a.node_id = pm.node_id),
pn2 as (select off, node_id, payload, case when status = 'sent' then p end as period_ms, status,
               case when status = 'sent' then concat('PERIOD:', cast(cast(floor(p / 1000.0 + 0.5) as bigint) as varchar)) end
                 as command,
               case when status = 'sent' then cast(floor(p / 1000.0 + 0.5) as bigint) = 0 end as ineffective
        from pn)"""


@register("period_normalize", with_views("period_messages", "twin_nodes") + "," + PERIOD_NORM + """
select off, node_id, payload, period_ms, status, command, ineffective from pn2""")
def period_normalize(spark, sf):
    tp = _tp(spark, sf).where(F.col("kind") == "period").select("off", "node_id", "payload")
    return P.period_normalize(tp, V.twin_nodes(spark))


@register("period_command_parse", with_views("period_messages", "twin_nodes") + "," + PERIOD_NORM + """
select off, node_id, command, i as interval_s, i is not null as applied
from (select *, case when try_cast(regexp_extract(command, '^PERIOD:([0-9]+)', 1) as bigint) > 0
                     then try_cast(regexp_extract(command, '^PERIOD:([0-9]+)', 1) as bigint) end as i from pn2)""")
def period_command_parse(spark, sf):
    tp = _tp(spark, sf).where(F.col("kind") == "period").select("off", "node_id", "payload")
    return P.period_command_parse(P.period_normalize(tp, V.twin_nodes(spark)))


@register("event_route", with_views("topic_messages") + "," + TP + """
select off, node_id, kind,
       case kind when 'parent' then 'parent-update' when 'msg' then 'app-msg' when 'crash' then 'node-crash'
                 when 'recovered' then 'node-recovered' when 'period' then 'device-period' end as endpoint,
       case kind when 'parent' then 'ParentUpdate' when 'msg' then 'AppMsg' when 'crash' then 'NodeCrash'
                 when 'recovered' then 'NodeRecovered' when 'period' then 'PeriodCommand' end as msg_type,
       case when kind = 'msg' then '1' when kind in ('parent', 'crash', 'recovered', 'period') then node_id end as target_node
from tp""")
def event_route(spark, sf):
    return P.event_route(_tp(spark, sf))


# ---- twin --------------------------------------------------------------------------

@register("liveness_events", with_views("topic_messages", "period_changes") + "," + TP + "," + LIVE + """
select node_id, tick_ms, event, last_seen_ms, period_ms from live""")
def liveness_events(spark, sf):
    return _live(spark, sf)


@register("event_fan_out", with_views("topic_messages", "period_changes") + "," + TP + "," + LIVE + """
select 'crash' as source, node_id, tick_ms as t, 0 as seq, 'http' as channel, 'node-crash' as target,
       concat('{"nodeId":"', node_id, '"}') as payload from live where event = 'crash'
union all
select 'crash', node_id, tick_ms, 1, 'mqtt', concat('iot/', node_id, '/restart'), 'restart' from live where event = 'crash'
union all
select 'period_change', node_id, t, 0, 'http', 'set-period',
       concat('{"nodeId":"', node_id, '","periodMs":', period_ms, '}') from period_changes
union all
select 'period_change', node_id, t, 1, 'mqtt', concat('iot/', node_id, '/period'), cast(period_ms as varchar)
from period_changes""")
def event_fan_out(spark, sf):
    crashes = _live(spark, sf).where(F.col("event") == "crash")
    return P.event_fan_out(crashes, V.period_changes(spark, sf))


@register("last_seen", with_views("topic_messages") + "," + TP + """
select node_id, min(t) as first_seen_ms, max(t) as last_seen_ms, count(*) as messages
from tp where kind in ('parent', 'msg') group by node_id""")
def last_seen(spark, sf):
    return W.last_seen(_activity(_tp(spark, sf)))


@register("app_messages", with_views("topic_messages") + "," + TP + f"""
select off, '1' as target_node, node_id as from_node_id, {PARSE_INT} as seq_num from tp where kind = 'msg'""")
def app_messages(spark, sf):
    return W.app_messages(_tp(spark, sf))


@register("twin_status", with_views("topic_messages") + "," + REG + """
select node_id, location from reg""")
def twin_status(spark, sf):
    return W.twin_status(_registry(spark, sf))


@register("twin_dispatch", with_views("topic_messages", "period_changes") + "," + TP + "," + REG + """,
ev as (select off, node_id, 'parent-update' as endpoint from tp where kind = 'parent'
       union all select off, node_id, 'set-period' from period_changes)
select ev.off, ev.node_id, ev.endpoint, case when reg.node_id is not null then 200 else 404 end as status
from ev left join reg on reg.node_id = ev.node_id""")
def twin_dispatch(spark, sf):
    tp = _tp(spark, sf)
    ev = (tp.where(F.col("kind") == "parent").select("off", "node_id", F.lit("parent-update").alias("endpoint"))
            .unionByName(V.period_changes(spark, sf).select("off", "node_id", F.lit("set-period").alias("endpoint"))))
    return W.twin_dispatch(ev, _registry(spark, sf))


@register("parent_history", with_views("topic_messages") + "," + TP + """,
pu as (select node_id, off, payload as parent from tp where kind = 'parent'),
allp as (select distinct node_id, cast(-1 as bigint) as off, case when node_id = '1' then 'root' else '1' end as parent
         from pu union all select * from pu)
select node_id, off, parent, hist_1, hist_2, hist_3 from (
  select *, lag(parent, 1) over w as hist_1, lag(parent, 2) over w as hist_2, lag(parent, 3) over w as hist_3
  from allp window w as (partition by node_id order by off)) where off >= 0""")
def parent_history(spark, sf):
    return W.parent_history(_parent_updates(_tp(spark, sf)))


@register("parent_changes", with_views("serial_lines", "twin_nodes") + "," + SERIAL + """
select node_id, off, parent from (
  select node_id, off, payload as parent, lag(payload) over (partition by node_id order by off) as prev
  from pr where kind = 'parent' and payload is not null) where prev is distinct from parent""")
def parent_changes(spark, sf):
    pr = W.parent_resolve(P.serial_line_parse(V.serial_lines(spark, sf)), V.twin_nodes(spark))
    obs = pr.where(F.col("kind") == "parent").select("node_id", "off", F.col("payload").alias("parent"))
    return W.parent_changes(obs)


@register("twin_state", with_views("topic_messages", "period_changes") + "," + TP + "," + REG + "," + LIVE + f""",
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
       par.hist_1, par.hist_2, par.hist_3, coalesce(per.period_ms, {C.DEFAULT_PERIOD_MS}) as period_ms,
       coalesce(cr.crashed, false) as crashed
from reg left join par on par.node_id = reg.node_id left join per on per.node_id = reg.node_id
left join cr on cr.node_id = reg.node_id""")
def twin_state(spark, sf):
    tp = _tp(spark, sf)
    reg = _registry(spark, sf)
    return W.twin_state(reg, _parent_updates(tp), V.period_changes(spark, sf), activity=_activity(tp),
                        liveness_period_ms=LIVE_PERIOD_MS, tick_ms=LIVE_TICK_MS)
