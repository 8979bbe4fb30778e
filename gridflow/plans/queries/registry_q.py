"""Registry queries: current state, command validation, as-of lookups, reports."""

from __future__ import annotations

from gridflow.operators import registry as R
from gridflow.operators import reports as P
from gridflow.plans.named import register
from gridflow.plans.oracle_views import with_views
from gridflow.plans.queries.billing_q import bills, bills_sql_prefix
from gridflow.sources import views as V

PANEL_USER = "u3"

USERS_CUR = """
users_cur as (
  select user_id, name, email from user_events
  where type in ('UserRegistered', 'UserUpdated', 'UserDeleted')
  qualify row_number() over (partition by user_id order by off desc) = 1 and type <> 'UserDeleted')"""

NODES_CUR = """
nodes_cur as (
  select node_id, district_id, node_type, owner_id, capacity from node_events
  where type in ('NodeCreated', 'NodeUpdated', 'NodeDeleted')
  qualify row_number() over (partition by node_id order by off desc) = 1 and type <> 'NodeDeleted')"""

USER_VALID = """
uv_u as (select user_id, off * 2 as ord,
                case when type in ('UserRegistered', 'UserUpdated') then true
                     when type = 'UserDeleted' then false end as st, cast(null as bigint) as cid
         from user_events),
uv_c as (select user_id, off * 2 + 1 as ord, cast(null as boolean) as st, off as cid from node_commands),
uv_s as (select cid, last_value(st ignore nulls) over (partition by user_id order by ord
                     rows between unbounded preceding and current row) as v
         from (select * from uv_u union all select * from uv_c)),
cmds as (select nc.off, nc.node_id, nc.user_id, nc.op, nc.node_type, coalesce(uv_s.v, false) as user_valid
         from node_commands nc join uv_s on uv_s.cid = nc.off)"""

ENRICH = """
en_r as (select node_id, off * 2 as ord,
                case when type in ('NodeCreated', 'NodeUpdated') then 1 when type = 'NodeDeleted' then 0 end as present,
                district_id, node_type, cast(null as bigint) as moff from node_events),
en_m as (select node_id, off * 2 + 1 as ord, cast(null as integer) as present, cast(null as varchar) as district_id,
                cast(null as varchar) as node_type, off as moff from measurements),
en_s as (select node_id, moff, last_value(case when present is not null then ord end ignore nulls)
                over (partition by node_id order by ord rows between unbounded preceding and current row) as reg_ord
         from (select * from en_r union all select * from en_m)),
en as (select m.off, m.node_id, m.v100, m.t, r.present, r.district_id, r.node_type
       from en_s join measurements m on m.off = en_s.moff
       left join en_r r on r.node_id = en_s.node_id and r.ord = en_s.reg_ord)"""


@register("users_current", with_views("user_events") + "," + USERS_CUR + """
select user_id, name, email from users_cur""")
def users_current(spark, sf):
    return R.users_current(V.user_events(spark, sf))


@register("list_users", with_views("user_events") + "," + USERS_CUR + """
select user_id, name, email from users_cur""")
def list_users(spark, sf):
    return R.users_current(V.user_events(spark, sf))


@register("nodes_current", with_views("node_events") + "," + NODES_CUR + """
select node_id, district_id, node_type, owner_id, capacity from nodes_cur""")
def nodes_current(spark, sf):
    return R.nodes_current(V.node_events(spark, sf))


@register("list_nodes", with_views("node_events") + "," + NODES_CUR + """
select node_id, district_id, node_type, owner_id, capacity from nodes_cur""")
def list_nodes(spark, sf):
    return R.nodes_current(V.node_events(spark, sf))


@register("valid_users", with_views("user_events") + "," + USERS_CUR + """
select user_id from users_cur""")
def valid_users(spark, sf):
    return R.valid_users(V.user_events(spark, sf))


@register("nodes_of_owner", with_views("node_events") + "," + NODES_CUR + f"""
select node_id, district_id, node_type, owner_id, capacity from nodes_cur where owner_id = '{PANEL_USER}'""")
def nodes_of_owner(spark, sf):
    return R.nodes_of_owner(R.nodes_current(V.node_events(spark, sf)), PANEL_USER)


@register("node_type_check", with_views("node_commands") + """
select off, node_id, node_type, coalesce(node_type in ('PRODUCER', 'CONSUMER', 'ACCUMULATOR'), false) as valid_type
from node_commands""")
def node_type_check(spark, sf):
    return R.node_type_check(V.node_commands(spark, sf))


ACCOUNT_SQL = with_views("account_commands") + """,
ac as (select *, coalesce(last_value(case op when 'register' then true when 'delete' then false end ignore nulls)
                 over (partition by user_id order by off rows between unbounded preceding and 1 preceding), false) as ex
       from account_commands),
checked as (select off, user_id, op,
       case when op = 'register' then not ex when op in ('update', 'delete') then ex else false end as accepted,
       case when op not in ('register', 'update', 'delete') then 'unknown command'
            when op = 'register' and ex then 'user already exists'
            when op in ('update', 'delete') and not ex then 'user does not exist' end as reason,
       case when op = 'register' and not ex then 'UserRegistered'
            when op = 'update' and ex then 'UserUpdated'
            when op = 'delete' and ex then 'UserDeleted' end as event_type, name, email, t
from ac)"""


@register("account_commands", ACCOUNT_SQL + """
select * from checked""")
def account_commands(spark, sf):
    return R.account_commands(V.account_commands(spark, sf))


@register("user_valid_asof", with_views("user_events", "node_commands") + "," + USER_VALID + """
select off, node_id, user_id, op, user_valid from cmds""")
def user_valid_asof(spark, sf):
    c = V.node_commands(spark, sf).select("off", "node_id", "user_id", "op")
    return R.user_valid_asof(V.user_events(spark, sf), c)


_REASON = """case when c.op not in ('create', 'update', 'delete') then 'unknown command'
     when not c.user_valid then 'user not registered'
     when c.op = 'create' and f.ex then 'node already exists'
     when c.op = 'create' and not c.vt then 'invalid node type'
     when c.op in ('update', 'delete') and not f.ex then 'node does not exist'
     when c.op in ('update', 'delete') and f.owner <> c.user_id then 'not the owner' end"""

NODE_COMMANDS_SQL = (with_views("user_events", "node_commands").replace("with ", "with recursive ", 1)
                     + "," + USER_VALID + f""",
c as (select *, row_number() over (partition by node_id order by off) as rn,
             coalesce(node_type in ('PRODUCER', 'CONSUMER', 'ACCUMULATOR'), false) as vt from cmds),
f as (
  select node_id, cast(0 as bigint) as rn, false as ex, cast(null as varchar) as owner,
         cast(null as bigint) as off, cast(null as varchar) as user_id, cast(null as varchar) as op,
         cast(null as varchar) as reason
  from (select distinct node_id from c)
  union all
  select c.node_id, c.rn,
         case when ({_REASON}) is null and c.op = 'create' then true
              when ({_REASON}) is null and c.op = 'delete' then false else f.ex end,
         case when ({_REASON}) is null and c.op = 'create' then c.user_id
              when ({_REASON}) is null and c.op = 'delete' then null else f.owner end,
         c.off, c.user_id, c.op, {_REASON}
  from f join c on c.node_id = f.node_id and c.rn = f.rn + 1)
select off, node_id, user_id, op, reason is null as accepted, reason,
       case when reason is null then case op when 'create' then 'NodeCreated' when 'update' then 'NodeUpdated'
                                            else 'NodeDeleted' end end as event_type
from f where rn > 0""")


@register("node_commands", NODE_COMMANDS_SQL)
def node_commands(spark, sf):
    return R.node_commands(V.user_events(spark, sf), V.node_commands(spark, sf))


@register("measurement_enrich", with_views("measurements", "node_events") + "," + ENRICH + """
select off, node_id, v100, t, district_id, node_type from en where present = 1""")
def measurement_enrich(spark, sf):
    return R.measurement_enrich(V.node_events(spark, sf), V.measurements(spark, sf)).select(
        "off", "node_id", "v100", "t", "district_id", "node_type")


@register("measurement_reject", with_views("measurements", "node_events") + "," + ENRICH + """
select off, node_id, v100, t, case when present is null then 'unknown node' else 'deleted node' end as reason
from en where coalesce(present, 0) = 0""")
def measurement_reject(spark, sf):
    return R.measurement_reject(V.node_events(spark, sf), V.measurements(spark, sf)).select(
        "off", "node_id", "v100", "t", "reason")


# ---- reports ---------------------------------------------------------------

@register("user_panel", bills_sql_prefix("node_events") + "," + NODES_CUR + """
select n.owner_id, n.node_id, n.node_type, n.district_id, b.window_no + 1 as history_no,
       b.total_energy_kwh, b.cost, b.measurement_count, b.period_end
from nodes_cur n left join bills b on b.node_id = n.node_id where n.owner_id is not null""")
def user_panel(spark, sf):
    return P.user_panel(R.nodes_current(V.node_events(spark, sf)), bills(spark, sf))


@register("user_total_cost", bills_sql_prefix("node_events") + "," + NODES_CUR + """,
nt as (select node_id, count(*) as bills, sum(energy_ckwms) as e, sum(cost_num) as c from bills group by node_id),
j as (select n.owner_id, n.node_id, nt.bills, nt.e, nt.c from nodes_cur n left join nt on nt.node_id = n.node_id
      where n.owner_id is not null)
select owner_id, node_id, 'node' as level, cast(coalesce(bills, 0) as bigint) as bills,
       cast(coalesce(e, 0) as double) / 3.6e8 as energy_kwh, cast(coalesce(c, 0) as double) / 3.6e10 + 0.0 as cost
from j
union all
select owner_id, null as node_id, 'user' as level, cast(coalesce(sum(bills), 0) as bigint),
       cast(coalesce(sum(e), 0) as double) / 3.6e8, cast(coalesce(sum(c), 0) as double) / 3.6e10 + 0.0
from j group by owner_id""")
def user_total_cost(spark, sf):
    return P.user_total_cost(R.nodes_current(V.node_events(spark, sf)), bills(spark, sf))


DISTRICT_SUMMARY_SQL = bills_sql_prefix("node_events") + "," + NODES_CUR + """,
nt as (select node_id, sum(energy_ckwms) as e, sum(cost_num) as c from bills group by node_id)
select n.district_id, count(*) as nodes, cast(coalesce(sum(nt.e), 0) as double) / 3.6e8 as energy_kwh,
       cast(coalesce(sum(nt.c), 0) as double) / 3.6e10 + 0.0 as cost
from nodes_cur n left join nt on nt.node_id = n.node_id group by n.district_id order by n.district_id"""


@register("district_summary", DISTRICT_SUMMARY_SQL)
def district_summary(spark, sf):
    return P.district_summary(R.nodes_current(V.node_events(spark, sf)), bills(spark, sf))


@register("summary_order", DISTRICT_SUMMARY_SQL)
def summary_order(spark, sf):
    return P.district_summary(R.nodes_current(V.node_events(spark, sf)), bills(spark, sf))


@register("state_counts", bills_sql_prefix("user_events", "node_events") + "," + USERS_CUR + "," + NODES_CUR + """
select 'users' as entity, count(*) as n from users_cur
union all select 'nodes', count(*) from nodes_cur
union all select 'billing_records', count(*) from bills""")
def state_counts(spark, sf):
    return P.state_counts(R.users_current(V.user_events(spark, sf)),
                          R.nodes_current(V.node_events(spark, sf)), bills(spark, sf))
