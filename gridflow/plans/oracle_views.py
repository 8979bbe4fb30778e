"""The input views of ``gridflow.sources.views`` written as DuckDB SQL.

Used by the DuckDB oracle queries (``gridflow.plans.catalog``) over the same
driver tables. Times: ``epoch_us(ts)//1000`` floors like Spark's ``unix_millis``.
"""

MS = "(epoch_us(ts) // 1000)"

VIEWS = {
    "measurements": f"""
select event_id as off, concat('n', user_id) as node_id, concat('d', user_id % 8) as district_id,
       case user_id % 3 when 0 then 'PRODUCER' when 1 then 'CONSUMER' else 'ACCUMULATOR' end as node_type,
       cast(round(value * 100) as bigint) * (case user_id % 3 when 0 then 1 when 1 then -1
            else case when event_id % 2 = 0 then 1 else -1 end end) as v100,
       {MS} as t
from events""",
    "account_commands": f"""
select event_id as off, concat('u', user_id) as user_id,
       case event_type when 'signup' then 'register' when 'purchase' then 'update'
                       when 'error' then 'delete' else 'other' end as op,
       concat('name', event_id) as name, concat('u', user_id, '@', event_id % 97) as email, {MS} as t
from events""",
    "user_events": """
select off, case op when 'register' then 'UserRegistered' when 'update' then 'UserUpdated'
                    when 'delete' then 'UserDeleted' else 'UserOther' end as type,
       user_id, name, email, t as timestamp
from account_commands""",
    "node_commands": f"""
select event_id as off, concat('n', user_id) as node_id,
       concat('u', user_id + case when event_id % 3 = 0 then 1 else 0 end) as user_id,
       case event_type when 'signup' then 'create' when 'click' then 'create' when 'purchase' then 'update'
                       when 'error' then 'delete' else 'report' end as op,
       concat('d', event_id % 5) as district_id,
       case event_id % 7 when 0 then 'BAD' when 1 then 'PRODUCER' when 2 then 'CONSUMER' else 'ACCUMULATOR' end as node_type,
       value as capacity, {MS} as t
from events""",
    "node_events": """
select off, case op when 'create' then 'NodeCreated' when 'update' then 'NodeUpdated'
                    when 'delete' then 'NodeDeleted' else 'NodeReported' end as type,
       node_id, case when op <> 'delete' then district_id end as district_id,
       case when op <> 'delete' then node_type end as node_type, user_id as owner_id,
       case when op <> 'delete' then capacity else 0.0 end as capacity, t as timestamp
from node_commands""",
    "topic_messages": f"""
select event_id as off, {MS} as t,
       concat('iot/', user_id, '/', case event_type when 'signup' then 'parent' when 'purchase' then 'msg'
              when 'view' then 'msg' when 'click' then 'period' else 'status' end) as topic,
       case event_type when 'signup' then cast(user_id * 7 % 150 as varchar)
            when 'click' then case event_id % 5 when 0 then '8000' when 1 then '{{"periodMs":5000}}'
                                                when 2 then 'abc' when 3 then '0' else '499' end
            else cast(event_id as varchar) end as payload
from events""",
    "serial_lines": f"""
select event_id as off, {MS} as t, cast(user_id as varchar) as node_id,
       case event_type when 'signup' then concat('[INFO: App] PARENT_CHANGE: FD00::20', user_id % 6)
            when 'purchase' then concat('[INFO: App] MSG_SENT:', event_id)
            when 'view' then concat('PARENT_CHANGE:fd00::20', user_id % 6, ' MSG_SENT: ', event_id)
            else 'Not reachable yet' end as line
from events""",
    "twin_nodes": """
select cast(k as integer) as pos, cast(k as varchar) as node_id, concat('fd00::20', k) as ipv6
from range(5) r(k)""",
    "ring_values": """
select o_custkey as district, cast(o_orderkey % 4 as integer) as step, o_orderkey as rank, cast(round(o_totalprice * 100) as bigint) as v100
from orders""",
    # period payload -> ms: plain decimal number (empty text is 0), else the periodMs field
    "period_messages": r"""
select off, t, split_part(topic, '/', 2) as node_id, payload,
       coalesce(case when trim(payload) = '' then 0.0
                     when regexp_full_match(trim(payload), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                     then try_cast(trim(payload) as double) end,
                case when trim((case when json_valid(payload) then json_extract_string(payload, '$.periodMs') end)) = '' then 0.0
                     when regexp_full_match(trim((case when json_valid(payload) then json_extract_string(payload, '$.periodMs') end)),
                                            '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                     then try_cast(trim((case when json_valid(payload) then json_extract_string(payload, '$.periodMs') end)) as double) end) as p
from topic_messages where split_part(topic, '/', 3) = 'period'""",
    "period_changes": """
select off, t, node_id, cast(p as integer) as period_ms
from period_messages where p > 0 and p = floor(p) and p <= 2147483647""",
}

# dependency order for the WITH clause
ORDER = ["measurements", "account_commands", "user_events", "node_commands", "node_events",
         "topic_messages", "serial_lines", "twin_nodes", "ring_values", "period_messages",
         "period_changes"]

_DEPS = {
    "user_events": ["account_commands"],
    "node_events": ["node_commands"],
    "period_messages": ["topic_messages"],
    "period_changes": ["period_messages"],
}


def with_views(*names: str) -> str:
    """A WITH prefix defining the named views (and what they depend on)."""
    need: set[str] = set()

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        need.add(n)

    for n in names:
        add(n)
    parts = [f"{n} as ({VIEWS[n]})" for n in ORDER if n in need]
    return "with " + ",\n".join(parts)
