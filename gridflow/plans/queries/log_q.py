"""Logs that are written and read back: each query lands files under the shared checkpoint folder
and runs the source or sink over them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.operators import billing as B
from gridflow.operators import parse as P
from gridflow.operators import registry as R
from gridflow.operators import reports as Rp
from gridflow.plans.named import ORACLE, register
from gridflow.plans.oracle_views import with_views
from gridflow.plans.queries.billing_q import bills_sql_prefix
from gridflow.plans.queries.registry_q import ACCOUNT_SQL, NODE_COMMANDS_SQL
from gridflow.session import checkpoint_dir
from gridflow.sources import views as V
from gridflow.sources.tables import read_table
from gridflow.streaming import continuous as Co
from gridflow.streaming import sinks as S
from gridflow.streaming import sources as Src
from gridflow.streaming import tables as Tb

BILL_COLS = ["off", "node_id", "window_no", "node_type", "district_id", "energy_ckwms", "total_energy_kwh", "cost_num", "cost",
             "measurement_count", "period_start", "period_end"]
BILL_ROWS_SQL = bills_sql_prefix() + f" select {', '.join(BILL_COLS)} from bills"
USER_FIELDS = {"type": "type", "userId": "user_id", "name": "name", "email": "email", "timestamp": "timestamp"}
USER_JSON = "type string, userId string, name string, email string, timestamp long"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/logs/{name}-{uuid.uuid4().hex[:12]}"


def _user_log(spark: SparkSession, sf: str) -> DataFrame:
    return P.keyed_log(V.user_events(spark, sf), "user_id", USER_FIELDS, "user-events")


def _user_rows(log: DataFrame) -> DataFrame:
    return log.select("off", F.from_json("value", USER_JSON).alias("d")).select(
        "off", "d.type", F.col("d.userId").alias("user_id"), "d.name", "d.email", "d.timestamp")


@register("keyed_log_sink", with_views("user_events") + """
select 'user-events' as topic, off, user_id as key,
       concat('{"type":"', type, '","userId":"', user_id, '"',
              case when name is not null then concat(',"name":"', name, '"') else '' end,
              case when email is not null then concat(',"email":"', email, '"') else '' end,
              ',"timestamp":', timestamp, '}') as value
from user_events""")
def keyed_log_sink(spark, sf):
    path, log = _folder(spark, "sink"), _user_log(spark, sf)
    for batch in (0, 1, 0):  # batch 0 is published twice, as by a retry
        S.write_keyed_log(log.where(F.col("off") % 2 == batch), path, batch)
    return Src.replay_log(spark, path)


@register("log_replay", with_views("user_events") + """
select off, type, user_id, name, email, timestamp from user_events
where off <= (select max(off) from user_events where off % 3 <> 2)""")
def log_replay(spark, sf):
    """Bounded replay: up to the ends recorded at its start, though more is published meanwhile."""
    path, log = _folder(spark, "replay"), _user_log(spark, sf)
    S.write_keyed_log(log, path, 0)
    ends = log.where(F.col("off") % 3 != 2).groupBy("topic").agg(F.max("off").alias("end"))
    S.write_keyed_log(log.withColumn("off", F.col("off") + 1_000_000_000), path, 1)
    return _user_rows(Src.replay_log(spark, path, ends))


@register("measurement_stream", with_views("measurements") + """
select off, node_id, node_type, district_id, v100, t from measurements""")
def measurement_stream(spark, sf):
    path, m = _folder(spark, "measurements"), V.measurements(spark, sf)
    rec = P.measurement_record(m).select(F.lit("measurements").alias("topic"), "off", "key", "value")
    for batch in range(3):
        S.write_keyed_log(rec.where(F.col("off") % 3 == batch), path, batch)
    s = S.stream_session(spark)
    df = Src.measurement_stream(Src.log_stream(s, path)).select("off", "node_id", "node_type", "district_id", "v100", "t")
    return S.run_to_table(s, df, "measurement_stream")


@register("concurrent_queries", with_views("measurements") + """
select 'high' as query, off, v100 from measurements where abs(v100) >= 5000
union all select 'low', off, v100 from measurements where abs(v100) < 5000""")
def concurrent_queries(spark, sf):
    """Two queries over one parsed stream, started together."""
    s = S.stream_session(spark)
    m = V.measurements_of(Src.table_stream(s, sf, "events")).select("off", "v100")
    high = F.abs("v100") >= 5000
    outs = S.concurrent_queries(s, {"high": (m.where(high), "append", None), "low": (m.where(~high), "append", None)})
    high_rows, low_rows = (S.read_output(s, outs[k], m.schema).select(F.lit(k).alias("query"), "off", "v100") for k in ("high", "low"))
    return high_rows.unionByName(low_rows)


SERIAL_SQL = with_views("serial_lines") + """
select node_id, line, row_number() over (partition by node_id order by off) as off from serial_lines"""


NO_NODE = "__HIVE_DEFAULT_PARTITION__"  # id under which lines without a node are landed


def _land_lines(lines: DataFrame, path: str, part: int = 0) -> None:
    """Console logs as a collector of many nodes lands them, a folder per part: a node's lines are in one file of
    the part, in order, each led by the node's id. The number of files follows the lines, not the nodes."""
    rows = lines.select(F.coalesce("node_id", F.lit(NO_NODE)).alias("node_id"), "off", "line")
    (rows.repartition("node_id").sortWithinPartitions("node_id", "off")
     .select(F.concat("node_id", F.lit(Src.TAB), F.coalesce("line", F.lit("")))).write.text(f"{path}/part-{part}"))


@register("serial_line_source", SERIAL_SQL)
def serial_line_source(spark, sf):
    """Console logs landed in files that many nodes share, read back in arrival order."""
    path = _folder(spark, "serial")
    _land_lines(V.serial_lines(spark, sf), path)
    return Src.serial_line_source(spark, path, shared=True)


@register("serial_line_stream", SERIAL_SQL)
def serial_line_stream(spark, sf):
    """The same logs growing by several files a node, read as a stream in several micro-batches."""
    s, path, base = S.stream_session(spark), _folder(spark, "serial-stream"), _folder(spark, "serial-run")
    lines = V.serial_lines(s, sf)
    parts, span = Tb.parts_of(lines, "off")
    for k in range(parts):
        _land_lines(lines.where(F.floor(F.col("off") * parts / span) == k), path, k)
        Co.serial_lines(Src.serial_line_stream(s, path, shared=True), base)
    return s.read.parquet(f"{base}/out").select("node_id", "line", "off")


@register("node_dimension", """
select cast(s_suppkey as integer) as pos, concat('n', s_suppkey) as node_id, concat('fd00::', s_nationkey, ':', s_suppkey) as ipv6
from supplier""")
def node_dimension(spark, sf):
    """The supplier dimension written as a device list of JSON lines and read back; its numbers are the positions."""
    path = _folder(spark, "nodes")
    n = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"]).select(
        F.col("s_suppkey").cast("int").alias("pos"), F.concat(F.lit("n"), "s_suppkey").alias("nodeId"),
        F.concat(F.lit("fd00::"), "s_nationkey", F.lit(":"), "s_suppkey").alias("ipv6"))
    n.write.json(path)
    return Src.node_list(spark, path)


@register("node_document", """
select n_regionkey as region, cast(row_number() over (partition by n_regionkey order by n_nationkey) - 1 as integer) as pos,
       concat('n', n_nationkey) as node_id, concat('fd00::', n_nationkey) as ipv6 from nation""")
def node_document(spark, sf):
    """One device list document per region (``{"nodes": [...]}``), read back with each node's place in it."""
    path = _folder(spark, "node-documents")
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    node = F.struct(F.col("n_nationkey").alias("_key"), F.concat(F.lit("n"), "n_nationkey").alias("nodeId"), F.concat(F.lit("fd00::"), "n_nationkey").alias("ipv6"))
    nodes = F.transform(F.sort_array(F.collect_list(node)), lambda x: F.struct(x["nodeId"].alias("nodeId"), x["ipv6"].alias("ipv6")))
    (n.groupBy("n_regionkey").agg(nodes.alias("nodes")).select(F.col("n_regionkey").alias("region"), F.to_json(F.struct("nodes")).alias("value"))
     .repartition("region").write.partitionBy("region").text(path))
    return Src.node_dimension(spark, path, keep=["region"]).select(F.col("region").cast(n.schema["n_regionkey"].dataType), "pos", "node_id", "ipv6")


@register("resume_point", bills_sql_prefix() + """
select off, node_id, window_no, cost_num from bills""")
def resume_point(spark, sf):
    """Billing that stops after the first part of the input and resumes on its checkpoint."""
    src, base = _folder(spark, "resume-in"), _folder(spark, "resume")
    m = V.measurements(spark, sf)
    half = m.agg(F.percentile_approx("off", 0.5)).first()[0]
    s = S.stream_session(spark)
    stream = s.readStream.schema(m.schema).option("recursiveFileLookup", "true").parquet
    for part, rows in enumerate((m.where(F.col("off") <= half), m.where(F.col("off") > half))):
        rows.write.parquet(f"{src}/part={part}")
        Co.billing(stream(src), base)
    return s.read.parquet(f"{base}/out").select("off", "node_id", "window_no", "cost_num")


@register("users_from_commands", ACCOUNT_SQL + """
, ev as (select off, user_id, event_type from checked where accepted),
last as (select user_id, arg_max(event_type, off) as event_type, arg_max(off, off) as off from ev group by user_id)
select l.user_id, c.name, c.email from last l join account_commands c on c.off = l.off and c.user_id = l.user_id
where l.event_type <> 'UserDeleted'""")
def users_from_commands(spark, sf):
    """Current users rebuilt from the events that accepted commands published and stored."""
    path = _folder(spark, "users")
    events = R.accepted_user_events(R.account_commands(V.account_commands(spark, sf)))
    S.write_keyed_log(P.keyed_log(events, "user_id", USER_FIELDS, "user-events"), path)
    return R.users_current(_user_rows(Src.replay_log(spark, path)))


NODE_FIELDS = {"type": "type", "nodeId": "node_id", "districtId": "district_id", "nodeType": "node_type", "ownerId": "owner_id",
               "capacity": "capacity", "timestamp": "timestamp"}
NODE_JSON = "type string, nodeId string, districtId string, nodeType string, ownerId string, capacity double, timestamp long"


@register("nodes_from_commands", with_views("node_commands") + ", d as (" + NODE_COMMANDS_SQL + """),
ev as (select d.off, d.event_type, c.node_id, c.district_id, c.node_type, c.user_id as owner_id, c.capacity
       from d join node_commands c on c.off = d.off where d.accepted)
select node_id, district_id, node_type, owner_id, capacity from ev
qualify row_number() over (partition by node_id order by off desc) = 1 and event_type <> 'NodeDeleted'""")
def nodes_from_commands(spark, sf):
    """Current nodes rebuilt from the events that accepted commands published and stored."""
    path, commands = _folder(spark, "nodes-log"), V.node_commands(spark, sf)
    events = R.accepted_node_events(commands, R.node_commands(V.user_events(spark, sf), commands))
    S.write_keyed_log(P.keyed_log(events, "node_id", NODE_FIELDS, "node-events"), path)
    d = Src.replay_log(spark, path).select("off", F.from_json("value", NODE_JSON).alias("d")).select(
        "off", "d.type", F.col("d.nodeId").alias("node_id"), F.col("d.districtId").alias("district_id"),
        F.col("d.nodeType").alias("node_type"), F.col("d.ownerId").alias("owner_id"), "d.capacity", "d.timestamp")
    return R.nodes_current(d)


def _stored_bills(spark, sf):
    """Bills published as full billing records, landed and read back as such."""
    path = _folder(spark, "bills")
    S.write_keyed_log(B.billing_records(B.billing_windows(V.measurements(spark, sf))), path)
    return B.bills_of_records(Src.replay_log(spark, path))


@register("bills_from_log", BILL_ROWS_SQL)
def bills_from_log(spark, sf):
    return _stored_bills(spark, sf).withColumns({c: F.col(c).cast("long") for c in ("energy_ckwms", "cost_num")}).select(*BILL_COLS)


# readings with five decimals: the events' values and a fine part from their position
_FINE = with_views("measurements") + """,
fine as (select off, node_id, node_type, t, (abs(v100) * 1000 + off % 1000) * sign(v100 + 0.5) as v from measurements),
fw as (select *, row_number() over w as pos, lag(t) over w as prev_t from fine window w as (partition by node_id order by off)),
fb as (select max(off) as off, node_id, (pos - 1) // 5 as window_no, arg_max(node_type, pos) as node_type, count(*) as n,
              cast(sum(cast(abs(v) as hugeint) * greatest(coalesce(t - prev_t, 0), 0)) as decimal(30,0)) * cast(0.001 as decimal(4,3)) as e
       from fw group by node_id, (pos - 1) // 5 having count(*) = 5)
select off, node_id, cast(window_no as bigint) as window_no, cast(e as double) as energy_ckwms, cast(e as double) / 3.6e8 as total_energy_kwh,
       cast(e * (case node_type when 'CONSUMER' then 25 when 'PRODUCER' then -10 else 0 end) as double) / 3.6e10 + 0.0 as cost from fb"""


def _fine_log(spark, sf):
    """Readings published with five decimals."""
    m = V.measurements(spark, sf)
    fine = (F.abs("v100") * 1000 + F.col("off") % 1000) * F.when(F.col("v100") < 0, -1).otherwise(1)
    rec = F.struct(F.lit(C.MEASUREMENT_EVENT_TYPE).alias("type"), F.col("node_id").alias("nodeId"), F.col("node_type").alias("nodeType"),
                   F.col("district_id").alias("districtId"), (fine / F.lit(100_000.0)).alias("value"), F.col("t").alias("timestamp"))
    return m.select(F.lit("measurements").alias("topic"), "off", F.col("district_id").alias("key"), F.to_json(rec).alias("value"))


def _fine_bills(bills):
    return bills.select("off", "node_id", "window_no", F.col("energy_ckwms").cast("double").alias("energy_ckwms"),
                        F.col("total_energy_kwh").cast("double").alias("total_energy_kwh"), F.col("cost").cast("double").alias("cost"))


@register("exact_billing", _FINE)
def exact_billing(spark, sf):
    """Bills of readings finer than hundredths, read from the log."""
    return _fine_bills(B.billing_windows(Src.measurement_stream(_fine_log(spark, sf), exact=True)))


@register("exact_billing_stream", _FINE)
def exact_billing_stream(spark, sf):
    """The same as a stream in several micro-batches."""
    s = S.stream_session(spark)
    run = lambda stream, base: Co.billing(Src.measurement_stream(stream, exact=True), base)
    base = Tb.in_parts(_fine_log(s, sf), "off", "exact_billing_stream", run)
    return _fine_bills(s.read.parquet(f"{base}/out"))


# the reports over stored records, with the SQL of the reports over readings
@register("billing_history_of_records", ORACLE["billing_history"])
def billing_history_of_records(spark, sf):
    return B.billing_history(_stored_bills(spark, sf)).select(
        "node_id", "history_no", "off", "total_energy_kwh", "cost", "measurement_count", "period_end")


@register("node_totals_of_records", ORACLE["node_billing_totals"])
def node_totals_of_records(spark, sf):
    t = B.node_billing_totals(_stored_bills(spark, sf))
    return t.withColumns({c: F.col(c).cast("long") for c in ("energy_ckwms", "cost_num")})


@register("user_panel_of_records", ORACLE["user_panel"])
def user_panel_of_records(spark, sf):
    return Rp.user_panel(R.nodes_current(V.node_events(spark, sf)), _stored_bills(spark, sf))


@register("user_total_cost_of_records", ORACLE["user_total_cost"])
def user_total_cost_of_records(spark, sf):
    return Rp.user_total_cost(R.nodes_current(V.node_events(spark, sf)), _stored_bills(spark, sf))


@register("district_summary_of_records", ORACLE["district_summary"])
def district_summary_of_records(spark, sf):
    return Rp.district_summary(R.nodes_current(V.node_events(spark, sf)), _stored_bills(spark, sf))


@register("last_billing_type_of_records", ORACLE["node_last_billing_type"])
def last_billing_type_of_records(spark, sf):
    return B.node_last_billing_type(_stored_bills(spark, sf))
