"""Parsing, projection and routing of raw messages (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridflow import config as C
from gridflow.plans.joins import checked_broadcast
from gridflow.functions.expr import (js_parse_int, json_field_text, period_command_seconds,
                                     period_ms_of_payload, period_seconds, topic_level, topic_matches)

# the JSON record a reading is published as (field names fixed by the log format)
MEASUREMENT_JSON_SCHEMA = T.StructType([
    T.StructField("nodeId", T.StringType()), T.StructField("nodeType", T.StringType()),
    T.StructField("districtId", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

SUBSCRIPTIONS = ("iot/+/parent", "iot/+/msg", "iot/+/crash", "iot/+/recovered", "iot/+/period")


def measurement_record(readings: DataFrame) -> DataFrame:
    """Readings as published log records: key = district, value = JSON."""
    rec = F.struct(F.lit(C.MEASUREMENT_EVENT_TYPE).alias("type"), F.col("node_id").alias("nodeId"),
                   F.col("node_type").alias("nodeType"), F.col("district_id").alias("districtId"),
                   (F.col("v100") / F.lit(100.0)).alias("value"), F.col("t").alias("timestamp"))
    return readings.select("off", F.col("district_id").alias("key"), F.to_json(rec).alias("value"))


def parse_measurement(records: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON (string or bytes) -> typed columns + event time. Malformed rows give
    nulls; rows missing district, value or timestamp go to ``parse_rejects``."""
    data = F.from_json(F.col(value_col).cast("string"), MEASUREMENT_JSON_SCHEMA)
    return records.select("off", data.alias("d")).select(
        "off", F.col("d.nodeId").alias("node_id"), F.col("d.nodeType").alias("node_type"),
        F.col("d.districtId").alias("district_id"), F.col("d.value").alias("value"),
        F.col("d.timestamp").alias("timestamp"),
        F.timestamp_millis(F.when(_in_range(F.col("d.timestamp")), F.col("d.timestamp"))).alias("event_time"))


MAX_PERIOD_MS = 1.0e18
# readings within these bounds have exact integer hundredths and a valid timestamp
MAX_ABS_VALUE = 9.0e13
MAX_ABS_TIMESTAMP = 9_000_000_000_000_000


def _in_range(timestamp: Column) -> Column:
    return timestamp.between(-MAX_ABS_TIMESTAMP, MAX_ABS_TIMESTAMP)


def _well_formed() -> Column:
    """District, a finite value and a timestamp, both in range (a comparison with NaN is false here)."""
    value = F.col("value")
    return F.coalesce(F.col("district_id").isNotNull() & ~F.isnan(value) & (F.abs(value) <= MAX_ABS_VALUE)
                      & _in_range(F.col("timestamp")), F.lit(False))


# power in hundredths with six decimals of its own: values keep eight decimals
EXACT = "decimal(22,6)"


def typed_projection(parsed: DataFrame, exact: bool = False) -> DataFrame:
    """Keep the five typed fields (plus off and v100, the value in hundredths), dropping malformed
    rows: no district, no finite value within MAX_ABS_VALUE, no timestamp in range.

    ``v100`` is a whole number, or with ``exact`` a decimal that keeps eight decimals of the value; all
    operators take either and compute without rounding."""
    # a filter does not keep the cast from running on other rows, so the cast itself must not fail
    return parsed.where(_well_formed()).select(
        "off", "node_id", "node_type", "district_id", "value", "timestamp",
        ((F.col("value").try_cast("decimal(24,8)") * 100).try_cast(EXACT) if exact else F.round(F.col("value") * 100).try_cast("long")).alias("v100"),
        F.col("timestamp").alias("t"))


def parse_rejects(parsed: DataFrame) -> DataFrame:
    """The rows that ``typed_projection`` drops."""
    return parsed.where(~_well_formed())


def keyed_log(df: DataFrame, key_col: str, fields: dict[str, str], topic: str) -> DataFrame:
    """Rows as keyed log records (topic, off, key, value JSON). ``fields`` maps
    JSON name -> column; null fields are omitted, as the writer does."""
    rec = F.struct(*[F.col(c).alias(n) for n, c in fields.items()])
    return df.select(F.lit(topic).alias("topic"), "off", F.col(key_col).alias("key"),
                     F.to_json(rec).alias("value"))


def topic_parse(messages: DataFrame, subscriptions=SUBSCRIPTIONS) -> DataFrame:
    """Keep messages matching any subscription; node id = 2nd level, kind = 3rd."""
    return (messages.where(topic_matches(F.col("topic"), *subscriptions))
                    .withColumn("node_id", topic_level(F.col("topic"), 1))
                    .withColumn("kind", topic_level(F.col("topic"), 2)))


def serial_line_parse(lines: DataFrame) -> DataFrame:
    """Device console lines -> messages. A parent change and/or a sent-message
    sequence number is extracted; other lines are dropped; a line with both
    yields two messages, parent first (seq 0, 1)."""
    parent = F.regexp_extract("line", C.PARENT_LINE_PATTERN, 1)
    msg = F.regexp_extract("line", C.MSG_LINE_PATTERN, 1)
    cands = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("parent").alias("kind"), parent.alias("value")),
        F.struct(F.lit(1).alias("seq"), F.lit("msg").alias("kind"), msg.alias("value")))
    e = lines.select("off", "t", "node_id", F.explode(F.filter(cands, lambda s: s["value"] != "")).alias("m"))
    return e.select("off", "t", "node_id", F.col("m.seq").alias("seq"), F.col("m.kind").alias("kind"),
                    F.col("m.value").alias("value"),
                    F.concat(F.lit("iot/"), F.col("node_id"), F.lit("/"), F.col("m.kind")).alias("topic"))


def http_bodies(parsed_messages: DataFrame) -> DataFrame:
    """The JSON bodies the coordination flow sends for parent and app messages."""
    parent_body = F.to_json(F.struct(F.col("node_id").alias("nodeId"), F.col("payload").alias("newParentId")))
    msg_body = F.to_json(F.struct(F.col("node_id").alias("fromNodeId"),
                                  js_parse_int(F.col("payload")).alias("seqNum")))
    return (parsed_messages.where(F.col("kind").isin("parent", "msg"))
                           .withColumn("body", F.when(F.col("kind") == "parent", parent_body).otherwise(msg_body)))


def flat_field_extract(bodies: DataFrame) -> DataFrame:
    """Read flat JSON fields as text ('' when missing)."""
    return bodies.select("off", "kind",
                         json_field_text(F.col("body"), "nodeId").alias("node_id_field"),
                         json_field_text(F.col("body"), "newParentId").alias("new_parent_id"),
                         json_field_text(F.col("body"), "fromNodeId").alias("from_node_id"),
                         json_field_text(F.col("body"), "seqNum").alias("seq_num"))


def period_normalize(period_messages: DataFrame, addresses: DataFrame) -> DataFrame:
    """Period messages -> device commands 'PERIOD:<s>'.

    A node without an address is rejected first; then the payload (a number or
    {"periodMs": n}) must be finite, > 0 and below MAX_PERIOD_MS (its seconds are sent as plain digits). Periods under 500 ms round to
    PERIOD:0, which devices ignore (``ineffective``).
    """
    # the first entry per node id decides; an entry without an address (null or empty) rejects
    first = addresses.groupBy("node_id").agg(F.min_by("ipv6", "pos").alias("_ip"))
    addr = first.where(F.col("_ip").isNotNull() & (F.col("_ip") != "")).select(
        "node_id", F.lit(True).alias("_has_addr"))
    j = period_messages.join(checked_broadcast(addr), "node_id", "left")
    j = j.withColumn("_p", period_ms_of_payload(F.col("payload")))
    p = F.col("_p")
    j = j.withColumn("status", F.when(F.col("_has_addr").isNull(), F.lit("no address"))
                                .when(p.isNull() | (p <= 0) | (p >= MAX_PERIOD_MS), F.lit("invalid payload"))
                                .otherwise(F.lit("sent")))
    sent = F.col("status") == "sent"
    sec = period_seconds(p)
    return j.select("off", "node_id", "payload", F.when(sent, p).alias("period_ms"), "status",
                    F.when(sent, F.concat(F.lit(C.PERIOD_COMMAND_PREFIX), sec.cast("string"))).alias("command"),
                    F.when(sent, sec == 0).alias("ineffective"))


def period_command_parse(commands: DataFrame) -> DataFrame:
    """Device side: leading digits after 'PERIOD:' (> 0) become the interval in seconds."""
    s = period_command_seconds(F.col("command"))
    return commands.select("off", "node_id", "command", s.alias("interval_s"), s.isNotNull().alias("applied"))


def event_route(parsed_messages: DataFrame) -> DataFrame:
    """Handler and target per message kind; app messages always go to the root node."""
    k = F.col("kind")
    endpoint = (F.when(k == "parent", "parent-update").when(k == "msg", "app-msg")
                 .when(k == "crash", "node-crash").when(k == "recovered", "node-recovered")
                 .when(k == "period", "device-period"))
    msg_type = (F.when(k == "parent", "ParentUpdate").when(k == "msg", "AppMsg")
                 .when(k == "crash", "NodeCrash").when(k == "recovered", "NodeRecovered")
                 .when(k == "period", "PeriodCommand"))
    target = F.when(k == "msg", F.lit(C.ROOT_NODE_ID)).when(endpoint.isNotNull(), F.col("node_id"))
    return parsed_messages.select("off", "node_id", "kind", endpoint.alias("endpoint"),
                                  msg_type.alias("msg_type"), target.alias("target_node"))


def event_fan_out(crashes: DataFrame, period_changes: DataFrame) -> DataFrame:
    """One input, several outputs: a crash updates the twin and publishes a
    restart command; a period change updates the twin and is published to the
    device topic."""
    c = crashes.select("node_id", F.col("tick_ms").alias("t"), F.explode(F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("http").alias("channel"), F.lit("node-crash").alias("target"),
                 F.to_json(F.struct(F.col("node_id").alias("nodeId"))).alias("payload")),
        F.struct(F.lit(1).alias("seq"), F.lit("mqtt").alias("channel"),
                 F.concat(F.lit("iot/"), F.col("node_id"), F.lit("/restart")).alias("target"),
                 F.lit("restart").alias("payload")))).alias("o"))
    p = period_changes.select("node_id", "t", F.explode(F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("http").alias("channel"), F.lit("set-period").alias("target"),
                 F.to_json(F.struct(F.col("node_id").alias("nodeId"),
                                    F.col("period_ms").alias("periodMs"))).alias("payload")),
        F.struct(F.lit(1).alias("seq"), F.lit("mqtt").alias("channel"),
                 F.concat(F.lit("iot/"), F.col("node_id"), F.lit("/period")).alias("target"),
                 F.col("period_ms").cast("string").alias("payload")))).alias("o"))
    cols = ["node_id", "t", F.col("o.seq").alias("seq"), F.col("o.channel").alias("channel"),
            F.col("o.target").alias("target"), F.col("o.payload").alias("payload")]
    return (c.select(F.lit("crash").alias("source"), *cols)
             .unionByName(p.select(F.lit("period_change").alias("source"), *cols)))
