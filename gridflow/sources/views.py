"""Input shapes derived from the driver tables.

Each function returns the DataFrame an operator expects (see the schema table in
FIXTURES.md). They read only the columns they need, so the parquet scan's
ReadSchema stays narrow. ``off`` is the arrival position (the table's event id);
``t`` is event time in epoch milliseconds; power is ``v100`` (centi-kW, BIGINT).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflow.functions.expr import epoch_ms, period_ms_of_payload, topic_level
from gridflow.sources.tables import read_table

_EV = ["event_id", "ts", "user_id", "event_type", "value"]


def _events(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    return read_table(spark, sf_dir, "events", cols or _EV)


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings: off, node_id, district_id, node_type, v100, t."""
    return measurements_of(_events(spark, sf_dir, ["event_id", "ts", "user_id", "value"]))


def measurements_of(e: DataFrame) -> DataFrame:
    """The readings view over any events DataFrame (batch or streaming)."""
    u3 = F.col("user_id") % 3
    sign = (F.when(u3 == 0, F.lit(1)).when(u3 == 1, F.lit(-1))
             .otherwise(F.when(F.col("event_id") % 2 == 0, F.lit(1)).otherwise(F.lit(-1))))
    return e.select(
        F.col("event_id").alias("off"),
        F.concat(F.lit("n"), F.col("user_id")).alias("node_id"),
        F.concat(F.lit("d"), F.col("user_id") % 8).alias("district_id"),
        F.when(u3 == 0, "PRODUCER").when(u3 == 1, "CONSUMER").otherwise("ACCUMULATOR").alias("node_type"),
        (F.round(F.col("value") * 100).cast("long") * sign).alias("v100"),
        epoch_ms(F.col("ts")).alias("t"),
    )


def account_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account commands (one per event): off, user_id, op, name, email, t."""
    return account_commands_of(_events(spark, sf_dir))


def account_commands_of(e: DataFrame) -> DataFrame:
    return e.select(
        F.col("event_id").alias("off"),
        F.concat(F.lit("u"), F.col("user_id")).alias("user_id"),
        _case(F.col("event_type"), {"signup": "register", "purchase": "update", "error": "delete"},
              "other").alias("op"),
        F.concat(F.lit("name"), F.col("event_id")).alias("name"),
        F.concat(F.lit("u"), F.col("user_id"), F.lit("@"), F.col("event_id") % 97).alias("email"),
        epoch_ms(F.col("ts")).alias("t"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user-events log: account commands with the op mapped to the event type."""
    return user_events_of(_events(spark, sf_dir))


def user_events_of(e: DataFrame) -> DataFrame:
    a = account_commands_of(e)
    return a.select(
        "off",
        _case(F.col("op"), {"register": "UserRegistered", "update": "UserUpdated",
                            "delete": "UserDeleted"}, "UserOther").alias("type"),
        "user_id", "name", "email", F.col("t").alias("timestamp"),
    )


def node_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node commands (one per event, every third by another user than the node's): off, node_id, user_id, op, district_id, node_type, capacity, t."""
    return node_commands_of(_events(spark, sf_dir))


def node_commands_of(e: DataFrame) -> DataFrame:
    ek7 = F.col("event_id") % 7
    return e.select(
        F.col("event_id").alias("off"),
        F.concat(F.lit("n"), F.col("user_id")).alias("node_id"),
        F.concat(F.lit("u"), F.col("user_id") + F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)).alias("user_id"),
        _case(F.col("event_type"), {"signup": "create", "click": "create", "purchase": "update",
                                    "error": "delete"}, "report").alias("op"),
        F.concat(F.lit("d"), F.col("event_id") % 5).alias("district_id"),
        F.when(ek7 == 0, "BAD").when(ek7 == 1, "PRODUCER").when(ek7 == 2, "CONSUMER")
         .otherwise("ACCUMULATOR").alias("node_type"),
        F.col("value").alias("capacity"),
        epoch_ms(F.col("ts")).alias("t"),
    )


def node_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node-events log: node commands with the op mapped to the event type.

    Deletes carry no district / type, as a tombstone does.
    """
    c = node_commands(spark, sf_dir)
    typ = _case(F.col("op"), {"create": "NodeCreated", "update": "NodeUpdated",
                              "delete": "NodeDeleted"}, "NodeReported")
    is_del = F.col("op") == "delete"
    return c.select(
        "off", typ.alias("type"), "node_id",
        F.when(~is_del, F.col("district_id")).alias("district_id"),
        F.when(~is_del, F.col("node_type")).alias("node_type"),
        F.col("user_id").alias("owner_id"),
        F.when(~is_del, F.col("capacity")).otherwise(F.lit(0.0)).alias("capacity"),
        F.col("t").alias("timestamp"),
    )


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device topic messages: off, t, topic, payload."""
    return topic_messages_of(_events(spark, sf_dir))


def topic_messages_of(e: DataFrame) -> DataFrame:
    """The topic-messages view over any events DataFrame (batch or streaming)."""
    kind = _case(F.col("event_type"), {"signup": "parent", "purchase": "msg", "view": "msg",
                                       "click": "period"}, "status")
    ek5 = F.col("event_id") % 5
    period_payload = (F.when(ek5 == 0, "8000").when(ek5 == 1, '{"periodMs":5000}')
                       .when(ek5 == 2, "abc").when(ek5 == 3, "0").otherwise("499"))
    payload = (F.when(F.col("event_type") == "signup", (F.col("user_id") * 7 % 150).cast("string"))
                .when(F.col("event_type") == "click", period_payload)
                .otherwise(F.col("event_id").cast("string")))
    return e.select(
        F.col("event_id").alias("off"), epoch_ms(F.col("ts")).alias("t"),
        F.concat(F.lit("iot/"), F.col("user_id"), F.lit("/"), kind).alias("topic"),
        payload.alias("payload"),
    )


def serial_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serial console lines of the devices: off, t, node_id, line."""
    e = _events(spark, sf_dir)
    et = F.col("event_type")
    line = (F.when(et == "signup", F.concat(F.lit("[INFO: App] PARENT_CHANGE: FD00::20"), F.col("user_id") % 6))
             .when(et == "purchase", F.concat(F.lit("[INFO: App] MSG_SENT:"), F.col("event_id")))
             .when(et == "view", F.concat(F.lit("PARENT_CHANGE:fd00::20"), F.col("user_id") % 6,
                                          F.lit(" MSG_SENT: "), F.col("event_id")))
             .otherwise(F.lit("Not reachable yet")))
    return e.select(
        F.col("event_id").alias("off"), epoch_ms(F.col("ts")).alias("t"),
        F.col("user_id").cast("string").alias("node_id"), line.alias("line"),
    )


def twin_nodes(spark: SparkSession) -> DataFrame:
    """Device address list (pos, node_id, ipv6): five devices, ::205 stays unresolved."""
    return spark.range(5).select(
        F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("node_id"),
        F.concat(F.lit("fd00::20"), F.col("id")).alias("ipv6"))


def ring_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated ring members: district = customer, rank = order key, a step per quarter of the keys."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return o.select(
        F.col("o_custkey").alias("district"), (F.col("o_orderkey") % 4).cast("int").alias("step"),
        F.col("o_orderkey").alias("rank"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("v100"),
    )


def period_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period-change actions (off, t, node_id, period_ms): the period messages whose
    payload is a finite whole number of ms > 0."""
    return period_changes_of(topic_messages(spark, sf_dir))


def period_changes_of(m: DataFrame) -> DataFrame:
    """Period changes from any topic-messages DataFrame (batch or streaming)."""
    p = period_ms_of_payload(F.col("payload"))
    # the parsed period is evaluated once inside the array; filtering it there keeps
    # Catalyst from copying the parse into every predicate
    ok = F.filter(F.array(p), lambda x: (x > 0) & (x == F.floor(x)) & (x <= F.lit(2147483647.0)))
    return (m.where(topic_level(F.col("topic"), 2) == "period")
             .select("off", "t", topic_level(F.col("topic"), 1).alias("node_id"), F.explode(ok).alias("p"))
             .select("off", "t", "node_id", F.col("p").cast("int").alias("period_ms")))
