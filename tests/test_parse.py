"""Table-driven parsing cases (message formats, payload normalisation, routing)."""
import pytest
from pyspark.sql import functions as F

from gridflow.functions.expr import js_parse_int, period_ms_of_payload, topic_matches
from gridflow.operators import parse as P
from gridflow.operators import twin as W

ADDR = [(0, "1", "fd00::201:1:1:1"), (1, "2", "fd00::202:2:2:2"), (2, "9", "FD00::201:1:1:1")]


@pytest.mark.parametrize("payload,ms,status,command,ineffective", [
    ("8000", 8000.0, "sent", "PERIOD:8", False),
    ('{"periodMs":5000}', 5000.0, "sent", "PERIOD:5", False),
    ('{"periodMs":"6000"}', 6000.0, "sent", "PERIOD:6", False),
    ("499", 499.0, "sent", "PERIOD:0", True),           # rounds to 0: the device ignores it
    ("500", 500.0, "sent", "PERIOD:1", False),          # halves round up
    ("1e3", 1000.0, "sent", "PERIOD:1", False),
    (" 2500 ", 2500.0, "sent", "PERIOD:3", False),
    ("0", None, "invalid payload", None, None),
    ("", None, "invalid payload", None, None),          # empty text is 0
    ("-5", None, "invalid payload", None, None),
    ("Infinity", None, "invalid payload", None, None),
    ("abc", None, "invalid payload", None, None),
    ('{"other":1}', None, "invalid payload", None, None),
])
def test_period_normalize(spark, payload, ms, status, command, ineffective):
    msgs = spark.createDataFrame([(1, "1", payload)], "off long, node_id string, payload string")
    addrs = spark.createDataFrame(ADDR, "pos int, node_id string, ipv6 string")
    r = P.period_normalize(msgs, addrs).collect()[0]
    assert (r["period_ms"], r["status"], r["command"], r["ineffective"]) == (ms, status, command, ineffective)


def test_period_needs_an_address_first(spark):
    msgs = spark.createDataFrame([(1, "7", "junk"), (2, "8", "8000"), (3, "9", "8000")],
                                 "off long, node_id string, payload string")
    addrs = spark.createDataFrame(ADDR + [(5, "8", ""), (6, "9", None), (7, "9", "fd00::209")],
                                  "pos int, node_id string, ipv6 string")
    got = {r["off"]: r["status"] for r in P.period_normalize(msgs, addrs).collect()}
    # node 9's first entry (pos 2) has an address; node 8's only entry is empty
    assert got == {1: "no address", 2: "no address", 3: "sent"}


@pytest.mark.parametrize("cmd,secs", [("PERIOD:8", 8), ("PERIOD:0", None), ("PERIOD:12abc", 12),
                                      ("PERIOD:", None), ("period:5", None), (None, None)])
def test_period_command_parse(spark, cmd, secs):
    df = spark.createDataFrame([(1, "1", cmd)], "off long, node_id string, command string")
    r = P.period_command_parse(df).collect()[0]
    assert r["interval_s"] == secs and r["applied"] == (secs is not None)


def test_serial_line_parse_and_resolve(spark):
    lines = spark.createDataFrame([
        (1, 0, "3", "[INFO: App] PARENT_CHANGE: FD00::201:1:1:1"),      # upper case resolves
        (2, 0, "3", "PARENT_CHANGE:fd00::205 MSG_SENT: 42"),             # both: parent first; unresolved raw
        (3, 0, "4", "Not reachable yet"),                                # dropped
        (4, 0, "4", "MSG_SENT:"),                                        # no digits: dropped
        (5, 0, "4", "PARENT_CHANGE: zz")],                               # no address chars: dropped
        "off long, t long, node_id string, line string")
    parsed = P.serial_line_parse(lines)
    addrs = spark.createDataFrame(ADDR, "pos int, node_id string, ipv6 string")
    got = sorted((r["off"], r["seq"], r["topic"], r["payload"]) for r in W.parent_resolve(parsed, addrs).collect())
    assert got == [(1, 0, "iot/3/parent", "1"),        # first match in file order wins over "9"
                   (2, 0, "iot/3/parent", "fd00::205"),
                   (2, 1, "iot/3/msg", "42")]


def test_topic_subscriptions(spark):
    df = spark.createDataFrame([("iot/5/parent",), ("iot/5/x/parent",), ("iot//parent",), ("iot/7/crash",),
                                ("other/5/parent",)], "topic string")
    got = [r["topic"] for r in df.where(topic_matches(F.col("topic"), "iot/+/parent", "iot/+/crash")).collect()]
    assert sorted(got) == ["iot/5/parent", "iot/7/crash"]
    parsed = P.topic_parse(df.withColumn("off", F.lit(1)).withColumn("payload", F.lit("p")))
    assert {(r["node_id"], r["kind"]) for r in parsed.collect()} == {("5", "parent"), ("7", "crash")}


@pytest.mark.parametrize("text,val", [("42", 42), ("  7x", 7), ("-3", -3), ("+5", 5), ("x1", None), ("", None)])
def test_parse_int(spark, text, val):
    assert spark.range(1).select(js_parse_int(F.lit(text)).alias("v")).first()["v"] == val


def test_flat_fields_and_routes(spark):
    msgs = spark.createDataFrame([(1, "4", "parent", "2"), (2, "5", "msg", "17"), (3, "6", "crash", ""),
                                  (4, "6", "period", "8000"), (5, "6", "status", "x")],
                                 "off long, node_id string, kind string, payload string")
    f = {r["off"]: r for r in P.flat_field_extract(P.http_bodies(msgs)).collect()}
    assert (f[1]["node_id_field"], f[1]["new_parent_id"], f[1]["from_node_id"]) == ("4", "2", "")
    assert (f[2]["from_node_id"], f[2]["seq_num"], f[2]["node_id_field"]) == ("5", "17", "")
    routes = {r["off"]: (r["endpoint"], r["target_node"]) for r in P.event_route(msgs).collect()}
    assert routes == {1: ("parent-update", "4"), 2: ("app-msg", "1"), 3: ("node-crash", "6"),
                      4: ("device-period", "6"), 5: (None, None)}


def test_malformed_measurements_are_rejected(spark):
    recs = spark.createDataFrame([(1, '{"nodeId":"n","districtId":"d","value":1.5,"timestamp":5}'),
                                  (2, "junk"), (3, None), (4, '{"nodeId":"n","districtId":"d","value":"x","timestamp":5}'),
                                  (5, '{"nodeId":"n","value":2.0,"timestamp":6}')], "off long, value string")
    parsed = P.parse_measurement(recs)
    ok = [r["off"] for r in P.typed_projection(parsed).collect()]
    bad = sorted(r["off"] for r in P.parse_rejects(parsed).collect())
    assert ok == [1] and bad == [2, 3, 4, 5]


def test_period_payload_expression(spark):
    df = spark.createDataFrame([("1e400",), ("NaN",), ("12",)], "p string")
    got = [r["v"] for r in df.select(period_ms_of_payload(F.col("p")).alias("v")).collect()]
    assert got == [None, None, 12.0]


def test_bad_readings_are_rejected_and_never_fail(spark):
    from gridflow.operators import parse as P
    body = '{"nodeId":"n","nodeType":"PRODUCER","districtId":"d","value":%s,"timestamp":%s}'
    cases = [("1.5", "1000"), ("NaN", "1000"), ('"Infinity"', "1000"), ("1e300", "1000"), ("-1e300", "1000"), ("2", "9223372036854775807"),
             ("0.5", "-5"), ("null", "1000"), ("2", "null")]
    rec = spark.createDataFrame([(i, body % c) for i, c in enumerate(cases)], "off long, value string")
    parsed = P.parse_measurement(rec)
    kept = {r.off: r.v100 for r in P.typed_projection(parsed).collect()}
    assert kept == {0: 150, 6: 50}
    assert {r.off for r in P.parse_rejects(parsed).collect()} == set(range(9)) - set(kept)


def test_period_white_space_and_range(spark):
    from gridflow.operators import parse as P
    msgs = spark.createDataFrame([(0, "n", "\t8000\n"), (1, "n", "1e30"), (2, "n", " 500﻿"), (3, "n", "\t")],
                                 "off long, node_id string, payload string")
    addr = spark.createDataFrame([(0, "n", "fd00::1")], "pos int, node_id string, ipv6 string")
    got = {r.off: (r.status, r.command) for r in P.period_normalize(msgs, addr).collect()}
    assert got == {0: ("sent", "PERIOD:8"), 1: ("invalid payload", None), 2: ("sent", "PERIOD:1"), 3: ("invalid payload", None)}


def test_exact_readings_keep_their_decimals(spark):
    from decimal import Decimal
    from gridflow.operators import billing as B, charge as G, windows as W
    from gridflow.streaming import stateful as St, steps
    values = [0.004, 12.34567, -0.00000001, 89999999999999.0, 1e3, 5.0, 0.1, 0.2, 0.3, 7.25]
    rows = [(i, '{"nodeId":"n","nodeType":"CONSUMER","districtId":"d","value":%r,"timestamp":%d}' % (v, 1_000_000 + 7_000 * i)) for i, v in enumerate(values)]
    r = P.typed_projection(P.parse_measurement(spark.createDataFrame(rows, "off long, value string")), exact=True)
    want = [Decimal(repr(v)) * 100 for v in values]
    assert [x.v100 for x in r.orderBy("off").collect()] == want
    bills = B.billing_windows(r).orderBy("off").collect()
    energy = [sum(abs(v) * (7_000 if i else 0) for i, v in list(enumerate(want))[a:a + 5]) for a in (0, 5)]
    assert [b.energy_ckwms for b in bills] == energy
    # the micro-batch step carries the open window's energy exactly
    first, state = steps.billing_step(r.where("off < 7"), spark.createDataFrame([], steps.BILL_STATE))
    second, _ = steps.billing_step(r.where("off >= 7"), state)
    assert [b.energy_ckwms for b in first.unionByName(second).orderBy("off").collect()] == energy
    small = r.where("off in (0, 1, 2, 4)")
    charge = G.district_charge(small, 7_000).orderBy("step").collect()
    assert charge[1].charge_kwh == float(Decimal("1234.567") * 7_000) / 3.6e8
    assert charge[2].batch_balance_kw == -1e-8
    total = W.sliding_balance(small, "1 hour", "1 hour").first().total_balance_kw
    assert total == float(Decimal("101234.966999")) / 100.0
    assert St._millionths(Decimal("0.400001")) == 400001 and St._millionths(7) == 7_000_000 and St._number(1_500_000) == 1.5
