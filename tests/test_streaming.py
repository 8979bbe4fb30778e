"""Streaming = batch: the same rows as ordered files, one file per trigger; the
last emission per key (or all appended rows) must equal the batch operator.
Includes a restart from the checkpoint and a late file."""
import glob
import json
import os
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import rows_of, sort_rows
from test_folds import READ_COLS, fold_bills, random_readings
from gridflow.operators import billing as B
from gridflow.operators import twin as W
from gridflow.operators import windows as Wn
from gridflow.session import checkpoint_dir
from gridflow.streaming import continuous as Co
from gridflow.streaming import sinks as S
from gridflow.streaming import sources as Src
from gridflow.streaming import stateful as St
from gridflow.streaming import steps
from gridflow.streaming import tables as Tb

SCHEMA = pa.schema([("off", pa.int64()), ("node_id", pa.string()), ("node_type", pa.string()),
                    ("district_id", pa.string()), ("v100", pa.int64()), ("t", pa.int64())])


@pytest.fixture(autouse=True)
def state_store(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", St.ROCKSDB_PROVIDER)


def land(folder, i, rows, schema=SCHEMA):
    os.makedirs(folder, exist_ok=True)
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    pq.write_table(pa.table(cols, schema=schema), os.path.join(folder, f"part-{i:04d}.parquet"))
    time.sleep(0.05)  # the file source orders files by modification time


def scratch(spark, name):
    return checkpoint_dir(spark, f"tests/{name}-{uuid.uuid4().hex[:8]}")


def stream_of(spark, folder, schema=READ_COLS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df, base, mode="append"):
    q = S.update_sink(df, None, os.path.join(base, "out"), os.path.join(base, "ck"), output_mode=mode)
    q.awaitTermination(300)
    assert q.exception() is None


class Fault(Exception):
    pass


def failing_once(at):
    """An ``after`` hook that fails behind the writes of batch ``at`` the first time."""
    seen = []

    def after(batch):
        if batch == at and not seen:
            seen.append(batch)
            raise Fault(f"batch {batch}")
    return after


def run_twice(start):
    """Run, fail inside a batch, and run again on the same checkpoint."""
    with pytest.raises(Exception, match="Fault|batch"):
        start()
    start()


@pytest.mark.parametrize("split", [{}, {"rows_per_split": 7}])
def test_billing_restarts_equal_batch(spark, split):
    """Several micro-batches, a fault between writes and commit, and a restart when more has landed."""
    rows = sorted(random_readings(31, n=240, nodes=3))
    base = scratch(spark, "bill")
    src = os.path.join(base, "src")
    for i in range(3):
        land(src, i, rows[i * 60:(i + 1) * 60])
    after = failing_once(1)
    run_twice(lambda: Co.billing(stream_of(spark, src), base, after=after, **split))
    land(src, 3, rows[180:])
    Co.billing(stream_of(spark, src), base, **split)
    out = spark.read.parquet(os.path.join(base, "out"))
    assert out.select("batch_id").distinct().count() >= 3
    batch = B.billing_windows(spark.createDataFrame(rows, READ_COLS))
    assert rows_of(out.select(*batch.columns), batch.columns) == rows_of(batch, batch.columns)
    cols = ["node_id", "node_type", "district_id", "energy_ckwms", "period_start", "period_end", "off"]
    assert rows_of(out.select(*cols), cols) == sort_rows(fold_bills(rows))


def test_billing_step_is_native_and_splits_hot_nodes(spark):
    rows = spark.createDataFrame(random_readings(5, n=400, nodes=1), READ_COLS)
    none = spark.createDataFrame([], steps.BILL_STATE)
    seen = []
    keep, steps._materialised = steps._materialised, lambda df: (seen.append(df._jdf.queryExecution().executedPlan().toString()), df.checkpoint())[1]
    try:
        bills, state = steps.billing_step(rows, none, rows_per_split=50)
    finally:
        steps._materialised = keep
    assert "Pandas" not in seen[0] and "Python" not in seen[0] and "_split" in seen[0]
    assert bills.count() == 80 and state.count() == 1


def test_charge_per_batch(spark):
    # each file is one micro-batch: the charge integrates batch balance x time since the last batch
    files = [[(0, "a", "P", "d", 100, 3_600_000)],
             [(1, "a", "P", "d", -500, 7_200_000), (2, "b", "P", "d", 200, 5_000_000)],
             [(3, "a", "P", "d", 300, 10_800_000)], [(4, "a", "P", "d", 50, 1_000), (5, "a", "P", None, 50, 1_000)]]
    base = scratch(spark, "charge")
    src = os.path.join(base, "src")
    for i, f in enumerate(files):
        land(src, i, f)
    after = failing_once(2)
    run_twice(lambda: Co.charge(stream_of(spark, src), base, after=after))
    out = steps.charge_rows(spark.read.parquet(f"{base}/charge/changes").orderBy("batch_id")).collect()
    got = [(r["num_measurements"], r["max_event_ms"], r["charge_kwh"]) for r in out]
    # batch 0: first sight; batch 1: (100 - 500 + 200) * 1 h < 0 -> 0; batch 2: 300 * 1 h; batch 3 is late: counted, no clock
    three = pytest.approx(300 * 3_600_000 / 3.6e8)
    assert got == [(1, 3_600_000, 0.0), (2, 7_200_000, 0.0), (1, 10_800_000, three), (1, 10_800_000, three)]
    assert steps.charge_rows(Co.charge_table(spark, base).current()).collect() == out[3:]


def test_keyed_table_upserts_compacts_and_replays(spark):
    import random
    rnd = random.Random(3)
    table = Tb.KeyedTable(spark, scratch(spark, "table"), ["k"], "k string, v long", compact_every=3)
    now, kind = {}, "k string, v long, gone boolean"
    assert table.current().count() == 0 and table.before(0).count() == 0
    for batch in range(8):
        before = {r.k: r.v for r in table.before(batch).collect()}
        assert before == now
        changed = {rnd.choice(["a", "b", None, f"n{rnd.randrange(5)}"]): (rnd.randrange(100), rnd.random() < 0.3) for _ in range(rnd.randrange(4) if batch else 3)}
        if batch % 2:  # a first attempt that is replaced, with other rows
            table.write(batch, spark.createDataFrame([("lost", 1, False)], kind))
            assert {r.k: r.v for r in table.before(batch).collect()} == now
        table.write(batch, spark.createDataFrame([(k, v, g) for k, (v, g) in changed.items()], kind))
        for k, (v, g) in changed.items():
            now.pop(k, None)
            if not g:
                now[k] = v
        assert {r.k: r.v for r in table.current().collect()} == now
    assert sorted(os.listdir(f"{table.path}/base")) == ["below=3", "below=6"]


def test_twin_steps_equal_batch(spark):
    """Micro-batches of parents, periods and crash events, a fault in one of them; equals the batch twin."""
    import random
    rnd = random.Random(12)
    kinds = ["parent", "parent", "period", "crash", "recovered"]
    rows = [(str(rnd.randrange(1, 5)), k, i, {"parent": rnd.choice(["1", "2", ""]), "period": str(rnd.randrange(1, 9) * 1000)}.get(k))
            for i, k in enumerate(rnd.choice(kinds) for _ in range(120))]
    rows += [("99", "parent", 200, "1")]  # no such twin
    schema = pa.schema([("node_id", pa.string()), ("kind", pa.string()), ("ord", pa.int64()), ("value", pa.string())])
    base, registry = scratch(spark, "twin"), spark.createDataFrame([(str(i),) for i in range(1, 7)], "node_id string")
    for i in range(4):
        land(f"{base}/src", i, rows[i * 31:(i + 1) * 31], schema)
    after = failing_once(2)
    events = stream_of(spark, f"{base}/src", "node_id string, kind string, ord long, value string")
    run_twice(lambda: Co.twins(events, registry, f"{base}/run", after=after))
    e = spark.createDataFrame(rows, "node_id string, kind string, ord long, value string")
    live = e.where("kind in ('crash', 'recovered')").select("node_id", F.col("ord").alias("tick_ms"), F.col("kind").alias("event"))
    want = W.twin_state(registry, e.where("kind = 'parent'").select("node_id", F.col("ord").alias("off"), F.col("value").alias("parent")),
                        e.where("kind = 'period'").select("node_id", F.col("ord").alias("off"), F.col("value").cast("long").alias("period_ms")), live)
    want = want.where(F.col("node_id").isin([r[0] for r in rows]))
    got = Co.twin_table(spark, f"{base}/run").current()
    assert rows_of(got, want.columns) == rows_of(want, want.columns)


def test_late_readings_go_to_the_side(spark):
    on_time = [(i, "n1", "P", "d1", 100, 1_000_000 + 10_000 * i) for i in range(12)]
    late = [(99, "n1", "P", "d1", 100, 500_000), (98, "n1", "P", "d1", 7, 1_100_000)]
    base = scratch(spark, "side")
    land(f"{base}/src", 0, on_time)
    land(f"{base}/src", 1, late)
    after = failing_once(1)
    run_twice(lambda: Co.sliding(stream_of(spark, f"{base}/src"), base, 120_000, 30_000, 30_000, after=after))
    assert [(r.off, r.batch_id) for r in spark.read.parquet(f"{base}/late").collect()] == [(99, 1)]
    got = Co.window_rows(Co.window_table(spark, base).current(), 120_000)
    want = Wn.sliding_balance(spark.createDataFrame(on_time + late[1:], READ_COLS))
    assert rows_of(got, sorted(want.columns)) == rows_of(want, sorted(want.columns))


def test_sliding_stream_late_rows(spark):
    # Watermark after file 0: 1_110_000 - 30 s = 1_080_000. Rows within it are always
    # aggregated (1_100_000 updates open windows); a row older than the watermark is
    # not guaranteed to be dropped -- it may only ever add windows of its own.
    on_time = [(i, "n1", "P", "d1", 100, 1_000_000 + 10_000 * i) for i in range(12)]
    late = [(99, "n1", "P", "d1", 100, 500_000), (98, "n1", "P", "d1", 7, 1_100_000)]
    base = scratch(spark, "slide")
    src = os.path.join(base, "src")
    land(src, 0, on_time)
    land(src, 1, late)
    df = Wn.sliding_balance(stream_of(spark, src), watermark="30 seconds")
    run(spark, df, base, mode="update")
    got = S.latest_per_key(spark, os.path.join(base, "out"), ["district_id", "window_start_ms"])
    want = Wn.sliding_balance(spark.createDataFrame(on_time + late[1:], READ_COLS))
    cols = sorted(want.columns)
    g, w = set(rows_of(got.select(*cols), cols)), set(rows_of(want, cols))
    assert w <= g
    extra_starts = {r[cols.index("window_start_ms")] for r in g - w}
    assert all(s <= 500_000 < s + 120_000 for s in extra_starts)


def test_liveness_stream_equals_batch_up_to_watermark(spark):
    # (times start well after 0: a row at the initial watermark counts as late). A timer fires
    # once the watermark passes it, so the stream covers ticks before the final watermark.
    T0 = 1_000_000
    act = [("1", 0, T0), ("2", 1, T0 + 1000), ("1", 2, T0 + 30000), ("2", 3, T0 + 40000), ("1", 4, T0 + 41000),
           ("2", 5, T0 + 90000)]
    per = [("2", 10, T0 + 20000, 2000)]
    base = scratch(spark, "live")
    sa, sp = os.path.join(base, "a"), os.path.join(base, "p")
    asch = pa.schema([("node_id", pa.string()), ("off", pa.int64()), ("t", pa.int64())])
    psch = pa.schema([("node_id", pa.string()), ("off", pa.int64()), ("t", pa.int64()), ("period_ms", pa.int32())])
    for i in range(3):
        land(sa, i, act[i * 2:(i + 1) * 2], asch)
    land(sp, 0, per, psch)
    a = spark.readStream.schema("node_id string, off long, t long").option("maxFilesPerTrigger", 1).parquet(sa)
    p = spark.readStream.schema("node_id string, off long, t long, period_ms int").parquet(sp)
    run(spark, St.liveness_stream(a, p, watermark="0 seconds", default_period_ms=4000, tick_ms=2000), base)
    got = spark.read.parquet(os.path.join(base, "out"))
    batch = W.liveness_events(spark.createDataFrame(act, "node_id string, off long, t long"),
                              spark.createDataFrame(per, "node_id string, off long, t long, period_ms int"),
                              default_period_ms=4000, tick_ms=2000, horizon_ms=T0 + 90000 - 1)
    cols = ["node_id", "tick_ms", "event"]
    assert rows_of(got.select(*cols), cols) == rows_of(batch.select(*cols), cols)


def test_concurrent_queries_share_one_parsed_stream(spark):
    rows = sorted(random_readings(41, n=100))
    base = scratch(spark, "conc")
    src = os.path.join(base, "src")
    land(src, 0, rows)
    s = stream_of(spark, src)
    outs = S.concurrent_queries(spark, {
        "q_high": (s.where("v100 > 0"), "append", None),
        "q_slide": (Wn.sliding_balance(s, watermark="30 seconds"), "update", None)})
    assert spark.read.parquet(outs["q_high"]).count() == sum(r[4] > 0 for r in rows)
    assert spark.read.parquet(outs["q_slide"]).count() > 0


def test_keyed_log_roundtrip_and_measurement_stream(spark):
    from gridflow.operators.parse import measurement_record
    rows = random_readings(51, n=50)
    base = scratch(spark, "log")
    recs = measurement_record(spark.createDataFrame(rows, READ_COLS)).select(
        F.lit("measurements").alias("topic"), "off", "key", "value")
    S.write_keyed_log(recs, os.path.join(base, "log"))
    back = Src.replay_log(spark, os.path.join(base, "log"))
    assert back.count() == 50
    parsed = Src.measurement_stream(Src.log_stream(spark, os.path.join(base, "log")))
    run(spark, parsed.select("off", "node_id", "v100", "t"), base)
    got = spark.read.parquet(os.path.join(base, "out")).drop("batch_id")
    assert rows_of(got, ["off", "node_id", "v100", "t"]) == sort_rows([(r[0], r[1], r[4], r[5]) for r in rows])


def test_broker_stream_without_connector_is_a_clear_error(spark):
    with pytest.raises(Exception):
        Src.broker_stream(spark, "localhost:1", "measurements")


def test_serial_line_source_and_node_dimension(spark):
    base = scratch(spark, "serial")
    for node, lines in {"3": ["PARENT_CHANGE: fd00::201", "noise"], "4": ["MSG_SENT: 7"]}.items():
        os.makedirs(os.path.join(base, "lines", node), exist_ok=True)
        with open(os.path.join(base, "lines", node, "console.log"), "w") as f:
            f.write("\n".join(lines) + "\n")
    src = Src.serial_line_source(spark, os.path.join(base, "lines"))
    first = [("3", "PARENT_CHANGE: fd00::201", 1), ("3", "noise", 2), ("4", "MSG_SENT: 7", 1)]
    assert sorted((r["node_id"], r["line"], r["off"]) for r in src.collect()) == first
    # the stream numbers the same lines, batch by batch, also when a batch fails and runs again
    run_lines = lambda after=None: Co.serial_lines(Src.serial_line_stream(spark, os.path.join(base, "lines")), os.path.join(base, "run"), after=after)
    run_lines()
    for i, (node, lines) in enumerate([("3", ["b", "a"]), ("5", ["c"]), ("3", ["d"])]):
        os.makedirs(os.path.join(base, "lines", node), exist_ok=True)
        with open(os.path.join(base, "lines", node, f"z{9 - i}.log"), "w") as f:  # names do not ascend, times do
            f.write("\n".join(lines) + "\n")
        time.sleep(0.05)
    run_twice(lambda after=failing_once(1): run_lines(after))
    want = first + [("3", "b", 3), ("3", "a", 4), ("3", "d", 5), ("5", "c", 1)]
    assert sorted(tuple(r) for r in spark.read.parquet(os.path.join(base, "run/out")).select("node_id", "line", "off").collect()) == sorted(want)
    again = Src.serial_line_source(spark, os.path.join(base, "lines"))
    assert sorted(tuple(r) for r in again.collect()) == sorted(want)
    cfg = {"mqttBroker": "x", "nodes": [{"nodeId": "1", "ipv6": "fd00::201:1:1:1"},
                                        {"nodeId": "2", "ipv6": "FD00::201:1:1:1"}, {"nodeId": "3"}]}
    with open(os.path.join(base, "nodes.json"), "w") as f:
        json.dump(cfg, f, indent=2)
    dim = Src.node_dimension(spark, os.path.join(base, "nodes.json"))
    assert [(r["pos"], r["node_id"]) for r in dim.orderBy("pos").collect()] == [(0, "1"), (1, "2"), (2, "3")]
    idx = {r["addr_lc"]: r["resolved_id"] for r in W.address_index(dim).collect()}
    assert idx == {"fd00::201:1:1:1": "1"}       # first match in file order, case-insensitive


def test_serial_lines_of_nodes_that_share_files(spark):
    """Files with the lines of many nodes, each led by its node's id: numbered per node over files, as batch and as stream."""
    base = scratch(spark, "shared")
    root = os.path.join(base, "lines")
    parts = [["3\tb", "4\tx\ty", "3\ta", "4\t", "no id"], ["4\tz", "3\tb"], ["5\tc", "3\td", "no id"]]
    run_lines = lambda after=None: Co.serial_lines(Src.serial_line_stream(spark, root, shared=True), os.path.join(base, "run"), after=after)
    for i, lines in enumerate(parts):
        os.makedirs(os.path.join(root, f"part-{i}"))
        with open(os.path.join(root, f"part-{i}", f"z{9 - i}.log"), "w") as f:
            f.write("\n".join(lines) + "\n")
        time.sleep(0.05)
        if i != 1:  # two files in one batch
            run_twice(lambda after=failing_once(1): run_lines(after)) if i else run_lines()
    want = [("3", "b", 1), ("3", "a", 2), ("3", "b", 3), ("3", "d", 4), ("4", "x\ty", 1), ("4", "", 2), ("4", "z", 3), ("5", "c", 1),
            (None, "no id", 1), (None, "no id", 2)]
    for got in (spark.read.parquet(os.path.join(base, "run/out")), Src.serial_line_source(spark, root, shared=True)):
        assert sort_rows(tuple(r) for r in got.select("node_id", "line", "off").collect()) == sort_rows(want)


def test_landed_lines_share_files(spark):
    """The number of landed files does not follow the number of nodes."""
    from gridflow.plans.queries.log_q import _land_lines
    base = scratch(spark, "landed")
    rows = spark.range(600).select((F.col("id") % 200).cast("string").alias("node_id"), F.col("id").alias("off"), F.concat(F.lit("line "), "id").alias("line"))
    _land_lines(rows, base)
    assert len(glob.glob(os.path.join(base, "*", "*.txt"))) <= 8
    got = Src.serial_line_source(spark, base, shared=True)
    assert sort_rows(tuple(r) for r in got.collect()) == sort_rows((str(i % 200), f"line {i}", i // 200 + 1) for i in range(600))


def test_district_charge_stream_equals_batch_closed_steps(spark):
    from gridflow.operators import charge as G
    rows = sorted(random_readings(61, n=300), key=lambda r: r[5])
    rows = [(i, n, ty, d, v, t) for i, (_, n, ty, d, v, t) in enumerate(rows)]   # arrival in time order
    base = scratch(spark, "stepcharge")
    src = os.path.join(base, "src")
    for i in range(5):
        land(src, i, rows[i * 60:(i + 1) * 60])
    closing = rows[-1][5] + 10 * 20_000
    land(src, 5, [(10_000, "n0", "P", "zz", 0, closing)])    # moves the watermark past the last step
    run(spark, St.district_charge_stream(stream_of(spark, src), step_ms=20_000), base)
    got = spark.read.parquet(os.path.join(base, "out")).where("district_id <> 'zz'")
    want = G.district_charge(spark.createDataFrame(rows, READ_COLS), step_ms=20_000)
    cols = sorted(want.columns)
    assert rows_of(got.select(*cols), cols) == rows_of(want, cols)


@pytest.mark.parametrize("fold_rows", [1024, 20])
def test_node_command_stream_equals_fold(spark, fold_rows):
    import random
    from test_folds import fold_nodes
    rnd = random.Random(71)
    ue, cmds, rows = [], [], []
    for o in range(400):
        if rnd.random() < 0.25:
            e = (o, rnd.choice(["UserRegistered", "UserUpdated", "UserDeleted"]), f"u{rnd.randrange(3)}")
            ue.append(e)
            rows.append((o, "u", e[2], e[1], None, None, None))
        else:
            c = (o, f"n{rnd.randrange(3)}", f"u{rnd.randrange(3)}", rnd.choice(["create", "update", "delete"]),
                 rnd.choice(["PRODUCER", "BAD"]))
            cmds.append(c)
            rows.append((o, "c", c[2], None, c[1], c[3], c[4]))
    sch = pa.schema([("off", pa.int64()), ("kind", pa.string()), ("user_id", pa.string()), ("type", pa.string()),
                     ("node_id", pa.string()), ("op", pa.string()), ("node_type", pa.string())])
    base = scratch(spark, "nodecmd")
    src = os.path.join(base, "src")
    schema = ("off long, kind string, user_id string, type string, node_id string, op string, node_type string")

    def start(after=None):
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        Co.node_commands(s, lambda e: e.where("kind = 'u'"), lambda e: e.where("kind = 'c'"), base, after=after, fold_rows=fold_rows)

    # two rounds of two files each; a batch of the second fails behind its writes
    fails = failing_once(2)
    for lo, hi in [(0, 2), (2, 4)]:
        for i in range(lo, hi):
            land(src, i, rows[i * 100:(i + 1) * 100], sch)
        if lo:
            run_twice(lambda: start(fails))
        else:
            start()
    got = spark.read.parquet(os.path.join(base, "out"))
    cols = ["off", "node_id", "user_id", "op", "accepted", "reason"]
    assert rows_of(got.select(*cols), cols) == sort_rows(fold_nodes([(o, t, u) for o, t, u in ue], cmds))


def test_time_limit_raises_and_stops(spark):
    base = scratch(spark, "limit")
    for i in range(20):
        land(os.path.join(base, "src"), i, sorted(random_readings(i, n=20)))
    with pytest.raises(TimeoutError):
        S.run_to_table(spark, Wn.sliding_balance(stream_of(spark, os.path.join(base, "src"))), "limited", "update", timeout_s=0.05)
    assert not spark.streams.active


def test_unreadable_output_raises(spark):
    base = scratch(spark, "broken")
    os.makedirs(os.path.join(base, "out", "batch_id=0"))
    with open(os.path.join(base, "out", "batch_id=0", "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        S.read_output(spark, os.path.join(base, "out"), St.LIVE_OUT).count()
    assert S.read_output(spark, os.path.join(base, "none"), St.LIVE_OUT).count() == 0


def test_stream_run_leaves_the_session_alone(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    from gridflow.plans.catalog import QUERIES
    QUERIES["district_charge_stream"](spark, "/root/testdata/sf0.001").count()
    assert before == {k: spark.conf.get(k, None) for k in before}


@pytest.mark.parametrize("seed", [None, 1, 2, 3])
def test_liveness_late_rows_equal_batch(spark, seed):
    import random
    if seed is None:
        files = [[(0, "n", 100_000), (1, "n", 120_000)], [(2, "n", 101_000)], [(3, "n", 123_000)], [(4, "z", 500_000)], [(5, "z", 900_000)]]
    else:
        rng = random.Random(seed)
        times = sorted(rng.randrange(100_000, 220_000) for _ in range(60))
        order = sorted(times, key=lambda t: t + rng.randrange(0, 25_000))  # late by less than the watermark
        rows = [(i, rng.choice("ab"), t) for i, t in enumerate(order)]
        files = [rows[i:i + 12] for i in range(0, 60, 12)] + [[(60, "z", 500_000)], [(61, "z", 900_000)]]
    schema = pa.schema([("off", pa.int64()), ("node_id", pa.string()), ("t", pa.int64())])
    base = scratch(spark, "late")
    src = os.path.join(base, "src")
    for i, rows in enumerate(files):
        land(src, i, rows, schema)
    kw = {"default_period_ms": 4000, "tick_ms": 2000}
    act = spark.readStream.schema("off long, node_id string, t long").option("maxFilesPerTrigger", 1).parquet(src)
    none = spark.readStream.schema("off long, node_id string, t long").parquet(src).where("false").withColumn("period_ms", F.lit(1))
    out = S.run_to_table(spark, St.liveness_stream(act, none, watermark="30 seconds", **kw), "late")
    got = {(r.node_id, r.tick_ms, r.event) for r in out.collect() if r.node_id != "z"}
    batch = spark.read.parquet(src)
    want = {(r.node_id, r.tick_ms, r.event) for r in
            W.liveness_events(batch, batch.where("false").withColumn("period_ms", F.lit(1)), **kw).collect() if r.node_id != "z"}
    assert got == want
    if seed is None:
        assert {("n", 114_000, "crash"), ("n", 120_000, "recovered")} <= got


def tick_loop(rows, default, tick, until):
    """Crash / recovered events by evaluating every tick: rows (node, off, t, kind, period) in order of
    (t, kind, off) are taken before the tick at or behind their time."""
    out = []
    for node in sorted({r[0] for r in rows}):
        mine = sorted((t, kind, off, p) for n, off, t, kind, p in rows if n == node)
        seen, period, crashed, i = None, 0, False, 0
        for at in range(mine[0][0] // tick * tick, until + 1, tick):
            while i < len(mine) and mine[i][0] <= at:
                t, kind, _, p = mine[i]
                seen, period = (t, period) if kind == 0 else (seen, p or 0)
                i += 1
            if seen is not None:
                bad = at - seen > 3 * (period or default)
                if bad != crashed:
                    out.append((node, at, "crash" if bad else "recovered"))
                    crashed = bad
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_liveness_equals_a_tick_loop(spark, seed):
    """Batch and stream against the loop over all ticks, with equal times and rows on the tick."""
    import random
    rnd = random.Random(seed)
    times = sorted(rnd.randrange(500, 620) * 1000 // rnd.choice([1, 1, 3]) * rnd.choice([1, 1]) for _ in range(70))
    rows = [(rnd.choice("ab"), i, t, int(rnd.random() < 0.2), rnd.choice([0, 1000, 2500, 9000])) for i, t in enumerate(times)]
    act = [(n, o, t) for n, o, t, k, _ in rows if k == 0]
    per = [(n, o, t, p) for n, o, t, k, p in rows if k == 1]
    a, p = spark.createDataFrame(act, "node_id string, off long, t long"), spark.createDataFrame(per, "node_id string, off long, t long, period_ms long")
    end = times[-1]
    kw = {"default_period_ms": 4000, "tick_ms": 2000}
    got = sorted((r.node_id, r.tick_ms, r.event) for r in W.liveness_events(a, p, horizon_ms=end, **kw).collect())
    assert got == tick_loop(rows, 4000, 2000, end) and got
    schema = pa.schema([("node_id", pa.string()), ("off", pa.int64()), ("t", pa.int64()), ("kind", pa.int64()), ("period_ms", pa.int64())])
    base = scratch(spark, "ticks")
    for i in range(5):
        land(f"{base}/src", i, [(n, o, t, k, q) for n, o, t, k, q in rows[i * 14:(i + 1) * 14]], schema)
    s = stream_of(spark, f"{base}/src", "node_id string, off long, t long, kind long, period_ms long")
    out = S.run_to_table(spark, St.liveness_stream(s.where("kind = 0"), s.where("kind = 1"), watermark="0 seconds", **kw), "ticks")
    assert sorted((r.node_id, r.tick_ms, r.event) for r in out.collect()) == tick_loop(rows, 4000, 2000, end - 1)


def test_liveness_of_a_node_with_many_waiting_rows(spark):
    """100,000 rows of one node wait for the watermark: Python gets one row per tick interval."""
    base, t0 = scratch(spark, "wait"), 10_000_000
    rows = spark.range(100_000).select(F.lit("hot").alias("node_id"), F.col("id").alias("off"), (t0 + F.col("id") % 60_000).alias("t"))
    rows.write.parquet(f"{base}/src/a")
    end = spark.createDataFrame([("z", 200_000, t0 + 500_000)], "node_id string, off long, t long")
    schema, kw = "node_id string, off long, t long", {"default_period_ms": 4000, "tick_ms": 2000}
    act = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/src")
    df = St.liveness_stream(act, act.where("false").withColumn("period_ms", F.lit(1)), watermark="90 seconds", **kw)
    start = lambda: S.finish(S.update_sink(df, "", f"{base}/out", f"{base}/ck", output_mode="append"))
    start()
    assert S.read_output(spark, f"{base}/out", St.LIVE_OUT).count() == 0
    end.write.parquet(f"{base}/src/b")
    start()
    got = [(r.node_id, r.tick_ms, r.event) for r in S.read_output(spark, f"{base}/out", St.LIVE_OUT).collect() if r.node_id == "hot"]
    # last seen at t0 + 59,999: the first tick more than 12 s later
    assert got == [("hot", t0 + 72_000, "crash")]


def test_liveness_state_is_per_group_of_nodes(spark, monkeypatch):
    """Sixty nodes (one without an id) in four groups: the events of the batch form, and a state row per group."""
    import random
    monkeypatch.setattr(St, "LIVE_GROUPS", 4)
    rnd = random.Random(5)
    times = sorted(rnd.randrange(500_000, 700_000) for _ in range(600)) + [700_001]
    rows = [(rnd.choice([None, *(f"n{i}" for i in range(59))]), i, t, int(rnd.random() < 0.2), rnd.choice([0, 1000, 2500, 9000])) for i, t in enumerate(times)]
    schema = pa.schema([("node_id", pa.string()), ("off", pa.int64()), ("t", pa.int64()), ("kind", pa.int64()), ("period_ms", pa.int64())])
    base = scratch(spark, "groups")
    for i in range(3):
        land(f"{base}/src", i, rows[i * 201:(i + 1) * 201], schema)
    ddl, kw = "node_id string, off long, t long, kind long, period_ms long", {"default_period_ms": 4000, "tick_ms": 2000}
    both = lambda df: (df.where("kind = 0"), df.where("kind = 1"))
    q = S.update_sink(St.liveness_stream(*both(stream_of(spark, f"{base}/src", ddl)), watermark="0 seconds", **kw), "", f"{base}/out", f"{base}/ck", output_mode="append")
    S.finish(q)
    cols = ["node_id", "tick_ms", "event", "last_seen_ms", "period_ms"]
    want = W.liveness_events(*both(spark.read.parquet(f"{base}/src")), horizon_ms=times[-1] - 1, **kw)
    got = S.read_output(spark, f"{base}/out", St.LIVE_OUT)
    assert rows_of(got.select(*cols), cols) == rows_of(want.select(*cols), cols) and got.count() > 60
    kept = [o["numRowsTotal"] for p in q.recentProgress for o in json.loads(p.json)["stateOperators"] if o["operatorName"].startswith("transformWithState")]
    assert kept and max(kept) <= 8  # a state row and a timer per group


def test_liveness_intervals_reach_python_packed(spark):
    """One row of lists per group of nodes, nothing for no activity or no period change."""
    rows = {"nodes": [3, 1, 3, 1], "node_id": ["a", "b", "c", None], "tick": [2000, 4000, 6000, 8000],
            "seen": [1500, None, 2**60 + 1, 7], "period": [None, 0, 5, None]}
    schema = pa.schema([("nodes", pa.int64()), ("node_id", pa.string()), *((c, pa.int64()) for c in ("tick", "seen", "period"))])
    batches = pa.table(rows, schema=schema).to_batches(max_chunksize=3)
    got = sorted((r for b in St._pack(iter(batches)) for r in b.to_pylist()), key=lambda r: r["nodes"])
    none = St._NONE
    assert got == [{"nodes": 1, "node_id": ["b", None], "tick": [4000, 8000], "seen": [none, 7], "period": [0, none]},
                   {"nodes": 3, "node_id": ["a", "c"], "tick": [2000, 6000], "seen": [1500, 2**60 + 1], "period": [none, 5]}]


def test_liveness_hashes_and_takes_the_latest_period_of_equal_times(spark):
    """The interval aggregate sorts nothing; of period changes at one time the largest arrival position counts."""
    t0, big = 1_000_000, 2**62
    act = [("n", 0, t0), ("m", 1, t0), ("z", 2, t0 + 100_000)]
    per = [("n", big + 1, t0 + 10, 9000), ("n", big, t0 + 10, 1000), ("n", None, t0 + 10, 2000), ("m", -5, t0 + 10, 3000), ("m", None, t0 + 10, 1000)]
    base = scratch(spark, "equal")
    asch = pa.schema([("node_id", pa.string()), ("off", pa.int64()), ("t", pa.int64())])
    land(f"{base}/a", 0, act, asch)
    land(f"{base}/p", 0, per, asch.append(pa.field("period_ms", pa.int64())))
    ddl = "node_id string, off long, t long"
    df = St.liveness_stream(spark.readStream.schema(ddl).parquet(f"{base}/a"), spark.readStream.schema(ddl + ", period_ms long").parquet(f"{base}/p"),
                            watermark="0 seconds", default_period_ms=4000, tick_ms=2000)
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    got = {(r.node_id, r.tick_ms, r.event, r.period_ms) for r in S.run_to_table(spark, df, "equal").collect()}
    # the first tick more than three periods behind the last activity
    assert got == {("n", t0 + 28_000, "crash", 9000), ("m", t0 + 10_000, "crash", 3000)}
