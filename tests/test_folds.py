"""Operators against plain-Python sequential folds written from the specified
semantics, on hand-made cases and seeded random sequences. Every operator runs
twice: normally, and with ``rows_per_split`` tiny so every key is "hot" and is
split across tasks -- both must equal the fold."""
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, sort_rows
from gridflow.operators import billing as B
from gridflow.operators import charge as G
from gridflow.operators import registry as R
from gridflow.operators import twin as W
from gridflow.plans.ordered import ordered_scan

SPLITS = [{}, {"rows_per_split": 3}]

READ_COLS = "off long, node_id string, node_type string, district_id string, v100 long, t long"


def random_readings(seed, n=300, nodes=4):
    rnd = random.Random(seed)
    rows, t = [], 1_000_000
    for off in range(n):
        node = f"n{rnd.randrange(nodes)}"
        t += rnd.choice([0, 1000, 5000, 60000, -3000])  # ties and a clock going back
        typ = rnd.choice(["CONSUMER", "PRODUCER", "ACCUMULATOR", "OTHER"])
        rows.append((off, node, typ, f"d{rnd.randrange(3)}", rnd.randrange(-5000, 5000), t))
    return rows


# ---- billing --------------------------------------------------------------------

def fold_bills(rows, size=5):
    last_t, acc, cnt, start, out = {}, {}, {}, {}, []
    for off, node, typ, dist, v, t in sorted(rows):
        lt = last_t.get(node)
        if lt is not None and t > lt:
            acc[node] = acc.get(node, 0) + abs(v) * (t - lt)
        last_t[node] = t
        cnt[node] = cnt.get(node, 0) + 1
        if cnt[node] == 1:
            start[node] = t
        if cnt[node] >= size:
            out.append((node, typ, dist, acc.get(node, 0), start[node], t, off))
            acc[node], cnt[node] = 0, 0
    return out


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", [1, 2])
def test_billing_windows_equal_fold(spark, seed, split):
    rows = random_readings(seed)
    df = spark.createDataFrame(rows, READ_COLS)
    got = B.billing_windows(df, **split).select(
        "node_id", "node_type", "district_id", "energy_ckwms", "period_start", "period_end", "off")
    assert rows_of(got, got.columns) == sort_rows(fold_bills(rows))


def test_billing_hand_cases(spark):
    # 4 readings: no bill; 6 readings: one bill; the gap before reading 6 counts in window 2;
    # clock going back at reading 3 adds nothing; a zero-energy PRODUCER costs 0.0 (not -0.0)
    rows = [(i, "a", "CONSUMER", "d", 100, 1000 * i) for i in range(4)]
    rows += [(10 + i, "b", "PRODUCER", "d", 0, 1000 * i) for i in range(6)]
    rows += [(20 + i, "c", "CONSUMER", "d", 100, [0, 1000, 500, 2000, 3000][i]) for i in range(5)]
    df = spark.createDataFrame(rows, READ_COLS)
    got = {r["node_id"]: r for r in B.billing_windows(df).collect()}
    assert "a" not in got
    assert got["b"]["cost"] == 0.0 and str(got["b"]["cost"]) == "0.0"
    # c: 0->1000 adds 1000, 1000->500 adds 0 (clock back), 500->2000 adds 1500, 2000->3000 adds 1000
    assert got["c"]["energy_ckwms"] == 100 * (1000 + 1500 + 1000)
    assert got["c"]["period_start"] == 0 and got["c"]["period_end"] == 3000
    assert got["c"]["cost"] == pytest.approx(100 * 3500 / 3.6e8 * 0.25)


# ---- charge ------------------------------------------------------------------------

def fold_charge(rows, step_ms):
    steps = {}
    for off, node, typ, dist, v, t in rows:
        s = steps.setdefault((dist, t // step_ms), [0, 0, None])
        s[0] += v
        s[1] += 1
        s[2] = t if s[2] is None else max(s[2], t)
    out, state = [], {}
    for (dist, step) in sorted(steps):
        bal, n, mx = steps[(dist, step)]
        charge, last = state.get(dist, (0, -1))
        clock = max(last, mx)
        if last > 0 and clock - last > 0:
            charge = max(0, charge + bal * (clock - last))
        state[dist] = (charge, clock)
        out.append((dist, step, n, clock, charge / 3.6e8))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_district_charge_equals_fold(spark, seed):
    rows = random_readings(seed, n=400)
    df = spark.createDataFrame(rows, READ_COLS)
    got = G.district_charge(df, step_ms=20_000).select(
        "district_id", "step", "num_measurements", "max_event_ms", "charge_kwh")
    assert rows_of(got, got.columns) == sort_rows(fold_charge(rows, 20_000))


def test_charge_clamps_and_recovers(spark):
    rows = [(0, "x", "P", "d", 100, 3_600_000), (1, "x", "P", "d", -500, 7_200_000),
            (2, "x", "P", "d", 300, 10_800_000)]
    df = spark.createDataFrame(rows, READ_COLS)
    got = [r["charge_kwh"] for r in G.district_charge(df, 3_600_000).orderBy("step").collect()]
    # first step integrates nothing; second would go negative -> 0; third recovers
    assert got == [0.0, 0.0, pytest.approx(300 * 3_600_000 / 3.6e8)]


def test_step_charge_fixed_dt(spark):
    b = spark.createDataFrame([(1, 0, 600), (1, 1, -1200), (1, 2, 60)], "district long, step long, balance_v100 long")
    got = [r["charge_kwh"] for r in G.step_charge(b).orderBy("step").collect()]
    assert got == [pytest.approx(0.1), 0.0, pytest.approx(0.01)]


# ---- commands --------------------------------------------------------------------

def fold_accounts(cmds):
    users, out = set(), []
    for off, user, op in sorted(cmds):
        if op == "register":
            ok = user not in users
            users.add(user)
        elif op in ("update", "delete"):
            ok = user in users
            if op == "delete":
                users.discard(user)
        else:
            ok = False
        out.append((off, user, op, ok))
    return out


@pytest.mark.parametrize("split", SPLITS)
def test_account_commands_equal_fold(spark, split):
    rnd = random.Random(7)
    cmds = [(i, f"u{rnd.randrange(4)}", rnd.choice(["register", "update", "delete", "other"])) for i in range(200)]
    df = spark.createDataFrame(cmds, "off long, user_id string, op string")
    got = R.account_commands(df, **split).select("off", "user_id", "op", "accepted")
    assert rows_of(got, got.columns) == sort_rows(fold_accounts(cmds))


def fold_nodes(user_events, cmds):
    valid, nodes, out = set(), {}, []
    stream = [(o * 2, "u", e) for o, *e in user_events] + [(o * 2 + 1, "c", (o, *c)) for o, *c in cmds]
    for _, kind, ev in sorted(stream):
        if kind == "u":
            typ, user = ev
            if typ in ("UserRegistered", "UserUpdated"):
                valid.add(user)
            elif typ == "UserDeleted":
                valid.discard(user)
            continue
        off, node, user, op, ntype = ev
        if op not in ("create", "update", "delete"):
            r = "unknown command"
        elif user not in valid:
            r = "user not registered"
        elif op == "create":
            r = ("node already exists" if node in nodes else
                 None if ntype in ("PRODUCER", "CONSUMER", "ACCUMULATOR") else "invalid node type")
            if r is None:
                nodes[node] = user
        else:
            r = "node does not exist" if node not in nodes else (None if nodes[node] == user else "not the owner")
            if r is None and op == "delete":
                del nodes[node]
        out.append((off, node, user, op, r is None, r))
    return out


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", [5, 6])
def test_node_commands_equal_fold(spark, seed, split):
    rnd = random.Random(seed)
    ue = [(i, rnd.choice(["UserRegistered", "UserUpdated", "UserDeleted", "UserOther"]), f"u{rnd.randrange(3)}")
          for i in range(60)]
    cmds = [(i, f"n{rnd.randrange(2)}", f"u{rnd.randrange(3)}", rnd.choice(["create", "create", "update", "delete", "x"]),
             rnd.choice(["PRODUCER", "CONSUMER", "BAD"])) for i in range(300)]
    ued = spark.createDataFrame(ue, "off long, type string, user_id string")
    cd = spark.createDataFrame(cmds, "off long, node_id string, user_id string, op string, node_type string")
    for fold_rows in (R.FOLD_ROWS, 0):  # 0: every node is chained by pointer doubling
        got = R.node_commands(ued, cd, fold_rows=fold_rows, **split).select("off", "node_id", "user_id", "op", "accepted", "reason")
        assert rows_of(got, got.columns) == sort_rows(fold_nodes(ue, cmds))


@pytest.mark.parametrize("fold_rows", [R.FOLD_ROWS, 0])
def test_node_commands_from_given_owners_and_with_nulls(spark, fold_rows):
    """Cutting the log and handing on the owners changes no decision; null ids and operations are ordinary values."""
    rnd = random.Random(77)
    ue = [(i, rnd.choice(["UserRegistered", "UserDeleted"]), f"u{rnd.randrange(3)}") for i in range(40)]
    cmds = [(i, rnd.choice(["n1", "n2", None]), rnd.choice(["u0", "u1", "u2", None]), rnd.choice(["create", "create", "update", "delete", "delete", None]),
             rnd.choice(["PRODUCER", None, "CONSUMER"])) for i in range(200)]
    ued = spark.createDataFrame(ue, "off long, type string, user_id string")
    kind = "off long, node_id string, user_id string, op string, node_type string"
    cols = ["off", "node_id", "user_id", "op", "accepted", "reason"]
    want = sort_rows(fold_nodes(ue, cmds))
    whole = R.node_commands(ued, spark.createDataFrame(cmds, kind), fold_rows=fold_rows)
    assert rows_of(whole.select(*cols), cols) == want
    first = R.node_commands(ued, spark.createDataFrame(cmds[:90], kind), fold_rows=fold_rows)
    owners = R.owners_after(first)
    second = R.node_commands(ued, spark.createDataFrame(cmds[90:], kind), fold_rows=fold_rows, owners=owners.where("has").select("node_id", "owner"))
    assert rows_of(first.unionByName(second).select(*cols), cols) == want
    assert R.node_commands(ued, spark.createDataFrame([], kind), fold_rows=fold_rows).count() == 0


def test_hot_node_is_chained_over_many_tasks(spark):
    """One node with 40,000 commands of alternating owners: a chain of 13,333 accepted creates, no Python."""
    n = 40_000
    ued = spark.createDataFrame([(0, "UserRegistered", "a"), (1, "UserRegistered", "b")], "off long, type string, user_id string")
    user = F.when(F.col("id") % 6 < 3, "a").otherwise("b")
    op = F.when(F.col("id") % 3 == 0, "create").when(F.col("id") % 3 == 1, "update").otherwise("delete")
    cd = spark.range(n, numPartitions=8).select((F.col("id") + 10).alias("off"), F.lit("hot").alias("node_id"), user.alias("user_id"), op.alias("op"), F.lit("PRODUCER").alias("node_type"))
    got = R.node_commands(ued, cd, rows_per_split=4000)
    assert "Pandas" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where("accepted").count() == n


def test_node_command_check_order(spark):
    # unregistered user AND missing node: the user check is reported first
    ue = spark.createDataFrame([(0, "UserRegistered", "a")], "off long, type string, user_id string")
    cd = spark.createDataFrame([(1, "n", "b", "update", "BAD"), (2, "n", "a", "create", "PRODUCER"),
                                (3, "n", "a", "update", "BAD"), (4, "n", "b", "delete", "X")],
                               "off long, node_id string, user_id string, op string, node_type string")
    got = {r["off"]: (r["accepted"], r["reason"]) for r in R.node_commands(ue, cd).collect()}
    assert got[1] == (False, "user not registered")
    assert got[2] == (True, None)
    assert got[3] == (True, None)           # update accepts any type
    assert got[4] == (False, "user not registered")


# ---- registry / as-of ------------------------------------------------------------

def test_registry_fold_and_asof(spark):
    ev = spark.createDataFrame([
        (1, "NodeCreated", "n1", "d1", "PRODUCER", "u1", 1.0),
        (3, "NodeDeleted", "n1", None, None, "u1", 0.0),
        (5, "NodeCreated", "n1", "d2", "CONSUMER", "u2", 1.0),
        (6, "NodeUpdated", "n2", "d3", "CONSUMER", "u3", 1.0),
        (9, "Weird", "n2", None, None, None, 0.0)],
        "off long, type string, node_id string, district_id string, node_type string, owner_id string, capacity double")
    cur = {r["node_id"]: r for r in R.nodes_current(ev).collect()}
    assert cur["n1"]["district_id"] == "d2" and cur["n2"]["owner_id"] == "u3"
    rd = spark.createDataFrame([(0, "n1", "X", "dx", 1, 0), (2, "n1", "X", "dx", 1, 0), (4, "n1", "X", "dx", 1, 0),
                                (5, "n1", "X", "dx", 1, 0), (7, "n9", "X", "dx", 1, 0)], READ_COLS)
    for split in SPLITS:
        r = {x["off"]: x for x in R.measurement_route(ev, rd, **split).collect()}
        assert r[0]["reason"] == "unknown node"
        assert r[2]["accepted"] and r[2]["district_id"] == "d1"
        assert r[4]["reason"] == "deleted node"
        assert r[5]["accepted"] and r[5]["district_id"] == "d2"   # registry first at equal positions
        assert r[7]["reason"] == "unknown node"


# ---- ordered scan: split layout never changes results -----------------------------

def test_ordered_scan_split_equals_plain(spark):
    rnd = random.Random(11)
    rows = [(f"k{rnd.randrange(3)}", i, rnd.choice([None, rnd.randrange(100)])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    kw = dict(position="pos", lags={"v": "lag_v"}, leads={"v": "lead_v"}, fills={"v": "ff"},
              fills_before={"v": "fb"}, ends={"v": ("first", "last")})
    a = ordered_scan(df, ["k"], "o", **kw)
    b = ordered_scan(df, ["k"], "o", rows_per_split=7, **kw)
    cols = ["k", "o", "v", "pos", "lag_v", "lead_v", "ff", "fb", "first", "last"]
    assert rows_of(a, cols) == rows_of(b, cols)
    # and equal to a direct Python scan
    want = []
    by = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        by.setdefault(k, []).append((o, v))
    for k, seq in by.items():
        last = None
        for i, (o, v) in enumerate(seq):
            fb = last
            if v is not None:
                last = v
            want.append((k, o, v, i + 1, seq[i - 1][1] if i else None,
                         seq[i + 1][1] if i + 1 < len(seq) else None, last, fb))
    assert rows_of(a, cols[:8]) == sort_rows(want)
    ends = {k: (of[0], of[-1]) for k in by for of in [[v for kk, _, v in sorted(rows, key=lambda r: r[1]) if kk == k]]}
    assert {(r.k, r.first, r.last) for r in b.collect()} == {(k, *x) for k, x in ends.items()}


# ---- liveness: segment form equals the tick loop ------------------------------------

def tick_loop(activity, periods, default, tick, mult, horizon):
    rows = sorted([(t, 0, o, n, None) for n, o, t in activity] + [(t, 1, o, n, p) for n, o, t, p in periods])
    start = min(r[0] for r in rows)
    out = []
    nodes = sorted({r[3] for r in rows})
    for n in nodes:
        mine = [r for r in rows if r[3] == n]
        crashed = False
        tau = (start // tick) * tick
        while tau <= horizon:
            seen = [r for r in mine if r[0] <= tau]
            acts = [r for r in seen if r[1] == 0]
            if acts:
                last_seen = acts[-1][0]
                ps = [r for r in seen if r[1] == 1]
                p = ps[-1][4] if ps else 0
                p = p or default
                bad = tau - last_seen > mult * p
                if bad != crashed:
                    out.append((n, tau, "crash" if bad else "recovered"))
                    crashed = bad
            tau += tick
    return out


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", [21, 22, 23])
def test_liveness_segment_equals_tick_loop(spark, seed, split):
    rnd = random.Random(seed)
    act, per, t = [], [], 0
    for o in range(120):
        t += rnd.choice([0, 500, 1000, 2000, 7000, 13000])
        node = f"{rnd.randrange(3)}"
        if rnd.random() < 0.2:
            per.append((node, o, t, rnd.choice([0, 1000, 2000, 4000])))
        else:
            act.append((node, o, t))
    horizon = t
    a = spark.createDataFrame(act, "node_id string, off long, t long")
    p = spark.createDataFrame(per, "node_id string, off long, t long, period_ms int")
    got = W.liveness_events(a, p, default_period_ms=4000, tick_ms=2000, multiplier=3, horizon_ms=horizon, **split)
    got = rows_of(got.select("node_id", "tick_ms", "event"), ["node_id", "tick_ms", "event"])
    assert got == sort_rows(tick_loop(act, per, 4000, 2000, 3, horizon))


def test_liveness_exact_timeout_boundary(spark):
    # silence of exactly 3 x period is not a crash; 1 ms more is
    a = spark.createDataFrame([("1", 0, 0), ("2", 1, 1)], "node_id string, off long, t long")
    p = spark.createDataFrame([], "node_id string, off long, t long, period_ms int")
    ev = W.liveness_events(a, p, default_period_ms=4000, tick_ms=2000, horizon_ms=14000).collect()
    got = {(r["node_id"], r["tick_ms"]) for r in ev}
    assert ("1", 14000) in got and ("1", 12000) not in got
    assert ("2", 14000) in got


# ---- parents -----------------------------------------------------------------------

@pytest.mark.parametrize("split", SPLITS)
def test_parent_history_and_state(spark, split):
    ups = [("2", i, p) for i, p in enumerate(["a", "b", "b", "", "c"])] + [("1", 10, "x")]
    df = spark.createDataFrame(ups, "node_id string, off long, parent string")
    h = {r["off"]: (r["parent"], r["hist_1"], r["hist_2"], r["hist_3"])
         for r in W.parent_history(df, **split).collect()}
    assert h[0] == ("a", "1", None, None)
    assert h[4] == ("c", "", "b", "b")       # repeated parents fill the history
    assert h[10] == ("x", "root", None, None)
    reg = W.twin_registry(spark, 3)
    live = spark.createDataFrame([("2", 5, "crash"), ("2", 9, "recovered"), ("3", 4, "crash")],
                                 "node_id string, tick_ms long, event string")
    pc = spark.createDataFrame([("3", 1, 0, 8000)], "node_id string, off long, t long, period_ms int")
    st = {r["node_id"]: r for r in W.twin_state(reg, df, pc, live).collect()}
    assert (st["2"]["parent"], st["2"]["hist_1"], st["2"]["hist_2"], st["2"]["hist_3"]) == ("c", "", "b", "b")
    assert st["1"]["parent"] == "x" and st["1"]["hist_1"] == "root"
    assert st["3"]["parent"] == "1" and st["3"]["period_ms"] == 8000 and st["3"]["crashed"] is True
    assert st["2"]["crashed"] is False and st["2"]["period_ms"] == 4000


def test_parent_changes_suppress_repeats(spark):
    obs = spark.createDataFrame([("1", 0, None), ("1", 1, "a"), ("1", 2, "a"), ("1", 3, "b"), ("1", 4, None),
                                 ("1", 5, "b"), ("1", 6, "a")], "node_id string, off long, parent string")
    got = [r["off"] for r in W.parent_changes(obs).orderBy("off").collect()]
    assert got == [1, 3, 6]


@pytest.mark.parametrize("seed", [31, 32, 33, 34])
def test_crashed_now_equals_last_liveness_event(spark, seed):
    # the flag is memoryless: the state after the last tick equals the last event's type
    rnd = random.Random(seed)
    act, per, t = [], [], 0
    for o in range(150):
        t += rnd.choice([0, 700, 2000, 5000, 9000, 15000])
        node = f"{rnd.randrange(4)}"
        if rnd.random() < 0.25:
            per.append((node, o, t, rnd.choice([0, 1000, 3000, 6000])))
        else:
            act.append((node, o, t))
    a = spark.createDataFrame(act, "node_id string, off long, t long")
    p = spark.createDataFrame(per, "node_id string, off long, t long, period_ms int")
    kw = dict(default_period_ms=4000, tick_ms=2000, multiplier=3)
    ev = W.liveness_events(a, p, **kw)
    last = {r["node_id"]: r["event"] == "crash" for r in
            ev.groupBy("node_id").agg(F.max_by("event", "tick_ms").alias("event")).collect()}
    now = {r["node_id"]: r["crashed"] for r in W.crashed_now(a, p, **kw).collect()}
    assert {n: now.get(n, False) for n in set(now) | set(last)} == {n: last.get(n, False) for n in set(now) | set(last)}


# ---- ring topology -----------------------------------------------------------------

@pytest.mark.parametrize("split", SPLITS)
def test_ring_roles_and_buckets(spark, split):
    from gridflow.operators import topology as T
    rows, want_ring, want_role = [], [], []
    rank = 0
    for district, size in enumerate(range(1, 11)):           # rings of 1 to 10 members
        members = list(range(rank, rank + size))
        rank += size
        for i, r in enumerate(members):
            v = (r * 37) % 101
            rows.append((district, 0, r, v))
            prev_v = (members[i - 1] * 37) % 101
            next_v = (members[(i + 1) % size] * 37) % 101
            want_ring.append((district, 0, r, v, prev_v, next_v))
            role = ("ACCUMULATOR" if i == size - 1 else "PRODUCER" if i < int(size * 0.6) else "CONSUMER")
            want_role.append((district, r, i, size, role))
    df = spark.createDataFrame(rows, "district long, step long, rank long, v100 long")
    ring = T.ring_neighbours(df, **split)
    assert rows_of(ring, ["district", "step", "rank", "v100", "prev_v100", "next_v100"]) == sort_rows(want_ring)
    role = T.rank_role(df, **split)
    assert rows_of(role, ["district", "rank", "district_rank", "size", "role"]) == sort_rows(want_role)
    b = {r["rank"]: (r["district"], r["district_rank"], r["incomplete"])
         for r in T.district_bucket(df, 4).collect()}
    n = len(rows)                                              # 55 ranks: the last district holds 3
    assert b[0] == (0, 0, False) and b[n - 1] == ((n - 1) // 4, (n - 1) % 4, True)


# ---- reports and windows: hand cases ---------------------------------------------------

NODE_EV = "off long, type string, node_id string, district_id string, node_type string, owner_id string, capacity double"


def test_reports_hand_cases(spark):
    from gridflow.operators import reports as P
    ev = spark.createDataFrame([
        (1, "NodeCreated", "a", "d1", "CONSUMER", "u1", 1.0),
        (2, "NodeCreated", "b", "d1", "PRODUCER", "u1", 1.0),     # b has no bills
        (3, "NodeCreated", "c", "d2", "CONSUMER", "u2", 1.0),
        (4, "NodeDeleted", "c", None, None, "u2", 0.0),            # c's bills drop out of the reports
        (5, "NodeCreated", "e", "d3", "CONSUMER", None, 1.0),      # null owner: in the summary, in no panel
        (6, "NodeCreated", "f", "d1", "CONSUMER", "u3", 1.0),
        (7, "NodeDeleted", "f", None, None, "u3", 0.0),
        (8, "NodeCreated", "f", "d4", "PRODUCER", "u4", 1.0)], NODE_EV)   # re-created: old bills shown
    nodes = R.nodes_current(ev)
    rd = [(i, "a", "CONSUMER", "dX", 100, 1000 * i) for i in range(10)]          # 2 bills
    rd += [(20 + i, "c", "CONSUMER", "dX", 100, 1000 * i) for i in range(5)]      # 1 bill, node deleted
    rd += [(40 + i, "f", "CONSUMER", "dX", 200, 1000 * i) for i in range(5)]      # 1 bill, node re-created
    bills = B.billing_windows(spark.createDataFrame(rd, READ_COLS))
    panel = rows_of(P.user_panel(nodes, bills).select("owner_id", "node_id", "history_no"),
                    ["owner_id", "node_id", "history_no"])
    assert panel == sort_rows([("u1", "a", 1), ("u1", "a", 2), ("u1", "b", None), ("u4", "f", 1)])
    summ = {r["district_id"]: r for r in P.district_summary(nodes, bills).collect()}
    # district comes from the current registry, not from the bills; counts not inflated by bills
    assert {d: r["nodes"] for d, r in summ.items()} == {"d1": 2, "d3": 1, "d4": 1}
    assert summ["d3"]["energy_kwh"] == 0.0 and summ["d3"]["cost"] == 0.0
    assert summ["d1"]["energy_kwh"] == pytest.approx((100 * 4000 + 100 * 5000) / 3.6e8)   # window 2 bills the gap 4 -> 5
    tot = {(r["owner_id"], r["node_id"]): r for r in P.user_total_cost(nodes, bills).collect()}
    assert tot[("u1", None)]["bills"] == 2 and tot[("u1", "b")]["bills"] == 0
    assert tot[("u4", None)]["cost"] == pytest.approx(200 * 4000 / 3.6e8 * 0.25)
    assert not any(k[0] is None for k in tot)


def test_sliding_balance_counts_node_ids_only(spark):
    from gridflow.operators import windows as Wn
    rows = [(0, "n1", "P", "d", 100, 60_000), (1, None, "P", "d", 50, 61_000), (2, "n2", "P", "d", -30, 90_000)]
    got = Wn.sliding_balance(spark.createDataFrame(rows, READ_COLS)).where("window_start_ms = 60000").first()
    assert got["num_measurements"] == 2 and got["total_balance_kw"] == pytest.approx(1.2)
    assert got["avg_balance_kw"] == pytest.approx(0.4)
    starts = sorted(r["window_start_ms"] for r in Wn.sliding_balance(spark.createDataFrame(rows[:1], READ_COLS)).collect())
    assert starts == [-30_000, 0, 30_000, 60_000]     # a reading on a slide boundary opens a window there


def test_billing_ten_readings_and_type_change(spark):
    rows = [(i, "x", "CONSUMER" if i < 7 else "PRODUCER", f"d{i // 3}", 100, 1000 * i) for i in range(10)]
    got = sorted((r["window_no"], r["node_type"], r["district_id"], r["energy_ckwms"])
                 for r in B.billing_windows(spark.createDataFrame(rows, READ_COLS)).collect())
    # the 5th / 10th reading decides type and district; the gap 4 -> 5 is billed in window 2
    assert got == [(0, "CONSUMER", "d1", 100 * 4000), (1, "PRODUCER", "d3", 100 * 5000)]


def test_several_lags_carry_over_splits(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.choice([None, rnd.randrange(9)])) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for split in ({}, {"rows_per_split": 1}, {"rows_per_split": 5}):
        got = ordered_scan(df, ["k"], "o", lags={"v": ["l1", "l2", "l3"]}, **split)
        by, want = {}, []
        for k, o, v in rows:
            past = by.setdefault(k, [])
            want.append((k, o, *(past[-i] if len(past) >= i else None for i in (1, 2, 3))))
            past.append(v)
        assert rows_of(got, ["k", "o", "l1", "l2", "l3"]) == sort_rows(want)


# ---- stored billing records -------------------------------------------------------

@pytest.mark.parametrize("split", SPLITS)
def test_reports_over_stored_records_equal_reports_over_readings(spark, split):
    from gridflow.operators import reports as P
    bills = B.billing_windows(spark.createDataFrame(random_readings(19, n=400, nodes=3), READ_COLS))
    other = spark.createDataFrame([("billing-records", 1, "n0", '{"type":"Other","nodeId":"n0","cost":1.0}')], "topic string, off long, key string, value string")
    stored = B.bills_of_records(B.billing_records(bills).unionByName(other), **split)
    cols = bills.columns
    assert rows_of(stored.select(*cols), cols) == rows_of(bills, cols)
    nodes = spark.createDataFrame([("n0", "d1", "CONSUMER", "u1", 1.0), ("n1", "d1", "PRODUCER", "u2", 1.0), ("n9", "d2", "PRODUCER", "u1", 1.0),
                                   ("n2", "d2", "PRODUCER", None, 1.0)], "node_id string, district_id string, node_type string, owner_id string, capacity double")
    for report in (P.user_panel, P.user_total_cost, P.district_summary):
        a, b = report(nodes, bills), report(nodes, stored)
        assert rows_of(a, a.columns) == rows_of(b, a.columns)
    panel = P.user_panel(nodes, stored)
    assert panel.where("node_id = 'n9' and history_no is null").count() == 1 and panel.where("node_id = 'n2'").count() == 0


def test_records_with_odd_amounts(spark):
    rows = [(1, '{"type":"UsageRecordCreated","nodeId":"a","totalEnergyKwh":1e300,"cost":0.25,"measurementCount":5}'),
            (2, '{"type":"UsageRecordCreated","nodeId":"a","cost":-0.5,"measurementCount":5}'), (3, "junk"), (4, None),
            (5, '{"type":"UsageRecordCreated","totalEnergyKwh":2.5,"cost":0.1}')]
    got = B.node_billing_totals(B.bills_of_records(spark.createDataFrame(rows, "off long, value string")))
    assert {(r.node_id, r.bills, r.total_energy_kwh, r.total_cost) for r in got.collect()} == {("a", 2, 0.0, -0.25), (None, 1, 2.5, 0.1)}


def test_broadcast_is_bounded_in_rows_and_bytes(spark):
    from gridflow.plans.joins import checked_broadcast
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().logical().toString() or "hint" in df._jdf.queryExecution().logical().toString().lower()
    dim = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit("y")).alias("a"))
    assert hint(checked_broadcast(dim)) and not hint(checked_broadcast(dim, max_rows=99)) and not hint(checked_broadcast(dim, max_bytes=90_000))
    assert hint(checked_broadcast(dim.where("false")))
