"""One micro-batch of a continuous operator as native DataFrame work.

Each step takes a micro-batch's rows and the keyed state before it, and returns what it emits and the
changed state. The order of arrival within the batch is restored by the ordered scans of the batch
operators, which split hot keys over tasks; state is one row per key in a ``KeyedTable``. A key with a
third of all rows is therefore never one task's group, and none of it runs in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.functions.expr import cost_from_energy, kwh, tariff_hundredths
from gridflow.operators import registry as R
from gridflow.operators.twin import initial_parent, newest_parents
from gridflow.plans.ordered import ordered_scan
from gridflow.session import checkpoint_dir


def _materialised(df: DataFrame) -> DataFrame:
    """Written once to the shared checkpoint folder: emitted rows and state both come from it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _with_state(rows: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Left join of the state by ``key``; its other columns get the prefix ``s_``."""
    s = state.select(F.col(key).alias("_k"), *[F.col(c).alias(f"s_{c}") for c in state.columns if c != key])
    return rows.join(s, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")


# ---- billing -------------------------------------------------------------------------

BILL_STATE = "node_id string, last_t long, k long, energy decimal(38,6), start_t long, bills long"


def billing_step(readings: DataFrame, state: DataFrame, size: int = C.BILLING_WINDOW_SIZE, **split) -> tuple[DataFrame, DataFrame]:
    """Bills that the batch's readings close, and per node of the batch the window left open: its ``k``
    readings, their energy and first time, the last reading's time and the bills so far."""
    e = ordered_scan(readings.select("off", "node_id", "node_type", "district_id", "v100", "t"), ["node_id"], "off",
                     position="pos", lags={"t": "prev_t"}, **split)
    power = dict(readings.dtypes)["v100"]
    state = state.withColumn("energy", F.col("energy").cast("decimal(38,6)" if power.startswith("decimal") else "long"))
    e = _with_state(e, state, "node_id")
    at = F.coalesce("s_k", F.lit(0)) + F.col("pos") - 1
    dt = F.greatest(F.coalesce(F.col("t") - F.coalesce("prev_t", "s_last_t"), F.lit(0)), F.lit(0))
    e = e.withColumn("win", F.floor(at / size).cast("long")).withColumn("energy", F.abs("v100") * dt)
    kept = {c: F.max(f"s_{c}").alias(f"s_{c}") for c in ("k", "energy", "start_t", "bills")}  # one value a node
    g = e.groupBy("node_id", "win").agg(
        F.count(F.lit(1)).alias("n"), F.sum("energy").alias("energy"), F.min_by("t", "pos").alias("start_t"),
        F.max_by(F.struct("node_type", "district_id", "t", "off"), "pos").alias("last"), *kept.values())
    open_ = (F.col("win") == 0) & (F.coalesce("s_k", F.lit(0)) > 0)  # the window that an earlier batch began
    g = _materialised(g.select(
        "node_id", (F.coalesce("s_bills", F.lit(0)) + F.col("win")).alias("window_no"),
        (F.col("n") + F.when(open_, F.col("s_k")).otherwise(0)).alias("n"),
        (F.col("energy") + F.when(open_, F.col("s_energy")).otherwise(0)).alias("energy"),
        F.when(open_, F.col("s_start_t")).otherwise(F.col("start_t")).alias("start_t"), "last.*"))
    bills = g.where(F.col("n") == size).select(
        "off", "node_id", "window_no", "node_type", "district_id", F.col("energy").alias("energy_ckwms"),
        kwh(F.col("energy")).alias("total_energy_kwh"), (F.col("energy") * tariff_hundredths(F.col("node_type"))).alias("cost_num"),
        cost_from_energy(F.col("energy"), F.col("node_type")).alias("cost"), F.col("n").cast("int").alias("measurement_count"),
        F.col("start_t").alias("period_start"), F.col("t").alias("period_end"))
    end = g.groupBy("node_id").agg(F.max_by(F.struct("n", "energy", "start_t", "t", "window_no"), "window_no").alias("w"))
    full = F.col("w.n") == size
    zero = lambda c, kind="long": F.when(full, F.lit(0)).otherwise(F.col(c)).cast(kind)
    after = end.select("node_id", F.col("w.t").alias("last_t"), zero("w.n").alias("k"), zero("w.energy", "decimal(38,6)").alias("energy"),
                       zero("w.start_t").alias("start_t"), (F.col("w.window_no") + full.cast("long")).alias("bills"))
    return bills, after


# ---- district charge -----------------------------------------------------------------

CHARGE_STATE = "district_id string, last_t long, charge decimal(38,6), batch_balance_kw double, num_measurements long"


def charge_step(readings: DataFrame, state: DataFrame) -> DataFrame:
    """Per district of the batch: its summed power and count, and the accumulated charge integrated over the
    time since the last batch's latest event time (clamped at 0). Late rows count; the clock never goes
    back. Emitted rows and state are the same."""
    r = readings.where("district_id is not null and v100 is not null and t is not null")
    g = r.groupBy("district_id").agg(F.sum("v100").alias("bal"), F.count(F.lit(1)).alias("n"), F.max("t").alias("mx"))
    g = _with_state(g, state.select("district_id", "last_t", "charge"), "district_id")
    last = F.coalesce("s_last_t", F.lit(-1).cast("long"))
    now = F.greatest("mx", last)
    more = F.when((last > 0) & (now > last), (F.col("bal").cast("decimal(28,6)") * (now - last).cast("decimal(20,0)")).cast("decimal(38,6)")).otherwise(0)
    had = F.coalesce("s_charge", F.lit(0).cast("decimal(38,6)"))
    charge = F.when(last > 0, F.greatest(F.lit(0).cast("decimal(38,6)"), (had + more).cast("decimal(38,6)"))).otherwise(had)
    return _materialised(g.select("district_id", now.alias("last_t"), charge.cast("decimal(38,6)").alias("charge"),
                                  (F.col("bal") / F.lit(100.0)).alias("batch_balance_kw"), F.col("n").alias("num_measurements")))


def charge_rows(state: DataFrame) -> DataFrame:
    return state.select("district_id", "batch_balance_kw", "num_measurements", F.col("last_t").alias("max_event_ms"),
                        kwh(F.col("charge").cast("double")).alias("charge_kwh"))


# ---- node commands -------------------------------------------------------------------

USER_STATE = "user_id string, valid boolean"
OWNER_STATE = "node_id string, owner string"


def command_step(user_events: DataFrame, commands: DataFrame, users: DataFrame, owners: DataFrame,
                 **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions on the batch's node commands; changed users (registered or not); changed owners (``gone``
    where the node was deleted). Only the state of users and nodes of the batch enters the scans."""
    commands = commands.select("off", "node_id", "user_id", "op", "node_type")
    acting = commands.select(F.col("user_id").alias("_k")).distinct()
    before = users.where("valid").join(acting, F.col("user_id").eqNullSafe(F.col("_k")), "left_semi")
    events = user_events.select("off", "type", "user_id").unionByName(
        before.select(F.lit(-1).cast("long").alias("off"), F.lit("UserRegistered").alias("type"), "user_id"))
    named = commands.select(F.col("node_id").alias("_k")).distinct()
    held = owners.join(named, F.col("node_id").eqNullSafe(F.col("_k")), "left_semi")
    decided = _materialised(R.node_commands(events, commands, owners=held, **options))
    moved = R.owners_after(decided).select("node_id", "owner", (~F.col("has")).alias("gone"))
    last = user_events.where(F.col("type").isin(*C.USER_EVENT_TYPES)).groupBy("user_id").agg(F.max_by("type", "off").alias("type"))
    return decided, last.select("user_id", (F.col("type") != "UserDeleted").alias("valid")), moved


# ---- device twin ---------------------------------------------------------------------

TWIN_STATE = "node_id string, parent string, hist_1 string, hist_2 string, hist_3 string, period_ms long, crashed boolean"


def twin_step(events: DataFrame, state: DataFrame, registry: DataFrame,
              default_period_ms: int = C.DEFAULT_PERIOD_MS) -> DataFrame:
    """Twins that the batch's events change: the newest parents go before the known ones, the period and
    the crash flag are the latest. ``events``: node_id, kind (parent | period | crash | recovered), ord
    (arrival position, or tick time), value. Events for nodes without a twin are not delivered."""
    e = _materialised(events.join(registry.select("node_id"), "node_id", "left_semi"))  # read for both sides of the join below
    depth = C.PARENT_HISTORY_DEPTH + 1
    kind = F.col("kind")
    rest = e.groupBy("node_id").agg(
        F.max_by(F.col("value").cast("long"), F.when(kind == "period", F.col("ord"))).alias("_period"),
        F.max_by(kind == "crash", F.when(kind.isin("crash", "recovered"), F.col("ord"))).alias("_crashed"))
    new = newest_parents(e.where(kind == "parent").select("node_id", F.col("ord").alias("off"), F.col("value").alias("parent")), depth)
    j = _with_state(rest.join(new, "node_id", "left"), state, "node_id")
    before = F.when(F.col("s_period_ms").isNotNull(), F.array("s_parent", "s_hist_1", "s_hist_2", "s_hist_3")).otherwise(
        F.array(initial_parent(F.col("node_id"))))
    line = F.concat(F.coalesce("newest", F.array().cast("array<string>")), before)
    return _materialised(j.select(
        "node_id", *[F.get(line, F.lit(i)).alias(n) for i, n in enumerate(["parent", "hist_1", "hist_2", "hist_3"])],
        F.coalesce("_period", "s_period_ms", F.lit(default_period_ms)).cast("long").alias("period_ms"),
        F.coalesce("_crashed", "s_crashed", F.lit(False)).alias("crashed")))


# ---- sliding windows and late rows ----------------------------------------------------

SLIDE_STATE = "district_id string, window_start_ms long, sum_v100 decimal(38,6), n_values long, n_nodes long"
CLOCK_STATE = "id int, t long"


def late_step(readings: DataFrame, latest: int | None, delay_ms: int, duration_ms: int, slide_ms: int) -> DataFrame:
    """Adds ``late``: had all windows of the reading ended at or before the watermark, which is ``delay_ms`` behind
    ``latest``, the largest event time of earlier batches?"""
    if latest is None:
        return readings.withColumn("late", F.lit(False))
    end = (F.floor(F.col("t") / slide_ms) * slide_ms + duration_ms).cast("long")
    return readings.withColumn("late", F.coalesce(end <= F.lit(latest - delay_ms), F.lit(False)))


def slide_step(readings: DataFrame, state: DataFrame, duration_ms: int, slide_ms: int) -> DataFrame:
    """Sliding windows that the batch's readings change: their sums and counts so far."""
    r = readings.where("district_id is not null and v100 is not null and t is not null")
    first = F.floor(F.col("t") / slide_ms) * slide_ms
    starts = F.transform(F.sequence(F.lit(0), F.lit(-(-duration_ms // slide_ms) - 1)), lambda i: (first - i * slide_ms).cast("long"))
    w = r.select("district_id", "node_id", "v100", "t", F.explode(starts).alias("window_start_ms")).where(F.col("window_start_ms") + duration_ms > F.col("t"))
    g = w.groupBy("district_id", "window_start_ms").agg(
        F.sum(F.col("v100").cast("decimal(28,6)")).alias("a"), F.count("v100").alias("b"), F.count("node_id").alias("c"))
    s = state.select(F.col("district_id").alias("_d"), F.col("window_start_ms").alias("_w"), "sum_v100", "n_values", "n_nodes")
    j = g.join(s, (F.col("district_id") == F.col("_d")) & (F.col("window_start_ms") == F.col("_w")), "left")
    plus = lambda x, y: F.col(x) + F.coalesce(F.col(y), F.lit(0))
    return j.select("district_id", "window_start_ms", plus("a", "sum_v100").cast("decimal(38,6)").alias("sum_v100"),
                    plus("b", "n_values").alias("n_values"), plus("c", "n_nodes").alias("n_nodes"))
