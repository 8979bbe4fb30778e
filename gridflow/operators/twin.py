"""Device twin: address resolution, liveness, parent history and twin state.

Activity is the parent and app messages of a node; a node is known from its
first activity on. Liveness is evaluated on a fixed tick grid (multiples of
``tick_ms``): at each tick a known node is "bad" when ``now - last_seen >
multiplier * period``; crash / recovered events are the changes of that flag,
starting from "not crashed".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.functions.expr import js_parse_int
from gridflow.plans.joins import checked_broadcast
from gridflow.plans.ordered import find_hot_keys, ordered_scan


# ---- addresses, registry, dispatch ------------------------------------------

def address_index(addresses: DataFrame) -> DataFrame:
    """lower(address) -> node id, first entry in file order wins."""
    return (addresses.where(F.col("ipv6").isNotNull())
                     .groupBy(F.lower("ipv6").alias("addr_lc"))
                     .agg(F.min_by("node_id", "pos").alias("resolved_id")))


def parent_resolve(parsed_lines: DataFrame, addresses: DataFrame) -> DataFrame:
    """Parent addresses -> node ids (case-insensitive); unresolved addresses pass
    through raw. Returns the published messages (off, seq, topic, payload)."""
    idx = checked_broadcast(address_index(addresses))
    j = parsed_lines.join(idx, (F.col("kind") == "parent") & (F.lower(F.col("value")) == F.col("addr_lc")), "left")
    payload = F.when(F.col("kind") == "parent", F.coalesce(F.col("resolved_id"), F.col("value"))).otherwise(F.col("value"))
    return j.select("off", "t", "node_id", "seq", "kind", "topic", payload.alias("payload"))


def twin_registry(spark, num_nodes: int, remote: bool = False) -> DataFrame:
    """Twin nodes 1..num_nodes; with a remote host the upper half lives there."""
    local_upto = (num_nodes + 1) // 2 if remote else num_nodes
    r = spark.range(1, num_nodes + 1)
    return r.select(F.col("id").cast("string").alias("node_id"),
                    F.when(F.col("id") <= local_upto, F.lit("local")).otherwise(F.lit("remote")).alias("location"))


def twin_status(registry: DataFrame) -> DataFrame:
    """Active twins: local ones then remote ones, tagged with their location."""
    loc = registry.where(F.col("location") == "local").select("node_id", F.lit("local").alias("location"))
    rem = registry.where(F.col("location") == "remote").select("node_id", F.lit("remote").alias("location"))
    return loc.unionAll(rem)


def twin_dispatch(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Deliver by node id: 200 for a known twin, 404 otherwise."""
    reg = checked_broadcast(registry.select("node_id", F.lit(True).alias("_known")))
    j = events.join(reg, "node_id", "left")
    return j.withColumn("status", F.when(F.col("_known"), F.lit(200)).otherwise(F.lit(404))).drop("_known")


def app_messages(parsed_messages: DataFrame) -> DataFrame:
    """App messages go to the root twin; they change no state."""
    m = parsed_messages.where(F.col("kind") == "msg")
    return m.select("off", F.lit(C.ROOT_NODE_ID).alias("target_node"), F.col("node_id").alias("from_node_id"),
                    js_parse_int(F.col("payload")).alias("seq_num"))


def last_seen(activity: DataFrame) -> DataFrame:
    """Known nodes with first and latest activity time and activity count."""
    return activity.groupBy("node_id").agg(F.min("t").alias("first_seen_ms"), F.max("t").alias("last_seen_ms"),
                                           F.count(F.lit(1)).alias("messages"))


# ---- parents ------------------------------------------------------------------

def initial_parent(node_id: F.Column) -> F.Column:
    return F.when(node_id == C.ROOT_NODE_ID, F.lit(C.ROOT_START_PARENT)).otherwise(F.lit(C.ROOT_NODE_ID))


def parent_history(updates: DataFrame, depth: int = C.PARENT_HISTORY_DEPTH, **split) -> DataFrame:
    """After each parent update: the new parent and the ``depth`` previous ones,
    newest first (``hist_1`` ..), seeded with the node's initial parent.

    One ordered scan brings all previous parents (a hot node is split across tasks and its splits carry their
    last ``depth`` values); the initial parent stands before a node's first update.
    """
    names = [f"hist_{k}" for k in range(1, depth + 1)]
    u = ordered_scan(updates.select("node_id", "off", "parent"), ["node_id"], "off", position="_pos", lags={"parent": names}, **split)
    first = initial_parent(F.col("node_id"))
    return u.select("node_id", "off", "parent", *[F.when(F.col("_pos") == k, first).otherwise(F.col(n)).alias(n) for k, n in enumerate(names, 1)])


def parent_changes(observations: DataFrame, **split) -> DataFrame:
    """Device side: report a parent only when it differs from the last reported
    one; the first non-null observation always reports."""
    o = observations.where(F.col("parent").isNotNull())
    s = ordered_scan(o, ["node_id"], "off", lags={"parent": "_prev"}, **split)
    return s.where(~F.col("parent").eqNullSafe(F.col("_prev"))).drop("_prev")


TOPK_SALTS = 1024   # fixed fan-out of the partial top-k; bounds its output to k rows per (node, salt)


def newest_parents(updates: DataFrame, k: int) -> DataFrame:
    """(node_id, newest): each node's last ``k`` parents, newest first.

    Two-phase top-k: rows are first ranked within (node, off mod TOPK_SALTS), keeping k per group, then
    the survivors (at most k x salts per node) are ranked per node. A hot node is spread over many
    tasks and no detection job is needed.
    """
    u = updates.select("node_id", "off", "parent")
    w1 = Window.partitionBy("node_id", F.pmod(F.col("off"), F.lit(TOPK_SALTS))).orderBy(F.desc("off"))
    part = u.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r")
    w = Window.partitionBy("node_id").orderBy(F.desc("off"))
    top = part.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    line = F.sort_array(F.collect_list(F.struct("_r", "parent")))
    return top.groupBy("node_id").agg(F.transform(line, lambda x: x["parent"]).alias("newest"))


def latest_parents(updates: DataFrame, depth: int = C.PARENT_HISTORY_DEPTH) -> DataFrame:
    """Current parent and history per node with at least one update: the newest depth+1 entries of
    [initial parent, updates...]."""
    line = F.concat("newest", F.array(initial_parent(F.col("node_id"))))
    return newest_parents(updates, depth + 1).select(
        "node_id", F.get("newest", F.lit(0)).alias("parent"), *[F.get(line, F.lit(i)).alias(f"hist_{i}") for i in range(1, depth + 1)])


def crashed_now(activity: DataFrame, period_changes: DataFrame, *,
                default_period_ms: int = C.DEFAULT_PERIOD_MS, tick_ms: int = C.HEARTBEAT_TICK_MS,
                multiplier: int = C.HEARTBEAT_MULTIPLIER, horizon_ms=None) -> DataFrame:
    """Crash flag per known node after the last tick up to the horizon.

    The flag after a tick depends only on that tick (``now - last_seen >
    multiplier * period``), so the state after the last tick is two partial
    aggregates (latest activity, latest period change as of that tick) -- the
    same as the type of the node's last crash / recovered event.
    """
    if horizon_ms is None:   # one scalar job; used three times below as a literal
        rows_t = activity.select("t").unionByName(period_changes.select("t"))
        horizon_ms = rows_t.agg(F.max("t").alias("h")).first()["h"]
    if horizon_ms is None:   # no input at all
        horizon_ms = 0
    last_tick = F.lit((int(horizon_ms) // tick_ms) * tick_ms)
    seen = (activity.where(F.col("t") <= last_tick).groupBy("node_id")
                    .agg(F.max("t").alias("last_seen_ms")))
    per = (period_changes.where(F.col("t") <= last_tick).groupBy("node_id")
                         .agg(F.max_by("period_ms", F.struct("t", "off")).alias("_p")))
    j = seen.join(per, "node_id", "left")
    period = F.coalesce(F.when(F.col("_p") != 0, F.col("_p")), F.lit(default_period_ms)).cast("long")
    return j.select("node_id", "last_seen_ms", period.alias("period_ms"),
                    ((last_tick - F.col("last_seen_ms")) > period * multiplier).alias("crashed"))


# ---- liveness -----------------------------------------------------------------

def liveness_events(activity: DataFrame, period_changes: DataFrame, *,
                    default_period_ms: int = C.DEFAULT_PERIOD_MS, tick_ms: int = C.HEARTBEAT_TICK_MS,
                    multiplier: int = C.HEARTBEAT_MULTIPLIER, horizon_ms=None, **split) -> DataFrame:
    """Crash / recovered events per node on the tick grid, up to ``horizon_ms``
    (default: the latest input time).

    Segment form, O(events): between consecutive inputs of a node, last-seen and
    period are constant, so the flag is false then true at most once; each
    segment yields its first tick and, if inside, the first bad tick. The
    changes of the flag over these candidates are the events.
    """
    act = activity.select("node_id", "off", "t", F.lit(0).alias("kind"), F.col("t").alias("_seen"),
                          F.lit(None).cast("long").alias("_per"))
    per = period_changes.select("node_id", "off", "t", F.lit(1).alias("kind"),
                                F.lit(None).cast("long").alias("_seen"), F.col("period_ms").cast("long").alias("_per"))
    rows = act.unionByName(per)
    if horizon_ms is None:   # one scalar job, then a literal in the plan
        horizon_ms = rows.agg(F.max("t").alias("h")).first()["h"] or 0
    horizon = F.lit(int(horizon_ms))
    # candidates are at most two per input row and keyed the same way: one hot-key check serves both scans
    hot = find_hot_keys(rows, ["node_id"], "t", split.get("rows_per_split"))
    s = ordered_scan(rows, ["node_id"], ["t", "kind", "off"], leads={"t": "_next_t"},
                     fills={"_seen": "last_seen", "_per": "_p"}, hot=hot, **split)
    period = F.coalesce(F.when(F.col("_p") != 0, F.col("_p")), F.lit(default_period_ms))
    seg = (s.where(F.col("last_seen").isNotNull())
            .withColumn("period_ms", period)
            .withColumn("_end", F.coalesce(F.col("_next_t"), horizon + 1))
            .withColumn("_t0", F.ceil(F.col("t") / F.lit(tick_ms)).cast("long") * tick_ms)
            .withColumn("_tc", (F.floor((F.col("last_seen") + F.col("period_ms") * multiplier) / F.lit(tick_ms))
                                .cast("long") + 1) * tick_ms)
            .where(F.col("_t0") < F.col("_end")))
    bad0 = (F.col("_t0") - F.col("last_seen")) > F.col("period_ms") * multiplier
    cands = F.filter(F.array(
        F.struct(F.col("_t0").alias("tick_ms"), bad0.alias("bad")),
        F.struct(F.when((F.col("_tc") > F.col("_t0")) & (F.col("_tc") < F.col("_end")), F.col("_tc"))
                  .alias("tick_ms"), F.lit(True).alias("bad"))), lambda c: c["tick_ms"].isNotNull())
    c = seg.select("node_id", "last_seen", "period_ms", F.explode(cands).alias("c")).select(
        "node_id", F.col("c.tick_ms").alias("tick_ms"), F.col("c.bad").alias("bad"), "last_seen", "period_ms")
    flips = ordered_scan(c, ["node_id"], "tick_ms", lags={"bad": "_prev_bad"}, hot=hot, **split)
    ev = flips.where(F.col("bad") != F.coalesce(F.col("_prev_bad"), F.lit(False)))
    return ev.select("node_id", "tick_ms",
                     F.when(F.col("bad"), F.lit("crash")).otherwise(F.lit("recovered")).alias("event"),
                     F.col("last_seen").alias("last_seen_ms"), "period_ms")


def twin_state(registry: DataFrame, parent_updates: DataFrame, period_changes: DataFrame,
               liveness: DataFrame | None = None, *, activity: DataFrame | None = None,
               default_period_ms: int = C.DEFAULT_PERIOD_MS, depth: int = C.PARENT_HISTORY_DEPTH,
               liveness_period_ms: int | None = None, tick_ms: int = C.HEARTBEAT_TICK_MS,
               multiplier: int = C.HEARTBEAT_MULTIPLIER, horizon_ms=None) -> DataFrame:
    """Per twin: parent, previous parents (newest first), period, crashed.

    Messages for nodes without a twin are not delivered. Parent and history are
    a bounded top-(depth+1); the period is the latest change (max_by, partial-
    aggregated). ``crashed`` is the latest crash / recovered event of
    ``liveness`` when given, else the flag computed from ``activity`` by
    ``crashed_now`` (equal, without materialising the events). A crash does
    not block other updates.
    """
    # per-node aggregates over all inputs; the left joins from the registry deliver
    # only to existing twins (no separate semi joins needed)
    nodes = registry.select("node_id")
    parents = latest_parents(parent_updates, depth)
    per = period_changes.groupBy("node_id").agg(F.max_by("period_ms", "off").alias("period_ms"))
    if liveness is not None:
        crash = liveness.groupBy("node_id").agg(F.max_by(F.col("event") == "crash", "tick_ms").alias("crashed"))
    else:
        crash = crashed_now(activity, period_changes, tick_ms=tick_ms, multiplier=multiplier,
                            default_period_ms=liveness_period_ms or default_period_ms,
                            horizon_ms=horizon_ms).select("node_id", "crashed")
    out = nodes.join(parents, "node_id", "left").join(per, "node_id", "left").join(crash, "node_id", "left")
    cols = [F.coalesce(F.col("parent"), initial_parent(F.col("node_id"))).alias("parent")]
    cols += [F.col(f"hist_{i}") for i in range(1, depth + 1)]
    return out.select("node_id", *cols,
                      F.coalesce(F.col("period_ms"), F.lit(default_period_ms)).alias("period_ms"),
                      F.coalesce(F.col("crashed"), F.lit(False)).alias("crashed"))
