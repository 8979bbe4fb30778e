"""Event-sourced registries, as-of lookups and command validation.

Logs carry ``off`` (arrival position). Registries are rebuilt by keeping the
latest event per key (tombstones remove); as-of lookups union the registry log
with the rows that use it and carry the last registry state forward in arrival
order (registry rows first at equal positions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.functions.expr import is_valid_node_type
from gridflow.plans.joins import checked_broadcast
from gridflow.plans.ordered import ordered_scan
from gridflow.session import checkpoint_dir


def _latest(log: DataFrame, key: str, types: tuple[str, ...], fields: list[str]) -> DataFrame:
    """Latest known-type event per key; keys whose latest event is a delete are dropped.

    max_by is partial-aggregable, so a hot key is pre-reduced map-side."""
    known = log.where(F.col("type").isin(*types))
    g = known.groupBy(key).agg(F.max_by(F.struct("type", *fields), "off").alias("s"))
    return (g.where(F.col("s.type") != types[2])
             .select(key, *[F.col(f"s.{f}").alias(f) for f in fields]))


def users_current(user_events: DataFrame) -> DataFrame:
    """Current users (user_id, name, email)."""
    return _latest(user_events, "user_id", C.USER_EVENT_TYPES, ["name", "email"])


def nodes_current(node_events: DataFrame) -> DataFrame:
    """Current nodes (node_id, district_id, node_type, owner_id, capacity)."""
    return _latest(node_events, "node_id", C.NODE_EVENT_TYPES,
                   ["district_id", "node_type", "owner_id", "capacity"])


def valid_users(user_events: DataFrame) -> DataFrame:
    """Ids of users that may act: registered or updated, and not deleted since."""
    return users_current(user_events).select("user_id")


def nodes_of_owner(nodes: DataFrame, user_id: str) -> DataFrame:
    """Current nodes owned by ``user_id`` (a null owner never matches)."""
    return nodes.where(F.col("owner_id") == F.lit(user_id))


def node_type_check(node_commands: DataFrame) -> DataFrame:
    """Flag whether each command names one of the three node types."""
    return node_commands.select("off", "node_id", "node_type",
                                is_valid_node_type(F.col("node_type")).alias("valid_type"))


def account_commands(commands: DataFrame, **split) -> DataFrame:
    """Validate register / update / delete against the user's existence.

    A user exists after a register (accepted or not) and not after a delete, so
    existence before a command is the last register/delete before it.
    """
    st = F.when(F.col("op") == "register", F.lit(True)).when(F.col("op") == "delete", F.lit(False))
    s = ordered_scan(commands.withColumn("_st", st), ["user_id"], "off",
                     fills_before={"_st": "_exists"}, **split)
    ex = F.coalesce(F.col("_exists"), F.lit(False))
    op = F.col("op")
    accepted = (F.when(op == "register", ~ex).when(op.isin("update", "delete"), ex).otherwise(F.lit(False)))
    reason = (F.when(~op.isin("register", "update", "delete"), F.lit("unknown command"))
               .when((op == "register") & ex, F.lit("user already exists"))
               .when(op.isin("update", "delete") & ~ex, F.lit("user does not exist")))
    event = (F.when(accepted & (op == "register"), F.lit("UserRegistered"))
              .when(accepted & (op == "update"), F.lit("UserUpdated"))
              .when(accepted & (op == "delete"), F.lit("UserDeleted")))
    fields = [c for c in ("name", "email", "t") if c in commands.columns]
    return s.select("off", "user_id", "op", accepted.alias("accepted"), reason.alias("reason"),
                    event.alias("event_type"), *fields)


def accepted_user_events(validated: DataFrame) -> DataFrame:
    """The events that accepted account commands publish, in the user-events log's shape; a delete
    carries the user only."""
    gone = F.col("event_type") == "UserDeleted"
    return validated.where("accepted").select(
        "off", F.col("event_type").alias("type"), "user_id", F.when(~gone, F.col("name")).alias("name"),
        F.when(~gone, F.col("email")).alias("email"), F.col("t").alias("timestamp"))


def _asof(registry: DataFrame, rows: DataFrame, key: str, state: F.Column, state_name: str,
          **split) -> DataFrame:
    """Carry the last non-null registry ``state`` onto each of ``rows``
    (registry rows first at equal ``off``). One union, one ordered pass: the
    rows keep all their columns, so nothing is joined back."""
    reg = registry.select(key, (F.col("off") * 2).alias("_ord"), state.alias("_state"))
    use = (rows.withColumn("_ord", F.col("off") * 2 + 1)
               .withColumn("_state", F.lit(None).cast(reg.schema["_state"].dataType)))
    both = reg.unionByName(use, allowMissingColumns=True)
    s = ordered_scan(both, [key], "_ord", fills={"_state": state_name}, **split)
    return s.where(F.col("_ord") % 2 == 1).drop("_ord", "_state")


def user_valid_asof(user_events: DataFrame, rows: DataFrame, **split) -> DataFrame:
    """Add ``user_valid``: was ``user_id`` registered (or updated) and not deleted
    before each row of ``rows``?"""
    t = F.col("type")
    state = F.when(t.isin("UserRegistered", "UserUpdated"), F.lit(True)).when(t == "UserDeleted", F.lit(False))
    out = _asof(user_events, rows, "user_id", state, "user_valid", **split)
    return out.withColumn("user_valid", F.coalesce(F.col("user_valid"), F.lit(False)))


def _registry_state(node_events: DataFrame) -> F.Column:
    t = F.col("type")
    return (F.when(t.isin("NodeCreated", "NodeUpdated"),
                   F.struct(F.lit(True).alias("present"), F.col("district_id"), F.col("node_type")))
             .when(t == "NodeDeleted",
                   F.struct(F.lit(False).alias("present"), F.lit(None).cast("string").alias("district_id"),
                            F.lit(None).cast("string").alias("node_type"))))


def _enrich_all(node_events: DataFrame, readings: DataFrame, **split) -> DataFrame:
    r = readings.drop("district_id", "node_type")
    return _asof(node_events, r, "node_id", _registry_state(node_events), "_reg", **split)


def measurement_enrich(node_events: DataFrame, readings: DataFrame, **split) -> DataFrame:
    """Readings of nodes that exist at the reading, with the registry's district and type."""
    a = _enrich_all(node_events, readings, **split)
    return (a.where(F.col("_reg.present"))
             .withColumn("district_id", F.col("_reg.district_id"))
             .withColumn("node_type", F.col("_reg.node_type")).drop("_reg"))


def measurement_reject(node_events: DataFrame, readings: DataFrame, **split) -> DataFrame:
    """Readings of nodes unknown (or deleted) at the reading, with the reason."""
    a = _enrich_all(node_events, readings, **split)
    return (a.where(~F.coalesce(F.col("_reg.present"), F.lit(False)))
             .withColumn("reason", F.when(F.col("_reg").isNull(), F.lit("unknown node"))
                                    .otherwise(F.lit("deleted node"))).drop("_reg"))


def measurement_route(node_events: DataFrame, readings: DataFrame, **split) -> DataFrame:
    """Both sides in one pass: ``accepted`` plus registry district/type or reason."""
    a = _enrich_all(node_events, readings, **split)
    ok = F.coalesce(F.col("_reg.present"), F.lit(False))
    return (a.withColumn("accepted", ok)
             .withColumn("district_id", F.col("_reg.district_id"))
             .withColumn("node_type", F.col("_reg.node_type"))
             .withColumn("reason", F.when(ok, F.lit(None).cast("string"))
                                    .when(F.col("_reg").isNull(), F.lit("unknown node"))
                                    .otherwise(F.lit("deleted node"))).drop("_reg"))


# ---------------------------------------------------------------------------
# node commands: who owns a node before each command
# ---------------------------------------------------------------------------

# nodes with at most so many commands are folded in one array expression each
FOLD_ROWS = 1024


def _moves(op, valid, valid_type, user, has, owner):
    """Does the command make a node without an owner owned, or an owned one free?"""
    valid = F.coalesce(valid, F.lit(False))
    return valid & (op == "create") & valid_type & ~has, valid & (op == "delete") & has & owner.eqNullSafe(user)


def _folded(commands: DataFrame) -> DataFrame:
    """Adds ``before`` (has, owner), the node's state before each command, by a fold over the array of the
    node's commands in arrival order."""
    cols = ["off", "user_id", "op", "user_valid", "valid_type"]
    rows = commands.groupBy("node_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("_rows"))
    state = lambda has, owner: F.struct(has.alias("has"), owner.alias("owner"))
    nobody = state(F.lit(False), F.lit(None).cast("string"))

    def step(acc, r):
        now = acc["now"]
        takes, frees = _moves(r["op"], r["user_valid"], r["valid_type"], r["user_id"], now["has"], now["owner"])
        after = F.when(takes, state(F.lit(True), r["user_id"])).when(frees, nobody).otherwise(now)
        return F.struct(after.alias("now"), F.concat(acc["seen"], F.array(now)).alias("seen"))

    start = F.struct(nobody.alias("now"), F.array().cast("array<struct<has:boolean,owner:string>>").alias("seen"))
    seen = F.aggregate("_rows", start, step, lambda acc: acc["seen"])
    out = rows.select("node_id", F.explode(F.arrays_zip(F.col("_rows").alias("r"), seen.alias("b"))).alias("x"))
    return out.select("node_id", *[F.col(f"x.r.{c}").alias(c) for c in cols], F.col("x.b").alias("before"))


def _same(a: str, b: str, *more: tuple[str, str]) -> F.Column:
    out = F.col(a).eqNullSafe(F.col(b))
    for x, y in more:
        out = out & (F.col(x) == F.col(y))
    return out


def _reached(jumps: DataFrame, first: DataFrame) -> DataFrame:
    """Rows (node_id, off) on the chain that starts at ``first`` and goes from ``off`` to ``jump``.

    Jumps are doubled: round k adds what lies 2^k steps behind what is known, so the rounds are the
    logarithm of the longest chain, and nodes whose chain is known drop out. Keys are (node, position),
    so one node's chain is spread over all tasks."""
    reached, jumps = first.checkpoint(), jumps.where("jump is not null").checkpoint()
    while True:
        at = reached.select(F.col("node_id").alias("_n"), F.col("off").alias("_o"))
        new = jumps.join(at, _same("node_id", "_n", ("off", "_o"))).select("node_id", F.col("jump").alias("off")).checkpoint()
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        on = jumps.select(F.col("node_id").alias("_n"), F.col("off").alias("_o"), F.col("jump").alias("further"))
        jumps = jumps.join(on, _same("node_id", "_n", ("jump", "_o"))).select(
            "node_id", "off", F.col("further").alias("jump")).checkpoint()


def _chained(commands: DataFrame, **split) -> DataFrame:
    """Adds ``before`` as ``_folded`` does, for nodes of any size.

    A command that can change a node is an acceptable create or delete. A create that is accepted ends with
    the next delete by the same user, and the first create behind that delete is accepted next, so each
    create points to one later create; the accepted ones are those reached from the node's first. Both
    ends are found by ordered scans, the chain by doubling."""
    moving = commands.where("user_valid and (op = 'create' and valid_type or op = 'delete')").select(
        "node_id", "user_id", "off", (-F.col("off")).alias("_back"), (F.col("op") == "create").alias("_create"))
    moving = moving.withColumn("_at", F.when(F.col("_create"), F.col("off")))
    moving = ordered_scan(moving, ["node_id"], "_back", fills_before={"_at": "_next"}, **split)
    moving = moving.withColumn("_end", F.when(~F.col("_create"), F.struct(F.col("off").alias("off"), F.col("_next").alias("next"))))
    creates = ordered_scan(moving, ["node_id", "user_id"], "_back", fills_before={"_end": "_freed"}, **split).where("_create").select(
        "node_id", "off", "user_id", F.col("_freed.off").alias("freed"), F.col("_freed.next").alias("jump")).checkpoint()
    reached = _reached(creates.select("node_id", "off", "jump"), creates.groupBy("node_id").agg(F.min("off").alias("off")))
    taken = creates.join(reached.select(F.col("node_id").alias("_n"), F.col("off").alias("_o")), _same("node_id", "_n", ("off", "_o"))).select(
        "node_id", "off", "user_id", "freed").checkpoint()
    events = taken.select("node_id", F.col("off"), F.lit(True).alias("has"), F.col("user_id").alias("owner")).unionByName(
        taken.where("freed is not null").select("node_id", F.col("freed").alias("off"), F.lit(False).alias("has"), F.lit(None).cast("string").alias("owner")))
    # an event holds from the position behind its command on
    events = events.withColumn("off", F.col("off") + 1)
    return _asof(events, commands, "node_id", F.struct("has", "owner"), "before", **split)


def node_commands(user_events: DataFrame, commands: DataFrame, *, owners: DataFrame | None = None,
                  fold_rows: int = FOLD_ROWS, **split) -> DataFrame:
    """Validate node create / update / delete commands.

    Checks, in order: user registered (as of the command) -> node exists or
    not -> (create) valid type / (update, delete) owner. Update does not check
    the type. Output: off, node_id, user_id, op, accepted, reason, event_type.
    A node has one command per ``off``, none below 0. ``owners`` (node_id, owner): nodes that exist before
    the first command.

    Whether a command is accepted depends on the earlier accepted ones. Nodes of up to ``fold_rows``
    commands are folded in one expression each, behind the exchange on the node; the commands of larger nodes
    are chained by pointer doubling, so no task holds a node's history. All of it is native.
    """
    counts = commands.groupBy("node_id").agg(F.count(F.lit(1)).alias("_n"))
    c = user_valid_asof(user_events, commands, **split)
    c = c.withColumn("valid_type", is_valid_node_type(F.col("node_type")))
    c = c.select("off", "node_id", "user_id", "op", "user_valid", "valid_type")
    if owners is not None:  # as if each owner had created the node before
        c = c.unionByName(owners.select(F.lit(-1).cast("long").alias("off"), "node_id", F.col("owner").alias("user_id"), F.lit("create").alias("op"),
                                        F.lit(True).alias("user_valid"), F.lit(True).alias("valid_type")))
    checkpoint_dir(c.sparkSession)
    large = counts.where(F.col("_n") > fold_rows).select(F.col("node_id").alias("_large"))
    if large.isEmpty():
        return _decided(_folded(c), owners)
    c = c.checkpoint()  # both ways read it
    large = checked_broadcast(large.checkpoint())
    of = F.col("node_id").eqNullSafe(F.col("_large"))
    return _decided(_folded(c.join(large, of, "left_anti")).unionByName(_chained(c.join(large, of, "left_semi"), **split)), owners)


def _decided(commands: DataFrame, owners: DataFrame | None) -> DataFrame:
    """The decision on each command from the state ``before`` it."""
    has, owner, op = F.coalesce(F.col("before.has"), F.lit(False)), F.col("before.owner"), F.col("op")
    known = F.coalesce(op.isin("create", "update", "delete"), F.lit(False))
    create = op == "create"
    reason = (F.when(~known, F.lit("unknown command"))
               .when(~F.col("user_valid"), F.lit("user not registered"))
               .when(create & has, F.lit("node already exists"))
               .when(create & ~F.col("valid_type"), F.lit("invalid node type"))
               .when(~create & ~has, F.lit("node does not exist"))
               .when(~create & ~owner.eqNullSafe(F.col("user_id")), F.lit("not the owner")))
    event = (F.when(create, F.lit("NodeCreated")).when(op == "update", F.lit("NodeUpdated")).otherwise(F.lit("NodeDeleted")))
    rows = commands if owners is None else commands.where("off >= 0")
    return rows.withColumn("reason", reason).select(
        "off", "node_id", "user_id", "op", F.col("reason").isNull().alias("accepted"), "reason",
        F.when(F.col("reason").isNull(), event).alias("event_type"))


def owners_after(decided: DataFrame) -> DataFrame:
    """Per node that accepted commands created or deleted: its owner after them (null: the node is gone)."""
    moved = decided.where("accepted and op <> 'update'")
    last = F.max_by(F.struct((F.col("op") == "create").alias("has"), F.col("user_id").alias("owner")), "off")
    return moved.groupBy("node_id").agg(last.alias("_l")).select("node_id", F.col("_l.has").alias("has"), F.when(F.col("_l.has"), F.col("_l.owner")).alias("owner"))


def accepted_node_events(commands: DataFrame, decided: DataFrame) -> DataFrame:
    """The events that accepted node commands publish, in the node-events log's shape: the decisions of
    ``node_commands`` with the fields of their commands (one command per ``off``). A delete carries
    the node and its owner only."""
    kept = decided.where("accepted").select(F.col("off").alias("_off"), "event_type")
    gone = F.col("event_type") == "NodeDeleted"
    return commands.join(kept, F.col("off") == F.col("_off")).select(
        "off", F.col("event_type").alias("type"), "node_id", F.when(~gone, F.col("district_id")).alias("district_id"),
        F.when(~gone, F.col("node_type")).alias("node_type"), F.col("user_id").alias("owner_id"),
        F.when(gone, F.lit(0.0)).otherwise(F.col("capacity")).alias("capacity"), F.col("t").alias("timestamp"))
