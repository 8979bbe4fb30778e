"""Streaming operators with keyed state and event-time order (``transformWithStateInPandas``).

Each function takes a streaming DataFrame and returns a streaming DataFrame. Rows are first reduced by
a native watermarked aggregate -- to (district, step) or (node, tick interval) -- that holds what waits
for the watermark in its own state and combines partially, so neither a hot key's raw rows nor waiting rows
ever reach Python. A keyed fold of constant state then takes the closed groups in order of time. State is
checkpointed with the offsets, so a restart resumes exactly. Both need the RocksDB state store provider,
set before the query starts.

The operators without event-time order (billing, charge by micro-batch, node commands, twin) are native
micro-batch steps: see ``steps`` and ``continuous``.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridflow import config as C

_KWH = float(C.CENTI_KW_MS_PER_KWH)
_MILLIONTHS = 1_000_000  # power is taken in millionths of its unit, so that exact readings keep their decimals


def _millionths(x) -> int:
    """Of a whole number or a decimal with at most six decimals."""
    return int(x) * _MILLIONTHS if x == int(x) else int(Decimal(x).scaleb(6, Context(prec=60)))


def _number(millionths: int) -> float:
    whole, rest = divmod(millionths, _MILLIONTHS)
    return millionths / _MILLIONTHS if rest else float(whole)
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# ---- liveness with event-time timers -------------------------------------------------

LIVE_OUT = T.StructType([
    T.StructField("node_id", T.StringType()), T.StructField("tick_ms", T.LongType()),
    T.StructField("event", T.StringType()), T.StructField("last_seen_ms", T.LongType()),
    T.StructField("period_ms", T.LongType()),
])
# nodes are dealt over so many groups: calls into the state store and to Python are per group and batch, not per node
LIVE_GROUPS = 1024
# closed intervals that a task packs at a time into one row per group: the engine makes Python objects of each row
PACK_ROWS = 500_000
_PACKED = "nodes long, node_id array<string>, tick array<long>, seen array<long>, period array<long>"
_NONE = -(1 << 63)  # in packed rows: no activity, no period change
_LIVE_STATE = T.StructType([
    T.StructField("node", T.ArrayType(T.StringType())), T.StructField("seen", T.ArrayType(T.LongType())),
    T.StructField("period", T.ArrayType(T.LongType())), T.StructField("crashed", T.ArrayType(T.BooleanType())),
    T.StructField("cursor", T.ArrayType(T.LongType())), T.StructField("timer", T.LongType()),
])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(nodes, node_id, tick, seen, period) -> their lists per group of nodes."""
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        held.clear()
        for name in ("seen", "period"):
            t = t.set_column(t.schema.get_field_index(name), name, pc.fill_null(t[name], _NONE))
        lists = t.group_by("nodes", use_threads=False).aggregate([(c, "list") for c in t.column_names[1:]])
        yield from lists.select(["nodes", *(f"{c}_list" for c in t.column_names[1:])]).rename_columns(t.column_names).to_batches()
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= PACK_ROWS:
            yield from flush()
    if held:
        yield from flush()


def _liveness_processor(default_period: int, tick: int, multiplier: int):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Liveness(StatefulProcessor):
        """A group of nodes. Per node [seen, period, crashed, cursor]: last seen (None: not known yet), period, crashed
        or not, and the tick up to which the flag is known. One timer, at the first tick at which a silent node crashes."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("liveness", _LIVE_STATE)

        def _ticks(self, s: list, below: int, node: str, out: list) -> None:
            """Evaluate the ticks in [cursor, below), between which nothing changes."""
            seen, period, crashed, cursor = s
            if cursor >= below:
                return
            s[3] = below
            first = -(-cursor // tick) * tick
            if seen is None or first >= below:
                return
            period = period or default_period
            bad = first - seen > multiplier * period
            if bad != crashed:
                out.append((node, first, "crash" if bad else "recovered", seen, period))
                s[2] = bad
            crash = ((seen + multiplier * period) // tick + 1) * tick
            if not bad and first < crash < below:
                out.append((node, crash, "crash", seen, period))
                s[2] = True

        def _load(self) -> tuple[dict, int]:
            if not self.state.exists():
                return {}, -1
            node, seen, period, crashed, cursor, timer = self.state.get()
            return dict(zip(node, map(list, zip(seen, period, crashed, cursor)))), timer

        def _done(self, nodes: dict, timer: int, touched, watermark: int, out: list) -> pd.DataFrame:
            for node in touched:
                self._ticks(nodes[node], watermark + 1, node, out)
            due = -1
            for node, s in nodes.items():
                if s[0] is None or s[2]:
                    continue
                at = ((s[0] + multiplier * (s[1] or default_period)) // tick + 1) * tick
                if at < watermark:  # a timer fires once the watermark has passed it
                    self._ticks(s, watermark + 1, node, out)
                elif due < 0 or at < due:
                    due = at
            if due != timer:
                if timer > watermark:
                    self.handle.deleteTimer(timer)
                if due >= 0:
                    self.handle.registerTimer(due)
            columns = zip(*nodes.values()) if nodes else ((), (), (), ())
            self.state.update((list(nodes), *map(list, columns), due))
            return pd.DataFrame(out, columns=LIVE_OUT.names)

        def handleInputRows(self, key, rows, timerValues):
            packed = pd.concat(list(rows), ignore_index=True)
            ticks, seens, periods = (np.concatenate(packed[c].tolist()) for c in ("tick", "seen", "period"))
            order = np.argsort(ticks, kind="stable")
            ids = [x for some in packed["node_id"] for x in some]
            (nodes, timer), out = self._load(), []
            names = [ids[i] for i in order.tolist()]
            for node, at, seen, period in zip(names, ticks[order].tolist(), seens[order].tolist(), periods[order].tolist()):
                s = nodes.get(node)
                if s is None:
                    s = nodes[node] = [None, 0, False, 0]
                self._ticks(s, at, node, out)
                if seen != _NONE:
                    s[0] = seen if s[0] is None else max(s[0], seen)
                if period != _NONE:
                    s[1] = max(period, 0)
            yield self._done(nodes, timer, dict.fromkeys(names), timerValues.getCurrentWatermarkInMs(), out)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            nodes, _ = self._load()
            out: list = []
            yield self._done(nodes, -1, (), timerValues.getCurrentWatermarkInMs(), out)

        def close(self) -> None:
            pass

    return Liveness()


def liveness_stream(activity: DataFrame, period_changes: DataFrame, *, watermark: str,
                    default_period_ms: int = C.DEFAULT_PERIOD_MS, tick_ms: int = C.HEARTBEAT_TICK_MS,
                    multiplier: int = C.HEARTBEAT_MULTIPLIER) -> DataFrame:
    """Crash / recovered events as a continuous query (append mode).

    The flag is evaluated at ticks only, so of all rows of a node between two ticks its latest activity and
    latest period change suffice: a watermarked aggregate by (node, tick interval) keeps them until the
    watermark reaches the interval's tick. A late row within the watermark changes nothing (the batch form
    sees the same rows); later ones are dropped. A keyed fold over groups of nodes takes each node's closed
    intervals in order and registers an event-time timer at the first tick at which a silent node of the group crashes.
    A silent *stream* moves no watermark, so a heartbeat source (any input) is needed for crashes to
    surface; emitted ticks are those before the watermark (batch form: horizon).
    """
    a = activity.select("node_id", "off", "t", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("period_ms"))
    p = period_changes.select("node_id", "off", "t", F.lit(1).alias("kind"), F.col("period_ms").cast("long"))
    # a row at a tick counts for it: intervals are open at their begin and closed at their tick
    rows = a.unionByName(p).withColumn("event_time", F.timestamp_millis(F.col("t") - 1)).withWatermark("event_time", watermark)
    # (t, off) as one number, a null off first: the aggregate hashes what has a fixed width and sorts for a struct
    place = F.expr("cast(cast(t as decimal(18,0)) * cast(20000000000000000000 as decimal(20,0)) as decimal(38,0))"
                   " + coalesce(cast(off as decimal(20,0)), cast(-10000000000000000000 as decimal(20,0)))")
    g = rows.groupBy("node_id", F.window("event_time", f"{tick_ms} milliseconds").alias("w")).agg(
        F.max(F.when(F.col("kind") == 0, F.col("t"))).alias("seen"),
        F.max_by(F.coalesce("period_ms", F.lit(0)), F.when(F.col("kind") == 1, place)).alias("period"))
    closed = g.select(F.pmod(F.xxhash64("node_id"), F.lit(LIVE_GROUPS)).alias("nodes"), "node_id",
                      F.unix_millis(F.col("w.end")).alias("tick"), "seen", "period").mapInArrow(_pack, _PACKED)
    return closed.groupBy("nodes").transformWithStateInPandas(
        statefulProcessor=_liveness_processor(default_period_ms, tick_ms, multiplier), outputStructType=LIVE_OUT,
        outputMode="Append", timeMode="EventTime")


# ---- district charge over event-time steps (equals the batch closed form) ----------------

STEP_CHARGE_OUT = T.StructType([
    T.StructField("district_id", T.StringType()), T.StructField("step", T.LongType()),
    T.StructField("batch_balance_kw", T.DoubleType()), T.StructField("num_measurements", T.LongType()),
    T.StructField("max_event_ms", T.LongType()), T.StructField("charge_kwh", T.DoubleType()),
])
_STEP_CHARGE_STATE = T.StructType([T.StructField("charge", T.StringType()), T.StructField("clock", T.LongType())])


CLOSING = "\x00closing"  # district of the row behind a bounded input


def _step_charge_processor():
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class StepCharge(StatefulProcessor):
        """Fold closed (district, step) balances in step order: the clock never
        moves back, the first step integrates nothing, the charge is clamped at 0."""

        def init(self, handle) -> None:
            self.state = handle.getValueState("charge", _STEP_CHARGE_STATE)

        def handleInputRows(self, key, rows, timerValues):
            pdf = pd.concat(list(rows), ignore_index=True).sort_values("step", kind="stable")
            charge, clock = self.state.get() if self.state.exists() else ("0", -1)
            charge, out = int(charge), []
            for step, bal, n, mx in zip(pdf["step"], pdf["balance_v100"], pdf["num_measurements"], pdf["max_t"]):
                last, clock = clock, max(clock, int(mx))
                if last > 0 and clock - last > 0:
                    charge = max(0, charge + _millionths(bal) * (clock - last))
                out.append((key[0], int(step), _number(_millionths(bal)) / 100.0, int(n), clock, _number(charge) / _KWH))
            self.state.update((str(charge), clock))
            yield pd.DataFrame(out, columns=[f.name for f in STEP_CHARGE_OUT.fields])

        def close(self) -> None:
            pass

    return StepCharge()


def district_charge_stream(readings: DataFrame, step_ms: int = C.MS_PER_HOUR,
                           watermark: str = "0 seconds") -> DataFrame:
    """``operators.charge.district_charge`` as a continuous query (append mode).

    Readings are reduced to (district, event-time step) by a watermarked
    aggregate -- partial-aggregated, so a hot district never reaches Python as
    raw rows -- and each step is emitted once the watermark closes it; a keyed
    fold then carries the clamped charge. Steps closed in the same micro-batch
    are folded in step order. Needs the RocksDB state store provider (set by
    the caller before start). Rows later than the watermark are dropped. The last steps of a bounded input
    close with a ``closing`` row, which is no part of the result.
    """
    r = readings.where(F.col("district_id").isNotNull() & F.col("v100").isNotNull() & F.col("t").isNotNull())
    r = r.withColumn("event_time", F.timestamp_millis("t")).withWatermark("event_time", watermark)
    g = (r.groupBy("district_id", F.window("event_time", f"{step_ms} milliseconds").alias("w"))
          .agg(F.sum("v100").alias("balance_v100"), F.count(F.lit(1)).alias("num_measurements"),
               F.max("t").alias("max_t")))
    g = g.select("district_id", F.floor(F.unix_millis(F.col("w.start")) / F.lit(step_ms)).cast("long").alias("step"),
                 "balance_v100", "num_measurements", "max_t")
    out = g.groupBy("district_id").transformWithStateInPandas(
        statefulProcessor=_step_charge_processor(), outputStructType=STEP_CHARGE_OUT,
        outputMode="Append", timeMode="None")
    return out.where(F.col("district_id") != CLOSING)


def closing(readings: DataFrame, step_ms: int = C.MS_PER_HOUR, delay_ms: int = 0) -> DataFrame:
    """One row that moves the watermark past every step of ``readings``, to be landed behind them."""
    last = readings.agg(F.max("t").alias("t"), F.max("off").alias("off"))
    values = {"off": F.coalesce(F.col("off") + 1, F.lit(0)), "t": F.coalesce(F.col("t"), F.lit(0)) + 2 * step_ms + delay_ms,
              "district_id": F.lit(CLOSING), "v100": F.lit(0)}
    return last.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in readings.schema.fields])
