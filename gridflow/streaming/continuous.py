"""Continuous operators over micro-batches: a step of ``steps``, its state in keyed tables, its output as
one folder per batch.

Each function runs everything available on its stream under ``base`` (a shared folder with the checkpoint,
the state and the output) and can be called again on the same ``base`` when more has landed, or after a
failure at any point: a batch that did not commit runs again from the same state and replaces what it left.
``after(batch_id)``, if given, is called behind a batch's writes and before its commit (tests raise there).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.streaming import steps as St
from gridflow.streaming.sources import numbered_lines
from gridflow.streaming.tables import KeyedTable, append, run_steps

After = Callable[[int], None] | None


def _table(spark: SparkSession, base: str, name: str, key: list[str], schema: str, **options) -> KeyedTable:
    return KeyedTable(spark, f"{base}/{name}", key, schema, **options)


def _done(after: After, batch: int) -> None:
    if after:
        after(batch)


def billing(readings: DataFrame, base: str, size: int = C.BILLING_WINDOW_SIZE, after: After = None, **split) -> None:
    """Bills per ``size`` readings per node (``base/out``). Micro-batches must come in order of arrival."""
    def step(rows: DataFrame, batch: int) -> None:
        state = _table(rows.sparkSession, base, "open", ["node_id"], St.BILL_STATE)
        bills, open_ = St.billing_step(rows, state.before(batch), size, **split)
        append(bills, f"{base}/out", batch)
        state.write(batch, open_)
        _done(after, batch)

    run_steps(readings, step, f"{base}/checkpoint")


def charge_table(spark: SparkSession, base: str) -> KeyedTable:
    return _table(spark, base, "charge", ["district_id"], St.CHARGE_STATE)


def charge(readings: DataFrame, base: str, after: After = None) -> None:
    """Charge per district and micro-batch; its rows are the changes of ``charge_table``."""
    def step(rows: DataFrame, batch: int) -> None:
        state = charge_table(rows.sparkSession, base)
        state.write(batch, St.charge_step(rows, state.before(batch)))
        _done(after, batch)

    run_steps(readings, step, f"{base}/checkpoint")


def node_commands(log: DataFrame, user_events: Callable[[DataFrame], DataFrame], commands: Callable[[DataFrame], DataFrame],
                  base: str, after: After = None, **options) -> None:
    """Decisions on node commands (``base/out``). Both logs come from one stream with a common arrival order;
    the functions take their rows out of it."""
    def step(rows: DataFrame, batch: int) -> None:
        users = _table(rows.sparkSession, base, "users", ["user_id"], St.USER_STATE)
        owners = _table(rows.sparkSession, base, "owners", ["node_id"], St.OWNER_STATE)
        decided, changed, moved = St.command_step(user_events(rows), commands(rows), users.before(batch), owners.before(batch), **options)
        append(decided, f"{base}/out", batch)
        users.write(batch, changed)
        owners.write(batch, moved)
        _done(after, batch)

    run_steps(log, step, f"{base}/checkpoint")


def serial_lines(lines: DataFrame, base: str, after: After = None) -> None:
    """Device lines with their place among their node's (``base/out``), for files that land one after the other per node."""
    def step(rows: DataFrame, batch: int) -> None:
        counts = _table(rows.sparkSession, base, "lines", ["node_id"], "node_id string, lines long")
        numbered, behind = numbered_lines(rows, counts.before(batch))
        append(numbered, f"{base}/out", batch)
        counts.write(batch, behind)
        _done(after, batch)

    run_steps(lines, step, f"{base}/checkpoint")


def twin_table(spark: SparkSession, base: str) -> KeyedTable:
    return _table(spark, base, "twins", ["node_id"], St.TWIN_STATE)


def twins(events: DataFrame, registry: DataFrame, base: str, default_period_ms: int = C.DEFAULT_PERIOD_MS, after: After = None) -> None:
    """Twin state per node in ``twin_table``."""
    def step(rows: DataFrame, batch: int) -> None:
        state = twin_table(rows.sparkSession, base)
        state.write(batch, St.twin_step(rows, state.before(batch), registry, default_period_ms))
        _done(after, batch)

    run_steps(events, step, f"{base}/checkpoint")


def window_table(spark: SparkSession, base: str, **options) -> KeyedTable:
    return _table(spark, base, "windows", ["district_id", "window_start_ms"], St.SLIDE_STATE, **options)


def sliding(readings: DataFrame, base: str, duration_ms: int, slide_ms: int, delay_ms: int, after: After = None, **options) -> None:
    """Sliding balances in ``window_table``. Readings whose windows had all ended at the watermark go to
    ``base/late`` with their batch instead, so that none is lost; the watermark of a batch is ``delay_ms``
    behind the largest event time of the batches before it."""
    def step(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        clock = _table(spark, base, "clock", ["id"], St.CLOCK_STATE)
        windows = window_table(spark, base, **options)
        had = clock.before(batch).first()
        marked = St.late_step(rows, had and had.t, delay_ms, duration_ms, slide_ms)
        append(marked.where("late").drop("late"), f"{base}/late", batch)
        windows.write(batch, St.slide_step(marked.where("not late"), windows.before(batch), duration_ms, slide_ms))
        now = rows.agg(F.lit(0).alias("id"), F.greatest(F.max("t"), F.lit(had and had.t).cast("long")).alias("t"))
        clock.write(batch, now)
        _done(after, batch)

    run_steps(readings, step, f"{base}/checkpoint")


def window_rows(table: DataFrame, duration_ms: int) -> DataFrame:
    """The table in the shape of ``operators.windows.sliding_balance``."""
    total = F.col("sum_v100").cast("double")
    return table.select("district_id", "window_start_ms", (F.col("window_start_ms") + duration_ms).alias("window_end_ms"),
                        (total / (F.col("n_values").cast("double") * F.lit(100.0))).alias("avg_balance_kw"),
                        (total / F.lit(100.0)).alias("total_balance_kw"), F.col("n_nodes").alias("num_measurements"))
