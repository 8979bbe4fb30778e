"""Ordered per-key scans that survive hot keys.

Many operators need a key's rows in arrival order (positions, the previous
value, the last non-null value so far). A plain ``Window.partitionBy(key)``
puts a key's whole history into one task; if one key holds a third of all rows
that task never finishes. Here a key (null included) whose row count exceeds
``rows_per_split`` is cut into ordered sub-ranges (``_split``) at quantiles of
its order column, so a burst or an outlier does not make one of them large.
Each sub-range is processed in its own task, and a small per-(key, split)
summary -- counts, last values -- is prefix-scanned per key and joined back,
which makes the results exact across split boundaries. On that path the
windowed rows are checkpointed to the shared checkpoint folder once, cutting the
lineage so neither branch recomputes the input.

Every hot key has more than ``rows_per_split`` rows, so there are at most
rows / rows_per_split of them, and about twice as many splits: that is the bound
on what the driver holds and what is broadcast. When no key is hot the plan is
the plain window with a single exchange on the key. (Rows of one key that all
carry the same leading order value stay in one split.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridflow import config as C
from gridflow.session import checkpoint_dir

SPLIT = "_split"
HOT = "_hot"
# the per-split summary of hot keys is broadcast when its rows, at most one per (hot key, split),
# times ROW_WIDTH bytes a column stay below this
BROADCAST_BYTES = 64 << 20
ROW_WIDTH = 64   # bytes of a summary column, generously
# rank error of the quantiles, relative to a split
SPLIT_ERROR = 0.05


def _order_cols(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _order_key(order):
    cols = _order_cols(order)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


@dataclass
class HotKeys:
    """Keys found hot, each with the ascending order values at which its splits begin.

    Applying the same list to a later input keyed the same way (for example rows
    derived one-to-few from the scanned ones) avoids a second detection job;
    any split layout gives exact results, the list only decides task sizes.
    """
    keys: list[str]
    rows: list[tuple]

    @property
    def any(self) -> bool:
        return bool(self.rows)

    def splits(self) -> int:
        """Upper bound on the number of (hot key, split) pairs."""
        return sum(len(r[-1]) + 1 for r in self.rows)

    def apply(self, df: DataFrame, order) -> DataFrame:
        if not self.rows:
            return df.withColumn(SPLIT, F.lit(0).cast("long"))
        from pyspark.sql.types import ArrayType, LongType, StructField, StructType
        schema = StructType([StructField(f"_k{i}", df.schema[k].dataType, True) for i, k in enumerate(self.keys)]
                            + [StructField("_cuts", ArrayType(LongType()))])
        hot_df = df.sparkSession.createDataFrame(self.rows, schema)
        lead = F.col(_order_cols(order)[0])
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        below = F.size(F.filter("_cuts", lambda c: c <= lead))
        return (df.join(F.broadcast(hot_df), same, "left")
                  .withColumn(SPLIT, F.when(F.col("_cuts").isNull() | lead.isNull(), 0).otherwise(below).cast("long"))
                  .withColumn(HOT, F.col("_cuts").isNotNull())
                  .drop("_cuts", *[f"_k{i}" for i in range(len(self.keys))]))


def find_hot_keys(df: DataFrame, keys: list[str], order, rows_per_split: int | None = None) -> HotKeys:
    """One aggregate job over the key column; only if it finds hot keys another one over their order
    values. The driver gets one row per hot key."""
    conf = df.sparkSession.conf
    rows_per_split = rows_per_split or int(conf.get("gridflow.skew.rowsPerSplit", str(C.ROWS_PER_SPLIT)))
    lead = _order_cols(order)[0]   # splits cut on the leading (numeric) order column
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_split).collect()
    rows = []
    # keys whose numbers of splits agree to a factor of two share a list of fractions
    sizes: dict[int, list[tuple]] = {}
    for r in counts:
        sizes.setdefault((-(-r["_n"] // rows_per_split) - 1).bit_length(), []).append(tuple(r[k] for k in keys) + ([],))
    for exponent, group in sorted(sizes.items()):
        n = 1 << exponent
        some = HotKeys(list(keys), group).apply(df.select(*keys, lead), order).where(F.col(HOT))
        cuts = F.percentile_approx(F.col(lead).cast("long"), [i / n for i in range(1, n)], max(100, int(n / SPLIT_ERROR)))
        for r in some.groupBy(*keys).agg(cuts.alias("_cuts")).collect():
            # a row with the cut value itself starts the next split
            rows.append(tuple(r[k] for k in keys) + (sorted({c + 1 for c in r["_cuts"] or []}),))
    return HotKeys(list(keys), rows)


def add_splits(df: DataFrame, keys: list[str], order,
               rows_per_split: int | None = None, hot: HotKeys | None = None) -> tuple[DataFrame, bool]:
    """Add ``_split`` (0 for ordinary keys). Returns (df, any_hot)."""
    hot = hot or find_hot_keys(df, keys, order, rows_per_split)
    out = hot.apply(df, order)
    return (out if hot.any else out.withColumn(HOT, F.lit(False))), hot.any


def _win(keys, split_aware: bool, order):
    parts = list(keys) + ([SPLIT] if split_aware else [])
    return Window.partitionBy(*parts).orderBy(*_order_cols(order))


def ordered_scan(df: DataFrame, keys: list[str], order, *,
                 position: str | None = None,
                 lags: dict[str, str | list[str]] | None = None,
                 leads: dict[str, str] | None = None,
                 fills: dict[str, str] | None = None,
                 fills_before: dict[str, str] | None = None,
                 ends: dict[str, tuple[str, str]] | None = None,
                 rows_per_split: int | None = None,
                 hot: HotKeys | None = None) -> DataFrame:
    """Per key, in ``order``: add a 1-based ``position`` column, previous values
    (``lags`` maps source column -> output name, or the names for the previous value, the one before it, ...), next values (``leads``) and
    last-non-null-so-far values
    (``fills`` maps source column -> output name; the current row included;
    ``fills_before`` the same over the earlier rows only) and the key's first and last value (``ends``).

    Exact for any split layout; hot keys are split across tasks.
    """
    lags = {src: [dst] if isinstance(dst, str) else list(dst) for src, dst in (lags or {}).items()}
    leads = leads or {}
    fills = fills or {}
    fills_before = fills_before or {}
    ends = ends or {}
    hot = hot or find_hot_keys(df, keys, order, rows_per_split)
    sdf, any_hot = add_splits(df, keys, order, rows_per_split, hot)
    w = _win(keys, any_hot, order)
    out = sdf if any_hot else sdf.drop(SPLIT, HOT)
    if position or any_hot:
        out = out.withColumn("_lpos", F.row_number().over(w))
    for src, names in lags.items():
        for i, dst in enumerate(names, 1):
            out = out.withColumn(dst, F.lag(src, i).over(w))
    for src, dst in leads.items():
        out = out.withColumn(dst, F.lead(src).over(w))
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for src, dst in fills.items():
        out = out.withColumn(dst, F.last(src, ignorenulls=True).over(wf))
    wb = w.rowsBetween(Window.unboundedPreceding, -1)
    for src, dst in fills_before.items():
        out = out.withColumn(dst, F.last(src, ignorenulls=True).over(wb))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for src, names in ends.items():
        for end, dst in zip((F.first, F.last), names):
            out = out.withColumn(dst, end(src).over(whole))
    if not any_hot:
        if position:
            out = out.withColumn(position, F.col("_lpos").cast("long")).drop("_lpos")
        return out

    # The windowed rows feed both the per-split summary and the join back: write them
    # once to the shared checkpoint folder (hot path only) so the input is computed,
    # scanned and shuffled once; the summary is joined back by broadcast, so the big
    # side is not shuffled again.
    checkpoint_dir(out.sparkSession)
    out = out.checkpoint(eager=True)
    # summary per (key, split): row count, last value of each lagged column, first
    # of each lead, last non-null of each filled column; prefix-scanned per key over splits.
    pos = F.col("_lpos")
    aggs = [F.max(pos).alias("_cnt")]
    for src, names in lags.items():  # the split's last values, newest first: its last row has them
        aggs.append(F.slice(F.max_by(F.array(src, *names[:-1]), pos), F.lit(1), F.least(F.max(pos), F.lit(len(names)))).alias(f"_last_{src}"))
    for src in leads:
        aggs.append(F.min_by(F.col(src), pos).alias(f"_first_{src}"))
    for src in ends:
        aggs += [F.min_by(F.col(src), pos).alias(f"_begin_{src}"), F.max_by(F.col(src), pos).alias(f"_end_{src}")]
    filled = list(dict.fromkeys([*fills, *fills_before]))
    for src in filled:
        aggs.append(F.max_by(F.col(src), F.when(F.col(src).isNotNull(), pos)).alias(f"_lnn_{src}"))
    # only hot keys have more than one split: ordinary keys' local results are final
    summ = out.where(F.col(HOT)).groupBy(*keys, SPLIT).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(SPLIT)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, SPLIT, "_cnt", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_start")]
    for src in leads:
        cols.append(F.lead(f"_first_{src}").over(ws).alias(f"_carry_lead_{src}"))
    for src, names in lags.items():  # no split is empty, so as many splits before hold as many values
        k = len(names)
        tails = F.reverse(F.collect_list(f"_last_{src}").over(ws.rowsBetween(-k, -1)))
        cols.append(F.slice(F.flatten(tails), F.lit(1), F.lit(k)).alias(f"_carry_lag_{src}"))
    for src in filled:
        cols.append(F.last(f"_lnn_{src}", ignorenulls=True).over(before).alias(f"_carry_fill_{src}"))
    for src, names in ends.items():
        every = ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        cols += [F.first(f"_begin_{src}").over(every).alias(f"_of_{names[0]}"), F.last(f"_end_{src}").over(every).alias(f"_of_{names[1]}")]
    summ = summ.select(*cols)
    width = len(summ.columns) + sum(len(names) for names in lags.values())
    if hot.splits() * ROW_WIDTH * width <= BROADCAST_BYTES:   # one row per hot (key, split)
        summ = F.broadcast(summ)
    names = [*keys, SPLIT]
    summ = summ.withColumnsRenamed({c: f"_s{i}" for i, c in enumerate(names)})
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    out = out.join(summ, same, "left").drop(*[f"_s{i}" for i in range(len(names))])
    if position:
        out = out.withColumn(position, (F.coalesce(F.col("_start"), F.lit(0)) + F.col("_lpos")).cast("long"))
    for src, names in lags.items():
        for i, dst in enumerate(names, 1):
            carried = F.get(F.col(f"_carry_lag_{src}"), (F.lit(i) - F.col("_lpos")).cast("int"))
            out = out.withColumn(dst, F.when(F.col("_lpos") <= i, carried).otherwise(F.col(dst)))
        out = out.drop(f"_carry_lag_{src}")
    for src, dst in leads.items():
        out = (out.withColumn(dst, F.when(F.col("_lpos") == F.col("_cnt"), F.col(f"_carry_lead_{src}"))
                                    .otherwise(F.col(dst)))
                  .drop(f"_carry_lead_{src}"))
    for dst in [name for names in ends.values() for name in names]:
        out = out.withColumn(dst, F.when(F.col("_cnt").isNotNull(), F.col(f"_of_{dst}")).otherwise(F.col(dst))).drop(f"_of_{dst}")
    for src, dst in [*fills.items(), *fills_before.items()]:
        out = out.withColumn(dst, F.coalesce(F.col(dst), F.col(f"_carry_fill_{src}")))
    out = out.drop(*[f"_carry_fill_{src}" for src in filled])
    return out.drop("_start", "_lpos", "_cnt", SPLIT, HOT)

