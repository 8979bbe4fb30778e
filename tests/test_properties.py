"""Property-based checks (hypothesis): the skew-safe ordered scan equals a plain
Python scan for any keys, nulls and split size, and the closed-form clamped
charge equals its recurrence."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows_of, sort_rows
from gridflow.operators import charge as G
from gridflow.plans.ordered import ordered_scan

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(-50, 50))),
                   min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, split=st.integers(1, 8))
def test_ordered_scan_any_split(spark, rows, split):
    data = [(k, i * 10, v) for i, (k, v) in enumerate(rows)]      # unique, increasing order values
    df = spark.createDataFrame(data, "k string, o long, v long")
    out = ordered_scan(df, ["k"], "o", position="pos", lags={"v": "lag"}, leads={"v": "lead"},
                       fills={"v": "ff"}, fills_before={"v": "fb"}, rows_per_split=split)
    want, by = [], {}
    for k, o, v in data:
        by.setdefault(k, []).append((o, v))
    for k, seq in by.items():
        last = None
        for i, (o, v) in enumerate(seq):
            fb = last
            last = v if v is not None else last
            want.append((k, o, i + 1, seq[i - 1][1] if i else None,
                         seq[i + 1][1] if i + 1 < len(seq) else None, last, fb))
    cols = ["k", "o", "pos", "lag", "lead", "ff", "fb"]
    assert rows_of(out, cols) == sort_rows(want)


@SETTINGS
@given(xs=st.lists(st.integers(-1000, 1000), min_size=1, max_size=40))
def test_clamped_sum_equals_recurrence(spark, xs):
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(xs)], "d string, s long, x long")
    got = [int(r["c"]) for r in G.clamped_running_sum(df, "d", "s", "x", "c").orderBy("s").collect()]
    c, want = 0, []
    for x in xs:
        c = max(0, c + x)
        want.append(c)
    assert got == want
