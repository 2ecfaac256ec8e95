"""Time-series operators against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import series as T


def stamps(seconds):
    return pd.to_datetime("2024-01-01") + pd.to_timedelta(seconds, unit="s")


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


@pytest.mark.parametrize("size", [4, 100_000])
def test_asof_matches_pandas_with_ties_and_duplicates(spark, size):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"k": rng.choice(["a", "b"], 120), "lid": range(120), "lt": stamps(rng.integers(0, 300, 120))})
    right = pd.DataFrame({"k": rng.choice(["a", "b"], 80), "rid": range(80), "rt": stamps(rng.integers(0, 300, 80))})
    got = T.asof_nearest(frame(spark, left), frame(spark, right), ("lt", "rt"), ("lid", "rid"), "k", tolerance=2_000_000, size=size)
    got = {r.lid: r.rid for r in got.collect()}
    want = {}
    for k in ("a", "b"):
        l, r = left[left.k == k].sort_values("lt"), right[right.k == k].sort_values(["rt", "rid"])
        m = pd.merge_asof(l, r, left_on="lt", right_on="rt", direction="nearest", tolerance=pd.Timedelta("2s")).dropna(subset=["rid"])
        want.update(dict(zip(m.lid, m.rid.astype(int))))
    assert got == want


def test_asof_without_limit_keeps_every_row_and_ties_go_back(spark):
    left = pd.DataFrame({"k": ["a"], "lid": [1], "lt": stamps([10])})
    right = pd.DataFrame({"k": ["a"] * 4, "rid": [1, 2, 3, 4], "rt": stamps([5, 5, 15, 15])})
    out = T.asof_nearest(frame(spark, left), frame(spark, right), ("lt", "rt"), ("lid", "rid"), "k", tolerance=10**15).collect()
    assert [(r.lid, r.rid, r.gap_us) for r in out] == [(1, 2, 5_000_000)]


def test_align_falls_back_to_positions(spark):
    left = pd.DataFrame({"lid": range(5), "lt": stamps(range(5))})
    near = pd.DataFrame({"rid": range(5), "rt": stamps(np.arange(5) + 0.1)})
    far = pd.DataFrame({"rid": range(4), "rt": stamps(np.arange(4) + 5000)})
    out, ratio = T.align(frame(spark, left), frame(spark, near), ("lt", "rt"), ("lid", "rid"))
    assert ratio == 1.0 and sorted((r.lid, r.rid) for r in out.collect()) == [(i, i) for i in range(5)]
    out, ratio = T.align(frame(spark, left), frame(spark, far), ("lt", "rt"), ("lid", "rid"))
    assert ratio == 0.0 and sorted((r.lid, r.rid) for r in out.collect()) == [(i, i) for i in range(4)]


def test_tolerance_of_short_series_is_one_second(spark):
    df = frame(spark, pd.DataFrame({"k": ["a", "a", "b", "b", "b"], "t": stamps([0, 100, 0, 10, 30])}))
    got = {r.k: r.tolerance_us for r in T.tolerance_us(T.median_gap(df, "t", "k")).collect()}
    assert got == {"a": 1_000_000, "b": 9_000_000}


@pytest.mark.parametrize("n,factor", [(1, 3), (2, 4), (9, 3)])
def test_densify_index_is_linear_interpolation(spark, n, factor):
    v = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "i": range(n), "v": v}))
    got = [r.value for r in T.densify_index(df, "v", ["i"], "k", factor, size=2).orderBy("at").collect()]
    assert np.allclose(got, np.interp(np.linspace(0, n - 1, (n - 1) * factor + 1), np.arange(n), v))


def test_densify_time_matches_pandas(spark):
    sec = np.array([0, 2, 4, 9, 10, 12])
    v = np.array([1.0, 3.0, 2.0, 7.0, 7.5, 0.0])
    df = frame(spark, pd.DataFrame({"k": "a", "i": range(6), "t": stamps(sec), "v": v}))
    got = [(r.ts, r.value) for r in T.densify_time(df, "t", "v", "k", 2, "i", size=3).orderBy("at").collect()]
    grid = pd.date_range(stamps([0])[0], stamps([12])[0], freq="1s")
    s = pd.Series(v, index=stamps(sec))
    want = s.reindex(s.index.union(grid)).interpolate(method="time").reindex(grid)
    assert [t for t, _ in got] == list(grid.to_pydatetime())
    assert np.allclose([x for _, x in got], want)


def test_densify_time_of_equal_times_goes_by_position(spark):
    df = frame(spark, pd.DataFrame({"k": "a", "i": range(3), "t": stamps([5, 5, 5]), "v": [0.0, 2.0, 4.0]}))
    got = T.densify_time(df, "t", "v", "k", 2, "i").orderBy("at").collect()
    assert [r.value for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0] and all(r.ts is None for r in got)


def test_windows_need_more_rows_than_their_length(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(4)] + [("b", i, float(i)) for i in range(3)], "k string, i int, v double")
    got = T.supervised_windows(df, "v", ["i"], "k", 3, size=2).collect()
    assert [(r.k, r.x, r.y) for r in got] == [("a", [0.0, 1.0, 2.0], 3.0)]


def test_scaling_round_trip_and_constant_series(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("c", 5.0), ("c", 5.0)], "k string, v double")
    params = T.fit_minmax(df, "v", "k", (-1.0, 1.0))
    scaled = T.scale(df, params, "v", "k")
    assert sorted(r.scaled for r in scaled.filter("k = 'a'").collect()) == [-1.0, 1.0]
    back = T.unscale(scaled, params, "scaled", "k").collect()
    assert all(abs(r.v - r.restored) < 1e-12 for r in back)


def test_empty_hours_have_no_rate(spark):
    df = frame(spark, pd.DataFrame({"k": "a", "t": stamps([0, 60, 3 * 3600]), "bad": [True, False, True]}))
    got = T.rate_per_bin(df, "t", F.col("bad"), 3_600_000_000, "k").orderBy("bin").collect()
    assert [(r.flagged, r.total, r.rate) for r in got] == [(1, 2, 50.0), (0, 0, None), (0, 0, None), (1, 1, 100.0)]


def test_resample_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"t": stamps(np.sort(rng.integers(0, 2000, 60))), "v": rng.normal(size=60)})
    got = T.resample(frame(spark, pdf), "t", 60_000_000, {"m": F.avg("v")}).orderBy("bin").toPandas()
    want = pdf.set_index("t")["v"].resample("1min").mean()
    assert list(got["bin"]) == list(want.index)
    assert np.allclose(got["m"].astype(float).fillna(-9), want.fillna(-9))


@pytest.mark.parametrize("n", [2, 3, 10, 100])
def test_split_keeps_one_holdout_row(spark, n):
    df = spark.createDataFrame([(i,) for i in range(n)], "i int")
    got = {r.i: r.part for r in T.split_by_position(df, ["i"]).collect()}
    pre = max(1, int(n * 0.75))
    fine = min(max(pre + 1, int(n * 0.95)), n - 1)
    want = {i: "pretrain" if i < pre else "finetune" if i < fine else "holdout" for i in range(n)}
    assert got == want


def test_forecast_feeds_predictions_back(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([9, 1, 2, 3])] + [("b", 0, 1.0)], "k string, i int, v double")
    got = [r.predicted for r in T.multi_step(df, "v", ["i"], "k", 3, 3).orderBy("step").collect()]
    seq = [1.0, 2.0, 3.0]
    for _ in range(3):
        seq.append(sum(seq[-3:]) / 3)
    assert np.allclose(got, seq[3:])


def test_future_steps_stay_in_range(spark):
    df = frame(spark, pd.DataFrame({"k": ["a", "b"], "t": stamps([0, 100])}))
    rows = T.future_stamps(df, "t", "k", 50).orderBy("k", "step").toPandas()
    gaps = rows.groupby("k")["ts"].diff().dropna().dt.total_seconds()
    assert gaps.between(15, 20).all() and gaps.nunique() > 3


def test_drift_report_recommends_by_change(spark):
    rows = [("a", i, 0.0, 1.0 if i < 4 else 3.0) for i in range(8)] + [("b", i, 0.0, 1.0) for i in range(8)]
    got = {r.k: r for r in T.drift_report(spark.createDataFrame(rows, "k string, i int, y double, p double"), "y", "p", ["i"], "k").collect()}
    assert got["a"].rmse_change_pct == pytest.approx(200) and got["a"].recommendation == "retrain"
    assert got["b"].rmse_diff == 0 and got["b"].recommendation == "keep"


def test_long_ranges_are_cut(spark):
    df = spark.createDataFrame([(0, 25_000), (5, 4), (7, 7)], "a bigint, b bigint")
    got = T.explode_range(df, F.col("a"), F.col("b"), "i")
    assert got.agg(F.count("i"), F.min("i"), F.max("i")).first()[:] == (25_002, 0, 25_000)


def test_single_rows_and_nulls_stay(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    rows = [("one", 1, t0, 5.0)] + [("two", i, t0 + dt.timedelta(minutes=i), float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz, v double")
    dense = T.densify_time(df, "ts", "v", "k", 2, "id").collect()
    assert [(r.at, r.ts, r.value) for r in dense if r.k == "one"] == [(0, t0, 5.0)]
    assert len(dense) == 6
    same = T.densify_time(df, "ts", "v", "k", 1, "id").collect()
    assert sorted((r.k, r.ts, r.value) for r in same) == sorted((k, t, v) for k, _, t, v in rows)
    holes = spark.createDataFrame([("k", i, None if i == 4 else float(i)) for i in range(10)], "k string, id int, v double")
    made = {r.id: r.x for r in T.supervised_windows(holes, "v", ["id"], "k", 3).collect()}
    assert len(made) == 7 and made[5] == [2.0, 3.0, None]
    scored = {r.id: r.predicted for r in T.one_step_score(holes, "v", ["id"], "k", 3).collect()}
    assert scored[5] == 2.5


def test_long_ids_break_ties(spark):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, t0)], "l int, lt timestamp_ntz")
    right = spark.createDataFrame([("x" * 30 + c, t0) for c in "cab"], "r string, rt timestamp_ntz")
    assert T.asof_nearest(left, right, ("lt", "rt"), ("l", "r"), tolerance=10).first().r == "x" * 30 + "c"
