"""Maintenance, features, models and streams on small frames."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import aggregates as A
from tidewell.operators import features as M
from tidewell.operators import maintenance as D
from tidewell.operators import models as L
from tidewell.streaming import jobs as ST


# -- maintenance -------------------------------------------------------------------------


def test_feedback_first_row_wins_but_all_tags_are_linked(spark):
    rows = [
        (1, "f1", "u2", "m1", "p", "r", 5.0, ["x", "y"]),
        (2, "f1", "u1", "m2", "other", "r", 1.0, ["z", "x"]),
        (3, "f2", "u2", "m2", "p2", "r2", 0.0, []),
    ]
    wide = spark.createDataFrame(
        rows, "line int, feedback_id string, user_name string, model_name string, prompt_text string, response_text string, rating double, tags array<string>"
    )
    t = D.normalise_feedback(wide)
    names = {k: {r[1]: r[0] for r in t[k].collect()} for k in ("app_user", "model", "tag")}
    assert names == {"app_user": {"u2": 1, "u1": 2}, "model": {"m1": 1, "m2": 2}, "tag": {"x": 1, "y": 2, "z": 3}}
    fb = {r.feedback_id: r for r in t["feedback"].collect()}
    assert (fb["f1"].user_id, fb["f1"].model_id, fb["f1"].prompt_text, fb["f1"].tags_array) == (1, 1, "p", ["x", "y"])
    assert sorted(map(tuple, t["feedback_tag"].collect())) == [(1, 1), (1, 2), (1, 3)]


def test_insert_returns_ids_of_old_and_new_keys(spark):
    target = spark.createDataFrame([("a", 4)], "k string, id bigint")
    incoming = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "line int, k string")
    got = sorted(map(tuple, D.insert_if_absent(target, incoming, "k", "id", ["line"]).collect()))
    assert got == [("a", 4, False), ("b", 5, True), ("c", 6, True)]


def test_update_keeps_own_value_and_rejects_foreign_ones(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, name string, n int")
    changes = spark.createDataFrame([(1, "a", 9), (2, "c", 9), (3, "new", None), (7, "x", 1)], "k int, name string, n int")
    got = sorted(map(tuple, D.update_by_key(target, changes, "k", "name").collect()))
    assert got == [(1, "a", 9), (2, "b", 2), (3, "new", 3)]
    assert {r.k: r.reason for r in D.rejected_changes(target, changes, "k", "name").collect()} == {2: "taken", 7: "unknown key"}


def test_audits(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, ref int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert [r.id for r in D.audit_fk(child, "ref", parent, "k").collect()] == [2]
    assert sorted(r.id for r in D.audit_fk(child, "ref", parent, "k", not_null=True).collect()) == [2, 3]
    assert [r.id for r in D.audit_check(child, {"small": F.col("ref") <= 5}).collect()] == [2]
    vec = spark.createDataFrame([(1, [1.0], "ab"), (2, [1.0, 2.0], "abc")], "id int, v array<double>, s string")
    got = sorted((r.id, r.rule_name) for r in D.audit_length(vec, {"v": 2, "s": 2}).collect())
    assert got == [(1, "dimension(v) = 2"), (2, "length(s) <= 2")]


def test_appending_twice_adds_nothing(spark):
    corpus = spark.createDataFrame([(1, "a")], "id int, text string")
    new = spark.createDataFrame([(2, "b"), (3, "b"), (4, "a")], "id int, text string")
    fresh = D.corpus_append(corpus, new, "text", ["id"]).select("id", "text")
    assert [tuple(r) for r in fresh.collect()] == [(2, "b")]
    assert D.corpus_append(corpus.unionByName(fresh), new, "text", ["id"]).count() == 0


# -- aggregates --------------------------------------------------------------------------


def test_profile_ignores_nan_and_matches_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, np.nan, 10.0], "b": [5.0, 5.0, 5.0, 5.0]})
    got = {r.column_name: r for r in A.column_profile(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    d = pdf.describe()
    for c in ("a", "b"):
        r = got[c]
        assert np.allclose([r.n_values, r["mean"], r["std"], r["min"], r.q0, r.q1, r.q2, r["max"]], d[c].to_numpy())
    assert got["a"].missing_rate == 0.25
    assert {r.column_name: r.n_outliers for r in A.zscore_outliers(spark.createDataFrame(pdf), ["a", "b"], 1.0).collect()} == {"a": 1, "b": 0}


def test_correlations_agree_with_numpy(spark):
    x = np.random.default_rng(2).normal(size=(40, 5))
    x[:, 4] = x[:, 0] * 2
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcde")))
    m = np.corrcoef(x.T)
    for r in A.corr_matrix(df, list("abcde")).collect():
        assert r.r == pytest.approx(m[r.i, r.j])
    assert [(r.col_a, r.col_b) for r in A.corr_pairs(df, list("abcde")).collect()] == [("a", "e"), ("e", "a")]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0, 1, 4, 10)], "v double")
    assert [r.n for r in A.histogram(df, "v", 5).orderBy("bin").collect()] == np.histogram([0, 0, 1, 4, 10], 5)[0].tolist()
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in A.histogram(flat, "v", 4).orderBy("bin").collect()] == np.histogram([3, 3], 4)[0].tolist()


def test_groups_without_limits_are_listed(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("a", 2.0), ("z", 1.0)], "g string, v double")
    limits = spark.createDataFrame([("a", "v", 2.0, 4.0)], "g string, param string, lower double, upper double")
    got = {r.g: (r.has_limits, r.n_below, r.n_above, r.n_total) for r in A.threshold_violations(df, limits, "g", ["v"]).collect()}
    assert got == {"a": (True, 1, 1, 2), "z": (False, 0, 0, 0)}


# -- features ----------------------------------------------------------------------------


def test_sweep_counts_scores_on_a_cut_and_takes_the_first_best(spark):
    cuts = np.linspace(0.05, 0.95, 181)
    rng = np.random.default_rng(1)
    score = np.concatenate([rng.choice(cuts, 60), rng.random(60), [0.0, 1.0]])
    label = (score + rng.normal(size=len(score)) * 0.3 > 0.5).astype(int)
    got = M.f1_threshold_sweep(spark.createDataFrame(pd.DataFrame({"y": label, "s": score})), "y", "s").orderBy("threshold").collect()
    f1 = []
    for t in cuts:
        p = score >= t
        tp, fp, fn = (p & (label == 1)).sum(), (p & (label == 0)).sum(), (~p & (label == 1)).sum()
        f1.append(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
    assert np.allclose([r.f1 for r in got], f1) and np.allclose([r.threshold for r in got], cuts)
    assert [i for i, r in enumerate(got) if r.is_best] == [int(np.argmax(f1))]


def test_no_positives_gives_zero_f1(spark):
    got = M.f1_threshold_sweep(spark.createDataFrame([(0, 0.5)], "y int, s double"), "y", "s").collect()
    assert {r.f1 for r in got} == {0.0} and sum(r.is_best for r in got) == 1


def test_bootstrap_weights_look_like_draws(spark):
    df = spark.range(4000).withColumnRenamed("id", "k")
    w = M.bootstrap(df, "k", [1, 2]).groupBy("seed").agg(F.sum("weight").alias("s"), F.count("k").alias("n")).collect()
    for r in w:
        assert abs(r.s - 4000) < 250 and abs(r.n / 4000 - (1 - math.exp(-1))) < 0.04


def test_folds_are_even_inside_each_class(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "k int, y int")
    sizes = M.stratified_folds(df, "k", "y").groupBy("y", "fold").count().collect()
    assert {r["count"] for r in sizes if r.y == 1} == {4} and {r["count"] for r in sizes if r.y == 0} == {36}


# -- models ------------------------------------------------------------------------------


def test_smote_fills_between_neighbours_of_the_same_class(spark):
    rng = np.random.default_rng(0)
    rows = [(f"a{i}", 0, rng.normal(size=2).tolist()) for i in range(12)] + [(f"b{i}", 1, (rng.normal(size=2) + 50).tolist()) for i in range(4)] + [("c0", 2, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "id string, y int, x array<double>")
    out = L.smote(df, "id", "y", "x").toPandas()
    assert out.groupby("y").size().to_dict() == {0: 12, 1: 12, 2: 12} and out["id"].is_unique
    small = np.stack([r[2] for r in rows if r[1] == 1])
    new = np.stack(out[out.id.str.startswith("new-1")]["x"].to_numpy())
    assert (new >= small.min(0) - 1e-9).all() and (new <= small.max(0) + 1e-9).all()
    assert sorted(map(tuple, out[~out.id.str.startswith("new")]["x"])) == sorted(tuple(r[2]) for r in rows)
    again = L.smote(df.repartition(3), "id", "y", "x").toPandas()
    assert sorted(map(tuple, again["x"])) == sorted(map(tuple, out["x"]))


def test_isolation_ranks_the_outlier_first(spark):
    x = np.random.default_rng(0).normal(size=(400, 3))
    x[7] = [9, -9, 9]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(400)))
    out = L.isolation_scores(df, "id", ["a", "b", "c"], trees=60, sample=64).orderBy(F.desc("score"))
    rows = out.collect()
    assert rows[0].id == 7 and len(rows) == 400 and 0 < rows[-1].score < rows[0].score < 1
    flat = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, a double")
    assert len({r.score for r in L.isolation_scores(flat, "id", ["a"], trees=5).collect()}) == 1


def test_lag_model_update_equals_fit_on_everything(spark):
    rng = np.random.default_rng(3)
    v = [0.0, 1.0]
    for _ in range(120):
        v.append(0.6 * v[-1] - 0.2 * v[-2] + 1 + rng.normal() * 0.1)
    df = spark.createDataFrame([("s", i, float(x), i >= 80) for i, x in enumerate(v)], "k string, i int, v double, late boolean")
    got = {r.phase: r for r in L.retrain_lag_linear(df, "v", ["i"], "k", 2, "late").collect()}
    z = np.array([[1, v[i - 2], v[i - 1]] for i in range(2, len(v))])
    for phase, n in (("original", 78), ("retrained", 120)):
        w = np.linalg.lstsq(z[:n], np.array(v[2 : n + 2]), rcond=None)[0]
        assert got[phase].n == n and np.allclose(got[phase].weights, w, atol=1e-6)


def test_random_search_tries_a_few_settings(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, float(rng.normal() + 3 * (i % 2)), i % 2) for i in range(40)], "id int, a double, y int")
    out = L.model_select(df, "id", ["a"], "y", {"numTrees": [1, 2, 3], "maxDepth": [1, 2]}, k=2, draws=2).collect()
    assert [r.place for r in out] == [1, 2] and out[0].f1 >= out[1].f1 > 0.5


def test_text_target_with_many_classes(spark):
    rows = [(i, float(i % 12), f"c{i % 12:02d}") for i in range(240)]
    out = L.supervised_report(spark.createDataFrame(rows, "id int, a double, y string"), "id", ["a"], "y", models=["random_forest"])
    assert {r.metric: r.value for r in out.collect()}["accuracy"] > 0.5


def test_report_falls_back_without_a_usable_target(spark):
    df = spark.createDataFrame([(i, float(i), 1) for i in range(30)], "id int, a double, y int")
    assert L.supervised_report(df, "id", ["a"], "y").first().model == "isolation_forest"
    assert L.supervised_report(df.select("id"), "id", [], None).first().metric == "skipped"
    assert L.task_of(df, "a") == "regression" and L.task_of(df, "y") == "single_class"


def test_oof_with_oversampling_scores_every_row(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal() + 2 * (i % 4 == 0)), float(rng.normal()), int(i % 4 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    out = L.oof_scores(df, "id", ["a", "b"], "y", k=2, n_models=1, oversample=True)
    assert out.count() == 80 and out.filter("proba NOT BETWEEN 0 AND 1 OR n_models <> 1").count() == 0


# -- streams -----------------------------------------------------------------------------


def _event_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(
        {"id": range(300), "k": rng.choice(["a", "b"], 300), "ts": pd.to_datetime("2024-01-01") + pd.to_timedelta(rng.permutation(300) * 97, unit="s"), "v": rng.normal(size=300)}
    )
    folder = str(tmp_path / "in")
    spark.createDataFrame(pdf).repartition(4).write.parquet(folder)
    return folder, spark.read.parquet(folder)


def test_streams_over_several_files_equal_the_batch(spark, tmp_path):
    folder, batch = _event_files(spark, tmp_path)
    read = lambda: ST.stream_files(spark, folder, batch, per_batch=1)
    rate = ST.run_update(ST.hourly_rate(read(), "ts", "k", F.col("v") > 0, late="30 days"), ST.job_folder(spark, "t"), ["k", "bin"])
    want = batch.groupBy("k", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bin")).agg(F.sum((F.col("v") > 0).cast("bigint")).alias("f"), F.count("v").alias("n"))
    assert sorted((r.k, r.bin, r.flagged, r.total) for r in rate.collect()) == sorted(map(tuple, want.collect()))
    hist = ST.run_update(ST.session_history(read(), "k", "ts", "id", 5), ST.job_folder(spark, "t"), ["k"]).collect()
    pdf = batch.toPandas()
    for r in hist:
        mine = pdf[pdf.k == r.k].sort_values("ts")
        assert r.history.split("\n") == [str(i) for i in mine["id"].tail(5)] and r.n_total == len(mine)
    days = ST.run_append(ST.distinct_per_day(read(), ["k"], "ts"), ST.job_folder(spark, "t"))
    assert days.count() == days.distinct().count() == batch.select("k", F.to_date("ts")).distinct().count()


def test_streamed_corpus_takes_each_content_once(spark, tmp_path):
    rows = [(i, f"text {i % 7}") for i in range(40)]
    spark.createDataFrame(rows, "id int, text string").repartition(4).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    seed = spark.createDataFrame([("text 3",)], "text string")
    stream = ST.stream_files(spark, str(tmp_path / "in"), df, per_batch=1)
    out = ST.corpus_add(stream, seed, "text", ["id"], ST.job_folder(spark, "t"))
    assert sorted(r.text for r in out.collect()) == [f"text {i}" for i in range(7) if i != 3]


def test_null_keys_are_kept(spark):
    from tidewell.operators import features as FE
    from tidewell.operators import relational as R

    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), (None, 5)], "k string, v int")
    shown = R.preview(rows, ["k"], "v", 2).collect()
    assert sorted((str(r.k), r.v, r.has_more) for r in shown) == [("None", 3, True), ("None", 4, True), ("a", 1, False), ("a", 2, False)]
    assert R.positional_zip(rows, rows.withColumnRenamed("v", "w"), "v", "w", "k").count() == 5
    assert R.splice_tail(rows, rows, "v", ["v"], "k").count() == 5
    assert FE.split(rows.withColumnRenamed("k", "c"), "v", "c").count() == 5


def test_maintenance_of_null_keys_and_repeats(spark):
    target = spark.createDataFrame([("x", 1), (None, 2)], "name string, id int")
    incoming = spark.createDataFrame([(None, 1), ("y", 2), (None, 3)], "name string, line int")
    once = D.insert_if_absent(target, incoming, "name", "id", ["line"])
    assert sorted((str(r.name), r.id) for r in once.select(F.col("name"), "id").collect()) == [("None", 2), ("x", 1), ("y", 3)]
    corpus = spark.createDataFrame([("t",), (None,)], "text string")
    more = spark.createDataFrame([(None, 1), ("u", 2), ("t", 3)], "text string, line int")
    assert [r.text for r in D.corpus_append(corpus, more, "text", ["line"]).collect()] == ["u"]
    people = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, name string, balance int")
    changes = spark.createDataFrame([(2, "b", 99, 1), (1, "b", 5, 1), (3, "d", None, 1), (3, None, 31, 2), (3, "e", None, 3)], "k int, name string, balance int, at int")
    got = sorted(map(tuple, D.update_by_key(people, changes, "k", "name", ["at"]).select("k", "name", "balance").collect()))
    assert got == [(1, "a", 10), (2, "b", 99), (3, "e", 31)]


def test_correlation_leaves_out_nan(spark):
    from tidewell.operators import aggregates as A

    df = spark.createDataFrame([(float(i), 2.0 * i if i else float("nan")) for i in range(9)], "a double, b double")
    assert abs(A.corr_matrix(df, ["a", "b"]).first().r - 1) < 1e-12


def test_features_with_holes_are_imputed(spark):
    from tidewell.operators import models as M

    df = spark.createDataFrame([(i, None if i == 3 else float(i), float("nan") if i == 4 else 1.0) for i in range(6)], "id int, a double, b double")
    assert M.assemble(df, ["a", "b"], ["id"]).count() == 6
