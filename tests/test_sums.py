"""Gram matrices, bracketed quantiles, lag models and isolation trees against NumPy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import aggregates as A
from tidewell.operators import gram as G
from tidewell.operators import models as M
from tidewell.operators import ordered as O
from tidewell.operators import series as T


def test_gram_sums_per_key(spark):
    g = np.random.default_rng(1)
    rows = [(None if i % 4 == 0 else f"k{i % 3}", [float(v) for v in g.normal(size=3)], float(g.normal())) for i in range(200)]
    bad = [("k0", [1.0, None, 2.0], 1.0), ("k1", [1.0, 2.0, 3.0], None), ("k2", [float("nan"), 1.0, 1.0], 1.0)]
    df = spark.createDataFrame(rows + bad, "k string, x array<double>, y double").repartition(5)
    for r in G.gram_by_key(df, ["k"], "x", "y").collect():
        z = np.array([[1.0, *x, y] for k, x, y in rows if k == r.k])
        assert np.allclose(r.gram, (z.T @ z)[np.triu_indices(5)])
        n, w, rmse = G.solve(r.gram)
        assert n == len(z) and np.allclose(w, np.linalg.lstsq(z[:, :-1], z[:, -1], rcond=None)[0])
        assert rmse == pytest.approx(float(np.sqrt(np.mean((z[:, -1] - z[:, :-1] @ w) ** 2))))


def test_correlations_of_two_hundred_columns_are_pairwise_complete(spark):
    g = np.random.default_rng(2)
    x = g.normal(size=(120, 200)) * 10.0 ** g.integers(-3, 6, 200) + 1e4 * g.integers(0, 3, 200)
    x[:, 7] = x[:, 3] * 2
    x[:, 9] = 5.0
    x[g.random(x.shape) < 0.1] = np.nan
    x[:, 11] = np.nan
    names = [f"c{i}" for i in range(200)]
    want = pd.DataFrame(x, columns=names).corr().fillna(0.0).to_numpy()
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(3)
    got = A.corr_matrix(df, names).collect()
    assert len(got) == 200 * 199
    assert max(abs(r.r - want[r.i, r.j]) for r in got) < 1e-7
    plan = A.corr_matrix(df, names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


@pytest.mark.parametrize("accuracy", [4, 50, 2000])
def test_quantiles_inside_brackets_are_exact(spark, accuracy):
    g = np.random.default_rng(4)
    data = {"n": g.normal(size=3000), "ties": g.integers(0, 5, 2500).astype(float), "one": np.array([7.0]), "skew": g.pareto(0.4, 1500), "flat": np.full(300, 2.0)}
    rows = [(k, float(v)) for k, values in data.items() for v in values] + [("n", None), ("n", float("nan")), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    probs = (0.0, 0.1, 0.5, 0.995, 1.0)
    got = {r.k: r for r in O.quantiles(df, "v", probs, "k", accuracy=accuracy).collect()}
    assert set(got) == {*data, None}
    for k, values in {**data, None: np.array([3.0, 5.0])}.items():
        assert got[k].n == len(values)
        assert [got[k][f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(values, probs).tolist(), rel=1e-12)
    whole = O.quantiles(df, "v", (0.25,), accuracy=accuracy).first()
    assert whole.q0 == pytest.approx(np.quantile(np.concatenate([*data.values(), [3.0, 5.0]]), 0.25))
    assert O.quantiles(df.limit(0), "v", (0.5,), "k").collect() == []


def test_brackets_cut_what_is_shuffled(spark):
    df = spark.range(60_000).select((F.xxhash64("id") / 1e10).alias("v"))
    inside, placed = O._enclosed(df, "v", (0.25, 0.5, 0.75), [], 2000)
    assert inside.count() < 0.02 * 3 * 60_000 and placed.count() == 3


def test_missed_brackets_fall_back_to_all_values(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(500)], "v double")
    real = O._brackets

    def wrong(usable, value, probs, keys, accuracy):
        ends = real(usable, value, probs, keys, accuracy)
        return ends if accuracy > 10_000 else ends.withColumn("__ends", F.transform("__ends", lambda e: F.struct(e["i"].alias("i"), F.lit(490.0).alias("lo"), F.lit(495.0).alias("hi"))))

    monkeypatch.setattr(O, "_brackets", wrong)
    assert O.quantiles(df, "v", (0.5,), accuracy=100).first().q0 == 249.5


def test_lag_model_recovers_its_weights(spark):
    g = np.random.default_rng(6)
    rows = []
    for s, (w0, w) in {"a": (1.0, [0.3, -0.2, 0.5]), "b": (-2.0, [0.1, 0.0, 0.8])}.items():
        v = g.normal(size=3).tolist()
        for _ in range(400):
            v.append(w0 + sum(a * b for a, b in zip(w, v[-3:])) + 0.1 * g.normal())
        rows += [(s, i, float(x)) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "s string, i int, v double")
    fits = M.solve_lag_linear(M.lag_statistics(df, "v", ["i"], "s", 3), "s")
    for r in fits.collect():
        v = np.array([x for s, _, x in rows if s == r.s])
        z = np.column_stack([np.ones(len(v) - 3), v[:-3], v[1:-2], v[2:-1]])
        assert r.n == 400 and np.allclose(r.weights, np.linalg.lstsq(z, v[3:], rcond=None)[0])
    scored = T.one_step_score(df, "v", ["i"], "s", 3, T.lag_linear, params=fits.select("s", "weights"))
    assert scored.columns == ["s", "i", "v", "rn", "predicted", "error"]
    assert scored.filter("i >= 3").agg(F.sqrt(F.avg(F.col("error") * F.col("error")))).first()[0] == pytest.approx(0.1, abs=0.02)
    ahead = T.multi_step(df, "v", ["i"], "s", 3, 4, T.lag_linear, fits.select("s", "weights")).orderBy("s", "step").collect()
    w = {r.s: r.weights for r in fits.collect()}
    for s in "ab":
        v = [x for k, _, x in rows if k == s]
        for r in [r for r in ahead if r.s == s]:
            v.append(w[s][0] + sum(a * b for a, b in zip(w[s][1:], v[-3:])))
            assert r.predicted == pytest.approx(v[-1])


def test_merged_statistics_equal_those_of_all_rows(spark):
    g = np.random.default_rng(8)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(g.normal(size=300))], "s string, i int, v double")
    fits = {r.phase: r for r in M.retrain_lag_linear(df.withColumn("late", F.col("i") >= 200), "v", ["i"], "s", 5, "late").collect()}
    whole = M.solve_lag_linear(M.lag_statistics(df, "v", ["i"], "s", 5), "s").first()
    assert fits["original"].n == 195 and fits["retrained"].n == 295 and np.allclose(fits["retrained"].weights, whole.weights)


@pytest.mark.parametrize("n", [3, 120, 3000])
def test_isolation_trees_put_planted_rows_on_top(spark, n):
    g = np.random.default_rng(9)
    rows = [(i, *(float(v) for v in g.normal(size=3))) for i in range(n)] + [(n + i, 12.0 + i, -15.0, 20.0 + i) for i in range(2)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    got = M.isolation_scores(df, "id", ["a", "b", "c"], trees=60, sample=128)
    scores = {r.id: r.score for r in got.collect()}
    assert set(scores) == {r[0] for r in rows} and all(0 < s < 1 for s in scores.values())
    if n > 3:
        assert sorted(scores, key=scores.get)[-2:] in ([n, n + 1], [n + 1, n])
    again = {r.id: r.score for r in M.isolation_scores(df.repartition(7), "id", ["a", "b", "c"], trees=60, sample=128).collect()}
    assert again == scores


def test_trees_get_their_samples(spark):
    numbers = spark.range(20_000).select("id", F.col("id").cast("double").alias("__x0"))
    dealt = M.deal_to_trees(numbers, ["id"], ["__x0"], 50, 64, 1).groupBy("tree").count().collect()
    assert len(dealt) == 50 and all(64 <= r["count"] <= 200 for r in dealt)


def test_fits_beside_each_other_give_the_same_scores(spark):
    g = np.random.default_rng(11)
    rows = [(i, float(g.normal() + i % 2), float(g.normal()), i % 2) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y int")
    scores = [{r.id: r.proba for r in M.oof_scores(df, "id", ["a", "b"], "y", k=2, n_models=2, trees=4, at_once=n).collect()} for n in (1, 4)]
    assert scores[0] == scores[1] and len(scores[0]) == 150
