"""Positions, neighbour windows, scans and quantiles on skewed keys and small runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.operators import ordered as O


def skewed(spark, n=2000, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.4, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.normal(size=n), 1)
    pdf = pd.DataFrame({"key": key, "id": rng.permutation(n), "t": rng.integers(0, 50, n), "v": v})
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    pdf, df = skewed(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = O.with_position(df, ["t", "id"], "key").toPandas().set_index("id")["rn"].sort_index()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = pdf.sort_values(["t", "id"]).assign(rn=lambda d: d.groupby("key").cumcount() + 1).set_index("id")["rn"].sort_index()
    assert got.tolist() == want.tolist()


def test_null_keys_and_values_get_positions(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None), ("a", 3)], "k string, v int")
    got = sorted((r.k or "", r.v or 9, r.rn) for r in O.with_position(df, ["v"], "k").collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 3, 1), ("a", 9, 2)]


@pytest.mark.parametrize("size", [3, 7, 10_000])
def test_neighbours_equal_plain_window(spark, size):
    pdf, df = skewed(spark, 500)
    placed = O.with_position(df, ["t", "id"], "key")
    made = O.neighbours(
        placed, "key", "rn",
        lambda w: {"s": F.sum("v").over(w.rowsBetween(-3, 2)), "nxt": F.lead("v", 2).over(w)}, before=3, after=2, size=size,
    ).toPandas().set_index("id").sort_index()
    ordered = pdf.sort_values(["t", "id"])
    parts = []
    for _, g in ordered.groupby("key"):
        v = g["v"].to_numpy()
        s = [v[max(0, i - 3) : i + 3].sum() for i in range(len(v))]
        parts.append(pd.DataFrame({"id": g["id"], "s": s, "nxt": g["v"].shift(-2)}))
    want = pd.concat(parts).set_index("id").sort_index()
    assert np.allclose(made["s"], want["s"])
    assert np.allclose(made["nxt"].astype(float).fillna(-99), want["nxt"].fillna(-99))


@pytest.mark.parametrize("size", [2, 5, 10_000])
def test_scan_carries_across_runs(spark, size):
    pdf, _ = skewed(spark, 400)
    pdf["w"] = pdf["v"].where(pdf["id"] % 5 == 0)
    df = spark.createDataFrame(pdf).withColumn("w", F.nanvl("w", F.lit(None)))
    placed = O.with_position(df, ["t", "id"], "key")
    got = O.scan(placed, "key", "rn", sums={"c": F.col("v")}, last={"l": F.col("w")}, first={"f": F.col("w")}, size=size)
    got = got.toPandas().set_index("id").sort_index()
    o = pdf.sort_values(["t", "id"])
    g = o.groupby("key")
    want = o.assign(c=g["v"].cumsum(), l=g["w"].ffill(), f=g["w"].bfill()).set_index("id").sort_index()
    for c in ("c", "l", "f"):
        assert np.allclose(got[c].astype(float).fillna(-9), want[c].fillna(-9)), c


@pytest.mark.parametrize("probs", [(0.0, 0.5, 1.0), (0.25, 0.333, 0.9)])
def test_quantiles_interpolate(spark, probs):
    pdf, df = skewed(spark, 777)
    df = df.unionByName(df.limit(1).withColumn("v", F.lit(float("nan")))).unionByName(df.limit(1).withColumn("v", F.lit(None).cast("double")))
    got = {r["key"]: r for r in O.quantiles(df, "v", probs, "key").collect()}
    for key, g in pdf.groupby("key"):
        assert got[key]["n"] == len(g)
        assert np.allclose([got[key][f"q{i}"] for i in range(len(probs))], np.quantile(g["v"], probs))
    one = O.quantiles(df, "v", (0.5,)).first()
    assert one["q0"] == pytest.approx(pdf["v"].median())
