"""Feature preparation, splits, thresholds and metrics on scored rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import det
from .aggregates import unpivot_numbers
from .ordered import _names, join_on_keys, quantiles, scan, with_position

# Cumulative probabilities of a Poisson(1) count, up to a tail below 1e-10.
POISSON1 = tuple(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) for i in range(13))


# -- preparation -------------------------------------------------------------------------


def _num(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None))


def fit_medians(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row holding the exact median of each column."""
    q = quantiles(unpivot_numbers(train, cols), "value", (0.5,), "column_name")
    return q.agg(*[F.max(F.when(F.col("column_name") == c, F.col("q0"))).alias(c) for c in cols])


def impute(df: DataFrame, medians: DataFrame, cols: Sequence[str]) -> DataFrame:
    fit = medians.select(F.struct(*cols)).scalar()
    out = df.withColumn("__fit", fit)
    return out.withColumns({c: F.coalesce(_num(c), F.col(f"__fit.{c}")) for c in cols}).drop("__fit")


def fit_standard(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column; a constant column keeps scale 1."""
    dev = lambda c: F.when(F.stddev_pop(_num(c)) == 0, F.lit(1.0)).otherwise(F.stddev_pop(_num(c)))
    return train.agg(*[F.struct(F.avg(_num(c)).alias("m"), dev(c).alias("s")).alias(c) for c in cols])


def standardize(df: DataFrame, fit: DataFrame, cols: Sequence[str]) -> DataFrame:
    out = df.withColumn("__fit", fit.select(F.struct(*cols)).scalar())
    return out.withColumns({c: (_num(c) - F.col(f"__fit.{c}.m")) / F.col(f"__fit.{c}.s") for c in cols}).drop("__fit")


def interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Products of every two different columns, without squares or a constant."""
    return df.withColumns({f"{a}*{b}": F.col(a) * F.col(b) for a, b in combinations(cols, 2)})


def label_encode(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """Position of each value among the sorted distinct values, from 0."""
    classes = with_position(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], name="__p")
    return df.join(classes.select(col, (F.col("__p") - 1).alias(name)), col, "left")


# -- splits ------------------------------------------------------------------------------


def split(
    df: DataFrame, key: str, label: str | None = None, time_col: str | None = None, test: float = 0.2, seed: int = 42
) -> DataFrame:
    """``part`` train or test: the latest rows by time, else a hash draw, exact inside each class of ``label``."""
    by = _names(label) if time_col is None else []
    draw = F.col(time_col) if time_col else det.hash52(key, str(seed))
    placed = with_position(df.withColumn("__draw", draw), ["__draw", key], by)
    sizes = placed.groupBy(*by).agg(F.max("rn").alias("__n"))
    placed = join_on_keys(placed, sizes, by) if by else placed.withColumn("__n", sizes.scalar())
    held = F.ceil(F.col("__n") * test)
    is_test = F.col("rn") > F.col("__n") - held if time_col else F.col("rn") <= held
    return placed.withColumn("part", F.when(is_test, "test").otherwise("train")).drop("__draw", "__n", "rn")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Fold 0..k-1 by hash rank inside each class."""
    placed = with_position(df.withColumn("__draw", det.hash52(key, str(seed))), ["__draw", key], label)
    return placed.withColumn("fold", F.pmod(F.col("rn") - 1, F.lit(k))).drop("__draw", "rn")


def bootstrap(df: DataFrame, key: str, seeds: Sequence[int]) -> DataFrame:
    """Row weights per model: a draw with replacement gives each row a Poisson(1) count.

    The count depends only on the row and the seed, so it is the same on a retried task.
    """
    rows = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    u = det.uniform(F.concat_ws(":", F.col("seed").cast("string"), F.col(key).cast("string")))
    rows = rows.withColumn("__u", u)
    weight = sum((F.when(F.col("__u") >= p, 1).otherwise(0) for p in POISSON1), F.lit(0))
    return rows.withColumn("weight", weight).drop("__u").filter("weight > 0")


# -- scores ------------------------------------------------------------------------------


def f1_threshold_sweep(df: DataFrame, label: str, score: str, lo: float = 0.05, hi: float = 0.95, steps: int = 181) -> DataFrame:
    """F1 of class 1 at evenly spaced cut-offs, the first best one marked.

    Rows are counted by the highest cut-off they pass; only ``steps`` counts are then summed.
    """
    spark = df.sparkSession
    width = (hi - lo) / (steps - 1)
    at = lambda i: i * F.lit(width) + F.lit(lo)
    s = F.col(score)
    near = F.floor((s - lo) / width)
    passed = F.when(s >= at(near + 1), near + 1).when(s >= at(near), near).otherwise(near - 1)
    passed = F.least(passed, F.lit(steps - 1)).cast("bigint")
    counts = df.groupBy(passed.alias("i")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("p"), F.sum((F.col(label) != 1).cast("bigint")).alias("q")
    )
    positives = df.agg(F.sum((F.col(label) == 1).cast("bigint"))).scalar()
    grid = spark.range(steps).withColumnRenamed("id", "i").join(counts.filter("i >= 0"), "i", "left").na.fill(0, ["p", "q"])
    w = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    curve = grid.select("i", at(F.col("i")).alias("threshold"), F.sum("p").over(w).alias("tp"), F.sum("q").over(w).alias("fp"))
    curve = curve.withColumn("fn", positives - F.col("tp"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    curve = curve.withColumn("f1", f1)
    first = F.row_number().over(Window.orderBy(F.desc("f1"), "i"))
    return curve.withColumn("is_best", first == 1).drop("i")


def ensemble_vote(scores: DataFrame, key: str, proba: str, cut: float) -> DataFrame:
    out = scores.groupBy(key).agg(F.avg(proba).alias("proba"))
    return out.withColumn("output", (F.col("proba") >= cut).cast("int"))


def quantile_flags(df: DataFrame, score: str, lo: float = 0.90, hi: float = 0.995, steps: int = 12) -> DataFrame:
    """Rows at or above each of ``steps`` quantiles of their scores."""
    probs = [lo + i * (hi - lo) / (steps - 1) for i in range(steps)]
    q = quantiles(df.select(score), score, probs)
    cuts = q.select(F.array(*[f"q{i}" for i in range(steps)])).scalar()
    counts = df.withColumn("__q", cuts).agg(
        F.first("__q").alias("__q"), *[F.count_if(F.col(score) >= F.col("__q")[i]).alias(f"n{i}") for i in range(steps)]
    )
    rows = [
        F.struct(F.lit(p).alias("quantile"), F.col("__q")[i].alias("threshold"), F.col(f"n{i}").alias("flagged"))
        for i, p in enumerate(probs)
    ]
    return counts.select(F.inline(F.array(*rows)))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined ratios are 0."""
    cells = confusion(df, actual, predicted)
    sides = F.array(
        F.struct(F.col(actual).alias("label"), F.lit(1).alias("a"), F.lit(0).alias("p")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).alias("a"), F.lit(1).alias("p")),
    )
    hit = (F.col(actual) == F.col(predicted)).cast("bigint") * F.col("n")
    rows = cells.select(hit.alias("hit"), "n", F.inline(sides))
    out = rows.groupBy("label").agg(
        F.sum(F.col("a") * F.col("n")).alias("support"),
        F.sum(F.col("p") * F.col("n")).alias("predicted"),
        F.sum(F.col("a") * F.col("hit")).alias("hits"),
    )
    zero = F.lit(0.0)
    out = out.withColumn("precision", F.coalesce(F.try_divide("hits", "predicted"), zero))
    out = out.withColumn("recall", F.coalesce(F.try_divide("hits", "support"), zero))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    return out.withColumn("f1", f1).drop("hits", "predicted")


def _cumulated(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score and up to it, from the highest score down."""
    per = df.groupBy(F.col(score).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("p"), F.sum((F.col(label) != 1).cast("bigint")).alias("q")
    )
    placed = with_position(per, [F.col("score").desc()])
    return scan(placed, None, "rn", sums={"tp": F.col("p"), "fp": F.col("q")})


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at each distinct score."""
    cum = _cumulated(df, label, score)
    total = cum.agg(F.struct(F.sum("p").alias("p"), F.sum("q").alias("q"))).scalar()
    cum = cum.withColumn("__t", total)
    return cum.select("score", F.try_divide("fp", "__t.q").alias("fpr"), F.try_divide("tp", "__t.p").alias("tpr"))


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC (chance that a positive outscores a negative, ties counted half) and average
    precision (precision times the gain in recall, over distinct scores), from one pass."""
    won = F.sum(F.col("q") * (F.col("tp") - F.col("p") / 2.0))
    gained = F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return _cumulated(df, label, score).agg(
        F.try_divide(won, (F.sum("p") * F.sum("q")).cast("double")).alias("roc_auc"),
        F.try_divide(gained, F.sum("p").cast("double")).alias("avg_precision"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("roc_auc")


def avg_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("avg_precision")


def regression_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """R2, MAE and RMSE."""
    err = F.col(actual) - F.col(predicted)
    sst = F.var_pop(actual) * F.count(actual)
    return df.agg(
        F.count(err).alias("n"),
        (1 - F.try_divide(F.sum(err * err), sst)).alias("r2"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def latest_runs(log: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str]) -> DataFrame:
    """Last logged value per key of an append-only run table."""
    return log.groupBy(*keys).agg(F.max_by(value, F.struct(*order_by)).alias(value), F.count(F.lit(1)).alias("n_logged"))
