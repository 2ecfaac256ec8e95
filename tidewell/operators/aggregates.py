"""Grouped summaries, profiles, control limits, correlation and error metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .gram import pair_sums
from .ordered import _names, join_on_keys, quantiles


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows and percent of all rows per value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total, 2))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of each column as rows, with their counts."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bits: int = 14) -> DataFrame:
    """A mergeable sketch of each column's distinct values, per ``by``: store it, and merge instead of counting again."""
    long = df.select(*by, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(list(by), list(cols), "column_name", "value")
    return long.groupBy(*by, "column_name").agg(F.hll_sketch_agg("value", F.lit(bits)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Approximate number of distinct values per ``by`` and column from stored sketches (about 0.8 % error at 14 bits)."""
    merged = sketches.groupBy(*by, "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, "column_name", F.hll_sketch_estimate("sketch").alias("n_distinct"))


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, max and missing rate of each column in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"m{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
    facts = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("n_values"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            (1 - F.try_divide(f"n{i}", "rows")).alias("missing_rate"),
        )
        for i, c in enumerate(cols)
    ]
    return facts.select(F.inline(F.array(*rows)))


def unpivot_numbers(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return doubles.unpivot(list(ids), list(cols), "column_name", "value")


def column_profile(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), exact: bool = True
) -> DataFrame:
    """Summary and quantiles of each numeric column; ``exact=False`` uses bounded sketches."""
    stats = numeric_summary(df, cols)
    if exact:
        q = quantiles(unpivot_numbers(df, cols), "value", probs, "column_name").drop("n")
    else:
        arrays = df.agg(
            *[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), list(probs), 10_000).alias(c) for c in cols]
        )
        q = arrays.unpivot([], list(cols), "column_name", "__a").select(
            "column_name", *[F.col("__a")[i].alias(f"q{i}") for i in range(len(probs))]
        )
    return stats.join(q, "column_name", "left")


def group_summary(df: DataFrame, by: str, value: str, flag: Column | None = None) -> DataFrame:
    """mean, std, min, max and, with ``flag``, percent of flagged rows per group."""
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    if flag is not None:
        aggs.append((F.avg(flag.cast("double")) * 100).alias("flag_rate"))
    return df.groupBy(by).agg(*aggs)


def flag_rate(df: DataFrame, by: str, flag: Column) -> DataFrame:
    """Percent of flagged rows per group and over all rows (``__all__``)."""
    one = df.select(F.col(by).cast("string").alias(by), flag.cast("double").alias("__f"))
    both = one.rollup(by).agg(F.grouping(by).alias("__all"), F.sum("__f").alias("__s"), F.count("__f").alias("n"))
    name = F.when(F.col("__all") == 1, F.lit("__all__")).otherwise(F.col(by))
    return both.select(name.alias(by), "n", (F.try_divide("__s", F.col("n")) * 100).alias("rate"))


def zscore_outliers(df: DataFrame, cols: Sequence[str], z: float = 3.0) -> DataFrame:
    """Values more than ``z`` population deviations from the mean, per column."""
    num = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    stats = df.agg(*[F.struct(F.avg(num(c)).alias("m"), F.stddev_pop(num(c)).alias("s")).alias(c) for c in cols])
    fit = stats.select(F.struct(*cols).alias("f")).scalar()
    counts = df.withColumn("__fit", fit).agg(
        *[
            F.count_if(
                (F.col(f"__fit.{c}.s") > 0) & (F.abs(num(c) - F.col(f"__fit.{c}.m")) / F.col(f"__fit.{c}.s") > z)
            ).alias(c)
            for c in cols
        ]
    )
    return counts.unpivot([], list(cols), "column_name", "n_outliers")


def top_std(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """``n`` columns with the largest sample deviation."""
    stats = numeric_summary(df, cols).select("column_name", "std")
    return stats.orderBy(F.desc_nulls_last("std"), "column_name").limit(n)


def control_limits(df: DataFrame, value: str, by=None, k: float = 3.0) -> DataFrame:
    """Mean and mean +- k sample deviations, per group or overall."""
    out = df.groupBy(*_names(by)).agg(
        F.avg(value).alias("center"), F.stddev_samp(value).alias("sigma"), F.count(value).alias("n")
    )
    return out.withColumn("lcl", F.col("center") - k * F.col("sigma")).withColumn("ucl", F.col("center") + k * F.col("sigma"))


def out_of_control(df: DataFrame, value: str, by=None, k: float = 3.0) -> DataFrame:
    """Rows outside their control limits."""
    keys = _names(by)
    limits = control_limits(df, value, keys, k).select(*keys, "lcl", "ucl")
    if keys:
        rows = join_on_keys(df, limits, keys)
    else:
        rows = df.withColumn("__l", limits.select(F.struct("lcl", "ucl")).scalar()).select("*", "__l.*").drop("__l")
    return rows.filter((F.col(value) < F.col("lcl")) | (F.col(value) > F.col("ucl")))


def _number(name: str) -> Column:
    """Column as double with NaN as null: correlations leave out rows where either side has no number."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every two columns over rows where both are numbers, undefined as 0; one scan."""
    names = F.array(*map(F.lit, cols))
    s = pair_sums(df, cols)
    spread_a, spread_b = (F.col("n") * F.col(q + q) - F.col(q) * F.col(q) for q in "ab")
    flat = lambda spread, q: spread <= F.lit(1e-14) * F.col("n") * F.col(q + q)  # nothing but rounding
    r = (F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(spread_a * spread_b)
    r = F.when((F.col("n") > 0) & ~flat(spread_a, "a") & ~flat(spread_b, "b"), r).otherwise(F.lit(0.0))
    r = F.coalesce(F.nanvl(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)), F.lit(0.0)), F.lit(0.0))
    one = s.select("i", "j", r.alias("r"))
    both = one.select(F.inline(F.array(F.struct("i", "j", "r"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r"))))
    name = lambda c: F.get(names, F.col(c).cast("int"))
    return both.select(name("i").alias("col_a"), name("j").alias("col_b"), "i", "j", "r")


def corr_pairs(df: DataFrame, cols: Sequence[str], min_abs: float = 0.8, top: int = 15) -> DataFrame:
    """First ``top`` strongly correlated pairs in matrix order, both directions."""
    strong = corr_matrix(df, cols).filter(F.abs("r") > min_abs)
    return strong.orderBy("i", "j").limit(top).select("col_a", "col_b", "r")


def corr_with_label(df: DataFrame, cols: Sequence[str], label: Column, min_abs: float = 0.3) -> DataFrame:
    y = F.nanvl(label.cast("double"), F.lit(None))
    facts = df.agg(*[F.corr(_number(c), y).alias(c) for c in cols])
    return facts.unpivot([], list(cols), "column_name", "r").filter(F.abs("r") > min_abs)


def threshold_rows(df: DataFrame, limits: DataFrame, group: str, params: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Readings outside the limits of their (group, param)."""
    long = df.unpivot([group, *ids], list(params), "param", "reading")
    joined = long.join(limits, [group, "param"])
    return joined.filter((F.col("reading") < F.col("lower")) | (F.col("reading") > F.col("upper")))


def threshold_violations(df: DataFrame, limits: DataFrame, group: str, params: Sequence[str]) -> DataFrame:
    """Counts below and above per (group, param) with the extremes; groups without limits are listed."""
    long = df.unpivot([group], list(params), "param", "reading")
    joined = long.join(limits, [group, "param"], "left")
    known = F.col("lower").isNotNull() | F.col("upper").isNotNull()
    below, above = F.col("reading") < F.col("lower"), F.col("reading") > F.col("upper")
    return joined.groupBy(group, "param").agg(
        F.max(known).alias("has_limits"),
        F.count_if(below).alias("n_below"),
        F.count_if(above).alias("n_above"),
        F.min(F.when(below, F.col("reading"))).alias("min_below"),
        F.max(F.when(above, F.col("reading"))).alias("max_above"),
        F.count_if(below | above).alias("n_total"),
    )


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whisker ends inside 1.5 IQR and outliers per group."""
    q = quantiles(df, value, (0.25, 0.5, 0.75), by)
    q = q.withColumn("__lo", F.col("q0") - 1.5 * (F.col("q2") - F.col("q0")))
    q = q.withColumn("__hi", F.col("q2") + 1.5 * (F.col("q2") - F.col("q0")))
    rows = join_on_keys(df.select(by, value).filter(F.col(value).isNotNull()), q, [by])
    inside = F.col(value).between(F.col("__lo"), F.col("__hi"))
    return rows.groupBy(by).agg(
        F.first("q0").alias("q1"),
        F.first("q1").alias("median"),
        F.first("q2").alias("q3"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum, the maximum in the last bin, empty bins as 0."""
    spark = df.sparkSession
    num = df.select(F.nanvl(F.col(value).cast("double"), F.lit(None)).alias("v")).filter("v IS NOT NULL")
    lo, hi = F.min("v"), F.max("v")
    flat = F.min("v") == F.max("v")
    edge = num.agg(
        F.struct(F.when(flat, lo - 0.5).otherwise(lo).alias("lo"), F.when(flat, hi + 0.5).otherwise(hi).alias("hi")).alias("e")
    ).scalar()
    placed = num.withColumn("e", edge)
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    slot = F.least(F.floor((F.col("v") - F.col("e.lo")) / width), F.lit(bins - 1)).cast("bigint")
    counts = placed.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).withColumnRenamed("id", "bin").withColumn("e", edge)
    out = grid.join(counts, "bin", "left")
    return out.select("bin", (F.col("e.lo") + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def error_metrics(df: DataFrame, actual: str, predicted: str, by=None, eps: float = 1e-8) -> DataFrame:
    """MAE, RMSE, largest and smallest error, and MAPE over rows with |actual| > eps."""
    err = F.col(actual) - F.col(predicted)
    share = F.when(F.abs(actual) > eps, F.abs(err / (F.col(actual) + eps)))
    return df.groupBy(*_names(by)).agg(
        F.count(err).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.max(F.abs(err)).alias("max_error"),
        F.min(F.abs(err)).alias("min_error"),
        F.coalesce(F.avg(share) * 100, F.lit(0.0)).alias("mape"),
    )


def column_lists(df: DataFrame, cols: Sequence[str], order_by, chunk: int = 1000) -> DataFrame:
    """Non-null values of each column as arrays of at most ``chunk``, in order.

    A long column becomes several rows (``part`` 0, 1, ...), so no array grows with the table.
    """
    from .ordered import with_position

    order = list(order_by)
    long = df.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *[F.col(c).cast("string").alias(c) for c in cols])
    ids = [f"__o{i}" for i in range(len(order))]
    long = long.unpivot(ids, list(cols), "column_name", "value").filter(F.col("value").isNotNull())
    placed = with_position(long, ids, "column_name")
    part = F.floor((F.col("rn") - 1) / chunk).alias("part")
    pairs = placed.groupBy("column_name", part).agg(F.sort_array(F.collect_list(F.struct("rn", "value"))).alias("p"))
    return pairs.select("column_name", "part", F.col("p.value").alias("items"))


def side_by_side(scores: DataFrame, metric: str, variant: str, value: str, variants: Sequence[str]) -> DataFrame:
    """Mean of each metric per variant as columns, 0.0 where a variant has none."""
    out = scores.groupBy(metric).pivot(variant, list(variants)).agg(F.avg(value))
    return out.na.fill(0.0, list(variants))


def even_square_sum(df: DataFrame, col: str) -> DataFrame:
    """Sum of squares of the even numbers, exact beyond 64 bits."""
    n = F.col(col).cast("decimal(19,0)")
    return df.filter(F.col(col) % 2 == 0).agg(F.sum((n * n).cast("decimal(38,0)")).alias("total"))
