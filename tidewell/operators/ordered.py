"""Dense positions, neighbour windows, running totals and exact quantiles.

A plain window over a key puts every row of that key into one task.  Here each key is
cut into runs of at most ``size`` consecutive rows, so a key that holds a third of the
table is spread like any other:

* ``with_position`` numbers rows by a range shuffle and per-partition offsets,
* ``neighbours`` copies the few edge rows a frame needs into the adjoining run,
* ``scan`` combines a window inside each run with one summary row per run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

RUN = 100_000


def _names(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _order(order_by) -> list[Column]:
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in items]


def earliest(order_by: Sequence[str]) -> Column:
    """Smallest order value of a group; one column keeps its own type, so that hash aggregation can be used."""
    return F.min(order_by[0]) if len(order_by) == 1 else F.min(F.struct(*order_by))


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where a null key matches a null key; right key columns are dropped."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = test if cond is None else cond & test
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_position(df: DataFrame, order_by, by=None, name: str = "rn") -> DataFrame:
    """Number rows 1..n inside each key.  ``order_by`` has to end in a unique column.

    The range shuffle includes the order columns, so a hot key covers many partitions.
    The settled rows are numbered from one offset per (key, partition).
    """
    keys = _names(by)
    order = _order(order_by)
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys], *order)
    ranged = ranged.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], *order)
    ranged = settle(ranged.withColumn("__wp_m", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("__wp_part", F.shiftright("__wp_m", 33))
    starts = ranged.groupBy(*keys, "__wp_part").agg(F.count(F.lit(1)).alias("__wp_c"), F.min("__wp_m").alias("__wp_m0"))
    before = Window.partitionBy(*keys).orderBy("__wp_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        *keys, "__wp_part", (F.coalesce(F.sum("__wp_c").over(before), F.lit(0)) - F.col("__wp_m0") + 1).alias("__wp_shift")
    )
    out = join_on_keys(ranged, starts, [*keys, "__wp_part"])
    return out.withColumn(name, F.col("__wp_m") + F.col("__wp_shift")).drop("__wp_m", "__wp_part", "__wp_shift")


def neighbours(
    df: DataFrame, by, pos: str, make, before: int = 0, after: int = 0, size: int = RUN, keep: Column | None = None
) -> DataFrame:
    """Add window columns that look at most ``before``/``after`` positions away.

    ``make(window)`` returns ``{name: Column}`` for a window ordered by ``pos``.
    No task sees more than ``size + before + after`` rows of a key.
    """
    keys = _names(by)
    size = max(size, before, after, 1)
    slot, run = F.pmod(F.col(pos) - 1, F.lit(size)), F.floor((F.col(pos) - 1) / size)
    copies = [F.struct(run.alias("run"), F.lit(True).alias("own"))]
    if before:
        copies.append(F.when(slot >= size - before, F.struct((run + 1).alias("run"), F.lit(False).alias("own"))))
    if after:
        copies.append(F.when((slot < after) & (run > 0), F.struct((run - 1).alias("run"), F.lit(False).alias("own"))))
    cut = df.withColumn("__h", F.explode(F.array_compact(F.array(*copies))))
    cut = cut.withColumn("__run", F.col("__h.run")).withColumn("__own", F.col("__h.own")).drop("__h")
    w = Window.partitionBy(*keys, "__run").orderBy(pos)
    out = cut.select("*", *[c.alias(n) for n, c in make(w).items()]).filter("__own")
    if keep is not None:
        out = out.filter(keep)
    return out.drop("__run", "__own")


def scan(
    df: DataFrame,
    by,
    pos: str,
    sums: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    first: Mapping[str, Column] | None = None,
    size: int = RUN,
) -> DataFrame:
    """Running sums, last non-null so far and next non-null, over whole keys.

    Each run gets two extra rows, one before it with what earlier runs add up to and one after
    it with the next known value, so a single window over runs (one shuffle, no join) does the
    rest.  The window over run summaries has one row for every ``size`` rows of a key.
    """
    keys = _names(by)
    sums, last, first = dict(sums or {}), dict(last or {}), dict(first or {})
    inputs = {f"__v{i}": c for i, c in enumerate([*sums.values(), *last.values(), *first.values()])}
    base = df.withColumns({"__run": F.floor((F.col(pos) - 1) / size), "__own": F.lit(True), **inputs})
    cols = list(inputs)
    s_cols, l_cols = cols[: len(sums)], cols[len(sums) : len(sums) + len(last)]
    f_cols = cols[len(sums) + len(last) :]

    seen = lambda c, pick: pick(c, F.when(F.col(c).isNotNull(), F.col(pos)))
    runs = base.groupBy(*keys, "__run").agg(
        *[F.sum(c).alias(c) for c in s_cols],
        *[seen(c, F.max_by).alias(c) for c in l_cols],
        *[seen(c, F.min_by).alias(c) for c in f_cols],
    )
    up, down = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("__run"), F.desc("__run")))
    extra = []
    if s_cols or l_cols:
        carried = [F.sum(c).over(up).alias(c) for c in s_cols] + [F.last(c, True).over(up).alias(c) for c in l_cols]
        extra.append(runs.select(*keys, "__run", F.lit(0).cast("bigint").alias(pos), F.lit(False).alias("__own"), *carried))
    if f_cols:
        # "Next" is "last" in descending order: a frame that only shrinks is recomputed for every row.
        carried = [F.last(c, True).over(down).alias(c) for c in f_cols]
        extra.append(runs.select(*keys, "__run", F.lit(2**62).alias(pos), F.lit(False).alias("__own"), *carried))
    for rows in extra:
        base = base.unionByName(rows, allowMissingColumns=True)
    forth, back = (
        Window.partitionBy(*keys, "__run").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc(pos), F.desc(pos))
    )
    made = {}
    for out, c in zip(sums, s_cols):
        made[out] = F.coalesce(F.sum(c).over(forth), F.lit(0))
    for out, c in zip(last, l_cols):
        made[out] = F.last(c, True).over(forth)
    for out, c in zip(first, f_cols):
        made[out] = F.last(c, True).over(back)
    return base.withColumns(made).filter("__own").drop("__run", "__own", *cols)


def _brackets(usable: DataFrame, value: str, probs: Sequence[float], keys: list[str], accuracy: int) -> DataFrame:
    """Per key the number of values and, for each probability, two values that should enclose it.

    The sketches are merged by Spark and miss a rank by ``1 / accuracy`` of the rows; the brackets allow four
    times that.  Keys of at most ``accuracy`` rows have no bracket: all their values are taken.
    """
    wide = 4.0 / accuracy
    marks = [min(1.0, max(0.0, p + d)) for p in probs for d in (-wide, wide)]
    sketch = usable.groupBy(*keys).agg(F.count(F.lit(1)).alias("__total"), F.percentile_approx(value, marks, accuracy).alias("__q"))
    many = F.col("__total") > accuracy
    at = lambda k: F.when(many, F.get("__q", k))
    ends = [F.struct(F.lit(i).alias("i"), at(2 * i).alias("lo"), at(2 * i + 1).alias("hi")) for i in range(len(probs))]
    return sketch.select(*keys, "__total", F.array(*ends).alias("__ends"))


def _enclosed(usable: DataFrame, value: str, probs: Sequence[float], keys: list[str], accuracy: int) -> tuple[DataFrame, DataFrame]:
    """Counted values inside each bracket (keys, __i, value, __n) and per bracket __total and __below, the rows under it.

    Rows under a bracket are counted where they are read, rows above it are left out, so what is shuffled are
    the sketches and the values of the brackets.
    """
    ends = settle(_brackets(usable, value, probs, keys, accuracy))
    rows = usable.select(*keys, value)
    rows = join_on_keys(rows, ends, keys) if keys else rows.withColumn("__e", ends.select(F.struct("__ends")).scalar()).withColumn("__ends", F.col("__e.__ends")).drop("__e")
    v = F.col(value)
    kinds = F.transform("__ends", lambda e: F.when(e["lo"].isNotNull() & (v < e["lo"]), F.struct(e["i"].alias("i"), F.lit(True).alias("under"))).when(
        e["hi"].isNull() | (v <= e["hi"]), F.struct(e["i"].alias("i"), F.lit(False).alias("under"))
    ))
    cut = rows.select(*keys, value, F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("__k"))
    counted = cut.groupBy(*keys, F.col("__k.i").alias("__i"), F.when(~F.col("__k.under"), v).alias(value)).agg(F.count(F.lit(1)).alias("__n"))
    counted = settle(counted)
    under = counted.filter(F.col(value).isNull()).select(*keys, "__i", F.col("__n").alias("__below"))
    every = ends.select(*keys, "__total", F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1))).alias("__i"))
    placed = join_on_keys(every, under, [*keys, "__i"], "left").withColumn("__below", F.coalesce("__below", F.lit(0)))
    return counted.filter(F.col(value).isNotNull()), placed


def _ranks(probs: Sequence[float]) -> tuple[Column, Column, Column]:
    """For a row with __i and __total: the place of its quantile among the sorted values, and the ranks around it."""
    p = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("__i"))
    h = p * (F.col("__total") - 1)
    return h, F.floor(h), F.ceil(h)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by=None, accuracy: int = 2000) -> DataFrame:
    """Exact interpolated quantiles: one row per key with columns ``n`` and ``q0..qk``.

    Mergeable sketches enclose each wanted rank, a counting pass keeps only the values inside (about
    ``8 / accuracy`` of the rows for each quantile), and these are counted, range-partitioned and looked up by
    rank.  Partition totals tell which partitions hold the wanted ranks; only those are sorted, so neither the
    driver nor one aggregation buffer holds the values of a key.  Should a sketch miss a rank, all values are
    counted instead.
    """
    keys = _names(by)
    usable = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    inside, placed = _enclosed(usable, value, probs, keys, accuracy)
    placed = settle(placed)
    h, low, high = _ranks(probs)
    held = inside.groupBy(*keys, "__i").agg(F.sum("__n").alias("__in"))
    found = join_on_keys(placed, held, [*keys, "__i"], "left").withColumn("__in", F.coalesce("__in", F.lit(0)))
    missed = found.filter((low < F.col("__below")) | (high >= F.col("__below") + F.col("__in")))
    if missed.limit(1).count():
        inside, placed = _enclosed(usable, value, probs, keys, 2**31 - 1)
    return _pick(inside, placed, value, probs, keys)


def _pick(inside: DataFrame, placed: DataFrame, value: str, probs: Sequence[float], keys: list[str]) -> DataFrame:
    group = [*keys, "__i"]
    ranged = inside.repartitionByRange(*[F.col(k).asc_nulls_first() for k in group], F.col(value).asc())
    ranged = settle(ranged.withColumn("__part", F.spark_partition_id()))
    totals = ranged.groupBy(*group, "__part").agg(F.sum("__n").alias("__size"))
    upto = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.withColumn("__start", F.sum("__size").over(upto) - F.col("__size"))
    totals = join_on_keys(totals, placed, group).withColumn("__start", F.col("__start") + F.col("__below"))
    h, low, high = _ranks(probs)
    within = lambda at: (at >= F.col("__start")) & (at < F.col("__start") + F.col("__size"))
    parts = join_on_keys(ranged, totals.filter(within(low) | within(high)).drop("__size", "__below"), [*group, "__part"])
    running = Window.partitionBy(*group, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = parts.withColumn("__cum", F.col("__start") + F.sum("__n").over(running))
    holds = lambda at: F.max(F.when((at >= F.col("__cum") - F.col("__n")) & (at < F.col("__cum")), F.col(value).cast("double")))
    ends = cum.groupBy(*group).agg(F.max("__total").alias("__total"), holds(low).alias("__lo"), holds(high).alias("__hi"))
    one = ends.select(*group, "__total", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (h - F.floor(h))).alias("__q"))
    picks = [F.max(F.when(F.col("__i") == i, F.col("__q"))).alias(f"q{i}") for i in range(len(probs))]
    return one.groupBy(*keys).agg(F.max("__total").alias("n"), *picks)
