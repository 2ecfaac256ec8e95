"""Operators on ordered series: one long table (key, time, value), any key of any length."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import det
from ..session import settle
from .aggregates import error_metrics
from .ordered import RUN, _names, join_on_keys, neighbours, quantiles, scan, with_position

STEP_ROWS = 10_000


def micros(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c, like: str = "timestamp_ntz") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(c).cast(like)


def _with_size(df: DataFrame, keys: Sequence[str], pos: str = "rn", name: str = "n") -> DataFrame:
    sizes = df.groupBy(*keys).agg(F.max(pos).alias(name))
    return join_on_keys(df, sizes, keys) if keys else df.withColumn(name, sizes.scalar())


def explode_range(df: DataFrame, lo: Column, hi: Column, name: str) -> DataFrame:
    """Rows for every whole number lo..hi; long ranges are cut so that no array gets large, and dealt out piece by
    piece, so that one row's range is not made in one task."""
    df = df.withColumns({"__lo": lo, "__hi": hi}).filter("__hi >= __lo")
    df = df.withColumn("__at", F.explode(F.sequence("__lo", "__hi", F.lit(STEP_ROWS).cast("bigint"))))
    df = df.repartition("__lo", "__hi", "__at")
    return df.withColumn(name, F.explode(F.sequence("__at", F.least(F.col("__at") + STEP_ROWS - 1, F.col("__hi"))))).drop(
        "__lo", "__hi", "__at"
    )


# -- neighbours and gaps -----------------------------------------------------------------


def half_mask(df: DataFrame, order_by, by=None, actual: str = "actual") -> DataFrame:
    """Show actual values for the front half only; ``in_pred_half`` marks the front rows."""
    keys = _names(by)
    placed = _with_size(with_position(df, order_by, keys), keys)
    front = F.col("rn") <= F.floor(F.col("n") / 2)
    return placed.withColumn("in_pred_half", front).withColumn("real_half", F.when(front, F.col(actual)))


def lag_feature(df: DataFrame, value: str, order_by, by=None, n: int = 1, name: str = "input", size: int = RUN) -> DataFrame:
    """Value ``n`` rows earlier in the same series."""
    keys = _names(by)
    return neighbours(
        with_position(df, order_by, keys), keys, "rn", lambda w: {name: F.lag(value, n).over(w)}, before=n, size=size
    )


def fill_both(df: DataFrame, value: str, order_by, by=None, name: str = "filled", size: int = RUN) -> DataFrame:
    """Last known value, and before the first known one the next."""
    keys = _names(by)
    placed = with_position(df, order_by, keys)
    out = scan(placed, keys, "rn", last={"__f": F.col(value)}, first={"__b": F.col(value)}, size=size)
    return out.withColumn(name, F.coalesce("__f", "__b")).drop("__f", "__b")


def median_gap(df: DataFrame, ts: str, by=None, distinct: bool = True, tie: str | None = None) -> DataFrame:
    """Median time between consecutive rows in microseconds, and the number of times."""
    keys = _names(by)
    times = df.filter(F.col(ts).isNotNull()).select(*keys, micros(ts).alias("__t"), *([tie] if tie and not distinct else []))
    if distinct:
        times = times.distinct()
    placed = with_position(times, ["__t", *([tie] if tie and not distinct else [])], keys)
    gaps = neighbours(placed, keys, "rn", lambda w: {"__gap": F.col("__t") - F.lag("__t").over(w)}, before=1)
    med = quantiles(gaps, "__gap", (0.5,), keys).select(*keys, F.col("q0").alias("median_gap_us"))
    counts = times.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_times"))
    if keys:
        return join_on_keys(counts, med, keys, "left")
    return counts.withColumn("median_gap_us", med.select("median_gap_us").scalar())


def tolerance_us(gaps: DataFrame, share: float = 0.6) -> DataFrame:
    """Matching tolerance from a series' own spacing; one second for short or flat series."""
    usable = (F.col("n_times") >= 3) & (F.col("median_gap_us") > 0)
    return gaps.withColumn("tolerance_us", F.when(usable, F.floor(F.col("median_gap_us") * share)).otherwise(1_000_000))


# -- as-of join --------------------------------------------------------------------------


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    ids: tuple[str, str],
    by=None,
    tolerance: int | None = None,
    keep_unmatched: bool = False,
    size: int = RUN,
) -> DataFrame:
    """For each left row the right row nearest in time within ``tolerance`` microseconds.

    Without a tolerance it is 0.6 of the median gap of the left times of the key.  Equal
    distances go to the earlier row; of equal times the last earlier and the first later row
    is taken.  Both sides form one ordered stream, so neither is held or broadcast whole.
    """
    keys = _names(by)
    l_ts, r_ts = on
    l_cols = [c for c in left.columns if c not in keys]
    r_cols = [c for c in right.columns if c not in keys]
    clash = set(l_cols) & set(r_cols)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    none = lambda df, cols: F.lit(None).cast(df.select(F.struct(*cols).alias("s")).schema["s"].dataType)
    a = left.filter(F.col(l_ts).isNotNull()).select(
        *keys, micros(l_ts).alias("__t"), F.lit(1).alias("__tag"), F.col(ids[0]).alias("__lid"),
        F.lit(None).cast(right.schema[ids[1]].dataType).alias("__rid"), F.struct(*l_cols).alias("__l"), none(right, r_cols).alias("__r"),
    )
    b = right.filter(F.col(r_ts).isNotNull()).select(
        *keys, micros(r_ts).alias("__t"), F.lit(0).alias("__tag"), F.lit(None).cast(left.schema[ids[0]].dataType).alias("__lid"), F.col(ids[1]).alias("__rid"),
        none(left, l_cols).alias("__l"), F.struct(*r_cols).alias("__r"),
    )
    placed = with_position(a.unionByName(b), ["__t", "__tag", "__lid", "__rid"], keys, "__pos")
    seen = F.when(F.col("__tag") == 0, F.struct(F.col("__t").alias("t"), F.col("__r").alias("r")))
    near = scan(placed, keys, "__pos", last={"__b": seen}, first={"__f": seen}, size=size).filter("__tag = 1")
    back, fore = F.col("__t") - F.col("__b.t"), F.col("__f.t") - F.col("__t")
    pick = F.when(F.col("__f").isNull() | (back <= fore), F.col("__b")).otherwise(F.coalesce("__f", "__b"))
    near = near.withColumn("__m", pick).withColumn("gap_us", F.abs(F.col("__t") - F.col("__m.t")))
    if tolerance is None:
        tol = tolerance_us(median_gap(left, l_ts, keys)).select(*keys, "tolerance_us")
        near = join_on_keys(near, tol, keys) if keys else near.withColumn("tolerance_us", tol.scalar())
    else:
        near = near.withColumn("tolerance_us", F.lit(tolerance))
    ok = F.col("gap_us") <= F.col("tolerance_us")
    near = near.withColumn("__m", F.when(ok, F.col("__m"))).withColumn("gap_us", F.when(ok, F.col("gap_us")))
    if not keep_unmatched:
        near = near.filter("gap_us IS NOT NULL")
    return near.select(*keys, "__l.*", *[F.col(f"__m.r.{c}").alias(c) for c in r_cols], "gap_us")


def align(left, right, on, ids, by=None, tolerance=None, min_ratio: float = 0.8) -> tuple[DataFrame, float]:
    """As-of match, or pairing by position when fewer than ``min_ratio`` of left rows match."""
    from .relational import positional_zip

    matched = settle(asof_nearest(left, right, on, ids, by, tolerance, keep_unmatched=True))
    row = matched.agg(F.count(F.lit(1)).alias("n"), F.count("gap_us").alias("hit")).first()
    ratio = row["hit"] / max(1, row["n"])
    if ratio >= min_ratio:
        return matched.filter("gap_us IS NOT NULL"), ratio
    paired = positional_zip(left, right, [on[0], ids[0]], [on[1], ids[1]], by).drop("rn")
    return paired.withColumn("gap_us", F.lit(None).cast("bigint")), ratio


# -- windows and scaling -----------------------------------------------------------------


def supervised_windows(df: DataFrame, value: str, order_by, by, seq_len: int, size: int = RUN) -> DataFrame:
    """``x``: the previous ``seq_len`` values, ``y``: the value; rows without a full window are left out.

    A null value keeps its place in the windows; fill first where a model cannot take it.
    """
    keys = _names(by)
    placed = with_position(df, order_by, keys)
    made = neighbours(
        placed, keys, "rn", lambda w: {"x": F.collect_list(F.struct(F.col(value).alias("v"))).over(w.rowsBetween(-seq_len, -1))["v"]}, before=seq_len, size=size
    )
    return made.filter(F.size("x") == seq_len).withColumn("y", F.col(value))


def fit_minmax(df: DataFrame, value: str, by=None, feature_range: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """scale and offset per key, such that scaled = value * scale + offset; a constant key has scale 1."""
    lo, hi = feature_range
    span = F.max(value) - F.min(value)
    scale = F.when(span == 0, F.lit(1.0)).otherwise(span)
    out = df.groupBy(*_names(by)).agg(F.min(value).alias("__lo"), scale.alias("__span"))
    out = out.withColumn("scale", F.lit(hi - lo) / F.col("__span"))
    return out.withColumn("offset", F.lit(lo) - F.col("__lo") * F.col("scale")).drop("__lo", "__span")


def _attach(df: DataFrame, params: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return join_on_keys(df, params, keys)
    return df.withColumn("__p", params.select(F.struct(*params.columns)).scalar()).select("*", "__p.*").drop("__p")


def _attach_left(df: DataFrame, params: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parameters beside the rows of their key; rows of other keys keep nulls."""
    return join_on_keys(df, params, keys, "left") if keys else _attach(df, params, keys)


def scale(df: DataFrame, params: DataFrame, value: str, by=None, name: str = "scaled") -> DataFrame:
    out = _attach(df, params, _names(by))
    return out.withColumn(name, F.col(value) * F.col("scale") + F.col("offset")).drop("scale", "offset")


def unscale(df: DataFrame, params: DataFrame, value: str, by=None, name: str = "restored") -> DataFrame:
    out = _attach(df, params, _names(by))
    return out.withColumn(name, (F.col(value) - F.col("offset")) / F.col("scale")).drop("scale", "offset")


# -- resampling --------------------------------------------------------------------------


def regular_keys(df: DataFrame, ts: str, by=None, probe: int = 20) -> DataFrame:
    """Per key whether its first ``probe`` stamps (three at least) are evenly spaced."""
    keys = _names(by)
    times = df.filter(F.col(ts).isNotNull()).select(*keys, micros(ts).alias("__t"))
    w = Window.partitionBy(*keys).orderBy("__t")
    first = times.withColumn("__p", F.row_number().over(w)).filter(F.col("__p") <= probe)  # Spark keeps ``probe`` rows per key and task
    gaps = first.withColumn("__gap", F.col("__t") - F.lag("__t").over(w))
    even = (F.count("__t") >= 3) & (F.min("__gap") == F.max("__gap")) & (F.min("__gap") > 0)
    return gaps.groupBy(*keys).agg(even.alias("regular"))


def resample_if_needed(df: DataFrame, ts: str, value: str, width_us: int, by=None, probe: int = 20) -> DataFrame:
    """``bin`` and ``mean``: series of even spacing as they are, all others as means per time bin."""
    keys = _names(by)
    marked = _attach(df.filter(F.col(ts).isNotNull()), regular_keys(df, ts, keys, probe), keys)
    kept = marked.filter("regular").select(*keys, from_micros(micros(ts)).alias("bin"), F.col(value).cast("double").alias("mean"))
    other = resample(marked.filter("not regular"), ts, width_us, {"mean": F.avg(value)}, keys)
    return kept.unionByName(other)


def resample(
    df: DataFrame, ts: str, width_us: int, aggs: Mapping[str, Column], by=None, fill_empty: bool = True
) -> DataFrame:
    """Aggregates per time bin (``bin`` is its start); bins between the first and last without rows are null."""
    keys = _names(by)
    t = micros(ts)
    binned = df.withColumn("__b", F.floor(t / width_us))
    out = binned.groupBy(*keys, "__b").agg(*[c.alias(n) for n, c in aggs.items()])
    if fill_empty:
        span = binned.groupBy(*keys).agg(F.min("__b").alias("__s"), F.max("__b").alias("__e"))
        grid = explode_range(span, F.col("__s"), F.col("__e"), "__b").select(*keys, "__b")
        out = join_on_keys(grid, out, [*keys, "__b"], "left")
    return out.select(*keys, from_micros(F.col("__b") * width_us).alias("bin"), *aggs)


def rate_per_bin(df: DataFrame, ts: str, flag: Column, width_us: int, by=None) -> DataFrame:
    """Flagged rows, rows and percent per bin; an empty bin has 0 rows and a null rate."""
    aggs = {"flagged": F.sum(flag.cast("bigint")), "total": F.count(F.lit(1))}
    out = resample(df, ts, width_us, aggs, by).na.fill(0, ["flagged", "total"])
    return out.withColumn("rate", F.try_divide(F.col("flagged") * 100.0, F.col("total")))


def densify_index(df: DataFrame, value: str, order_by, by, factor: int, size: int = RUN) -> DataFrame:
    """(n-1) * factor + 1 points per series, linear between neighbours; ``at`` counts from 0."""
    keys = _names(by)
    placed = with_position(df.select(*keys, value, *[c for c in order_by if c != value]), order_by, keys)
    paired = neighbours(placed, keys, "rn", lambda w: {"__next": F.lead(value).over(w), "__more": F.lead(F.lit(1)).over(w)}, after=1, size=size)
    steps = F.sequence(F.lit(0), F.when(F.col("__more") == 1, F.lit(factor - 1)).otherwise(F.lit(0)))
    out = paired.withColumn("__i", F.explode(steps))
    rise = F.coalesce((F.col("__next") - F.col(value)) * F.col("__i") / factor, F.lit(0.0))
    return out.select(*keys, ((F.col("rn") - 1) * factor + F.col("__i")).alias("at"), (F.col(value) + rise).alias("value"))


def densify_time(df: DataFrame, ts: str, value: str, by, factor: int, tie: str, size: int = RUN) -> DataFrame:
    """Grid from the first to the last time at median gap / factor, interpolated in time.

    A key whose median gap is not positive is densified by position, without times.  A series of one row, and
    any series at a factor of 1 or less, stays as it is.
    """
    keys = _names(by)
    if factor <= 1:
        placed = with_position(df.select(*keys, tie, F.col(ts).alias("__ts"), value), ["__ts", tie], keys)
        return placed.select(*keys, (F.col("rn") - 1).alias("at"), F.col("__ts").alias("ts"), F.col(value).alias("value"))
    gaps = median_gap(df, ts, keys, distinct=False, tie=tie)
    step = gaps.select(*keys, F.greatest(F.lit(1), F.floor(F.floor("median_gap_us") / factor)).alias("__step"), "median_gap_us")
    start = df.groupBy(*keys).agg(F.min(micros(ts)).alias("__start"))
    placed = with_position(df.select(*keys, tie, micros(ts).alias("__t"), value), ["__t", tie], keys)
    paired = neighbours(
        placed, keys, "rn", lambda w: {"__t2": F.lead("__t").over(w), "__v2": F.lead(value).over(w)}, after=1, size=size
    )
    rows = _attach(_attach(paired, step, keys), start, keys)
    regular = rows.filter("median_gap_us > 0")
    first = F.ceil((F.col("__t") - F.col("__start")) / F.col("__step"))
    stop = F.when(F.col("__t2").isNull(), F.floor((F.col("__t") - F.col("__start")) / F.col("__step"))).otherwise(
        F.ceil((F.col("__t2") - F.col("__start")) / F.col("__step")) - 1
    )
    grid = explode_range(regular, first, stop, "__k")
    grid = grid.withColumn("__g", F.col("__start") + F.col("__k") * F.col("__step"))
    frac = F.try_divide((F.col("__g") - F.col("__t")).cast("double"), (F.col("__t2") - F.col("__t")).cast("double"))
    value_at = F.col(value) + F.coalesce((F.col("__v2") - F.col(value)) * frac, F.lit(0.0))
    timed = grid.select(*keys, F.col("__k").alias("at"), from_micros("__g").alias("ts"), value_at.alias("value"))
    flat = rows.filter("median_gap_us is null or median_gap_us <= 0").withColumn(
        "__i", F.explode(F.sequence(F.lit(0), F.when(F.col("__t2").isNull(), F.lit(0)).otherwise(F.lit(factor - 1))))
    )
    by_place = flat.select(
        *keys,
        ((F.col("rn") - 1) * factor + F.col("__i")).alias("at"),
        F.when(F.col("median_gap_us").isNull(), from_micros("__t")).alias("ts"),
        (F.col(value) + F.coalesce((F.col("__v2") - F.col(value)) * F.col("__i") / factor, F.lit(0.0))).alias("value"),
    )
    return timed.unionByName(by_place)


# -- splits ------------------------------------------------------------------------------


def split_by_position(
    df: DataFrame, order_by, by=None, ratios: tuple[float, float] = (0.75, 0.95), names=("pretrain", "finetune", "holdout")
) -> DataFrame:
    """Three consecutive parts; the last holds at least one row."""
    keys = _names(by)
    placed = _with_size(with_position(df, order_by, keys), keys)
    n = F.col("n")
    pre = F.greatest(F.lit(1), F.floor(n * ratios[0]))
    fine = F.least(F.greatest(pre + 1, F.floor(n * ratios[1])), n - 1)
    part = F.when(F.col("rn") <= pre, names[0]).when(F.col("rn") <= fine, names[1]).otherwise(names[2])
    return placed.withColumn("part", part).drop("n")


def split_at(df: DataFrame, order_by, by=None, idx: int = 2000, seq_len: int = 0) -> DataFrame:
    """Rows up to ``idx`` are original, later ones retrain; retrain rows lose their first ``seq_len``."""
    placed = with_position(df, order_by, _names(by))
    kept = placed.filter((F.col("rn") <= idx) | (F.col("rn") > idx + seq_len))
    return kept.withColumn("part", F.when(F.col("rn") <= idx, "original").otherwise("retrain"))


def split_by_year(windows: DataFrame, ts: str, first_test_year: int) -> DataFrame:
    """Applied to finished windows, so test windows reach back into the training rows."""
    return windows.withColumn("part", F.when(F.year(ts) < first_test_year, "train").otherwise("test"))


# -- scoring -----------------------------------------------------------------------------

Scorer = Callable[[Column], Column]


def moving_average(x: Column) -> Column:
    known = F.filter(x, lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, v: a + v), F.size(known))


def lag_linear(x: Column) -> Column:
    """Constant and lags weighted by the column ``weights`` that the scored rows carry; null where a lag is null."""
    weights = F.col("weights")
    terms = F.zip_with(x, F.slice(weights, 2, F.size(weights) - 1), lambda a, w: a * w)
    return F.aggregate(terms, F.get(weights, 0), lambda total, t: total + t)


def one_step_score(
    df: DataFrame, value: str, order_by, by, seq_len: int, scorer: Scorer = moving_average, size: int = RUN, params: DataFrame | None = None
) -> DataFrame:
    """Predict each row from the ``seq_len`` before it; the first rows take their actual value.

    ``params`` holds what the scorer needs of each key (for ``lag_linear`` its weights) and meets the finished
    windows.  The moving average leaves out nulls; where there is no prediction the actual value is taken.
    """
    keys = _names(by)
    made = neighbours(
        with_position(df, order_by, keys), keys, "rn",
        lambda w: {"__x": F.collect_list(F.struct(F.col(value).alias("v"))).over(w.rowsBetween(-seq_len, -1))["v"]}, before=seq_len, size=size,
    )
    extra = [c for c in params.columns if c not in keys] if params is not None else []
    made = _attach_left(made, params, keys) if extra else made
    pred = F.when(F.size("__x") == seq_len, scorer(F.col("__x")))
    out = made.withColumn("predicted", F.coalesce(pred, F.col(value))).drop("__x", *extra)
    return out.withColumn("error", F.col(value) - F.col("predicted"))


def multi_step(
    df: DataFrame, value: str, order_by: Sequence[str], by, seq_len: int, n_steps: int, scorer: Scorer = moving_average, params: DataFrame | None = None
) -> DataFrame:
    """Forecast ``n_steps`` ahead per key, feeding each prediction back.  Only the last ``seq_len`` rows are used.

    ``params`` as in ``one_step_score``.
    """
    keys = _names(by)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_by])
    tail = df.withColumn("__back", F.row_number().over(w)).filter(F.col("__back") <= seq_len)
    seeds = tail.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(-F.col("__back"), F.col(value).alias("v")))).alias("__s"))
    seeds = seeds.filter(F.size("__s") == seq_len).withColumn("__s", F.col("__s.v"))
    seeds = seeds if params is None else _attach_left(seeds, params, keys)
    grow = lambda acc, _: F.concat(acc, F.array(scorer(F.slice(acc, -seq_len, seq_len))))
    run = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(n_steps)), F.col("__s"), grow), seq_len + 1, n_steps)
    return seeds.select(*keys, F.posexplode(run).alias("step", "predicted")).withColumn("step", F.col("step") + 1)


def future_stamps(df: DataFrame, ts: str, by, n_steps: int, low: int = 15, high: int = 20, salt: str = "") -> DataFrame:
    """Times after the last one in steps of ``low``..``high`` seconds, drawn from a hash of key and step."""
    keys = _names(by)
    last = df.groupBy(*keys).agg(F.max(ts).alias("__last"))
    rows = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_steps))))
    draw = det.uniform(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("step").cast("string")), salt)
    rows = rows.withColumn("__s", low + F.floor(draw * (high - low + 1)))
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    total = micros("__last") + F.sum("__s").over(w) * 1_000_000
    return rows.select(*keys, "step", from_micros(total).alias("ts"))


def drift_report(
    df: DataFrame, actual: str, predicted: str, order_by, by, cut: int | None = None, warn_pct: float = 50.0
) -> DataFrame:
    """Errors of the front and back section of each series and the change between them, in percent of the front RMSE."""
    keys = _names(by)
    placed = _with_size(with_position(df, order_by, keys), keys)
    edge = F.lit(cut) if cut else F.floor(F.col("n") / 2)
    placed = placed.withColumn("__part", F.when(F.col("rn") <= edge, 1).otherwise(2)).drop("n")
    m = error_metrics(placed, actual, predicted, [*keys, "__part"])
    out = m.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("__part") == p, F.col(c))).alias(f"section{p}_{c}")
            for p in (1, 2)
            for c in ("n", "mae", "rmse", "max_error")
        ]
    )
    diff = F.col("section2_rmse") - F.col("section1_rmse")
    out = out.withColumn("rmse_diff", diff).withColumn("rmse_change_pct", F.try_divide(diff * 100, F.col("section1_rmse")))
    return out.withColumn("recommendation", F.when(F.col("rmse_change_pct") > warn_pct, "retrain").otherwise("keep"))
