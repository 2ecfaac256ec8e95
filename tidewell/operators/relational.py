"""Projections, filters, joins, ranking, paging and set operations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle, spread
from .multipattern import first_key
from .ordered import _names, earliest, join_on_keys, with_position


# -- projections and filters -------------------------------------------------------------

def select_as(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(a) for c, a in aliases.items()])


def keep_existing(df: DataFrame, wanted: Sequence[str], order_by: str | None = None) -> DataFrame:
    out = df.select(*[c for c in wanted if c in df.columns])
    return out.orderBy(order_by) if order_by else out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def column_families(columns: Sequence[str], pattern: str) -> dict[str, list[str]]:
    """Columns grouped by the first capture of ``pattern``; columns without a match are left out."""
    found: dict[str, list[str]] = {}
    for c in columns:
        m = re.search(pattern, c)
        if m:
            found.setdefault(m.group(1), []).append(c)
    return found


def finite_or_null(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def fill_nonfinite(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.coalesce(finite_or_null(c), F.lit(value)) for c in cols})


def clean_labels(df: DataFrame, col: str) -> DataFrame:
    number = F.expr(f"try_cast({col} AS DOUBLE)")
    return df.withColumn(col, number).filter(F.col(col).isin(0.0, 1.0)).withColumn(col, F.col(col).cast("int"))


def time_parse_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of each text column that reads as a timestamp, in one pass."""
    cols = list(cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    facts = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.count(F.try_to_timestamp(F.col(c))).alias(f"p{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_values"), F.col(f"p{i}").alias("n_parsed"))
            for i, c in enumerate(cols)
        ]
    )
    out = facts.select(F.inline(rows))
    return out.withColumn("is_time", (F.col("n_values") > 0) & (F.col("n_values") == F.col("n_parsed")))


def guess_time_column(df: DataFrame) -> str | None:
    """A column with a usual time name first, else the first text column that parses fully."""
    lower = {c.lower(): c for c in df.columns}
    for name in ("timestamp", "time", "datetime", "date"):
        if name in lower:
            return lower[name]
    for f in df.schema:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return f.name
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return None
    hit = {r["column_name"] for r in time_parse_profile(df, texts).collect() if r["is_time"]}
    return next((c for c in texts if c in hit), None)


# -- joins -------------------------------------------------------------------------------


def contains_lookup(
    queries: DataFrame, id_col: str, text: str, entries: DataFrame, key: str, value: str, rank: str, default: str
) -> DataFrame:
    """First entry (by ``rank``, then key) whose key occurs in the text, case-insensitively; else ``default``.

    One pass of an automaton over each text finds the keys, whatever their lengths.  Every row is looked up for
    itself and keeps its columns; a null text, an empty key and a null rank find nothing.
    """
    keys = entries.select(F.lower(key).alias("__k"), F.col(value).alias("__v"), F.col(rank).alias("__rank"))
    keys = settle(keys.groupBy("__k").agg(F.min_by("__v", "__rank").alias("__v"), F.min("__rank").alias("__rank")))
    rows = spread(queries.withColumn("__low", F.lower(text)))
    found = first_key(rows, "__low", keys, "__k", "__rank", "__found").drop("__low")
    out = found.join(keys.select(F.col("__k").alias("__found"), "__v"), "__found", "left").drop("__found")
    return out.withColumn("answer", F.coalesce("__v", F.lit(default))).drop("__v")


def lateral_series(df: DataFrame, n, name: str = "i") -> DataFrame:
    """Every row repeated for 1..n, ``n`` a column or a number."""
    n = n if isinstance(n, Column) else F.lit(n)
    return df.withColumn(name, F.explode(F.when(n >= 1, F.sequence(F.lit(1), n))))


def positional_zip(a: DataFrame, b: DataFrame, order_a, order_b, by=None) -> DataFrame:
    """Pair rows by position inside each key up to the shorter side; column names must differ."""
    keys = _names(by)
    left, right = with_position(a, order_a, keys), with_position(b, order_b, keys)
    return join_on_keys(left, right, [*keys, "rn"])


# -- ranking and paging ------------------------------------------------------------------


def leaderboard(
    facts: DataFrame, dims: DataFrame, key: str, value: str, min_count: int = 2, scale: tuple[int, int] = (3, 2)
) -> DataFrame:
    """Mean per key over at least ``min_count`` rows, ranked by mean, count, key.

    Aggregated before the join, and ranked by a range shuffle instead of one sorted task.
    """
    stats = (
        facts.groupBy(key)
        .agg(F.avg(value).cast(f"decimal({scale[0]},{scale[1]})").alias("avg_value"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )
    order = [F.col("avg_value").desc(), F.col("n").desc(), F.col(key).asc()]
    return with_position(stats.join(dims, key), order, name="ranking").orderBy("ranking")


def leaderboard_by_row(facts, dims, key, value, min_count=2, scale=(3, 2)) -> DataFrame:
    """The same ranking with the group statistics attached to each row and reduced afterwards."""
    stats = facts.groupBy(key).agg(
        F.avg(value).cast(f"decimal({scale[0]},{scale[1]})").alias("avg_value"), F.count(F.lit(1)).alias("n")
    )
    rows = facts.select(key).join(stats, key).filter(F.col("n") >= min_count).dropDuplicates()
    order = [F.col("avg_value").desc(), F.col("n").desc(), F.col(key).asc()]
    return with_position(rows.join(dims, key), order, name="ranking").orderBy("ranking")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order_by``; combined before the shuffle, so copies may be many."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("__row"))
    return picked.select(*keys, "__row.*")


def top_per_key(df: DataFrame, keys: Sequence[str], order, k: int, name: str = "place") -> DataFrame:
    """First ``k`` rows per key; Spark limits each task to ``k`` rows per key before the shuffle."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def preview(df: DataFrame, keys: Sequence[str], order, k: int = 3) -> DataFrame:
    """First ``k`` rows per key and whether there are more."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    shown = top_per_key(df, keys, order, k)
    return join_on_keys(shown, counts, list(keys)).withColumn("has_more", F.col("__n") > k).drop("__n")


def page_of(df: DataFrame, order_by, page: int, count: int) -> DataFrame:
    """Rows of the zero-based page, in order, with the number of pages; ``order_by`` ends in a unique column.

    Rows are numbered by a range shuffle, so a page far back costs no more than the first one.
    """
    pages = df.agg(F.ceil(F.count(F.lit(1)) / count).alias("n")).scalar()
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    placed = with_position(df, order, name="__rn")
    rows = placed.filter((F.col("__rn") > page * count) & (F.col("__rn") <= (page + 1) * count)).orderBy("__rn").drop("__rn")
    return rows.withColumn("total_pages", pages)


def page_after(df: DataFrame, order_by: Sequence[str], after: Sequence | None, count: int) -> DataFrame:
    """The next ``count`` rows in order after the row whose order values are ``after`` (None: from the start).

    Needs no numbering: each task keeps ``count`` rows past the mark.  Nulls come last in every column.
    """
    past = F.lit(True) if after is None else F.lit(False)
    same = F.lit(True)
    for name, value in zip(order_by, after or ()):
        mark = F.lit(value)
        beyond = F.lit(False) if value is None else F.col(name).isNull() | (F.col(name) > mark)
        past = past | (same & beyond)
        same = same & F.col(name).eqNullSafe(mark)
    return df.filter(past).orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(count)


def spaced_sample(df: DataFrame, score, n: int) -> DataFrame:
    """``n`` rows at evenly spaced ranks of ascending ``score``; all rows when there are at most ``n``."""
    placed = with_position(df, score)
    placed = placed.withColumn("__t", placed.agg(F.max("rn")).scalar())
    at, last = F.col("rn") - 1, F.col("__t") - 1
    if n <= 1:
        return placed.filter((F.col("__t") <= n) | (at == 0)).drop("__t")
    # Rank r is wanted when some i in 0..n-1 has floor(i * (N-1) / (n-1)) = r; only i near r*(n-1)/(N-1) can.
    near = F.ceil(at * (n - 1) / last)
    hit = F.lit(False)
    for step in (-1, 0, 1):
        i = near + step
        hit = hit | ((i >= 0) & (i <= n - 1) & (F.floor(i * last / (n - 1)) == at))
    return placed.filter((F.col("__t") <= n) | hit).drop("__t")


# -- set operations ----------------------------------------------------------------------


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "phase") -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def dedupe_first(df: DataFrame, content: Sequence[Column | str], order_by: Sequence[str]) -> DataFrame:
    """First row of each distinct content.  Only hashes and order columns take part in the
    grouping, combined map-side, so a group of many copies stays cheap."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000")) for c in content]
    hashed = df.withColumn("__h", F.sha2(F.concat_ws("\u0001", *parts), 256))
    winners = hashed.groupBy("__h").agg(earliest(order_by).alias("__w"))
    winners = winners.select(F.col("__w").alias(order_by[0])) if len(order_by) == 1 else winners.select("__w.*")
    return df.join(winners, list(order_by), "left_semi")


def splice_tail(base: DataFrame, new: DataFrame, value: str, order_by, by=None, offset: int | None = None) -> DataFrame:
    """Replace ``value`` in the back half of ``base`` with rows of ``new``.

    ``offset`` is where reading from ``new`` starts (0 repeats its front rows); by default the
    two series are aligned, position for position.
    """
    keys = _names(by)
    left = with_position(base, order_by, keys)
    sizes = left.groupBy(*keys).agg(F.floor(F.max("rn") / 2).alias("__half"))
    left = join_on_keys(left, sizes, keys) if keys else left.withColumn("__half", sizes.scalar())
    start = F.col("__half") if offset is None else F.lit(offset)
    left = left.withColumn("__at", F.when(F.col("rn") > F.col("__half"), F.col("rn") - F.col("__half") + start))
    donor = with_position(new, order_by, keys, "__at").select(*keys, "__at", F.col(value).alias("__new"))
    out = join_on_keys(left, donor, [*keys, "__at"], "left")
    return out.withColumn(value, F.coalesce("__new", value)).drop("__at", "__new", "__half")
