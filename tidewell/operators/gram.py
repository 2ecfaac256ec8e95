"""Sums of products for least squares and correlations, added up as matrices in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of matrices that a task holds before it hands them on.
HELD = 1 << 27


def gram_by_key(rows: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Columns keys and gram: the upper triangle, row by row, of the sums of products of (1, x..., y) per key.

    Each task adds up one matrix per key over its batches with matrix products; matrices of a key are then added
    element by element, so neither a hot key nor a wide window meets in one task.  Rows with a null or NaN in
    ``x`` or ``y`` are left out; all ``x`` have the same length.
    """
    number = lambda c: c.isNotNull() & ~F.isnan(c)
    whole = F.forall(F.col(x), number) & number(F.col(y).cast("double"))
    slim = rows.filter(whole).select(*keys, F.col(x).cast("array<double>").alias("x"), F.col(y).cast("double").alias("y"))
    schema = T.StructType([*[slim.schema[k] for k in keys], T.StructField("gram", T.ArrayType(T.DoubleType()))])
    n_keys = len(keys)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(i).type for i in range(n_keys)]
            lags = batch.column(n_keys).flatten().to_numpy().reshape(batch.num_rows, -1)
            z = np.column_stack([np.ones(len(lags)), lags, batch.column(n_keys + 1).to_numpy()])
            who = list(zip(*(batch.column(i).to_pylist() for i in range(n_keys)))) or [()] * len(z)
            names = list(dict.fromkeys(who))
            place = {k: i for i, k in enumerate(names)}
            code = np.fromiter((place[k] for k in who), np.int64, len(who))
            for i, key in enumerate(names):
                part = z[code == i] if len(names) > 1 else z
                held[key] = held.get(key, 0.0) + part.T @ part
            if len(held) * z.shape[1] ** 2 * 8 > HELD:
                yield emit(held, kinds)
                held = {}
        if held:
            yield emit(held, kinds)

    def emit(held: dict, kinds: list) -> pa.RecordBatch:
        size = next(iter(held.values())).shape[0]
        upper = np.triu_indices(size)
        columns = [pa.array([k[i] for k in held], kinds[i]) for i in range(n_keys)]
        flat = np.concatenate([m[upper] for m in held.values()])
        offsets = np.arange(len(held) + 1, dtype=np.int32) * len(upper[0])
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, flat)], [*keys, "gram"])

    return add_up(slim.mapInArrow(add, schema), keys)


def add_up(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matrices of equal keys added element by element; partial sums are combined before the shuffle."""
    cells = parts.select(*keys, F.posexplode("gram").alias("at", "v")).groupBy(*keys, "at").agg(F.sum("v").alias("v"))
    return cells.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("cells")).select(*keys, F.col("cells.v").alias("gram"))


def solve(gram: Sequence[float]) -> tuple[int, np.ndarray, float]:
    """Rows, least-squares weights (the constant first) and training RMSE of a flat upper triangle."""
    flat = np.asarray(gram, np.float64)
    size = (math.isqrt(8 * len(flat) + 1) - 1) // 2
    s = np.zeros((size, size))
    s[np.triu_indices(size)] = flat
    s = s + np.triu(s, 1).T
    # Columns are scaled to one length first: lags of any unit weigh alike in the rank decision.
    unit = np.sqrt(np.maximum(np.diag(s)[:-1], 1e-300))
    a = s[:-1, :-1] / unit[:, None] / unit[None, :]
    w = np.linalg.lstsq(a, s[:-1, -1] / unit, rcond=None)[0] / unit
    sse = s[-1, -1] - 2 * w @ s[:-1, -1] + w @ s[:-1, :-1] @ w
    return int(round(s[0, 0])), w, math.sqrt(max(sse, 0.0) / max(s[0, 0], 1.0))


def pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row for every two columns i < j: n, and the sums of a, b, aa, bb, ab over rows where both are numbers.

    One scan, in which each task adds up four matrices.  Values are taken relative to a mean of some rows, which
    keeps the products small and changes no correlation.
    """
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None))
    numbers = df.select(*[number(c).alias(f"c{i}") for i, c in enumerate(cols)])
    some = numbers.limit(1000).agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    shift = np.array([0.0 if v is None or not math.isfinite(v) else v for v in some])
    i, j = np.triu_indices(len(cols), 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = one = two = both = 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
            has = ~np.isnan(x)
            x = np.where(has, x - shift, 0.0)
            mask = has.astype(np.float64)
            n, one, two, both = n + mask.T @ mask, one + x.T @ mask, two + (x * x).T @ mask, both + x.T @ x
        if np.ndim(n):
            sums = [n[i, j], one[i, j], one[j, i], two[i, j], two[j, i], both[i, j]]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(dict(zip(("i", "j", "n", "a", "b", "aa", "bb", "ab"), (i, j, *sums)))), preserve_index=False)

    parts = numbers.mapInArrow(add, "i long, j long, n double, a double, b double, aa double, bb double, ab double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
