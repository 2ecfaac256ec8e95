"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import short_batches, spaced_words, whole_text

#: Slots of hashed words, factors of each feature, passes over the sample, rows of a step.
SLOTS, FACTORS, EPOCHS, STEP = 1 << 14, 8, 8, 128
RATE, SHRINK = 0.02, 1e-5
#: Labelled rows that a fit uses at most: those with the smallest hash of their id.
SAMPLE = 8000
#: Bounds between the buckets of each statistic; a bucket is a feature of its own beside the value.
BOUNDS = (-1.5, -0.75, -0.25, 0.25, 0.75, 1.5)
STATS = 15
_CLASS = np.zeros(256, np.int64)
_CLASS[[*range(97, 123)]] = 1  # lower case
_CLASS[[*range(65, 91)]] = 2  # upper case
_CLASS[[*range(48, 58)]] = 3  # digits
_CLASS[[32]] = 4
_CLASS[[9, 10, 11, 12, 13]] = 5
_CLASS[[*b".,;:'\"()-"]] = 6  # marks of prose
_CLASS[[*b"!?"]] = 7
_CLASS[[*b"|/\\_=+<>[]{}~^`@"]] = 8
_CLASS[[*b"#$%&*"]] = 9
_CLASS[128:] = 10


def _stats(text: str, n_chars: float) -> tuple[list[float], np.ndarray, np.ndarray]:
    """Statistics of one whole text, and the slots and weights of its words."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.zeros(11, np.int64)
    for at in range(0, len(data), 1 << 20):
        counts += np.bincount(_CLASS[np.frombuffer(data, np.uint8, min(1 << 20, len(data) - at), at)], minlength=11)
    slots = np.zeros(SLOTS, np.int64)
    n_words = word_bytes = ended = 0
    hashed = xxhash.xxh64_intdigest
    for words in spaced_words(text, lower=True):
        n_words += len(words)
        word_bytes += sum(map(len, words))
        ended += sum(w[-1] in b"!%$&*#|" for w in words)
        slots += np.bincount(np.fromiter((hashed(w) & (SLOTS - 1) for w in words), np.int64, len(words)), minlength=SLOTS)
    lines = data.split(b"\n")
    size, letters, words_or_1 = max(len(data), 1), max(int(counts[1] + counts[2]), 1), max(n_words, 1)
    used = np.flatnonzero(slots)
    stats = [
        counts[2] / letters,
        counts[3] / size,
        counts[4] / size,
        counts[5] / size,
        counts[6] / size,
        counts[7] / size,
        counts[8] / size,
        counts[9] / size,
        counts[10] / size,
        word_bytes / words_or_1,
        ended / words_or_1,
        len(used) / min(words_or_1, SLOTS),
        1 - len(set(lines)) / len(lines),
        np.log1p(n_words),
        np.log1p(max(n_chars, 0.0)),
    ]
    weight = np.log1p(slots[used])
    return stats, used, weight / max(np.sqrt((weight**2).sum()), 1e-12)


def features(texts: list[str], n_chars: list[float]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    parts = [_stats(t, c) for t, c in zip(texts, n_chars)]
    stats = np.array([p[0] for p in parts], np.float64).reshape(-1, STATS)
    return stats, [p[1] for p in parts], [p[2] for p in parts]


class FactorisationMachine:
    """Bias, a weight and a factor vector for each feature; pairs cost no more than the features themselves."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        self.mean, self.spread = mean, spread
        self.size = SLOTS + STATS * (len(BOUNDS) + 2)
        self.bias, self.weight = 0.0, np.zeros(self.size)
        self.factor = np.random.default_rng(7).normal(0, 0.05, (self.size, FACTORS))

    def state(self) -> tuple:
        return self.mean, self.spread, self.bias, self.weight, self.factor

    @classmethod
    def of(cls, state: tuple) -> FactorisationMachine:
        mean, spread, bias, weight, factor = state
        model = cls(mean, spread)
        model.bias, model.weight, model.factor = bias, weight, factor
        return model

    def rows(self, stats: np.ndarray, slots: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers and values of all rows one after another, and where each row starts."""
        z = np.clip((stats - self.mean) / self.spread, -3, 3)
        buckets = SLOTS + STATS + np.arange(STATS) * (len(BOUNDS) + 1) + np.searchsorted(BOUNDS, z)
        at = np.concatenate([np.concatenate([s, SLOTS + np.arange(STATS), b]) for s, b in zip(slots, buckets)])
        x = np.concatenate([np.concatenate([w, v / 3, np.full(STATS, 0.5)]) for w, v in zip(weights, z)])
        starts = np.concatenate([[0], np.cumsum([len(s) + 2 * STATS for s in slots])[:-1]])
        return at, x, starts

    def margin(self, at: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum-of-squares identity: half of (sum of v x) squared less the sum of (v x) squared, per factor."""
        vx = self.factor[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weight[at] * x, starts) + pairs, vx, total

    def score(self, stats: np.ndarray, slots: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        m, _, _ = self.margin(*self.rows(stats, slots, weights))
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))

    def fit(self, stats: np.ndarray, slots: list[np.ndarray], weights: list[np.ndarray], y: np.ndarray) -> FactorisationMachine:
        """Adam on the logistic loss; the order of rows and all random numbers are fixed."""
        rng = np.random.default_rng(11)
        params = {"weight": self.weight, "factor": self.factor}
        first = {k: np.zeros_like(p) for k, p in params.items()}
        second = {k: np.zeros_like(p) for k, p in params.items()}
        bias_m = bias_v = 0.0
        step = 0
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for begin in range(0, len(y), STEP):
                rows = order[begin : begin + STEP]
                at, x, starts = self.rows(stats[rows], [slots[r] for r in rows], [weights[r] for r in rows])
                m, vx, total = self.margin(at, x, starts)
                g = (1 / (1 + np.exp(-np.clip(m, -30, 30))) - y[rows]) / len(rows)
                row = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(at))))
                gx = g[row] * x
                grads = {
                    "weight": np.bincount(at, gx, self.size) + SHRINK * self.weight,
                    "factor": np.stack([np.bincount(at, gx * (total[row, f] - vx[:, f]), self.size) for f in range(FACTORS)], axis=1)
                    + SHRINK * self.factor,
                }
                step += 1
                c1, c2 = 1 - 0.9**step, 1 - 0.999**step
                for k, grad in grads.items():
                    first[k] += 0.1 * (grad - first[k])
                    second[k] += 0.001 * (grad**2 - second[k])
                    params[k] -= RATE * (first[k] / c1) / (np.sqrt(second[k] / c2) + 1e-8)
                bias_m += 0.1 * (g.sum() - bias_m)
                bias_v += 0.001 * (g.sum() ** 2 - bias_v)
                self.bias -= RATE * (bias_m / c1) / (np.sqrt(bias_v / c2) + 1e-8)
        return self


def _length(docs: DataFrame, chars_col: str, text: Column) -> Column:
    """The metadata column, or the text's own length where there is none."""
    own = F.length(text).cast("double")
    return F.coalesce(docs[chars_col].cast("double"), own) if chars_col in docs.columns else own


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
) -> FactorisationMachine | None:
    """Fit on at most ``sample`` labelled documents, those of the smallest id hash; None if none is labelled.

    Repeated labels of an id count by their mean (0.5 or more is 1), null labels not at all; of repeated rows
    of a document the one of the smallest text hash is used.  The fit runs in one task, on ``sample`` rows of at most ``SLOTS`` features.
    """
    short_batches(docs.sparkSession)
    known = labels.groupBy(labels[id_col].cast("long").alias("·id")).agg(F.avg(labels[label_col].cast("double")).alias("·y"))
    chosen = known.where("`·id` is not null and `·y` is not null").orderBy(F.xxhash64("·id"), "·id").limit(sample)
    text = whole_text(docs[text_col])
    rows = (
        docs.select(docs[id_col].cast("long").alias("·doc"), text.alias("·text"), _length(docs, chars_col, text).alias("·n"))
        .join(F.broadcast(chosen), F.col("·doc") == F.col("·id"))  # at most `sample` pairs of numbers
        .select(F.col("·doc").alias("doc"), F.col("·text").alias("text"), F.col("·n").alias("n"), (F.col("·y") >= 0.5).cast("double").alias("y"), F.xxhash64("·text").alias("h"))
    )

    def extract(batches):
        for batch in batches:
            stats, slots, weights = features(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            packed = [pickle.dumps(p) for p in zip(stats, slots, weights)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), pa.array(packed, pa.binary()), batch.column(3)], ["doc", "h", "x", "y"])

    def train(batches):
        found = {d: (x, y) for b in batches for d, x, y in zip(*(c.to_pylist() for c in b.columns))}
        if found:
            parts = [(*pickle.loads(x), y) for _, (x, y) in sorted(found.items())]
            stats, y = np.array([p[0] for p in parts]), np.array([p[3] for p in parts])
            model = FactorisationMachine(stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6))
            model.fit(stats, [p[1] for p in parts], [p[2] for p in parts], y)
            state = pickle.dumps(model.state())
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["model"])

    # of repeated rows the one of the smallest text hash, whatever the order of rows
    known = rows.mapInArrow(extract, "doc long, h long, x binary, y double").groupBy("doc").agg(F.min(F.struct("h", "x", "y")).alias("first"))
    fitted = known.select("doc", "first.x", "first.y").repartition(1).mapInArrow(train, "model binary").collect()
    if not fitted:
        return None
    return FactorisationMachine.of(pickle.loads(fitted[0][0]))


def quality_score(docs: DataFrame, model: FactorisationMachine | None, text_col: str = "text", chars_col: str = "n_chars") -> Column:
    """Score from 0 to 1 of each whole text, higher for label 1; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)
    # SLOTS x (FACTORS + 1) numbers; plain arrays, as a broadcast class would have to be installed on executors
    sent = docs.sparkSession.sparkContext.broadcast(model.state())

    @F.pandas_udf("double")
    def scored(texts: pd.Series, n_chars: pd.Series) -> pd.Series:
        machine = FactorisationMachine.of(sent.value)
        out = [machine.score(*features(list(texts[i : i + 200]), list(n_chars[i : i + 200]))) for i in range(0, len(texts), 200)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    text = whole_text(docs[text_col])
    return scored(text, _length(docs, chars_col, text))


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: the CRC-32 of the id as text is divisible by 5."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def score_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", least: float = 0.3, sample: int = SAMPLE, id_col: str = "doc_id"
) -> DataFrame:
    """Columns doc_id, held_out, score, predicted of every document.

    Learns from labelled rows that are not held out.  Null and empty texts are scored by their statistics; a
    null doc_id is never labelled and counts as not held out; repeated rows score alike; without any label to
    learn from every score is 0.5; an empty table gives no rows.
    """
    model = fit_quality(docs, labels.where(~held_out(labels[id_col].cast("long"))), label_col, sample, id_col)
    score = quality_score(docs, model)
    out = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(held_out(docs[id_col].cast("long")), F.lit(False)).alias("held_out"), score.alias("score")
    )
    return out.withColumn("predicted", (F.col("score") >= least).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, label_col: str = "quality", least: float = 0.3, sample: int = SAMPLE, id_col: str = "doc_id") -> DataFrame:
    """The documents that score at least ``least``, with all columns and without a shuffle."""
    model = fit_quality(docs, labels.where(~held_out(labels[id_col].cast("long"))), label_col, sample, id_col)
    return docs.where(quality_score(docs, model) >= least)
