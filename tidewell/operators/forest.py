"""Random forests that are grown and asked where their rows are.

Features are cut into codes at quantiles.  While nodes hold many rows, trees grow a level at a time from
histograms that tasks add up.  Below, the training and test rows of a node meet in one group, which grows the
rest of the tree and answers for its test rows, so no driver or task holds a forest, and no group more than the
rows of a bounded node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .features import POISSON1

#: Codes of a feature, drawn training rows that a group takes at most, and test rows whose votes are added up together.
BINS, NODE, CHUNK = 32, 50_000, 1 << 12
#: Gain that counts, as a share of what the node is worth: less is rounding.
LEAST = 1e-10


def _draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn with replacement for a tree, Poisson(1) by a hash of its key."""
    salt = ((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    with np.errstate(over="ignore"):
        z = key + np.uint64(salt)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return np.searchsorted(POISSON1, (z >> np.uint64(11)) / 2.0**53, side="right")


class Task:
    """What is predicted: one of ``classes`` by weighted shares, or without classes a number by weighted means."""

    def __init__(self, classes: int, features: int):
        self.classes, self.features = classes, features
        self.tried = math.ceil(math.sqrt(features)) if classes else math.ceil(features / 3)

    def stats(self, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        if self.classes:
            return (y[:, None] == np.arange(self.classes)) * weight[:, None]
        return np.stack([weight, weight * y], axis=1)

    def worth(self, stats: np.ndarray) -> np.ndarray:
        """What impurity leaves of the weight (Gini) or of the squares (variance); a split gains by the sum of its sides."""
        total, square = (stats.sum(-1), (stats**2).sum(-1)) if self.classes else (stats[..., 0], stats[..., 1] ** 2)
        return np.divide(square, total, out=np.zeros_like(total), where=total > 0)

    def votes(self, stats: np.ndarray) -> np.ndarray:
        """Class shares, or the mean and a 1 that counts trees."""
        total = (stats.sum(-1) if self.classes else stats[..., 0])[..., None]
        return stats / total if self.classes else np.concatenate([stats[..., 1:] / total, np.ones_like(total)], axis=-1)


def _descend(codes: np.ndarray, top: tuple) -> np.ndarray:
    """The node of a tree's top at which each row arrives; the left child's number is given, the right one is next."""
    feature, cut, left = top
    at = np.zeros(len(codes), np.int64)
    while len(rows := np.flatnonzero(feature[at] >= 0)):
        node = at[rows]
        at[rows] = left[node] + (codes[rows, feature[node]] > cut[node])
    return at


def _tried(task: Task, seed: int, tree: int, nodes: Sequence[int]) -> np.ndarray:
    """The features that each node of a top may be split by."""
    return np.array([np.random.default_rng([seed, tree, n]).permutation(task.features)[: task.tried] for n in nodes])


def _best_cuts(task: Task, node: np.ndarray, code: np.ndarray, stats: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the gain of its best cut of one feature, and the last code on the left."""
    bits = max(1, len(node).bit_length())
    cell = node * BINS + code
    order = np.sort((cell << bits) | np.arange(len(node))) & ((1 << bits) - 1)
    cell = cell[order]
    last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))
    upto, cell = np.cumsum(stats[order], axis=0)[last], cell[last]
    of = cell // BINS
    ends = np.flatnonzero(np.append(of[1:] != of[:-1], True))
    left = upto - np.concatenate([np.zeros((1, upto.shape[1])), upto[ends[:-1]]])[of]
    gain = task.worth(left) + task.worth(whole[of] - left) - task.worth(whole)[of]
    gain[ends] = -np.inf  # all rows on the left
    most = np.maximum.reduceat(gain, np.append(0, ends[:-1] + 1))
    best = np.flatnonzero(gain == most[of])
    best = best[np.append(True, of[best][1:] != of[best][:-1])]
    return most, cell[best] % BINS


def grow_and_ask(task: Task, codes: np.ndarray, stats: np.ndarray, asked: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Grows a tree of at most ``limit`` levels from the rows and gives its votes for the rows asked, which go down with them."""
    node, at, rows = np.zeros(len(codes), np.int64), np.zeros(len(asked), np.int64), np.arange(len(asked))
    out = None
    for level in range(limit + 1):
        n = int(node.max()) + 1
        whole = np.stack([np.bincount(node, s, n) for s in stats.T], axis=1)
        gain, feature, cut = LEAST * task.worth(whole), np.full(n, -1), np.zeros(n, np.int64)
        tried = np.argsort(rng.random((n, task.features)), axis=1)[:, : task.tried]
        for f in tried.T if level < limit else ():
            found, code = _best_cuts(task, node, codes[np.arange(len(node)), f[node]], stats, whole)
            better = found > gain
            gain[better], feature[better], cut[better] = found[better], f[better], code[better]
        votes = task.votes(whole)
        out = np.zeros((len(asked), votes.shape[1])) if out is None else out
        split = feature >= 0
        ended = ~split[at]
        out[rows[ended]] = votes[at[ended]]
        if not split.any():
            return out
        child = 2 * (np.cumsum(split) - 1)
        go = split[node]
        node, codes, stats = node[go], codes[go], stats[go]
        node = child[node] + (codes[np.arange(len(node)), feature[node]] > cut[node])
        at, rows = at[~ended], rows[~ended]
        at = child[at] + (asked[rows, feature[at]] > cut[at])
    return out


class Forest:
    """``trees`` trees of at most ``depth`` levels; nodes of more than ``node`` drawn rows are split by all tasks together."""

    def __init__(self, classes: int, features: int, trees: int, depth: int, seed: int, node: int = NODE):
        self.task, self.trees, self.depth, self.seed, self.node = Task(classes, features), trees, depth, seed, node

    def scores(self, train: DataFrame, test: DataFrame, id_col: str) -> DataFrame:
        """label, prediction and probability (an array, null for numbers) of the rows of ``test``.

        Both frames hold label and features, a vector; ``train`` may hold a weight.
        """
        x = vector_to_array("features").alias("x")
        weight = F.col("weight") if "weight" in train.columns else F.lit(1.0)
        rows = settle(train.select(F.xxhash64(id_col).alias("key"), "label", weight.alias("weight"), x))
        asked = settle(test.select(F.monotonically_increasing_id().alias("at"), "label", x))
        cuts = self._cuts(rows)
        tops, closed, levels = self._tops(rows, cuts)
        sent = self._sent(rows, cuts, tops, closed).unionByName(self._asked(asked, cuts, tops))
        return self._gathered(self._voted(sent, closed, levels), asked)

    def _cuts(self, rows: DataFrame) -> list[np.ndarray]:
        marks = [k / BINS for k in range(1, BINS)]
        found = rows.agg(*[F.percentile_approx(F.get("x", F.lit(i)), marks, 10_000) for i in range(self.task.features)]).first()
        return [np.unique(f or []) for f in found]

    def _read(self, cuts: list[np.ndarray]):
        def codes(column: pa.Array) -> np.ndarray:
            x = column.flatten().to_numpy().reshape(len(column), -1)
            return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)

        return codes

    def _tops(self, rows: DataFrame, cuts: list[np.ndarray]) -> tuple[dict, dict, dict]:
        """Tops of all trees, the votes of their leaves, and the level of every node."""
        tops = {t: tuple(np.array([v]) for v in (-1, 0, 0)) for t in range(self.trees)}
        closed: dict[tuple[int, int], list[float]] = {}
        levels = {(t, 0): 0 for t in tops}
        opened = {t: [0] for t in tops} if rows.count() > self.node else {}
        for level in range(self.depth + 1):
            if not opened:
                break
            found, opened = self._level(rows, cuts, tops, opened, level < self.depth).collect(), {}
            for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
                tree, node = r["tree"], r["node"]
                if r["feature"] < 0:
                    closed[tree, node] = r["votes"]
                    continue
                feature, cut, left = tops[tree]
                first = len(feature)
                feature[node], cut[node], left[node] = r["feature"], r["cut"], first
                tops[tree] = tuple(np.append(a, v) for a, v in ((feature, [-1, -1]), (cut, [0, 0]), (left, [0, 0])))
                for child, n in ((first, r["n_left"]), (first + 1, r["n_right"])):
                    levels[tree, child] = level + 1
                    if n > self.node:
                        opened.setdefault(tree, []).append(child)
        return tops, closed, levels

    def _level(self, rows: DataFrame, cuts: list[np.ndarray], tops: dict, opened: dict, may_split: bool) -> DataFrame:
        """How the open nodes are split: histograms of the tried features, added up over the tasks."""
        task, seed, codes_of = self.task, self.seed, self._read(cuts)
        width = len(task.stats(np.zeros(1), np.ones(1))[0]) + 1  # and the number of rows

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {t: np.zeros((len(nodes) * task.tried * BINS, width)) for t, nodes in opened.items()}
            tried = {t: _tried(task, seed, t, nodes) for t, nodes in opened.items()}
            for b in batches:
                key, y, w, codes = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.column(2).to_numpy(), codes_of(b.column(3))
                for t, nodes in opened.items():
                    times = _draws(key, t, seed)
                    drawn = np.flatnonzero(times)
                    slots = np.full(len(tops[t][0]), -1)
                    slots[nodes] = np.arange(len(nodes))
                    slot = slots[_descend(codes[drawn], tops[t])]
                    r, slot = drawn[slot >= 0], slot[slot >= 0]
                    stats = np.concatenate([task.stats(y[r], w[r] * times[r]), np.ones((len(r), 1))], axis=1)
                    for j in range(task.tried):
                        cell = (slot * task.tried + j) * BINS + codes[r, tried[t][slot, j]]
                        for s in range(width):
                            sums[t][:, s] += np.bincount(cell, stats[:, s], len(sums[t]))
            part = TaskContext.get().partitionId()
            for t, found in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([part], pa.int32()), pa.array([found.tobytes()])], ["tree", "part", "sums"])

        def best(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            tree = int(key[0])
            nodes = opened[tree]
            tried = _tried(task, seed, tree, nodes)
            sums = sum(np.frombuffer(s) for s in parts.sort_values("part")["sums"]).reshape(len(nodes), task.tried, BINS, width)
            upto = sums.cumsum(axis=2)
            every = upto[:, :, -1:]
            left, right = upto[..., :-1], (every - upto)[..., :-1]
            gain = task.worth(left) + task.worth(right) - task.worth(every[..., :-1])
            gain[(upto[..., -1] == 0) | (upto[..., -1] == every[..., -1])] = -np.inf
            out = []
            for k, node in enumerate(nodes):
                whole = every[k, 0, 0, :-1]
                j, code = np.unravel_index(np.argmax(gain[k]), gain[k].shape)
                if may_split and gain[k, j, code] > LEAST * task.worth(whole):
                    n = int(upto[k, j, code, -1])
                    out.append((tree, node, int(tried[k, j]), int(code), n, int(every[k, j, 0, -1]) - n, None))
                else:
                    out.append((tree, node, -1, 0, 0, 0, task.votes(whole).tolist()))
            return pd.DataFrame(out, columns=["tree", "node", "feature", "cut", "n_left", "n_right", "votes"])

        summed = rows.mapInArrow(count, "tree int, part int, sums binary").groupBy("tree")
        return settle(summed.applyInPandas(best, "tree int, node int, feature int, cut int, n_left long, n_right long, votes array<double>"))

    SENT = "tree int, node int, part long, chunk long, codes binary, content binary"

    def _sent(self, rows: DataFrame, cuts: list[np.ndarray], tops: dict, closed: dict) -> DataFrame:
        """The drawn training rows of each tree, packed by node; nodes that are leaves need them no more."""
        seed, codes_of = self.seed, self._read(cuts)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, b in enumerate(batches):
                part = TaskContext.get().partitionId() << 32 | number
                key, y, w, codes = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.column(2).to_numpy(), codes_of(b.column(3))
                for t in tops:
                    times = _draws(key, t, seed)
                    drawn = np.flatnonzero(times)
                    content = np.stack([y[drawn], w[drawn] * times[drawn]], axis=1)
                    yield _packed(t, part, _descend(codes[drawn], tops[t]), np.full(len(drawn), -1), codes[drawn], content, closed)

        return rows.mapInArrow(pack, self.SENT)

    def _asked(self, asked: DataFrame, cuts: list[np.ndarray], tops: dict) -> DataFrame:
        """The test rows for each tree, packed by node and chunk."""
        codes_of = self._read(cuts)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, b in enumerate(batches):
                part = TaskContext.get().partitionId() << 32 | number
                at, codes = b.column(0).to_numpy(), codes_of(b.column(1))
                for t in tops:
                    yield _packed(t, part, _descend(codes, tops[t]), at // CHUNK, codes, (at % CHUNK).astype(np.uint16)[:, None], {})

        return asked.select("at", "x").mapInArrow(pack, self.SENT)

    def _voted(self, sent: DataFrame, closed: dict, levels: dict) -> DataFrame:
        task, seed, depth = self.task, self.seed, self.depth
        read = lambda parts, name, kind, width: np.concatenate([np.zeros((0, width), kind), *(np.frombuffer(p, kind).reshape(-1, width) for p in parts[name])])

        def grow(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            tree, node = int(key[0]), int(key[1])
            parts = parts.sort_values(["chunk", "part"])
            train, test = parts[parts["chunk"] < 0], parts[parts["chunk"] >= 0]
            asked = read(test, "codes", np.uint8, task.features)
            content = read(train, "content", np.float64, 2)
            if (tree, node) in closed:
                votes = np.tile(closed[tree, node], (len(asked), 1))
            elif len(content) and len(asked):
                rng = np.random.default_rng([seed, tree, node, 1])
                stats = task.stats(content[:, 0], content[:, 1])
                votes = grow_and_ask(task, read(train, "codes", np.uint8, task.features), stats, asked, depth - levels[tree, node], rng)
            else:  # nobody asks, or no row was drawn
                return pd.DataFrame({"chunk": [], "tree": [], "rows": [], "votes": []})
            ends = np.cumsum([len(c) // 2 for c in test["content"]]).tolist()
            cut = [votes[a:b].tobytes() for a, b in zip([0, *ends], ends)]
            return pd.DataFrame({"chunk": test["chunk"].to_numpy(), "tree": tree, "rows": test["content"].to_numpy(), "votes": cut})

        return sent.groupBy("tree", "node").applyInPandas(grow, "chunk long, tree int, rows binary, votes binary")

    def _gathered(self, voted: DataFrame, asked: DataFrame) -> DataFrame:
        """The trees' votes for each test row, added up in the order of the trees."""
        task = self.task

        def add(votes: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros((CHUNK, task.classes or 2))
            for r in votes.sort_values("tree", kind="stable").itertuples():
                total[np.frombuffer(r.rows, np.uint16)] += np.frombuffer(r.votes).reshape(-1, total.shape[1])
            mine = total[rows["at"].to_numpy() % CHUNK]
            made = pd.DataFrame({"label": rows["label"].to_numpy()})
            if task.classes:
                share = mine / np.maximum(mine.sum(axis=1, keepdims=True), 1e-300)
                return made.assign(prediction=share.argmax(axis=1).astype(np.float64), probability=list(share))
            return made.assign(prediction=mine[:, 0] / np.maximum(mine[:, 1], 1.0), probability=None)

        rows = asked.select((F.shiftright("at", CHUNK.bit_length() - 1)).alias("chunk"), "at", "label")
        met = voted.groupBy("chunk").cogroup(rows.groupBy("chunk"))
        return met.applyInPandas(add, "label double, prediction double, probability array<double>")


def _packed(tree: int, part: int, node: np.ndarray, chunk: np.ndarray, codes: np.ndarray, content: np.ndarray, without: dict) -> pa.RecordBatch:
    """A row for each node and chunk, with the codes and the content of its rows; nodes in ``without`` are left out."""
    order = np.lexsort((chunk, node))
    node, chunk, codes, content = node[order], chunk[order], codes[order], content[order]
    starts = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (chunk[1:] != chunk[:-1]))) if len(node) else np.zeros(0, np.int64)
    spans = [(a, b) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(node)]) if (tree, int(node[a])) not in without]
    firsts = [a for a, _ in spans]
    columns = [
        pa.array([tree] * len(spans), pa.int32()), pa.array(node[firsts], pa.int32()), pa.array([part] * len(spans), pa.int64()), pa.array(chunk[firsts], pa.int64()),
        pa.array([codes[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([content[a:b].tobytes() for a, b in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["tree", "node", "part", "chunk", "codes", "content"])
