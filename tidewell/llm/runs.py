"""Periodic run detection: Lyndon roots of word sequences, extended to the runs that repeat them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.common import ids_and_texts, short_batches, spaced_pieces

#: Words and periods that a reported run holds at least.
LEAST, PERIODS = 24, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, the end being smaller than all ranks.

    Phase one of the grouping suffix sorter.  Suffixes start in groups by their first rank.  Groups are taken
    from the greatest to the smallest; a group's context (the words its suffixes are known to share) is then
    final, and is the longest Lyndon word there.  Each place of the group hands its context to the closest
    place before it that is still in a smaller group; places of one group that were handed it equally often
    form a new group just above their old one.
    """
    n = len(ranks)
    order = sorted(set(ranks))
    number = {r: g for g, r in enumerate(order)}
    group = [number[r] for r in ranks]
    members: list[list[int]] = [[] for _ in order]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(order)  # words that the suffixes of a group share
    below, above = list(range(-1, len(order) - 1)), list(range(1, len(order) + 1))
    length, before = [0] * n, [-1] * n
    top = len(order) - 1
    while top >= 0:
        shared, hits = context[top], {}
        for i in members[top]:
            if group[i] != top:
                continue
            length[i] = shared
            j = i - 1
            while j >= 0 and length[j]:  # in a greater group, or earlier in this one
                j = before[j]
            before[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        members[top] = []
        made: dict[tuple[int, int], list[int]] = {}
        for j, times in hits.items():
            made.setdefault((group[j], times), []).append(j)
        # more often handed the context stands higher, so the largest count goes in first, right above its old group
        for (old, times), places in sorted(made.items(), reverse=True):
            new, up = len(members), above[old]
            members.append(places)
            context.append(context[old] + times * shared)
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new
            for j in places:
                group[j] = new
        top = below[top]
    return length


def repeating_parts(ids: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> Iterator[tuple[int, int]]:
    """Start and end of the stretches that alone can hold a run.

    Every ``least // periods`` words of a run stand in it once more, one period away (single words where two
    periods suffice), so a run lies within words covered by repeated word groups.  Equal hashes of unequal
    groups only lengthen a stretch.
    """
    width = max(1, least // periods) if periods > 2 else 1
    if len(ids) < max(least, width):
        return
    h = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    grams = np.zeros(len(ids) - width + 1, np.uint64)
    for k in range(width):
        grams = (grams ^ (grams >> np.uint64(29))) * _MIX + h[k : k + len(grams)]
    order = np.argsort(grams)
    same = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(same):
        return
    steps = np.zeros(len(ids) + 1, np.int64)
    found = np.union1d(order[same], order[same + 1])
    np.add.at(steps, found, 1)
    np.add.at(steps, found + width, -1)
    covered = np.concatenate([[0], np.cumsum(steps[:-1]) > 0, [0]])
    edges = np.flatnonzero(np.diff(covered))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start >= least:
            yield start, end


class Extensions:
    """Exact lengths of common extensions of two places of a sequence, forward and backward.

    Level k numbers the stretches of 2**k words so that equal stretches have equal numbers.
    """

    def __init__(self, ranks: np.ndarray):
        self.levels, self.n = [ranks], len(ranks)
        while 2 << (len(self.levels) - 1) <= self.n:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            both = last[: len(last) - half] * np.int64(self.n + 1) + last[half:]
            different, numbers = np.unique(both, return_inverse=True)
            if len(different) == len(numbers):
                break
            self.levels.append(numbers.astype(np.int64))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and from ``b`` on, for a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level, top = self.levels[k], len(self.levels[k]) - 1
            y = b + out
            fits = y <= top
            out += (fits & (level[np.minimum(a + out, top)] == level[np.minimum(y, top)])) << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree just before ``a`` and just before ``b``, for a < b."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            x = a - out - (1 << k)
            fits = x >= 0
            out += (fits & (level[np.maximum(x, 0)] == level[np.maximum(b - out - (1 << k), 0)])) << k
        return out


def find_runs(ids: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """Rows (start, length, period) of the runs, by start, then period.

    A run of smallest period q has at least ``least`` words and ``periods`` (2 or more) times q, and cannot be
    longer on either side.  Its least rotation under one of the two orders of the words is the longest Lyndon
    word where it starts, so all places with their Lyndon words under both orders are extended.
    """
    found = [np.zeros((0, 3), np.int64)]
    for begin, end in repeating_parts(ids, least, periods):
        _, ranks = np.unique(ids[begin:end], return_inverse=True)
        ranks, size = ranks.astype(np.int64), end - begin
        place = np.arange(size)
        starts, roots = [], []
        for order in (ranks, ranks.max() - ranks):
            root = np.array(lyndon_array(order.tolist()), np.int64)
            short = (root * periods <= size) & (place + root < size)
            starts.append(place[short])
            roots.append(root[short])
        both = np.unique(np.stack([np.concatenate(starts), np.concatenate(roots)], axis=1), axis=0)
        at, root = both[:, 0], both[:, 1]
        extend = Extensions(ranks)
        first = at - extend.backward(at, at + root)
        length = at + root + extend.forward(at, at + root) - first
        enough = length >= np.maximum(least, periods * root)
        found.append(np.stack([first[enough] + begin, length[enough], root[enough]], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def number_words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, equal for equal words, and the words in pieces of the text joined by one space."""
    seen: dict[bytes, int] = {}
    ids, joined = [np.zeros(0, np.int64)], []
    for words in spaced_pieces(text):
        if words:
            ids.append(np.array([seen.setdefault(w, len(seen)) for w in words], np.int64))
            joined.append(b" ".join(words))
    return np.concatenate(ids), joined


def collapse(joined: list[bytes], runs: np.ndarray, n: int) -> bytes:
    """The words left, joined by one space, when every run keeps only its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    keep, at, kept = np.cumsum(steps[:-1]) == 0, 0, []
    for piece in joined:
        words = piece.split(b" ")
        left = list(compress(words, keep[at : at + len(words)].tolist()))
        if left:
            kept.append(b" ".join(left))
        at += len(words)
    return b" ".join(kept)


def collapse_runs(
    docs: DataFrame, least: int = LEAST, periods: int = PERIODS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns doc_id, n_words, runs (structs of start, length, period in words) and collapsed (text).

    Words stand between white space (space and \\x09-\\x0D).  A run repeats its first ``period`` words; it has
    at least ``least`` words and ``periods`` periods, and no neighbouring word extends it.  ``collapsed`` holds
    the words, joined by one space, that no run contains after its first period.  Documents are independent, so
    nothing is shuffled.  A text needs memory in proportion to its own length, and the grouping runs over
    repeating stretches only.

    Null and empty texts have no words, no runs and an empty ``collapsed``; every row, repeated or without id,
    is treated for itself; an empty table gives no rows.
    """
    short_batches(docs.sparkSession, 250)

    def run(batches):
        for batch in batches:
            sizes, texts, offsets, rows = [], [], [0], [np.zeros((0, 3), np.int64)]
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                ids, joined = number_words(text)
                runs = find_runs(ids, least, periods)
                sizes.append(len(ids))
                texts.append(collapse(joined, runs, len(ids)) if len(runs) else b" ".join(joined))
                rows.append(runs)
                offsets.append(offsets[-1] + len(runs))
            flat = np.concatenate(rows)
            parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)
