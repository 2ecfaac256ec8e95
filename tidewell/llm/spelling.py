"""Spelling variants: words one edit apart, found in tries of letter-group counts, and the forms they vary."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts
from tidewell.session import settle

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, RATIO = 7, 2, 10
# Fixed value: letters by how common they are in English.  Each is a group of its own; other characters go to
# four more groups by code point.  Groups are dealt to ``PARTS`` parts in turn, so that parts tell words apart alike.
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
GROUPS, PARTS = 30, 3
#: Words of a block that meet in one task, letters compared as arrays, pairs of a trie node that are compared at once.
BLOCK, WIDE, PAIRS = 8_192, 48, 1 << 15
#: Parts into which the words of a crowded cell are dealt while they learn its number of blocks.
SALTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(
    docs: DataFrame,
    spell: Callable[[Column, Column], Column] | None = None,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Columns word and n: how often each letter run stands in all texts, A-Z in lower case.

    Runs and words of fewer than ``least_letters`` code points and words of fewer than ``least_count``
    occurrences are left out.  ``spell`` maps (doc_id, lower-cased run) to the word it counts for, which must
    not be longer than the run.  Counts are combined before the shuffle.  Null and empty texts have no words;
    repeated rows count again; an empty table gives no rows.
    """
    runs = ids_and_texts(docs, id_col, text_col).select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_letters},}}"), 0)).alias("run")
    )
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    words = runs.select("doc_id", run.alias("run"))
    word = spell(F.col("doc_id"), F.col("run")) if spell else F.col("run")
    counted = words.select(word.alias("word")).where(F.char_length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row per word: how many letters it has of each group."""
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.arange(128) % (GROUPS - len(COMMON)) + len(COMMON)
    known[[ord(c) for c in COMMON]] = np.arange(len(COMMON))
    groups = np.where(letters < 128, known[np.minimum(letters, 127)], letters % (GROUPS - len(COMMON)) + len(COMMON))
    cells = np.repeat(np.arange(len(words)), sizes) * GROUPS + groups
    return np.bincount(cells, minlength=len(words) * GROUPS).reshape(len(words), GROUPS).astype(np.int32)


def signature(counts: np.ndarray) -> np.ndarray:
    """Two bits for each group, set for counts of 1 and of 2 or more: two words differ in no more bits than in letters."""
    bits = np.uint64(1) << np.arange(2 * GROUPS, dtype=np.uint64)
    return ((counts >= 1) * bits[:GROUPS]).sum(axis=1, dtype=np.uint64) | ((counts >= 2) * bits[GROUPS:]).sum(axis=1, dtype=np.uint64)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from one word to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:  # length of the common prefix
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


class VariantTrie:
    """Words in a trie of successive letter-group counts: sorted rows, a node being the rows of one prefix."""

    def __init__(self, words: list[str], part: int):
        self.words, self.part = words, part
        counts = letter_counts(words)
        parts = [list(range(p, GROUPS, PARTS)) for p in range(PARTS)]
        levels = [g for p in range(PARTS) if p != part for g in parts[p]]
        order = np.lexsort(counts[:, levels[::-1]].T)
        self.words = [words[k] for k in order]
        self.place = order
        self.bits = signature(counts[order])
        self.counts = np.ascontiguousarray(counts[order][:, levels])
        # parts before this one come first among the levels
        self.earlier = [slice(p * (GROUPS // PARTS), (p + 1) * (GROUPS // PARTS)) for p in range(part)]
        self.size = np.array([len(w) for w in self.words])
        self.codes = np.array([w[:WIDE] for w in self.words], f"<U{WIDE}").view(np.uint32).reshape(len(words), WIDE)
        self.back = np.array([w[::-1][:WIDE] for w in self.words], f"<U{WIDE}").view(np.uint32).reshape(len(words), WIDE)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (in the list of words) of all pairs one edit apart, each pair once and shorter words first.

        All words descend together, depth first.  A word may go where a count is greater by one (its surplus
        budget), and after that where one is smaller by one (its deficit budget): pairs that differ the other
        way round are met from their other word.  Words that agree in a part before this trie's own are met
        there.  At small nodes the words that are left are compared.
        """
        n, depth = len(self.words), self.counts.shape[1]
        todo = [(0, 0, n, np.arange(n), np.zeros(n, np.int8))]
        while todo:
            level, low, high, who, spent = todo.pop()
            if level == depth or len(who) * (high - low) <= PAIRS:
                step = max(1, 8 * PAIRS // (high - low))
                for at in range(0, len(who), step):
                    some = who[at : at + step]
                    close = np.bitwise_count(self.bits[some][:, None] ^ self.bits[low:high][None, :]) <= 2
                    x, y = np.nonzero(close)
                    yield from self._near(some[x], low + y)
                continue
            column = self.counts[low:high, level]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [high - low]])
            own = self.counts[who, level]
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                more = column[start] - own
                go = (more == 0) | ((more == 1) & (spent == 0)) | ((more == -1) & (spent == 1))
                if go.any():
                    todo.append((level + 1, low + start, low + end, who[go], spent[go] + (more[go] != 0)))

    def _near(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(a), 2 * PAIRS):
            x, y = a[at : at + 2 * PAIRS], b[at : at + 2 * PAIRS]
            longer = self.size[y] - self.size[x]
            fits = (longer == 1) | ((longer == 0) & (x != y))
            x, y = x[fits], y[fits]
            more = self.counts[y] - self.counts[x]
            fits = (np.abs(more).sum(axis=1) <= 2) & (more.max(axis=1, initial=0) <= 1) & (more.min(axis=1, initial=0) >= -1)
            # of two words of equal length, the one that has the first surplus; within a group, the smaller place
            lead = more[np.arange(len(more)), (more != 0).argmax(axis=1)] if more.shape[1] else np.zeros(len(more))
            fits &= (lead > 0) | ((lead == 0) & ((self.size[x] < self.size[y]) | (x < y)))
            for group in self.earlier:
                fits &= (more[:, group] != 0).any(axis=1)
            x, y = x[fits], y[fits]
            short = self.size[y] <= WIDE
            same = ~short
            same[~short] = [one_edit(self.words[i], self.words[j]) for i, j in zip(x[~short].tolist(), y[~short].tolist())]
            i, j = x[short], y[short]
            ahead = (self.codes[i] != self.codes[j]).argmax(axis=1)
            behind = (self.back[i] != self.back[j]).argmax(axis=1)
            same[short] = ahead + behind >= self.size[j] - 1
            if same.any():
                yield self.place[x[same]], self.place[y[same]]


def near_words(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Columns word, n_near, near, near_n: how many words are one edit apart, and the most frequent of these.

    Rows of a word come from several tasks, each with its own share of the near words: their n_near add up, and
    the largest near_n (of equals the smallest near) is the first.  Each pair is met in one task only, and a task
    hands on a row for each word, whatever the number of pairs.

    One edit changes two letter-group counts at most, so of three parts of the groups one agrees.  Words meet
    by part and counts of that part; the other two parts are the levels of a trie which is searched with a
    surplus and a deficit of one.  Pairs are reported by the first part that agrees.  Cells of more than
    ``block`` words are dealt into blocks and every two blocks meet in a task of their own, so memory is
    bounded for any cell.
    """
    per_part = GROUPS // PARTS
    rows = settle(counts.select("word", "n").mapInArrow(_cells, "word string, n long, cell binary"))
    crowded = rows.groupBy("cell").count().where(F.col("count") > block)
    crowded = crowded.select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    # words of one cell meet its number of blocks under several salts, as a crowded cell is one key
    crowded = crowded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
    dealt = salted.join(crowded, ["cell", "salt"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cell", "word", "n", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def search(table: pa.Table) -> pa.Table:
        words, n, mine = table.column("word").to_pylist(), table.column("n").to_numpy(), table.column("mine").to_numpy()
        part, apart = table.column("cell")[0].as_py()[0], table.column("i")[0].as_py() != table.column("j")[0].as_py()
        order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
        for a, b in VariantTrie(words, part).pairs() if len(words) > 1 else ():
            if apart:
                keep = mine[a] != mine[b]
                a, b = a[keep], b[keep]
            for x, y in ((a, b), (b, a)):
                near += np.bincount(x, minlength=len(words))
                np.minimum.at(best, x, place[y])
        at = np.flatnonzero(near)
        first = np.array(order, np.int64)[best[at]]
        column = table.column("word").combine_chunks()
        taken = {"word": column.take(pa.array(at)), "n_near": pa.array(near[at]), "near": column.take(pa.array(first)), "near_n": pa.array(n[first])}
        return pa.table(taken)

    # by block and not by cell alone, and in as many tasks as shuffles have: the work is more than the bytes
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "cell", "i", "j").groupBy("cell", "i", "j").applyInArrow(search, "word string, n_near long, near string, near_n long")


def _cells(batches):
    """Each word once for each part, with the part's number and its letter-group counts as a key."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        counts = letter_counts(words).astype("<u4") if words else np.zeros((0, GROUPS), "<u4")
        for part in range(PARTS):
            keys = [bytes([part]) + row.tobytes() for row in np.ascontiguousarray(counts[:, part::PARTS])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary())], ["word", "n", "cell"])


def group_variants(counts: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """Columns word, n, n_near, form, form_n, root of a table of distinct words and how often they occur.

    n_near counts the words exactly one inserted, deleted or replaced code point away.  The form of a word is
    the most frequent of them (the smallest of equals in code-point order) if it is at least ``ratio`` times as
    frequent, else null.  The root is where following forms ends; each step multiplies the count by ``ratio``,
    so a few joins of doubled steps reach it.  Null words are left out; an empty table gives no rows.
    """
    words = settle(counts.where("word is not null"))
    near = near_words(words, block).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("first")
    )
    joined = words.join(near, "word", "left")
    likely = -F.col("first.less") >= ratio * F.col("n")
    rows = settle(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(likely, F.col("first.near")).alias("form"),
            F.when(likely, -F.col("first.less")).alias("form_n"),
        )
    )
    steps = settle(rows.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = settle(moved)
        steps = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            break
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
