"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ids_and_texts, short_batches, spaced_words, whole_text
from tidewell.llm.components import smallest_reachable
from tidewell.session import drop_settled, settle

BITS = 64
#: Fingerprints of a bucket up to which its pairs are compared one by one; larger buckets meet on ball keys.
BUCKET = 32
SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of one text: bit j is 1 if it is set in over half of the shingles' XXH64 values."""
    votes, n = np.zeros(BITS, np.int64), 0
    carry: list[bytes] = []
    hashed = xxhash.xxh64_intdigest
    for run in spaced_words(text, lower=True):
        words = carry + run
        if len(words) < shingle:
            carry = words
            continue
        h = np.fromiter((hashed(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))), np.uint64)
        for part in np.array_split(h, -(-len(h) // 65536)):
            votes += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
        n += len(h)
        carry = words[len(words) - shingle + 1 :]
    if not n:
        return hashed(b" ".join(carry), SEED) if carry else 0
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """Columns doc_id and fp (the fingerprint's 64 bits as a long), a row per document; ``hashed`` adds the text's sha."""
    short_batches(docs.sparkSession)
    rows = ids_and_texts(docs, id_col, text_col)
    rows = rows.withColumn("sha", F.sha2("text", 256)) if hashed else rows

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "sha"][: len(columns)])

    return rows.mapInArrow(run, "doc_id long, fp long" + ", sha string" * hashed)


def bit_counts(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How often two bits are set together over all fingerprints (64 x 64), and the number of fingerprints."""

    def run(batches):
        gram, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            rows = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(rows.view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float64)
            gram += (bits.T @ bits).astype(np.int64)
            n += len(rows)
        values = np.append(gram.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["at", "n"])

    total = fps.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    out = np.zeros(BITS * BITS + 1, np.int64)
    for at, n in total.collect():  # BITS * BITS + 1 sums, whatever the corpus
        out[at] = n
    return out[:-1].reshape(BITS, BITS), int(out[-1])


def correlated_groups(gram: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size: each group grows by the bit most correlated with it."""
    p = np.diag(gram) / n
    cov = gram / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for g in range(parts):
        size = len(free) // (parts - g)
        strength = corr[np.ix_(free, free)].sum(axis=1)
        group = [free.pop(int(np.argmax(strength)))]
        while len(group) < size:
            pull = corr[np.ix_(free, group)].sum(axis=1)
            group.append(free.pop(int(np.argmax(pull))))
        groups.append(group)
    return groups


def chance_within(group: list[int], gram: np.ndarray, n: int, most: int) -> list[float]:
    """Estimated chance that two fingerprints differ in at most t bits of the group, t = 0 .. most.

    Bits form a chain in which each depends on the one before it, by the pair counts of all fingerprints.
    """
    p = np.diag(gram) / n
    agree = p**2 + (1 - p) ** 2
    state = np.zeros((2, most + 2))  # last bit differs or not; bits that differ, the last column for more
    first = group[0]
    state[0, 0], state[1, min(1, most + 1)] = agree[first], 1 - agree[first]
    for i, j in itertools.pairwise(group):
        p11 = gram[i, j] / n
        p10, p01 = p[i] - p11, p[j] - p11
        p00 = 1 - p11 - p10 - p01
        same = p11**2 + p10**2 + p01**2 + p00**2
        only_i = 2 * (p11 * p10 + p01 * p00)  # i agrees, j differs
        stay = np.clip(same / max(same + only_i, 1e-12), 0, 1)
        only_j = 2 * (p11 * p01 + p10 * p00)
        back = np.clip(only_j / max(1 - agree[i], 1e-12), 0, 1)
        new = np.zeros_like(state)
        new[0] = state[0] * stay + state[1] * back
        for was, chance in ((0, 1 - stay), (1, 1 - back)):
            new[1, 1:] += state[was, :-1] * chance
            new[1, -1] += state[was, -1] * chance
        state = new
    return list(np.cumsum(state.sum(axis=0))[: most + 1])


def allocate(groups: list[list[int]], gram: np.ndarray, n: int, most: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with sum most - parts + 1 and the least estimated cost, by dynamic programming.

    A group with threshold t costs a row for each choice of t masked bits and fingerprint, and the pairs that
    are expected to agree within t bits; threshold -1 leaves the group out.
    """
    target = most - len(groups) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        chance = chance_within(group, gram, n, most)
        costs = {-1: 0.0} | {t: n * comb(len(group), t) + n * (n - 1) / 2 * chance[t] for t in range(min(most, len(group)) + 1)}
        new: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t, more in costs.items():
                if total + t not in new or cost + more < new[total + t][0]:
                    new[total + t] = (cost + more, [*chosen, t])
        best = new
    return best[target]


def probe_masks(gram: np.ndarray, n: int, most: int) -> list[int]:
    """Bit masks such that fingerprints within ``most`` bits are equal under at least one of them."""
    plans = []
    for parts in range(1, most + 3):
        groups = correlated_groups(gram, n, parts)
        cost, thresholds = allocate(groups, gram, n, most)
        plans.append((cost, parts, groups, thresholds))
    _, _, groups, thresholds = min(plans, key=lambda x: x[:2])
    masks = []
    for group, t in zip(groups, thresholds):
        for hidden in itertools.combinations(group, t) if t >= 0 else ():
            masks.append(sum(1 << b for b in group if b not in hidden))
    return masks


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def close_pairs(fps: DataFrame, most: int, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between distinct fingerprints that connect exactly those within ``most`` differing bits.

    Fingerprints equal under a probe mask share a bucket.  In buckets of up to ``bucket`` fingerprints every
    pair is verified by its bit distance.  Members of larger buckets meet on ball keys instead: balls of
    half the distance overlap exactly for fingerprints within the distance, so all members of a key link to
    its smallest one, in work proportional to the members, and no pair list of a large bucket is ever made.
    """
    gram, n = bit_counts(fps)
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks = probe_masks(gram, n, most)
    keys = F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v")) for k, m in enumerate(masks)))
    probes = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    sizes = probes.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(probes.join(sizes, ["k", "v"]))
    small = shared.where(F.col("n") <= bucket)
    one, two = small.alias("one"), small.alias("two")
    pairs = one.join(
        two,
        (F.col("one.k") == F.col("two.k"))
        & (F.col("one.v") == F.col("two.v"))
        & (F.col("one.fp") < F.col("two.fp"))
        & (F.bit_count(F.col("one.fp").bitwiseXOR(F.col("two.fp"))) <= most),
    ).select(F.col("one.fp").alias("a"), F.col("two.fp").alias("b"))
    crowded = shared.where(F.col("n") > bucket).select("fp").distinct()
    flips = [sum(1 << b for b in c) for r in range(most // 2 + 1) for c in itertools.combinations(range(BITS), r)]
    hides = [1 << b for b in range(BITS)] if most % 2 else [0]
    full = (1 << BITS) - 1
    flipped = crowded.select("fp", F.explode(F.array(*(F.lit(_signed(x)) for x in flips))).alias("x"))
    hidden = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(_signed(full ^ x)).alias("m")) for k, x in enumerate(hides))))
    balls = flipped.select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("ball"), hidden.alias("h")).select(
        "fp", F.col("h.k").alias("k"), F.col("ball").bitwiseAND(F.col("h.m")).alias("v")
    )
    heads = balls.groupBy("k", "v").agg(F.min("fp").alias("head"), F.max("fp").alias("last")).where("head < last")
    stars = balls.join(heads.drop("last"), ["k", "v"]).where("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def _groups(own: DataFrame, first: Column, max_bits: int, bucket: int) -> DataFrame:
    """fp, first (the least of its rows) and root, the same for all of a component, of the distinct fingerprints."""
    classes = settle(own.groupBy("fp").agg(F.min(first).alias("first")))
    linked = smallest_reachable(close_pairs(classes.select("fp"), max_bits, bucket))
    return classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Columns doc_id, fingerprint (hex) and component_id (smallest doc_id reachable) of every row.

    Null and empty texts have fingerprint zero and are linked like any other.  Rows that repeat a doc_id each
    keep their row.  A row without doc_id is linked, but names no component: its component_id is the smallest
    doc_id reachable, or null if there is none.  An empty table gives no rows.
    """
    own = settle(fingerprints(docs, shingle, id_col, text_col))
    groups = _groups(own, F.col("doc_id"), max_bits, bucket)
    ids = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    named = groups.join(ids, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of the smallest (doc_id, text hash) of every group, with all columns.

    Rows that repeat a doc_id but stand in different groups are judged each in its own; of rows equal in id and
    text the one of the least other columns stays.  Rows without doc_id stay as they are: nothing could name
    them as the copy of another.
    """
    own = settle(fingerprints(docs, shingle, id_col, text_col, hashed=True))
    first = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "sha"))
    heads = _groups(own, first, max_bits, BUCKET).groupBy("root").agg(F.min("first").alias("head")).where("head is not null")
    heads = heads.select(F.col("head.doc_id").alias("·head"), F.col("head.sha").alias("·text"))
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns))
    others = F.to_json(F.struct(docs[text_col].isNull().alias("·null"), *(docs[f"`{c}`"] for c in docs.columns if c != text_col)))
    rows = docs.select(docs[id_col].cast("long").alias("·id"), F.sha2(whole_text(docs[text_col]), 256).alias("·sha"), row.alias("·row"), others.alias("·others"))
    mine = rows.join(heads, (F.col("·id") == F.col("·head")) & (F.col("·sha") == F.col("·text")), "left_semi")
    kept = mine.groupBy("·id", "·sha").agg(F.min_by("·row", "·others").alias("·row")).select("·row.*")
    return kept.unionByName(docs.where(docs[id_col].cast("long").isNull()))
