"""Embedding near-duplicates by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.components import smallest_reachable
from tidewell.session import drop_settled, settle

COSINE = 0.95
#: Vectors at each side that a vector is compared with at least, in the order of a pass.
WINDOW = 256
#: Random hashes of a sort key, the share of pairs at the threshold to be found, and passes at least.
HASHES, RECALL, PASSES = 48, 0.995, 4
SEED = 5
#: Vectors whose links are found by brute force to measure a pass count, links of each that are kept in a batch and
#: altogether, and the share of these links that the passes have to meet.
SAMPLE, SAMPLE_LINKS, MEASURED = 256, 64, 0.97
_BLOCKS = "pass int, dim int, low long, gap int"


def pass_count(n: int, cosine: float, window: int, recall: float) -> int:
    """Passes by which a pair right at the threshold meets in a window with chance ``recall``.

    About log2(n / window) hashes must agree for that in one pass, each with chance 1 - angle / pi; closer
    pairs meet more often.
    """
    agree = (1 - math.acos(cosine) / math.pi) ** max(0.0, math.log2(max(n, 2) / window))
    return max(PASSES, math.ceil(math.log(1 - recall) / math.log(max(1e-12, 1 - min(agree, 1 - 1e-9)))))


def _usable(docs: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Columns vec_id, v (doubles, null unless all components are finite and one is not zero)."""
    v = docs[vec_col].cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return docs.select(docs[id_col].cast("long").alias("vec_id"), F.when(fine, v).alias("v"))


def _unit(flat: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest component first keeps squares in range."""
    x = flat / np.abs(flat).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(classes: DataFrame, begin: int, end: int) -> DataFrame:
    """rep, pass, key of passes ``begin`` to ``end``: the signs of random projections, one after another, as the bits of a long."""
    passes = end - begin

    def run(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            for size in sorted({len(v) for v in vectors}):
                rows = [i for i, v in enumerate(vectors) if len(v) == size]
                x = _unit(np.array([vectors[i] for i in rows], np.float64))
                planes = np.concatenate([np.random.default_rng([SEED, size, p]).normal(size=(size, HASHES)) for p in range(begin, end)], axis=1)
                bits = (x @ planes > 0).reshape(len(rows), passes, HASHES)
                keys = (bits.astype(np.int64) << np.arange(HASHES - 1, -1, -1)).sum(axis=2)
                reps = batch.column(0).take(pa.array(np.repeat(rows, passes)))
                turn = np.tile(np.arange(begin, end, dtype=np.int32), len(rows))
                dim = np.full(len(turn), size, np.int32)
                yield pa.RecordBatch.from_arrays([reps, pa.array(turn), pa.array(dim), pa.array(keys.ravel())], ["rep", "pass", "dim", "key"])

    return classes.select("rep", "v").mapInArrow(run, "rep long, pass int, dim int, key long")


def _ranks(keys: DataFrame) -> DataFrame:
    """rep, pass, rank: places in the order (pass, dim, key, rep) of all rows, by a range shuffle and offsets."""
    ordered = settle(
        keys.repartitionByRange("pass", "dim", "key", "rep").sortWithinPartitions("pass", "dim", "key", "rep").withColumn("part", F.spark_partition_id())
    )

    def number(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            parts = batch.column(3).to_numpy()
            out = np.empty(len(parts), np.int64)
            for p in np.unique(parts):
                mine = np.flatnonzero(parts == p)
                out[mine] = seen.get(int(p), 0) + np.arange(len(mine))
                seen[int(p)] = int(out[mine[-1]]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(out)], ["rep", "pass", "dim", "part", "at"])

    placed = ordered.groupBy("part").agg(F.count("*").alias("n"))
    offsets, total = [], 0
    for part, n in sorted(tuple(r) for r in placed.collect()):  # a row for each shuffle partition
        offsets.append((part, total))
        total += n
    spark = keys.sparkSession
    starts = spark.createDataFrame(offsets or [(0, 0)], "part int, before long")
    again = ordered.repartition("part").sortWithinPartitions("part", "pass", "dim", "key", "rep").select("rep", "pass", "dim", "part")
    return again.mapInArrow(number, "rep long, pass int, dim int, part int, at long").join(starts, "part").select(
        "rep", "pass", "dim", (F.col("before") + F.col("at")).alias("rank")
    )


def _sampled_links(classes: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) of ``SAMPLE`` classes, drawn by hash, with all classes; of very many links of one some are kept."""
    sample = [(r["rep"], r["v"]) for r in classes.orderBy("rep").limit(SAMPLE).select("rep", "v").collect()]

    def run(batches):
        for batch in batches:
            vectors, reps = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            for size in sorted({len(v) for v in vectors} & {len(v) for _, v in sample}):
                rows = np.array([i for i, v in enumerate(vectors) if len(v) == size])
                names = np.array([r for r, v in sample if len(v) == size])
                hit = _linked(_unit(np.array([v for _, v in sample if len(v) == size], np.float64)), _unit(np.array([vectors[i] for i in rows], np.float64)), cosine)
                hit &= names[:, None] != reps[rows][None, :]
                hit &= np.cumsum(hit, axis=1) <= SAMPLE_LINKS
                i, j = np.nonzero(hit)
                yield pa.RecordBatch.from_arrays([pa.array(names[i], pa.int64()), pa.array(reps[rows[j]], pa.int64())], ["a", "b"])

    found = classes.select("rep", "v").mapInArrow(run, "a long, b long")
    some = Window.partitionBy("a").orderBy(F.xxhash64("a", "b"), "b")
    return found.withColumn("place", F.row_number().over(some)).where(F.col("place") <= SAMPLE_LINKS).drop("place")


def _met(links: DataFrame, ranks: DataFrame) -> float:
    """Share of the links whose ends stand in the same or in neighbouring blocks in some pass; 1 without links."""
    end = lambda name: ranks.select(F.col("rep").alias(name), "pass", F.col("block").alias(f"block_{name}"))
    both = links.join(end("a"), "a").join(end("b"), ["b", "pass"]).groupBy("a", "b")
    return both.agg(F.max((F.abs(F.col("block_a") - F.col("block_b")) <= 1).cast("double")).alias("met")).agg(F.avg("met")).first()[0] or 0.0


def _ranked(classes: DataFrame, cosine: float, window: int, recall: float) -> DataFrame:
    """rep, pass, dim, rank, block of as many passes as the vectors need.

    Their number follows from the number of classes as if these pointed everywhere.  Where many of them point
    alike it takes more, so links of a bounded sample, found by brute force over all classes, are looked for in
    the passes, and passes are added until ``MEASURED`` of them meet or the passes compare as many pairs as brute
    force would.
    """
    n = classes.count()
    blocks = lambda begin, end: settle(_ranks(_keys(classes, begin, end)).withColumn("block", F.floor(F.col("rank") / window)))
    passes = pass_count(n, cosine, window, recall)
    ranks, links = blocks(0, passes), settle(_sampled_links(classes, cosine))
    if links.isEmpty():
        return ranks
    while _met(links, ranks) < MEASURED and passes * window < n:
        more = passes + max(1, passes // 2)
        ranks, passes = ranks.unionByName(blocks(passes, more)), more
    return ranks


def _linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    return x @ y.T >= cosine


def _compare(members: DataFrame, cosine: float, window: int, final: bool) -> DataFrame:
    """Compare the two blocks of each group (pass, dim, low, gap); a group holds at most two blocks.

    Members hold the group, rep, size, v, rank and, in the final round, blocks and reaches of all passes.
    The first rounds return the groups with a link at least ``window`` ranks apart; the final one returns
    each row's number of links that no earlier pass has compared, and a link to the smallest row of each
    linked set of the group.
    """

    def explore(key, table):
        x, rank, low = _matrix(table), table["rank"].to_numpy(), key[2].as_py()
        first = rank // window == low
        hit = _linked(x[first], x[~first], cosine) & (rank[~first][None, :] - rank[first][:, None] >= window)
        return pa.table([[k.as_py()] for k in key], schema=_schema_pairs) if hit.any() else _schema_pairs.empty_table()

    def count(key, table):
        turn, _, low, gap = (k.as_py() for k in key)
        x, rank = _matrix(table), table["rank"].to_numpy()
        rep, size = table["rep"].to_numpy(), table["size"].to_numpy()
        blocks, reaches = (np.array(table[c].to_pylist(), np.int64).reshape(len(x), -1) for c in ("blocks", "reaches"))
        one = np.flatnonzero(rank // window == low)
        two = np.flatnonzero(rank // window == low + gap)
        hit = _linked(x[one], x[two], cosine)
        if gap == 0:
            hit &= np.triu(np.ones(hit.shape, bool), 1)
        i, j = np.nonzero(hit)
        i, j = one[i], two[j]
        new = np.ones(len(i), bool)
        for earlier in range(turn):  # a pair counts in the first pass that compares it
            a, b = blocks[i, earlier], blocks[j, earlier]
            reach = np.where(a <= b, reaches[i, earlier], reaches[j, earlier])
            new &= np.abs(a - b) > reach
        links = np.bincount(i[new], size[j[new]], len(x)) + np.bincount(j[new], size[i[new]], len(x))
        root = np.arange(len(x))
        order = np.argsort(rep)
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        best = place.copy()
        while True:  # smallest row of each linked set
            low_ends = best.copy()
            np.minimum.at(low_ends, i, best[j])
            np.minimum.at(low_ends, j, best[i])
            if (low_ends == best).all():
                break
            best = low_ends
        root = rep[order[best]]
        keep = (links > 0) | (root != rep)
        return pa.table({"rep": rep[keep], "root": root[keep], "links": links[keep].astype(np.int64)}, _schema_links)

    grouped = members.groupBy("pass", "dim", "low", "gap")
    return grouped.applyInArrow(count, "rep long, root long, links long") if final else grouped.applyInArrow(explore, _BLOCKS)


_schema_pairs = pa.schema([("pass", pa.int32()), ("dim", pa.int32()), ("low", pa.int64()), ("gap", pa.int32())])
_schema_links = pa.schema([("rep", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _matrix(table: pa.Table) -> np.ndarray:
    column = table["v"].combine_chunks()
    return _unit(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept: links of cosine >= ``cosine`` found, and their components.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, vectors of
    different length never link.  Equal vectors are one class, compared once; a class of any size links all
    its members.  Each pass sorts the classes by the concatenated signs of random projections and compares
    blocks of ``window`` neighbours with themselves and the next block, so every group holds two blocks at
    most.  Where a link spans a whole window the set may reach further: the next block is compared as well,
    as long as such links appear.  A pair counts in the first pass that compares it; a block reports counts
    and a spanning set of links, never its list of pairs.  The number of passes follows from the number of
    classes, the threshold and the recall asked for, and from the recall measured on a sample.  Rows that repeat a vec_id are vectors of their own; a
    null vec_id keeps its row, counts as a link of others and names no component (its own component_id is the
    smallest vec_id reachable, or null).  An empty table gives no rows.
    """
    rows = settle(_usable(vectors, id_col, vec_col).withColumn("code", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))), 256))))
    # a class is known by a number of its own, as its vec_ids may be null
    classes = settle(
        rows.where("v is not null").groupBy("code").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"), F.any_value("v").alias("v")).withColumn("rep", F.xxhash64("code"))
    )
    if classes.isEmpty():
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    ranks = _ranked(classes, cosine, window, recall)
    placed = settle(ranks.join(classes.select("rep", "size", "v"), "rep"))
    # blocks at the seams of passes and dimensions never meet: vectors of another length cannot link
    known = ranks.select("pass", "dim", "block").distinct()
    same = known.select("pass", "dim", F.col("block").alias("low"), F.lit(0).alias("gap"))
    following = known.select("pass", "dim", (F.col("block") - 1).alias("low")).join(same.drop("gap"), ["pass", "dim", "low"]).withColumn("gap", F.lit(1))
    done = settle(same.unionByName(following))
    frontier = done.where("gap = 1")
    while True:
        active = _compare(_members(frontier, placed), cosine, window, final=False)
        ends = known.select("pass", "dim", F.col("block").alias("end"))
        longer = active.withColumn("gap", F.col("gap") + 1).withColumn("end", F.col("low") + F.col("gap"))
        onward = settle(longer.join(ends, ["pass", "dim", "end"]).select("pass", "dim", "low", "gap"))
        if onward.isEmpty():
            break
        grown = settle(done.unionByName(onward))
        drop_settled(done)
        done, frontier = grown, onward
    reach = done.groupBy("pass", "dim", F.col("low").alias("block")).agg(F.max("gap").alias("reach"))
    where = ranks.join(reach, ["pass", "dim", "block"]).groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("pass", "block", F.col("reach").cast("long").alias("reach")))).alias("w"))
    full = placed.join(where.select("rep", F.col("w.block").alias("blocks"), F.col("w.reach").alias("reaches")), "rep")
    found = settle(_compare(_members(done, full, "size", "blocks", "reaches"), cosine, window, final=True))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = smallest_reachable(found.where("root <> rep"), "rep", "root")
    named = classes.select("code", "rep", "first", "size").join(links, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    named = named.select("code", "first", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("set"))
    least = named.groupBy("set").agg(F.min("first").alias("least"))
    labels = named.join(least, "set").select("code", "n", "least")
    out = rows.select("vec_id", "code").join(labels, "code", "left")
    component = F.when(F.col("code").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.col("code").isNull()).alias("kept"),
    )


def _members(pairs: DataFrame, placed: DataFrame, *more: str) -> DataFrame:
    """The rows of both blocks of every pair (pass, dim, low, gap)."""
    ends = pairs.select("pass", "dim", "low", "gap", F.explode(F.array_distinct(F.array("low", F.col("low") + F.col("gap")))).alias("block"))
    return placed.join(ends, ["pass", "dim", "block"]).select("pass", "dim", "low", "gap", "rep", "v", "rank", *more)
