"""Steps that have to hold for tables of any size: what is built where, and the same rows as before."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions import strings as S
from tidewell.operators import chunking as C
from tidewell.operators import evaluation as E
from tidewell.operators import forest as FO
from tidewell.operators import models as M
from tidewell.operators import retrieval as X
from tidewell.streaming import jobs as ST


def test_stream_of_a_table_in_several_files(spark, tmp_path):
    rows = [(i, f"text {i % 4}", "en" if i == 0 else "de") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    df.write.parquet(str(tmp_path / "other.parquet"))
    stream = ST.stream_files(spark, str(tmp_path), df, "documents.parquet")
    got = ST.corpus_add(stream, df.filter("lang = 'en'"), "text", ["doc_id"], str(tmp_path / "job")).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3]


def test_stream_of_a_table_in_one_file(spark, tmp_path):
    df = spark.range(5)
    df.coalesce(1).write.parquet(str(tmp_path / "parts"))
    next((tmp_path / "parts").glob("*.parquet")).rename(tmp_path / "table.parquet")
    stream = ST.stream_files(spark, str(tmp_path), df, "table.parquet")
    assert ST.run_append(stream, str(tmp_path / "job")).count() == 5


@pytest.mark.parametrize("node", [150, 100_000])
def test_forest_of_classes_in_nodes_of_any_size(spark, node):
    rng = random.Random(2)
    x = [(rng.random(), rng.random(), rng.random()) for _ in range(1600)]
    rows = [(i, float((a > 0.5) != (b > 0.4)), "test" if i % 5 == 0 else "train", a, b, c) for i, (a, b, c) in enumerate(x)]
    data = M.assemble(spark.createDataFrame(rows, "id int, label double, part string, a double, b double, c double"), ["a", "b", "c"], ["id", "label", "part"])
    train, test = M.balance(data.filter("part = 'train'"), "label"), data.filter("part = 'test'")
    got = FO.Forest(2, 3, 20, 30, 7, node).scores(train, test, "id").collect()
    assert len(got) == 320 and all(sum(r.probability) == pytest.approx(1) for r in got)
    assert sum(r.label == r.prediction for r in got) > 0.93 * len(got)
    again = FO.Forest(2, 3, 20, 30, 7, node).scores(train.repartition(5), test, "id").collect()
    assert sum(r.probability[1] for r in got) == pytest.approx(sum(r.probability[1] for r in again), rel=0.05)


@pytest.mark.parametrize("node", [150, 100_000])
def test_forest_of_numbers(spark, node):
    rng = random.Random(3)
    rows = [(i, 10 * a + b, "test" if i % 5 == 0 else "train", a, b) for i in range(1500) for a, b in [(rng.random(), rng.random())]]
    data = M.assemble(spark.createDataFrame(rows, "id int, label double, part string, a double, b double"), ["a", "b"], ["id", "label", "part"])
    got = FO.Forest(0, 2, 20, 30, 7, node).scores(data.filter("part = 'train'"), data.filter("part = 'test'"), "id").collect()
    assert len(got) == 300 and sum(abs(r.label - r.prediction) for r in got) / 300 < 1.2


def test_reports_collect_no_forest():
    """A Spark ML forest is gathered in the driver."""
    size = M.ModelSize()
    made = [M._classifiers(3, 2, 1, size)["random_forest"], M._regressors(3, 1, size)["random_forest"]]
    assert all(isinstance(m, FO.Forest) and (m.trees, m.depth) == (300, 30) for m in made)


def test_no_draw_and_one_row(spark):
    data = M.assemble(spark.createDataFrame([(1, 1.0, 2.0), (2, 0.0, 3.0)], "id int, label double, a double"), ["a"], ["id", "label"])
    got = FO.Forest(2, 1, 3, 30, 1).scores(data.limit(1), data, "id").collect()
    assert len(got) == 2 and all(r.prediction in (0.0, 1.0) for r in got)


def test_medians_of_columns_with_gaps_only(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(M, "fit_medians", lambda df, cols, f=M.fit_medians: asked.append(list(cols)) or f(df, cols))
    df = spark.createDataFrame([(1, 1.0, 5), (2, None, 6), (3, 3.0, 7), (4, float("nan"), 8)], "id int, a double, b int")
    got = {r.id: r.features.toArray().tolist() for r in M.assemble(df, ["a", "b"], ["id"]).collect()}
    assert asked == [["a"]] and got == {1: [1.0, 5.0], 2: [2.0, 6.0], 3: [3.0, 7.0], 4: [2.0, 8.0]}
    assert M.assemble(df, ["b"], ["id"]).count() == 4 and asked == [["a"]]


def test_paths_of_ranked_trees():
    g = np.random.default_rng(1)
    x = np.round(g.random((500, 3)), 1)
    trees = [M._grow_tree(x[g.integers(0, 500, 64)], g, 6) for _ in range(5)]
    cuts, ranked = M._ranked(trees, 3)
    columns = [np.searchsorted(c, x[:, i]).astype(np.uint32) for i, c in enumerate(cuts)]
    flat, rows = np.stack(columns, axis=1).ravel(), np.arange(500) * 3
    for (feature, cut, path), tree in zip(trees, ranked):
        at = np.zeros(500, int)
        for _ in range(6):
            at = 2 * at + 1 + (x[np.arange(500), feature[at]] > cut[at])
        assert (M._paths(tree, columns, flat, rows, 6) == path[at]).all()


def test_words_between_blanks_in_tasks(spark):
    texts = [f"a{chr(c)}b {chr(c)}c" for c in [*range(1, 0x2100), 0x3000, 0xFEFF] if not 0xD800 <= c < 0xE000] + ["", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", S.blank_split("text").alias("words"))
    assert all((r.words or []) == S.blank_words(r.text) for r in df.collect())


def test_postings_count_texts_of_one_id_together(spark):
    docs = spark.createDataFrame([(1, "a b a"), (1, "a c"), (2, "b"), (3, None), (None, "a"), (None, "z")], "doc_id int, text string")
    index = X.posting_index(docs)
    got = {(r.doc_id, r.term) for r in index.postings.collect()}
    assert got == {(1, "a"), (1, "b"), (1, "c"), (2, "b"), (None, "a"), (None, "z")} and index.n == 6
    assert {r.term: r.df for r in index.terms.collect()} == {"a": 2, "b": 2, "c": 1, "z": 1}
    reach = {(r.doc_id, r.term): r.reach for r in index.postings.collect()}
    assert reach[1, "a"] == pytest.approx(3 * 2.5 / (3 + 1.5 * (0.25 + 0.75 * 5 / (8 / 6))))


def test_cosines_move_no_row_for_a_term(spark):
    rows = [(1, "red cat", "red dog"), (1, "cat", "cat"), (2, "", "x"), (None, "same words", "same words"), (3, "one two", "one two")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    made = E.tfidf_pairs(df, ["id"], {"p": (F.col("a"), F.col("b"))})
    assert "Aggregate(keys=[id#" in (plan := made._jdf.queryExecution().executedPlan().toString()) or "ObjectHashAggregate" in plan
    assert "explode(concat" not in plan and "regexp_extract_all" in plan
    got = sorted((r.id or 0, round(r.cosine, 6)) for r in made.collect())
    only = 1 + math.log(1.5)
    x, y = {"red": 1, "cat": 2, "red cat": 1}, {"red": 1, "dog": 1, "red dog": 1, "cat": 1}
    idf = lambda t: 1.0 if t in x and t in y else only
    size = lambda v: math.sqrt(sum((n * idf(t)) ** 2 for t, n in v.items()))
    one = round(sum(x[t] * y[t] for t in x if t in y) / size(x) / size(y), 6)
    assert got == sorted([(1, one), (1, one), (2, 0.0), (0, 0.0), (3, 1.0)])


def test_summary_of_texts_with_one_id(spark):
    rows = [(1, "Red cat sat. Blue dog. Red cat."), (1, "Red cat ran. Short."), (2, None), (None, "Lost text here."), (3, "x. y.")]
    got = {r.doc_id: r.summary for r in C.extractive_summary(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text", per_chunk=1).collect()}
    assert got == {1: "Red cat ran.\nRed cat sat."}


def test_chunks_of_many_texts(spark):
    rows = [(i if i % 9 else None, f"{i} " * (i % 50) or None) for i in range(300)]
    got = C.chunk_recursive(spark.createDataFrame(rows, "id long, text string"), "id", "text", 40, 10).collect()
    want = [(i, k, c) for i, t in rows for k, c in enumerate(C.split_recursive(t or "", 40, 10))]
    key = lambda r: (r[0] is None, *[(v is not None, v) for v in r])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_sessions_of_a_key_with_ties(spark, tmp_path):
    from tests.test_streams import plain_sessions, run

    rng = random.Random(4)
    rows = [(1, 7 * rng.randrange(4000), f"l{k % 50}") for k in range(3000)]
    assert run(spark, tmp_path, [rows[:2000], rows[2000:]], 20, 3, "30 days", "ties") == plain_sessions(rows, 20, 3)
