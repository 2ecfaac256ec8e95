"""Key automata, posting bounds and visited buckets against plain searches."""

import math
import pathlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import multipattern as P
from tidewell.operators import postings as packed
from tidewell.operators import relational as R
from tidewell.operators import retrieval as X
from tidewell.session import scratch_dir


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_first_key_matches_brute_force(spark, rng, monkeypatch, block):
    monkeypatch.setattr(P, "deal", lambda rows, by, key, size=block, real=P.deal: real(rows, by, key, size))
    word = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    keys = list({word(rng.randrange(1, 6)) for _ in range(60)}) + ["", "a" * 300]
    entries = [(k, f"v{i}", rng.randrange(40)) for i, k in enumerate(keys)] + [(None, "none", 0), ("a" * 300, "late", 99)]
    texts = [(i, word(rng.randrange(0, 20)).upper(), i % 3) for i in range(120)] + [(500, None, 0), (501, "", 0), (502, "B" + "A" * 400, 1), (1, "zz", 9)]
    got = R.contains_lookup(
        spark.createDataFrame(texts, "id int, t string, extra int"), "id", "t", spark.createDataFrame(entries, "k string, v string, r int"), "k", "v", "r", "no"
    )
    assert got.columns == ["id", "t", "extra", "answer"]
    best = {}
    for k, v, r in entries:
        if k and (k not in best or r < best[k][0]):
            best[k] = (r, v)
    for row in got.collect():
        found = [(r, k, v) for k, (r, v) in best.items() if row.t and k in row.t.lower()]
        assert row.answer == (min(found)[2] if found else "no"), row
    assert got.count() == len(texts)


@pytest.mark.parametrize("block", [24, 1 << 20])
def test_term_counts_match_brute_force(spark, rng, monkeypatch, block):
    monkeypatch.setattr(P, "deal", lambda rows, by, key, size=block, real=P.deal: real(rows, by, key, size))
    texts = [(i, "".join(rng.choice("ab c") for _ in range(rng.randrange(0, 60)))) for i in range(90)] + [(90, None), (91, ""), (None, "ab ab")]
    words = [(q, "".join(rng.choice("abc") for _ in range(rng.randrange(1, 4))), rng.randrange(1, 4)) for q in range(12) for _ in range(3)]
    words = list({(q, t): (q, t, m) for q, t, m in words}.values())
    got = P.count_topk(
        spark.createDataFrame(texts, "doc int, t string").repartition(3), "doc", "t", spark.createDataFrame(words, "q int, term string, m int"), "q", 4, step=7
    )
    best = {}
    for r in got.collect():
        best.setdefault(r.q, []).append((-r.score, r.doc))
    for q in range(12):
        want = [(-sum(m * t.count(term) for qq, term, m in words if qq == q), d) for d, t in texts if t and d is not None]
        assert sorted(best.get(q, []))[:4] == sorted(w for w in want if w[0] < 0)[:4]


def test_no_keys_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a")], "id int, t string")
    none = spark.createDataFrame([], "k string, v string, r int")
    assert [r.answer for r in R.contains_lookup(texts, "id", "t", none, "k", "v", "r", "no").collect()] == ["no"]
    one = spark.createDataFrame([("a", "x", 1)], "k string, v string, r int")
    assert R.contains_lookup(texts.limit(0), "id", "t", one, "k", "v", "r", "no").collect() == []


def plain_bm25(docs, queries, k1=1.5, b=0.75):
    tf = {d: Counter(t.split()) for d, t in docs}
    n, avg = len(docs), sum(sum(c.values()) for c in tf.values()) / len(docs)
    df = Counter(w for c in tf.values() for w in c)
    idf = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    mean = sum(idf.values()) / len(idf)
    out = {}
    for q, t in queries:
        for d, c in tf.items():
            s = 0.0
            for w, m in Counter(t.split()).items():
                if c[w]:
                    s += m * (idf[w] if idf[w] >= 0 else 0.25 * mean) * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * sum(c.values()) / avg))
            out[q, d] = round(s, 9)
    return out


def corpus(rng, n):
    return [(i, " ".join(["the"] * rng.randrange(1, 9) + [f"w{min(int(rng.paretovariate(0.6)), 3000)}" for _ in range(rng.randrange(3, 40))])) for i in range(n)]


def test_bounds_keep_the_best_and_score_few_pairs(spark, rng):
    docs = corpus(rng, 1500)
    queries = [(i, "the the " + " ".join(rng.choice(docs)[1].split()[-3:])) for i in range(25)]
    frames = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(queries, "item_id int, text string")
    want = plain_bm25(docs, queries)
    index = X.posting_index(frames[0])
    hits = {(r.item_id, r.doc_id): r.score for r in X.index_hits(index, frames[1], 3).collect()}
    assert len(hits) < 0.1 * len(docs) * len(queries)  # every document holds a query word
    assert all(s == pytest.approx(want[p], abs=2e-9) for p, s in hits.items())
    for r in X.bm25_topk(*frames, 3).collect() + X.index_topk(index, *frames, 3).collect():
        order = sorted(((-s, d) for (q, d), s in want.items() if q == r.item_id))
        assert r.score == pytest.approx(-order[r["rank"] - 1][0], abs=2e-9)


def test_index_takes_less_room_than_the_texts(spark, rng):
    docs, scratch = corpus(rng, 4000), pathlib.Path(scratch_dir(spark), "tidewell")
    before = {*scratch.glob("*")}
    frames = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(1, "the w7 w900"), (2, "w11 w12")], "item_id int, text string")
    index = X.posting_index(frames[0])
    X.index_topk(index, *frames, 3).collect()
    kept = sum(p.stat().st_size for folder in {*scratch.glob("*")} - before for p in folder.rglob("*.parquet"))
    assert kept < sum(len(t) for _, t in docs)
    postings = sum(len(set(t.split())) for _, t in docs)
    assert index.postings.count() == postings > 50 * index.segments.count()
    top = {(r.term, r.block): r.peak for r in index.peaks.collect()}
    assert all(r.reach <= top[r.term, r.block] for r in index.postings.collect())


def joined_bm25(docs, queries):
    """Scores above 0 or below, texts of one id being one document."""
    tf = {}
    for d, t in docs:
        tf.setdefault(d, Counter()).update((t or "").split())
    n, avg = len(docs), sum(c.total() for c in tf.values()) / len(docs)
    df = Counter(w for c in tf.values() for w in c)
    idf = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    mean = sum(idf.values()) / len(idf)
    weigh = lambda w: idf[w] if idf[w] >= 0 else 0.25 * mean
    reach = lambda x, size: x * 2.5 / (x + 1.5 * (0.25 + 0.75 * size / avg))
    words = {q: Counter(t.split()) for q, t in queries}
    return {
        (q, d): round(sum(m * weigh(w) * reach(c[w], c.total()) for w, m in ws.items() if c[w]), 9)
        for q, ws in words.items() for d, c in tf.items() if any(c[w] for w in ws)
    }


@pytest.mark.parametrize("docs_of, postings, together", [(48, 90, 3), (4096, 1 << 20, 64)])
def test_small_segments_cut_documents_and_repeated_ids(spark, rng, monkeypatch, docs_of, postings, together):
    monkeypatch.setattr(packed, "DOCS", docs_of)
    monkeypatch.setattr(packed, "POSTINGS", postings)
    monkeypatch.setattr(X, "TOGETHER", together)
    docs = [(f"d{i:03d}", t) for i, t in corpus(rng, 400)]
    docs += [(f"d{i:03d}", t) for i, t in corpus(rng, 60)]  # two texts of an id
    docs += [("hot", t) for _, t in corpus(rng, 70)] + [(None, t) for _, t in corpus(rng, 70)]  # many texts, and more terms than a segment's
    docs += [("long", " ".join(f"w{i}" for i in range(900))), ("blank", " "), ("none", None)]
    queries = [(f"q{i}", "the " + " ".join(rng.choice(docs[:400])[1].split()[-4:])) for i in range(20)]
    frames = spark.createDataFrame(docs, "doc_id string, text string").repartition(5), spark.createDataFrame(queries, "item_id string, text string")
    index, want = X.posting_index(frames[0]), joined_bm25(docs, queries)
    assert index.n == len(docs) and (index.segments.filter("not whole").count() > 12) == (postings == 90)
    assert {(r.doc_id, r.term) for r in index.postings.collect()} == {(d, w) for d, t in docs for w in (t or "").split()}
    hits = {(r.item_id, r.doc_id): r.score for r in X.index_hits(index, frames[1], 3).collect()}
    assert all(s == pytest.approx(want[p], abs=2e-9) for p, s in hits.items())
    best = {}
    for r in X.index_topk(index, *frames, 3).collect():
        best.setdefault(r.item_id, {})[r["rank"]] = (r.doc_id, round(r.score, 7))
    for q, _ in queries:
        order = sorted(((-round(s, 7), d or "", d) for (i, d), s in want.items() if i == q and s > 0))[:3]
        assert [best[q][i + 1] for i in range(len(order))] == [(d, -s) for s, _, d in order]


def test_negative_weights_open_every_block(spark):
    docs = [(i, "a b c d " + "a " * (i % 4) + "e " * (i == 7)) for i in range(60)] + [(60, "b")]
    queries = [(1, "a"), (2, "a b e"), (3, "d zz")]
    frames = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(queries, "item_id int, text string")
    want = joined_bm25(docs, queries)
    assert min(want.values()) < 0 < max(want.values())
    hits = {(r.item_id, r.doc_id): r.score for r in X.index_hits(X.posting_index(frames[0]), frames[1], 3).collect()}
    assert all(s == pytest.approx(want[p], abs=2e-9) for p, s in hits.items())
    for q, _ in queries:
        order = sorted((-round(s, 7), d) for (i, d), s in want.items() if i == q)[:3]
        assert sorted((-round(s, 7), d) for (i, d), s in hits.items() if i == q)[:3] == order


def test_visited_buckets_find_nine_in_ten(spark):
    g = np.random.default_rng(3)
    centres = g.normal(size=(20, 32)) * 3
    x = centres[g.integers(0, 20, 3000)] + g.normal(size=(3000, 32))
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id int, embedding array<double>")
    asked = vecs.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    exact = {(r.query_id, r.vec_id) for r in X.vector_topk(vecs, asked, 10).collect()}
    found = X.vector_topk(vecs, asked, 10, probing=X.Probing(bucket=200)).collect()
    assert len({(r.query_id, r["rank"]) for r in found}) == len(found) == 600
    assert len(exact & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(exact)
    for r in found[:50]:
        assert r.distance == pytest.approx(float(np.linalg.norm(x[r.query_id] - x[r.vec_id])))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_exact_search_with_ties_nulls_and_text_ids(spark, metric):
    rows = [(f"v{i % 7}-{i:02d}", [float(i % 5), float(i % 3), 1.0]) for i in range(60)] + [("none", None), ("zero", [0.0, 0.0, 0.0])]
    vecs = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    asked = vecs.filter(F.col("embedding").isNotNull()).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    got = {}
    for r in X.vector_topk(vecs, asked, 4, metric).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    known = {i: np.array(v) for i, v in rows if v is not None}
    size = lambda v: max(float(np.linalg.norm(v)), 1e-300)
    far = lambda a, b: round(float(np.linalg.norm(a - b)) if metric == "l2" else 1 - float(a @ b) / size(a) / size(b), 12)
    for q, v in known.items():
        assert [i for _, i in sorted(got[q])] == [i for _, i in sorted((far(v, w), i) for i, w in known.items())[:4]]
