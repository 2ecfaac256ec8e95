"""Quality, mixing, personal data, embeddings and the pipeline against plain versions."""

import hashlib
import os
import pathlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.conftest import DOCS, words
from tests.oracle import compare, connect
from tidewell.llm import embeddup, mixing, pii, quality
from tidewell.llm.queries import QUERIES, SQL
from tidewell.llm.sql import mixing_sql

SF = "/root/testdata/sf0.001"
DOC_COLUMNS = DOCS.fieldNames()


def test_factorisation_machine_equals_the_sum_over_pairs():
    model = quality.FactorisationMachine(np.zeros(quality.STATS), np.ones(quality.STATS))
    rng = np.random.default_rng(0)
    model.weight = rng.normal(size=model.size)
    stats, slots, weights = quality.features(["one two two three!", "", "A " * 50], [18.0, 0.0, 100.0])
    at, x, starts = model.rows(stats, slots, weights)
    got, _, _ = model.margin(at, x, starts)
    for r, (a, b) in enumerate(zip(starts, [*starts[1:], len(at)])):
        i, v = at[a:b], x[a:b]
        pairs = sum(model.factor[i[p]] @ model.factor[i[q]] * v[p] * v[q] for p in range(len(i)) for q in range(p))
        assert got[r] == pytest.approx((model.weight[i] * v).sum() + pairs)


def quality_rows(n=400):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        good = rng.random() < 0.7
        w = words(rng, rng.randrange(20, 80)).split()
        rows.append((i, " ".join(w) + "." if good else "!! ".join(x.upper() for x in w)))
        marks.append((i, int(good)))
    return rows, marks


def test_quality_held_out(spark, docs_of):
    rows, marks = quality_rows()
    odd = [(900, None), (901, ""), (902, "x" * 300_000), (None, "no id"), (5, rows[5][1]), (903, "\ud7ff 😀")]
    marks += [(5, None), (None, 1), (7, marks[7][1])]
    docs = docs_of(rows + odd)
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    truth = dict(marks[:400])
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held) > 50
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    # held-out labels are never read
    flipped = spark.createDataFrame([(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in marks], "doc_id long, quality int")
    key = lambda rows_: sorted((str(r["doc_id"]), r["score"]) for r in rows_)
    assert key(quality.score_quality(docs, flipped).collect()) == key(got)
    kept = quality.accepted(docs, labels)
    assert kept.columns == DOC_COLUMNS and kept.count() == sum(r["predicted"] for r in got)


def test_quality_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.score_quality(docs_of([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert quality.score_quality(docs_of([]), none).collect() == []
    one_class = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert quality.score_quality(docs_of([(i, "a b") for i in range(20)]), one_class).where("predicted = 1").count() == 20


def mix_rows():
    rng = random.Random(4)
    rows = [(i, words(rng, rng.randrange(1, 60)) + (" | |" * 9 if i % 7 == 0 else "!" * 30 if i % 11 == 0 else "")) for i in range(300)]
    return rows + [(900, None), (901, ""), (902, " \n"), (None, "no id"), (5, rows[5][1]), (903, words(rng, 20_000)), (904, "| | |")]


def test_mix_matches_sql(docs_of, tmp_path):
    import duckdb

    docs = docs_of(mix_rows())
    docs.write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert compare(mixing.mix_report(docs), con, mixing_sql()) == ""


def test_mix_reaches_its_margins(docs_of):
    cells = [(s, la, t, 1, 100 + 37 * ((si + 1) * (li + 2) * (ti + 3) % 11)) for si, s in enumerate("ab") for li, la in enumerate(("en", "de")) for ti, t in enumerate(("prose", "table"))]
    spark = docs_of([]).sparkSession
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, docs long, tokens long")
    shares = {"source": {"a": 0.3, "b": 0.7}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"prose": 0.8, "table": 0.2}}
    fitted = mixing.rake(frame, shares).collect()
    for dim, goals in shares.items():
        for level, goal in goals.items():
            assert sum(r["weight"] for r in fitted if r[dim] == level) == pytest.approx(goal, abs=1e-6)
    drawn = mixing.calibrate(mixing.rake(frame, shares), 300).collect()
    assert sum(r["tokens"] * r["probability"] for r in drawn) == pytest.approx(300, rel=0.01)
    assert all(0 <= r["probability"] <= 1 for r in drawn)


def test_sample_mix(docs_of):
    docs = docs_of(mix_rows())
    sampled = mixing.sample_mix(docs)
    report = [r["doc_id"] for r in mixing.mix_report(docs).collect() if r["sampled"]]
    assert sampled.columns == DOC_COLUMNS
    assert sorted((r["doc_id"] for r in sampled.collect()), key=str) == sorted(report, key=str)
    assert mixing.mix_report(docs_of([])).collect() == [] and mixing.sample_mix(docs_of([])).collect() == []
    assert mixing.mix_report(docs_of([(1, None)])).collect()[0]["sampled"] is False


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def plain_spans(text):
    found = [(m.start(), n, f"{k}:{m.start()}:{m.end()}", k) for n, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if plain_valid(k, m[0])]
    return [(s, k) for _, _, s, k in sorted(found)]


def test_personal_data_matches_brute_force(docs_of):
    rng = random.Random(8)
    texts = [
        None, "", "none", "a@b.c", "x a@b.com_y@z.org, q", "é😀 a.b@c-d.ef 1.2.3.4.5.6.7.8 é 256.1.1.1 001.02.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "+1 (988) 555-2485 +49.30.1234567 +1-1 +123456789 +1234567890123456", "1" * 30_000, "a" * 30_000 + "@", "a@" * 3000, "1." * 3000, "+1 " * 3000, "1 " * 9000,
        "a@b", "@b.c", "a@b.", "a@.b", "+0 1 2 3 4 5 6 7 8 9", "0000 0000 0000", "99999999999999999999.1.1.1", "a%b@c.d-e.f--",
    ]
    for _ in range(300):
        texts.append("".join(rng.choice("aé0123456789@.+-() \n😀") for _ in range(rng.randrange(60))))
        texts.append(" ".join(rng.choice(["1.2.3.4", "4111111111111111", "a@b.co", "+1 (222) 333-4444", "call", "x", "12", "@", "+", "300.1.1.1"]) for _ in range(8)))
    rows = [*enumerate(texts), (3, "a@b.c"), (None, "a@b.c +123456789")]
    got = pii.find_personal_data(docs_of(rows)).collect()
    want = []
    for i, t in rows:
        spans = plain_spans(t)
        joined = ",".join(s for s, _ in spans)
        want.append((str(i), *(sum(k == kind for _, k in spans) for kind in BASE), hashlib.sha256(joined.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    by_id = {str(r["doc_id"]): r["spans"] for r in got}
    for i, t in rows:
        if i is not None and i > 3:
            assert {s for s, _ in plain_spans(t)} <= set(by_id[str(i)].split(","))
    assert pii.find_personal_data(docs_of([])).collect() == []


def test_contexts_discover_unseen_identifiers(docs_of):
    rows = [(i, f"please call +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(50, "please call 555-010-7777 now"), (51, "page 555-010-7777"), (52, "see 555-010-8888 there"), (53, "please call 12 people")]
    got = {r["doc_id"]: r for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert got[50]["spans"] == "phone:12:24" and got[50]["n_phone"] == 0
    assert got[51]["spans"] == "phone:5:17"
    assert got[52]["spans"] == "" and got[53]["spans"] == ""
    assert got[0]["spans"] == "phone:12:29"


def test_many_unseen_identifiers_do_not_hide_each_other(docs_of):
    rows = [(i, f"please call +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(100 + i, f"please call 555-010-{7000 + i} now") for i in range(30)]
    rows += [(200 + i, f"about +1 (555) 020-{1000 + i} said") for i in range(12)] + [(300 + i, f"about {i + 20} said") for i in range(12)] + [(400, "about 555-010-9999 said")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert all(got[100 + i] == "phone:12:24" for i in range(30))
    assert got[400] == "" and all(got[300 + i] == "" for i in range(12))


def test_identifiers_side_by_side_are_candidates_of_their_own(docs_of):
    rows = [(i, f"please call +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(50, "please call 555-010-7777, 555-010-8888 now"), (51, "please call 555-010-7777 2 times"), (52, "please call 555 010 7777 now")]
    rows += [(53, "some words before these please-call 555-010-6666."), (54, "w" * 70 + " please call 3 or 555-010-5555")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs_of(rows)).collect()}
    assert got[50] == "phone:12:24,phone:26:38" and got[51] == "phone:12:24" and got[52] == "phone:12:24"
    assert got[53] == "phone:36:48" and got[54] == ""  # there the word before is "or"


def near_vectors(rng, groups=25, size=64):
    centres = rng.normal(size=(groups, size))
    rows = [c + rng.normal(size=size) * 0.12 for c in centres for _ in range(int(rng.integers(1, 30)))]
    return [r.astype(np.float32).tolist() for r in rows + list(rng.normal(size=(300, size)))]


def brute_links(rows, least):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if o else None for (_, v), o in zip(rows, ok)]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(len(rows))]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(near[i]), component, True if key is None and len(seen) == 1 and not ok[i] else key == component if key is not None else False))
    return out


@pytest.mark.parametrize("window", [8, 256])
def test_embeddings(spark, window):
    rng = np.random.default_rng(6)
    vectors = near_vectors(rng)
    rows = [(1000 - i, v) for i, v in enumerate(vectors)]
    rows += [(2000 + i, vectors[0]) for i in range(40)] + [(3000, None), (3001, []), (3002, [0.0] * 64), (3003, [float("nan")] * 64), (3004, [None] + [1.0] * 63)]
    rows += [(3005, [float("inf")] * 64), (3006, [1.0, 2.0]), (3007, [1.0, 2.0]), (3008, [2.0, 4.0]), (3009, [1e30] * 64), (3010, [1e-30] * 64), (5, vectors[1]), (None, vectors[2])]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, rep string, size int")
    got = sorted((tuple(r) for r in embeddup.near_duplicates(frame, window=window).collect()), key=str)
    want = sorted(brute_links(rows, 0.95), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    if window == 256:
        assert got == want


def test_large_group_of_near_vectors_is_followed(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (np.ones(32) + rng.normal(size=32) * 0.03).tolist()) for i in range(300)]
    got = embeddup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), window=16).collect()
    assert all(r["n_links"] == 299 and r["component_id"] == 0 for r in got)
    assert embeddup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_stages_follow_their_operators(spark, docs_of):
    rows, marks = quality_rows(150)
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(900, None), (901, ""), (None, "w1 w2 w3")]
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == DOC_COLUMNS
            assert not Counter(map(tuple, out.collect())) - Counter(map(tuple, docs.collect()))
            assert stage(spark, docs_of([]), SF).columns == DOC_COLUMNS
            docs = spark.createDataFrame(out.collect(), DOCS)
    ids = sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] is not None)
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == ids


def test_queries_on_the_smallest_tables(spark):
    con = connect(SF)
    for name, sql in SQL.items():
        assert compare(QUERIES[name](spark, SF), con, sql) == "", name
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_budget_is_met_beside_starved_cells(docs_of):
    cells = [(f"s{k}", 1, 1000 + 10 * k, 0.05) for k in range(20)] + [("small", 1, 130, 1e-20)]
    frame = docs_of([]).sparkSession.createDataFrame(cells, "source string, docs long, tokens long, weight double").coalesce(1)
    total = sum(c[2] for c in cells)
    for keep in (0.5, 1.0):
        drawn = mixing.calibrate(frame, keep * total).collect()
        assert sum(r["tokens"] * r["probability"] for r in drawn) == pytest.approx(keep * total, rel=1e-3)
        assert all(0 <= r["probability"] <= 1 for r in drawn)


def test_unlisted_levels_keep_their_share(docs_of):
    tokens = {"en": 400, "de": 200, "fr": 200, "es": 100, "nl": 60, "unknown": 40}
    cells = [("a" if la != "nl" else "b", la, 1, n) for la, n in tokens.items()]
    frame = docs_of([]).sparkSession.createDataFrame(cells, "source string, lang string, docs long, tokens long").coalesce(1)
    goals = {r["lang"]: r["goal"] for r in mixing.shares_of(frame, "lang", mixing.LANG_SHARES, 1.0).collect()}
    assert goals == pytest.approx({"en": 0.495, "de": 0.135, "fr": 0.135, "es": 0.135, "nl": 0.06, "unknown": 0.04})
    drawn = mixing.calibrate(mixing.rake(frame, {"lang": mixing.LANG_SHARES, "source": {"a": 1.0, "b": 0.0}}, 2), 200).collect()
    assert {r["lang"] for r in drawn if r["probability"] > 0} == tokens.keys() - {"nl"}
    drawn = mixing.calibrate(mixing.rake(frame, {"source": None, "lang": mixing.LANG_SHARES}, 2), 500).collect()
    assert all(r["probability"] > 0 for r in drawn)


def test_budget_is_met_beside_cells_of_little_weight(spark):
    for little in (1e-6, 1.2e-7, 9.4e-8, 6e-8, 1e-10, 1e-20):
        cells = [(f"c{k}", 1000, 0.05) for k in range(20)] + [("small", 1000, little)]
        got = mixing.calibrate(spark.createDataFrame(cells, "name string, tokens long, weight double"), 10000.0).collect()
        assert abs(sum(r["tokens"] * r["probability"] for r in got) / 10000 - 1) < 1e-3, little


def test_fit_does_not_depend_on_row_order(spark, docs_of, rng):
    rows = [(i, words(rng, 30)) for i in range(40)] + [(3, words(rng, 12)), (3, words(rng, 50)), (3, words(rng, 8)), (7, words(rng, 9))]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    fits = [quality.fit_quality(docs_of(order), labels) for order in (rows, rows[::-1], rows[20:] + rows[:20])]
    assert fits[0].bias == fits[1].bias == fits[2].bias and (fits[0].weight == fits[1].weight).all() and (fits[0].factor == fits[2].factor).all()


def test_executors_need_no_installed_package(tmp_path):
    """A session started elsewhere: its workers cannot import the package, code and models travel by value."""
    root = pathlib.Path(__file__).parents[2]
    script = f"""
import sys
sys.path.append({str(root)!r})
from tidewell import build_session
from tidewell.llm import quality, runs, spelling
spark = build_session("elsewhere", 1)
sys.path.pop()
docs = spark.createDataFrame([(i, f"some text {{i}} " * 9, 90) for i in range(9)], "doc_id long, text string, n_chars long")
labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, quality int")
print("rows", quality.score_quality(docs, labels).count(), runs.collapse_runs(docs).count(), len(quality.score_quality(docs, labels).collect()))
print("words", len(spelling.group_variants(spark.createDataFrame([("abcdefg", 2), ("abcdefh", 30)], "word string, n long")).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 9 9 9" in done.stdout and "words 2" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("shape", ["dense third", "off centre"])
def test_recall_where_vectors_point_alike(spark, shape):
    g = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    near = lambda x, c: unit(c * x + np.sqrt(1 - c * c) * unit(g.normal(size=x.shape)))
    n, dim = 6000, 64
    centre = unit(g.normal(size=dim))
    x = unit(g.normal(size=(n, dim)))
    crowd = n // 3 if shape == "dense third" else n
    x[:crowd] = near(np.tile(centre, (crowd, 1)), np.sqrt(0.9) if shape == "dense third" else 0.6)
    x = np.concatenate([x, near(x[:200], 0.957)])
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddup.near_duplicates(vectors, window=32).collect()}
    links = (x @ x.T >= 0.95).sum(axis=1) - 1
    asked = [i for i in range(len(x)) if i % 50 == 0 or i >= n]
    assert all(got[i] <= links[i] for i in range(len(x)))
    assert sum(got[i] for i in asked) >= 0.95 * sum(links[i] for i in asked) > 0
