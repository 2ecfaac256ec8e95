"""Strings, JSON predicates, chunking, batches, retrieval and scores on small hand-made frames."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions import jsontext as J
from tidewell.functions import strings as S
from tidewell.operators import chunking as C
from tidewell.operators import evaluation as E
from tidewell.operators import relational as R
from tidewell.operators import retrieval as X


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


# -- scalar ------------------------------------------------------------------------------


def test_tokens_keep_hangul_and_drop_single_letters(spark):
    assert column(spark, ["a BC 한국어-ab1 é", ""], S.tokens("v")) == [["bc", "한국어", "ab1"], []]


def test_script_classes(spark):
    got = column(spark, [" 홍길동 ", "Hong", "홍Gil", "홍1", "G 1", "12"], S.script_class("v"))
    assert got == ["first", "second", "mixed", "has_first", "has_second", "other"]


def test_scores_from_text(spark):
    values = ['{"score": 0.7}', '{"other": 1}', "around 0.25 maybe", "1.0", "85", "none", '{"score": "x 0.5"}', None]
    assert column(spark, values, S.parse_score("v")) == [0.7, 0.0, 0.25, 1.0, 0.0, 0.0, 0.5, 0.0]


def test_password_rules_name_what_is_missing(spark):
    got = column(spark, ["abc", "Abc1!", "A1[", "a\\B2"], S.failed_rules("v"))
    assert got == [["uppercase", "digit", "symbol"], [], ["lowercase"], []]


def test_fences_only_when_the_text_starts_with_one(spark):
    values = ["```markdown\n# T\n```\n", "```\nx\n```", "x ```y```"]
    assert column(spark, values, S.strip_fences("v")) == ["# T", "x", "x ```y```"]


def test_blocks_end_at_the_next_header(spark):
    text = "[role]\nA\n[task]\nB\nB2\n[notes]\nC\n[context]\nD\n[x]\nE"
    assert column(spark, [text], S.strip_block(S.strip_from("v", "context"), "task")) == ["[role]\nA\n[notes]\nC"]


def test_two_digit_years_split_at_fifty(spark):
    assert [str(d) for d in column(spark, ["17/06/03", "49/01/01", "50/01/01"], S.short_year_date("v"))] == ["2017-06-03", "2049-01-01", "1950-01-01"]


def test_bands_use_the_rounded_value(spark):
    df = spark.createDataFrame([(53.46, 170.0), (66.18, 170.0), (72.0, 170.0)], "w double, h double")
    got = [tuple(r) for r in df.select(S.bmi("w", "h").alias("b")).select("b", S.band("b")).collect()]
    assert got == [(18.5, "normal"), (22.9, "overweight"), (24.91, "obese")]


def test_safe_text_and_tags(spark):
    assert column(spark, [None, " 　a \n"], S.safe_str("v")) == ["", "a"]
    assert column(spark, [" a, ,b ,", "", None], S.split_tags("v")) == [["a", "b"], [], []]


def test_page_text_drops_markup(spark):
    html = "<p>a&lt;b <script>var x='</p>';</script><!-- no --><style>q</style>c&amp;lt;</p>"
    assert column(spark, [html], S.page_text("v")) == ["a<b c&lt;"]


# -- JSON --------------------------------------------------------------------------------


def test_json_containment(spark):
    docs = ['{"a": 1, "b": {"c": ["x", 2]}}', '{"a": "1"}', '{"a": 1.0}', "[1, 2]", "bad", None]
    check = lambda lit: column(spark, docs, J.json_contains("v", lit))
    assert check({"a": 1}) == [True, False, True, False, False, None]
    assert check({"a": "1"}) == [False, True, False, False, False, None]
    assert check({"b": {"c": [2]}}) == [True, False, False, False, False, None]
    assert check([2]) == [False, False, False, True, False, None]


def test_json_keys_exist_even_when_null(spark):
    docs = ['{"k": null}', '{"x": {"k": 1}}', '["k", 1]', "[1]", None]
    assert column(spark, docs, J.json_has_key("v", "k")) == [True, False, True, False, None]


# -- chunking ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text,size,overlap,seps,want",
    [
        ("aa bb cc dd", 5, 0, C.PLAIN, ["aa bb", "cc", "dd"]),
        ("aa bb cc dd", 6, 3, C.PLAIN, ["aa bb", "bb cc", "cc dd"]),
        ("one\n\ntwo\n\nthree", 7, 0, C.PLAIN, ["one", "two", "three"]),
        ("one\n\ntwo\n\nthree", 8, 0, C.PLAIN, ["one\n\ntwo", "three"]),
        ("abcdefghij", 4, 1, C.PLAIN, ["abcd", "defg", "ghij"]),
        ("# T\n## A\nx\n## B\ny", 8, 0, C.HEADINGS, ["# T", "## A\nx", "## B\ny"]),
        ("   ", 4, 0, C.PLAIN, []),
    ],
)
def test_recursive_split_rules(text, size, overlap, seps, want):
    assert C.split_recursive(text, size, overlap, seps) == want


def test_recursive_chunks_fit_and_lose_no_word(spark):
    rng = random.Random(4)
    text = "\n\n".join(" ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 60))) for _ in range(20))
    df = spark.createDataFrame([(1, text), (2, None), (3, "short")], "id int, text string")
    rows = C.chunk_recursive(df, "id", "text", 100, 20).orderBy("id", "chunk_index").collect()
    mine = [r.text for r in rows if r.id == 1]
    assert max(map(len, mine)) <= 100 and Counter(text.split()) <= Counter(" ".join(mine).split())
    assert [(r.id, r.chunk_index) for r in rows if r.id != 1] == [(3, 0)]


def test_fixed_chunks_cover_whole_text(spark):
    text = "".join(chr(0xAC00 + i % 500) for i in range(2345))
    df = spark.createDataFrame([(1, text), (2, "x" * 150), (3, "x" * 1001)], "id int, text string")
    got = {}
    for r in C.chunk_fixed(df, "id", "text", 1000, 150).orderBy("id", "chunk_index").collect():
        got.setdefault(r.id, []).append(r.text)
    assert got[1] == [text[0:1000], text[850:1850], text[1700:2345]]
    assert [len(t) for t in got[2]] == [150] and [len(t) for t in got[3]] == [1000, 151]


def greedy(tokens, max_tokens, max_count):
    out, held, count, batch = [], 0, 0, 0
    fresh = True
    for t in tokens:
        if t >= max_tokens:
            batch += 1
            out.append(batch)
            fresh = True
            continue
        if fresh or held + t > max_tokens or count >= max_count:
            batch, held, count, fresh = batch + 1, 0, 0, False
        held, count = held + t, count + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("block,fan", [(5, 2), (20, 3), (1000, 500)])
def test_batches_equal_the_sequential_rule(spark, block, fan):
    rng = random.Random(block)
    rows = [(k, i, rng.choice([1, 5, 9, 20, 50, 60])) for k, n in (("hot", 150), ("b", 7), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, tok int").repartition(4)
    got = {(r.k, r.i): r.batch for r in C.token_batches(df, "tok", "k", ["i"], 50, 4, block=block, fan=fan).collect()}
    for k in ("hot", "b", "c"):
        mine = [t for kk, _, t in rows if kk == k]
        assert [got[k, i] for i in range(len(mine))] == greedy(mine, 50, 4), k


def test_char_vocab_and_windows(spark):
    df = spark.createDataFrame([(1, "héllo"), (2, "ab")], "id int, t string")
    assert [(r.ch, r.idx) for r in C.char_vocab(df, "t").orderBy("idx").collect()] == [(c, i) for i, c in enumerate(sorted(set("hélloab")))]
    assert [(r.x, r.y) for r in C.char_windows(df, "id", "t", 3).orderBy("pos").collect()] == [("hél", "éll"), ("éll", "llo")]


# -- retrieval ---------------------------------------------------------------------------


def test_keyword_counts_occurrences_inside_words(spark):
    docs = spark.createDataFrame([(1, "cat concat CATCAT"), (2, "dog"), (3, "aaaa"), (4, "x")], "doc_id int, text string")
    queries = spark.createDataFrame([(1, "cat cat"), (2, "aa z"), (3, "nothing")], "item_id int, text string")
    got = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in X.keyword_topk(docs, queries, 2).collect()}
    assert got == {(1, 1): (1, 8.0), (1, 2): (2, 0.0), (2, 1): (3, 2.0), (2, 2): (1, 0.0), (3, 1): (1, 0.0), (3, 2): (2, 0.0)}


def test_bm25_matches_direct_formula(spark):
    texts = ["a b c a", "a d", "a e f g h", "b b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.score for r in X.bm25_topk(docs, spark.createDataFrame([(1, "a b b")], "item_id int, text string"), 4).collect()}
    words = [t.split() for t in texts]
    avgdl = sum(map(len, words)) / 4
    df = Counter(w for t in words for w in set(t))
    idf = {w: math.log(4 - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    eps = 0.25 * sum(idf.values()) / len(idf)
    for i, t in enumerate(words):
        want = sum((idf[q] if idf[q] >= 0 else eps) * t.count(q) * 2.5 / (t.count(q) + 1.5 * (0.25 + 0.75 * len(t) / avgdl)) for q in ["a", "b", "b"])
        assert got[i] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_vector_search_is_exact_both_ways(spark, metric, monkeypatch):
    rng = np.random.default_rng(0)
    m, q = rng.normal(size=(70, 5)), rng.normal(size=(9, 5))
    vecs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id int, embedding array<double>").repartition(3)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id int, query_vec array<double>")
    d = np.linalg.norm(m[None] - q[:, None], axis=2)
    if metric == "cosine":
        d = 1 - (q @ m.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(m, axis=1)[None]
    want = {(i, r + 1): int(j) for i in range(9) for r, j in enumerate(np.argsort(d[i])[:4])}
    sent = {(r.query_id, r["rank"]): r.vec_id for r in X.vector_topk(vecs, queries, 4, metric).collect()}
    holes = [vecs.unionByName(spark.createDataFrame([(99, None)], vecs.schema)), queries.unionByName(spark.createDataFrame([(99, None)], queries.schema))]
    joined = {(r.query_id, r["rank"]): r.vec_id for r in X.vector_topk(*holes, 4, metric).collect()}
    blocks = X.knn_blocks(queries, vecs, 4, metric, "vec_id", "embedding", "query_id", "query_vec", block=8)
    assert sent == want == joined == {(r.query_id, r["rank"]): r.vec_id for r in blocks.collect()}


def test_mmr_prefers_variety(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.8, 0.6]), (4, [0.0, 1.0])]
    vecs = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    query = spark.createDataFrame([(7, [1.0, 0.0])], "query_id int, query_vec array<double>")
    pick = lambda lam: [r.vec_id for r in X.mmr(vecs, query, 2, 4, lam).orderBy("rank").collect()]
    assert pick(1.0) == [1, 2] and pick(0.5)[0] == 1 and pick(0.3)[1] in (3, 4)


def test_fusion_and_first_of_several_variants(spark):
    ranked = lambda rows: spark.createDataFrame(rows, "q int, d string, rank int")
    out = X.fuse([ranked([(1, "a", 1), (1, "b", 2)]), ranked([(1, "b", 1)])], [0.5, 0.5], "q", "d")
    assert {r.d: round(r.score, 9) for r in out.collect()} == {"a": round(0.5 / 61, 9), "b": round(0.5 / 62 + 0.5 / 61, 9)}
    both = spark.createDataFrame([(1, "a", 2, 1), (1, "a", 1, 3), (1, "b", 2, 2)], "q int, d string, variant int, rank int")
    assert sorted(tuple(r) for r in X.unite(both, "q", "d", ["variant", "rank"]).collect()) == [(1, "a", 1, 3), (1, "b", 2, 2)]


def test_lookup_takes_first_entry_or_default(spark):
    entries = spark.createDataFrame([(1, "ab", "one"), (2, "B", "two"), (3, "xyz", "three")], "r int, k string, v string")
    texts = spark.createDataFrame([(1, "zABz"), (2, "b only"), (3, "nope"), (4, "")], "id int, t string")
    got = {r.id: r.answer for r in R.contains_lookup(texts, "id", "t", entries, "k", "v", "r", "unknown").collect()}
    assert got == {1: "one", 2: "two", 3: "unknown", 4: "unknown"}


# -- evaluation --------------------------------------------------------------------------


def test_pair_cosine(spark):
    rows = [(1, "the cat sat", "the cat sat"), (2, "aa bb", "cc dd"), (3, "", "x y"), (4, "a b", "a b"), (5, "aa bb", "aa cc")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    got = {r.id: r.cosine for r in E.tfidf_pairs(df, ["id"], {"p": (F.col("a"), F.col("b"))}).collect()}
    w = (1 + math.log(1.5)) ** 2
    assert got[1] == pytest.approx(1) and got[2] == got[3] == got[4] == 0
    assert got[5] == pytest.approx(1 / (1 + 2 * w))


def test_log_keeps_first_of_equal_questions(spark):
    rows = [(1, " q ", "a", ["c"]), (2, "q", "b", ["c"]), (3, "r", "", ["c"]), (4, "r", "a", []), (5, "s", "a", None), (6, "t", "a", ["c"])]
    log = spark.createDataFrame(rows, "ts int, question string, answer string, contexts array<string>")
    assert [(r.ts, r.question) for r in E.eval_set_from_log(log, ["ts"]).collect()] == [(1, "q"), (6, "t")]
    assert [r.ts for r in E.eval_set_from_log(log, ["ts"], 1).collect()] == [1]


def test_history_keeps_last_lines_and_skips_blanks(spark):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}" if i != 28 else " ") for i in range(30)]
    df = spark.createDataFrame(turns, "c int, t int, role string, text string")
    row = E.history_text(df, "c", "t", "role", "text", 3).first()
    assert row.history == "사용자: t26\n어시스턴트: t27\n어시스턴트: t29"


def test_contexts_fall_back(spark):
    df = spark.createDataFrame([(None, [], ["abc", "", "de", "f", "g"])], "a array<string>, b array<string>, c array<string>")
    assert df.select(E.context_fallback([F.col("a"), F.col("b"), F.col("c")], 4, 2).alias("x")).first().x == ["ab", "de", "f"]


def test_spaced_sample_follows_truncated_targets(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(23)], "id int, s double")
    for n in (1, 2, 5, 22, 23, 40):
        want = set(range(23)) if n >= 23 else {int(i * 22 / (n - 1)) for i in range(n)} if n > 1 else {0}
        assert {r.id for r in R.spaced_sample(df, ["s", "id"], n).collect()} == want, n


def test_pages_by_number_and_by_key(spark):
    df = spark.createDataFrame([(i, -i) for i in range(53)], "id int, s int")
    short = [r.id for r in R.page_of(df, ["s", "id"], 2, 20).orderBy("s").collect()]
    far = R.page_of(df, ["s", "id"], 2, 20).collect()
    keyed = [r.id for r in R.page_after(df, ["s", "id"], [-13, 13], 20).collect()]
    assert keyed == short
    assert [r.id for r in R.page_after(df, ["s", "id"], None, 2).collect()] == [52, 51]
    assert short == [r.id for r in far] == list(range(12, -1, -1)) and far[0].total_pages == 3


def test_splice_repeats_the_front_or_aligns(spark):
    base = spark.createDataFrame([(i, float(i)) for i in range(5)], "i int, v double")
    new = base.withColumn("v", F.col("v") + 100)
    run = lambda off: [r.v for r in R.splice_tail(base, new, "v", ["i"], offset=off).orderBy("i").collect()]
    assert run(None) == [0.0, 1.0, 102.0, 103.0, 104.0] and run(0) == [0.0, 1.0, 100.0, 101.0, 102.0]


def test_records_need_a_title_or_a_body(spark):
    df = spark.createDataFrame([(1, " T ", "b"), (2, None, "b"), (3, " ", None)], "id int, t string, b string")
    assert [(r.id, r.text) for r in C.title_and_body(df, "t", "b").collect()] == [(1, "T\n\nb"), (2, "b")]


def test_templates_put_examples_first(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    out = df.select(X.render("A={a} B={b}", {"a": F.col("a"), "b": F.col("b")}, ["shot"]).alias("p")).first().p
    assert out == "shot\n\nA=x B="
