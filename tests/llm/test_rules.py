"""Quality rules against a plain version."""

import collections
import re

from tidewell.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def test_measures_match_brute_force(docs_of, rng):
    vocabulary = "the of and # * ab<c> 100% é ñandú 你好 \U0001F600 x|y end... a\x1cb c\xa0d".split(" ")
    seps = [" ", " ", " ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c", "\n\n"]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e"), (6, "a b c d e a b c d e"), (7, "a a a a a a"), (8, "\n\n a\na\n a\n\n")]
    for i in range(10, 150):
        n = rng.randrange(1, 60)
        some = vocabulary[: rng.choice([1, 2, 4, len(vocabulary)])]
        rows.append((i, "".join(rng.choice(some) + rng.choice(seps) for _ in range(n))))
    rows += [(200, "word " * 30000), (201, " ".join(f"w{k}" for k in range(60000))), (200, "word " * 30000), (None, "the " * 12), (202, "a b c d e f g h i j\n" * 3)]
    got = rules.judge(docs_of(rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((plain(*r) for r in rows), key=str)


def test_threshold_table_decides(docs_of):
    clean = "The ship of the line was old and it lay by the pier. " * 1 + "Men came with ropes to bind what the storm had left behind."
    rows = [(1, clean), (2, clean.replace("the", "###")), (3, " ".join(f"zzword{k}" for k in range(40))), (4, clean.replace(" ", "")), (5, "\n".join(["the end of it", "a b"] * 9))]
    got = {r["doc_id"]: r for r in rules.judge(docs_of(rows)).collect()}
    assert got[1]["kept"] and got[1]["failed_rules"] == ""
    assert not got[2]["kept"] and "symbols" in got[2]["failed_rules"] and not got[2]["base_failed"]
    assert got[3]["failed_rules"] == "stop_words" and not got[3]["base_failed"]
    assert got[4]["base_failed"] and got[4]["failed_rules"].startswith("few_words")
    assert "duplicate_lines" in got[5]["failed_rules"]
    own = (rules.Rule("short", "n_words", least=3), rules.Rule("long", "n_words", most=5))
    assert [r["failed_rules"] for r in rules.judge(docs_of([(1, "a b"), (2, "a b c"), (3, "a b c d e f")]), own).orderBy("doc_id").collect()] == ["short", "", "long"]
    assert rules.judge(docs_of([(1, "a b")]), (rules.Rule("any", "n_stop_words", most=0),), stop_words={}).first()["kept"]


def test_one_projection_without_python(docs_of):
    plan = rules.judge(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_no_rows(docs_of):
    assert rules.judge(docs_of([])).collect() == []
