"""Spelling variants against a comparison of all words."""

import collections
import re
import zlib

import pytest

from tidewell.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_groups(counts):
    near_of = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in near_of.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near_of[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def plain_counts(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def edited(rng, w, letters):
    k = rng.randrange(len(w) + 1)
    return rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k + 1 :]])


@pytest.mark.parametrize("letters", ["ab", "abcd", "abcdefghijklmnopqrstuvwxyzéü"])
@pytest.mark.parametrize("block", [7, 16384])
def test_groups_match_brute_force(spark, rng, letters, block):
    counts = {}
    for _ in range(60):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 13)))
        counts[w] = rng.randrange(2, 2000)
        for _ in range(6):
            w = edited(rng, w, letters)
            counts.setdefault(w, rng.randrange(2, 40))
    got = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"), block=block).collect()
    assert sorted(tuple(r) for r in got) == plain_groups(counts)


def test_anagrams_long_words_and_other_scripts(spark, rng):
    base = list("abcdefgh")
    counts = {}
    for _ in range(300):  # one cell of the trie
        rng.shuffle(base)
        counts["".join(base)] = 5
    long = "".join(rng.choice("xyz") for _ in range(4000))
    counts |= {long: 900, long[:17] + long[18:]: 8, long[:3999] + "q": 9, "q" + long: 70, long + long: 3}
    counts |= {"слово": 50, "слова": 4, "😀word": 90, "word": 3, "": 4, "a": 9}
    table = spark.createDataFrame([*counts.items(), (None, 4)], "word string, n long")
    got = spelling.group_variants(table, block=64).collect()
    assert sorted(tuple(r) for r in got) == plain_groups(counts)


def test_chain_of_forms(spark):
    counts = {"a" * 7 + "b" * k: 10**k for k in range(1, 12)} | {"zzzzzzz": 2}
    got = {r["word"]: r["root"] for r in spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 7 + "b" * 11, "zzzzzzz"} and got["zzzzzzz"] == "zzzzzzz"


def test_query_matches_brute_force(docs_of, rng):
    letters = "abcdeABÉéÀü×"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 11))) for _ in range(40)]
    vocabulary += [edited(rng, w, letters) for w in vocabulary]
    seps = [" ", "-", ", ", "1", "_", "\n", "Ā", "\xbf"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice(seps) for _ in range(rng.randrange(80)))) for i in range(120)]
    rows += [(None, " ".join(vocabulary)), (500, None), (501, ""), (7, "abcdefg " * 900), (7, "abcdefg " * 900), (8, "Abcdefgh" * 5000), (8, "aBcdefgh" * 5000)]
    got = spelling.group_variants(spelling.count_words(docs_of(rows), queries.misspelt)).collect()
    want = plain_groups(plain_counts(rows))
    assert sorted(tuple(r) for r in got) == want and any(r[1] for r in want)


def test_no_rows(spark, docs_of):
    assert spelling.count_words(docs_of([])).collect() == []
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).collect() == []
