"""Periodic runs against a plain search of all periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np

from tests.llm.conftest import words
from tidewell.llm import queries, runs


def plain_lyndon(r):
    out = []
    for i in range(len(r)):
        sizes = [k for k in range(1, len(r) - i + 1) if all(r[i : i + k] < r[i + j : i + k] for j in range(1, k))]
        out.append(max(sizes))
    return out


def plain_runs(w, least, periods):
    found = set()
    for p in range(1, len(w)):
        j = 0
        while j < len(w) - p:
            s = j
            while j < len(w) - p and w[j] == w[j + p]:
                j += 1
            size = j - s + p
            if j > s and size >= max(least, periods * p):
                part = w[s : s + size]
                if next(q for q in range(1, size + 1) if part[: size - q] == part[q:]) == p:
                    found.add((s, size, p))
            j += j == s
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_array_matches_brute_force(rng):
    for _ in range(600):
        r = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randrange(14))]
        assert runs.lyndon_array(r) == plain_lyndon(r)


def test_runs_match_brute_force(rng):
    for _ in range(600):
        least, periods = rng.choice([(24, 3), (6, 3), (4, 2), (2, 2), (9, 4)])
        size, w = rng.choice([1, 2, 3, 50]), []
        for _ in range(rng.randrange(12)):
            p = [rng.randrange(size) for _ in range(rng.randrange(1, 9))]
            w += p * rng.randrange(1, 7) + p[: rng.randrange(len(p) + 1)] + [rng.randrange(size) for _ in range(rng.randrange(3))]
        got = [tuple(x) for x in runs.find_runs(np.array(w, np.int64), least, periods).tolist()]
        assert got == plain_runs(w, least, periods)


def test_many_runs_in_few_letters():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    got = [tuple(x) for x in runs.find_runs(np.array(b), 6, 2).tolist()]
    assert got == plain_runs(b, 6, 2) and len(got) > 500


def plain_query(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w, 24, 3)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (doc_id, len(found), *best, milli, digest(listed), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_matches_brute_force(docs_of, rng):
    rows = [(i, words(rng, rng.randrange(1, 90), rng.choice([2, 3, 40]))) for i in range(250)]
    rows += [(i, "a b c " * rng.randrange(6, 12) + words(rng, 9) + "\n" + "x\ty " * rng.randrange(9, 30)) for i in range(300, 330)]
    rows += [(400, None), (401, ""), (402, " \n"), (None, "é ü " * 20), (None, None), (403, "w " * 1500), (404, "a b " * 12 + "a"), (405, "a b c d " * 6), (405, "a b c d " * 6)]
    ten = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(i, t) for i, t in zip(ten, [None, "", " ", "one", "a b", words(rng, 1200), "é " * 9 + words(rng, 200), "\n x\x1cy z\n" * 20])]
    got = queries.run_digest(runs.collapse_runs(queries.with_periods(docs_of(rows)))).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((plain_query(*r) for r in rows), key=str)
    assert any(r["n_runs"] > 1 for r in got)


def test_collapsed_text_and_spans(docs_of):
    got = {r["doc_id"]: r for r in runs.collapse_runs(docs_of([(1, "go on. " * 20 + "stop now"), (2, "  plain\ttext "), (3, None)])).collect()}
    assert got[1]["collapsed"] == "go on. stop now" and [tuple(x) for x in got[1]["runs"]] == [(0, 40, 2)] and got[1]["n_words"] == 42
    assert got[2]["collapsed"] == "plain text" and got[2]["runs"] == [] and got[3]["collapsed"] == "" and got[3]["n_words"] == 0


def test_very_long_text(docs_of, rng):
    part = words(rng, 500, 5000)
    text = words(rng, 60000, 9000) + " " + " ".join([part] * 40) + " end " + words(rng, 60000, 9000)
    got = runs.collapse_runs(docs_of([(1, text)])).first()
    assert [(r["length"] >= 20000, r["period"]) for r in got["runs"]] == [(True, 500)]


def test_no_rows(docs_of):
    assert runs.collapse_runs(docs_of([])).collect() == []
