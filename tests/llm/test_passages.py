"""Substring dedup, decontamination and licence scans against plain versions."""

import hashlib
import math
import re

import pytest

from tests.llm.conftest import DOCS, words
from tidewell.llm import decontam, licenses, substring

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_removal(rows, window):
    lists = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in lists:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in lists:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [1, 2, 7, 50])
def test_removal_matches_brute_force(docs_of, rng, window):
    passage, other = words(rng, 70), words(rng, 55)
    rows = [(i, words(rng, 20 + 9 * i)) for i in range(12)]
    rows += [(20 + i, f"{words(rng, 5 * i)} {passage} {words(rng, 7)}") for i in range(6)]
    rows += [(30, f"{other}\n\t{passage} {other}"), (31, f"x {other} y"), (32, passage + " " + passage), (19, passage.upper())]
    rows += [(40, rows[8][1]), (41, rows[8][1]), (7, rows[8][1]), (42, None), (43, ""), (44, "  "), (45, "one"), (46, "z " * 300), (47, "z " * 300)]
    rows += [(48, words(rng, 5000) + " " + passage), (20, rows[12][1]), (None, passage), (None, None), (49, "é " * 60), (50, "é " * 60 + "e")]
    got = substring.remove_repeats(docs_of(rows), window=window).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(rows, window)


def test_removal_of_nothing(docs_of):
    assert substring.remove_repeats(docs_of([])).collect() == []
    assert substring.levels(50) == [13, 25, 50] and substring.levels(1) == [1]


def plain_containment(docs, items):
    cut = lambda t: re.findall(WORD, (t or "").translate(LOWER))
    sets = {}
    for i, t in items:
        w = cut(t)
        if w:
            sets.setdefault(i, set()).update(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    out = []
    for d, t in docs:
        w = cut(t)
        for i, wanted in sets.items():
            held = {tuple(w[k : k + n]) for n in {len(x) for x in wanted} for k in range(len(w) - n + 1)}
            shared = len(wanted & held)
            if shared >= 0.8 * len(wanted):
                out.append((d, i, shared, len(wanted), round(shared / len(wanted), 6)))
    return sorted(out, key=str)


def test_containment_matches_brute_force(spark, docs_of, rng, monkeypatch):
    items = [(i, words(rng, 10 + 13 * i)) for i in range(14)] + [(20, "Two, words!"), (21, None), (22, "..."), (23, "a b c d e"), (None, words(rng, 30)), (3, words(rng, 12))]
    rows = [(i, words(rng, 200)) for i in range(5)]
    for n, (_, t) in enumerate(items[:14]):
        w = t.split()
        for k in range(1, 8):  # more and more words changed
            x = list(w)
            for _ in range(k - 1):
                x[rng.randrange(len(x))] = "changed"
            rows.append((100 * n + 1000 + k, f"{words(rng, 50)} {' '.join(x).upper()}; {words(rng, 3000 if k == 2 else 20)}"))
    rows += [(7, "two words"), (8, "A-b c.d e"), (9, None), (10, ""), (None, items[2][1]), (11, items[17][1]), (11, items[17][1]), (12, items[18][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_containment(rows, items)
    for block in (200_000, 300):
        monkeypatch.setattr(decontam, "BLOCK", block)
        got = decontam.contained_items(docs_of(rows), bench).collect()
        assert sorted((tuple(r) for r in got), key=str) == want
    kept = decontam.without_contained(docs_of(rows), bench)
    leaky = {d for d, *_ in want}
    assert kept.columns == DOCS.fieldNames()
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, _ in rows if d not in leaky), key=str)


def test_containment_of_nothing(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contained_items(docs_of([(1, "a b")]), none).collect() == []
    assert decontam.contained_items(docs_of([]), some).collect() == []
    assert decontam.without_contained(docs_of([(1, None)]), some).count() == 1


def test_sketch_keeps_contained_items():
    for q in range(1, 400):
        kept, need = decontam.sketch_plan(q)
        assert 1 <= need <= kept <= max(q, decontam.SKETCH)
        if q < decontam.SKETCH:
            assert (kept, need) == (q, math.ceil(0.8 * q - 1e-9))


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def plain_licences(text):
    w = re.findall(WORD, (text or "").translate(LOWER))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licences(docs_of, rng, monkeypatch):
    texts = [
        None, "", "...", "MIT", "mit license", "The MIT-License, the GNU General Public License and Apache license; MIT license.",
        "gnu general gnu general public license public license", "CC BY cc by CC BY-NC", "cc byé", "Licensed under CC BY-NC 4.0.",
        "apache apache license license", words(rng, 400) + " mit license " + words(rng, 400), "the license " * 50,
        "Permission is hereby granted, free of charge, to any person obtaining a copy of that software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction", "x " * 50_000 + "cc by",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "mit license"), (None, "cc by")]
    for piece in (1 << 20, 16):
        monkeypatch.setattr(licenses, "PIECE", piece)
        index = licenses.LicenseIndex()
        for t in texts:
            found = index.scan(t or "")
            starts = [s for s, _ in found["places"]]
            labels = ",".join(sorted({index.phrase_labels[n] for _, n in found["places"]}))
            assert (found["n_words"], len(starts), min(starts, default=None), max(starts, default=None), labels) == plain_licences(t)
    got = licenses.scan_licenses(docs_of(rows)).collect()
    base = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got]
    assert sorted(base, key=str) == sorted(((i, *plain_licences(t)) for i, t in rows), key=str)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[9]["labels"] == "cc-by,cc-by-nc-4.0" and by_id[13]["labels"] == "mit-text" and 0.8 <= by_id[13]["score"] < 1
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)
    assert licenses.scan_licenses(docs_of([])).collect() == []


def test_automaton_holds_every_run():
    words_ = ["a b c a b d".split(), "b c b c a".split(), "a".split(), "a b c".split()]
    auto = licenses.SuffixAutomaton([[w.encode() for w in s] for s in words_])
    runs = {tuple(s[i:j]) for s in words_ for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = "a b c a b c b c a a b d d c a b".split()
    state = length = 0
    for k, w in enumerate(text):
        state, length = auto.step(state, length, w.encode())
        assert length == max((n for n in range(1, k + 2) if tuple(text[k + 1 - n : k + 1]) in runs), default=0)


def test_a_template_is_reported_each_time_it_stands(docs_of, rng):
    text = licenses.TEMPLATES["bsd-text"]
    times = "\n".join([text, words(rng, 40), text, text, words(rng, 2000), text[: len(text) * 9 // 10]])
    got = licenses.scan_licenses(docs_of([(1, times), (2, text)])).orderBy("doc_id").collect()
    spans = [(s["first"], s["last"]) for s in got[0]["spans"] if s["label"] == "bsd-text"]
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and len([s for s in got[1]["spans"] if s["label"] == "bsd-text"]) == 1
