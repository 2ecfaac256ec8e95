import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import DOCS, words
from tidewell.llm import simhash
from tidewell.llm.components import smallest_reachable

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    parts = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute(rows, bits):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    least = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    return sorted(((rows[k][0], f"{fps[k]:016x}", least[root[k]]) for k in range(len(rows))), key=str)


def corpus(rng):
    rows = [(100 - i, words(rng, 60)) for i in range(30)]
    for i in range(60):  # near copies
        w = rows[i % 5][1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(500, rows[0][1]), (501, rows[0][1].upper()), (502, None), (503, ""), (504, " \t\n"), (505, "Two words"), (506, "é è"), (507, "a" * 200_000)]
    return rows + [(508, words(rng, 30_000)), (500, rows[0][1]), (None, rows[1][1]), (None, "alone and without an id")]


def test_matches_brute_force(spark, docs_of, rng):
    rows = corpus(rng)
    for bits, bucket in ((2, 32), (2, 2), (3, 3), (1, 2), (0, 2)):
        got = simhash.near_duplicates(docs_of(rows), max_bits=bits, bucket=bucket).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, bits)


def test_long_text_is_hashed_in_runs(monkeypatch, rng):
    text = words(rng, 500)
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr("tidewell.llm.common.PIECE", 37)
    assert simhash.fingerprint(text, 3) == whole == plain_fingerprint(text)


def test_keep_one(docs_of, rng):
    rows = corpus(rng)
    kept = simhash.keep_one(docs_of(rows))
    assert kept.columns == DOCS.fieldNames()
    heads = {c for _, _, c in brute(rows, 2) if c is not None}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == sorted(heads) and got.count(None) == 2


def test_keep_one_judges_rows_of_an_id_apart(docs_of, rng):
    x, y = words(rng, 60), words(rng, 60)
    rows = [(5, x), (3, y), (5, y), (5, y + " "), (8, x), (9, None), (9, "alone in its words"), (9, "")]
    for order in (rows, rows[::-1]):
        kept = simhash.keep_one(docs_of(order).repartition(4)).collect()
        assert sorted((r["doc_id"], r["text"] or "") for r in kept) == sorted([(5, x), (3, y), (9, ""), (9, "alone in its words")])
    same = docs_of([(1, x)] * 3)
    assert len({tuple(r) for n in (1, 4) for r in simhash.keep_one(same.repartition(n)).collect()}) == 1


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []
    assert simhash.keep_one(docs_of([])).collect() == []


def test_masks_find_every_close_pair():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**63, 500, dtype=np.uint64) & np.uint64(0xFFFF00FFFFFF00FF)
    bits = np.unpackbits(fps.view(np.uint8), bitorder="little").reshape(-1, 64).astype(np.int64)
    for most in (1, 2, 3):
        masks = simhash.probe_masks(bits.T @ bits, len(fps), most)
        for _ in range(2000):
            x = rng.integers(0, 2**63)
            y = int(x)
            for b in rng.choice(64, most, replace=False):
                y ^= 1 << int(b)
            assert any(int(x) & m == y & m for m in masks)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (5000, 4000), (4000, 5000)]
    rng.shuffle(links)
    got = {tuple(r) for r in smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(1000 + i, 1000) for i in range(1, 200)} | {(5000, 4000)}
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).collect() == []
