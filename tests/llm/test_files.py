"""Token files, WARC archives and the coder: exact round trips."""

import hashlib
import os
import zlib

import numpy as np
import pytest

from tests.llm.conftest import words
from tidewell.llm import idcoder, tokenfile, warc
from tidewell.llm.queries import tokenizer_path


@pytest.mark.parametrize("block", [1, 7, 64, 4096])
def test_coder_round_trip(block):
    rng = np.random.default_rng(block)
    for n in (0, 1, block, block + 1, 3 * block - 1 if block > 1 else 5, 200):
        n = min(n, 9000)
        for ids in (rng.integers(0, idcoder.LIMIT, n), np.zeros(n, int), np.full(n, idcoder.LIMIT - 1), np.arange(n) % 5, np.minimum((rng.pareto(0.5, n) * 3).astype(int), 50256)):
            codes = idcoder.encode(ids, block)
            assert len(codes) == -(-n // block)
            assert (idcoder.decode(codes, n, block) == ids).all()


def test_blocks_are_independent():
    ids = np.random.default_rng(2).integers(0, 50257, 10_000)
    codes = idcoder.encode(ids)
    assert (idcoder.decode(codes[1:2], idcoder.BLOCK) == ids[idcoder.BLOCK : 2 * idcoder.BLOCK]).all()
    with pytest.raises(ValueError):
        idcoder.encode([idcoder.LIMIT])


def test_coder_learns_what_repeats():
    ids = np.tile([3, 60_000, 12, 900, 14], 4000)
    assert sum(map(len, idcoder.encode(ids))) < len(ids) / 10


def test_codes_are_as_in_files_of_before():
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, idcoder.LIMIT, 3000), np.minimum((rng.pareto(0.5, 6000) * 3).astype(int), 50256), np.arange(1000) % 7])
    codes = idcoder.encode(ids)
    assert [len(c) for c in codes] == [7160, 3858, 782] and [zlib.crc32(c) for c in codes] == [4040034595, 575885490, 1206189337]
    assert (idcoder.decode_blocks(codes, idcoder.BLOCK).T.ravel()[: len(ids)] == ids).all()


def test_files_are_decoded_side_by_side(tmp_path, monkeypatch, rng):
    calls, decode = [], idcoder.decode_blocks
    monkeypatch.setattr(idcoder, "decode_blocks", lambda codes, steps: calls.append(len(codes)) or decode(codes, steps))
    paths, want = [], []
    for k, n in enumerate((1, 9000, 5, 4096, 300)):
        ids = np.array([rng.randrange(900) for _ in range(n)], "<u4")
        path = tmp_path / str(k)
        path.write_bytes(tokenfile.MAGIC + b"".join(tokenfile.pack([k], [ids.tobytes()])))
        paths.append(str(path))
        want.append((str(path), [k], [n], ids.tolist()))
    for most, blocks in ((1 << 12, [7]), (4, [4, 3]), (1, [1, 3, 1, 1, 1])):
        monkeypatch.setattr(tokenfile, "SIDE_BY_SIDE", most)
        calls.clear()
        assert [(p, d.tolist(), s.tolist(), i.tolist()) for p, d, s, i in tokenfile.unpack_all(paths)] == want
        assert calls == blocks


def test_pieces_met_lately_are_not_learned_again(monkeypatch):
    monkeypatch.setattr(tokenfile, "REMEMBERED", 20)
    encoder, learned = tokenfile.PieceEncoder(tokenizer_path()), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: learned.extend(pieces) or learn(pieces))
    for k in range(30):
        text = f"a common word again {k} {k}x " + " ".join(f"w{k}{c}" for c in "abcdefgh")
        assert encoder.encode([text])[0] == plain_ids([text])[0][:-1].tobytes()
        assert len(encoder.known) + len(encoder.older) <= 2 * (20 + 13)
    assert [learned.count(p) for p in ("common", "word", "again")] == [1, 1, 1]


TEXTS = [
    "plain words here", "", None, " ", "  two  spaces ", "line\nbreak \n next\t tab", "Müller straße  ñ é", "it's we'll  don't 12 345", "a\u00a0b \u00a0c \u2003 d",
    "<|endoftext|> special <|endoftext|>", "emoji 😀 x 😀😀", "Ġmark Ġ Ġ", "x" * 5000, "end ", "\n", "a  ", "1 2 3 \r\n 4", "\u3000wide space\u3000 x", "日本 語 テキスト",
]


def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [np.array(e.ids + [0], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_special_strings_have_their_own_ids():
    got = tokenfile.PieceEncoder(tokenizer_path()).encode(["a <|endoftext|> b", "x<|endoftext|>y <|endoftext|>"])
    assert np.frombuffer(got[0], "<u4").tolist() == [64, 220, 50256, 275]
    assert [g for g in got] == [b[:-1].tobytes() for b in plain_ids(["a <|endoftext|> b", "x<|endoftext|>y <|endoftext|>"])]


def test_pieces_give_the_same_ids(rng):
    texts = [t or "" for t in TEXTS] + [" ".join(rng.choice(["a", "b\n", "\nc", "", "d.", "é", "\t"]) for _ in range(60)) for _ in range(200)]
    got = tokenfile.PieceEncoder(tokenizer_path()).encode(texts)
    for text, a, b in zip(texts, got, plain_ids(texts)):
        assert a == b[:-1].tobytes(), text


def test_token_files(spark, docs_of, rng, monkeypatch, tmp_path):
    rows = [(1000 - 7 * k, t) for k, t in enumerate(TEXTS)] + [(-5, words(rng, 20_000)), (3, "same"), (3, "same"), (3, "rather"), (None, "no id"), (None, "and none")]
    rows += [(2000 + k, words(rng, 30)) for k in range(50)]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for (i, _), ids in zip(order, plain_ids([t for _, t in order])):
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for segment in (1 << 23, 100):
        monkeypatch.setattr(tokenfile, "SEGMENT", segment)
        folder = str(tmp_path / f"ids{segment}")
        got = tokenfile.round_trip(docs_of(rows).repartition(3), tokenizer_path(), folder).collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert tokenfile.round_trip(docs_of([]), tokenizer_path()).collect() == []


def test_damaged_token_files_are_refused(tmp_path):
    data = tokenfile.MAGIC + b"".join(tokenfile.pack([1, None], [np.arange(3000, dtype="<u4").tobytes(), np.zeros(1, "<u4").tobytes()]))

    def read(raw):
        path = tmp_path / "f"
        path.write_bytes(raw)
        with open(path, "rb") as f:
            return list(tokenfile.unpack(f.read, "f"))

    assert read(data)[0][2].tolist() == [*range(3000), 0]
    for at in (3, 60, len(data) - 10):
        with pytest.raises((ValueError, zlib.error)):
            read(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ValueError):
        read(data[:-3])


def test_archives(spark, rng, monkeypatch, tmp_path):
    long = words(rng, 20_000)
    html = [None, "", "short", "short", long, long, "é" * 50, "é" * 50, "x" * 99, "x" * 99, "y" * 100, "y" * 100, "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n" * 9, "😀" * 400]
    rows = [(100 - k, f"http://h/{k}\r\nX-Page-ID: 9", h, "x", "y") for k, h in enumerate(html)]
    rows += [rows[10], rows[11], rows[11], (None, None, "y" * 100, "x", "y"), (None, "u", "z" * 100, "x", "y"), (None, "u", "z" * 100, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, data string, record_id string")
    first = {}
    for i, _, h, *_ in rows:
        if h and len(h.encode()) >= 100:
            first[h] = min([i for i in (first.get(h), i) if i is not None], default=None)
    want = []
    for i, _, h, *_ in rows:
        raw = (h or "").encode()
        refers = first.get(h) if first.get(h) != i else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    for size in (1 << 18, 7):
        monkeypatch.setattr(warc, "CHUNK", size)
        monkeypatch.setattr(warc.chunks, "__defaults__", ("page_id", "url", "html", size))
        monkeypatch.setattr(warc.read_archives, "__defaults__", (size,))
        folder = str(tmp_path / f"w{size}")
        got = warc.round_trip(pages, folder=folder).drop("path", "record_no").collect()
        assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).collect() == []
    import gzip

    raw = b"".join(gzip.open(os.path.join(folder, f)).read() for f in os.listdir(folder))
    assert raw.count(long.encode()) == 1 and raw.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_chunk_table_carries_digests(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abcdefghij" * 3)], "page_id long, url string, html string")
    rows = warc.chunks(pages, size=8).collect()
    assert [bytes(r["data"]) for r in rows] == [b"abcdefgh", b"ijabcdef", b"ghijabcd", b"efghij"]
    typed = warc.with_types(warc.digests(warc.chunks(pages, size=8)))
    read = warc.read_archives(warc.write_archives(warc.chunks(pages, size=8), typed, str(tmp_path / "w")), 8).orderBy("chunk_no").collect()
    text = b"abcdefghij" * 3
    assert [r["digest"] for r in read] == [hashlib.sha256(text[: 8 * k + 8]).hexdigest() for k in range(4)]
