import random
import zlib

import cases
import numpy as np
import pytest

from tagloom.llm import tokens

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


def whole(texts):
    tok, *_ = tokens.tokenizer(PATH)
    return [tok.encode(t, add_special_tokens=False).ids + [0] for t in texts]


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n,block", [(0, 8), (1, 8), (8, 8), (13, 8), (1000, 64), (5000, 4096)])
def test_planes_round_trip(bits, n, block):
    rng = np.random.default_rng(n)
    for high in (2, 50257, 1 << 32):
        ids = rng.integers(0, high, n).astype(np.uint32)
        assert tokens.restored(tokens.shuffled(ids, block, bits)).tolist() == ids.tolist()


def test_pieces_give_the_tokens_of_the_whole():
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "the", "Don't", "it's", "'", "''s", "é", " è", " ", " ", "　", "12", "3.5", ".", ",", "!!", "%%%",
            "<|endoftext|>", "<|", "|>", "a_b", "你好", "\U0001f600", "é", "x-y", "#tag", "$5", "\x1c", "\x85", "ß", "²", "Ⅷ", "(", ")", "…", "—"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 30))) for _ in range(1500)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    ids, counts = tokens.encode(np.frombuffer(b"".join(raw), np.uint8), offsets, PATH, 0)
    want = whole(texts)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_files_give_back_every_document(spark):
    rows = cases.texts()
    stored = tokens.write_ids(cases.frame(spark), PATH, shard_bytes=20_000, chunk_ids=500, block=64, work_bytes=3000)
    got = sorted(tokens.read_ids(stored).collect(), key=lambda r: r.start)
    order = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    start = 0
    for r, (some, d, t), ids in zip(got, order, whole([t for *_, t in order])):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d if some else None, start, len(ids), crc)
        start += len(ids)
    assert len(got) == len(rows)
    chunks = stored.filter("payload is not null").collect()
    assert sum(c.ids for c in chunks) == start
    assert all(len(tokens.restored(bytes(c.payload))) == c.ids for c in chunks)


def test_empty_table(spark):
    assert tokens.read_ids(tokens.write_ids(cases.empty(spark), PATH)).count() == 0


def test_pieces_that_sums_of_powers_confuse(spark, monkeypatch):
    texts = [*cases.even_and_odd(), "some pieces and some more", "other pieces"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    want = [i for w in whole(texts) for i in w]
    held = np.frombuffer(b"".join(raw), np.uint8)
    assert tokens.encode(held, offsets, PATH, 0)[0].tolist() == want
    # all pieces under one hash: their bytes tell them apart
    monkeypatch.setattr(tokens.ragged, "byte_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    assert tokens.encode(held, offsets, PATH, 0)[0].tolist() == want


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"{i:04d} text without an id " * 5) for i in range(1500)] + [(i, "with one") for i in range(500)]
    stored = tokens.write_ids(cases.frame(spark, rows), PATH, shard_bytes=10_000)
    sizes = [r["count"] for r in stored.filter("payload is null").groupBy("shard").count().collect()]
    assert sum(sizes) == 2000 and len(sizes) >= 10 and max(sizes) < 600
    starts = sorted((r.start, r.doc_id) for r in tokens.read_ids(stored).collect())
    assert [d for _, d in starts] == [None] * 1500 + list(range(500))
