import hashlib
import random

import cases
import numpy as np
import pytest

from tagloom.llm import doubling, suffix


def words_left(rows, length):
    seen, out = set(), {}
    for d, t in rows:
        w = t.encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            if k in seen:
                gone[i : i + length] = [True] * length
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


def bytes_left(rows, length):
    first, out = {}, {}
    for d, t in rows:
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    for d, t in rows:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = True
        turns = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        spans = list(zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()))
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out[d] = (len(t), int(gone.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans)
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 4000])
@pytest.mark.parametrize("length,start", [(20, 5), (7, 3), (4, 4)])
def test_words(spark, block_bytes, length, start):
    rows = cases.unique_ids()
    want = words_left(rows, length)
    got = doubling.repeated_words(cases.frame(spark, rows), length=length, start=start, block_bytes=block_bytes).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


@pytest.mark.parametrize("block_bytes,bin_bytes", [(1 << 24, 1 << 20), (4000, 3000)])
@pytest.mark.parametrize("length,k,crowd", [(50, 24, 10_000), (12, 6, 10_000), (50, 24, 2), (12, 6, 3)])
def test_bytes(spark, block_bytes, bin_bytes, length, k, crowd):
    rows = cases.unique_ids()
    want = bytes_left([(d, t.encode()) for d, t in rows], length)
    got = suffix.repeated_bytes(
        cases.frame(spark, rows), length=length, k=k, block_bytes=block_bytes, bin_bytes=bin_bytes, crowd=crowd
    ).collect()
    assert {r.doc_id: (*r[1:5], [tuple(x) for x in r.removed]) for r in got} == want


def test_nulls_repeated_ids_and_empty_tables(spark):
    docs = cases.frame(spark)
    for out, count in ((doubling.repeated_words(docs, block_bytes=5000), "n_words"), (suffix.repeated_bytes(docs, block_bytes=5000), "n_bytes")):
        got = out.collect()
        assert len(got) == len(cases.texts())
        assert sum(r.doc_id is None for r in got) == 3
        assert [r[count] for r in got if r.doc_id == 400] == [0]
    # rows of one id are separate places to the word operator, one document to the byte operator
    words = sorted(r.n_removed for r in doubling.repeated_words(docs).collect() if r.doc_id == 0)
    assert words[0] == 0 or words[0] < words[-1]
    assert all(r.n_removed == 0 for r in suffix.repeated_bytes(docs.filter("doc_id = 0")).collect())
    assert doubling.repeated_words(cases.empty(spark)).count() == 0
    assert suffix.repeated_bytes(cases.empty(spark)).count() == 0


def test_levels():
    assert doubling.levels(5, 20) == [5, 10, 20]
    assert doubling.levels(3, 20) == [3, 6, 12, 20]
    assert doubling.levels(30, 20) == [20]


def test_borders_are_common_prefixes():
    rng = random.Random(2)
    for _ in range(40):
        text = np.array([rng.randrange(1, 1 + rng.choice((2, 3))) for _ in range(rng.randrange(1, 80))] + [0], np.uint16)
        length = rng.randrange(1, 12)
        order, rank = suffix.suffix_ranks(text, length)
        raw = text.tolist()
        keys = [raw[i : i + length] for i in order.tolist()]
        assert keys == sorted(keys)
        border = suffix.common_prefixes(text[order - 1], length)
        for i in range(1, len(raw)):
            a, b = raw[order[i - 1] :], raw[order[i] :]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert border[i] == (same if same < length else -1)


def test_borders_of_few_symbols_are_read_from_packed_keys():
    rng = random.Random(3)
    for _ in range(60):
        piece = [rng.randrange(1, 258 if rng.random() < 0.3 else 3) for _ in range(rng.randrange(1, 40))]
        text = np.array([x for _ in range(rng.randrange(1, 9)) for x in piece[rng.randrange(len(piece)) :]] + [0], np.uint16)
        length = rng.randrange(1, 40)
        order, _ = suffix.suffix_ranks(text, length)
        whole = suffix.common_prefixes(text[order - 1], length)
        border, reach = suffix.short_prefixes(text, order, length)
        assert reach == min(14, length)
        assert border.tolist() == [x if x < reach else -1 for x in whole.tolist()]
        assert suffix.common_prefixes(text[order - 1], length, (border, reach)).tolist() == whole.tolist()


def test_least_owner_of_every_window():
    rng = random.Random(4)
    for _ in range(30):
        length = rng.randrange(2, 8)
        chunks = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(length, 40))) for _ in range(9)]
        docs = np.array([rng.randrange(9) for _ in chunks])
        least = {}
        for c, d in zip(chunks, docs.tolist()):
            for i in range(len(c) - length + 1):
                least[c[i : i + length]] = min(least.get(c[i : i + length], 99), d)
        for c, got in zip(chunks, suffix.first_owners(chunks, docs, length)):
            assert got.tolist() == [least[c[i : i + length]] for i in range(len(c) - length + 1)]


def test_words_that_sums_of_powers_confuse(spark):
    one, other = cases.even_and_odd()
    words = [f"w{i}" for i in range(24)]
    rows = [(1, " ".join([*words[:12], one, *words[12:]])), (2, " ".join([*words[:12], other, *words[12:]])), (3, f"{one} {other}")]
    want = words_left(rows, 20)
    assert {w[1] for w in want.values()} == {0}
    got = doubling.repeated_words(cases.frame(spark, rows), length=20).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == want


def test_hashes_and_bytes_of_spans():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in [*range(0, 20), 63, 64, 65, 200] * 3]
    texts += texts[:30] + [x.encode() for x in cases.even_and_odd()]
    data = np.frombuffer(b"-".join(texts), np.uint8)
    starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    ends = starts + [len(t) for t in texts]
    from tagloom.llm import ragged

    h = ragged.byte_hashes(data, starts, ends)
    assert len(set(h.tolist())) == len(set(texts))
    assert len({(a, t) for a, t in zip(h.tolist(), texts)}) == len(set(texts))
    other = rng.integers(0, len(texts), len(texts))
    assert ragged.same_bytes(data, starts, ends, other).tolist() == [t == texts[o] for t, o in zip(texts, other)]
