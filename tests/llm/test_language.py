import math
import random
import zlib

import cases
import numpy as np
import public_tokenizers

from tagloom.llm import language
from tagloom.llm.queries import op11_language_id

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.01"


def segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, min(len(word), language.PIECE_BYTES) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def small_vocabulary():
    pieces = {bytes([b]) for b in [32, *np.flatnonzero(language.LETTERS).tolist()]} | {b" a", b"ab", b"abab", b"b", b" abab", b"aa", b"bab", "é".encode(), b"abababab"}
    keys = np.array(sorted(int.from_bytes(p, "big") for p in pieces), np.uint64)
    return pieces, [int(k).to_bytes(8, "big").lstrip(b"\0") for k in keys], keys


def held(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(t) for t in texts])))


def test_sums_over_all_segmentations():
    pieces, names, keys = small_vocabulary()
    rng = np.random.default_rng(2)
    table = np.append(rng.random((len(keys), 3)) / 50, np.zeros((1, 3)), axis=0)
    texts = ["abab ba", "", "é aabab, abababababa ab", "ab\nab"]
    words = language.words_of(*held([t.encode() for t in texts]))
    index = language.Index(keys)
    each = language.likelihoods(words, index, table)
    want_words = [(0, "abab"), (0, "ba"), (2, "é"), (2, "aabab"), (2, "abababababa"), (2, "ab"), (3, "ab"), (3, "ab")]
    assert words.text.tolist() == [t for t, _ in want_words] and len(words.lengths) == 6
    for place, (_, word) in enumerate(want_words):
        for g in range(3):
            ways = [math.prod(table[names.index(p), g] for p in s) for s in segmentations(b" " + word.encode(), pieces)]
            assert math.isclose(each[words.of[place], g], math.log(sum(ways)), rel_tol=1e-9)
    weights = table[:, 0]
    times = np.bincount(words.of, minlength=len(words.lengths))[:, None]
    got = language.expected(words, index, weights, times)[0] / language.UNIT
    want = np.zeros(len(keys))
    for _, word in want_words:
        ways = [(s, math.prod(weights[names.index(p)] for p in s)) for s in segmentations(b" " + word.encode(), pieces)]
        total = sum(p for _, p in ways)
        for s, p in ways:
            for piece in s:
                want[names.index(piece)] += p / total
    assert np.allclose(got, want, atol=len(want_words) / language.UNIT)


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    texts = [b"abc abd abc", b"x abd " + b"q" * 100]
    plain = language.words_of(*held(texts))
    monkeypatch.setattr(language.ragged, "mixed", lambda h: h & np.uint64(0))
    crowded = language.words_of(*held(texts))
    for w in (plain, crowded):
        shown = [w.registers[:, i].astype(">u8").tobytes().rstrip(b"\0") for i in w.of]
        assert shown == [b"abc", b"abd", b"abc", b"x", b"abd", b"q" * 31, b"q" * 31, b"q" * 31, b"q" * 7]


def test_index_finds_every_piece():
    keys = language.read_vocabulary(PATH)
    index = language.Index(keys)
    assert len(keys) > 20000 and (index.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(np.random.default_rng(0).integers(1, 1 << 62, 5000).astype(np.uint64), keys)
    assert (index.find(others) == index.missing).all()


def test_held_out_accuracy(spark):
    out = {r.doc_id: r for r in op11_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(out) == len(docs)
    tested = [r for r in docs if out[r.doc_id].held_out]
    assert all(out[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in docs)
    assert len(tested) > 150
    assert sum(out[r.doc_id].lang_pred == r.lang for r in tested) / len(tested) > 0.98


def sentences():
    rng = random.Random(4)
    kinds = {"xx": "the of and thing other water".split(), "yy": "der und nicht straße über wasser".split()}
    return [(i, " ".join(rng.choices(kinds[k], k=rng.randrange(3, 30))), k) for i in range(120) for k in [rng.choice(list(kinds))]]


def test_hostile_rows(spark):
    rows = [(i, t, k) for i, t, k in sentences()]
    rows += [(900, None, "xx"), (901, "", "yy"), (902, "12 %% 34 !?", "xx"), (903, "THE OF", None), (None, "und nicht", None)]
    rows += [(904, "wasser" * 90000, None), (905, "你好 \U0001f600", "xx"), rows[0], rows[0]]
    full = [(*r, *[1, "f", 0.5, "u"]) for r in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, piece int, lang_pred string, score double, units string").repartition(4)
    got = language.identify(docs, PATH).collect()
    assert len(got) == len(rows)
    out = {r.doc_id: r for r in got}
    assert {out[i].lang_pred for i in (900, 901, 902)} == {"und"} and {out[i].score for i in (900, 901, 902)} == {0.0}
    assert out[903].lang_pred == "xx" and out[None].lang_pred == "yy" and not out[None].held_out and out[904].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in got)
    told = {i: k for i, _, k in sentences()}
    assert all(out[i].lang_pred == k for i, k in told.items())
    # another layout of the rows and a third round give the same languages, the layout the same scores
    again = {r.doc_id: r for r in language.identify(docs.repartition(1), PATH, work_bytes=1 << 10).collect()}
    assert all(again[i].lang_pred == r.lang_pred and abs(again[i].score - r.score) < 1e-9 for i, r in out.items())
    more = {r.doc_id: r.lang_pred for r in language.identify(docs, PATH, rounds=3).collect()}
    assert all(more[i] == k for i, k in told.items())
    assert language.identify(docs.limit(0), PATH).collect() == []
    nothing = language.identify(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"), PATH).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.identify(cases.frame(spark), PATH).count() == len(cases.texts())
