import random
import zlib

import cases
import numpy as np

from tagloom.llm import classifier


def rows():
    rng = random.Random(2)
    good = [(i, cases.prose(rng, rng.randrange(10, 200))) for i in range(160)]
    junk = [(1000 + i, cases.prose(rng, rng.randrange(10, 200)).replace(" ", "%%% ")) for i in range(80)]
    return good + junk


def test_held_out_accuracy_and_hostile_rows(spark):
    labelled = rows()
    docs = cases.frame(spark, [*labelled, (5000, None), (5001, ""), (None, "x y z"), (5002, "long " * 40000), labelled[0]])
    marks = [(d, int(d < 1000), 0) for d, _ in labelled] + [(None, 1, 0), (1, None, 0), (99999, 0, 0), (3, 7, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    out = classifier.classify(docs, labels).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    tested = [r for r in out if r.held_out and r.doc_id < 2000]
    assert len(tested) > 30
    assert sum(r.predicted == int(r.doc_id < 1000) for r in tested) / len(tested) > 0.95
    kept = classifier.accepted(docs, labels)
    assert kept.columns == docs.columns
    want = sorted(((r.doc_id is None, r.doc_id or 0) for r in out if r.predicted))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect()) == want
    assert classifier.classify(cases.empty(spark), labels).count() == 0
    # nothing to tell apart: the share of label 1, or no rejection at all
    assert {r.score for r in classifier.classify(docs, labels.filter("quality = 0")).collect()} == {0.0}
    assert {r.predicted for r in classifier.classify(docs, labels.limit(0)).collect()} == {1}


def test_parts_of_a_long_text_give_its_score():
    net = classifier.Network(3)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 5, 255, 256, 251, 3000, 70000)]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data, tables = np.frombuffer(b"".join(texts), np.uint8), net.pair_tables()
    whole = net.score(data, offsets, tables)
    assert np.allclose(whole, net.score(data, offsets, tables, step=7))
    alone = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]), tables)[0] for t in texts]
    assert np.allclose(whole, alone)


def test_gradients():
    net = classifier.Network(1)
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 110, n).astype(np.uint8)) for n in (3, 300, 900)]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data, y = np.frombuffer(b"".join(texts), np.uint8), np.array([0, 1, 0], np.float32)

    def loss():
        p = net.score(data, offsets, net.pair_tables())
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = net.gradients(data, offsets, y)
    for name, weight in net.weights.items():
        for at in [tuple(rng.integers(0, s) for s in weight.shape) for _ in range(8)]:
            if name == "taps":
                at = (at[0], int(rng.integers(97, 110)), at[2])
            old = weight[at]
            weight[at] = old + 1e-2
            up = loss()
            weight[at] = old - 1e-2
            down = loss()
            weight[at] = old
            assert abs((up - down) / 2e-2 - grads[name][at]) < 2e-3, (name, at)


def test_long_texts_are_learned_from(spark):
    """All texts of one label are longer than what is learned of one; none would be left without pieces."""
    rng = random.Random(6)
    good = [(i, cases.prose(rng, 3000)) for i in range(40)]
    junk = [(1000 + i, cases.prose(rng, 60).replace(" ", "%%% ")) for i in range(40)]
    docs = cases.frame(spark, [*good, *junk, (7000, None)])
    labels = spark.createDataFrame([(d, int(d < 1000), 0) for d, _ in [*good, *junk]] + [(7000, 1, 0)] + [(9000 + i, i % 2, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    out = classifier.classify(docs, labels, sample_bytes=2000, sample_docs=50).collect()
    tested = [r for r in out if r.held_out and r.doc_id < 5000]
    assert len(tested) > 10 and sum((r.score >= 0.5) == (r.doc_id < 1000) for r in tested) / len(tested) > 0.9


def test_held_out_given_labels(spark):
    """Ranks the held-out labelled documents of the given table right: area under the curve of at least 0.95."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = classifier.fit(docs, labels)
    tested = docs.join(labels.filter(classifier.held_out()), "doc_id").select("text", "quality").collect()
    tables = model.pair_tables()
    raw = [r.text.encode() for r in tested]
    score = model.score(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))), tables)
    label = np.array([r.quality for r in tested])
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(1, len(score) + 1)
    ones = label.sum()
    auc = (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))
    assert len(label) > 500 and auc >= 0.95
