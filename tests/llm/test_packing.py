import random
from bisect import bisect_left
from collections import defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from tagloom.llm import packing

SIZES = (8, 16, 32)


def one_by_one(lengths, sizes, costs):
    """Best-fit decreasing, a piece at a time."""
    bins, left = [], sorted(lengths)
    while left:
        n = left.pop()
        fits = [(size - used, i) for i, (size, used) in enumerate(bins) if size - used >= n]
        if fits:
            bins[min(fits)[1]][1] += n
            continue
        best = None
        for size in sizes:
            if size < n:
                continue
            used, rest = n, sorted(left)
            while True:
                at = bisect_left(rest, size - used + 1)
                if not at:
                    break
                used += rest.pop(at - 1)
            score = (costs[min(s for s in sizes if s >= used)] / used, -size)
            best = min(best or (score, size), (score, size))
        bins.append([best[1], n])
    return [(used, min(s for s in sizes if s >= used)) for _, used in bins]


@pytest.mark.parametrize("seed", range(12))
def test_histogram_plan_is_best_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.choice((rng.randrange(1, 33), rng.randrange(1, 6), 16)) for _ in range(rng.randrange(0, 120))]
    histogram = defaultdict(int)
    for n in lengths:
        histogram[n] += 1
    costs = packing.default_costs(SIZES)
    p = packing.plan(dict(histogram), SIZES, costs)
    got = [(used, size) for a, b, used, size in p.bins for _ in range(b - a)]
    assert got == one_by_one(lengths, SIZES, costs)


def check(rows, lengths, sizes):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    assert sorted(bins) == list(range(len(bins)))
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert {(r.bin_used, r.bin_capacity) for r in members} == {(at, min(s for s in sizes if s >= at))}
    whole = defaultdict(int)
    for r in rows:
        whole[r.doc_id] += r.n_tokens
    want = defaultdict(int)
    for d, n in lengths:
        want[d] += n
    assert whole == want
    assert all(r.start == r.piece * max(sizes) for r in rows)


def test_documents(spark):
    rows = packing.pack(cases.frame(spark), capacities=SIZES, buckets=3).collect()
    check(rows, [(d, len((t or "").encode().split()) + 1) for d, t in cases.texts()], SIZES)


def test_lengths_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, None), (3, -4), (4, 0), (None, 40), (5, 32), (6, 33)], "doc_id long, w int")
    rows = packing.pack(df, length=F.col("w"), capacities=SIZES).collect()
    check(rows, [(1, 10), (None, 40), (5, 32), (6, 33)], SIZES)
    assert packing.pack(cases.empty(spark)).count() == 0
    assert packing.pack(df.filter("w = 0"), length=F.col("w")).count() == 0


def test_rows_without_an_id_are_dealt_by_their_texts(spark, monkeypatch):
    kept = {}
    real = packing.written
    monkeypatch.setattr(packing, "written", lambda df, name: kept.setdefault(name, real(df, name)))
    df = spark.createDataFrame([(None, f"no id {i}") for i in range(2000)], "doc_id long, text string")
    rows = packing.pack(df, capacities=(8, 16), buckets=32).collect()
    assert len({(r.bin_id, r.bin_offset) for r in rows}) == len(rows) == 2000
    counts = [r["_count"] for r in kept["piece-counts"].collect()]
    assert len(counts) == 32 and max(counts) < 150
