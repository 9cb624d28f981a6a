import random

import cases
import pytest

from tagloom.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, s, n):
    s = list(s)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(s) + 1)
        if kind == 0:
            s.insert(at, rng.choice("abé\U0001f600"))
        elif at < len(s):
            s[at : at + 1] = [] if kind == 1 else [rng.choice("abc")]
    return "".join(s)


@pytest.mark.parametrize("t", [0, 1, 2, 3])
def test_banded_distance(spark, t):
    rng = random.Random(t)
    pairs = []
    for _ in range(250):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 25)))
        pairs.append((a, changed(rng, a, rng.randrange(0, 6))))
    got = lines.edits(spark.createDataFrame(pairs, "a string, b string"), t).collect()
    assert [min(r.edits, t + 1) for r in got] == [min(distance(r.a, r.b), t + 1) for r in got]


def gone(rows, t, min_chars):
    """Lines that go, by brute force over all pairs of different lines."""
    places = [
        ((d is not None, d or 0, i), x) for d, text in rows for i, x in enumerate((text or "").split("\n")) if x.encode().split()
    ]
    first = {}
    for p, x in sorted(places):
        first.setdefault(x, p)
    near = {
        x
        for x in first
        if len(x) >= min_chars
        and any(first[y] < first[x] and abs(len(y) - len(x)) <= t and len(y) >= min_chars and distance(x, y) <= t for y in first)
    }
    return sorted((p, p == first[x]) for p, x in places if p != first[x] or x in near)


def near_rows():
    rng = random.Random(8)
    base = [" ".join(rng.choice(cases.WORDS) for _ in range(rng.randrange(1, 9))) for _ in range(30)]
    rows = []
    for d in range(25):
        rows.append((d, "\n".join(changed(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 3))) for _ in range(6))))
    return [*rows, (30, None), (31, ""), (32, " \n\t\n"), (None, base[0] + "\n" + base[1]), (33, "\n".join(base[:3] * 5)), (5, rows[5][1])]


@pytest.mark.parametrize("t,min_chars", [(2, 24), (1, 10), (3, 12)])
def test_repeated_lines(spark, t, min_chars):
    rows = near_rows()
    got = lines.repeated_lines(cases.frame(spark, rows), max_edits=t, min_chars=min_chars).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0, r.line_no), r.near) for r in got) == gone(rows, t, min_chars)
    assert any(r.near for r in got)


def test_texts_left(spark):
    rows = [r for r in near_rows() if r[0] != 5]
    docs = cases.frame(spark, rows)
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    drop = {p for p, _ in gone(rows, 2, 24)}
    want = {}
    for d, text in rows:
        left = [x for i, x in enumerate((text or "").split("\n")) if (d is not None, d or 0, i) not in drop]
        want[d] = text if text is None else "\n".join(left)
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert {d: t for d, (t, _) in got.items()} == want
    assert all(n == len(t or "") for t, n in got.values())
    assert lines.dedup_lines(cases.empty(spark)).count() == 0
    hostile = cases.frame(spark)
    assert lines.dedup_lines(hostile).count() == hostile.count()


def test_rows_without_id_and_rows_that_repeat_one_lose_their_own_lines(spark):
    rng = random.Random(12)
    own = [" ".join(rng.choice(cases.WORDS) + str(rng.randrange(1000)) for _ in range(8)) for _ in range(30)]
    rows = []
    for i in range(10):
        same = [own[0], own[i % 3], own[10 + i], own[20 + i // 2]]
        rows.append((None if i < 5 else 7, "\n".join(same)))
    left = [(r.doc_id, r.text) for r in lines.dedup_lines(cases.frame(spark, rows)).collect()]
    assert [d for d, _ in left].count(None) == 5 and len(left) == 10
    kept = [x for _, t in left for x in t.split("\n") if x]
    # every different line stays once
    assert sorted(kept) == sorted({x for _, t in rows for x in t.split("\n")})


def templated(n):
    """Lines of one template; numbers of one length, so that they share segments by the hundred."""
    rng = random.Random(3)
    return [
        f"A new message was posted on {rng.randrange(10, 29)} May {rng.randrange(1990, 2030)} at {rng.randrange(10, 24)}:{rng.randrange(10, 60)} by user number {i:06d}"
        for i in rng.sample(range(10**6), n)
    ]


@pytest.mark.parametrize("t", [1, 2, 3])
def test_crowded_segments_lose_no_pair(spark, monkeypatch, t):
    monkeypatch.setattr(lines, "CROWDED", 3)
    rng = random.Random(t)
    base = templated(12)
    rows = [(i, "\n".join(changed(rng, rng.choice(base), rng.randrange(0, t + 2)) for _ in range(6))) for i in range(20)]
    rows += [(50 + i, changed(rng, "short one", rng.randrange(0, t + 1))) for i in range(12)]
    got = lines.repeated_lines(cases.frame(spark, rows), max_edits=t, min_chars=5).collect()
    assert sorted(((True, r.doc_id, r.line_no), r.near) for r in got) == gone(rows, t, 5)
    assert any(r.near for r in got)


def test_a_template_does_not_meet_all_its_pairs(spark):
    n = 3000
    texts = spark.createDataFrame([(i, x) for i, x in enumerate(templated(n))], "h long, line string")
    texts = texts.selectExpr("h", "line", "length(line) AS n").withColumn("bag", lines._bag(lines.F.col("line")))
    finer = lines._finer(texts, 2, False).groupBy("key").count()
    largest, met = finer.agg(lines.F.max("count"), lines.F.sum(lines.F.expr("count * (count - 1) / 2"))).first()
    assert met < n * n / 2 / 10
    one = texts.select(lines.F.explode(lines._indexed(2)).alias("key")).groupBy("key").count().agg(lines.F.max("count")).first()[0]
    assert one == n and largest < n / 20
