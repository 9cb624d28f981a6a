import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.operators import match, stats
from tagloom.specs import Band, Rule, bands


def test_unmatched_is_null_and_first_match_wins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id bigint, v string")
    rules = [Rule(20, "a", 2), Rule(10, "a", 1), Rule(30, "b", 3)]
    got = {r["id"]: r["tag_id"] for r in match.match_tag(df, "id", "v", rules).collect()}
    assert got == {1: 10, 2: 30, 3: None, 4: None}


def test_match_join_equals_case(spark, rows):
    rng = random.Random(1)
    rules = [Rule(i, str(rng.randrange(60)), rng.randrange(5)) for i in range(150)]
    df = spark.range(200).select("id", (F.col("id") % 70).cast("string").alias("v"))
    assert rows(match.match_tag(df, "id", "v", rules)) == rows(match.match_tag_join(df, "id", "v", rules))


def test_range_join_equals_case(spark, rows):
    rng = random.Random(2)
    texts = [f"{a}-{a + rng.randrange(9)}" for a in (rng.randrange(100) for _ in range(80))]
    texts += [f"{a / 8}~{a / 8 + 0.5}" for a in range(0, 80, 3)] + ["<-40", ">=150", ">90", "120"]
    items = bands([Rule(i, t, rng.randrange(9)) for i, t in enumerate(texts)])
    df = spark.range(-500, 1500).select("id", (F.col("id") / 8).alias("v")).unionByName(
        spark.createDataFrame([(9999, None)], "id bigint, v double")
    )
    value = F.col("v")
    assert rows(stats.range_tag(df, "id", value, items)) == rows(stats.range_tag_join(df, "id", value, items))


def test_wrapping_band(spark):
    items = bands([Rule(112, "1222-0120")])
    df = spark.createDataFrame([(1221,), (1222,), (1231,), (101,), (120,), (121,)], "v int")
    got = [r[0] for r in df.select(stats.band_column(F.col("v"), items)).collect()]
    assert got == [None, 112, 112, 112, 112, None]


def test_age_band_with_and_without_dashes(spark):
    df = spark.createDataFrame([(1, "1980-01-01"), (2, "19891231"), (3, "1949-12-31"), (4, "n/a")], "id int, b string")
    got = {r["id"]: r["tag_id"] for r in stats.age_band(df, "id", "b", seeds.AGE).collect()}
    assert got == {1: 55, 2: 55, 3: None, 4: None}


def test_purchase_cycle_from_epoch_seconds(spark):
    from tagloom.functions.columns import epoch_seconds

    # text comparison would take '999999999' for the last one
    data = [(1, "999999999"), (1, "1000000000"), (2, "no number")]
    orders = spark.createDataFrame(data, "u int, t string").withColumn("t", epoch_seconds(F.col("t")))
    got = {r["u"]: (r["days"], r["tag_id"]) for r in stats.purchase_cycle(orders, "u", "t", "2001-09-12", seeds.CYCLE).collect()}
    assert got == {1: (3, 127), 2: (None, None)}


def test_payment_ties(spark):
    data = [(1, "wxpay"), (1, "alipay"), (2, "other"), (2, "other"), (2, "cod"), (3, None), (4, None), (4, None), (4, "cod")]
    orders = spark.createDataFrame(data, "u int, c string")
    got = {r["u"]: (r["code"], r["n"], r["tag_id"]) for r in stats.most_used_payment(orders, "u", "c", seeds.PAYMENT).collect()}
    assert got == {1: ("alipay", 1, 143), 2: ("other", 2, None), 3: (None, 0, None), 4: ("cod", 1, 146)}


def test_latest_payment_ties(spark):
    data = [(1, "a", 5, 1), (1, "cod", 7, 2), (1, "wxpay", 7, 3)]
    orders = spark.createDataFrame(data, "u int, c string, t int, sn int")
    got = stats.latest_payment(orders, "u", "c", "t", "sn", seeds.PAYMENT).first()
    assert (got["order_id"], got["tag_id"]) == (3, 144)


def _sessions(times, gap):
    out = []
    for t in sorted(times):
        if out and t - out[-1][1] <= gap:
            out[-1][1] = t
            out[-1][2] += 1
        else:
            out.append([t, t, 1])
    return [tuple(s) for s in out]


@pytest.mark.parametrize("gap", [10, 60])
def test_sessions_equal_a_scan_in_time_order(spark, gap):
    rng = random.Random(gap)
    base = datetime.datetime(2024, 1, 1)
    data = [(u, rng.randrange(3000)) for u in range(3) for _ in range(120)] + [(0, 0), (0, gap), (0, 2 * gap + 1)]
    logs = spark.createDataFrame([(u, base + datetime.timedelta(seconds=s)) for u, s in data], "u int, t timestamp")
    zero = int(logs.select(F.unix_micros(F.lit(base))).first()[0])
    got = {}
    for r in stats.sessions(logs, "u", "t", gap).collect():
        got.setdefault(r["u"], []).append(
            ((r["start_us"] - zero) // 10**6, (r["end_us"] - zero) // 10**6, r["events"])
        )
    want = {u: _sessions([s for v, s in data if v == u], gap) for u in range(3)}
    assert {u: sorted(s) for u, s in got.items()} == want


def test_midnight_counts_as_hour_24(spark):
    logs = spark.createDataFrame([(1, datetime.datetime(2024, 1, 1, 0, 5)), (2, datetime.datetime(2024, 1, 1, 7))], "u int, t timestamp")
    got = {r["u"]: r["tag_id"] for r in stats.browsing_hours(logs, "u", "t", seeds.BROWSING_HOURS).collect()}
    assert got == {1: 195, 2: 191}


def test_device_order(spark):
    agents = [("Mozilla (Linux; Android 13)", "Android"), ("iPhone; like Mac OS X", "IOS"), ("Windows NT", "Windows"), ("X11; Linux", "Linux"), ("curl", None)]
    df = spark.createDataFrame(agents, "a string, want string")
    from tagloom.functions.columns import device_type

    assert df.where(~F.equal_null(device_type(F.col("a")), F.col("want"))).count() == 0


@pytest.mark.parametrize("n", [1, 64, 65, 300, 3000])
@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)", "double"])
def test_search_and_chain_agree_at_every_length_and_type(spark, rows, n, kind):
    rng = random.Random(n)
    widths = [(Decimal(2) ** (i % 60), Decimal(2) ** (i % 60 + 1) - 1) for i in range(n)]
    items = [Band(i, lo + i // 60, hi, rng.random() < 0.2, rng.random() < 0.2) for i, (lo, hi) in enumerate(widths)]
    items += [Band(9001, Decimal("9007199254740992"), Decimal("9007199254740992")), Band(9002, Decimal("-3.5"), Decimal("-0.5"), True)]
    items += [Band(9003, Decimal("90071992547409930")), Band(9004, None, Decimal(-100))]
    values = ["9007199254740993", "9007199254740992", "90071992547409931", "0", "1", "-1", "-3", "-100", "-101"]
    values += [str(rng.randrange(0, 2 ** rng.randrange(1, 56))) for _ in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(998, None)], "id int, t string")
    df = df.select("id", F.col("t").cast(kind).alias("v"))
    if kind == "double":
        df = df.unionByName(spark.createDataFrame([(999, float("nan")), (997, float("inf")), (996, -3.5), (995, -0.5)], "id int, v double"))
    chain = df.select("id", stats.band_column(F.col("v"), items[:400]).alias("tag_id"))
    assert rows(stats.range_tag_join(df, "id", F.col("v"), items[:400])) == rows(chain)
    assert rows(stats.range_tag(df, "id", F.col("v"), items[:400])) == rows(chain)
    if n > 400:
        exact = {r["id"]: r["v"] for r in df.collect()}
        for r in stats.range_tag(df, "id", F.col("v"), items).collect():
            v = exact[r["id"]]
            if v is None:
                assert r["tag_id"] is None
            elif kind != "double":
                over = [b.lo is None or (v > b.lo if b.lo_open else v >= b.lo) for b in items]
                under = [b.hi is None or (v < b.hi if b.hi_open else v <= b.hi) for b in items]
                hit = [b.tag_id for b, x, y in zip(items, over, under) if (x or y if b.wraps else x and y)]
                assert r["tag_id"] == (hit[0] if hit else None)


@pytest.mark.parametrize("n", [3, 250])
def test_match_compares_texts_at_every_length(spark, rows, n):
    rules = [Rule(i, str(i), i) for i in range(n)] + [Rule(777, "x", n)]
    df = spark.createDataFrame([(1, 2), (2, None), (3, 10**6)], "id int, v int")
    assert rows(match.match_tag(df, "id", "v", rules)) == {(1, 2), (2, None), (3, None)}
