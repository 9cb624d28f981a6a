"""The catalogue from its rule texts: plans, two sources, cells, clusters, long lists."""

import pytest
from pyspark.sql import functions as F

from suite import whole
from tagloom.operators import profile
from tagloom.plans import catalogue
from tagloom.sinks.writers import write_cells
from tagloom.operators.cells import rows_to_cells

SF = "/root/testdata/sf0.001"
TAGS = "id long, name string, level int, pid long, `order` int, state int, rule string"


def text(table, fields, measure, kind="hive", more=""):
    return f"inType={kind}\ndbTable={table}\nselectFieldNames={fields}\nmeasure={measure}\n{more}"


def test_one_plan_per_source(spark):
    plans = catalogue.compile_catalogue(whole.catalogue_tags(spark))
    shown = {("#".join(s.table for s in p.specs), p.style): len(p.tags) for p in plans}
    assert shown == {
        ("catalogue_users", "row"): 17,
        ("catalogue_orders", "aggregate"): 5,
        ("catalogue_priced", "aggregate"): 1,
        ("catalogue_logs", "aggregate"): 4,
        ("catalogue_logs", "visits"): 1,
        ("catalogue_daily", "aggregate"): 1,
        ("catalogue_lines#catalogue_orders", "aggregate"): 4,
        ("catalogue_goods#catalogue_orders", "aggregate"): 1,
    }
    whole.sources(spark, SF)
    for p in plans:
        plan = catalogue.run_plan(spark, p, "2001-08-10")._jdf.queryExecution().optimizedPlan().toString()
        # as many scans as the source has by itself, one aggregate of the plan's own
        alone = catalogue.read_plan(spark, p)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == alone.count("Relation [")
        assert p.style == "visits" or plan.count("Aggregate [") - alone.count("Aggregate [") == (p.style == "aggregate")


def test_rows_of_every_kind_of_trouble(spark, rows):
    data = [
        (1, "a", "10", "2020-01-05", None), (1, "b", "20.5", "2020-01-07", 1), (1, "b", None, None, 2), (2, None, "x", "bad", None),
        (None, "a", "5", "2020-01-01", 3), (3, "a", "-5", "2020-01-01", 4), (3, "b", "0", "2020-01-01", 5),
    ]
    spark.createDataFrame(data, "u long, c string, m string, d string, i int").createOrReplaceTempView("trouble")
    tags = [
        (10, "mode", 4, 1, None, 3, text("trouble", "u,c", "mode(c)")), (11, "a", 5, 10, 1, 3, "a"), (12, "b", 5, 10, 2, 3, "b"),
        (20, "sum", 4, 1, None, 3, text("trouble", "u,m", "total(m)")), (21, "low", 5, 20, 1, 3, "<=0"), (22, "high", 5, 20, 2, 3, ">0"),
        (30, "latest", 4, 1, None, 3, text("trouble", "u,c,d,i", "latest(c,d,i)")), (31, "a", 5, 30, None, 3, "a"), (32, "b", 5, 30, None, 3, "b"),
        (40, "gone", 4, 1, None, -1, text("trouble", "u,c", "mode(c)")), (41, "a", 5, 40, None, 3, "a"),
        (50, "no measure", 4, 1, None, 3, "inType=hive\ndbTable=trouble\nselectFieldNames=u,c"), (51, "a", 5, 50, None, 3, "a"),
        (60, "no values", 4, 1, None, 3, text("trouble", "u,c", "mode(c)")), (70, "empty", 4, 1, None, 3, None),
        (80, "days", 4, 1, None, 3, text("trouble", "u,d", "days_since(d)", more="asOf=2020-01-10\nwhereFieldNames=c\nwhereFieldValues=b")),
        (81, "week", 5, 80, None, 3, "7day"), (82, "more", 5, 80, None, 3, ">7"),
    ]
    table = spark.createDataFrame(tags, TAGS)
    # of three values at one time the one with the greatest last column counts
    want = {(1, 12), (1, 22), (1, 32), (1, 81), (2, None), (3, 11), (3, 21), (3, 32), (3, 82)} - {(2, None)}
    got = rows(catalogue.run_catalogue(spark, table.where("id not in (80, 81, 82)"), "2020-01-10"))
    assert got == {p for p in want if p[1] not in (81, 82)}
    with pytest.raises(ValueError, match="tag 80 has an unknown measure"):
        catalogue.compile_catalogue(table.withColumn("rule", F.replace("rule", F.lit("days_since(d)"), F.lit("days(d)"))))
    spark.sql("SELECT u, c, try_cast(d AS DATE) AS d FROM trouble").createOrReplaceTempView("trouble_days")
    days = table.where("id in (80, 81, 82)").withColumn("rule", F.replace("rule", F.lit("trouble"), F.lit("trouble_days")))
    assert rows(catalogue.run_catalogue(spark, days, "1999-01-01")) == {(1, 81), (3, 82)}


def test_cells_two_sources_and_versions(spark, tmp_path, rows):
    goods = spark.createDataFrame([("o1", "白色", "冰吧"), ("o1", "黑色", "冰吧"), ("o2", "白色", "料理机"), ("o3", "x", "料理机"), ("o4", "蓝色", "冰吧")], "goods_order string, colour string, kind string")
    orders = spark.createDataFrame([("o1", "7", "3"), ("o2", "8", "4"), ("o3", "9", "5"), ("o4", None, "1"), ("o5", "7", "8")], "order_sn string, member string, amount string")
    keyed = {
        "goods": goods.withColumn("row", F.monotonically_increasing_id().cast("string")),
        "orders": orders.withColumn("row", F.col("order_sn")),
    }
    for name, df in keyed.items():
        write_cells(rows_to_cells(df, "row", "detail"), str(tmp_path / name))
    both = f"{tmp_path / 'goods'}#{tmp_path / 'orders'}"

    def rule(table, fields, measure):
        return f"inType=hbase\nhbaseTable={table}\nfamily=detail\nselectFieldNames={fields}\nmeasure={measure}"

    tags = [
        (244, "gender", 4, 4, None, 3, rule(both, "goods_order,colour,kind#member,order_sn", "vote(colour,kind)")),
        (248, "male", 5, 244, 1, 3, "1"), (249, "female", 5, 244, 2, 3, "2"),
        (22, "spent", 4, 4, None, 3, rule(tmp_path / "orders", "member,amount", "total(amount)")),
        (132, "much", 5, 22, 1, 3, ">=10"), (133, "some", 5, 22, 2, 3, "1-9"),
    ]
    table = spark.createDataFrame(tags, TAGS)
    assert rows(catalogue.run_catalogue(spark, table, "2020-01-01")) == {(8, 249), (7, 132), (8, 133), (9, 133)}
    root = str(tmp_path / "profile")
    catalogue.tag_catalogue(spark, table.where("id != 244"), "2020-01-01", root, 1)
    stored = catalogue.tag_catalogue(spark, table, "2020-01-01", root, 2, base=1)
    assert rows(profile.explode_profile(spark.read.parquet(stored))) == {(8, 249), (7, 132), (8, 133), (9, 133)}


def test_long_lists_are_looked_up_in_the_table(spark, rows):
    spark.range(500).selectExpr("id AS u", "CAST(id % 60 AS STRING) AS c", "id * 1.0D AS m").createOrReplaceTempView("many")
    tags = [(10, "t", 4, 1, None, 3, text("many", "u,c", "text(c)")), (20, "n", 4, 1, None, 3, text("many", "u,m", "number(m)"))]
    tags += [(1000 + i, "v", 5, 10, None, 3, str(i)) for i in range(50)]
    tags += [(2000 + i, "v", 5, 20, None, 3, f"{i * 7}-{i * 7 + 9}") for i in range(50)]
    table = spark.createDataFrame(tags, TAGS)
    short = rows(catalogue.run_catalogue(spark, table, "2020-01-01"))
    assert len(short) == sum(i % 60 < 50 for i in range(500)) + 353
    assert rows(catalogue.run_catalogue(spark, table, "2020-01-01", list_limit=40)) == short


def test_clusters_take_the_values_in_order(spark, rows):
    far = [(u, 100.0 * (u % 3) + u * 0.001, 50.0 * (u % 3)) for u in range(300)]
    spark.createDataFrame(far, "u long, x double, y double").createOrReplaceTempView("far")
    tags = [(10, "k", 4, 1, None, 3, text("far", "u,x,y", "cluster(x,y)"))]
    tags += [(11, "best", 5, 10, 1, 3, "1"), (12, "mid", 5, 10, 2, 3, "2"), (13, "last", 5, 10, 3, 3, "3")]
    got = rows(catalogue.run_catalogue(spark, spark.createDataFrame(tags, TAGS), "2020-01-01"))
    assert got == {(u, 13 - u % 3) for u in range(300)}


def test_pivot_of_lists_is_the_pivot_of_rows(spark, rows):
    tags = spark.createDataFrame([(50, 8), (51, 8), (83, 14), (84, 14), (97, 16)], "id long, pid long")
    df = spark.createDataFrame([(1, [51, 50, 97]), (2, [84]), (3, [97]), (4, []), (5, None)], "user_id long, tag_ids array<long>")
    want = {(1, 50, None), (2, None, 84)}
    out = profile.pivot_lists(df, tags, [8, 14])
    assert rows(out) == want == rows(profile.pivot_profile(profile.explode_profile(df), tags, [8, 14]))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_texts_stay_below_the_joins(spark, rows):
    """A good votes before it is joined to its order; category and brand are made once per product."""
    goods = [("o1", "白色", "冰吧"), ("o1", "黑色", "冰吧"), ("o1", None, "冰吧"), ("o2", "白色", "料理机"), ("o2", "x", "料理机"), ("o3", "黑色", None)]
    spark.createDataFrame(goods, "g string, colour string, kind string").createOrReplaceTempView("voters")
    spark.createDataFrame([("o1", 7), ("o2", 8), ("o3", 9)], "o string, member long").createOrReplaceTempView("voters_orders")
    rule = text("voters#voters_orders", "g,colour,kind#member,o", "vote(colour,kind)")
    tags = [(10, "vote", 4, 1, None, 3, rule), (11, "male", 5, 10, 1, 3, "1"), (12, "female", 5, 10, 2, 3, "2")]
    table = spark.createDataFrame(tags, TAGS)
    # member 7 has a vote for either side, 8 one for rule 2, 9 none
    assert rows(catalogue.run_catalogue(spark, table, "2020-01-01")) == {(8, 12)}
    (plan,) = catalogue.compile_catalogue(table)
    above = catalogue.run_plan(spark, plan, "2020-01-01")._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "_ballot" in above and "colour#" not in above
    whole.sources(spark, SF)
    lines = spark.table("catalogue_lines")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in lines and "regexp_extract" not in lines.split("Join")[0]
