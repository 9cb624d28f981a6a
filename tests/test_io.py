import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.operators import ml
from tagloom.plans import jobs
from tagloom.operators.profile import merge_profile
from tagloom.session import is_small, shared_dir, small_table
from tagloom.sinks import writers
from tagloom.sources import readers
from tagloom.specs import HBASE, SourceSpec, parse_rule


def test_shared_dir_is_below_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != two and (base is None or one.startswith(base))


def test_size_check_counts_to_the_limit(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)
    assert is_small(spark.range(0), 0)


def test_bucketed_profile_is_not_shuffled_again(spark, rows, tmp_path):
    first = small_table(spark, [(u, [50]) for u in range(40)], "user_id bigint, tag_ids array<bigint>")
    stored = writers.write_bucketed(first, "tagloom_test_bucketed", str(tmp_path / "p"), "user_id", 8)
    assert len(list((tmp_path / "p").glob("part-*"))) <= 8
    new = small_table(spark, [(1, 83), (99, 84)], "user_id bigint, tag_id bigint")
    merged = merge_profile(stored, new)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1
    assert {r for r in rows(merged) if r[0] in (0, 1, 99)} == {(0, (50,)), (1, (50, 83)), (99, (84,))}
    spark.sql("drop table tagloom_test_bucketed")


def test_versions_are_never_overwritten(spark, rows, tmp_path):
    root = str(tmp_path)
    new = small_table(spark, [(1, 50)], "user_id bigint, tag_id bigint")
    first = writers.write_merged_profile(new, root, 1)
    second = writers.write_merged_profile(new.withColumn("tag_id", F.lit(83).cast("bigint")), root, 2, base=1)
    assert rows(spark.read.parquet(first)) == {(1, (50,))} and rows(spark.read.parquet(second)) == {(1, (50, 83))}
    with pytest.raises(Exception, match="already exists"):
        writers.write_merged_profile(new, root, 2)


def test_wide_profile_in_parts(spark, rows, tmp_path):
    df = spark.range(100).withColumn("tag_8", F.col("id") % 2)
    path = writers.write_profile_wide(df, str(tmp_path), 1, parts=5)
    assert len(list((tmp_path / "v00000001").glob("part-*"))) == 5
    assert spark.read.parquet(path).count() == 100


def test_export_splits_sheets(spark, tmp_path):
    path = writers.export_users(spark.range(10).coalesce(1), ["id"], str(tmp_path / "out"), sheet_rows=4)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 3
    assert spark.read.csv(path, header=True).count() == 10


def test_tsv_keeps_what_is_too_long(spark, rows, tmp_path):
    lines = ["\t".join(f"c{i}" for i in range(n)) for n in (6, 7, 9)] + ["c0\t\t\t\t\t\t"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "t"))
    got = readers.read_tsv_fixed(spark, str(tmp_path / "t"), "product_type", [("first", 0), ("last", 6)])
    assert rows(got) == {("c0", "c6"), ("c0", "c6\tc7\tc8"), ("c0", "")}


def test_model_is_stored_once(spark, tmp_path):
    df = ml.assemble(spark.range(20).withColumn("x", F.col("id") * 1.0), ["x"])
    path = str(tmp_path / "model")
    first = writers.load_or_fit(spark, path, lambda: ml.kmeans_fit(df, 3))
    again = writers.load_or_fit(spark, path, lambda: pytest.fail("must load"))
    assert isinstance(again, KMeansModel)
    assert sorted(map(tuple, first.clusterCenters())) == sorted(map(tuple, again.clusterCenters()))


class _Reader:
    """Stands in for a session: remembers what a JDBC read was asked for."""

    def __init__(self, df):
        self.df, self.given = df, {}
        self.read = self

    def format(self, name):
        self.given["format"] = name
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def options(self, **pairs):
        self.given.update(pairs)
        return self

    def load(self):
        return self.df


def test_jdbc_options(spark):
    reader = _Reader(spark.range(10))
    df = readers.read_jdbc(reader, "jdbc:mysql://h/tags", "tbl_basic_tag", "id > 5", ("id", 0, 100, 4), user="u")
    assert reader.given == {
        "format": "jdbc", "url": "jdbc:mysql://h/tags", "dbtable": "tbl_basic_tag", "user": "u",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    assert df.count() == 4


def test_rdbms_source_reads_over_jdbc(spark):
    reader = _Reader(spark.range(3))
    spec = parse_rule("inType=mysql\ndriver=d\nurl=jdbc:x?a=b\nusername=u\npassword=p\ndbTable=t")[0]
    assert readers.read_source(reader, spec).count() == 3
    assert reader.given == {"format": "jdbc", "url": "jdbc:x?a=b", "dbtable": "t", "driver": "d", "user": "u", "password": "p"}


def test_tag_job_from_rule_text_to_profile(spark, rows, tmp_path):
    users = small_table(spark, [(1, "1", "3"), (2, "2", None), (3, "0", "x")], "id bigint, gender string, job string")
    from tagloom.operators.cells import rows_to_cells

    store = writers.write_cells(rows_to_cells(users, "id", "detail"), str(tmp_path / "cells"))
    spec = parse_rule(f"inType=hbase\nhbaseTable={store}\nfamily=detail\nselectFieldNames=gender,job")[0]
    todo = [jobs.TagJob("gender", "gender", tuple(seeds.GENDER)), jobs.TagJob("job", "job", tuple(seeds.JOB))]
    path = jobs.tag_source(spark, spec, "row", todo, str(tmp_path / "profile"), 1)
    assert rows(spark.read.parquet(path)) == {(1, (50, 85)), (2, (51,))}


def test_cells_source_without_family_rows(spark, tmp_path):
    store = small_table(spark, [("1", "f", "a", "x", 1)], "rowkey string, family string, qualifier string, value string, ts bigint")
    store.write.parquet(str(tmp_path / "c"))
    assert readers.read_source(spark, SourceSpec(HBASE, str(tmp_path / "c"), "none", ("a",))).count() == 0


def test_run_wide_and_pairs_agree(spark, rows):
    users = small_table(spark, [(1, "1", "152"), (2, "9", "999")], "id bigint, gender string, height string")
    todo = [jobs.TagJob("gender", "gender", tuple(seeds.GENDER)), jobs.TagJob("height", "height", tuple(seeds.HEIGHT), jobs.RANGE)]
    assert rows(jobs.run_wide(users, "id", todo)) == {(1, 50, 60), (2, None, None)}
    assert rows(jobs.run_pairs(users, "id", todo)) == {(1, 50), (1, 60)}
    assert rows(jobs.run_profile(users, "id", todo)) == {(1, (50, 60)), (2, ())}


def test_conditions_of_every_source(spark, rows, tmp_path):
    from tagloom.operators.cells import rows_to_cells

    users = small_table(spark, [(1, "1", "3"), (2, "2", "5"), (3, None, "3"), (4, None, None)], "id bigint, gender string, job string")
    extra = users.withColumn("other", F.lit("x"))
    store = writers.write_cells(rows_to_cells(extra, "id", "detail"), str(tmp_path / "cells"))
    text = f"inType=hbase\nhbaseTable={store}\nfamily=detail\nselectFieldNames=gender\n"
    assert rows(readers.read_source(spark, parse_rule(text)[0])) == {("1", "1"), ("2", "2"), ("3", None), ("4", None)}
    one = parse_rule(text + "whereFieldNames=job\nwhereFieldValues=3")[0]
    assert rows(readers.read_source(spark, one)) == {("1", "1"), ("3", None), ("4", None)}
    full = users.where("job is not null")
    full.write.saveAsTable("rule_users", path=str(tmp_path / "hive"))
    try:
        hive = "inType=hive\ndbTable=rule_users\nselectFieldNames=id\n"
        assert rows(readers.read_source(spark, parse_rule(hive)[0])) == {(1,), (2,), (3,)}
        assert rows(readers.read_source(spark, parse_rule(hive + "whereFieldNames=job\nwhereFieldValues=3")[0])) == {(1,), (3,)}
        assert rows(readers.read_source(spark, parse_rule(hive + "sql=select * from rule_users where id > 1")[0])) == {(2,), (3,)}
    finally:
        spark.sql("DROP TABLE rule_users")
    full.select("id", "job").write.csv(str(tmp_path / "csv"), sep=";")
    hdfs = f"inType=hdfs\ninPath={tmp_path / 'csv'}\nsperator=;\ninFields=id,job\noutFields=id\nwhereFieldNames=job\nwhereFieldValues=3"
    assert rows(readers.read_source(spark, parse_rule(hdfs)[0])) == {("1",), ("3",)}


def test_rdbms_conditions_query_and_partitions(spark):
    reader = _Reader(spark.createDataFrame([(1, "3"), (2, "5")], "id int, job string"))
    text = "inType=mysql\nurl=jdbc:x\ndbTable=t\nsql=select * from t\npartitionColumn=id\nlowerBound=0\nupperBound=9\nnumPartitions=3\nselectFieldNames=id\nwhereFieldNames=job\nwhereFieldValues=3"
    assert [tuple(r) for r in readers.read_source(reader, parse_rule(text)[0]).collect()] == [(1,)]
    assert reader.given["dbtable"] == "(select * from t) AS rule_rows"
    assert (reader.given["partitionColumn"], reader.given["numPartitions"]) == ("id", "3")
