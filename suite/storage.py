"""Sources, sinks and cells. Written data goes to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from tagloom import seeds
from tagloom.operators import cells, match, profile, search
from tagloom.session import shared_dir
from tagloom.sinks import writers
from tagloom.sources import readers
from tagloom.specs import HBASE, HDFS, HIVE, SourceSpec, parse_rule

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


_FIELDS = ["gender", "job", "birthday", "education"]


def _user_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells.rows_to_cells(b.users(spark, sf), "id", "detail", _FIELDS)


# ---------------------------------------------------------------- sources


@query(
    "S1_read_cells",
    b.sql("SELECT CAST(id AS VARCHAR) AS row, gender, birthday FROM u WHERE gender <> '0'"),
)
def read_cells(spark: SparkSession, sf: str) -> DataFrame:
    """User cells in a stored table, two fields of them with a condition."""
    path = writers.write_cells(_user_cells(spark, sf), shared_dir(spark, "cells"))
    spec = SourceSpec(HBASE, path, "detail", ("gender", "birthday"), "gender[ne]0")
    return readers.read_cells(spark, spec)


@query("S2_read_wide", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def read_wide(spark: SparkSession, sf: str) -> DataFrame:
    catalog = readers.catalog_text(f"{sf}/customer.parquet", ["c_mktsegment", "c_nationkey"], "info", key="c_custkey")
    return readers.read_catalog(spark, catalog)


@query("S3_read_tag_family", b.sql("SELECT id, name, level, pid FROM tags WHERE id = 42 OR pid = 42"))
def tag_family(spark: SparkSession, sf: str) -> DataFrame:
    """A level-4 tag with its values, as the tag jobs read it from the tag table."""
    return readers.read_tag_family(b.tags(spark, sf), 42).select("id", "name", "level", "pid")


@query("S4_read_source", b.sql("SELECT CAST(id AS VARCHAR) AS id, gender, 'hbase' AS kind FROM u UNION ALL SELECT CAST(id AS VARCHAR), gender, 'hive' FROM u UNION ALL SELECT CAST(id AS VARCHAR), gender, 'hdfs' FROM u"))
def read_source(spark: SparkSession, sf: str) -> DataFrame:
    """The same users through three kinds of source."""
    users = b.users(spark, sf).select(F.col("id").cast("string").alias("id"), "gender")
    stored = writers.write_cells(_user_cells(spark, sf), shared_dir(spark, "cells"))
    text = shared_dir(spark, "text")
    users.write.csv(text, sep="\t")
    users.createOrReplaceTempView("tagloom_users")
    specs = [
        SourceSpec(HBASE, stored, "detail", ("gender",)),
        SourceSpec(HIVE, "tagloom_users", fields=("id", "gender")),
        SourceSpec(HDFS, text, fields=("id", "gender"), options=(("sperator", "\\t"),)),
    ]
    parts = [
        readers.read_source(spark, s).withColumnRenamed("row", "id").select("id", "gender", F.lit(s.kind).alias("kind"))
        for s in specs
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("S5_read_hive", "SELECT * FROM part")
def read_hive(spark: SparkSession, sf: str) -> DataFrame:
    b.table(spark, sf, "part").createOrReplaceTempView("tagloom_part")
    return readers.read_hive(spark, "tagloom_part")


@query("S5_read_stored_table", b.sql("SELECT CAST(id AS VARCHAR) AS id, gender, nationality FROM u WHERE gender = '1'"))
def read_stored_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table of the catalog that was written before, by a rule text with a condition."""
    users = b.users(spark, sf).select(F.col("id").cast("string").alias("id"), "gender", "nationality", "job")
    users.write.mode("overwrite").option("path", shared_dir(spark, "table")).saveAsTable("tagloom_stored_users")
    text = "inType=hive\ndbTable=tagloom_stored_users\nselectFieldNames=id,gender,nationality\nwhereFieldNames=gender\nwhereFieldValues=1"
    return readers.read_source(spark, parse_rule(text)[0])


@query("S6_read_delimited", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def read_delimited(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "text")
    b.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(path, sep="|")
    return readers.read_delimited(spark, path, "|", ["id", "status", "priority"])


def _tabs(fields: int, first: Column, last: Column) -> Column:
    return F.concat(first, F.repeat(F.lit("\t"), fields - 1), last)


@query(
    "S7_read_tsv_fixed",
    """SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 5 = 1 THEN props || chr(9) || 'x' ELSE props END AS last
    FROM events WHERE event_id % 5 <> 0""",
)
def read_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines of 11 fields; every fifth is one short, another fifth one too long."""
    e, props = F.col("event_id"), F.col("props")
    line = (
        F.when(e % 5 == 0, _tabs(10, e.cast("string"), props))
        .when(e % 5 == 1, _tabs(11, e.cast("string"), F.concat(props, F.lit("\tx"))))
        .otherwise(_tabs(11, e.cast("string"), props))
    )
    path = shared_dir(spark, "tsv")
    b.table(spark, sf, "events").select(line.alias("value")).write.text(path)
    return readers.read_tsv_fixed(spark, path, "log", [("id", 0), ("last", 10)])


@query("S8_read_libsvm", "SELECT CAST(label AS DOUBLE) AS label, round(CAST(embedding[1] AS DOUBLE), 6) AS first, round(CAST(embedding[64] AS DOUBLE), 6) AS last FROM embeddings")
def read_libsvm(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = F.transform("embedding", lambda x, i: F.concat((i + 1).cast("string"), F.lit(":"), x.cast("double").cast("string")))
    line = F.concat_ws(" ", F.col("label").cast("string"), F.array_join(values, " "))
    path = shared_dir(spark, "libsvm")
    b.table(spark, sf, "embeddings").select(line.alias("value")).write.text(path)
    v = vector_to_array("features")
    rows = readers.read_libsvm(spark, path, 64)
    return rows.select("label", F.round(v[0], 6).alias("first"), F.round(v[63], 6).alias("last"))


# ---------------------------------------------------------------- sinks


@query(
    "K1_write_profile_wide",
    b.sql(
        f"""SELECT id, CASE WHEN a THEN {b.sql_match('gender', seeds.GENDER)} END AS tag_8,
        coalesce(CASE WHEN z THEN {b.sql_match('marriage', seeds.MARRIAGE)} END, CASE WHEN a THEN
        {b.sql_match('job', seeds.JOB)} END) AS tag_14, CASE WHEN z THEN {b.sql_match('political', seeds.POLITICAL)} END AS tag_13
        FROM (SELECT *, education IS NOT NULL AS a, property IS NOT NULL AS z FROM u) WHERE a OR z"""
    ),
)
def write_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions: the second writes one old column and one new one."""
    users, root = b.users(spark, sf), shared_dir(spark, "wide")
    first = match.match_many(
        users.where("education is not null"), "id",
        {"tag_8": match.match_column(F.col("gender"), seeds.GENDER), "tag_14": match.match_column(F.col("job"), seeds.JOB)},
    )
    second = match.match_many(
        users.where("property is not null"), "id",
        {"tag_14": match.match_column(F.col("marriage"), seeds.MARRIAGE), "tag_13": match.match_column(F.col("political"), seeds.POLITICAL)},
    )
    writers.write_profile_wide(first, root, 1)
    return spark.read.parquet(writers.write_profile_wide(second, root, 2, base=1))


@query(
    "K2_merge_profile_versions",
    b.sql(
        f"""SELECT user_id, array_to_string(list_sort(list(tag_id)), ',') AS tag_ids FROM (
        SELECT id AS user_id, {b.sql_match('gender', seeds.GENDER)} AS tag_id FROM u UNION ALL
        SELECT id, {b.sql_match('job', seeds.JOB)} FROM u) WHERE tag_id IS NOT NULL GROUP BY user_id"""
    ),
)
def merge_versions(spark: SparkSession, sf: str) -> DataFrame:
    users, root = b.users(spark, sf), shared_dir(spark, "profile")
    gender = match.match_tag(users, "id", "gender", seeds.GENDER).withColumnRenamed("id", "user_id")
    job = match.match_tag(users, "id", "job", seeds.JOB).withColumnRenamed("id", "user_id")
    writers.write_merged_profile(gender, root, 1)
    stored = spark.read.parquet(writers.write_merged_profile(job, root, 2, base=1))
    return stored.select("user_id", F.array_join(F.sort_array("tag_ids").cast("array<string>"), ",").alias("tag_ids"))


@query(
    "K2_merge_bucketed_profile",
    b.sql(
        f"""SELECT user_id, array_to_string(list_sort(list(tag_id)), ',') AS tag_ids FROM (
        SELECT id AS user_id, {b.sql_match('gender', seeds.GENDER)} AS tag_id FROM u UNION ALL
        SELECT id, {b.sql_match('job', seeds.JOB)} FROM u) WHERE tag_id IS NOT NULL GROUP BY user_id"""
    ),
)
def merge_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The stored profile keeps its buckets; only the new tags are shuffled to them."""
    users, path = b.users(spark, sf), shared_dir(spark, "bucketed")
    first = profile.collapse_profile(match.match_tag(users, "id", "gender", seeds.GENDER), "id")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = writers.write_bucketed(first, f"tagloom_{path[-12:]}", path, "user_id", buckets)
    merged = profile.merge_profile(stored, match.match_tag(users, "id", "job", seeds.JOB), "id")
    return merged.select("user_id", profile.encode_tags(F.sort_array("tag_ids")).alias("tag_ids"))


@query(
    "K3_rows_to_cells",
    b.sql(
        """SELECT CAST(id AS VARCHAR) AS rowkey, 'detail' AS family, qualifier, value, CAST(0 AS BIGINT) AS ts FROM (
        SELECT id, 'gender' AS qualifier, gender AS value FROM u UNION ALL SELECT id, 'job', job FROM u UNION ALL
        SELECT id, 'birthday', birthday FROM u UNION ALL SELECT id, 'education', education FROM u) WHERE value IS NOT NULL"""
    ),
)
def rows_to_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells.sort_cells(_user_cells(spark, sf))


@query("K4_cells_to_rows", b.sql("SELECT CAST(id AS VARCHAR) AS row, gender, job, birthday, education FROM u"))
def cells_to_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Back again: every field as it was, the missing ones null."""
    return cells.cells_to_rows(_user_cells(spark, sf), "detail", _FIELDS)


@query(
    "K4_cells_to_rows_versions",
    b.sql(
        """SELECT rowkey AS row, max(value) FILTER (qualifier = 'status') AS status,
        max(value) FILTER (qualifier = 'clerk') AS clerk FROM newest WHERE qualifier IN ('status', 'clerk') GROUP BY rowkey"""
    ),
)
def cells_versions(spark: SparkSession, sf: str) -> DataFrame:
    return cells.cells_to_rows(b.cells(spark, sf), "detail", ["status", "clerk"])


@query(
    "K5_sync_table",
    """SELECT rowkey, qualifier, value FROM (SELECT CAST(p_partkey AS VARCHAR) AS rowkey,
    unnest(['p_name', 'p_brand', 'p_type', 'p_size']) AS qualifier, unnest([p_name, p_brand, p_type, CAST(p_size AS VARCHAR)]) AS value FROM part)""",
)
def sync_table(spark: SparkSession, sf: str) -> DataFrame:
    part = b.table(spark, sf, "part").drop("p_retailprice")
    path = writers.sync_table(part, "p_partkey", "info", shared_dir(spark, "sync"))
    return spark.read.parquet(path).select("rowkey", "qualifier", "value")


@query(
    "K2_profile_cells",
    b.sql(
        """SELECT 'u_' || CAST(user_id AS VARCHAR) AS rowkey, unnest(['userId', 'tagIds']) AS qualifier,
        unnest([CAST(user_id AS VARCHAR), tag_ids]) AS value FROM (SELECT user_id,
        array_to_string(list_sort(list(tag_id)), ',') AS tag_ids FROM own GROUP BY user_id)"""
    ),
)
def profile_cells(spark: SparkSession, sf: str) -> DataFrame:
    return writers.profile_cells(b.profile(spark, sf)).select("rowkey", "qualifier", "value")


@query(
    "K7_export_users",
    b.sql(
        """SELECT left(name, 1) || '**' AS name, left(id_card, 3) || repeat('*', 12) || right(id_card, 3) AS id_card,
        left(mobile, 3) || repeat('*', 5) || right(mobile, 3) AS mobile, CAST(id AS VARCHAR) AS id
        FROM u WHERE id IN (SELECT user_id FROM own WHERE tag_id IN (51, 97))"""
    ),
)
def export_users(spark: SparkSession, sf: str) -> DataFrame:
    found = search.users_by_tags_any(b.profile(spark, sf), b.tags(spark, sf), [51, 97])
    rows = b.users(spark, sf).join(found.withColumnRenamed("user_id", "id"), "id", "left_semi")
    hidden = search.masked_users(rows, "name", ["id_card", "mobile"])
    path = writers.export_users(hidden, ["id", "name", "id_card", "mobile"], shared_dir(spark, "export"))
    return spark.read.csv(path, header=True, schema="id string, name string, id_card string, mobile string")


# ---------------------------------------------------------------- cells


def _text(df: DataFrame) -> DataFrame:
    return df.select("rowkey", "family", "qualifier", "value", "ts")


@query(
    "H1_scan",
    b.sql("SELECT rowkey, string_agg(qualifier || '=' || value, ';' ORDER BY qualifier) AS row FROM newest GROUP BY rowkey"),
)
def scan(spark: SparkSession, sf: str) -> DataFrame:
    entries = F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return cells.scan(b.cells(spark, sf), "detail").select(
        "rowkey", F.array_join(F.sort_array(entries), ";").alias("row")
    )


_FROM, _TO = 883612800000000, 915148800000000  # the year 1998


@query(
    "H2_time_range",
    b.sql(
        f"""SELECT rowkey, family, qualifier, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY rowkey, qualifier
        ORDER BY ts DESC, value DESC) AS rn FROM cells WHERE ts >= {_FROM} AND ts < {_TO}) WHERE rn = 1"""
    ),
)
def time_range(spark: SparkSession, sf: str) -> DataFrame:
    return cells.time_range(b.cells(spark, sf), _FROM, _TO)


@query("H3_get", b.sql("SELECT * FROM newest WHERE rowkey = '42'"))
def get(spark: SparkSession, sf: str) -> DataFrame:
    return cells.get(b.cells(spark, sf), "42")


@query("H3_multi_get", b.sql("SELECT * FROM newest WHERE rowkey IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 7)"))
def multi_get(spark: SparkSession, sf: str) -> DataFrame:
    wanted = b.table(spark, sf, "customer").where("c_nationkey = 7").select(F.col("c_custkey").cast("string").alias("rowkey"))
    return cells.multi_get(b.cells(spark, sf), wanted)


@query("H4_key_range", b.sql("SELECT * FROM newest WHERE rowkey >= '12' AND rowkey < '3'"))
def key_range(spark: SparkSession, sf: str) -> DataFrame:
    return cells.key_range(b.cells(spark, sf), "12", "3")


@query(
    "H5_value_contains",
    b.sql("SELECT rowkey, value FROM newest WHERE qualifier = 'priority' AND contains(value, 'GH') ORDER BY rowkey LIMIT 50"),
)
def value_contains(spark: SparkSession, sf: str) -> DataFrame:
    return cells.value_contains(b.cells(spark, sf), "detail", "priority", "GH", 50)


@query("H6_value_equals", b.sql("SELECT rowkey, value FROM newest WHERE qualifier = 'status' AND value = 'F'"))
def value_equals(spark: SparkSession, sf: str) -> DataFrame:
    return cells.value_equals(b.cells(spark, sf), "detail", "status", "F")


@query("H7_has_qualifier", b.sql("SELECT DISTINCT rowkey FROM cells WHERE qualifier = 'clerk' ORDER BY rowkey LIMIT 60"))
def has_qualifier(spark: SparkSession, sf: str) -> DataFrame:
    return cells.has_qualifier(b.cells(spark, sf), "detail", "clerk", 60)


@query(
    "H8_match_all",
    b.sql(
        """SELECT rowkey FROM newest WHERE (qualifier = 'status' AND value = 'O') OR (qualifier = 'priority' AND value = '5-LOW')
        GROUP BY rowkey HAVING count(*) = 2"""
    ),
)
def match_all(spark: SparkSession, sf: str) -> DataFrame:
    return cells.match_all(b.cells(spark, sf), "detail", {"status": "O", "priority": "5-LOW"})


@query(
    "H8_match_any",
    b.sql(
        "SELECT DISTINCT rowkey FROM newest WHERE (qualifier = 'status' AND value = 'P') OR (qualifier = 'clerk' AND value = 'clerk-4')"
    ),
)
def match_any(spark: SparkSession, sf: str) -> DataFrame:
    return cells.match_any(b.cells(spark, sf), "detail", {"status": "P", "clerk": "clerk-4"})


@query("H9_count_contains", b.sql("SELECT count(*) AS n FROM newest WHERE qualifier = 'clerk' AND contains(value, '-2')"))
def count_contains(spark: SparkSession, sf: str) -> DataFrame:
    return cells.count_contains(b.cells(spark, sf), "detail", "clerk", "-2")


@query("H10_all_row_keys", b.sql("SELECT DISTINCT rowkey FROM cells"))
def all_row_keys(spark: SparkSession, sf: str) -> DataFrame:
    return cells.all_row_keys(b.cells(spark, sf))


@query(
    "H11_upsert_and_delete",
    b.sql(
        f"""SELECT rowkey, family, qualifier, value, ts FROM newest WHERE rowkey IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
          WHERE c_nationkey <> 3) AND NOT (qualifier = 'status' AND rowkey IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 5))
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'detail', 'status', c_mktsegment, {2 * _TO} FROM customer WHERE c_nationkey = 5"""
    ),
)
def upsert_delete(spark: SparkSession, sf: str) -> DataFrame:
    """One nation's status is written anew, another nation's rows are deleted."""
    customer = b.table(spark, sf, "customer").withColumn("rowkey", F.col("c_custkey").cast("string"))
    changed = cells.update_qualifier(
        b.cells(spark, sf), customer.where("c_nationkey = 5"), "detail", "status", F.col("c_mktsegment"), 2 * _TO
    )
    return _text(cells.delete_rows(changed, customer.where("c_nationkey = 3")))
