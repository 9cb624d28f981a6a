"""The tag tree and its companions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from tagloom.operators import catalog

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


_CHAIN = """SELECT a.id, e.name AS n1, d.name AS n2, c.name AS n3, p.name AS n4, a.name AS n0,
  a.id IN (SELECT pid FROM tags) AS has FROM tags a LEFT JOIN tags p ON a.pid = p.id LEFT JOIN tags c ON p.pid = c.id
  LEFT JOIN tags d ON c.pid = d.id LEFT JOIN tags e ON d.pid = e.id"""


@query(
    "Q13_tag_path",
    b.sql(f"SELECT id, concat_ws(' --- ', n1, n2, n3, n4, CASE WHEN has THEN n0 END) AS path FROM ({_CHAIN})"),
)
def tag_path(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tag_path(b.tags(spark, sf))


@query("Q13_tag_path_with_leaf", b.sql(f"SELECT id, concat_ws(' --- ', n1, n2, n3, n4, n0) AS path FROM ({_CHAIN})"))
def tag_path_leaf(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tag_path(b.tags(spark, sf), include_leaf=True)


@query("Q14_leaf_tags", b.sql("SELECT DISTINCT tag_id FROM leaves WHERE ancestor_id IN (5, 8, 97)"))
def leaf_tags(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.leaf_tags(b.tags(spark, sf), [5, 8, 97])


@query(
    "Q15_subtree",
    b.sql(
        """SELECT CAST(5 AS BIGINT) AS id, 3 AS level, 'self' AS relation UNION ALL
        SELECT id, level, 'ancestor' FROM tags WHERE id IN (1, 2) UNION ALL
        SELECT id, level, 'descendant' FROM tags WHERE pid = 5 UNION ALL
        SELECT id, level, 'descendant' FROM tags WHERE pid IN (SELECT id FROM tags WHERE pid = 5)"""
    ),
)
def subtree(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.subtree(b.tags(spark, sf), 5)


@query("Q16_search_tags", b.sql("SELECT DISTINCT id, name, level, pid FROM tags WHERE name LIKE '%ring%' AND state <> -1"))
def search_tags(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.search_tags(b.tags(spark, sf).select("id", "name", "level", "pid", "state"), "ring").drop("state")


@query(
    "Q17_visible_tags",
    b.sql(
        """SELECT id, name, level FROM tags WHERE state <> -1 AND id IN (SELECT tag_id FROM user_grants WHERE user_id = 3
        UNION ALL SELECT tag_id FROM role_grants WHERE role_id = 4 AND tag_type = 1)"""
    ),
)
def visible_tags(spark: SparkSession, sf: str) -> DataFrame:
    users, roles = b.grants(spark, sf)
    return catalog.visible_tags(b.tags(spark, sf), users, roles, 3, 4).select("id", "name", "level")


@query(
    "Q17_visible_tags_super",
    b.sql(
        """SELECT id, name, level FROM tags WHERE state <> -1 AND id IN (SELECT tag_id FROM user_grants
        UNION ALL SELECT tag_id FROM role_grants WHERE tag_type = 1)"""
    ),
)
def visible_super(spark: SparkSession, sf: str) -> DataFrame:
    users, roles = b.grants(spark, sf)
    return catalog.visible_tags(b.tags(spark, sf), users, roles, 3, 1).select("id", "name", "level")


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    users, _ = b.grants(spark, sf)
    user_tags = users.select((F.col("user_id") * 1_000_000 + F.col("tag_id")).alias("id"), "user_id", "tag_id")
    merged = b.merge_tags(spark, sf)
    user_merges = merged.select(
        (F.col("id") * 10).alias("id"),
        (F.col("id") % 50).alias("user_id"),
        F.col("id").alias("merge_tag_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(4).alias("state"),
    )
    return catalog.tag_audit(b.tags(spark, sf), user_tags, merged, user_merges, name="1")


_AUDIT = """(SELECT user_id * 1000000 + tag_id AS id, t.id AS tag_id, name, business, 1 AS type, level, state,
  user_id AS apply_user_id, ctime FROM tags t LEFT JOIN user_grants g ON t.id = g.tag_id WHERE contains(name, '1') UNION
  SELECT id * 10, id, name, condition, 2, -1, CASE WHEN id % 2 = 0 THEN 1 ELSE 4 END, id % 50, ctime FROM merge_tags
  WHERE contains(name, '1'))"""


@query("Q18_tag_audit_total", b.sql(f"SELECT count(*) AS total, count(DISTINCT tag_id) AS tags FROM {_AUDIT}"))
def audit_total(spark: SparkSession, sf: str) -> DataFrame:
    return _audit(spark, sf).agg(F.count("*").alias("total"), F.countDistinct("tag_id").alias("tags"))


@query(
    "Q18_tag_audit_page",
    b.sql(f"SELECT * REPLACE (CAST(ctime AS VARCHAR) AS ctime) FROM {_AUDIT} a ORDER BY a.ctime DESC, type, tag_id, id NULLS FIRST LIMIT 30 OFFSET 30"),
)
def audit_page(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tag_audit_list(_audit(spark, sf), 2, 30).withColumn("ctime", F.col("ctime").cast("string"))


@query("Q19_tags_per_merge_tag", b.sql("SELECT merge_tag_id, count(*) AS members FROM members GROUP BY 1"))
def per_merge(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tags_per_merge_tag(b.merge_members(spark, sf))


@query("Q20_tag_count_by_level", b.sql("SELECT level, count(*) AS tags FROM tags t GROUP BY level"))
def by_level(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.tag_count_by_level(b.tags(spark, sf))


@query(
    "Q21_merge_tag_members",
    b.sql(
        """SELECT merge_tag_id, m.name AS merge_name, seq, basic_tag_id, t.name AS tag_name, level, connector
        FROM members JOIN merge_tags m ON merge_tag_id = m.id JOIN tags t ON basic_tag_id = t.id WHERE m.state <> 6"""
    ),
)
def members(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.merge_tag_members(b.merge_tags(spark, sf), b.merge_members(spark, sf), b.tags(spark, sf))
