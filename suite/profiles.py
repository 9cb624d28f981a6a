"""Profiles, questions over them and composite tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from tagloom import seeds
from tagloom.functions.columns import mask, mask_name
from tagloom.operators import catalog, composite, match, profile, search, stats
from tagloom.plans.jobs import run_pairs
from tagloom.session import small_table

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


def as_text(df: DataFrame) -> DataFrame:
    return df.select("user_id", profile.encode_tags(F.col("tag_ids")).alias("tag_ids"))


def sql_text(pairs: str) -> str:
    return f"""SELECT user_id, array_to_string(list_sort(list(DISTINCT tag_id)), ',') AS tag_ids
    FROM {pairs} GROUP BY user_id"""


# ---------------------------------------------------------------- flagship


@query(
    "flagship_users_per_job_tag",
    b.sql(f"SELECT tag_id, 1 AS tag_type, count(*) AS user_count FROM (SELECT {b.sql_match('job', seeds.JOB)} AS tag_id FROM u) WHERE tag_id IS NOT NULL GROUP BY tag_id"),
)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Match job tags, merge them into an empty profile, count users per tag."""
    tagged = match.match_tag(b.users(spark, sf), "id", "job", seeds.JOB)
    empty = small_table(spark, [], "user_id bigint, tag_ids array<bigint>")
    merged = profile.merge_profile(empty, tagged.withColumnRenamed("id", "user_id"))
    return search.tag_user_count(merged)


# ---------------------------------------------------------------- merging

# An existing profile: the members whose property is known; without a known
# education the list is empty. The new tags: jobs, but for the first kind of job.
_OLD = """(SELECT id AS user_id, CASE WHEN education IS NULL THEN [] ELSE [50 + id % 2, 850] END AS tags
  FROM u WHERE property IS NOT NULL)"""
_NEW = f"(SELECT id AS user_id, {b.sql_match('job', seeds.JOB[1:])} AS tag_id FROM u)"


def _old(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id")
    none = F.array().cast("array<bigint>")
    tags = F.when(F.col("education").isNull(), none).otherwise(F.array(i % 2 + 50, F.lit(850).cast("bigint")))
    return b.users(spark, sf).where("property is not null").select(i.alias("user_id"), tags.alias("tag_ids"))


def _new(spark: SparkSession, sf: str) -> DataFrame:
    tagged = match.match_tag(b.users(spark, sf), "id", "job", seeds.JOB[1:])
    return tagged.withColumnRenamed("id", "user_id")


@query(
    "P1_merge_profile",
    b.sql(
        f"""SELECT coalesce(o.user_id, n.user_id) AS user_id, array_to_string(list_concat(coalesce(o.tags, []),
        CASE WHEN n.tag_id IS NULL THEN [] ELSE [n.tag_id] END), ',') AS tag_ids
        FROM {_OLD} o FULL JOIN (SELECT * FROM {_NEW} WHERE tag_id IS NOT NULL) n ON o.user_id = n.user_id"""
    ),
)
def merge_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Merged twice on purpose: the second time must change nothing."""
    once = profile.merge_profile(_old(spark, sf), _new(spark, sf))
    return as_text(profile.merge_profile(once, _new(spark, sf)))


@query(
    "P1_replace_siblings",
    b.sql(
        f"""SELECT user_id, array_to_string(list_sort(tags), ',') AS tag_ids FROM (
        SELECT coalesce(o.user_id, n.user_id) AS user_id, list_concat(CASE WHEN n.tag_id IS NULL THEN coalesce(o.tags, [])
          ELSE list_filter(coalesce(o.tags, []), lambda x: x NOT IN (50, 51)) END,
          CASE WHEN n.tag_id IS NULL THEN [] ELSE [n.tag_id] END) AS tags FROM {_OLD} o FULL JOIN
          (SELECT id AS user_id, {b.sql_match('gender', seeds.GENDER)} AS tag_id FROM u WHERE gender IN ('1', '2')) n ON o.user_id = n.user_id)"""
    ),
)
def replace_siblings(spark: SparkSession, sf: str) -> DataFrame:
    """Members of known gender get that tag anew; another old one has to go."""
    new = match.match_tag(b.users(spark, sf), "id", "gender", seeds.GENDER).withColumnRenamed("id", "user_id")
    parents = b.tags(spark, sf).where("level = 5").select(F.col("id").alias("tag_id"), F.col("pid").alias("parent_id"))
    merged = profile.replace_siblings(_old(spark, sf), new, parents)
    return as_text(merged.withColumn("tag_ids", F.sort_array("tag_ids")))


@query("P2_explode_profile", b.sql("SELECT user_id, tag_id FROM own"))
def explode_profile(spark: SparkSession, sf: str) -> DataFrame:
    """From the comma text of a stored profile to rows."""
    stored = as_text(b.profile(spark, sf))
    return profile.explode_profile(stored.withColumn("tag_ids", profile.decode_tags(F.col("tag_ids"))))


@query("P2_collapse_profile", b.sql(sql_text("pairs")))
def collapse_profile(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(profile.collapse_profile(b.pairs(spark, sf)))


_PIVOT = [8, 9, 14, 15, 22]


@query(
    "P3_pivot_profile",
    b.sql(
        "SELECT user_id, "
        + ", ".join(f"min(tag_id) FILTER (pid = {p}) AS tag_{p}" for p in _PIVOT)
        + f" FROM own JOIN tags ON tag_id = tags.id WHERE pid IN ({', '.join(map(str, _PIVOT))}) GROUP BY user_id"
    ),
)
def pivot_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.pivot_lists(b.profile(spark, sf), b.tags(spark, sf), _PIVOT)


@query(
    "P4_merge_many",
    b.sql(
        f"""SELECT coalesce(o.user_id, n.user_id) AS user_id, array_to_string(list_concat(coalesce(o.tags, []),
        list_filter(coalesce(n.tags, []), lambda x: NOT list_contains(coalesce(o.tags, []), x))), ',') AS tag_ids FROM {_OLD} o FULL JOIN (
        SELECT user_id, list_sort(list(DISTINCT tag_id)) AS tags FROM (
          SELECT id AS user_id, {b.sql_match('gender', seeds.GENDER)} AS tag_id FROM u UNION ALL
          SELECT id, {b.sql_match('job', seeds.JOB)} FROM u UNION ALL
          SELECT member_id, {b.sql_match('payment_code', seeds.PAYMENT)} FROM (SELECT *, row_number() OVER
            (PARTITION BY member_id ORDER BY pay_time DESC, order_sn DESC) AS rn FROM ord) WHERE rn = 1)
        WHERE tag_id IS NOT NULL GROUP BY user_id) n ON o.user_id = n.user_id"""
    ),
)
def merge_many(spark: SparkSession, sf: str) -> DataFrame:
    """Three models at once: gender, job and the latest payment."""
    users = b.users(spark, sf)
    outputs = [
        run_pairs(users, "id", [j for j in b.USER_JOBS if j.name in ("gender", "job")]),
        stats.latest_payment(
            b.orders(spark, sf), "member_id", "payment_code", "pay_time", "order_sn", seeds.PAYMENT
        ).select(F.col("member_id").alias("user_id"), "tag_id"),
    ]
    return as_text(profile.merge_many(_old(spark, sf), outputs))


# ---------------------------------------------------------------- users by tags


@query(
    "Q1_users_by_tags_any",
    b.sql("SELECT DISTINCT user_id FROM own JOIN leaves USING (tag_id) WHERE ancestor_id IN (8, 97, 98)"),
)
def users_any(spark: SparkSession, sf: str) -> DataFrame:
    return search.users_by_tags_any(b.profile(spark, sf), b.tags(spark, sf), [8, 97, 98])


@query(
    "Q1_users_by_tags_any_page",
    b.sql(
        "SELECT DISTINCT user_id FROM own JOIN leaves USING (tag_id) WHERE ancestor_id IN (22, 46) ORDER BY user_id LIMIT 40 OFFSET 80"
    ),
)
def users_any_page(spark: SparkSession, sf: str) -> DataFrame:
    found = search.users_by_tags_any(b.profile(spark, sf), b.tags(spark, sf), [22, 46])
    return search.page(found, ["user_id"], 3, 40)


# Composite tag 1 of the seeds, used by the questions that take composite tags.
_RICH = "(SELECT DISTINCT a.user_id FROM own a, own b, own c WHERE a.user_id = b.user_id AND b.user_id = c.user_id AND a.tag_id IN (97, 98) AND b.tag_id IN (132, 133) AND c.tag_id = 214)"


def _with_merges(spark: SparkSession, sf: str) -> DataFrame:
    """Profile rows that also list the user's composite tags."""
    met = [
        F.when(composite.condition(F.col("tag_ids"), members), F.lit(mid).cast("bigint"))
        for mid, members in seeds.COMPOSITES
    ]
    return b.profile(spark, sf).withColumn("merge_ids", match.tag_list(met))


@query(
    "Q2_users_by_tags_all",
    b.sql(
        f"SELECT user_id FROM own WHERE tag_id IN (97, 51) AND user_id IN {_RICH} GROUP BY user_id HAVING count(*) = 2"
    ),
)
def users_all(spark: SparkSession, sf: str) -> DataFrame:
    return search.users_by_tags_all(_with_merges(spark, sf), [97, 51], [1])


@query(
    "Q2_users_by_tags_all_pairs",
    b.sql("SELECT user_id FROM pairs WHERE tag_id IN (51, 83, 214) GROUP BY user_id HAVING count(*) = 3"),
)
def users_all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return search.users_by_tags_all_pairs(b.pairs(spark, sf), [51, 83, 214])


@query("Q3_users_by_basic_tag", b.sql("SELECT user_id FROM own WHERE tag_id = 84 ORDER BY user_id LIMIT 25"))
def users_basic(spark: SparkSession, sf: str) -> DataFrame:
    return search.users_by_tag(_with_merges(spark, sf), 84, 1, 25)


@query("Q3_users_by_merge_tag", b.sql("SELECT user_id FROM own WHERE tag_id = 55 ORDER BY user_id LIMIT 25"))
def users_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Composite tag 4 has the single member 55."""
    return search.users_by_tag(_with_merges(spark, sf), 4, 2, 25)


@query(
    "Q3_user_details",
    b.sql(
        """SELECT left(name, 1) || '**' AS name, left(id_card, 3) || repeat('*', 12) || right(id_card, 3) AS id_card,
        left(mobile, 3) || repeat('*', 5) || right(mobile, 3) AS mobile FROM u
        WHERE id IN (SELECT user_id FROM own WHERE tag_id = 84 ORDER BY user_id LIMIT 25)"""
    ),
)
def user_details(spark: SparkSession, sf: str) -> DataFrame:
    """The first users of a tag as they are shown: names and numbers masked."""
    found = search.users_by_tag(_with_merges(spark, sf), 84, 1, 25)
    shown = search.user_details(found, b.users(spark, sf), "name", ["id_card", "mobile"], 25)
    return shown.select("name", "id_card", "mobile")


@query(
    "Q8_top_users_shown",
    b.sql(
        """SELECT tag_id, CAST(rn AS INTEGER) AS rn, left(name, 1) || '**' AS name, left(mobile, 3) || repeat('*', 5) || right(mobile, 3) AS mobile
        FROM (SELECT tag_id, user_id, row_number() OVER (PARTITION BY tag_id ORDER BY user_id) AS rn FROM own
          JOIN leaves USING (tag_id) WHERE ancestor_id = 14) JOIN u ON id = user_id WHERE rn <= 5"""
    ),
)
def top_users_shown(spark: SparkSession, sf: str) -> DataFrame:
    """Five sample users for each child of the job tag, masked."""
    rules = [r.tag_id for r in seeds.JOB]
    rows = profile.explode_profile(b.profile(spark, sf)).where(F.col("tag_id").isin(*rules))
    top = search.top_users_per_tag(rows, 5)
    people = search.masked_users(b.users(spark, sf).select("id", "name", "mobile"), "name", ["mobile"])
    shown = people.join(F.broadcast(top), F.col("id") == F.col("user_id"))  # five rows per rule
    return shown.select("tag_id", "rn", "name", "mobile")


@query("Q3_users_by_unknown_type", b.sql("SELECT user_id FROM own WHERE false"))
def users_none(spark: SparkSession, sf: str) -> DataFrame:
    return search.users_by_tag(_with_merges(spark, sf), 84, 3, 25)


@query(
    "Q4_count_users_by_tags",
    b.sql("SELECT count(*) AS users FROM (SELECT user_id FROM own WHERE tag_id IN (51, 214) GROUP BY user_id HAVING count(*) = 2)"),
)
def count_users(spark: SparkSession, sf: str) -> DataFrame:
    return search.count_users_by_tags(_with_merges(spark, sf), [51, 214])


@query("Q5_tag_user_count", b.sql("SELECT tag_id, 1 AS tag_type, count(*) AS user_count FROM own GROUP BY tag_id"))
def tag_user_count(spark: SparkSession, sf: str) -> DataFrame:
    return search.tag_user_count(b.profile(spark, sf))


@query(
    "Q5_stored_tag_count",
    b.sql(
        "SELECT CAST(t AS BIGINT) AS tag_id, CAST(coalesce(n, 0) AS BIGINT) AS user_count FROM (SELECT unnest([50, 51, 59, 9999]) AS t)"
        " LEFT JOIN (SELECT tag_id, count(*) AS n FROM own GROUP BY tag_id) ON t = tag_id"
    ),
)
def stored_count(spark: SparkSession, sf: str) -> DataFrame:
    counts = search.tag_user_count(b.profile(spark, sf))
    return search.stored_tag_count(counts, [50, 51, 59, 9999], 1)


@query(
    "Q6_all_user_count",
    b.sql("SELECT count(*) AS user_count, count(DISTINCT user_id) AS covered_users FROM own"),
)
def all_user_count(spark: SparkSession, sf: str) -> DataFrame:
    return search.all_user_count(b.profile(spark, sf))


@query(
    "Q7_tag_share",
    b.sql(
        "SELECT tag_id, count(*) AS user_count, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer), 6) AS share FROM own GROUP BY tag_id"
    ),
)
def tag_share(spark: SparkSession, sf: str) -> DataFrame:
    return search.tag_share(b.profile(spark, sf)).withColumn("share", F.round("share", 6))


@query(
    "Q8_top_users_per_tag",
    b.sql(
        "SELECT tag_id, user_id, CAST(rn AS INTEGER) AS rn FROM (SELECT tag_id, user_id, row_number() OVER (PARTITION BY tag_id ORDER BY user_id) AS rn FROM pairs) WHERE rn <= 5"
    ),
)
def top_users(spark: SparkSession, sf: str) -> DataFrame:
    return search.top_users_per_tag(b.pairs(spark, sf), 5)


# ---------------------------------------------------------------- portraits


@query("Q9_portrait", b.sql("SELECT user_id, paths.* FROM pairs JOIN paths USING (tag_id)"))
def portrait(spark: SparkSession, sf: str) -> DataFrame:
    return search.portrait(b.pairs(spark, sf), b.tags(spark, sf))


_TREE = b.sql(
    f"""WITH flat AS (SELECT user_id, paths.* FROM own JOIN paths USING (tag_id)),
    a4 AS (SELECT user_id, l1, l1_name, l2, l2_name, l3, l3_name, l4, l4_name, list({{'id': l5, 'name': l5_name}} ORDER BY l5) AS c
      FROM flat GROUP BY ALL),
    a3 AS (SELECT user_id, l1, l1_name, l2, l2_name, l3, l3_name, list({{'id': l4, 'name': l4_name, 'children': c}} ORDER BY l4) AS c
      FROM a4 GROUP BY user_id, l1, l1_name, l2, l2_name, l3, l3_name),
    a2 AS (SELECT user_id, l1, l1_name, l2, l2_name, list({{'id': l3, 'name': l3_name, 'children': c}} ORDER BY l3) AS c
      FROM a3 GROUP BY user_id, l1, l1_name, l2, l2_name),
    a1 AS (SELECT user_id, l1, l1_name, list({{'id': l2, 'name': l2_name, 'children': c}} ORDER BY l2) AS c
      FROM a2 GROUP BY user_id, l1, l1_name),
    a0 AS (SELECT user_id, CAST(to_json(list({{'id': l1, 'name': l1_name, 'children': c}} ORDER BY l1)) AS VARCHAR) AS tags
      FROM a1 GROUP BY user_id),
    met AS (SELECT user_id, 1 AS m FROM {_RICH} UNION ALL
      SELECT user_id, 2 FROM own WHERE tag_id IN (75, 134, 51) GROUP BY user_id HAVING count(*) = 3 UNION ALL
      SELECT user_id, 3 FROM own WHERE tag_id IN (50, 137, 130, 217, 160) GROUP BY user_id HAVING count(*) = 5 UNION ALL
      SELECT user_id, 4 FROM own WHERE tag_id = 55)
    SELECT a0.user_id, tags, (SELECT string_agg(m, ',' ORDER BY m) FROM met WHERE met.user_id = a0.user_id) AS merge_tags FROM a0"""
)


@query("Q9_portrait_tree", _TREE)
def portrait_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Nested portraits with composite tags; as text, one row per user."""
    flat = search.portrait(profile.explode_profile(b.profile(spark, sf)), b.tags(spark, sf))
    merges = composite.eval_merge_tags(b.profile(spark, sf), seeds.COMPOSITES)
    tree = search.portrait_tree(flat, merges=merges)
    return tree.select("user_id", F.to_json("tags").alias("tags"), F.array_join(F.col("merge_tags").cast("array<string>"), ",").alias("merge_tags"))


_EDGES = """(SELECT DISTINCT depth, source_id, source, target_id, target, category FROM (
  SELECT 0 AS depth, 0 AS source_id, 'user' AS source, l1 AS target_id, l1_name AS target, l1_name AS category FROM seen UNION ALL
  SELECT 1, l1, l1_name, l2, l2_name, l1_name FROM seen UNION ALL SELECT 2, l2, l2_name, l3, l3_name, l1_name FROM seen UNION ALL
  SELECT 3, l3, l3_name, l4, l4_name, l1_name FROM seen UNION ALL SELECT 4, l4, l4_name, l5, l5_name, l1_name FROM seen))"""


@query(
    "Q10_portrait_graph",
    b.sql(
        f"""SELECT e.*, coalesce(n, 0) AS children FROM {_EDGES.replace('seen', '(SELECT paths.* FROM pairs JOIN paths USING (tag_id))')} e
        LEFT JOIN (SELECT source_id AS s, count(*) AS n FROM {_EDGES.replace('seen', '(SELECT paths.* FROM pairs JOIN paths USING (tag_id))')} GROUP BY 1) ON e.target_id = s"""
    ),
)
def portrait_graph(spark: SparkSession, sf: str) -> DataFrame:
    """The graph of every tag somebody holds."""
    held = b.pairs(spark, sf).select("tag_id").distinct()
    return search.portrait_graph(catalog.leaf_paths(b.tags(spark, sf)).join(held, "tag_id", "left_semi"))


# A tree that lost two inner tags: below the one paths begin at level 4, below the other at level 5.
_LOST = (4, 46)
_BROKEN = f"""(SELECT a.id AS tag_id, e.id AS l1, e.name AS l1_name, d.id AS l2, d.name AS l2_name, c.id AS l3, c.name AS l3_name,
  p.id AS l4, p.name AS l4_name, a.id AS l5, a.name AS l5_name FROM tags a LEFT JOIN tags p ON a.pid = p.id AND p.id NOT IN {_LOST}
  LEFT JOIN tags c ON p.pid = c.id AND c.id NOT IN {_LOST} LEFT JOIN tags d ON c.pid = d.id LEFT JOIN tags e ON d.pid = e.id
  WHERE a.level = 5 AND a.id IN (SELECT tag_id FROM own))"""


def _broken(spark: SparkSession, sf: str) -> DataFrame:
    return b.tags(spark, sf).where(~F.col("id").isin(*_LOST))


@query(
    "Q9_portrait_broken_tree",
    b.sql(
        f"""SELECT user_id, root_id, root, count(DISTINCT node) AS nodes FROM (
        SELECT user_id, coalesce(l1, l2, l3, l4, l5) AS root_id, coalesce(l1_name, l2_name, l3_name, l4_name, l5_name) AS root,
          unnest([l1, l2, l3, l4, l5]) AS node FROM own JOIN {_BROKEN} broken USING (tag_id)) GROUP BY ALL"""
    ),
)
def portrait_broken_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Where every path of a user begins, and how many tags hang there."""
    flat = search.portrait(profile.explode_profile(b.profile(spark, sf)), _broken(spark, sf))
    roots = search.portrait_tree(flat).select("user_id", F.explode("tags").alias("n"))
    return roots.select(
        "user_id",
        F.col("n.id").alias("root_id"),
        F.col("n.name").alias("root"),
        F.regexp_count(F.to_json("n"), F.lit('"id":')).cast("long").alias("nodes"),
    )


_BROKEN_EDGES = f"""(SELECT DISTINCT * FROM (
  SELECT 0 AS depth, 0 AS source_id, 'user' AS source, l1 AS target_id, l1_name AS target, l1_name AS category FROM {_BROKEN} x WHERE l1 IS NOT NULL UNION ALL
  SELECT 1, coalesce(l1, 0), coalesce(l1_name, 'user'), l2, l2_name, coalesce(l1_name, l2_name) FROM {_BROKEN} x WHERE l2 IS NOT NULL UNION ALL
  SELECT 2, coalesce(l2, 0), coalesce(l2_name, 'user'), l3, l3_name, coalesce(l1_name, l2_name, l3_name) FROM {_BROKEN} x WHERE l3 IS NOT NULL UNION ALL
  SELECT 3, coalesce(l3, 0), coalesce(l3_name, 'user'), l4, l4_name, coalesce(l1_name, l2_name, l3_name, l4_name) FROM {_BROKEN} x WHERE l4 IS NOT NULL UNION ALL
  SELECT 4, coalesce(l4, 0), coalesce(l4_name, 'user'), l5, l5_name, coalesce(l1_name, l2_name, l3_name, l4_name, l5_name) FROM {_BROKEN} x))"""


@query(
    "Q10_portrait_broken_graph",
    b.sql(
        f"""SELECT e.*, coalesce(n, 0) AS children FROM {_BROKEN_EDGES} e
        LEFT JOIN (SELECT source_id AS s, count(*) AS n FROM {_BROKEN_EDGES} y GROUP BY 1) ON e.target_id = s"""
    ),
)
def portrait_broken_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Partial paths hang on the root, each with its own highest known tag."""
    held = profile.explode_profile(b.profile(spark, sf)).select("tag_id").distinct()
    return search.portrait_graph(catalog.leaf_paths(_broken(spark, sf)).join(held, "tag_id", "left_semi"))


_ASKED = """(SELECT DISTINCT CASE order_sn % 5 WHEN 0 THEN '13' || lpad(CAST(member_id AS VARCHAR), 9, '0')
  WHEN 1 THEN 'c' || CAST(member_id AS VARCHAR) || '@mail.example.com' WHEN 2 THEN CAST(member_id + 10000 AS VARCHAR)
  WHEN 3 THEN '1101' || lpad(CAST(member_id AS VARCHAR), 13, '0') || 'X' ELSE 'nobody' END AS num, order_sn % 5 AS k FROM ord)"""


@query(
    "Q11_lookup_users",
    b.sql(
        f"""SELECT num, CASE k WHEN 0 THEN 'mobile' WHEN 1 THEN 'email' WHEN 2 THEN 'qq' ELSE 'id_card' END AS kind, id AS user_id
        FROM {_ASKED} JOIN u ON num = CASE k WHEN 0 THEN mobile WHEN 1 THEN email WHEN 2 THEN qq WHEN 3 THEN id_card END"""
    ),
)
def lookup(spark: SparkSession, sf: str) -> DataFrame:
    return search.lookup_users(asked_numbers(spark, sf), b.users(spark, sf))


def asked_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """One number per order, of a kind that depends on the order."""
    k, key = F.col("order_sn") % 5, F.col("member_id").cast("string")
    num = (
        F.when(k == 0, F.concat(F.lit("13"), F.lpad(key, 9, "0")))
        .when(k == 1, F.concat(F.lit("c"), key, F.lit("@mail.example.com")))
        .when(k == 2, (F.col("member_id") + 10000).cast("string"))
        .when(k == 3, F.concat(F.lit("1101"), F.lpad(key, 13, "0"), F.lit("X")))
        .otherwise("nobody")
    )
    return b.orders(spark, sf).select(num.alias("num"))


@query(
    "Q12_mask",
    b.sql(
        """SELECT id, left(name, 1) || '**' AS name, left(id_card, 3) || repeat('*', 12) || right(id_card, 3) AS id_card,
        CASE WHEN length(qq) < 6 THEN qq ELSE left(qq, 3) || repeat('*', length(qq) - 6) || right(qq, 3) END AS qq,
        coalesce(education, '') AS education FROM u"""
    ),
)
def masked(spark: SparkSession, sf: str) -> DataFrame:
    return b.users(spark, sf).select(
        "id",
        mask_name(F.col("name")).alias("name"),
        mask(F.col("id_card")).alias("id_card"),
        mask(F.col("qq")).alias("qq"),
        mask(F.col("education")).alias("education"),
    )


# ---------------------------------------------------------------- composite tags


@query("C1_parse_conditions", b.sql("SELECT merge_tag_id, seq, basic_tag_id, connector FROM members"))
def parse_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return composite.parse_conditions(b.merge_tags(spark, sf), "id", "condition").withColumnRenamed("id", "merge_tag_id")


@query(
    "C2_eval_merge_tags",
    b.sql(
        f"""SELECT user_id, CAST(1 AS BIGINT) AS merge_tag_id FROM {_RICH} UNION ALL
        SELECT user_id, 2 FROM own WHERE tag_id IN (75, 134, 51) GROUP BY user_id HAVING count(*) = 3 UNION ALL
        SELECT user_id, 3 FROM own WHERE tag_id IN (50, 137, 130, 217, 160) GROUP BY user_id HAVING count(*) = 5 UNION ALL
        SELECT user_id, 4 FROM own WHERE tag_id = 55"""
    ),
)
def eval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return composite.eval_merge_tags(b.profile(spark, sf), seeds.COMPOSITES)


_PER_PRODUCT = b.sql(
    f"""SELECT DISTINCT x.user_id, p_partkey + 1 AS merge_tag_id FROM part
    JOIN bought x ON x.tag_id IN (p_partkey + {b.GOODS_BASE}, p_partkey + {b.GOODS_BASE + 1})
    JOIN bought y ON y.user_id = x.user_id AND y.tag_id = p_partkey + {b.GOODS_BASE + 2}"""
)


@query("C2_eval_merge_texts", _PER_PRODUCT)
def eval_merge_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A rule text per product over everything that members bought."""
    return composite.eval_merge_texts(b.purchases(spark, sf), b.merge_tags(spark, sf), "id")


@query("C2_eval_merge_table", _PER_PRODUCT)
def eval_merge_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same rules as member rows."""
    return composite.eval_merge_table(b.purchases(spark, sf), b.merge_members(spark, sf))


@query(
    "C3_merge_tag_user_count",
    b.sql(
        f"""SELECT CAST(1 AS BIGINT) AS tag_id, 2 AS tag_type, count(*) AS user_count FROM {_RICH} HAVING count(*) > 0 UNION ALL
        SELECT 2, 2, count(*) FROM (SELECT user_id FROM own WHERE tag_id IN (75, 134, 51) GROUP BY user_id HAVING count(*) = 3) HAVING count(*) > 0 UNION ALL
        SELECT 4, 2, count(*) FROM own WHERE tag_id = 55 HAVING count(*) > 0"""
    ),
)
def merge_count(spark: SparkSession, sf: str) -> DataFrame:
    return composite.merge_tag_user_count(composite.eval_merge_tags(b.profile(spark, sf), seeds.COMPOSITES))
