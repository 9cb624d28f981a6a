"""The whole catalogue in one profile, and what keeps questions over it cheap at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from suite import catalogue as tree
from suite import profiles, scoring, tagging
from tagloom import seeds
from tagloom.functions.columns import units
from tagloom.operators import accounts, bitmaps, composite, intervals, labels, pages, profile, search
from tagloom.plans import catalogue
from tagloom.session import shared_dir, small_table, tune

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


# ---------------------------------------------------------------- the catalogue

# Where every measured tag has its rows: (source, fields, measure, further line).
_MEASURED = {
    8: ("users", "id,gender", "text(gender)", ""),
    9: ("users", "id,birthday", "day(birthday)", ""),
    10: ("users", "id,height", "number(height)", ""),
    11: ("users", "id,ethnicity", "text(ethnicity)", ""),
    12: ("users", "id,native_place", "text(native_place)", ""),
    13: ("users", "id,political", "text(political)", ""),
    14: ("users", "id,job", "text(job)", ""),
    15: ("users", "id,marriage", "text(marriage)", ""),
    16: ("users", "id,education", "text(education)", ""),
    17: ("users", "id,employment", "text(employment)", ""),
    18: ("users", "id,birthday", "sign(birthday)", ""),
    19: ("users", "id,district", "text(district)", ""),
    20: ("users", "id,nationality", "text(nationality)", ""),
    46: ("users", "id,property", "text(property)", ""),
    47: ("users", "id,property_value", "number(property_value)", ""),
    48: ("users", "id,car", "text(car)", ""),
    49: ("users", "id,car_value", "number(car_value)", ""),
    21: ("orders", "member_id,pay_time", "days_since(pay_time)", f"asOf={b.AS_OF_ORDERS}"),
    22: ("orders", "member_id,amount", "total(amount)", ""),
    23: ("orders", "member_id,amount", "average(amount)", ""),
    24: ("orders", "member_id,payment_code", "mode(payment_code)", ""),
    25: ("orders", "member_id,amount", "largest(amount)", ""),
    233: ("priced", "member_id,paid,coupon", "sensitivity(paid,coupon)", ""),
    33: ("logs", "user_id,log_time", "days_since(log_time)", f"asOf={b.AS_OF_LOGS}"),
    34: ("logs", "user_id,page", "mode(page)", ""),
    35: ("logs", "user_id,log_time", "visits(log_time,21600)", ""),
    38: ("logs", "user_id,user_agent", "device(user_agent)", ""),
    39: ("logs", "user_id,log_time", "hour(log_time)", ""),
    239: ("daily", "user_id,log_time,url", "activity(log_time,url)", f"asOf={b.AS_OF_LOGS}"),
    29: ("lines#orders", "order_sn,paid,receivable#member_id,order_sn", "ratio(paid,receivable)", ""),
    30: ("lines#orders", "order_sn,coupon_type#member_id,order_sn", "mode(coupon_type)", ""),
    44: ("lines#orders", "order_sn,category#member_id,order_sn", "mode(category)", ""),
    45: ("lines#orders", "order_sn,brand#member_id,order_sn", "mode(brand)", ""),
    244: ("goods#orders", "goods_order,colour,kind#member_id,order_sn", "vote(colour,kind)", ""),
}


def _rule_text(source: str, fields: str, measure: str, more: str) -> str:
    tables = "#".join(f"catalogue_{s}" for s in source.split("#"))
    return f"inType=hive\ndbTable={tables}\nselectFieldNames={fields}\nmeasure={measure}\n{more}"


def catalogue_tags(spark: SparkSession, ids: list[int] | None = None) -> DataFrame:
    """The seeded tag table with a rule text for every tag that can be measured."""
    rows = []
    for tag, name, level, pid, order, state in b.tree_rows():
        rule = name if level == 5 else _rule_text(*_MEASURED[tag]) if tag in _MEASURED else None
        if ids is None or tag in ids or pid in ids:
            rows.append((tag, name, level, pid, order, state, rule))
    return small_table(tune(spark), rows, "id bigint, name string, level int, pid bigint, `order` int, state int, rule string")


def sources(spark: SparkSession, sf: str) -> None:
    """The tables that the rule texts name."""
    lines = b.table(spark, sf, "lineitem")
    # texts are made once per product, not once per line
    part = b.table(spark, sf, "part").select(
        "p_partkey",
        b.pick(b.texts(seeds.CATEGORY), F.col("p_size") % 11).alias("category"),
        b.pick(b.texts(seeds.BRAND), F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 6).alias("brand"),
    )
    full, off = units(F.col("l_extendedprice")), units(F.col("l_discount")) * (1 + F.col("l_orderkey") % 9)
    flag = F.col("l_returnflag")
    detailed = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_sn"),
        (full * 100 / F.lit(10000.0)).alias("receivable"),
        (full * (100 - off) / F.lit(10000.0)).alias("paid"),
        F.when(flag == "A", "折扣券").when(flag == "N", "活动券").when(flag == "R", "积分换购").alias("coupon_type"),
        "category",
        "brand",
    )
    logs = b.logs(spark, sf)
    named = {
        "users": b.users(spark, sf),
        "orders": b.orders(spark, sf).withColumn("amount", F.floor(F.col("amount") / 50).cast("double")),
        "priced": b.priced_orders(spark, sf).withColumnRenamed("amount", "paid"),
        "logs": logs,
        "daily": logs.withColumn("user_id", F.col("user_id") * 100 + F.dayofmonth("log_time")),
        "lines": detailed,
        "goods": b.goods(spark, sf),
    }
    for name, df in named.items():
        df.createOrReplaceTempView(f"catalogue_{name}")


def _own_sql() -> str:
    """Tags that a user row carries, as (user, tag) rows."""
    rules = {
        "gender": seeds.GENDER, "ethnicity": seeds.ETHNICITY, "native_place": seeds.NATIVE_PLACE, "political": seeds.POLITICAL,
        "job": seeds.JOB, "marriage": seeds.MARRIAGE, "education": seeds.EDUCATION, "employment": seeds.EMPLOYMENT,
        "district": seeds.DISTRICT, "nationality": seeds.NATIONALITY, "property": seeds.PROPERTY, "car": seeds.CAR,
    }
    arms = [b.sql_match(c, r) for c, r in rules.items()] + [b.AGE_SQL]
    return b.sql(" UNION ALL ".join(f"SELECT id AS user_id, {arm} AS tag_id FROM u" for arm in arms))


_PARTS = [
    ("G1_height", "id", "tag_id"), ("G3_zodiac", "id", "tag_id"), ("G12_property_and_car_value", "id", "property_tag"),
    ("G12_property_and_car_value", "id", "car_tag"), ("T2_purchase_cycle", "member_id", "tag_id"),
    ("G5_spending_band", "member_id", "tag_id"), ("G4_order_value", "member_id", "avg_tag"),
    ("T3_most_used_payment", "member_id", "tag_id"), ("G4_order_value", "member_id", "max_tag"),
    ("A8_psm_band", "member_id", "tag_id"), ("G7_last_login", "user_id", "tag_id"), ("G8_page_type", "user_id", "tag_id"),
    ("G9_visit_duration", "user_id", "tag_id"), ("G8_device", "user_id", "tag_id"), ("G10_browsing_hours", "user_id", "tag_id"),
    ("G13_activity_band", "user_id", "tag_id"), ("G6_discount_depth", "member_id", "tag_id"),
    ("G11_coupon_type", "member_id", "tag_id"), ("G11_category_preference", "member_id", "tag_id"),
    ("G11_brand_preference", "member_id", "tag_id"), ("A23_shop_gender_vote", "member_id", "tag_id"),
]
_SQL = {**tagging.QUERIES, **scoring.QUERIES}
_EVERY_TAG = f"SELECT user_id, tag_id FROM ({_own_sql()})" + "".join(
    f" UNION ALL SELECT {user}, {tag} FROM ({_SQL[name][1]})" for name, user, tag in _PARTS
)


@query(
    "S4_catalogue_profile",
    f"""SELECT user_id, array_to_string(list_sort(list(DISTINCT tag_id)), ',') AS tag_ids
    FROM ({_EVERY_TAG}) WHERE tag_id IS NOT NULL GROUP BY user_id""",
)
def catalogue_profile(spark: SparkSession, sf: str) -> DataFrame:
    """All measured tags of the catalogue from their stored rule texts into one profile version."""
    sources(spark, sf)
    root = shared_dir(spark, "catalogue")
    stored = catalogue.tag_catalogue(spark, catalogue_tags(spark), b.AS_OF_ORDERS, root, 1)
    merged = spark.read.parquet(stored)
    return profiles.as_text(merged.withColumn("tag_ids", F.sort_array("tag_ids")))


@query("S4_two_source_rule", f"SELECT member_id AS user_id, tag_id FROM ({_SQL['A23_shop_gender_vote'][1]})")
def two_source_rule(spark: SparkSession, sf: str) -> DataFrame:
    """The vote over goods, which know the order, and orders, which know the member."""
    sources(spark, sf)
    return catalogue.run_catalogue(spark, catalogue_tags(spark, [244]), b.AS_OF_ORDERS)


# Q9 and P3 over statistic, score, vote and product tags beside the user's own.
_SHOWN = [8, 9, 18, 22, 24, 33, 38, 45, 233, 244]
_TAGS_OF = ", ".join(f"min(tag_id) FILTER (tags.pid = {p}) AS tag_{p}" for p in _SHOWN)


@query(
    "P3_pivot_catalogue",
    b.sql(
        f"""SELECT user_id, {_TAGS_OF} FROM tags JOIN (SELECT DISTINCT user_id, tag_id FROM ({_EVERY_TAG})
        WHERE tag_id IS NOT NULL) every_tag ON tag_id = tags.id WHERE tags.pid IN {tuple(_SHOWN)} GROUP BY user_id"""
    ),
)
def pivot_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    sources(spark, sf)
    pairs = catalogue.run_catalogue(spark, catalogue_tags(spark), b.AS_OF_ORDERS)
    return profile.pivot_lists(profile.collapse_profile(pairs), catalogue_tags(spark), _SHOWN)


# ---------------------------------------------------------------- bands as a table


@query(
    "T0_interval_table",
    """WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS id, floor(l_extendedprice) AS v FROM lineitem),
    r AS (SELECT o_orderkey AS tag_id, floor(o_totalprice / 3) AS lo, floor(o_totalprice / 3) + o_orderkey % 40 AS hi,
      CASE WHEN o_custkey % 7 > 0 THEN o_custkey % 7 END AS place FROM orders),
    hit AS (SELECT id, v, arg_min(tag_id, (place IS NOT NULL, coalesce(place, 0), tag_id)) AS tag_id
      FROM v JOIN r ON v BETWEEN r.lo AND r.hi GROUP BY id, v)
    SELECT v.id, hit.tag_id FROM v LEFT JOIN hit USING (id, v)""",
)
def interval_table(spark: SparkSession, sf: str) -> DataFrame:
    """A band per order, many of them overlapping, over the prices of all order lines."""
    lo = F.floor(F.col("o_totalprice") / 3)
    place = F.col("o_custkey") % 7
    rules = b.table(spark, sf, "orders").select(
        F.concat(lo.cast("string"), F.lit("-"), (lo + F.col("o_orderkey") % 40).cast("string")).alias("rule"),
        F.col("o_orderkey").alias("tag_id"),
        F.when(place > 0, place).alias("order"),
    )
    values = b.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.floor("l_extendedprice").cast("double").alias("v")
    )
    return intervals.interval_tag(values, "id", "v", intervals.band_table(rules))


# ---------------------------------------------------------------- bitmaps


def _maps(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.tag_bitmaps(b.profile(spark, sf))


@query("Q1_users_by_tags_any_bitmap", b.sql("SELECT DISTINCT user_id FROM own WHERE tag_id IN (50, 97, 98)"))
def any_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.members(bitmaps.any_of(_maps(spark, sf), [50, 97, 98]))


@query(
    "Q2_users_by_tags_all_bitmap",
    b.sql("SELECT user_id FROM own WHERE tag_id IN (51, 83, 214) GROUP BY user_id HAVING count(*) = 3"),
)
def all_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.members(bitmaps.all_of(_maps(spark, sf), [51, 83, 214]))


@query("Q4_count_users_bitmap", profiles.QUERIES["Q4_count_users_by_tags"][1])
def count_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.count_users(bitmaps.all_of(_maps(spark, sf), [51, 214]))


@query("Q5_tag_user_count_bitmap", profiles.QUERIES["Q5_tag_user_count"][1])
def counts_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.tag_counts(_maps(spark, sf))


@query("C2_eval_merge_bitmap", profiles.QUERIES["C2_eval_merge_tags"][1])
def merge_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.members(bitmaps.eval_merge_bitmaps(_maps(spark, sf), seeds.COMPOSITES))


@query("C2_eval_merge_texts_bitmap", profiles.QUERIES["C2_eval_merge_texts"][1])
def merge_texts_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """A rule text per product over everything that members bought."""
    bought = b.purchases(spark, sf).select("user_id", F.array("tag_id").alias("tag_ids"))
    groups = composite.condition_groups(b.merge_tags(spark, sf), "id")
    return bitmaps.members(bitmaps.composite_bitmaps(bitmaps.tag_bitmaps(bought), groups))


@query("C3_merge_tag_user_count_bitmap", profiles.QUERIES["C3_merge_tag_user_count"][1])
def merge_count_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    met = bitmaps.eval_merge_bitmaps(_maps(spark, sf), seeds.COMPOSITES)
    return bitmaps.tag_counts(met.withColumnRenamed("merge_tag_id", "tag_id"), 2)


# ---------------------------------------------------------------- pages


@query(
    "Q1_page_index",
    b.sql("SELECT DISTINCT user_id FROM own WHERE tag_id IN (50, 51) ORDER BY user_id LIMIT 10 OFFSET 80"),
)
def users_page_index(spark: SparkSession, sf: str) -> DataFrame:
    """Page 9 of the users of a tag, from where it is."""
    found = search.users_by_tags_any(b.profile(spark, sf), b.tags(spark, sf), [8])
    index = pages.write_pages(found, shared_dir(spark, "pages"), ["user_id"], 8)
    return pages.read_page(spark, index, 9, 10)


@query(
    "Q18_page_index",
    b.sql(
        f"SELECT * REPLACE (CAST(ctime AS VARCHAR) AS ctime) FROM {tree._AUDIT} a ORDER BY a.ctime DESC, type, tag_id, id NULLS FIRST LIMIT 30 OFFSET 90"
    ),
)
def audit_page_index(spark: SparkSession, sf: str) -> DataFrame:
    """Page 4 of the audit list."""
    order = [("ctime", True), "type", "tag_id", "id"]
    index = pages.write_pages(tree._audit(spark, sf), shared_dir(spark, "pages"), order, 8)
    return pages.read_page(spark, index, 4, 30).withColumn("ctime", F.col("ctime").cast("string"))


# ---------------------------------------------------------------- labels of the tree


@query("Q14_leaf_tags_labels", tree.QUERIES["Q14_leaf_tags"][1])
def leaf_tags_labels(spark: SparkSession, sf: str) -> DataFrame:
    tags = b.tags(spark, sf)
    found, _ = labels.tree_labels(tags)
    leaves = tags.where("level = 5").select(F.col("id").alias("tag_id"))
    return leaves.join(labels.at_or_below(found, [5, 8, 97]).select("id"), F.col("tag_id") == F.col("id"), "left_semi")


# A forest over the products: chains of 50, which end in a pair that points at each other
# where the number is a multiple of 500, and in a child of product 1 elsewhere.
_UP = "CASE WHEN p_partkey % 500 = 0 THEN p_partkey + 1 WHEN p_partkey % 50 = 0 THEN 1 WHEN p_partkey = 1 THEN -1 ELSE p_partkey - 1 END"


@query(
    "Q15_deep_tree_labels",
    f"""WITH RECURSIVE t AS (SELECT p_partkey AS id, {_UP} AS pid FROM part),
    c AS (SELECT id, id AS top, pid, 1 AS n FROM t UNION ALL SELECT c.id, t.id, t.pid, n + 1 FROM c JOIN t ON c.pid = t.id WHERE n < 200),
    rooted AS (SELECT id, max(n) AS depth FROM c GROUP BY id HAVING bool_or(pid NOT IN (SELECT id FROM t)))
    SELECT t.id, CAST(depth AS BIGINT) AS depth, CAST(count(c.id) AS BIGINT) AS below FROM t JOIN rooted ON t.id = rooted.id
    JOIN c ON c.top = t.id GROUP BY ALL UNION ALL SELECT id, NULL, NULL FROM t WHERE id NOT IN (SELECT id FROM rooted)""",
)
def deep_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Depth and size of every tag of a forest with long chains; tags without a root are shown without them."""
    p = b.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.expr(_UP).cast("bigint").alias("pid"))
    found, lost = labels.tree_labels(p)
    out = found.select("id", "depth", (F.col("last") - F.col("first") + 1).alias("below"))
    return out.unionByName(lost, allowMissingColumns=True)


# ---------------------------------------------------------------- counts kept by difference

# Version k holds some users, and of their tags some, in a pattern that moves with k.
_KEPT = "(user_id * 7 + k) % 5 < 3 AND (tag_id + user_id + k * 3) % 4 > 0"


@query(
    "Q5_counts_by_difference",
    b.sql(f"SELECT tag_id, 1 AS tag_type, count(*) AS user_count FROM (SELECT *, 5 AS k FROM own) WHERE {_KEPT} GROUP BY tag_id"),
)
def counts_by_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Counted once, then carried through four more versions by what changed."""
    whole = b.profile(spark, sf)

    def version(k: int) -> DataFrame:
        stays = F.filter("tag_ids", lambda t: (t + F.col("user_id") + k * 3) % 4 > 0)
        return whole.where((F.col("user_id") * 7 + k) % 5 < 3).select("user_id", stays.alias("tag_ids"))

    counts = search.tag_user_count(version(1))
    for k in range(2, 6):
        counts = search.updated_counts(counts, search.tag_count_changes(version(k - 1), version(k)))
    return counts


# ---------------------------------------------------------------- accounts by bucket


@query("Q11_account_index", profiles.QUERIES["Q11_lookup_users"][1])
def account_index(spark: SparkSession, sf: str) -> DataFrame:
    """The numbers of all orders, from an index over the accounts of all users."""
    index = accounts.write_accounts(b.users(spark, sf), shared_dir(spark, "accounts"), buckets=32)
    return accounts.find_accounts(spark, index, profiles.asked_numbers(spark, sf))
