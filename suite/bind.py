"""The driver's tables seen as the source tables of the tag jobs.

Every function has a twin in ``CTE``: the same derivation as SQL text. ``sql``
puts the fragments a query needs in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.functions.columns import units
from tagloom.plans.jobs import DAY, RANGE, TagJob, run_pairs, run_profile
from tagloom.session import small_table, tune
from tagloom.specs import Rule

AS_OF_ORDERS = "2001-08-10"
AS_OF_LOGS = "2024-02-01"
GOODS_BASE = 100_000  # tag id of product p is this plus its key

JOBS = {"AUTOMOBILE": "1", "BUILDING": "2", "FURNITURE": "3", "HOUSEHOLD": "4", "MACHINERY": "5"}
PAYMENTS = {"1": "alipay", "2": "wxpay", "3": "chinapay", "4": "cod"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """Value at a position from 0; null behind the end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def texts(rules: list[Rule]) -> list[str]:
    return [r.text for r in rules]


def users(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    key = c.cast("string")
    return table(spark, sf, "customer").select(
        c.alias("id"),
        F.col("c_name").alias("name"),
        (c % 3).cast("string").alias("gender"),
        F.element_at(F.create_map(*[F.lit(x) for p in JOBS.items() for x in p]), F.col("c_mktsegment")).alias("job"),
        (1 + c % 4).cast("string").alias("political"),
        (1 + (c * 7) % 4).cast("string").alias("marriage"),
        pick(texts(seeds.NATIONALITY), F.col("c_nationkey") % 6).alias("nationality"),
        F.date_add(F.to_date(F.lit("1950-01-01")), ((c * 97) % 29000).cast("int")).alias("birthdate"),
        pick(texts(seeds.EDUCATION), c % 9).alias("education"),
        pick(texts(seeds.NATIVE_PLACE), (c * 5) % 7).alias("native_place"),
        pick(texts(seeds.PROPERTY), (c * 11) % 5).alias("property"),
        pick(texts(seeds.CAR), (c * 13) % 4).alias("car"),
        (c % 9).cast("string").alias("ethnicity"),
        pick(texts(seeds.EMPLOYMENT), (c * 3) % 5).alias("employment"),
        pick(texts(seeds.DISTRICT), (c * 17) % 8).alias("district"),
        (150 + c % 95).alias("height"),
        F.floor(F.col("c_acctbal") * 6).alias("spend"),
        F.floor(F.col("c_acctbal") * 700).alias("property_value"),
        F.floor(F.col("c_acctbal") * 150).alias("car_value"),
        F.concat(F.lit("13"), F.lpad(key, 9, "0")).alias("mobile"),
        F.concat(F.lit("c"), key, F.lit("@mail.example.com")).alias("email"),
        (c + 10000).cast("string").alias("qq"),
        F.concat(F.lit("1101"), F.lpad(key, 13, "0"), F.lit("X")).alias("id_card"),
    ).withColumn("birthday", F.date_format("birthdate", "yyyy-MM-dd"))


def orders(spark: SparkSession, sf: str) -> DataFrame:
    code = F.create_map(*[F.lit(x) for p in PAYMENTS.items() for x in p])
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderkey").alias("order_sn"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("pay_time"),
        F.coalesce(F.element_at(code, F.substring("o_orderpriority", 1, 1)), F.lit("other")).alias("payment_code"),
    )


def priced_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the coupon value of their lines. Every third order and every
    seventh member go without, so that some users have no discount at all."""
    lines = table(spark, sf, "lineitem")
    coupons = lines.groupBy(F.col("l_orderkey").alias("order_sn")).agg(
        F.sum(units(F.col("l_extendedprice")) * units(F.col("l_discount"))).alias("_c")
    )
    free = (F.col("order_sn") % 3 == 0) | (F.col("member_id") % 7 == 0)
    value = F.when(free, 0.0).otherwise(F.coalesce("_c", F.lit(0)) / F.lit(10000.0))
    return orders(spark, sf).join(coupons, "order_sn", "left").withColumn("coupon", value).drop("_c")


def logs(spark: SparkSession, sf: str) -> DataFrame:
    agents = [
        "Mozilla/5.0 (Windows NT 10.0; Win64)",
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15)",
        "Mozilla/5.0 (X11; Linux x86_64)",
        "Mozilla/5.0 (Linux; Android 13; SM-S901B)",
        "Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X)",
        "curl/8.1",
    ]
    pages = {"signup": "登录页", "view": "首页", "click": "商品页", "purchase": "我的订单页"}
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        F.col("user_id"),
        F.col("ts").alias("log_time"),
        F.col("props").alias("url"),
        F.element_at(F.create_map(*[F.lit(x) for p in pages.items() for x in p]), F.col("event_type")).alias("page"),
        pick(agents, (e * 7 + F.col("user_id")) % 6).alias("user_agent"),
    )


def goods(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered goods with a colour and a product type; some have an unknown one."""
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.coalesce(
            pick(list(seeds.COLOURS), F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") - 1), F.lit("other")
        ).alias("colour"),
        F.coalesce(
            pick(list(seeds.PRODUCT_TYPES), (F.col("p_partkey") * 7 + F.col("p_size")) % 31), F.lit("other")
        ).alias("kind"),
    )
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("goods_order"), "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select("goods_order", "colour", "kind")


# Tags that a user row carries by itself.
USER_JOBS = [
    TagJob("gender", "gender", tuple(seeds.GENDER)),
    TagJob("job", "job", tuple(seeds.JOB)),
    TagJob("political", "political", tuple(seeds.POLITICAL)),
    TagJob("marriage", "marriage", tuple(seeds.MARRIAGE)),
    TagJob("nationality", "nationality", tuple(seeds.NATIONALITY)),
    TagJob("education", "education", tuple(seeds.EDUCATION)),
    TagJob("native_place", "native_place", tuple(seeds.NATIVE_PLACE)),
    TagJob("property", "property", tuple(seeds.PROPERTY)),
    TagJob("age", "birthday", tuple(seeds.AGE), DAY),
    TagJob("spending", "spend", tuple(seeds.SPENDING), RANGE),
]


def profile(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user with the sorted list of the user's own tags."""
    return run_profile(users(spark, sf), "id", USER_JOBS)


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Users and the product tags of the goods they ordered, once each."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    heads = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("user_id"), (F.col("l_partkey") + GOODS_BASE).alias("tag_id"))
        .distinct()
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """``(user_id, tag_id)``: own tags and product tags."""
    own = run_pairs(users(spark, sf), "id", USER_JOBS)
    return own.unionByName(purchases(spark, sf))


def tree_rows() -> list[tuple]:
    """Levels 1 to 4 and the level-5 rules, as plain rows."""
    parent = {tag: pid for tag, pid, _ in seeds.TREE}

    def level(tag: int) -> int:
        return 1 if parent[tag] == -1 else 1 + level(parent[tag])

    rows = [(tag, name, level(tag), pid, None, 4) for tag, pid, name in seeds.TREE]
    for pid, rules in seeds.RULES_BY_TAG.items():
        rows += [(r.tag_id, r.text, 5, pid, r.order, 3) for r in rules]
    return rows


def tags(spark: SparkSession, sf: str) -> DataFrame:
    """The tag tree: the seeded part and one tag per product below "purchased goods"."""
    seeded = small_table(
        tune(spark), tree_rows(), "id bigint, name string, level int, pid bigint, `order` int, state int"
    )
    p = F.col("p_partkey")
    product = table(spark, sf, "part").select(
        (p + GOODS_BASE).alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), p.cast("string")).alias("name"),
        F.lit(5).alias("level"),
        F.lit(42).cast("bigint").alias("pid"),
        F.lit(None).cast("int").alias("order"),
        F.when(p % 10 == 0, -1).otherwise(4).alias("state"),
    )
    both = seeded.unionByName(product)
    return both.select(
        "*",
        F.concat(F.lit("about "), F.col("name")).alias("business"),
        F.date_add(F.to_date(F.lit("2019-07-01")), (F.col("id") % 365).cast("int")).alias("ctime"),
    )


def merge_tags(spark: SparkSession, sf: str) -> DataFrame:
    """One composite tag per product: (this or the next product) and the one after."""
    p = F.col("p_partkey")
    t = (p + GOODS_BASE).cast("string")
    return table(spark, sf, "part").select(
        (p + 1).alias("id"),
        F.concat(F.lit("set "), F.col("p_brand")).alias("name"),
        F.concat(
            t, F.lit(" or "), (p + GOODS_BASE + 1).cast("string"), F.lit(" and "),
            (p + GOODS_BASE + 2).cast("string"), F.lit(" and"),
        ).alias("condition"),
        F.when(p % 8 == 0, 6).otherwise(4).alias("state"),
        F.date_add(F.to_date(F.lit("2019-07-04")), (p % 100).cast("int")).alias("ctime"),
    )


def merge_members(spark: SparkSession, sf: str) -> DataFrame:
    from tagloom.operators.composite import parse_conditions

    return parse_conditions(merge_tags(spark, sf), "id", "condition").withColumnRenamed("id", "merge_tag_id")


def grants(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Tags granted to users and to roles: a supplier manages the products it
    sold, a role (its nation) every product of one size."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    users_ = lines.select(
        F.col("l_suppkey").alias("user_id"), (F.col("l_partkey") + GOODS_BASE).alias("tag_id")
    )
    part = table(spark, sf, "part")
    roles = part.select(
        (F.col("p_size") % 25).cast("bigint").alias("role_id"),
        (F.col("p_partkey") + GOODS_BASE).alias("tag_id"),
        F.when(F.col("p_partkey") % 5 == 0, 2).otherwise(1).alias("tag_type"),
    )
    return users_, roles


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with versions: the state of each member's orders, one version per order."""
    o = table(spark, sf, "orders")
    named = F.array(
        F.struct(F.lit("status").alias("qualifier"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("priority").alias("qualifier"), F.col("o_orderpriority").alias("value")),
        F.struct(
            F.lit("clerk").alias("qualifier"),
            F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("clerk-"), (F.col("o_orderkey") % 50).cast("string"))).alias("value"),
        ),
    )
    return o.select(
        F.col("o_custkey").cast("string").alias("rowkey"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.explode(named).alias("c"),
    ).where("c.value is not null").select("rowkey", F.lit("detail").alias("family"), "c.qualifier", "c.value", "ts")


# ------------------------------------------------------------------ SQL twins


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def sql_match(column: str, rules: list[Rule]) -> str:
    arms = " ".join(f"WHEN {column} = {quoted(r.text)} THEN {r.tag_id}" for r in rules)
    return f"CAST(CASE {arms} END AS BIGINT)"


def sql_between(value: str, table_: list[tuple[float, float, int]], dtype: str = "BIGINT") -> str:
    arms = " ".join(f"WHEN {value} BETWEEN {lo} AND {hi} THEN {tag}" for lo, hi, tag in table_)
    return f"CAST(CASE {arms} END AS {dtype})"


AGE_SQL = "CAST(CASE WHEN year(birthdate) BETWEEN 1950 AND 2029 THEN 52 + (year(birthdate) - 1950) // 10 END AS BIGINT)"
SPEND_SQL = (
    "CAST(CASE WHEN spend BETWEEN 50000 AND 1000000 THEN 132 WHEN spend BETWEEN 40000 AND 49999 THEN 133"
    " WHEN spend BETWEEN 30000 AND 39999 THEN 134 WHEN spend BETWEEN 20000 AND 29999 THEN 135"
    " WHEN spend BETWEEN 10000 AND 19999 THEN 136 WHEN spend BETWEEN 1000 AND 9999 THEN 137"
    " WHEN spend BETWEEN 1 AND 999 THEN 138 END AS BIGINT)"
)

CTE: dict[str, tuple[str, str]] = {
    # name: (needed fragments, query)
    "u": (
        "",
        f"""SELECT c_custkey AS id, c_name AS name, CAST(c_custkey % 3 AS VARCHAR) AS gender,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3'
          WHEN 'HOUSEHOLD' THEN '4' WHEN 'MACHINERY' THEN '5' END AS job,
        CAST(1 + c_custkey % 4 AS VARCHAR) AS political, CAST(1 + (c_custkey * 7) % 4 AS VARCHAR) AS marriage,
        {sql_list(texts(seeds.NATIONALITY))}[c_nationkey % 6 + 1] AS nationality,
        DATE '1950-01-01' + CAST((c_custkey * 97) % 29000 AS INTEGER) AS birthdate,
        {sql_list(texts(seeds.EDUCATION))}[c_custkey % 9 + 1] AS education,
        {sql_list(texts(seeds.NATIVE_PLACE))}[(c_custkey * 5) % 7 + 1] AS native_place,
        {sql_list(texts(seeds.PROPERTY))}[(c_custkey * 11) % 5 + 1] AS property,
        {sql_list(texts(seeds.CAR))}[(c_custkey * 13) % 4 + 1] AS car,
        CAST(c_custkey % 9 AS VARCHAR) AS ethnicity,
        {sql_list(texts(seeds.EMPLOYMENT))}[(c_custkey * 3) % 5 + 1] AS employment,
        {sql_list(texts(seeds.DISTRICT))}[(c_custkey * 17) % 8 + 1] AS district,
        150 + c_custkey % 95 AS height, CAST(floor(c_acctbal * 6) AS BIGINT) AS spend,
        CAST(floor(c_acctbal * 700) AS BIGINT) AS property_value, CAST(floor(c_acctbal * 150) AS BIGINT) AS car_value,
        '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile,
        'c' || CAST(c_custkey AS VARCHAR) || '@mail.example.com' AS email,
        CAST(c_custkey + 10000 AS VARCHAR) AS qq,
        '1101' || lpad(CAST(c_custkey AS VARCHAR), 13, '0') || 'X' AS id_card,
        strftime(DATE '1950-01-01' + CAST((c_custkey * 97) % 29000 AS INTEGER), '%Y-%m-%d') AS birthday
        FROM customer""",
    ),
    "ord": (
        "",
        """SELECT o_custkey AS member_id, o_orderkey AS order_sn, o_totalprice AS amount,
        CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderdate AS pay_time,
        CASE o_orderpriority[1] WHEN '1' THEN 'alipay' WHEN '2' THEN 'wxpay' WHEN '3' THEN 'chinapay'
          WHEN '4' THEN 'cod' ELSE 'other' END AS payment_code FROM orders""",
    ),
    "priced": (
        "ord",
        """SELECT ord.*, CASE WHEN order_sn % 3 = 0 OR member_id % 7 = 0 THEN 0 ELSE coalesce(c.v, 0) END AS coupon4
        FROM ord LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)
          * CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY l_orderkey) c
        ON ord.order_sn = c.l_orderkey""",
    ),
    "logs": (
        "",
        """SELECT user_id, ts AS log_time, props AS url,
        CASE event_type WHEN 'signup' THEN '登录页' WHEN 'view' THEN '首页' WHEN 'click' THEN '商品页'
          WHEN 'purchase' THEN '我的订单页' END AS page,
        ['Windows', 'Mac', 'Linux', 'Android', 'IOS'][(event_id * 7 + user_id) % 6 + 1] AS device FROM events""",
    ),
    "goods": (
        "",
        f"""SELECT l_orderkey AS goods_order,
        coalesce({sql_list(list(seeds.COLOURS))}[CAST(replace(p_brand, 'Brand#', '') AS INTEGER)], 'other') AS colour,
        coalesce({sql_list(list(seeds.PRODUCT_TYPES))}[(p_partkey * 7 + p_size) % 31 + 1], 'other') AS kind
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "own": (
        "u",
        "SELECT DISTINCT user_id, tag_id FROM ("
        + " UNION ALL ".join(
            f"SELECT id AS user_id, {arm} AS tag_id FROM u"
            for arm in [
                sql_match("gender", seeds.GENDER),
                sql_match("job", seeds.JOB),
                sql_match("political", seeds.POLITICAL),
                sql_match("marriage", seeds.MARRIAGE),
                sql_match("nationality", seeds.NATIONALITY),
                sql_match("education", seeds.EDUCATION),
                sql_match("native_place", seeds.NATIVE_PLACE),
                sql_match("property", seeds.PROPERTY),
                AGE_SQL,
                SPEND_SQL,
            ]
        )
        + ") WHERE tag_id IS NOT NULL",
    ),
    "bought": (
        "",
        f"""SELECT DISTINCT o_custkey AS user_id, l_partkey + {GOODS_BASE} AS tag_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "pairs": ("own bought", "SELECT user_id, tag_id FROM own UNION ALL SELECT user_id, tag_id FROM bought"),
    "tags": (
        "",
        "SELECT *, 'about ' || name AS business, DATE '2019-07-01' + CAST(id % 365 AS INTEGER) AS ctime FROM ("
        'SELECT CAST(id AS BIGINT) AS id, name, level, CAST(pid AS BIGINT) AS pid, CAST("order" AS INTEGER) AS "order", state FROM (VALUES '
        + ", ".join(
            f"({i}, {quoted(n)}, {lv}, {p}, {'NULL' if o is None else o}, {s})" for i, n, lv, p, o, s in tree_rows()
        )
        + ') t(id, name, level, pid, "order", state) UNION ALL '
        f"SELECT p_partkey + {GOODS_BASE}, p_name || ' ' || CAST(p_partkey AS VARCHAR), 5, 42, NULL, "
        "CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE 4 END FROM part)",
    ),
    "paths": (
        "tags",
        """SELECT a.id AS tag_id, e.id AS l1, e.name AS l1_name, d.id AS l2, d.name AS l2_name, c.id AS l3,
        c.name AS l3_name, b.id AS l4, b.name AS l4_name, a.id AS l5, a.name AS l5_name
        FROM tags a JOIN tags b ON a.pid = b.id JOIN tags c ON b.pid = c.id JOIN tags d ON c.pid = d.id
        JOIN tags e ON d.pid = e.id WHERE a.level = 5 AND e.level = 1""",
    ),
    "leaves": ("paths", "SELECT tag_id, unnest([l1, l2, l3, l4, l5]) AS ancestor_id FROM paths"),
    "merge_tags": (
        "",
        f"""SELECT p_partkey + 1 AS id, 'set ' || p_brand AS name,
        CAST(p_partkey + {GOODS_BASE} AS VARCHAR) || ' or ' || CAST(p_partkey + {GOODS_BASE + 1} AS VARCHAR) || ' and '
          || CAST(p_partkey + {GOODS_BASE + 2} AS VARCHAR) || ' and' AS condition,
        CASE WHEN p_partkey % 8 = 0 THEN 6 ELSE 4 END AS state,
        DATE '2019-07-04' + CAST(p_partkey % 100 AS INTEGER) AS ctime FROM part""",
    ),
    "members": (
        "",
        f"""SELECT p_partkey + 1 AS merge_tag_id, CAST(s AS INTEGER) AS seq, p_partkey + {GOODS_BASE} + s - 1 AS basic_tag_id,
        CASE WHEN s = 1 THEN 'or' ELSE 'and' END AS connector FROM part, (SELECT unnest([1, 2, 3]) AS s)""",
    ),
    "user_grants": (
        "",
        f"SELECT DISTINCT l_suppkey AS user_id, l_partkey + {GOODS_BASE} AS tag_id FROM lineitem",
    ),
    "role_grants": (
        "",
        f"""SELECT p_size % 25 AS role_id, p_partkey + {GOODS_BASE} AS tag_id,
        CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS tag_type FROM part""",
    ),
    "cells": (
        "",
        """SELECT CAST(o_custkey AS VARCHAR) AS rowkey, 'detail' AS family, q AS qualifier, v AS value,
        epoch_us(o_orderdate) AS ts FROM (
          SELECT *, 'status' AS q, o_orderstatus AS v FROM orders UNION ALL
          SELECT *, 'priority', o_orderpriority FROM orders UNION ALL
          SELECT *, 'clerk', 'clerk-' || CAST(o_orderkey % 50 AS VARCHAR) FROM orders WHERE o_orderkey % 4 = 0)""",
    ),
    "newest": (
        "cells",
        """SELECT rowkey, family, qualifier, value, ts FROM (SELECT *, row_number() OVER
        (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, value DESC) AS rn FROM cells) WHERE rn = 1""",
    ),
}


def sql(body: str) -> str:
    """The query with the fragments it names in front."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in CTE and name not in needed:
                add(CTE[name][0])
                if name not in needed:
                    needed.append(name)

    add(" ".join(re.findall(r"(?:FROM|JOIN|IN|,)\s+\(?(\w+)", body)))
    head = ", ".join(f"{n} AS ({CTE[n][1]})" for n in needed)
    if not head:
        return body
    own = re.match(r"\s*WITH\s+", body)
    return f"WITH {head}, {body[own.end():]}" if own else f"WITH {head} {body}"
