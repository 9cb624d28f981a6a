"""Match tags, statistic tags, the rule language and per-row helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from tagloom import seeds, specs
from tagloom.functions import columns as col
from tagloom.functions import predicates as pred
from tagloom.operators import match, quality, stats
from tagloom.session import small_table
from tagloom.specs import Rule, bands

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


# ---------------------------------------------------------------- predicates


@query(
    "F1_where_dsl",
    b.sql(
        """SELECT id, gender, education FROM u WHERE gender <> '0'
        AND (education IS NULL OR education >= '大专') AND birthday > '1970' AND qq < '8'"""
    ),
)
def where_dsl(spark: SparkSession, sf: str) -> DataFrame:
    test = pred.where_dsl("gender[ne]0,education[GE]大专,birthday[Gt]1970,qq[lt]8")
    return b.users(spark, sf).where(test).select("id", "gender", "education")


@query("F1_where_dsl_numeric", b.sql("SELECT id, height FROM u WHERE CAST(qq AS BIGINT) >= 10020 AND height < 200"))
def where_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return b.users(spark, sf).where(pred.where_dsl("qq[ge]10020,height[lt]200", numeric=True)).select("id", "height")


@query(
    "F2_cell_predicates",
    b.sql(
        """SELECT id, job, native_place FROM u WHERE job IS NOT NULL AND (native_place LIKE '%hang%'
        OR regexp_matches(mobile, '7$') OR education IS NULL) AND id_card <> '' AND birthday <= '2010-06-01'
        AND property IS NOT NULL AND property <> '无房'"""
    ),
)
def cell_predicates(spark: SparkSession, sf: str) -> DataFrame:
    either = pred.any_of(
        [pred.cell("native_place", "substring", "HANG"), pred.cell("mobile", "regex", "7$"), pred.cell("education", "null")]
    )
    test = pred.all_of(
        [
            pred.cell("job", "not_null"),
            either,
            pred.cell("id_card", "ne", ""),
            pred.cell("birthday", "le", "2010-06-01"),
            pred.cell("property", "ne", "无房"),
        ]
    )
    return b.users(spark, sf).where(test).select("id", "job", "native_place")


@query(
    "F3_relative_time",
    b.sql(
        f"""SELECT order_sn, CAST(date_diff('day', CAST(pay_time AS DATE), DATE '{b.AS_OF_ORDERS}') AS INTEGER) AS days,
        pay_time >= DATE '{b.AS_OF_ORDERS}' - 182 AS half_year, pay_time >= DATE '{b.AS_OF_ORDERS}' - INTERVAL 1 MONTH AS month,
        pay_time >= DATE '{b.AS_OF_ORDERS}' - 60 AS sixty, epoch_ms(DATE '{b.AS_OF_ORDERS}' - 60) AS sixty_ms FROM ord WHERE pay_time >= DATE '{b.AS_OF_ORDERS}' - 182"""
    ),
)
def relative_time(spark: SparkSession, sf: str) -> DataFrame:
    def since(text: str):
        return F.to_date("pay_time") >= pred.relative_day(text, b.AS_OF_ORDERS)

    return (
        b.orders(spark, sf)
        .where(since("0.5y"))
        .select(
            "order_sn",
            F.datediff(F.to_date(F.lit(b.AS_OF_ORDERS)), F.to_date("pay_time")).alias("days"),
            since("0.5y").alias("half_year"),
            since("1m").alias("month"),
            since("60d").alias("sixty"),
            pred.epoch_millis(pred.relative_day("60d", b.AS_OF_ORDERS)).alias("sixty_ms"),
        )
    )


@query(
    "F4_parse_rule",
    b.sql(
        """SELECT p_partkey AS id, 'tbl_' || p_type AS source_table, 'id,' || p_brand AS fields,
        'jdbc:x?a=' || CAST(p_size AS VARCHAR) AS url FROM part"""
    ),
)
def parse_rule(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.concat(
        F.lit("inType=mysql\nurl=jdbc:x?a="), F.col("p_size").cast("string"), F.lit("\ndbTable=tbl_"), F.col("p_type"),
        F.lit("\nselectFieldNames=id,"), F.col("p_brand"),
    )
    return b.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), lines.alias("rule")).select(
        "id",
        col.rule_value(F.col("rule"), "dbTable").alias("source_table"),
        col.rule_value(F.col("rule"), "selectFieldNames").alias("fields"),
        col.rule_value(F.col("rule"), "url").alias("url"),
    )


@query(
    "F4_parse_rule_specs",
    """SELECT CAST(n_nationkey AS BIGINT) AS id, 'rdbms' AS kind, 'tbl_' || n_name AS source_table, 'id|r' || CAST(n_regionkey AS VARCHAR) AS fields,
    'a[eq]' || CAST(n_nationkey AS VARCHAR) || ',b[eq]x' AS conditions, 'jdbc:x?a=' || CAST(n_regionkey AS VARCHAR) || '&b=1' AS url, 0 AS part
    FROM nation UNION ALL SELECT n_nationkey, 'rdbms', 'second', 'k|v', 'a[eq]' || CAST(n_nationkey AS VARCHAR) || ',b[eq]x',
    'jdbc:x?a=' || CAST(n_regionkey AS VARCHAR) || '&b=1', 1 FROM nation""",
)
def parse_rule_specs(spark: SparkSession, sf: str) -> DataFrame:
    """A rule text per nation, of which there are 25, as the parser of the jobs reads it: two sources each."""
    found = []
    for n in b.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").collect():
        text = (
            f"inType=MySQL\r\nurl=jdbc:x?a={n['n_regionkey']}&b=1\ndbTable=tbl_{n['n_name']}#second\nselectFieldNames=id,r{n['n_regionkey']}#k,v\n"
            f"whereFieldNames=a,b\nwhereFieldValues={n['n_nationkey']},x"
        )
        for i, spec in enumerate(specs.parse_rule(text)):
            found.append((n["n_nationkey"], spec.kind, spec.table, "|".join(spec.fields), spec.where, spec.option("url"), i))
    return small_table(spark, found, "id bigint, kind string, source_table string, fields string, conditions string, url string, part int")


@query("F5_project", b.sql("SELECT id, gender, birthday FROM u"))
def project(spark: SparkSession, sf: str) -> DataFrame:
    fields = "id,gender,birthday".split(",")
    return b.users(spark, sf).select(*fields)


# ---------------------------------------------------------------- match tags


def _match(name: str, column: str, rules: list[Rule]) -> None:
    @query(name, b.sql(f"SELECT id, {b.sql_match(column, rules)} AS tag_id FROM u"))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return match.match_tag(b.users(spark, sf), "id", column, rules)


_match("M1_gender", "gender", seeds.GENDER)
_match("M2_job", "job", seeds.JOB)
_match("M3_political", "political", seeds.POLITICAL)
_match("M4_nationality", "nationality", seeds.NATIONALITY)
_match("M5_marriage", "marriage", seeds.MARRIAGE)


@query(
    "M0_match_long_rules",
    """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_partkey < 300 AND l_partkey % 3 <> 0 THEN 7000 + l_partkey
    WHEN l_partkey < 300 THEN 8000 + l_partkey END AS BIGINT) AS tag_id FROM lineitem""",
)
def match_long(spark: SparkSession, sf: str) -> DataFrame:
    """Rules beyond the CASE limit; every third has an older rival that wins."""
    rules = [Rule(7000 + i, str(i), 2) for i in range(300)]
    rules += [Rule(8000 + i, str(i), 1) for i in range(0, 300, 3)]
    lines = b.table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber").alias("line"), F.col("l_partkey").cast("string").alias("code")
    )
    return match.match_tag(lines, "line", "code", rules).select("line.l_orderkey", "line.l_linenumber", "tag_id")


@query(
    "M0_match_rule_table",
    """SELECT l_orderkey, l_linenumber, CASE WHEN r.p_brand IS NOT NULL THEN r.tag END AS tag_id FROM lineitem
    JOIN part ON l_partkey = part.p_partkey
    LEFT JOIN (SELECT p_brand, min(p_partkey) AS tag FROM part WHERE p_size > 10 GROUP BY p_brand) r
      ON part.p_brand = r.p_brand""",
)
def match_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rules read from a table that repeats every text; the lowest order wins."""
    part = b.table(spark, sf, "part")
    rules = part.where("p_size > 10").select(
        F.col("p_brand").alias("rule"), F.col("p_partkey").alias("tag_id"), F.lit(1).alias("order")
    )
    lines = b.table(spark, sf, "lineitem").join(
        part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("code")), "l_partkey"
    )
    keyed = lines.select(F.struct("l_orderkey", "l_linenumber").alias("line"), "code")
    return match.match_tag_table(keyed, "line", "code", rules).select("line.l_orderkey", "line.l_linenumber", "tag_id")


# ---------------------------------------------------------------- statistics


@query(
    "T0_range_long_bands",
    """SELECT p_partkey, CAST(CASE WHEN l BETWEEN 0 AND 499 THEN l % 500 // 2 + 1 WHEN l >= 900 THEN 999 END AS BIGINT) AS tag_id
    FROM (SELECT p_partkey, CAST(floor(p_retailprice * 10) AS BIGINT) % 1000 AS l FROM part)""",
)
def range_long(spark: SparkSession, sf: str) -> DataFrame:
    """Bands beyond the CASE limit: 250 pairs of numbers and an open end."""
    rules = [Rule(i + 1, f"{2 * i}-{2 * i + 1}") for i in range(250)] + [Rule(999, ">=900")]
    value = F.floor(F.col("p_retailprice") * 10) % 1000
    return stats.range_tag(b.table(spark, sf, "part"), "p_partkey", value, bands(rules))


@query("T1_age_band", b.sql(f"SELECT id, {b.AGE_SQL} AS tag_id FROM u"))
def age_band(spark: SparkSession, sf: str) -> DataFrame:
    return stats.age_band(b.users(spark, sf), "id", "birthday", seeds.AGE)


_CYCLE = [(0, 7, 127), (8, 14, 128), (15, 30, 129), (31, 60, 130), (61, 90, 131)]


@query(
    "T2_purchase_cycle",
    b.sql(
        f"""SELECT member_id, days, {b.sql_between('days', _CYCLE)} AS tag_id FROM (SELECT member_id,
        CAST(date_diff('day', CAST(max(pay_time) AS DATE), DATE '{b.AS_OF_ORDERS}') AS INTEGER) AS days
        FROM ord GROUP BY member_id)"""
    ),
)
def purchase_cycle(spark: SparkSession, sf: str) -> DataFrame:
    return stats.purchase_cycle(b.orders(spark, sf), "member_id", "pay_time", b.AS_OF_ORDERS, seeds.CYCLE)


@query(
    "T3_most_used_payment",
    b.sql(
        f"""SELECT member_id, payment_code AS code, n, {b.sql_match('payment_code', seeds.PAYMENT)} AS tag_id FROM (
        SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY n DESC, payment_code) AS rn FROM (
          SELECT member_id, payment_code, count(*) AS n FROM ord GROUP BY ALL)) WHERE rn = 1"""
    ),
)
def most_used(spark: SparkSession, sf: str) -> DataFrame:
    return stats.most_used_payment(b.orders(spark, sf), "member_id", "payment_code", seeds.PAYMENT)


@query(
    "T4_latest_payment",
    b.sql(
        f"""SELECT member_id, order_sn AS order_id, payment_code AS code, {b.sql_match('payment_code', seeds.PAYMENT)} AS tag_id
        FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY pay_time DESC, order_sn DESC) AS rn FROM ord)
        WHERE rn = 1"""
    ),
)
def latest_payment(spark: SparkSession, sf: str) -> DataFrame:
    return stats.latest_payment(
        b.orders(spark, sf), "member_id", "payment_code", "pay_time", "order_sn", seeds.PAYMENT
    )


@query(
    "T5_payment_counts",
    b.sql("SELECT member_id, count(*) AS n FROM ord WHERE payment_code <> 'other' GROUP BY member_id"),
)
def payment_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.payment_counts(b.orders(spark, sf), "member_id", "payment_code", seeds.PAYMENT)


# ---------------------------------------------------------------- catalogue tags

_HEIGHT = [(150 + 10 * i, 159 + 10 * i, 60 + i) for i in range(6)] + [(210, 240, 66)]


@query("G1_height", b.sql(f"SELECT id, {b.sql_between('height', _HEIGHT)} AS tag_id FROM u"))
def height(spark: SparkSession, sf: str) -> DataFrame:
    return stats.range_tag(b.users(spark, sf), "id", F.col("height"), bands(seeds.HEIGHT))


_EQUALITY = {
    "ethnicity": seeds.ETHNICITY,
    "native_place": seeds.NATIVE_PLACE,
    "education": seeds.EDUCATION,
    "employment": seeds.EMPLOYMENT,
    "district": seeds.DISTRICT,
    "property": seeds.PROPERTY,
    "car": seeds.CAR,
}


@query(
    "G2_equality_tags",
    b.sql("SELECT id, " + ", ".join(f"{b.sql_match(c, r)} AS {c}_tag" for c, r in _EQUALITY.items()) + " FROM u"),
)
def equality(spark: SparkSession, sf: str) -> DataFrame:
    """Seven tags over one scan of the users."""
    columns = {f"{c}_tag": match.match_column(F.col(c), r) for c, r in _EQUALITY.items()}
    return match.match_many(b.users(spark, sf), "id", columns)


_SIGNS = """CASE WHEN md >= 1222 OR md <= 119 THEN 'capricorn' WHEN md <= 218 THEN 'aquarius' WHEN md <= 320 THEN 'pisces'
 WHEN md <= 420 THEN 'aries' WHEN md <= 520 THEN 'taurus' WHEN md <= 621 THEN 'gemini' WHEN md <= 722 THEN 'cancer'
 WHEN md <= 822 THEN 'leo' WHEN md <= 922 THEN 'virgo' WHEN md <= 1022 THEN 'libra' WHEN md <= 1121 THEN 'scorpio'
 ELSE 'sagittarius' END"""
_SIGN_TAGS = "CAST(CASE sign " + " ".join(f"WHEN '{s}' THEN {t}" for s, t in stats.ZODIAC_TAGS.items()) + " END AS BIGINT)"


@query(
    "G3_zodiac",
    b.sql(
        f"""SELECT id, sign, {_SIGN_TAGS} AS tag_id FROM (SELECT id, {_SIGNS} AS sign FROM (
        SELECT id, month(birthdate) * 100 + day(birthdate) AS md FROM u))"""
    ),
)
def zodiac_tag(spark: SparkSession, sf: str) -> DataFrame:
    return stats.zodiac_tag(b.users(spark, sf), "id", F.col("birthdate"))


_AMOUNT = [(1, 999), (1000, 2999), (3000, 4999), (5000, 9999)]


def _amounts(first: int) -> list[tuple[int, int, int]]:
    return [(lo, hi, first + i) for i, (lo, hi) in enumerate(_AMOUNT)]


def _cheap(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with amounts in the range of the bands: hundreds to thousands."""
    return b.orders(spark, sf).select("member_id", F.floor(F.col("amount") / 50).cast("double").alias("amount"))


@query(
    "G4_order_value",
    b.sql(
        f"""SELECT member_id, avg_order, max_order, {b.sql_between('avg_order', _amounts(139))} AS avg_tag,
        {b.sql_between('max_order', _amounts(147))} AS max_tag FROM (SELECT member_id,
        CAST(sum(floor(amount / 50)) AS DOUBLE) / count(*) AS avg_order, max(floor(amount / 50)) AS max_order
        FROM ord GROUP BY member_id)"""
    ),
)
def order_value(spark: SparkSession, sf: str) -> DataFrame:
    return stats.order_value(_cheap(spark, sf), "member_id", "amount", seeds.ORDER_VALUE, seeds.LARGEST_ORDER)


_SPENDING = [
    (50000, 1000000, 132),
    (40000, 49999, 133),
    (30000, 39999, 134),
    (20000, 29999, 135),
    (10000, 19999, 136),
    (1000, 9999, 137),
    (1, 999, 138),
]


@query(
    "G5_spending_band",
    b.sql(
        f"""SELECT member_id, total, {b.sql_between('total', _SPENDING)} AS tag_id FROM (
        SELECT member_id, CAST(sum(floor(amount / 50)) AS DOUBLE) AS total FROM ord GROUP BY member_id)"""
    ),
)
def spending(spark: SparkSession, sf: str) -> DataFrame:
    return stats.spending_band(_cheap(spark, sf), "member_id", "amount", seeds.SPENDING)


@query(
    "G6_discount_depth",
    f"""SELECT member_id, depth, {b.sql_between('depth', [(0.3, 0.4, 160), (0.5, 0.7, 161), (0.8, 0.9, 162)])} AS tag_id
    FROM (SELECT o_custkey AS member_id, floor(CAST(sum(paid) AS DOUBLE) / CAST(sum(full4) AS DOUBLE) * 10 + 0.5::DOUBLE) / 10 AS depth
      FROM (SELECT l_orderkey, CAST(round(l_extendedprice * 100) AS BIGINT) * 100 AS full4,
        CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT) * (1 + l_orderkey % 9)) AS paid
        FROM lineitem) JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)""",
)
def discount(spark: SparkSession, sf: str) -> DataFrame:
    """Line discounts of one to nine times their size; paid over full price per member."""
    full = col.units(F.col("l_extendedprice"))
    off = col.units(F.col("l_discount")) * (1 + F.col("l_orderkey") % 9)
    lines = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_sn"),
        (full * 100 / F.lit(10000.0)).alias("receivable"),
        (full * (100 - off) / F.lit(10000.0)).alias("paid"),
    )
    owners = b.orders(spark, sf).select("order_sn", "member_id")
    return stats.discount_depth(lines.join(owners, "order_sn"), "member_id", "paid", "receivable", seeds.DISCOUNT_DEPTH)


@query(
    "G7_last_login",
    b.sql(
        f"""SELECT user_id, days, CAST(CASE WHEN days <= 1 THEN 169 WHEN days <= 7 THEN 170 WHEN days <= 14 THEN 171
        WHEN days <= 30 THEN 172 END AS BIGINT) AS tag_id FROM (SELECT user_id,
        CAST(date_diff('day', CAST(max(log_time) AS DATE), DATE '{b.AS_OF_LOGS}') AS INTEGER) AS days FROM logs GROUP BY user_id)"""
    ),
)
def last_login(spark: SparkSession, sf: str) -> DataFrame:
    return stats.last_login(b.logs(spark, sf), "user_id", "log_time", b.AS_OF_LOGS, seeds.LAST_LOGIN)


def _mode_sql(source: str, user: str, label: str, tag: str, label_name: str = "label") -> str:
    return b.sql(
        f"""SELECT {user}, v AS {label_name}, n, {tag} AS tag_id FROM (SELECT {user}, v, n, row_number() OVER
        (PARTITION BY {user} ORDER BY n DESC, v) AS rn FROM (SELECT {user}, {label} AS v, count(*) AS n FROM {source}
        WHERE {label} IS NOT NULL GROUP BY ALL)) WHERE rn = 1"""
    )


@query("G8_page_type", _mode_sql("logs", "user_id", "page", b.sql_match("v", seeds.PAGE)))
def page_type(spark: SparkSession, sf: str) -> DataFrame:
    return stats.favourite_tag(b.logs(spark, sf), "user_id", F.col("page"), seeds.PAGE)


@query("G8_device", _mode_sql("logs", "user_id", "device", b.sql_match("v", seeds.DEVICE)))
def device(spark: SparkSession, sf: str) -> DataFrame:
    return stats.device_tag(b.logs(spark, sf), "user_id", "user_agent", seeds.DEVICE)


_VISITS = """(SELECT user_id, session, max(t) - min(t) AS us FROM (SELECT user_id, t, sum(fresh) OVER
  (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT user_id, epoch_us(log_time) AS t,
  CASE WHEN epoch_us(log_time) - lag(epoch_us(log_time)) OVER (PARTITION BY user_id ORDER BY log_time) <= 21600000000
  THEN 0 ELSE 1 END AS fresh FROM logs)) GROUP BY user_id, session)"""


@query(
    "G9_visit_duration",
    b.sql(
        f"""SELECT user_id, visits, seconds, CAST(CASE WHEN seconds < 60 THEN 179 WHEN seconds BETWEEN 60 AND 299 THEN 180
        WHEN seconds > 300 THEN 181 END AS BIGINT) AS tag_id FROM (SELECT user_id, count(*) AS visits,
        CAST(floor(CAST(sum(us) AS DOUBLE) / count(*) / 1000000) AS BIGINT) AS seconds FROM {_VISITS} GROUP BY user_id)"""
    ),
)
def visit_duration(spark: SparkSession, sf: str) -> DataFrame:
    return stats.visit_duration(b.logs(spark, sf), "user_id", "log_time", seeds.VISIT_SECONDS, 6 * 3600)


_HOURS = [(1, 7, 191), (8, 12, 192), (13, 17, 193), (18, 21, 194), (22, 24, 195)]


@query(
    "G10_browsing_hours",
    _mode_sql(
        "logs",
        "user_id",
        "CAST(CASE WHEN hour(log_time) = 0 THEN 24 ELSE hour(log_time) END AS INTEGER)",
        b.sql_between("v", _HOURS),
        "hour",
    ),
)
def browsing_hours(spark: SparkSession, sf: str) -> DataFrame:
    return stats.browsing_hours(b.logs(spark, sf), "user_id", "log_time", seeds.BROWSING_HOURS)


def _bought(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    part = b.table(spark, sf, "part")
    owners = b.orders(spark, sf).select("order_sn", "member_id")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        owners, F.col("l_orderkey") == F.col("order_sn")
    )


_BOUGHT = "lineitem JOIN part ON l_partkey = p_partkey JOIN ord ON l_orderkey = order_sn"


@query(
    "G11_category_preference",
    _mode_sql(
        _BOUGHT, "member_id", f"{b.sql_list(b.texts(seeds.CATEGORY))}[p_size % 11 + 1]", b.sql_match("v", seeds.CATEGORY)
    ),
)
def category(spark: SparkSession, sf: str) -> DataFrame:
    label = b.pick(b.texts(seeds.CATEGORY), F.col("p_size") % 11)
    return stats.favourite_tag(_bought(spark, sf), "member_id", label, seeds.CATEGORY)


@query(
    "G11_brand_preference",
    _mode_sql(
        _BOUGHT,
        "member_id",
        f"{b.sql_list(b.texts(seeds.BRAND))}[CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 6 + 1]",
        b.sql_match("v", seeds.BRAND),
    ),
)
def brand(spark: SparkSession, sf: str) -> DataFrame:
    label = b.pick(b.texts(seeds.BRAND), F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") % 6)
    return stats.favourite_tag(_bought(spark, sf), "member_id", label, seeds.BRAND)


@query(
    "G11_coupon_type",
    _mode_sql(
        "lineitem JOIN ord ON l_orderkey = order_sn",
        "member_id",
        "CASE l_returnflag WHEN 'A' THEN '折扣券' WHEN 'N' THEN '活动券' WHEN 'R' THEN '积分换购' END",
        b.sql_match("v", seeds.COUPON),
    ),
)
def coupon(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_sn"), "l_returnflag")
    owned = lines.join(b.orders(spark, sf).select("order_sn", "member_id"), "order_sn")
    flag = F.col("l_returnflag")
    label = F.when(flag == "A", "折扣券").when(flag == "N", "活动券").when(flag == "R", "积分换购")
    return stats.favourite_tag(owned, "member_id", label, seeds.COUPON)


@query(
    "G12_property_and_car_value",
    b.sql(
        """SELECT id, CAST(CASE WHEN property_value BETWEEN 0 AND 499999 THEN 218 WHEN property_value BETWEEN 500000 AND 999999 THEN 219
        WHEN property_value BETWEEN 1000000 AND 1999999 THEN 220 WHEN property_value BETWEEN 2000000 AND 4999999 THEN 221
        WHEN property_value > 5000000 THEN 222 END AS BIGINT) AS property_tag,
        CAST(CASE WHEN car_value BETWEEN 1 AND 99999 THEN 226 WHEN car_value BETWEEN 100000 AND 199999 THEN 227
        WHEN car_value BETWEEN 200000 AND 299999 THEN 228 WHEN car_value BETWEEN 300000 AND 499999 THEN 229
        WHEN car_value BETWEEN 500000 AND 699999 THEN 230 WHEN car_value BETWEEN 700000 AND 999999 THEN 231
        WHEN car_value > 1000000 THEN 232 END AS BIGINT) AS car_tag FROM u"""
    ),
)
def values(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        "property_tag": stats.rule_band(F.col("property_value"), seeds.PROPERTY_VALUE),
        "car_tag": stats.rule_band(F.col("car_value"), seeds.CAR_VALUE),
    }
    return match.match_many(b.users(spark, sf), "id", columns)


# ---------------------------------------------------------------- helpers


@query(
    "U1_days_since",
    b.sql(f"SELECT id, CAST(date_diff('day', birthdate, DATE '{b.AS_OF_LOGS}') AS INTEGER) AS days FROM u"),
)
def days_since(spark: SparkSession, sf: str) -> DataFrame:
    text = F.date_format("birthdate", "yyyy/MM/dd")
    return b.users(spark, sf).select("id", col.days_since(text, b.AS_OF_LOGS).alias("days"))


@query(
    "U2_zodiac",
    f"""SELECT o_orderkey, {_SIGNS} AS sign FROM (
    SELECT o_orderkey, month(o_orderdate) * 100 + day(o_orderdate) AS md FROM orders)""",
)
def zodiac(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "orders").select("o_orderkey", col.zodiac(F.to_date("o_orderdate")).alias("sign"))


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Users, some of whose numbers are broken in a known way."""
    c = F.col("id")

    def broken(name: str, n: int, bad):
        return F.when(c % n == 0, bad).otherwise(F.col(name)).alias(name)

    return b.users(spark, sf).select(
        broken("mobile", 3, F.concat(F.lit("9"), "mobile")),
        broken("email", 4, F.lit("nobody")),
        broken("qq", 5, F.lit("0x12")),
        broken("id_card", 6, F.substring("id_card", 1, 10)),
        broken("birthday", 7, F.lit("2019-02-30")),
        F.concat(F.lit("10."), (c % 300).cast("string"), F.lit(".1.2")).alias("ip"),
        F.when(c % 8 == 0, "ftp://x").otherwise(F.concat(F.lit("http://a.example.com/"), c.cast("string"))).alias("url"),
    )


@query(
    "U3_validity_report",
    "SELECT unnest(['mobile','email','qq','id_card','birthday','ip','url']) AS \"column\", "
    "unnest(['mobile','email','qq','id_card','date','ip','url']) AS kind, unnest(p) AS passed, "
    "CAST(unnest(p) AS DOUBLE) / n AS share FROM (SELECT count(*) AS n, "
    "[count(*) FILTER (id % 3 <> 0), count(*) FILTER (id % 4 <> 0), count(*) FILTER (id % 5 <> 0),"
    " count(*) FILTER (id % 6 <> 0), count(*) FILTER (id % 7 <> 0), count(*) FILTER (id % 300 < 256),"
    " count(*) FILTER (id % 8 <> 0)] AS p FROM (SELECT c_custkey AS id FROM customer))",
)
def validity(spark: SparkSession, sf: str) -> DataFrame:
    kinds = {
        "mobile": "mobile",
        "email": "email",
        "qq": "qq",
        "id_card": "id_card",
        "birthday": "date",
        "ip": "ip",
        "url": "url",
    }
    return quality.validity_report(_damaged(spark, sf), kinds)
