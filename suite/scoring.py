"""Scores and machine learning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import bind as b
from tagloom import seeds
from tagloom.operators import ml, score
from tagloom.plans import training
from tagloom.session import shared_dir
from tagloom.sinks.writers import load_or_fit
from tagloom.specs import Rule, rules

QUERIES: dict[str, tuple] = {}


def query(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = (fn, oracle)
        return fn

    return keep


# ---------------------------------------------------------------- RFM

_RFM = f"""(SELECT member_id, CAST(date_diff('day', CAST(max(pay_time) AS DATE), DATE '{b.AS_OF_ORDERS}') AS INTEGER) AS recency,
  count(order_sn) AS frequency, CAST(sum(cents) AS DOUBLE) / 100 AS monetary FROM ord GROUP BY member_id)"""


@query("A1_rfm", b.sql(f"SELECT member_id, recency, frequency, monetary FROM {_RFM}"))
def rfm(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfm(b.orders(spark, sf), "member_id", "pay_time", "order_sn", "amount", b.AS_OF_ORDERS)




@query(
    "A2_rfm_score_compat",
    b.sql(
        f"""SELECT member_id, recency, frequency, monetary,
        CASE WHEN recency BETWEEN 1 AND 3 THEN 5 WHEN recency BETWEEN 4 AND 6 THEN 4 WHEN recency BETWEEN 7 AND 9 THEN 3
          WHEN recency BETWEEN 10 AND 15 THEN 2 WHEN recency >= 16 THEN 1 END AS r_score,
        CASE WHEN frequency >= 200 THEN 5 WHEN frequency BETWEEN 150 AND 199 THEN 4 WHEN frequency BETWEEN 100 AND 149 THEN 3
          WHEN frequency BETWEEN 50 AND 99 THEN 2 WHEN frequency BETWEEN 1 AND 49 THEN 1 END AS f_score,
        CASE WHEN monetary >= 200000 THEN 5 WHEN monetary BETWEEN 100000 AND 199999 THEN 4
          WHEN monetary BETWEEN 50000 AND 99999 THEN 3 WHEN monetary BETWEEN 10000 AND 49999 THEN 2
          WHEN monetary <= 9999 THEN 1 END AS m_score FROM {_RFM}"""
    ),
)
def rfm_compat(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfm_score(rfm(spark, sf), compat=True)


# Bands that split the driver's data into parts of similar size.
_R_WIDE = rules([("0-30", 5), ("31-60", 4), ("61-120", 3), ("121-240", 2), (">=241", 1)])
_F_WIDE = rules([(">=15", 5), ("12-14", 4), ("9-11", 3), ("6-8", 2), ("1-5", 1)])
_M_WIDE = rules([(">=4000000", 5), ("3000000-3999999", 4), ("2000000-2999999", 3), ("1000000-1999999", 2), ("0-999999", 1)])


@query(
    "A2_rfm_score",
    b.sql(
        f"""SELECT * FROM (SELECT member_id, recency, frequency, monetary,
        CASE WHEN recency < 31 THEN 5 WHEN recency < 61 THEN 4 WHEN recency < 121 THEN 3 WHEN recency < 241 THEN 2 ELSE 1 END AS r_score,
        CASE WHEN frequency >= 15 THEN 5 WHEN frequency >= 12 THEN 4 WHEN frequency >= 9 THEN 3 WHEN frequency >= 6 THEN 2 ELSE 1 END AS f_score,
        CASE WHEN monetary >= 4000000 THEN 5 WHEN monetary >= 3000000 THEN 4 WHEN monetary >= 2000000 THEN 3
          WHEN monetary >= 1000000 THEN 2 ELSE 1 END AS m_score FROM {_RFM})"""
    ),
)
def rfm_scored(spark: SparkSession, sf: str) -> DataFrame:
    scored = score.rfm_score(rfm(spark, sf), _R_WIDE, _F_WIDE, _M_WIDE)
    return score.drop_unscored(scored, "r_score", "f_score", "m_score")


# ---------------------------------------------------------------- RFE

_RFE = f"""(SELECT user_id, CAST(date_diff('day', CAST(max(log_time) AS DATE), DATE '{b.AS_OF_LOGS}') AS INTEGER) AS recency,
  count(url) AS frequency, count(DISTINCT url) AS engagements FROM logs GROUP BY user_id)"""


@query("A3_rfe", b.sql(f"SELECT user_id, recency, frequency, engagements FROM {_RFE}"))
def rfe(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfe(b.logs(spark, sf), "user_id", "log_time", "url", b.AS_OF_LOGS)


@query(
    "A4_rfe_score_compat",
    b.sql(
        f"""SELECT user_id, recency, frequency, engagements,
        CASE WHEN recency BETWEEN 0 AND 3 THEN 5 WHEN recency BETWEEN 4 AND 6 THEN 4 WHEN recency BETWEEN 7 AND 9 THEN 3
          WHEN recency BETWEEN 10 AND 15 THEN 2 WHEN recency >= 16 THEN 1 END AS r_score,
        CASE WHEN frequency >= 400 THEN 5 WHEN frequency >= 300 THEN 4 WHEN frequency >= 200 THEN 3
          WHEN frequency >= 100 THEN 2 ELSE 1 END AS f_score,
        CASE WHEN engagements >= 250 THEN 5 WHEN engagements >= 230 THEN 4 WHEN engagements >= 210 THEN 3
          WHEN engagements >= 200 THEN 2 WHEN engagements <= 100 THEN 1 END AS e_score FROM {_RFE}"""
    ),
)
def rfe_compat(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfe_score(rfe(spark, sf), compat=True)


_F_EVENTS = rules([(">=75", 5), ("70-74", 4), ("65-69", 3), ("60-64", 2), ("0-59", 1)])
_E_EVENTS = rules([(">=58", 5), ("54-57", 4), ("50-53", 3), ("46-49", 2), ("<=45", 1)])
_R_EVENTS = rules([("0-2", 5), ("3-4", 4), ("5-6", 3), ("7-8", 2), (">=9", 1)])


@query(
    "A4_rfe_score",
    b.sql(
        f"""SELECT user_id, recency, frequency, engagements,
        CASE WHEN recency < 3 THEN 5 WHEN recency < 5 THEN 4 WHEN recency < 7 THEN 3 WHEN recency < 9 THEN 2 ELSE 1 END AS r_score,
        CASE WHEN frequency >= 75 THEN 5 WHEN frequency >= 70 THEN 4 WHEN frequency >= 65 THEN 3 WHEN frequency >= 60 THEN 2 ELSE 1 END AS f_score,
        CASE WHEN engagements >= 58 THEN 5 WHEN engagements >= 54 THEN 4 WHEN engagements >= 50 THEN 3
          WHEN engagements >= 46 THEN 2 ELSE 1 END AS e_score FROM {_RFE}"""
    ),
)
def rfe_scored(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfe_score(rfe(spark, sf), _R_EVENTS, _F_EVENTS, _E_EVENTS)


# Single days of a user, so that the six-step bands see small numbers.
_DAILY = f"""(SELECT user_id * 100 + day(log_time) AS user_id, CAST(date_diff('day', CAST(max(log_time) AS DATE), DATE '{b.AS_OF_LOGS}') AS INTEGER) AS recency,
  count(url) AS frequency, count(DISTINCT url) AS engagements FROM logs GROUP BY ALL)"""


def _six(value: str, steps: list[tuple[str, int]]) -> str:
    return "CASE " + " ".join(f"WHEN {value} {test} THEN {n}" for test, n in steps) + " END"


_SIX_SQL = f"""(SELECT user_id, recency, frequency, engagements,
  {_six('recency', [('<= 1', 6), ('<= 3', 5), ('<= 5', 4), ('<= 7', 3), ('<= 14', 2), ('>= 15', 1)])} AS r_score,
  {_six('frequency', [('>= 10', 6), ('>= 8', 5), ('>= 6', 4), ('>= 4', 3), ('>= 2', 2), ('= 1', 1)])} AS f_score,
  {_six('engagements', [('>= 6', 6), ('= 5', 5), ('= 4', 4), ('= 3', 3), ('= 2', 2), ('= 1', 1)])} AS e_score
  FROM {_DAILY})"""


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.logs(spark, sf).withColumn("user_id", F.col("user_id") * 100 + F.dayofmonth("log_time"))
    return score.rfe(rows, "user_id", "log_time", "url", b.AS_OF_LOGS)


@query(
    "A5_rfe_score_total",
    b.sql(
        f"""SELECT user_id, recency, frequency, engagements, r_score, f_score, e_score,
        r_score + f_score + e_score AS total FROM {_SIX_SQL}"""
    ),
)
def rfe_total(spark: SparkSession, sf: str) -> DataFrame:
    return score.rfe_score_total(_daily(spark, sf))


@query(
    "G13_activity_band",
    b.sql(
        f"""SELECT user_id, total, share, CAST(CASE WHEN share >= 1 THEN 240 WHEN share BETWEEN 0.6 AND 0.9 THEN 241
        WHEN share BETWEEN 0.2 AND 0.5 THEN 242 WHEN share <= 0.1 THEN 243 END AS BIGINT) AS tag_id FROM (
        SELECT user_id, total, floor(CAST(total * 10 AS DOUBLE) / 18 + 0.5::DOUBLE) / 10 AS share FROM (
        SELECT user_id, r_score + f_score + e_score AS total FROM {_SIX_SQL}))"""
    ),
)
def activity(spark: SparkSession, sf: str) -> DataFrame:
    return score.activity_band(_daily(spark, sf), "user_id", seeds.ACTIVITY)


# ---------------------------------------------------------------- PSM

_PSM_SUMS = """(SELECT member_id, sum(CASE WHEN coupon4 > 0 THEN 1 ELSE 0 END) AS dotn, count(*) AS otn,
  CAST(sum(coupon4) AS DOUBLE) / 10000 AS dat, CAST(sum(cents * 100 + coupon4) AS DOUBLE) / 10000 AS rat,
  CAST(sum(cents * 100) AS DOUBLE) / 10000 AS aat FROM priced GROUP BY member_id)"""
_PSM_TERMS = """CAST(dotn AS DOUBLE) / otn AS dor, CASE WHEN dotn = 0 THEN 0 ELSE (dat / dotn) / (rat / otn) END AS odr, dat / rat AS dara"""
_PSM = f"(SELECT *, dor + odr + dara AS score FROM (SELECT *, {_PSM_TERMS} FROM {_PSM_SUMS}))"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("dor", "odr", "dara", "score") if c in df.columns})


@query(
    "A6_psm",
    b.sql(
        f"""SELECT member_id, CAST(dotn AS BIGINT) AS dotn, otn, dat, rat, aat, round(dor, 6) AS dor, round(odr, 6) AS odr,
        round(dara, 6) AS dara, round(score, 6) AS score FROM {_PSM}"""
    ),
)
def psm(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(score.psm(b.priced_orders(spark, sf), "member_id", "amount", "coupon", 4))


@query(
    "A7_psm_positive",
    b.sql(
        f"""SELECT member_id, CAST(dotn AS BIGINT) AS dotn, otn, dat, rat, round(dor, 6) AS dor, round(odr, 6) AS odr,
        round(dara, 6) AS dara, round(score, 6) AS score FROM {_PSM}"""
    ),
)
def psm_positive(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.priced_orders(spark, sf).withColumn("receivable", F.col("amount") + F.col("coupon"))
    return _rounded(score.psm_positive(rows, "member_id", "receivable", "coupon", 4))


# Coupons and amounts of either sign, and some of none.
_SIGNED = """(SELECT member_id, CASE WHEN order_sn % 11 = 0 THEN -coupon4 ELSE coupon4 END AS c4,
  CASE WHEN order_sn % 17 = 0 THEN -cents * 100 ELSE cents * 100 END + CASE WHEN order_sn % 11 = 0 THEN -coupon4 ELSE coupon4 END AS r4 FROM priced)"""


@query(
    "A7_psm_positive_signs",
    b.sql(
        f"""SELECT member_id, dotn, otn, dat, rat, round(coalesce(dotn::DOUBLE / nullif(otn, 0), 0), 6) AS dor,
        round(coalesce((dat / nullif(dotn, 0)) / nullif(rat / nullif(otn, 0), 0), 0), 6) AS odr, round(coalesce(dat / nullif(rat, 0), 0), 6) AS dara FROM (
        SELECT member_id, count(*) FILTER (c4 > 0) AS dotn, count(*) FILTER (r4 > 0) AS otn,
          coalesce(CAST(sum(c4) FILTER (c4 > 0) AS DOUBLE), 0) / 10000 AS dat, coalesce(CAST(sum(r4) FILTER (r4 > 0) AS DOUBLE), 0) / 10000 AS rat
        FROM {_SIGNED} GROUP BY member_id)"""
    ),
)
def psm_positive_signs(spark: SparkSession, sf: str) -> DataFrame:
    """Only positive amounts count on either side; here a good part of them is not."""
    order = F.col("order_sn")
    rows = b.priced_orders(spark, sf).select(
        "member_id",
        F.when(order % 17 == 0, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.when(order % 11 == 0, -F.col("coupon")).otherwise(F.col("coupon")).alias("coupon"),
    )
    rows = rows.withColumn("receivable", F.col("amount") + F.col("coupon"))
    return _rounded(score.psm_positive(rows, "member_id", "receivable", "coupon", 4)).drop("score")


@query(
    "A8_psm_band",
    b.sql(
        f"""SELECT member_id, round(score, 6) AS score, CAST(CASE WHEN score >= 1 THEN 234 WHEN score BETWEEN 0.4 AND 1 THEN 235
        WHEN score BETWEEN 0.1 AND 0.3 THEN 236 WHEN score = 0 THEN 237 WHEN score < 0 THEN 238 END AS BIGINT) AS tag_id
        FROM {_PSM}"""
    ),
)
def psm_band(spark: SparkSession, sf: str) -> DataFrame:
    scored = score.psm(b.priced_orders(spark, sf), "member_id", "amount", "coupon", 4)
    return _rounded(score.psm_band(scored, "member_id", seeds.PSM))


# ---------------------------------------------------------------- features


@query("A9_assemble", b.sql(f"SELECT member_id, recency, frequency, 2 AS size FROM {_RFM} WHERE frequency <> 7"))
def assemble(spark: SparkSession, sf: str) -> DataFrame:
    """Users with seven orders have no frequency and are left out."""
    rows = rfm(spark, sf).withColumn("f", F.when(F.col("frequency") != 7, F.col("frequency")))
    return ml.assemble(rows, ["recency", "f"]).select(
        "member_id", "recency", "frequency", F.size(ml.as_array("features")).alias("size")
    )


@query(
    "A10_scale_minmax",
    b.sql(
        f"""SELECT member_id, round((CAST(recency AS DOUBLE) - min(recency) OVER ()) / (max(recency) OVER () - min(recency) OVER ()), 6) AS r,
        round((CAST(frequency AS DOUBLE) - min(frequency) OVER ()) / (max(frequency) OVER () - min(frequency) OVER ()), 6) AS f
        FROM {_RFM}"""
    ),
)
def scale(spark: SparkSession, sf: str) -> DataFrame:
    scaled = ml.scale_minmax(ml.assemble(rfm(spark, sf), ["recency", "frequency"]))
    v = ml.as_array("scaled")
    return scaled.select("member_id", F.round(v[0], 6).alias("r"), F.round(v[1], 6).alias("f"))


def _norm_sql(norm: str) -> str:
    return f"""SELECT vec_id, round(v[1] / n, 6) AS first, round(v[len(v)] / n, 6) AS last FROM (
      SELECT vec_id, v, {norm} AS n FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))"""


@query("A11_normalize_l1", _norm_sql("list_sum(list_transform(v, lambda x: abs(x)))"))
def normalize_l1(spark: SparkSession, sf: str) -> DataFrame:
    normed = ml.normalize(ml.vectors(b.table(spark, sf, "embeddings"), "embedding"), 1.0)
    v = ml.as_array("normed")
    return normed.select(
        "vec_id", F.round(F.element_at(v, 1), 6).alias("first"), F.round(F.element_at(v, -1), 6).alias("last")
    )


@query("A11_normalize_linf", _norm_sql("list_max(list_transform(v, lambda x: abs(x)))"))
def normalize_linf(spark: SparkSession, sf: str) -> DataFrame:
    v = ml.normalize_array(F.col("embedding").cast("array<double>"), float("inf"))
    return b.table(spark, sf, "embeddings").select("vec_id", v.alias("v")).select(
        "vec_id", F.round(F.element_at("v", 1), 6).alias("first"), F.round(F.element_at("v", -1), 6).alias("last")
    )


# ---------------------------------------------------------------- clusters

_SCORES = ["r_score", "f_score", "m_score"]


def _scored_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ml.assemble(rfm_scored(spark, sf), _SCORES)


def _scored_points(spark: SparkSession, sf: str) -> DataFrame:
    """At most 125 score triples with the number of users of each."""
    return ml.assemble(ml.compress(rfm_scored(spark, sf), _SCORES), _SCORES)


@query("A12_kmeans")
def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    model = ml.kmeans_fit(_scored_points(spark, sf), len(seeds.SPENDING), weight="weight")
    return model.transform(_scored_vectors(spark, sf)).groupBy("prediction").agg(F.count("*").alias("users"))


@query("A13_kmeans_sweep")
def kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return ml.kmeans_sweep(_scored_points(spark, sf), range(2, 11), weight="weight")


# Four groups of members far apart from each other, so that every clustering that
# works finds just these: coordinates are a multiple of 1000 and a small rest.
_GROUPS = """(SELECT c_custkey AS id, c_custkey * 7 % 4 AS g, 1000 * (c_custkey * 7 % 4) + c_acctbal / 10000 AS x,
  1000 * (c_custkey * 7 % 4) + c_custkey % 10 / 10 AS y FROM customer)"""
_GROUP_COST = f"""(SELECT sum(s) AS cost FROM (SELECT (var_pop(x) + var_pop(y)) * count(*) AS s FROM {_GROUPS} GROUP BY g))"""


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    far = 1000 * (c * 7 % 4)
    rows = b.table(spark, sf, "customer").select(
        c.alias("id"), (far + F.col("c_acctbal") / 10000).alias("x"), (far + c % 10 / 10).alias("y")
    )
    return ml.assemble(rows, ["x", "y"]).select("id", "features")


@query("A12_kmeans_far_groups", f"SELECT id, CAST(4 - g AS INTEGER) AS rank, CAST(1554 + 4 - g AS BIGINT) AS tag_id FROM {_GROUPS}")
def kmeans_far(spark: SparkSession, sf: str) -> DataFrame:
    """Fit, rank and tag: the group with the greatest coordinates takes the first tag."""
    rows = _groups(spark, sf)
    tags = [Rule(1555 + i, "", i) for i in range(4)]
    return ml.cluster_tags(rows, "id", ml.kmeans_fit(rows, 4, max_iter=20), tags).drop("prediction")


@query("A13_kmeans_cost", f"SELECT 4 AS k, round(cost, 3) AS cost FROM {_GROUP_COST}")
def kmeans_cost(spark: SparkSession, sf: str) -> DataFrame:
    return ml.kmeans_sweep(_groups(spark, sf), [4], max_iter=20).select("k", F.round("cost", 3).alias("cost"))


@query("A13_best_k", f"SELECT CAST(count(DISTINCT g) AS INTEGER) AS k FROM {_GROUPS}")
def kmeans_best_k(spark: SparkSession, sf: str) -> DataFrame:
    """The cost curve of far groups bends where k is their number."""
    k = ml.best_k(ml.kmeans_sweep(_groups(spark, sf), range(2, 8), max_iter=20))
    return _groups(spark, sf).agg(F.lit(k).cast("int").alias("k"), F.count("*").alias("_n")).select("k")


@query("A24_bisecting_cost", f"SELECT 4 AS k, round(cost, 3) AS cost FROM {_GROUP_COST}")
def bisecting_cost(spark: SparkSession, sf: str) -> DataFrame:
    return ml.bisecting_sweep(_groups(spark, sf), [4]).select("k", F.round("cost", 3).alias("cost"))


def _centers(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vector per label, cents exact: stands for fitted centers."""
    o = b.orders(spark, sf)
    return o.groupBy((F.col("member_id") % 9).cast("int").alias("prediction")).agg(
        F.array(
            F.avg((F.col("order_sn") % 1000).cast("double")), F.count("*").cast("double"), F.max("order_sn").cast("double")
        ).alias("center")
    )


_CENTERS = """(SELECT prediction, a + n + m AS center_sum, row_number() OVER (ORDER BY a + n + m DESC, prediction) AS rank
  FROM (SELECT CAST(o_custkey % 9 AS INTEGER) AS prediction, avg(CAST(o_orderkey % 1000 AS DOUBLE)) AS a,
  CAST(count(*) AS DOUBLE) AS n, CAST(max(o_orderkey) AS DOUBLE) AS m FROM orders GROUP BY 1))"""


@query("A14_rank_clusters", f"SELECT prediction, round(center_sum, 6) AS center_sum, CAST(rank AS INTEGER) AS rank FROM {_CENTERS}")
def rank_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return ml.rank_clusters(_centers(spark, sf)).withColumn("center_sum", F.round("center_sum", 6))


@query(
    "A15_cluster_to_tag",
    f"""SELECT prediction, round(center_sum, 6) AS center_sum, CAST(rank AS INTEGER) AS rank, CAST(131 + rank AS BIGINT) AS tag_id
    FROM {_CENTERS} WHERE rank <= 7""",
)
def cluster_to_tag(spark: SparkSession, sf: str) -> DataFrame:
    tagged = ml.cluster_to_tag(ml.rank_clusters(_centers(spark, sf)), seeds.SPENDING)
    return tagged.withColumn("center_sum", F.round("center_sum", 6))


@query("A15_cluster_tags")
def cluster_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Customer value: train on the RFM scores, store, load, and tag every user."""
    scored, path = rfm_scored(spark, sf), shared_dir(spark, "rfm")
    training.train(scored, _SCORES, len(seeds.SPENDING), path)
    return training.predict(scored, "member_id", _SCORES, path, seeds.SPENDING)


@query("A15_activity_clusters")
def activity_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """User activity: RFE scores scaled to 0..1, four clusters, four tags."""
    names = ["r_score", "f_score", "e_score"]
    scored = score.drop_unscored(rfe_scored(spark, sf), *names)
    scaled = ml.scale_minmax(ml.assemble(scored, names)).select("user_id", F.col("scaled").alias("features"))
    points = ml.compress(scaled, ["features"])
    model = ml.kmeans_fit(points, len(seeds.ACTIVITY), seed=20, max_iter=20, weight="weight")
    return ml.cluster_tags(scaled, "user_id", model, seeds.ACTIVITY)


@query("A15_sensitivity_clusters")
def sensitivity_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Price sensitivity: the PSM score alone, five clusters, five tags."""
    scored, path = score.psm(b.priced_orders(spark, sf), "member_id", "amount", "coupon", 4), shared_dir(spark, "psm")
    training.train(scored, ["score"], len(seeds.PSM), path, distinct=False)
    return training.predict(scored, "member_id", ["score"], path, seeds.PSM)


@query(
    "A16_cluster_stats",
    b.sql(
        f"""SELECT CAST(member_id % 7 AS INTEGER) AS prediction, min(recency + frequency) AS min_score,
        max(recency + frequency) AS max_score FROM {_RFM} GROUP BY 1"""
    ),
)
def cluster_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = rfm(spark, sf).withColumn("prediction", (F.col("member_id") % 7).cast("int"))
    return ml.cluster_stats(rows, ["recency", "frequency"])


_POWER = """SELECT member_id, CAST(epoch_ms(max(pay_time)) AS DOUBLE) AS recency, count(order_sn) AS frequency,
  CAST(sum(cents) AS DOUBLE) / 100 AS monetary FROM ord GROUP BY member_id"""


def _power(spark: SparkSession, sf: str) -> DataFrame:
    return score.spend_power(b.orders(spark, sf), "member_id", "pay_time", "order_sn", "amount")


@query("A17_spend_power_features", b.sql(_POWER))
def spend_power_features(spark: SparkSession, sf: str) -> DataFrame:
    return _power(spark, sf)


@query("A17_spend_power")
def spend_power(spark: SparkSession, sf: str) -> DataFrame:
    """Unscored features, L1-normed, three clusters, ranked to three tags."""
    rows = ml.normalize(ml.assemble(_power(spark, sf), ["recency", "frequency", "monetary"]), 1.0)
    rows = rows.select("member_id", F.col("normed").alias("features"))
    tags = [Rule(t, "", i) for i, t in enumerate(seeds.SPEND_POWER, start=1)]
    return ml.cluster_tags(rows, "member_id", ml.kmeans_fit(rows, 3), tags)


def _told(assembled: DataFrame, user: str, model, rules: list[Rule]) -> DataFrame:
    """Per user whether the tag is that of the nearest center, and whether more users' centers
    with a greater sum have a better place: what a clustering must give whatever it found."""
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    place = {i: sum(sum(o) > sum(c) for o in centers) for i, c in enumerate(centers)}
    tags = [r.tag_id for r in sorted(rules, key=lambda r: (r.order or 0, r.tag_id))]
    point = ml.as_array("features")

    def far(center: list[float]):
        both = F.zip_with(point, F.array(*[F.lit(x) for x in center]), lambda a, c: (a - c) * (a - c))
        return F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x)

    given = ml.cluster_tags(assembled, user, model, rules).select(user, "prediction", "tag_id")
    away = assembled.select(F.col(user).alias("_user"), F.array(*[far(c) for c in centers]).alias("_far"))
    return given.join(away, F.col(user) == F.col("_user")).select(
        user,
        (F.get("_far", F.col("prediction")) <= F.array_min("_far") * (1 + 1e-9) + 1e-12).alias("nearest"),
        (F.col("tag_id") == F.element_at(F.array(*[F.lit(tags[place[i]]) for i in range(len(centers))]), F.col("prediction") + 1)).alias("ranked"),
    )


@query("A15_cluster_invariants", b.sql(f"SELECT member_id, true AS nearest, true AS ranked FROM {_RFM}"))
def cluster_invariants(spark: SparkSession, sf: str) -> DataFrame:
    model = ml.kmeans_fit(_scored_points(spark, sf), len(seeds.SPENDING), weight="weight")
    return _told(_scored_vectors(spark, sf), "member_id", model, seeds.SPENDING)


@query("A17_spend_power_invariants", b.sql(f"SELECT member_id, true AS nearest, true AS ranked FROM {_RFM}"))
def spend_power_invariants(spark: SparkSession, sf: str) -> DataFrame:
    rows = ml.normalize(ml.assemble(_power(spark, sf), ["recency", "frequency", "monetary"]), 1.0)
    rows = rows.select("member_id", F.col("normed").alias("features"))
    tags = [Rule(t, "", i) for i, t in enumerate(seeds.SPEND_POWER, start=1)]
    return _told(rows, "member_id", ml.kmeans_fit(rows, 3), tags)


# ---------------------------------------------------------------- shop gender


def _case(column: str, codes: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {b.quoted(k)} THEN {v}" for k, v in codes.items()) + " ELSE 0 END"


_LABEL = f"""CASE WHEN colour IN ({', '.join(map(b.quoted, seeds.FEMALE_COLOURS))})
  OR kind IN ({', '.join(map(b.quoted, seeds.FEMALE_TYPES))}) THEN 1 ELSE 0 END"""
_CODED = f"""(SELECT goods_order, colour, kind, {_case('colour', seeds.COLOUR_CODES)} AS colour_code,
  {_case('kind', seeds.PRODUCT_TYPES)} AS type_code, {_LABEL} AS label FROM goods)"""


@query(
    "A18_encode_categories",
    b.sql(
        f"""SELECT colour, kind, colour_code, type_code, count(*) AS n FROM {_CODED}
        GROUP BY colour, kind, colour_code, type_code"""
    ),
)
def encode(spark: SparkSession, sf: str) -> DataFrame:
    coded = score.encode_categories(b.goods(spark, sf), "colour", "kind")
    return coded.groupBy("colour", "kind", "colour_code", "type_code").agg(F.count("*").alias("n"))


@query("A19_weak_label", b.sql(f"SELECT goods_order, {_LABEL} AS label, count(*) AS n FROM goods GROUP BY ALL"))
def weak_label(spark: SparkSession, sf: str) -> DataFrame:
    labelled = score.weak_label(b.goods(spark, sf), "colour", "kind")
    return labelled.groupBy("goods_order", "label").agg(F.count("*").alias("n"))


def _shop(spark: SparkSession, sf: str) -> DataFrame:
    coded = score.weak_label(score.encode_categories(b.goods(spark, sf), "colour", "kind"), "colour", "kind")
    return score.shop_features(coded, b.orders(spark, sf), "goods_order", "order_sn", "member_id")


@query(
    "A20_shop_features",
    b.sql(
        f"""SELECT member_id, order_sn, label, CAST(colour_code AS DOUBLE) AS colour_code, CAST(type_code AS DOUBLE) AS type_code
        FROM {_CODED} JOIN ord ON goods_order = order_sn WHERE colour_code <> 0 AND type_code <> 0"""
    ),
)
def shop_features(spark: SparkSession, sf: str) -> DataFrame:
    return _shop(spark, sf)


_CODES = ["colour_code", "type_code"]


def _shop_points(spark: SparkSession, sf: str, share: float) -> DataFrame:
    """Distinct codes with label, side of the split and count: one pass over the
    goods serves both sides."""
    rows = _shop(spark, sf).withColumn("train", ml.draw("order_sn") < share)
    return ml.assemble(ml.compress(rows, ["train", "label", *_CODES]), _CODES)


@query("A21_decision_tree")
def decision_tree(spark: SparkSession, sf: str) -> DataFrame:
    points = _shop_points(spark, sf, 0.7)
    model = ml.decision_tree_fit(points.where("train"), weight="weight")
    test = model.transform(points.where("not train"))
    return test.groupBy("label", "predicted_label").agg(F.sum("weight").cast("bigint").alias("n"))


@query("A22_evaluate")
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    with ml.kept(_shop_points(spark, sf, 0.7)) as points:
        model = ml.decision_tree_fit(points.where("train"), weight="weight")
        parts = [
            ml.evaluate(model.transform(points.where(side)), weight="weight").withColumn("part", F.lit(name))
            for name, side in (("train", "train"), ("test", "not train"))
        ]
    return parts[0].unionByName(parts[1])


@query("A22_shop_gender_job")
def shop_gender(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job: no tags unless both splits are predicted well enough."""
    with ml.kept(_shop_points(spark, sf, 0.7)) as points:
        model = ml.decision_tree_fit(points.where("train"), weight="weight")
        accuracy = [
            ml.evaluate(model.transform(points.where(side)), auc=False, weight="weight").first()["accuracy"]
            for side in ("train", "not train")
        ]
    rows = ml.assemble(_shop(spark, sf), _CODES)
    predicted = model.transform(rows).withColumn("predicted", F.col("predicted_label").cast("double"))
    votes = score.shop_gender_vote(predicted, "member_id", "predicted", seeds.SHOP_GENDER)
    return votes.where(F.lit(min(accuracy) > 0.8))


@query(
    "A23_shop_gender_vote",
    b.sql(
        f"""SELECT member_id, male, female, total, CAST(CASE WHEN CAST(male AS DOUBLE) / total >= 0.6 THEN 248 ELSE 249 END AS BIGINT) AS tag_id
        FROM (SELECT member_id, count(*) FILTER (label = 0) AS male, count(*) FILTER (label = 1) AS female, count(*) AS total
          FROM {_CODED} JOIN ord ON goods_order = order_sn WHERE colour_code <> 0 AND type_code <> 0 GROUP BY member_id) WHERE CAST(male AS DOUBLE) / total >= 0.6 OR CAST(female AS DOUBLE) / total >= 0.6"""
    ),
)
def vote(spark: SparkSession, sf: str) -> DataFrame:
    return score.shop_gender_vote(_shop(spark, sf), "member_id", "label", seeds.SHOP_GENDER)


# A label that one threshold on the colour code decides, as codes and members.
_SPLIT = f"(SELECT colour_code, type_code, CASE WHEN colour_code > 8 THEN 1 ELSE 0 END AS label FROM {_CODED} WHERE colour_code <> 0 AND type_code <> 0)"


def _threshold(spark: SparkSession, sf: str) -> DataFrame:
    coded = score.encode_categories(b.goods(spark, sf), "colour", "kind").where("colour_code != 0 and type_code != 0")
    labelled = coded.withColumn("label", F.when(F.col("colour_code") > 8, 1).otherwise(0))
    return ml.assemble(ml.compress(labelled, ["label", *_CODES]), _CODES)


_CONFUSION = b.sql(f"SELECT label, CAST(label AS VARCHAR) AS predicted_label, count(*) AS n FROM {_SPLIT} GROUP BY label")


@query("A21_decision_tree_threshold", _CONFUSION)
def tree_threshold(spark: SparkSession, sf: str) -> DataFrame:
    rows = _threshold(spark, sf)
    out = ml.decision_tree_fit(rows, weight="weight").transform(rows)
    return out.groupBy("label", "predicted_label").agg(F.sum("weight").cast("bigint").alias("n"))


@query("A25_random_forest_threshold", _CONFUSION)
def forest_threshold(spark: SparkSession, sf: str) -> DataFrame:
    rows = _threshold(spark, sf)
    out = ml.random_forest_fit(rows, weight="weight").transform(rows)
    return out.groupBy("label", "predicted_label").agg(F.sum("weight").cast("bigint").alias("n"))


@query("A28_points_tree_threshold", _CONFUSION)
def points_threshold(spark: SparkSession, sf: str) -> DataFrame:
    rows = _threshold(spark, sf)
    out = ml.points_tree_fit(rows.withColumn("label", F.col("label").cast("double"))).transform(rows)
    guess = F.col("prediction").cast("int").cast("string").alias("predicted_label")
    return out.groupBy("label", guess).agg(F.sum("weight").cast("bigint").alias("n"))


@query(
    "A22_evaluate_given",
    b.sql(
        f"""SELECT round(accuracy, 6) AS accuracy, round(1 - accuracy, 6) AS error, round(auc, 6) AS auc FROM (
        SELECT sum(CASE WHEN (c > 10) = (l = 1) THEN n ELSE 0 END) / sum(n) AS accuracy FROM (
          SELECT colour_code AS c, label AS l, count(*) AS n FROM {_CODED} WHERE colour_code <> 0 GROUP BY ALL)),
        (SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM (SELECT pos, neg,
          coalesce(sum(neg) OVER (ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
          SELECT colour_code AS c, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
          FROM {_CODED} WHERE colour_code <> 0 GROUP BY colour_code)))"""
    ),
)
def evaluate_given(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy and area for a guess from the colour code alone."""
    coded = score.weak_label(score.encode_categories(b.goods(spark, sf), "colour", "kind"), "colour", "kind")
    counted = ml.compress(coded.where("colour_code != 0"), ["label", "colour_code"])
    code = F.col("colour_code").cast("double")
    rows = counted.select(
        F.col("label").cast("double").alias("indexed_label"),
        F.when(F.col("colour_code") > 10, 1.0).otherwise(0.0).alias("prediction"),
        ml.array_to_vector(F.array(-code, code)).alias("rawPrediction"),
        "weight",
    )
    report = ml.evaluate(rows, weight="weight")
    return report.select(*[F.round(c, 6).alias(c) for c in report.columns])


@query(
    "A26_naive_bayes_whole",
    b.sql(
        f"""WITH f AS (SELECT label, CAST(colour_code AS DOUBLE) AS c, CAST(type_code AS DOUBLE) AS t, count(*) AS n
          FROM {_CODED} JOIN ord ON goods_order = order_sn WHERE colour_code <> 0 AND type_code <> 0 GROUP BY ALL),
        m AS (SELECT label, ln((sum(n) + 1) / ((SELECT sum(n) FROM f) + 2)) AS pi,
          ln((sum(c * n) + 1) / (sum((c + t) * n) + 2)) AS tc, ln((sum(t * n) + 1) / (sum((c + t) * n) + 2)) AS tt FROM f GROUP BY label)
        SELECT round(accuracy, 6) AS accuracy, round(1 - accuracy, 6) AS error FROM (
        SELECT CAST(sum(CASE WHEN label = guess THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS accuracy FROM (
          SELECT f.label, f.n, arg_max(m.label, pi + f.c * tc + f.t * tt) AS guess FROM f, m GROUP BY f.label, f.c, f.t, f.n))"""
    ),
)
def naive_bayes_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted to all goods and judged on them."""
    rows = ml.assemble(ml.compress(_shop(spark, sf), ["label", *_CODES]), _CODES)
    report = ml.evaluate(ml.naive_bayes_fit(rows, weight="weight").transform(rows), auc=False, weight="weight")
    return report.select(F.round("accuracy", 6).alias("accuracy"), F.round("error", 6).alias("error"))


@query("A24_bisecting_sweep")
def bisecting(spark: SparkSession, sf: str) -> DataFrame:
    return ml.bisecting_sweep(_scored_points(spark, sf), range(2, 11), weight="weight")


@query("A25_random_forest")
def random_forest(spark: SparkSession, sf: str) -> DataFrame:
    with ml.kept(_shop_points(spark, sf, 0.7)) as points:
        model = ml.random_forest_fit(points.where("train"), weight="weight")
        return ml.evaluate(model.transform(points.where("not train")), weight="weight")


@query("A26_naive_bayes")
def naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    with ml.kept(_shop_points(spark, sf, 0.6)) as points:
        model = ml.naive_bayes_fit(points.where("train"), weight="weight")
        return ml.evaluate(model.transform(points.where("not train")), auc=False, weight="weight")


@query("A27_pca")
def pca(spark: SparkSession, sf: str) -> DataFrame:
    rows = ml.vectors(b.table(spark, sf, "embeddings"), "embedding")
    v = ml.as_array("projected")
    return ml.pca_project(rows, 3).select("vec_id", v[0].alias("c1"), v[1].alias("c2"), v[2].alias("c3"))


@query(
    "A27_pca_rotation",
    """SELECT vec_id, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)), 4) AS square FROM embeddings""",
)
def pca_rotation(spark: SparkSession, sf: str) -> DataFrame:
    """All 64 components only turn a vector: its length stays."""
    rows = ml.vectors(b.table(spark, sf, "embeddings"), "embedding")
    turned = ml.pca_project(rows, 64).select("vec_id", ml.as_array("projected").alias("v"))
    return turned.select("vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 4).alias("square"))


@query("A28_points_tree")
def points_tree(spark: SparkSession, sf: str) -> DataFrame:
    rows = ml.vectors(b.table(spark, sf, "embeddings").withColumn("label", F.col("label").cast("double")), "embedding")
    train, test = ml.split(rows, [0.7, 0.3], "vec_id")
    return ml.evaluate(ml.points_tree_fit(train).transform(test), label="label", auc=False)


@query("K6_save_load_model", b.sql(f"SELECT count(*) AS users, 3 AS clusters, 3 AS loaded FROM {_RFM}"))
def save_load(spark: SparkSession, sf: str) -> DataFrame:
    """Fit and store on the first call, load on the second."""
    rows = ml.assemble(rfm(spark, sf), ["recency", "frequency"])
    path = shared_dir(spark, "model")
    fitted = load_or_fit(spark, path, lambda: ml.kmeans_fit(rows, 3))
    loaded = load_or_fit(spark, path, lambda: ml.kmeans_fit(rows, 5))
    return loaded.transform(rows).agg(F.count("*").alias("users")).select(
        "users",
        F.lit(len(fitted.clusterCenters())).alias("clusters"),
        F.lit(len(loaded.clusterCenters())).alias("loaded"),
    )
