"""Scores: recency, frequency, money, activity, price sensitivity, shop gender."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.functions.columns import day, exact_sum, map_literal
from tagloom.operators.stats import band_column
from tagloom.specs import Rule, bands, close_gaps


def _score(value: Column, rules: Sequence[Rule], compat: bool) -> Column:
    table = bands(rules) if compat else close_gaps(bands(rules))
    return band_column(value, table, "int")


def rfm(orders: DataFrame, user: str, finished: str, order_id: str, amount: str, as_of: str) -> DataFrame:
    """Recency in days, number of orders and money spent per user."""
    return (
        orders.groupBy(user)
        .agg(
            F.max(finished).alias("_last"),
            F.count(order_id).alias("frequency"),
            exact_sum(orders, amount).alias("monetary"),
        )
        .select(user, F.datediff(day(as_of), F.to_date("_last")).alias("recency"), "frequency", "monetary")
    )


def rfm_score(
    features: DataFrame,
    recency: Sequence[Rule] = tuple(seeds.RFM_RECENCY),
    frequency: Sequence[Rule] = tuple(seeds.RFM_FREQUENCY),
    monetary: Sequence[Rule] = tuple(seeds.RFM_MONETARY),
    compat: bool = False,
) -> DataFrame:
    """Scores 1 to 5. ``compat`` takes the bands literally, holes included;
    otherwise each band reaches up to the next one."""
    return features.select(
        "*",
        _score(F.col("recency"), recency, compat).alias("r_score"),
        _score(F.col("frequency"), frequency, compat).alias("f_score"),
        _score(F.col("monetary"), monetary, compat).alias("m_score"),
    )


def rfe(logs: DataFrame, user: str, time: str, url: str, as_of: str) -> DataFrame:
    """Recency in days, page views and distinct pages per user."""
    return (
        logs.groupBy(user)
        .agg(
            F.max(time).alias("_last"),
            F.count(url).alias("frequency"),
            F.countDistinct(url).alias("engagements"),
        )
        .select(user, F.datediff(day(as_of), F.to_date("_last")).alias("recency"), "frequency", "engagements")
    )


def rfe_score(
    features: DataFrame,
    recency: Sequence[Rule] = tuple(seeds.RFE_RECENCY),
    frequency: Sequence[Rule] = tuple(seeds.RFE_FREQUENCY),
    engagement: Sequence[Rule] = tuple(seeds.RFE_ENGAGEMENT),
    compat: bool = False,
) -> DataFrame:
    return features.select(
        "*",
        _score(F.col("recency"), recency, compat).alias("r_score"),
        _score(F.col("frequency"), frequency, compat).alias("f_score"),
        _score(F.col("engagements"), engagement, compat).alias("e_score"),
    )


def drop_unscored(df: DataFrame, *scores: str) -> DataFrame:
    """Keep rows whose scores are all known."""
    return df.dropna(subset=list(scores))


def rfe_score_total(features: DataFrame) -> DataFrame:
    """Six-step scores and their sum; a user without page views scores 0 for them."""
    scored = rfe_score(
        features, seeds.SIX_RECENCY, seeds.SIX_FREQUENCY, seeds.SIX_ENGAGEMENT, compat=True
    )
    names = ("r_score", "f_score", "e_score")
    scored = scored.fillna(0, subset=list(names))
    return scored.withColumn("total", F.col("r_score") + F.col("f_score") + F.col("e_score"))


def activity_band(features: DataFrame, user: str, rules: Sequence[Rule], best: int = 18) -> DataFrame:
    """Six-step total as tenths of the best total, then its band."""
    tenths = F.floor(F.col("total") * 10 / F.lit(float(best)) + F.lit(0.5)) / F.lit(10.0)
    shares = rfe_score_total(features).select(user, "total", tenths.alias("share"))
    return shares.select(user, "total", "share", band_column(F.col("share"), bands(rules)).alias("tag_id"))


def psm(orders: DataFrame, user: str, paid: str, coupon: str, scale: int = 2) -> DataFrame:
    """Price sensitivity from discounted orders, saved money and their shares.

    score = dotn/otn + (dat/dotn)/(rat/otn) + dat/rat; a term that has no value
    counts 0. An order with a negative coupon is in no order count.
    """
    rows = orders.select(
        user,
        F.col(paid).alias("aa"),
        F.col(coupon).alias("da"),
        (F.col(paid) + F.col(coupon)).alias("ra"),
        F.when(F.col(coupon) > 0, 1).when(F.col(coupon) == 0, 0).alias("state"),
    )
    sums = rows.groupBy(user).agg(
        F.sum("state").alias("dotn"),
        F.count("state").alias("otn"),
        exact_sum(rows, "da", scale).alias("dat"),
        exact_sum(rows, "ra", scale).alias("rat"),
        exact_sum(rows, "aa", scale).alias("aat"),
    )
    return _psm_score(sums)


def psm_positive(orders: DataFrame, user: str, receivable: str, coupon: str, scale: int = 2) -> DataFrame:
    """Same score where only positive amounts count on either side."""
    rows = orders.select(
        user,
        F.when(F.col(receivable) > 0, F.col(receivable)).alias("ra"),
        F.when(F.col(coupon) > 0, F.col(coupon)).alias("da"),
    )
    sums = rows.groupBy(user).agg(
        F.count("da").alias("dotn"),
        F.count("ra").alias("otn"),
        F.coalesce(exact_sum(rows, "da", scale), F.lit(0.0)).alias("dat"),
        F.coalesce(exact_sum(rows, "ra", scale), F.lit(0.0)).alias("rat"),
    )
    return _psm_score(sums)


def psm_terms(dotn: Column, otn: Column, dat: Column, rat: Column) -> tuple[Column, Column, Column]:
    """The three terms of the score from its sums; a term without a value is 0."""
    zero = F.lit(0.0)
    dotn, otn, dat, rat = (c.cast("double") for c in (dotn, otn, dat, rat))
    share = F.coalesce(F.try_divide(dotn, otn), zero)
    single = F.coalesce(F.try_divide(F.try_divide(dat, dotn), F.try_divide(rat, otn)), zero)
    money = F.coalesce(F.try_divide(dat, rat), zero)
    return share, single, money


def _psm_score(sums: DataFrame) -> DataFrame:
    share, single, money = psm_terms(*[F.col(c) for c in ("dotn", "otn", "dat", "rat")])
    return sums.select("*", share.alias("dor"), single.alias("odr"), money.alias("dara")).withColumn(
        "score", F.col("dor") + F.col("odr") + F.col("dara")
    )


def psm_band(scored: DataFrame, user: str, rules: Sequence[Rule], score: str = "score") -> DataFrame:
    return scored.select(user, score, band_column(F.col(score), bands(rules)).alias("tag_id"))


# ---------------------------------------------------------------- shop gender


def lookup(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of a text from a fixed table, 0 if it has none."""
    return F.coalesce(map_literal(codes, "int")[value], F.lit(0))


def encode_categories(
    goods: DataFrame,
    colour: str,
    kind: str,
    colours: Mapping[str, int] = seeds.COLOUR_CODES,
    kinds: Mapping[str, int] = seeds.PRODUCT_TYPES,
) -> DataFrame:
    return goods.withColumns(
        {
            "colour_code": lookup(F.col(colour), colours),
            "type_code": lookup(F.col(kind), kinds),
        }
    )


def weak_label(
    goods: DataFrame,
    colour: str,
    kind: str,
    colours: Sequence[str] = seeds.FEMALE_COLOURS,
    kinds: Sequence[str] = seeds.FEMALE_TYPES,
) -> DataFrame:
    """1 where the colour or the type is one of the marked ones, else 0."""
    marked = F.coalesce(F.col(colour).isin(*colours), F.lit(False)) | F.coalesce(
        F.col(kind).isin(*kinds), F.lit(False)
    )
    return goods.withColumn("label", F.when(marked, 1).otherwise(0))


def shop_features(
    goods: DataFrame, orders: DataFrame, goods_order: str, order_id: str, member: str
) -> DataFrame:
    """Coded goods with the member who ordered them, codes as doubles."""
    known = goods.where("colour_code != 0 and type_code != 0")
    owners = orders.where(F.col(member).isNotNull()).select(member, order_id)
    return known.join(owners, F.col(goods_order) == F.col(order_id)).select(
        member,
        order_id,
        "label",
        F.col("colour_code").cast("double").alias("colour_code"),
        F.col("type_code").cast("double").alias("type_code"),
    )


def shop_gender_vote(
    predicted: DataFrame, user: str, label: str, rules: Sequence[Rule], share: float = 0.6
) -> DataFrame:
    """Tag of the gender that holds at least ``share`` of a user's goods, male first;
    users without such a majority have no row."""
    male, female = rules[0], rules[1]
    value = F.col(label).cast("int") + 1
    votes = predicted.groupBy(user).agg(
        F.count(F.when(value == int(male.text), 1)).alias("male"),
        F.count(F.when(value == int(female.text), 1)).alias("female"),
        F.count(label).alias("total"),
    )
    tag = F.when(F.try_divide(F.col("male"), F.col("total")) >= share, F.lit(male.tag_id)).when(
        F.try_divide(F.col("female"), F.col("total")) >= share, F.lit(female.tag_id)
    )
    return votes.withColumn("tag_id", tag.cast("bigint")).where("tag_id is not null")


def spend_power(orders: DataFrame, user: str, paid: str, order_id: str, amount: str) -> DataFrame:
    """Unscored features: last payment as epoch milliseconds, orders, money."""
    return (
        orders.groupBy(user)
        .agg(
            F.max(paid).alias("_last"),
            F.count(order_id).alias("frequency"),
            exact_sum(orders, amount).alias("monetary"),
        )
        .select(
            user, F.unix_millis(F.col("_last").cast("timestamp")).cast("double").alias("recency"), "frequency", "monetary"
        )
    )
