"""Bands as a table: the first band that holds a value, for any number of bands and values.

The bounds of all bands cut the numbers into stretches. A band covers a run of them, and a
run is a few blocks of a power of two stretches each, so the bands become rows by block, the
first band of a block is one aggregate, and the tag of a stretch is the first of the blocks
around it. No list of bands is held anywhere, and bands may overlap as they like.

Values and stretches are then dealt together into ranges of about equal size, whose borders
are quantiles of both. Each range starts with the stretch that is open at its border, and
one ordered pass gives every value the last stretch begun before it. A value that fills
several ranges by itself, as a third of all rows may, is spread over as many tasks.
"""

from __future__ import annotations

from math import inf

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tagloom.session import stored

_NUM, _UNIT = r"(-?\d+(?:\.\d+)?)", r"(?:second|day)?"
EXACT = "decimal(38,10)"


def band_table(rules: DataFrame, rule: str = "rule", tag: str = "tag_id", order: str = "order") -> DataFrame:
    """Rule texts as bands ``(tag_id, place, lo, hi, lo_open, hi_open)``, in the grammar of
    ``specs.parse_band``; other texts are an error. ``place`` orders them: rules without an
    order first, then by order, then by tag."""
    text = F.trim(F.col(rule))
    forms = rf"^(?:(>=|>|<=|<)?{_NUM}{_UNIT}|(<)?{_NUM}{_UNIT}[-~]{_NUM}{_UNIT})$"
    parts = [F.regexp_extract(text, forms, i) for i in range(1, 6)]
    place = F.struct(F.col(order).isNotNull().alias("ordered"), F.coalesce(F.col(order), F.lit(0)).cast("bigint").alias("at"), F.col(tag).cast("bigint").alias("id"))
    # a generator's columns are made once, however often they are used
    row = F.struct(text.alias("text"), place.alias("place"), *[x.alias(n) for n, x in zip(("sign", "x", "below", "a", "b"), parts)])
    read = rules.select(F.inline(F.array(row)))
    sign, x, a, b_ = (F.col(c) for c in ("sign", "x", "a", "b"))
    plain = F.col("text").rlike(rf"^{_NUM}$")
    within = F.col("text").rlike(r"^\d+day$")
    wrong = F.raise_error(F.concat(F.lit("not a band rule: "), F.coalesce("text", F.lit("null")))).cast("string")
    lo = (
        F.when(sign.startswith(">"), x)
        .when(sign.startswith("<") | within | (F.col("below") != ""), None)
        .when(a != "", a)
        .when(plain, x)
        .otherwise(wrong)
    )
    hi = F.when(sign.startswith("<") | within, x).when(sign.startswith(">"), None).when(a != "", b_).when(plain, x)
    return read.select(
        F.col("place.id").alias("tag_id"),
        "place",
        lo.cast(EXACT).alias("lo"),
        hi.cast(EXACT).alias("hi"),
        (sign == ">").alias("lo_open"),
        (sign == "<").alias("hi_open"),
    )


def _keys(bands: DataFrame, kind: str) -> DataFrame:
    """Bands as half-open runs ``from .. to`` of points ``(number, just above it or not)``;
    null is unbounded, a band with ``lo > hi`` is two runs, an empty one is none."""
    lo, hi = F.col("lo").cast(kind), F.col("hi").cast(kind)

    def point(number: Column, above: Column) -> Column:
        return F.when(number.isNotNull(), F.struct(number.alias("k"), above.cast("int").alias("s")))

    start, stop = point(lo, F.col("lo_open")), point(hi, ~F.col("hi_open"))
    none = F.lit(None).cast(T.StructType.fromDDL(f"k {kind}, s int"))
    run = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    runs = F.when(F.coalesce(lo > hi, F.lit(False)), F.array(run(none, stop), run(start, none))).otherwise(F.array(run(start, stop)))
    out = bands.select("tag_id", "place", F.explode(runs).alias("r")).select("tag_id", "place", "r.a", "r.b")
    return out.where(F.coalesce(F.col("a") < F.col("b"), F.lit(True)))


class _Ranges:
    """Borders between ranges, and how many tasks share the one that a border opens."""

    def __init__(self, points: DataFrame, parts: int) -> None:
        shares = [i / parts for i in range(1, parts)]
        found = points.agg(F.percentile_approx("d", shares, max(10_000, 20 * parts))).first()[0] if shares else None
        cuts = [x for x in found or [] if abs(x) != inf]
        self.borders = sorted(set(cuts))
        self.shares = [1, *[cuts.count(x) for x in self.borders]]

    def dealt(self, df: DataFrame) -> DataFrame:
        """Adds ``range``; ``d`` has no NaN."""
        if not self.borders:
            return df.withColumn("range", F.lit(0))
        cut = Bucketizer(splits=[-inf, *self.borders, inf], inputCol="d", outputCol="_range")
        return cut.transform(df).withColumn("range", F.col("_range").cast("int")).drop("_range")

    def tasks(self) -> Column:
        """Number of tasks of a range."""
        return F.element_at(F.array(*[F.lit(n) for n in self.shares]), F.col("range") + 1)


def _ranked(points: DataFrame, ranges: _Ranges) -> DataFrame:
    """Different points numbered from 1 in order."""
    dealt = ranges.dealt(points.distinct().withColumn("d", F.col("p.k").cast("double")))
    counts = dealt.groupBy("range").agg(F.count("*").alias("n"))
    # one row a range
    before = counts.withColumn("before", F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("range", F.coalesce("before", F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("range").orderBy("p"))
    numbered = dealt.withColumn("_at", local).join(F.broadcast(before), "range")
    return numbered.select("p", "range", (F.col("before") + F.col("_at")).alias("rank"))


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(F.struct("place", "tag_id")).alias("first")).select(*keys, "first.place", "first.tag_id")


def _winners(runs: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(rank, tag_id)``: the first band over the stretch that begins at a point (0: before
    all points); stretches without a band are missing."""
    a = ranked.select(F.col("p").alias("a"), F.col("rank").alias("ra"))
    b = ranked.select(F.col("p").alias("b"), F.col("rank").alias("rb"))
    points = ranked.count()
    levels = F.sequence(F.lit(0), F.lit(points.bit_length()))
    # an unbounded end lies behind every point
    covered = runs.join(a, "a", "left").join(b, "b", "left").select(
        "tag_id", "place", F.coalesce("ra", F.lit(0)).cast("bigint").alias("l"), F.coalesce("rb", F.lit(points + 1)).cast("bigint").alias("r")
    )

    def halved(x: Column, t: Column) -> Column:
        return F.call_function("shiftright", x, t)

    def blocks(t: Column) -> Column:
        """Of size 2 ** t, the ones at the ends of a run that no greater one covers."""
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), t)
        left, right = halved(F.col("l") + size - 1, t), halved(F.col("r"), t)
        ends = [
            F.when((left < right) & (odd % 2 == 1), F.struct(t.alias("level"), at.alias("block")))
            for odd, at in ((left, left), (right, right - 1))
        ]
        return F.array_compact(F.array(*ends))

    nodes = covered.select("tag_id", "place", F.explode(F.flatten(F.transform(levels, blocks))).alias("n"))
    nodes = _first(nodes.select("tag_id", "place", "n.level", "n.block"), "level", "block")
    around = ranked.select("rank").unionByName(ranked.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("rank")))
    around = around.select(
        "rank",
        F.explode(F.transform(levels, lambda t: F.struct(t.alias("level"), halved(F.col("rank"), t).alias("block")))).alias("n"),
    ).select("rank", "n.*")
    return _first(around.join(nodes, ["level", "block"]), "rank").select("rank", "tag_id")


def interval_tag(df: DataFrame, key: str, value: str, bands: DataFrame, out: str = "tag_id", parts: int | None = None) -> DataFrame:
    """``(key, tag)`` for every row: the tag of the first band, by place, that holds its
    value; null where none does or the value is null. NaN counts as greater than any number,
    so only bands without an upper bound hold it. Whole numbers and decimals are compared
    exactly, others as doubles. Repeated rows stay.

    ``bands`` is a table as ``band_table`` makes it. ``parts`` is the number of ranges, by
    default the session's shuffle partitions; it changes no answer.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = isinstance(df.schema[value].dataType, (T.IntegralType, T.DecimalType))
    kind = EXACT if whole else "double"
    given = df.select(F.col(key).alias("_key"), F.col(value).cast(kind).alias("k"))
    if not whole:
        given = given.withColumn("k", F.when(F.isnan("k"), float("inf")).otherwise(F.col("k")))
    runs = stored(_keys(bands, kind), "runs")
    points = runs.select(F.explode(F.array("a", "b")).alias("p")).where("p is not null")
    numbers = given.where("k is not null").select(F.col("k").cast("double").alias("d"))
    ranges = _Ranges(numbers.unionByName(points.select(F.col("p.k").cast("double").alias("d"))), parts)
    ranked = stored(_ranked(points, ranges), "points")
    won = stored(_winners(runs, ranked), "stretches")
    # what is open at a range's border: the last stretch of the ranges before it
    starts = ranked.join(won, "rank", "left").select("range", "p", "rank", F.struct("tag_id").alias("won"))
    lasts = starts.groupBy("range").agg(F.max_by("won", "rank").alias("won"))
    none = F.lit(None).cast("struct<tag_id:bigint>")
    first = won.where("rank = 0").select(F.lit(-1).alias("range"), F.struct("tag_id").alias("won"))
    all_ranges = spark.range(len(ranges.borders) + 1).select(F.col("id").cast("int").alias("range"))
    known = all_ranges.join(lasts, "range", "left").unionByName(first)  # one row a range
    open_ = F.last("won", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    carried = known.select("range", open_.alias("won")).where("range >= 0")
    point = f"struct<k:{kind},s:int>"
    begun = starts.select("range", "p", "won").unionByName(carried.select("range", F.lit(None).cast(point).alias("p"), "won"))
    begun = begun.select(
        "range", F.explode(F.sequence(F.lit(0), ranges.tasks() - 1)).alias("lane"), F.col("p.k").alias("k"), F.col("p.s").alias("s"),
        F.lit(0).alias("is_value"), F.lit(None).cast(given.schema["_key"].dataType).alias("_key"), "won",
    )
    asked = ranges.dealt(given.where("k is not null").withColumn("d", F.col("k").cast("double"))).select(
        "range", F.pmod(F.xxhash64("_key"), ranges.tasks()).cast("int").alias("lane"), "k", F.lit(0).alias("s"),
        F.lit(1).alias("is_value"), "_key", none.alias("won"),
    )
    order = Window.partitionBy("range", "lane").orderBy(F.col("k").asc_nulls_first(), "s", "is_value")
    held = F.last("won", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    told = begun.unionByName(asked).withColumn("_held", held).where("is_value = 1")
    told = told.select(F.col("_key").alias(key), F.col("_held.tag_id").alias(out))
    return told.unionByName(given.where("k is null").select(F.col("_key").alias(key), F.lit(None).cast("bigint").alias(out)))
