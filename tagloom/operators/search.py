"""Questions over profiles: who has which tags, how many, and one user's portrait."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.functions.columns import classify_account, mask, mask_name
from tagloom.operators.catalog import leaf_paths, leaf_tags, small_tree
from tagloom.operators.profile import explode_profile
from tagloom.session import BROADCAST_ROWS, broadcast_if, is_small, small_table


def _ids(ids: Sequence[int]) -> Column:
    return F.array(*[F.lit(i).cast("bigint") for i in ids])


def users_by_tags_any(profile: DataFrame, tags: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Users holding any level-5 tag at or below the ids, once each."""
    pairs = explode_profile(profile)
    wanted = broadcast_if(small_tree(tags), leaf_tags(tags, ids))
    return pairs.join(wanted, "tag_id", "left_semi").select("user_id").distinct()


def page(df: DataFrame, order: Sequence[str], number: int, size: int) -> DataFrame:
    """One page; the order must be total. Spark keeps only the rows up to its end."""
    return df.orderBy(*order).offset(max(0, (number - 1) * size)).limit(size)


def users_by_tags_all(
    profile: DataFrame, basic: Sequence[int], merge: Sequence[int] = (), merge_column: str = "merge_ids"
) -> DataFrame:
    """Users holding all basic and all composite tags: a test on the profile row."""
    test = F.size(F.array_except(_ids(basic), F.col("tag_ids"))) == 0 if basic else F.lit(True)
    if merge:
        test = test & (F.size(F.array_except(_ids(merge), F.col(merge_column))) == 0)
    return profile.where(test).select("user_id")


def users_by_tags_all_pairs(pairs: DataFrame, ids: Sequence[int], user: str = "user_id") -> DataFrame:
    """The same over ``(user, tag)`` rows."""
    wanted = sorted(set(ids))
    return (
        pairs.where(F.col("tag_id").isin(*wanted))
        .groupBy(user)
        .agg(F.countDistinct("tag_id").alias("_n"))
        .where(F.col("_n") == len(wanted))
        .select(user)
    )


def users_by_tag(profile: DataFrame, tag_id: int, tag_type: int, n: int, merge_column: str = "merge_ids") -> DataFrame:
    """First n users of a basic (1) or composite (2) tag; no other type has any."""
    column = {1: "tag_ids", 2: merge_column}.get(tag_type)
    if column is None:
        return profile.where(F.lit(False)).select("user_id")
    held = F.array_contains(column, F.lit(tag_id).cast("bigint"))
    return profile.where(held).select("user_id").orderBy("user_id").limit(n)


def count_users_by_tags(profile: DataFrame, basic: Sequence[int], merge: Sequence[int] = ()) -> DataFrame:
    return users_by_tags_all(profile, basic, merge).agg(F.count("*").alias("users"))


def tag_user_count(profile: DataFrame, tag_type: int = 1) -> DataFrame:
    """Users per tag. A profile row lists a tag once, so counting rows is exact and
    needs no distinct; partial counts keep a popular tag to one row per task."""
    pairs = explode_profile(profile)
    return pairs.groupBy("tag_id").agg(F.count("*").alias("user_count")).select(
        "tag_id", F.lit(tag_type).alias("tag_type"), "user_count"
    )


def stored_tag_count(counts: DataFrame, tag_ids: Sequence[int], tag_type: int) -> DataFrame:
    """Stored counts read back by tag and type, 0 where nothing is stored."""
    wanted = small_table(counts.sparkSession, [(i,) for i in tag_ids], "tag_id bigint")
    sums = (
        counts.where((F.col("tag_type") == tag_type) & F.col("tag_id").isin(*tag_ids))
        .groupBy("tag_id")
        .agg(F.sum("user_count").alias("_n"))
    )
    return wanted.join(sums, "tag_id", "left").select("tag_id", F.coalesce("_n", F.lit(0)).alias("user_count"))


def tag_count_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(tag_id, change)``: how the users per tag differ between two versions of a profile.

    A user's row is compared with itself: tags that came count one more, tags that went one
    less, and users whose tags stayed send nothing on. Each version has a user once.
    """
    none = F.array().cast("array<bigint>")
    before = old.where("user_id is not null").select("user_id", F.col("tag_ids").alias("_old"))
    after = new.where("user_id is not null").select("user_id", F.col("tag_ids").alias("_new"))
    both = before.join(after, "user_id", "full_outer").select(F.coalesce("_old", none).alias("_old"), F.coalesce("_new", none).alias("_new"))
    changed = F.concat(
        F.transform(F.array_except("_new", "_old"), lambda t: F.struct(t.alias("tag_id"), F.lit(1).alias("n"))),
        F.transform(F.array_except("_old", "_new"), lambda t: F.struct(t.alias("tag_id"), F.lit(-1).alias("n"))),
    )
    rows = both.select(F.explode(changed).alias("c")).where("c.tag_id is not null")
    return rows.groupBy("c.tag_id").agg(F.sum("c.n").alias("change")).where("change != 0")


def updated_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored counts with the changes added; tags that nobody has any more go."""
    kinds = counts.select("tag_id", "tag_type", "user_count")
    moved = changes.select(F.col("tag_id").alias("_tag"), "change")
    total = F.coalesce("user_count", F.lit(0)) + F.coalesce("change", F.lit(0))
    return (
        kinds.join(moved, F.col("tag_id") == F.col("_tag"), "full_outer")
        .select(F.coalesce("tag_id", "_tag").alias("tag_id"), F.coalesce("tag_type", F.lit(1)).alias("tag_type"), total.alias("user_count"))
        .where("user_count > 0")
    )


def all_user_count(profile: DataFrame) -> DataFrame:
    """Sum of the per-tag counts, and how many users hold any tag at all."""
    return profile.agg(
        F.coalesce(F.sum(F.size(F.array_distinct("tag_ids"))), F.lit(0)).cast("bigint").alias("user_count"),
        F.count(F.when(F.size("tag_ids") > 0, 1)).alias("covered_users"),
    )


def tag_share(profile: DataFrame) -> DataFrame:
    """Share of all users that hold each tag."""
    total = profile.agg(F.count("*").alias("n")).scalar()
    return tag_user_count(profile).select(
        "tag_id", "user_count", F.try_divide(F.col("user_count").cast("double"), total.cast("double")).alias("share")
    )


def top_users_per_tag(pairs: DataFrame, n: int = 5, user: str = "user_id") -> DataFrame:
    """First n users of each tag. Spark cuts every task's rows to n per tag before
    the shuffle, so a popular tag never travels whole."""
    order = Window.partitionBy("tag_id").orderBy(user)
    return (
        pairs.select("tag_id", user)
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= n)
    )


# ---------------------------------------------------------------- portraits


def portrait(pairs: DataFrame, tags: DataFrame, user: str = "user_id") -> DataFrame:
    """One row per user and level-5 tag with its whole path. A user holds a tag
    once, so the pairs need no distinct before the join."""
    paths = broadcast_if(small_tree(tags), leaf_paths(tags))
    return pairs.select(user, "tag_id").join(paths, "tag_id")


def portrait_tree(paths: DataFrame, user: str = "user_id", merges: DataFrame | None = None) -> DataFrame:
    """One row per user with a nested forest of their tags.

    The paths of a user come together once; the nesting is done inside the row. A path
    whose upper tags are missing begins at its highest known one, so unrelated broken paths
    stay apart. ``merges`` adds the user's composite tags.
    """
    node = "struct<id:bigint,name:string>"
    steps = [F.struct(F.col(f"l{i}").cast("bigint").alias("id"), F.col(f"l{i}_name").alias("name")) for i in range(1, 6)]
    known = F.filter(F.array(*steps), lambda n: n["id"].isNotNull())
    rows = (
        paths.select(user, known.alias("_path"))
        .groupBy(user)
        .agg(F.sort_array(F.collect_set("_path")).cast(f"array<array<{node}>>").alias("_paths"))
    )
    out = rows.select(user, _forest(F.col("_paths"), 1).alias("tags"))
    if merges is not None:
        lists = merges.groupBy(user).agg(F.sort_array(F.collect_set("merge_tag_id")).alias("merge_tags"))
        out = out.join(lists, user, "left")
    return out


def _forest(paths: Column, depth: int) -> Column:
    """Nodes at a depth of paths that share all above it, each with what is below."""
    nodes = F.array_distinct(F.transform(F.filter(paths, lambda p: F.size(p) >= depth), lambda p: F.get(p, F.lit(depth - 1))))
    if depth == 5:
        return nodes
    return F.transform(
        nodes,
        lambda node: F.struct(
            node["id"].alias("id"),
            node["name"].alias("name"),
            _forest(F.filter(paths, lambda p: F.get(p, F.lit(depth - 1))["id"] == node["id"]), depth + 1).alias("children"),
        ),
    )


def portrait_graph(paths: DataFrame, root: str = "user") -> DataFrame:
    """Edges of the force graph, root to level 5, with the number of children of each target
    and its category: the name its path begins with. A path whose upper tags are missing
    hangs with its highest known one on the root."""
    steps = []
    for i in range(1, 6):
        source_id = F.col(f"l{i - 1}") if i > 1 else F.lit(None).cast("bigint")
        source = F.col(f"l{i - 1}_name") if i > 1 else F.lit(None).cast("string")
        top = source_id.isNull()
        steps.append(
            F.struct(
                F.lit(i - 1).alias("depth"),
                F.when(top, F.lit(0).cast("bigint")).otherwise(source_id).alias("source_id"),
                F.when(top, F.lit(root)).otherwise(source).alias("source"),
                F.col(f"l{i}").alias("target_id"),
                F.col(f"l{i}_name").alias("target"),
                F.coalesce(*[F.when(F.col(f"l{j}").isNotNull(), F.col(f"l{j}_name")) for j in range(1, i + 1)]).alias("category"),
            )
        )
    edges = paths.select(F.explode(F.array(*steps)).alias("e")).where("e.target_id is not null").distinct()
    # an edge says something about both its ends: it describes its target and is
    # one more child of its source, so one aggregation by node gives both
    none = F.lit(None).cast(edges.schema["e"].dataType)
    target = F.struct(F.col("e.target_id").alias("node"), F.col("e").alias("edge"), F.lit(0).alias("child"))
    source = F.struct(F.col("e.source_id").alias("node"), none.alias("edge"), F.lit(1).alias("child"))
    ends = edges.select(F.explode(F.array(target, source)).alias("n")).select("n.*")
    return (
        ends.groupBy("node")
        .agg(F.max("edge").alias("edge"), F.sum("child").alias("children"))
        .where("edge is not null")
        .select("edge.*", "children")
    )


# ---------------------------------------------------------------- users


def lookup_users(numbers: DataFrame, users: DataFrame, number: str = "num") -> DataFrame:
    """Exact lookup of account numbers: classify, then match that kind of column.

    ``users`` has ``id, mobile, email, qq, id_card``. Each number is looked up once
    however often it was asked for, so a popular number is no heavy join key.
    """
    asked = numbers.select(F.col(number).alias("num")).distinct()
    asked = asked.select("num", classify_account(F.col("num")).alias("kind")).where("kind is not null")
    asked = broadcast_if(is_small(numbers), asked)
    accounts = users.select(
        F.col("id").alias("user_id"),
        F.explode(
            F.create_map(*[x for k in ("mobile", "email", "qq", "id_card") for x in (F.lit(k), F.col(k))])
        ).alias("kind", "num"),
    ).where("num is not null")
    return accounts.join(asked, ["kind", "num"]).select("num", "kind", "user_id")


def masked_users(users: DataFrame, name: str, hidden: Sequence[str]) -> DataFrame:
    """Users with shortened names and numbers hidden but for three characters at
    both ends."""
    return users.withColumns({name: mask_name(F.col(name)), **{c: mask(F.col(c)) for c in hidden}})


def user_details(
    found: DataFrame, users: DataFrame, name: str, hidden: Sequence[str], n: int, key: str = "id"
) -> DataFrame:
    """Masked rows of at most n found users; n tells whether to broadcast them."""
    wanted = broadcast_if(n <= BROADCAST_ROWS, found.select(F.col("user_id").alias(key)))
    return masked_users(users.join(wanted, key, "left_semi"), name, hidden)
