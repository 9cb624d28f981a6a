import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.operators import ml
from tagloom.specs import Rule


@pytest.fixture(scope="module")
def points(spark):
    """Four tight pairs on the diagonal."""
    data = [(i, Vectors.dense([v, v])) for i, v in enumerate([0.1, 0.3, 10.1, 10.3, 20.1, 20.3, 30.1, 30.3])]
    return spark.createDataFrame(data, ["id", "features"])


def test_kmeans_pairs(points):
    model = ml.kmeans_fit(points, 4, seed=1, max_iter=20)
    got = {r["id"]: r["prediction"] for r in model.transform(points).collect()}
    assert all(got[i] == got[i + 1] for i in range(0, 8, 2)) and len(set(got.values())) == 4
    assert model.summary.trainingCost == pytest.approx(0.16)


def test_sweep_bends_at_the_true_number(points):
    sweep = ml.kmeans_sweep(points, range(2, 7), seed=1, max_iter=20)
    costs = {r["k"]: r["cost"] for r in sweep.collect()}
    assert costs[4] == pytest.approx(0.16) and costs[2] > costs[3] > costs[4]
    assert sweep.where("second_diff is null").count() == 2
    assert ml.best_k(sweep.where("k >= 3")) == 4
    bisecting = {r["k"]: r["cost"] for r in ml.bisecting_sweep(points, [2, 4], seed=1).collect()}
    assert bisecting[4] == pytest.approx(0.16)


def test_weights_stand_for_repeated_rows(spark):
    data = [(float(x), float(y)) for x, y in [(0, 0)] * 30 + [(1, 0)] * 10 + [(9, 9)] * 5 + [(9, 8)] * 20]
    df = spark.createDataFrame(data, "x double, y double")
    small = ml.compress(df, ["x", "y"])
    assert small.count() == 4 and small.agg(F.sum("weight")).first()[0] == 65
    whole = ml.kmeans_fit(ml.assemble(df, ["x", "y"]), 2, max_iter=20)
    short = ml.kmeans_fit(ml.assemble(small, ["x", "y"]), 2, max_iter=20, weight="weight")
    centers = [sorted(tuple(c) for c in m.clusterCenters()) for m in (whole, short)]
    assert np.allclose(*centers)
    assert whole.summary.trainingCost == pytest.approx(short.summary.trainingCost)


def test_rank_follows_the_center_sum_and_ties_the_number(spark, points):
    centers = ml.small_table(spark, [(0, [1.0, 2.0]), (1, [5.0, 0.0]), (2, [3.0, 0.0])], "prediction int, center array<double>")
    got = {r["prediction"]: r["rank"] for r in ml.rank_clusters(centers).collect()}
    assert got == {1: 1, 0: 2, 2: 3}
    tags = ml.cluster_tags(points, "id", ml.kmeans_fit(points, 4, seed=1), [Rule(12, "", 2), Rule(11, "", 1), Rule(13, "", 3), Rule(14, "", 4)])
    assert {r["id"]: r["tag_id"] for r in tags.collect()} == {0: 14, 1: 14, 2: 13, 3: 13, 4: 12, 5: 12, 6: 11, 7: 11}


def test_fewer_clusters_than_tags(spark, points):
    few = points.where("id < 4")
    model = ml.kmeans_fit(few.select("id", F.col("features")), 7, seed=1)
    tags = ml.cluster_tags(few, "id", model, [Rule(i, "", i) for i in range(1, 8)])
    assert tags.count() == 4 and tags.where("tag_id is null").count() == 0


def test_assemble_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    assert ml.assemble(df, ["a", "b"]).count() == 1


def test_norms(spark):
    data = [(0, [1.0, 0.1, -8.0]), (1, [2.0, 1.0, -4.0]), (2, [4.0, 10.0, 8.0]), (3, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "id int, v array<double>")
    for p, norms in ((1.0, [9.1, 7, 22, 1]), (float("inf"), [8, 4, 10, 1])):
        arrays = [r[0] for r in df.orderBy("id").select(ml.normalize_array(F.col("v"), p)).collect()]
        vectors = [r[0] for r in ml.normalize(ml.vectors(df, "v"), p).orderBy("id").select(ml.as_array("normed")).collect()]
        want = [[x / n for x in v] for (_, v), n in zip(data, norms)]
        assert np.allclose(arrays, want) and np.allclose(vectors, want)


def test_minmax(spark):
    df = ml.assemble(spark.createDataFrame([(1.0, 5.0), (3.0, 7.0), (2.0, 9.0)], "a double, b double"), ["a", "b"])
    got = [r[0] for r in ml.scale_minmax(df).orderBy("a").select(ml.as_array("scaled")).collect()]
    assert got == [[0.0, 0.0], [0.5, 1.0], [1.0, 0.5]]


def test_pca_against_numpy(spark):
    data = np.array([[0, 1.0, 0, 7.0, 0], [2.0, 0, 3.0, 4.0, 5.0], [4.0, 0, 0, 6.0, 7.0]])
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(data)], ["id", "features"])
    got = np.array([r[0] for r in ml.pca_project(df, 2).orderBy("id").select(ml.as_array("projected")).collect()])
    _, vectors = np.linalg.eigh(np.cov(data.T))
    want = data @ vectors[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)


# Fixed values, the published sample as it is: label and (age, looks, income, civil servant), met or not.
TRAIN = [
    (0, 32, 1, 1, 0), (0, 25, 1, 2, 0), (1, 29, 1, 2, 1), (1, 24, 1, 1, 0), (0, 31, 1, 1, 0), (1, 35, 1, 2, 1),
    (0, 30, 0, 1, 0), (0, 31, 1, 1, 0), (1, 30, 1, 2, 1), (1, 21, 1, 1, 0), (0, 21, 1, 2, 0), (1, 21, 1, 2, 1),
    (0, 29, 0, 2, 1), (0, 29, 1, 0, 1), (0, 29, 0, 2, 1), (1, 30, 1, 1, 0),
]
TEST = [(0, 32, 1, 2, 0), (1, 27, 1, 1, 1), (1, 29, 1, 1, 0), (1, 25, 1, 2, 1), (0, 23, 0, 2, 1)]


def test_tree_on_labelled_points(spark):
    data = [(float(label), Vectors.dense(x)) for label, *x in TRAIN]
    df = spark.createDataFrame(data, ["label", "features"])
    model = ml.points_tree_fit(df)
    report = ml.evaluate(model.transform(df), label="label").first()
    assert report["accuracy"] == 1.0 and report["error"] == 0.0 and report["auc"] == 1.0
    unseen = spark.createDataFrame([(float(label), Vectors.dense(x)) for label, *x in TEST], ["label", "features"])
    report = ml.evaluate(model.transform(unseen), label="label").first()
    assert report["error"] == pytest.approx(1 - report["accuracy"]) and 0.4 <= report["accuracy"] <= 1.0


def _grid(spark):
    """Two classes split by a corner of a grid, each cell several times."""
    data = [(x, y, int(x > 4 and y > 2)) for x in range(1, 10) for y in range(1, 6) for _ in range(1 + (x + y) % 3)]
    return spark.createDataFrame(data, "x int, y int, label int").withColumn("id", F.monotonically_increasing_id())


@pytest.mark.parametrize("fit", [ml.decision_tree_fit, ml.random_forest_fit])
def test_trees_learn_the_grid_with_and_without_weights(spark, fit):
    df = _grid(spark)
    plain = fit(ml.assemble(df, ["x", "y"]))
    heavy = fit(ml.assemble(ml.compress(df, ["x", "y", "label"]), ["x", "y"]), weight="weight")
    for model in (plain, heavy):
        out = model.transform(ml.assemble(df, ["x", "y"]))
        assert out.where("cast(predicted_label as int) = label").count() >= 0.95 * df.count()
        assert ml.evaluate(out).first()["auc"] > 0.95


def test_naive_bayes(spark):
    data = [(0, Vectors.dense([9.0, 1.0]))] * 10 + [(1, Vectors.dense([1.0, 9.0]))] * 10
    df = spark.createDataFrame(data, ["label", "features"])
    out = ml.naive_bayes_fit(df).transform(df)
    assert ml.evaluate(out, auc=False).first()["accuracy"] == 1.0


def test_split_depends_on_the_key_only(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 700)
    a, b = ml.split(df, [0.7, 0.3], "g")
    assert a.count() + b.count() == 2000
    assert a.select("g").intersect(b.select("g")).count() == 0
    again, _ = ml.split(df.repartition(5), [0.7, 0.3], "g")
    assert a.exceptAll(again).count() == 0
    assert 0.6 < a.count() / 2000 < 0.8


def test_cluster_stats(spark):
    df = spark.createDataFrame([(0, 1, 2), (0, 5, 5), (1, 0, 1)], "prediction int, a int, b int")
    assert [tuple(r) for r in ml.cluster_stats(df, ["a", "b"]).collect()] == [(0, 3, 10), (1, 1, 1)]


def test_train_then_predict(spark, tmp_path):
    from tagloom.plans import training

    data = [(i, float(i % 3) * 10, float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(data, "u int, a double, b double")
    path = str(tmp_path / "model")
    training.train(df, ["a", "b"], 3, path)
    tags = training.predict(df, "u", ["a", "b"], path, [Rule(t, "", i) for i, t in enumerate((7, 8, 9), 1)])
    assert {r["tag_id"] for r in tags.where("u % 3 = 2").collect()} == {7}
    assert {r["tag_id"] for r in tags.where("u % 3 = 0").collect()} == {9}
    assert tags.count() == 90


def test_points_have_one_layout_and_are_released(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    layouts = []
    for parts in (1, 64):
        with ml.kept(df.repartition(parts), parts=5) as held:
            assert held.storageLevel.useMemory
            layouts.append(held.select(F.spark_partition_id(), F.monotonically_increasing_id(), "id").collect())
        assert not held.storageLevel.useMemory
    assert sorted(layouts[0]) == sorted(layouts[1]) and len({r[0] for r in layouts[0]}) == 5


@pytest.mark.parametrize("fit", ["cluster", "sweep"])
def test_clusters_do_not_depend_on_the_layout(spark, fit):
    data = spark.range(1500).select("id", *[(F.hash("id", F.lit(i)) % 100).cast("double").alias(c) for i, c in enumerate("abc")])
    counted = ml.compress(data, ["a", "b", "c"])
    found = []
    for parts, coalesce in ((4, "true"), (8, "false"), (32, "false")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        try:
            points = ml.assemble(counted.repartition(parts, "a"), ["a", "b", "c"])
            if fit == "sweep":
                # partial sums of the cost meet in the order the tasks end
                costs = [r["cost"] for r in ml.kmeans_sweep(points, range(2, 5), weight="weight").collect()]
                found.append([round(c, 4) for c in costs])
            else:
                model = ml.kmeans_fit(points, 6, weight="weight")
                found.append([c.tolist() for c in model.clusterCenters()])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found[0] == found[1] == found[2]


def test_equal_points_are_counted_before_a_fit(spark):
    """A third of the points is one value: one row with its weight; the model follows neither
    the layout of the input nor the number of shuffle partitions, and costs what a fit of all rows costs."""
    from pyspark.ml.clustering import KMeans

    rows = [(i, 5.0 if i % 3 == 0 else float(i % 100) + 200 * (i % 2), float(i % 7)) for i in range(9000)]
    df = ml.assemble(spark.createDataFrame(rows, "id long, x double, y double"), ["x", "y"])
    points, weight = ml.counted(df, "features")
    assert points.count() < 800 and points.agg(F.sum(weight)).first()[0] == 9000
    with ml.kept(points, parts=4) as held:
        assert held.rdd.getNumPartitions() == 4
        assert max(len(p) for p in held.rdd.glom().collect()) < 400
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (4, 8, 32):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            model = ml.kmeans_fit(df.repartition(n), 3)
            seen.append(sorted(tuple(round(float(x), 9) for x in c) for c in model.clusterCenters()))
            more = ml.kmeans_fit(df.repartition(n), 3, parts=n)
            assert len(more.clusterCenters()) == 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
    whole = KMeans(k=3, seed=10, maxIter=10).fit(df).summary.trainingCost
    assert ml.kmeans_fit(df, 3).summary.trainingCost <= 1.1 * whole
