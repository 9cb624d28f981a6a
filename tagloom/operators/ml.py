"""Feature vectors, clusterings and classifiers on Spark ML.

Fitting reads its input many times, so the input is kept in memory and on disk
for that long; lost blocks are computed again from lineage. Scores and category
codes take few distinct values: ``compress`` counts equal rows first, and the
fits take the counts as weights, which is the same model from far fewer rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    PCA,
    IndexToString,
    MinMaxScaler,
    Normalizer,
    StringIndexer,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from tagloom.session import small_table
from tagloom.specs import Rule, in_order


# Partitions that a fit reads unless it is told otherwise. Random starts are drawn by
# partition and row, so a model is the same only where the layout is.
FIT_PARTITIONS = 16
COUNT = "_count"


@contextmanager
def kept(df: DataFrame, parts: int | None = None):
    """Data that a fit iterates over, released afterwards, in ``parts`` partitions
    (``FIT_PARTITIONS``, read when it is called).

    Rows are dealt by their values and put in order, whatever layout they come in:
    neither the number of shuffle partitions nor their sizes show in the model.
    """
    values = [vector_to_array(F.col(f.name)) if isinstance(f.dataType, VectorUDT) else F.col(f.name) for f in df.schema]
    order = [F.xxhash64(*values), *values]
    held = df.repartition(parts or FIT_PARTITIONS, order[0]).sortWithinPartitions(*order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


# ---------------------------------------------------------------- features


def compress(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Distinct rows over the columns with how often each occurs."""
    return df.groupBy(*columns).agg(F.count("*").cast("double").alias(weight))


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """One vector column; rows with a missing value are left out."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="skip").transform(df)


def vectors(df: DataFrame, array: str, out: str = "features") -> DataFrame:
    """Vector column from an array column."""
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def scale_minmax(df: DataFrame, features: str = "features", out: str = "scaled") -> DataFrame:
    """Every coordinate mapped to 0..1 by its own least and greatest value."""
    return MinMaxScaler(inputCol=features, outputCol=out).fit(df).transform(df)


def normalize(df: DataFrame, p: float, features: str = "features", out: str = "normed") -> DataFrame:
    return Normalizer(inputCol=features, outputCol=out, p=p).transform(df)


def normalize_array(values: Column, p: float) -> Column:
    """The same for an array column, without leaving generated code for vectors."""
    size = F.transform(values, F.abs)
    if p == float("inf"):
        norm = F.array_max(size)
    else:
        total = F.aggregate(size, F.lit(0.0), lambda acc, x: acc + F.pow(x, F.lit(float(p))))
        norm = total if p == 1.0 else F.pow(total, F.lit(1.0 / p))
    return F.transform(values, lambda x: F.when(norm == 0, x).otherwise(x / norm))


def pca_project(df: DataFrame, n: int, features: str = "features", out: str = "projected", parts: int | None = None) -> DataFrame:
    with kept(df.select(features), parts) as held:
        model = PCA(k=n, inputCol=features, outputCol=out).fit(held)
    return model.transform(df)


# ---------------------------------------------------------------- clusters


def counted(df: DataFrame, features: str, label: str | None = None, weight: str | None = None) -> tuple[DataFrame, str]:
    """Points to fit on and the name of their weight. Equal points are one with their count
    as weight, unless a weight is given, so one that a third of all rows hold is one row."""
    rest = [label] if label else []
    if weight:
        return df.select(features, *rest, weight), weight
    rows = df.groupBy(vector_to_array(F.col(features)).alias("_values"), *rest).agg(F.count("*").cast("double").alias(COUNT))
    return rows.select(array_to_vector("_values").alias(features), *rest, COUNT), COUNT


def kmeans_fit(
    df: DataFrame,
    k: int,
    seed: int = 10,
    max_iter: int = 10,
    features: str = "features",
    weight: str | None = None,
    parts: int | None = None,
) -> KMeansModel:
    points, weight = counted(df, features, weight=weight)
    with kept(points, parts) as held:
        return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, weightCol=weight).fit(held)


def centers_frame(spark: SparkSession, model) -> DataFrame:
    """Cluster centers as a table; k rows of a few numbers."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return small_table(spark, rows, "prediction int, center array<double>")


def rank_clusters(centers: DataFrame) -> DataFrame:
    """Clusters numbered from 1 by the sum of their center, greatest first.

    ``centers`` has one row per cluster, so the single window holds k rows.
    """
    total = F.aggregate("center", F.lit(0.0), lambda acc, x: acc + x)
    order = Window.orderBy(F.desc("center_sum"), "prediction")
    return centers.select("prediction", total.alias("center_sum")).withColumn(
        "rank", F.row_number().over(order)
    )


def cluster_to_tag(ranked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The i-th ranked cluster takes the i-th child tag; spare tags stay unused."""
    tags = [(i, r.tag_id) for i, r in enumerate(in_order(rules), start=1)]
    table = small_table(ranked.sparkSession, tags, "rank int, tag_id bigint")
    return ranked.join(F.broadcast(table), "rank").select("prediction", "center_sum", "rank", "tag_id")


def cluster_tags(df: DataFrame, user: str, model, rules: Sequence[Rule]) -> DataFrame:
    """``(user, prediction, tag)`` for assembled rows and a fitted clustering."""
    tags = cluster_to_tag(rank_clusters(centers_frame(df.sparkSession, model)), rules)
    return (
        model.transform(df)
        .select(user, "prediction")
        .join(F.broadcast(tags.select("prediction", "rank", "tag_id")), "prediction")
        .select(user, "prediction", "rank", "tag_id")
    )


def cluster_stats(predicted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest summed score per cluster."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return (
        predicted.groupBy("prediction")
        .agg(F.min(total).alias("min_score"), F.max(total).alias("max_score"))
        .orderBy("prediction")
    )


def _sweep(points: DataFrame, ks: Sequence[int], estimator, parallelism: int, parts: int | None) -> DataFrame:
    """Cost per k. The fits do not depend on each other, so a few run at a time
    over the same cached points, the way Spark's own cross validator does."""

    def cost(k: int) -> float:
        return float(estimator(k).fit(held).summary.trainingCost)

    with kept(points, parts) as held, ThreadPool(min(parallelism, len(ks))) as pool:
        costs = pool.map(inheritable_thread_target(points.sparkSession)(cost), ks)
    bend = [
        costs[i - 1] - 2 * costs[i] + costs[i + 1] if 0 < i < len(costs) - 1 else None
        for i in range(len(costs))
    ]
    return small_table(
        points.sparkSession, list(zip(ks, costs, bend)), "k int, cost double, second_diff double"
    )


def kmeans_sweep(
    df: DataFrame,
    ks: Sequence[int] = range(2, 11),
    seed: int = 10,
    max_iter: int = 10,
    features: str = "features",
    weight: str | None = None,
    parallelism: int = 8,
    parts: int | None = None,
) -> DataFrame:
    """Cost per k and how sharply the cost curve bends there."""

    points, weight = counted(df, features, weight=weight)

    def estimator(k: int):
        return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, weightCol=weight)

    return _sweep(points, list(ks), estimator, parallelism, parts)


def bisecting_sweep(
    df: DataFrame,
    ks: Sequence[int] = range(2, 11),
    seed: int = 10,
    max_iter: int = 20,
    features: str = "features",
    weight: str | None = None,
    parallelism: int = 8,
    parts: int | None = None,
) -> DataFrame:
    points, weight = counted(df, features, weight=weight)

    def estimator(k: int):
        return BisectingKMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, weightCol=weight)

    return _sweep(points, list(ks), estimator, parallelism, parts)


def best_k(sweep: DataFrame) -> int:
    """k at the sharpest bend; reads the sweep's handful of rows."""
    return sweep.where("second_diff is not null").orderBy(F.desc("second_diff"), "k").first()["k"]


# ---------------------------------------------------------------- classifiers


def _fit_trees(
    train: DataFrame, classifier, max_categories: int, label: str, features: str, weight: str | None, parts: int | None
) -> PipelineModel:
    """Label index, category index, trees, and the label of the prediction."""
    points, weight = counted(train, features, label, weight)
    with kept(points, parts) as held:
        labels = StringIndexer(inputCol=label, outputCol="indexed_label").fit(held)
        index = VectorIndexer(
            inputCol=features, outputCol="indexed_features", maxCategories=max_categories, handleInvalid="keep"
        ).fit(held)
        classifier.setLabelCol("indexed_label").setFeaturesCol("indexed_features")
        classifier.setWeightCol(weight)
        back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)
        return Pipeline(stages=[labels, index, classifier, back]).fit(held)


def draw(key: str, seed: int = 10) -> Column:
    """A random number from 0 to 1 that depends on the row's key alone, so a task
    that runs again draws the same."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1_000_000)) / F.lit(1_000_000.0)


def split(df: DataFrame, shares: Sequence[float], key: str, seed: int = 10) -> list[DataFrame]:
    """Random split by key."""
    number, total, parts, lo = draw(key, seed), float(sum(shares)), [], 0.0
    for i, share in enumerate(shares):
        hi = 1.0 if i == len(shares) - 1 else lo + share / total
        parts.append(df.where((number >= lo) & (number < hi)))
        lo = hi
    return parts


def decision_tree_fit(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    depth: int = 7,
    bins: int = 24,
    max_categories: int = 3,
    weight: str | None = None,
    parts: int | None = None,
) -> PipelineModel:
    tree = DecisionTreeClassifier(impurity="gini", maxDepth=depth, maxBins=bins)
    return _fit_trees(train, tree, max_categories, label, features, weight, parts)


def random_forest_fit(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    trees: int = 20,
    max_categories: int = 4,
    seed: int = 10,
    weight: str | None = None,
    parts: int | None = None,
) -> PipelineModel:
    forest = RandomForestClassifier(numTrees=trees, seed=seed)
    return _fit_trees(train, forest, max_categories, label, features, weight, parts)


def naive_bayes_fit(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    smoothing: float = 1.0,
    weight: str | None = None,
    parts: int | None = None,
) -> PipelineModel:
    labels = StringIndexer(inputCol=label, outputCol="indexed_label")
    points, weight = counted(train, features, label, weight)
    bayes = NaiveBayes(labelCol="indexed_label", featuresCol=features, smoothing=smoothing, weightCol=weight)
    with kept(points, parts) as held:
        return Pipeline(stages=[labels, bayes]).fit(held)


def points_tree_fit(
    train: DataFrame, label: str = "label", features: str = "features", weight: str | None = None, parts: int | None = None
):
    """Tree on labelled points: depth 5, 32 bins."""
    points, weight = counted(train, features, label, weight)
    tree = DecisionTreeClassifier(
        labelCol=label, featuresCol=features, weightCol=weight, impurity="gini", maxDepth=5, maxBins=32
    )
    with kept(points, parts) as held:
        return tree.fit(held)


def evaluate(
    predicted: DataFrame, label: str = "indexed_label", auc: bool = True, weight: str | None = None
) -> DataFrame:
    """Accuracy, error and, for two classes, the area under the ROC curve taken
    from the class probability. One row."""
    columns = [label, "prediction"] + (["rawPrediction"] if auc else []) + ([weight] if weight else [])
    hits = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    curve = BinaryClassificationEvaluator(labelCol=label)
    if weight:
        hits.setWeightCol(weight)
        curve.setWeightCol(weight)
    with kept(predicted.select(*columns)) as held:
        accuracy = float(hits.evaluate(held))
        area = float(curve.evaluate(held)) if auc else None
    return small_table(
        predicted.sparkSession, [(accuracy, 1.0 - accuracy, area)], "accuracy double, error double, auc double"
    )


def as_array(column: str) -> Column:
    return vector_to_array(F.col(column))
