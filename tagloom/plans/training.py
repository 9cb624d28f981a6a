"""Cluster jobs: train and store a model in one run, tag users with it in another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from tagloom.operators import ml
from tagloom.sinks.writers import save_model
from tagloom.specs import Rule


def points(features: DataFrame, columns: Sequence[str], distinct: bool = True) -> DataFrame:
    """Vectors to fit on: each distinct row once with its count as weight. Features
    that hardly repeat are better fitted as they are (``distinct=False``)."""
    return ml.assemble(ml.compress(features, columns) if distinct else features, columns)


def train(
    features: DataFrame, columns: Sequence[str], k: int, path: str, seed: int = 10, distinct: bool = True
) -> KMeansModel:
    """Fit and store; k is usually the number of child tags."""
    rows = points(features, columns, distinct)
    model = ml.kmeans_fit(rows, k, seed=seed, weight="weight" if distinct else None)
    save_model(model, path)
    return model


def predict(features: DataFrame, user: str, columns: Sequence[str], path: str, rules: Sequence[Rule]) -> DataFrame:
    """Load, assign, rank the clusters and give each user the tag of their rank."""
    return ml.cluster_tags(ml.assemble(features, columns), user, KMeansModel.load(path), rules)
