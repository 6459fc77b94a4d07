"""Correctness classifiers (M-2 to M-5, P-10): the forest on MLlib, boosted
trees and the dense net as given on Spark (``boost``, ``net``), neighbours by
pivots (``knn``). Training and prediction are distributed; features are taken by name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators import boost, net
from dossier.operators.knn import knn_pivots
from dossier.operators.quality import knn_vote
from dossier.session import scratch_path

MODELS = ("RF", "XG", "NN", "KN")
# neighbours that vote
NEIGHBOURS = 7


def forest(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, seed: int) -> DataFrame:
    """100 trees, depth 10, min leaf 5, sqrt features, bootstrap; a null is -1, as a category's code is."""
    x = array_to_vector(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features]))
    model = RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=5, featureSubsetStrategy="sqrt",
                                   bootstrap=True, seed=seed, labelCol=label).fit(
        train.select(x.alias("features"), F.col(label).cast("double").alias(label)))
    # read back without its training summary: that holds the session, which tasks cannot take once it has observations
    path = scratch_path(train.sparkSession, "forest")
    model.write().overwrite().save(path)
    model = RandomForestClassificationModel.load(path)
    out = model.transform(test.withColumn("features", x))
    return out.withColumn("prediction", F.col("prediction").cast("int")).drop("rawPrediction", "probability", "features")


def neighbours(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str) -> DataFrame:
    """The vote of the nearest training rows; ``key`` is unique over both parts."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    near = knn_pivots(train.select(key, x.alias("x"), label), test.select(key, x.alias("x")), NEIGHBOURS, key, "x", label)
    vote = knn_vote(near).select(F.col("q_id").alias(key), F.col("predicted").alias("prediction"))
    return test.join(vote, key, "left")


def fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                kind: str, seed: int = 0, subset: bool = False, key: str = "row") -> DataFrame:
    """Fit on ``train`` and return ``test`` with an integer ``prediction``.
    ``subset`` picks the dense net for a subset of the labelled rows."""
    if kind == "RF":
        return forest(train, test, features, label, seed)
    if kind == "XG":
        return boost.fit_predict(train, test, features, label)
    if kind == "NN":
        return net.fit_predict(train, test, features, label, seed, subset)
    if kind == "KN":
        return neighbours(train, test, features, label, key)
    raise ValueError(f"kind must be one of {MODELS}")


def cross_validated(df: DataFrame, fit: Callable[[DataFrame, DataFrame], DataFrame], fold: str = "fold",
                    folds: int = 5) -> DataFrame:
    """Every row with the prediction of a model fitted on the other folds;
    ``fit(train, test)`` returns ``test`` with its prediction."""
    out = None
    for k in range(folds):
        part = fit(df.filter(F.col(fold) != k), df.filter(F.col(fold) == k))
        out = part if out is None else out.unionByName(part)
    return out
