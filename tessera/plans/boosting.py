"""Boosted trees that stop by patience (M4).

Trees are fit on the training rows alone.  The loss of every round on the
validation rows is then one pass over them (``evaluateEachIteration``); the
first round after which ``patience`` rounds in a row bring no lower loss ends
the training, and the ensemble is cut at the best round.  Spark cannot go on
with a fitted ensemble, so the number of rounds doubles until the rule stops it
or ``max_iter`` is reached: the seed makes each fit begin with the same trees,
and an early stop costs at most twice the rounds that it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession


@dataclass
class Boosted:
    model: GBTClassificationModel  # cut at the best round
    losses: list[float]            # of rounds 1 to the stop
    best: int                      # round with the least loss
    stop: int                      # last round that counts

    def rounds(self, spark: SparkSession) -> DataFrame:
        """(round, loss): one row per round, ``max_iter`` at most."""
        return spark.createDataFrame([(i, float(x)) for i, x in enumerate(self.losses, 1)], "round int, loss double")


def patience_stop(losses: Sequence[float], patience: int) -> tuple[int, int, bool]:
    """(best round, stop round, whether the rule stopped), rounds from 1: the
    stop is the first round that lies ``patience`` rounds behind the best so
    far; without one it is the last round.  Ties keep the earlier round."""
    best = 1
    for r, loss in enumerate(losses, 1):
        if loss < losses[best - 1]:
            best = r
        elif r - best >= patience:
            return best, r, True
    return best, len(losses), False


def cut(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The same ensemble with its first ``rounds`` trees."""
    spark = SparkSession.getActiveSession()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    java = model._java_obj
    trees, weights = java.trees(), java.treeWeights()
    some = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    share = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        some[i], share[i] = trees[i], weights[i]
    out = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), some, share))
    for p in model.extractParamMap():
        if model.isSet(p) and out.hasParam(p.name):
            out.set(out.getParam(p.name), model.getOrDefault(p))
    out._transfer_params_to_java()
    return out


def fit_boosted(train: DataFrame, valid: DataFrame, estimator: GBTClassifier, patience: int = 5, first: int = 24) -> Boosted:
    """``estimator`` says all but the rounds (``maxIter`` is the most).  Without
    validation rows there is no loss to stop by: all rounds are kept."""
    most = estimator.getMaxIter()
    if valid.isEmpty():
        return Boosted(estimator.fit(train), [], most, most)
    n = min(first, most)
    while True:
        model = estimator.copy({estimator.maxIter: n}).fit(train)
        losses = model.evaluateEachIteration(valid)
        best, stop, ended = patience_stop(losses, patience)
        if ended or n == most:
            return Boosted(cut(model, best), list(losses[:stop]), best, stop)
        n = min(2 * n, most)
