"""One-hot from a table of categories, and boosting with patience."""

import os
import random
import tempfile

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from tessera.plans.boosting import cut, fit_boosted, patience_stop
from tessera.plans.encoding import fit_table_one_hot
from tessera.plans.model import GBTParams, fit_gbt_rounds, load_model, predict, save_model


def vectors(df):
    return {r["id"]: (r["v"]["size"], r["v"]["indices"], r["v"]["values"])
            for r in df.select("id", F.unwrap_udt("features").alias("v")).collect()}


def test_slots_unseen_null_and_numbers(spark):
    train = spark.createDataFrame([(1, "b", None, 1.5), (2, "a", 7, None), (3, None, 7, float("nan")), (4, "", 8, 2.5)], "id int, s string, n int, x double")
    enc = fit_table_one_hot(train, ["s", "n"], ["x"])
    # s: null '' a b; n: null 7 8; then x with mean 2.0
    assert enc.sizes == [4, 3] and enc.means == [2.0] and enc.width == 8
    got = vectors(enc.transform(train))
    assert got == {1: (8, [3, 4, 7], [1.0, 1.0, 1.5]), 2: (8, [2, 5, 7], [1.0, 1.0, 2.0]),
                   3: (8, [0, 5, 7], [1.0, 1.0, 2.0]), 4: (8, [1, 6, 7], [1.0, 1.0, 2.5])}
    new = spark.createDataFrame([(9, "zz", 5, 0.0), (10, "a", None, None)], "id int, s string, n int, x double")
    assert vectors(enc.transform(new)) == {9: (8, [7], [0.0]), 10: (8, [2, 4, 7], [1.0, 1.0, 2.0])}
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-enc-"), "m")
    PipelineModel(stages=[enc]).write().overwrite().save(path)
    assert vectors(PipelineModel.load(path).transform(train)) == got


def test_a_million_categories_fit_and_score(spark):
    """No label reaches the driver: it holds one number per column."""
    n = 1_000_000
    rows = spark.range(n).select("id", F.concat(F.lit("k"), "id").alias("s"), (F.col("id") % 2).cast("double").alias("y"))
    enc = fit_table_one_hot(rows, ["s"])
    assert enc.sizes == [n] and set(vars(enc)) >= {"dictionary", "sizes"}
    out = enc.transform(rows)
    assert out.count() == n
    some = out.where("id % 100000 = 7")
    slots = {r["id"]: r["v"]["indices"] for r in some.select("id", F.unwrap_udt("features").alias("v")).collect()}
    rank = {r["value"]: r["slot"] for r in enc.dictionary.where("value in ('k7', 'k100007')").collect()}
    assert slots[7] == [rank["k7"]] and slots[100007] == [rank["k100007"]]
    model = LogisticRegression(labelCol="y", maxIter=1, standardization=False).fit(out.where("id % 20 < 2"))
    assert model.numFeatures == n
    scored = model.transform(some.limit(3)).select("prediction").collect()
    assert len(scored) == 3


def test_patience_rule_against_plain_loop():
    r = random.Random(0)
    for _ in range(300):
        losses = [r.choice([0.1, 0.2, 0.3, 0.4, 0.5]) for _ in range(r.randint(1, 25))]
        patience = r.randint(1, 6)
        best, since, stop = 0, 0, len(losses) - 1
        for i in range(1, len(losses)):
            if losses[i] < losses[best]:
                best, since = i, 0
            else:
                since += 1
                if since == patience:
                    stop = i
                    break
        assert patience_stop(losses, patience)[:2] == (best + 1, stop + 1)


@pytest.fixture(scope="module")
def noisy(spark):
    """Half the labels are noise, and a feature with many values to learn it by heart."""
    rows = [(i, float(i * 7919 % 1000), "c%d" % (i % 3), "train" if i % 3 else "val") for i in range(1500)]
    df = spark.createDataFrame(rows, "id int, x double, c string, split string")
    rule = (F.col("x") > 500).cast("int")
    return df.withColumn("y", F.when(F.pmod(F.xxhash64("id"), F.lit(2)) == 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int")).otherwise(rule))


def test_noise_stops_early_and_the_cut_model_scores(spark, noisy):
    model, fit = fit_gbt_rounds(noisy.drop("id"), "y", params=GBTParams(max_iter=40, patience=3))
    assert fit.stop < 40 and fit.best == fit.stop - 3
    assert fit.losses[fit.best - 1] == min(fit.losses) and len(fit.losses) == fit.stop
    assert model.stages[-1].getNumTrees == fit.best
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-gbt-"), "m")
    save_model(model, path)
    again, _, _ = load_model(path)
    a, b = (sorted((r.x, r.prediction, r.probability) for r in predict(m, noisy).collect()) for m in (model, again))
    assert a == b and len(a) == 1500
    extra = noisy.withColumns({"features": F.lit("own"), "slot": F.lit(1), "value": F.lit("v")})
    assert predict(model, extra.drop("features")).count() == 1500


def test_more_rounds_begin_with_the_same_trees(spark, noisy):
    enc = fit_table_one_hot(noisy, ["c"], ["x"])
    rows = enc.transform(noisy).select("split", F.col("y").cast("double").alias("label"), "features").cache()
    gbt = GBTClassifier(maxIter=6, maxDepth=2, seed=1)
    few = gbt.copy({gbt.maxIter: 3}).fit(rows)
    many = gbt.fit(rows)
    assert [t.toDebugString.split("\n", 1)[1] for t in few.trees] == [t.toDebugString.split("\n", 1)[1] for t in many.trees[:3]]
    short = cut(many, 3)
    assert short.evaluateEachIteration(rows) == pytest.approx(few.evaluateEachIteration(rows), abs=1e-12)
    none = fit_boosted(rows, rows.limit(0), gbt)
    assert none.best == none.stop == 6 and none.losses == []
