"""Encode, fit, save, load and score with Spark's own pipeline stages
(M3-M7, M9, B1, B7, S11, S14).

The encoder is fit on the training rows only and travels inside the fitted
``PipelineModel``, so raw columns go in at scoring time.  Its categories are a
table (``encoding.py``); boosted trees stop by patience (``boosting.py``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .boosting import Boosted, fit_boosted
from .encoding import encode_long, fit_dictionary, fit_table_one_hot  # noqa: F401
from .features import FeatureSpec, assemble

def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def one_hot_stages(columns: Sequence[str], output: str = "features",
                   passthrough: Sequence[str] = ()) -> list:
    """M3 stages for columns the caller declares categorical: NULL becomes a
    category of its own, values are indexed in ascending string order with an
    extra index for unseen values (the indexer's 'keep'), and the one-hot drops
    the last slot, which is that index, so an unseen value encodes to all
    zeros.  ``passthrough`` numeric columns join the feature vector as numbers,
    a missing one as the training rows' mean.  Labels of these stages live on the driver; for columns
    of very many values use :func:`fit_dictionary`."""
    cols = list(columns)
    # a letter in front: no value can be mistaken for NULL
    sel = ", ".join(f"coalesce(concat('v', CAST({_q(c)} AS STRING)), 'n') AS {_q(c + '__s')}" for c in cols)
    stages = []
    if cols:
        stages = [
            SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__"),
            StringIndexer(inputCols=[c + "__s" for c in cols], outputCols=[c + "__idx" for c in cols],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[c + "__idx" for c in cols], outputCols=[c + "__ohe" for c in cols],
                          dropLast=True)]
    nums = list(passthrough)
    if nums:
        num = ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {_q(c + '__num')}" for c in nums)
        stages += [SQLTransformer(statement=f"SELECT *, {num} FROM __THIS__"),
                   Imputer(strategy="mean", inputCols=[c + "__num" for c in nums], outputCols=[c + "__in" for c in nums])]
    return stages + [VectorAssembler(inputCols=[c + "__ohe" for c in cols] + [c + "__in" for c in nums], outputCol=output,
                                     handleInvalid="keep")]


def fit_one_hot(train: DataFrame, columns: Sequence[str], output: str = "features",
                passthrough: Sequence[str] = ()) -> PipelineModel:
    """M3 as pipeline stages, fit on the training rows."""
    return Pipeline(stages=one_hot_stages(columns, output, passthrough)).fit(train)


@dataclass
class GBTParams:
    max_iter: int = 100
    step_size: float = 0.1
    max_depth: int = 5
    patience: int = 5
    seed: int = 42


def fit_gbt(df: DataFrame, label: str, split_col: str = "split", train: str = "train",
            valid: str = "val", columns: Sequence[str] | None = None,
            params: GBTParams | None = None, categorical: Sequence[str] | None = None) -> PipelineModel:
    """M4 + M6: see :func:`fit_gbt_rounds`; the PipelineModel alone."""
    return fit_gbt_rounds(df, label, split_col, train, valid, columns, params, categorical)[0]


def fit_gbt_rounds(df: DataFrame, label: str, split_col: str = "split", train: str = "train",
                   valid: str = "val", columns: Sequence[str] | None = None,
                   params: GBTParams | None = None, categorical: Sequence[str] | None = None) -> tuple[PipelineModel, Boosted]:
    """M4 + M6: encoder fit on ``train`` rows; boosted trees fit on them, cut at
    the best round on the ``valid`` rows with patience.  One PipelineModel out,
    and the rounds.  ``categorical`` columns (the string columns unless given)
    are one-hot encoded from a table of categories, all others enter as numbers;
    every column may be given, as for a booster on one-hot features alone."""
    p = params or GBTParams()
    feats = [c for c in (columns or df.columns) if c not in (label, split_col)]
    if categorical is None:
        categorical = [c for c in feats if isinstance(df.schema[c].dataType, T.StringType)]
    enc = fit_table_one_hot(df.filter(F.col(split_col) == train), list(categorical), [c for c in feats if c not in set(categorical)])
    rows = df.filter(F.col(split_col).isin(train, valid)).withColumn("_label", F.col(label).cast("double"))
    # encoded once: every fit and every loss reads the vectors
    rows = written(enc.transform(rows).select(split_col, "_label", "features"), "encoded")
    gbt = GBTClassifier(featuresCol="features", labelCol="_label", maxIter=p.max_iter, stepSize=p.step_size,
                        maxDepth=p.max_depth, seed=p.seed, cacheNodeIds=True, checkpointInterval=10)
    done = fit_boosted(rows.filter(F.col(split_col) == train), rows.filter(F.col(split_col) == valid), gbt, p.patience)
    return PipelineModel(stages=[enc, done.model]), done


def fit_linear(df: DataFrame, label: str, features: Sequence[str]) -> PipelineModel:
    """M5: least squares with intercept, no regularisation, on the rows whose
    label and features are all there.  Scoring keeps every row."""
    df = df.na.drop(subset=[label, *features])
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0,
                          elasticNetParam=0.0, solver="normal", predictionCol="prediction")
    return Pipeline(stages=[va, lr]).fit(df)


def predict(model: PipelineModel, df: DataFrame, output: str = "prediction",
            probability: str | None = "probability", contract: str | None = None) -> DataFrame:
    """Score with a fitted pipeline; the prediction is a double (NULL
    where a missing feature leaves none) and, for classifiers, ``probability``
    is the positive-class probability.  Helper columns of the encoder are
    dropped; input columns and all rows are kept.  With the recorded
    ``contract`` a missing or differently typed input raises."""
    if contract:
        require_contract(df, contract)
    out = model.transform(df)
    keep = list(df.columns)
    cols = [F.col(c) for c in keep] + [F.nanvl(F.col("prediction").cast("double"), F.lit(None).cast("double")).alias(output)]
    if probability and "probability" in out.columns:
        cols.append(vector_to_array("probability")[1].alias(probability))
    return out.select(*cols)


# ------------------------------------------------------------------ contracts (M7)

def contract_of(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """The input schema recorded at fit time, as JSON."""
    cols = list(columns) if columns else df.columns
    return T.StructType([df.schema[c] for c in cols]).json()


def check_contract(df: DataFrame, contract: str) -> list[dict]:
    """One entry per mismatch between ``df`` and a recorded schema: missing
    columns and type changes (extra columns are allowed; inputs are taken by
    name)."""
    want = T.StructType.fromJson(json.loads(contract))
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in want.fields:
        if f.name not in have:
            out.append({"column": f.name, "expected": f.dataType.simpleString(), "actual": None,
                        "problem": "missing"})
        elif have[f.name] != f.dataType:
            out.append({"column": f.name, "expected": f.dataType.simpleString(),
                        "actual": have[f.name].simpleString(), "problem": "type"})
    return out


class ContractError(ValueError):
    pass


def require_contract(df: DataFrame, contract: str) -> None:
    problems = check_contract(df, contract)
    if problems:
        raise ContractError(f"inputs do not match the recorded schema: {problems}")


# ------------------------------------------------------------------ persistence

def save_model(model: PipelineModel, path: str, spec: FeatureSpec | None = None,
               contract: str | None = None) -> None:
    """Model directory plus a one-row JSON record of the spec and contract,
    written through Spark so any shared file system works."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    meta = spark.createDataFrame([(spec.to_json() if spec else None, contract)],
                                 "spec string, contract string")
    meta.coalesce(1).write.mode("overwrite").json(path.rstrip("/") + "/tessera_meta")


def load_model(path: str) -> tuple[PipelineModel, FeatureSpec | None, str | None]:
    spark = SparkSession.getActiveSession()
    model = PipelineModel.load(path)
    row = spark.read.schema("spec string, contract string").json(
        path.rstrip("/") + "/tessera_meta").first()
    spec = FeatureSpec.from_json(row["spec"]) if row and row["spec"] else None
    return model, spec, (row["contract"] if row else None)


# ------------------------------------------------------------------ batch scoring (B1)

def score_batch(df: DataFrame, model: PipelineModel, spec: FeatureSpec,
                tables: dict[str, DataFrame] | None = None, output: str = "prediction",
                contract: str | None = None) -> DataFrame:
    """B1: the input holds keys only; features are looked up and functions run
    as at training time, then the model scores.  Output = input columns +
    feature values + prediction (+ probability); excluded columns are kept."""
    assembled = assemble(df, spec, tables, apply_exclude=False)
    return predict(model, assembled, output=output, contract=contract)


# ------------------------------------------------------------------ run records (M9)

RUN_SCHEMA = "run_id string, kind string, split string, name string, value_num double, value_text string"


def run_record(spark: SparkSession, run_id: str, params: dict, metrics: DataFrame | None,
               inputs: Sequence[str], split_col: str = "split") -> DataFrame:
    """Parameters, metrics (a metrics table with one row per split, every
    numeric column a metric) and input table names as long rows."""
    rows = [(run_id, "param", None, k, None, str(v)) for k, v in params.items()]
    rows += [(run_id, "input", None, "table", None, t) for t in inputs]
    head = spark.createDataFrame(rows, RUN_SCHEMA)
    if metrics is None:
        return head
    num = [f.name for f in metrics.schema.fields
           if f.name != split_col and isinstance(f.dataType, (T.NumericType,))]
    by = [split_col] if split_col in metrics.columns else []
    long = metrics.select(*by, *[F.col(c).cast("double").alias(c) for c in num]) \
                  .unpivot(by, num, "name", "value_num")
    m = long.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
                    (F.col(split_col) if by else F.lit(None).cast("string")).alias("split"),
                    "name", "value_num", F.lit(None).cast("string").alias("value_text"))
    return head.unionByName(m)


def store_run(record: DataFrame, path: str) -> str:
    """M9: keep a run (one ``run_id``) below ``path``, one folder a run.  A run
    that is stored again replaces itself, so a repeated job leaves one copy;
    runs that are stored at the same time do not touch each other."""
    saved = written(record, "run")
    ids = [r[0] for r in saved.select("run_id").distinct().limit(2).collect()]
    if len(ids) != 1 or not re.fullmatch(r"[A-Za-z0-9._-]+", ids[0] or ""):
        raise ValueError(f"one run_id of letters, digits and ._- is needed, got {ids}")
    saved.drop("run_id").write.mode("overwrite").parquet(f"{path}/run_id={ids[0]}")
    return ids[0]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs stored below ``path``; a filter on ``run_id`` reads that run's folder alone."""
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def compare_runs(runs: DataFrame, baseline: str, higher: dict[str, bool]) -> DataFrame:
    """The metrics named in ``higher`` (whether more is better), per split and
    run: the value, the baseline run's, the change against it, and the place
    among all runs (equal values share one; a missing value or NaN has none)."""
    m = runs.filter((F.col("kind") == "metric") & F.col("name").isin(list(higher))).select("run_id", "split", "name", "value_num")
    base = m.filter(F.col("run_id") == baseline).select(F.col("split").alias("_split"), F.col("name").alias("_name"),
                                                        F.col("value_num").alias("baseline_value"))
    worse = F.when(F.col("name").isin([k for k, v in higher.items() if v]), -F.col("value_num")).otherwise(F.col("value_num"))
    valid = F.col("value_num").isNotNull() & ~F.isnan("value_num")
    place = F.rank().over(Window.partitionBy("split", "name", valid).orderBy(worse))
    return (m.withColumn("place", F.when(valid, place))
            .join(base, F.col("split").eqNullSafe(F.col("_split")) & (F.col("name") == F.col("_name")), "left")
            .select("split", "name", "run_id", "value_num", "baseline_value",
                    (F.col("value_num") - F.col("baseline_value")).alias("change"), "place"))
