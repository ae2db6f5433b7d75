"""One-hot encoding from a table of categories (M3, M6).

The dictionary (column, value, slot) is a table and stays one: rows look their
slots up by a join per column, so a column of any number of categories fits and
scores without its labels on the driver.  Spark broadcasts a small dictionary
and sort-merges a large one, splitting a hot category.  The slots of a row are
gathered into one sparse vector; a value that the training rows do not have
adds nothing to it (all zeros).

The fitted stage saves its dictionary beside its metadata, so a pipeline that
holds it can be saved, loaded and scored elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.prefix import bucket_count, bucket_of, running_totals
from ..session import written


def fit_dictionary(train: DataFrame, columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """M3, distributed: (column, value, slot) for every category of the training
    rows; ``slot`` numbers a column's values from 0 in ascending string order,
    NULL (a category of its own) first.  The dictionary is a table, ranked by
    buckets: no label reaches the driver, whatever the number of categories.
    """
    cols = list(columns)
    values = written(train.select(*[F.col(c).cast("string").alias(c) for c in cols])
                     .unpivot([], cols, "column", "value").distinct(), "categories")
    nb = bucket_count(values, buckets)
    # a sample of the values, about 16 per bucket, only places the cut points
    step = max(1, values.count() // (16 * nb))
    sample = sorted(r["value"] for r in values.where(F.col("value").isNotNull())
                    .where(F.pmod(F.xxhash64("value"), F.lit(step)) == 0).select("value").distinct().collect())
    cuts = [sample[len(sample) * i // nb] for i in range(1, nb)] if len(sample) >= nb else []
    ranked = running_totals(values.withColumn("_one", F.lit(1).cast("bigint")), ["column"], ["value"], ["_one"],
                            bucket=bucket_of(F.col("value"), sorted(set(cuts))))
    return ranked.select("column", "value", (F.col("cum__one") - 1).cast("int").alias("slot"))


def encode_long(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value, slot): each row's slot per column, -1 for a
    value that the training rows do not have (all zeros in one-hot form)."""
    cols = list(columns)
    long = df.select(*keep, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(list(keep), cols, "column", "value")
    d = dictionary.select(F.col("column").alias("_c"), F.col("value").alias("_v"), "slot")
    j = long.join(d, (F.col("column") == F.col("_c")) & F.col("value").eqNullSafe(F.col("_v")), "left")
    return j.select(*keep, "column", "value", F.coalesce("slot", F.lit(-1)).alias("slot"))


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from ascending indices and their values.  Spark has no
    function that makes one; its JSON reader knows the vector type."""
    body = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    text = F.to_json(F.struct(body.alias("v")))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


class TableOneHotModel(Model, MLWritable, MLReadable):
    """Categorical columns by their dictionary, then numeric ones as numbers (a
    missing one as the training mean), as one sparse vector.  ``sizes`` and
    ``means`` hold one number per column."""

    def __init__(self, dictionary: DataFrame | None = None, columns: Sequence[str] = (), sizes: Sequence[int] = (),
                 numbers: Sequence[str] = (), means: Sequence[float] = (), output: str = "features"):
        super().__init__()
        self.dictionary, self.columns, self.sizes = dictionary, list(columns), list(sizes)
        self.numbers, self.means, self.output = list(numbers), list(means), output

    @property
    def width(self) -> int:
        return sum(self.sizes) + len(self.numbers)

    def offsets(self) -> list[int]:
        return [sum(self.sizes[:i]) for i in range(len(self.sizes))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for i, c in enumerate(self.columns):
            d = self.dictionary.where(F.col("column") == c).select(F.col("value").alias(f"_value{i}"), F.col("slot").alias(f"_slot{i}"))
            out = out.join(d, out[c].cast("string").eqNullSafe(d[f"_value{i}"]), "left").drop(f"_value{i}")
        place = [F.col(f"_slot{i}") + off for i, off in enumerate(self.offsets())]
        slots = F.filter(F.array(*place), lambda s: s.isNotNull()) if place else F.array().cast("array<int>")
        ones = F.transform(slots, lambda s: F.lit(1.0))
        first = sum(self.sizes)
        at = F.array(*[F.lit(first + j) for j in range(len(self.numbers))]).cast("array<int>")
        number = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(m))
                  for c, m in zip(self.numbers, self.means)]
        values = F.array(*number).cast("array<double>")
        vector = sparse_vector(self.width, F.concat(slots, at), F.concat(ones, values))
        return out.withColumn(self.output, vector).drop(*[f"_slot{i}" for i in range(len(self.columns))])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


FIELDS = ("columns", "sizes", "numbers", "means", "output")


class _Writer(MLWriter):
    def __init__(self, stage: TableOneHotModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        extra = {"fields": {f: getattr(self.stage, f) for f in FIELDS}}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=extra)
        self.stage.dictionary.write.parquet(path.rstrip("/") + "/dictionary")


class _Reader(MLReader):
    def load(self, path: str) -> TableOneHotModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        d = SparkSession.getActiveSession().read.parquet(path.rstrip("/") + "/dictionary")
        stage = TableOneHotModel(d, **meta["fields"])
        stage._resetUid(meta["uid"])
        return stage


def fit_table_one_hot(train: DataFrame, columns: Sequence[str], numbers: Sequence[str] = (),
                      output: str = "features") -> TableOneHotModel:
    """Fit on the training rows; the dictionary is written once to the shared
    folder, and one number per column reaches the driver."""
    cols, nums = list(columns), list(numbers)
    if cols:
        d = written(fit_dictionary(train, cols), "dictionary")
    else:
        d = train.sparkSession.createDataFrame([], "column string, value string, slot int")
    size = {r["column"]: r["n"] for r in d.groupBy("column").agg((F.max("slot") + 1).alias("n")).collect()}
    means = []
    if nums:
        number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        means = [0.0 if m is None else m for m in train.agg(*[F.avg(number(c)) for c in nums]).first()]
    return TableOneHotModel(d, cols, [size.get(c, 0) for c in cols], nums, means, output)
