"""Sources and sinks over catalog tables and files.

Keys are not enforceable on parquet tables in open-source Spark (neither
``SET NOT NULL`` nor ``ADD CONSTRAINT`` is accepted), so a declared key is
kept as a table property and checked as data with :mod:`tessera.operators.keys`.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import KeyViolation, require_key
from ..session import written

KEY_PROPERTY = "tessera.primary_key"


CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, header: bool, multi_line: bool):
    """Quoted text as spreadsheets and data frames write it: a quote is doubled
    inside quotes, and quoted text may hold line breaks."""
    return (spark.read.option("header", header).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             date_positions: Sequence[int] = (), header: bool = True, multi_line: bool = True) -> DataFrame:
    """S1 + S2: CSV records, typed.  Types are those of ``schema``, or inferred
    from all rows; columns at the given 0-based positions become timestamps.
    Empty cells are missing; a cell that does not parse as its type is NULL, and
    so is an unparseable date (:func:`csv_errors` returns such records).  A file
    whose quoted text may hold line breaks is read by one task; files known to
    have none are split with ``multi_line=False``."""
    return _typed_csv(spark, path, schema, date_positions, header, multi_line).drop(CORRUPT, "_bad")


def csv_errors(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               date_positions: Sequence[int] = (), header: bool = True, multi_line: bool = True) -> DataFrame:
    """The records with a cell that does not parse: the parsed columns, the
    names of the columns that failed (``_bad``; NULL where the record itself is
    broken) and its text (``_corrupt_record``; NULL where only dates failed)."""
    df = _typed_csv(spark, path, schema, date_positions, header, multi_line)
    # the reader refuses a query that looks at the corrupt text alone
    some = F.coalesce(F.col(_quoted(df.columns[0])).cast("string"), F.lit("")) >= ""
    return df.where((F.col(CORRUPT).isNotNull() | (F.size("_bad") > 0)) & some).withColumn("_bad", F.when(F.size("_bad") > 0, F.col("_bad")))


def _typed_csv(spark: SparkSession, path: str, schema: T.StructType | str | None, date_positions: Sequence[int], header: bool,
               multi_line: bool) -> DataFrame:
    if schema is None:
        # dates are parsed below, so that a bad one does not turn its column into text
        fields = _csv(spark, header, multi_line).option("inferSchema", True).csv(path).schema.fields
        fields = [T.StructField(f.name, T.StringType() if i in set(date_positions) else f.dataType) for i, f in enumerate(fields)]
    else:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    df = _csv(spark, header, multi_line).schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])).csv(path)
    out, bad = [], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        if i in set(date_positions) and isinstance(f.dataType, T.StringType):
            text = F.nullif(F.trim(c), F.lit(""))
            day = F.try_to_timestamp(text).cast("timestamp_ntz")
            bad.append(F.when(text.isNotNull() & day.isNull(), F.lit(f.name)))
            c = day
        out.append(c.alias(f.name))
    failed = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<string>")
    return df.select(*out, F.col(CORRUPT), failed.alias("_bad"))


def scan(spark: SparkSession, name: str) -> DataFrame:
    """S3: full scan of a one-, two- or three-part table name."""
    return spark.table(name)


def scan_param(spark: SparkSession, table_name: str) -> DataFrame:
    """The table name is a bound parameter, never spliced into SQL text."""
    return spark.sql("SELECT * FROM identifier(:t)", args={"t": table_name})


def table_key(spark: SparkSession, name: str) -> list[str]:
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    k = props.get(KEY_PROPERTY)
    return json.loads(k) if k else []


def _key_property(key: Sequence[str]) -> str:
    """The key's column names as JSON, as a string literal."""
    text = json.dumps(list(key)).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{KEY_PROPERTY}' = '{text}'"


def read_keyed(spark: SparkSession, name: str) -> tuple[DataFrame, list[str]]:
    """A table together with its declared key."""
    return spark.table(name), table_key(spark, name)


def write_table(df: DataFrame, name: str, key: Sequence[str] | None = None, buckets: int | None = None) -> None:
    """Replace rows and schema.  With ``key`` the rows are first written
    below the shared folder, so they are computed once; the key is checked
    there and recorded as a table property.  With ``buckets`` too, the table is
    clustered by its key: dealt to that many buckets, sorted within each, so a
    lookup by the key reads it without an exchange."""
    if key:
        df = written(df, "keyed")
        require_key(df, key)
    writer = df.write
    if key and buckets:
        # one file per bucket: the rows of a bucket are brought together first
        df = df.repartition(buckets, *[F.col(_quoted(k)) for k in key])
        writer = df.write.bucketBy(buckets, *key).sortBy(*key)
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    if key:
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_key_property(key)})")


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def ctas_if_absent(df: DataFrame, name: str) -> bool:
    """Create the table from ``df`` only if it does not exist yet."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return False
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)
    return True


def create_keyed_table(spark: SparkSession, name: str, schema: T.StructType | str,
                       key: Sequence[str], buckets: int | None = None) -> None:
    """Empty table with declared column types and a named key; no-op if
    present.  With ``buckets`` the table is clustered by its key."""
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    names = ", ".join(_quoted(k) for k in key)
    cluster = f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS " if buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet {cluster}"
              f"TBLPROPERTIES ({_key_property(key)})")


def drop_table(spark: SparkSession, name: str) -> None:
    """S9."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_keyed(df: DataFrame, name: str) -> None:
    """INSERT INTO .. SELECT, after checking the key: the new rows among
    themselves, and by a semi join against the table, whose own rows need no
    second check.  No row reaches the driver."""
    spark = df.sparkSession
    key = table_key(spark, name)
    if key:
        existing = spark.table(name)
        df = written(df.select(*existing.columns), "append")
        require_key(df, key)
        if not df.join(existing.select(*key), key, "left_semi").isEmpty():
            raise KeyViolation(f"key {key}: rows with keys that {name} has already")
    df.select(*spark.table(name).columns).write.insertInto(name)


def write_scored(df: DataFrame, path: str) -> None:
    """Scored rows as JSON records."""
    df.write.mode("overwrite").json(path)


def use(spark: SparkSession, catalog: str | None = None, db: str | None = None) -> None:
    """Later unqualified names resolve in this namespace."""
    if catalog:
        spark.sql(f"SET CATALOG `{catalog}`")
    if db:
        spark.sql(f"USE DATABASE `{db}`")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """A bounded look at the rows."""
    return df.limit(n)
