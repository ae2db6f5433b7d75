"""Session construction and shared-folder helpers."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in this package assumes.  Timestamps are compared as
# wall-clock values, so the session zone is pinned to UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is read from the
    session.  Where it is unset, a folder below ``spark.sql.warehouse.dir`` is
    used, which a local run always has; a cluster must name its own, because a
    default warehouse lies on the driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings a registered query relies on, applied to a session made
    elsewhere: UTC session zone (wall-clock differences of TIMESTAMP_NTZ
    values are computed through the session zone, which must not have DST)
    and the shared checkpoint folder."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df):
    """Write a (pre-aggregated) intermediate once to the shared checkpoint
    folder and read it back, so several later passes do not each rescan the
    source, and a lost executor recomputes nothing before this point.
    Reliable ``checkpoint()``, never a machine-local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_FOLDERS: list[str] = []  # open scratch folders, innermost last (plans are built by one thread)


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in the
    innermost ``scratch_folder`` that is open."""
    folder = _FOLDERS[-1] if _FOLDERS else _scratch_root(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str):
    """Intermediates written inside the block go when it ends, by an error too.
    Only results that are written elsewhere may be used after it."""
    path = scratch_path(spark, name)
    _FOLDERS.append(path)
    try:
        yield path
    finally:
        _FOLDERS.remove(path)
        _remove(spark, path)


def remove_scratch(spark: SparkSession) -> None:
    """Remove all intermediates of this application.  Frames returned by this
    package must have been consumed: some read them."""
    if _FOLDERS:
        raise ValueError("a scratch folder is open")
    _remove(spark, _scratch_root(spark))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they start: a
    zip of it in the shared folder, added to the session once (``addPyFile``)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    # beside the applications' folders: new executors fetch it as long as the session lives
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera/package-{uuid.uuid4().hex}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def written(df, name: str):
    """``df`` written once as Parquet below the shared folder and read back:
    lineage is cut, and a lost executor repeats nothing before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def data_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
