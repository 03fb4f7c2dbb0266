"""Sessions, input tables and the shared scratch folder.

Intermediate results that are read more than once are written as Parquet below
the folder named by ``spark.checkpoint.dir`` (seen by the driver and by every
executor), so a lost executor only costs the tasks that were running on it.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
#: While a table is written: shuffle files go once it is there, and batches for Python are of a size that whole texts fit.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "512"}
_OWN_DIR: list[str] = []
_WRITTEN: list[str] = []
_STORED: dict[tuple, object] = {}


def build_session(app: str = "weavemine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; extra settings by keyword (dots as ``__``)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only where that is unset and the session is one machine's, as in tests, a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^-\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="weavemine-"))
        atexit.register(shutil.rmtree, _OWN_DIR[0], True)
    return f"file://{_OWN_DIR[0]}"


def scratch_path(spark: SparkSession, name: str = "t") -> str:
    path = f"{shared_dir(spark)}/weavemine-scratch/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, name: str = "t", batch: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives executor loss.

    Once the table is written nothing needs the shuffle files it was made of; Spark is asked to delete them then.
    ``batch`` is how many rows Python is given at once, where they are small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    conf = _WRITING | ({"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)} if batch else {})
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out._weavemine_path = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(*dfs: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for df in dfs:
        path = getattr(df, "_weavemine_path", None)
        if path in _WRITTEN:
            _WRITTEN.remove(path)
            drop_path(df.sparkSession, path)


def stored(source: DataFrame, kind: str, build: Callable[[], T]) -> T:
    """What ``build`` makes of a table of files, made once for these files and this application, and then read by all.

    Files are taken not to change under their names, as written Parquet files do not. ``clear_scratch`` forgets it.
    """
    key = (source.sparkSession.sparkContext.applicationId, kind, *sorted(source.inputFiles()))
    if key not in _STORED:
        _STORED[key] = build()
    return _STORED[key]


def clear_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this process; call it once results that read them are written."""
    _STORED.clear()
    while _WRITTEN:
        drop_path(spark, _WRITTEN.pop())
