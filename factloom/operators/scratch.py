"""Intermediate tables in the folder that driver and executors share; they cut lineage and outlive executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_made: dict[str, list[str]] = {}
_cleared: dict[str, int] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a temporary folder in local mode; a cluster has to have the setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="kept-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return "file://" + _local[app]


def kept(rows: DataFrame, name: str) -> DataFrame:
    """rows, written once and read back by all that use them."""
    spark = rows.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(rows.schema).parquet(path)


def times_cleared(spark: SparkSession) -> int:
    """Who remembers a kept table has to make it anew once this number has changed."""
    return _cleared.get(spark.sparkContext.applicationId, 0)


def clear(spark: SparkSession) -> None:
    """Delete the tables kept so far; what was made of them and isn't written yet becomes unreadable."""
    _cleared[spark.sparkContext.applicationId] = times_cleared(spark) + 1
    for path in _made.pop(spark.sparkContext.applicationId, []):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
