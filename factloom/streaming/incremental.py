"""Incremental collection, and windows over the stream of events (an addition to the batch engine)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_reviews(stream: DataFrame, late: str = "7 days") -> DataFrame:
    """Reviews of a stream (url, ts) once each, within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["url"])


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Batch numbers of the finished versions of a table, in order."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return []
    found = [x.getPath() for x in files.listStatus(where) if x.getPath().getName().startswith("version=")]
    whole = [x for x in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
    return sorted(int(x.getName().split("=")[1]) for x in whole)


def upserted_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/version={versions(spark, path)[-1]}")


def upsert_sink(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch becomes a version of the table, made of the last finished one before it.

    A batch that is run again writes its version again from the same one. The last two versions stay, so that readers of
    the one before aren't cut off.
    """

    def write(batch: DataFrame, number: int) -> None:
        from factloom.operators.store import upserted

        spark = batch.sparkSession
        before = [v for v in versions(spark, path) if v < number]
        rows = upserted(spark.read.parquet(f"{path}/version={before[-1]}"), batch, key) if before else batch
        rows.write.mode("overwrite").parquet(f"{path}/version={number}")
        for old in before[:-1]:
            files, where = _folder(spark, f"{path}/version={old}")
            files.delete(where, True)

    return write


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n").alias("longest"))
