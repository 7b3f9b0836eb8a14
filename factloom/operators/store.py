"""The store: partitions by source, upserts by key, dated snapshots and their index."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stamped(rows: DataFrame, source: str) -> DataFrame:
    return rows.withColumn("retrieved_by", F.lit(source))


def replaced(stored: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """The store after all rows of a source were replaced; an empty replacement is an error."""
    if rows.isEmpty():
        raise ValueError(f"no rows for {source}: nothing is replaced")
    return stored.where(~F.col("retrieved_by").eqNullSafe(F.lit(source))).unionByName(stamped(rows, source), allowMissingColumns=True)


def write_source(rows: DataFrame, path: str, source: str) -> None:
    """Replace one source's partition of a Parquet store and leave the others as they are."""
    if rows.isEmpty():
        raise ValueError(f"no rows for {source}: nothing is replaced")
    stamped(rows, source).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("retrieved_by").parquet(path)


def upserted(stored: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """stored with the rows of new in place of those of equal key."""
    return stored.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def write_snapshot(tables: dict[str, DataFrame], path: str, date: str) -> None:
    """Write all tables of a date into a folder of their own, then one index entry that names it.

    Readers go by the index, whose entries are added and never changed. So a snapshot is there with all its tables or not at all,
    one that is being written again is read in its old form meanwhile, and what a job that died has left behind is not seen.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"{path}/versions/{date}-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{version}/{name}")
    files = [(name, f"{version}/{name}") for name in tables]
    entry = spark.createDataFrame([(date, dict(files))], "date string, files map<string, string>").withColumn("written", F.current_timestamp())
    entry.coalesce(1).write.mode("append").parquet(f"{path}/index")


def snapshot_index(spark: SparkSession, path: str) -> DataFrame:
    """date, files (name to folder), written: of each date the last entry, and the latest date's under `latest` too."""
    entries = spark.read.parquet(f"{path}/index")
    last = entries.groupBy("date").agg(F.max_by(F.struct("files", "written"), "written").alias("e")).select("date", "e.files", "e.written")
    newest = last.orderBy(F.desc("date")).limit(1).withColumn("date", F.lit("latest"))
    return last.unionByName(newest)


def read_snapshot(spark: SparkSession, path: str, name: str, date: str = "latest") -> DataFrame:
    """A table of a date; an unknown date or table is an error."""
    return spark.read.parquet(data_file(snapshot_index(spark, path), name, date))


def indexed(index: DataFrame, entry: DataFrame) -> DataFrame:
    """The index with the entry under its own date and under latest."""
    return upserted(index, entry.unionByName(entry.withColumn("date", F.lit("latest"))), "date")


def write_tsv(rows: DataFrame, path: str) -> None:
    if not rows.isEmpty():
        rows.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def save_raw(rows: DataFrame, path: str, source: str, clean: bool = True) -> None:
    """The raw rows of a source, in place of those saved before, or beside them if not clean."""
    rows.write.mode("overwrite" if clean else "append").parquet(f"{path}/raw/{source}")


def write_text(rows: DataFrame, path: str, column: str) -> None:
    rows.select(column).write.mode("overwrite").text(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """A table with its header; without rows nothing is written."""
    if not rows.isEmpty():
        rows.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def of_source(stored: DataFrame, source: str) -> DataFrame:
    return stored.where(F.col("retrieved_by").eqNullSafe(F.lit(source)))


def points(stored: DataFrame, keys: DataFrame, key: str = "url") -> DataFrame:
    """The stored rows of some keys: look-ups one by one become a join."""
    return stored.join(keys.select(key).distinct(), key, "left_semi")


def stale_dates(index: DataFrame, date: str) -> DataFrame:
    """Dates of the index but `date` and latest, which a restore of `date` makes stale."""
    return index.select("date").distinct().exceptAll(index.sparkSession.createDataFrame([(date,), ("latest",)], "date string").distinct())


def index_entry(index: DataFrame, date: str = "latest") -> DataFrame:
    """The entry of a date; an unknown date is an error."""
    entry = index.where(F.col("date") == date)
    if entry.isEmpty():
        raise KeyError(f"nothing for {date}")
    return entry


def data_file(index: DataFrame, file: str, date: str = "latest") -> str:
    """Where a file of a date lies, from its entry's map `files`; an unknown file is an error."""
    found = index_entry(index, date).select(F.try_element_at("files", F.lit(file)).alias("path")).first()
    if found["path"] is None:
        raise KeyError(f"no {file} for {date}")
    return found["path"]


def loaded_or_made(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at path; where there is none it is made first, and written."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        make().write.parquet(path)
    return spark.read.parquet(path)


def replace_rows(rows: DataFrame, path: str, source: str) -> None:
    """A source's rows in place of those written before, stamped with the source and the time."""
    if rows.isEmpty():
        raise ValueError(f"no rows for {source}: nothing is replaced")
    stamped(rows, source).withColumn("updated", F.current_timestamp()).write.mode("overwrite").parquet(f"{path}/rows/{source}")
