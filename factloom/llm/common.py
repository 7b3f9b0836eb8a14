"""Scratch tables in the shared folder, and small helpers that all operators use."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()
_made: list[tuple[SparkSession, str]] = []
#: Tables made since the innermost `settled` began.
_since: ContextVar[list[DataFrame] | None] = ContextVar("since", default=None)
#: Spark deletes the shuffle files of a query that has ended, and not when the driver happens to collect its garbage.
ENDED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application; theirs may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(__file__).parents[1]
    where = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    archive = Path(where, f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in root.rglob("*.py"):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one in local mode.

    On a cluster the setting has to be there, since a machine's own folder is not seen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="scratch-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return "file://" + _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries that start and end here leave no shuffle files."""
    before = spark.conf.get(ENDED, "false")
    spark.conf.set(ENDED, "true")
    try:
        yield
    finally:
        spark.conf.set(ENDED, before)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors. options: the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with tidy(spark):
        df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    if (since := _since.get()) is not None:
        since.append(table)
    return table


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """materialise(make(), name); the tables that make() has left are then deleted, as nothing else reads them."""
    outer, since = _since.get(), []
    token = _since.set(since)
    try:
        table = materialise(make(), name)
    finally:
        _since.reset(token)
    discard(*(x for x in since if x is not table))
    if outer is not None:
        outer.append(table)
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete materialised tables from which nothing is to be read any more."""
    for table in tables:
        if table is not None and (table.sparkSession, table.scratch_path) in _made:
            spark = table.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            _made.remove((spark, table.scratch_path))


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table made so far in this session; results not yet written become unreadable."""
    for s, path in [x for x in _made if x[0] is spark]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _made.remove((s, path))


def swept(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files and broadcast tables of what is done."""
    gc.collect()
    spark._jvm.System.gc()


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """left.join(right) by a sort-merge join at any size: a broadcast one takes the whole of a table that grows with the
    corpus through the driver, as long as it is under a limit that counts compressed bytes."""
    return left.join(right.hint("merge"), on, how)


def released() -> None:
    """Give back to the system what a finished task has freed: the worker lives on, its texts don't."""
    gc.collect()
    if not gc.get_freeze_count():  # modules stay: later tasks needn't look through them
        gc.freeze()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the given text column has about `limit` bytes in each (one row at least)."""
    try:
        yield from _slices(batches, column, limit)
    finally:
        released()


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def table_batches(columns: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of equal key as tables, from batches whose rows arrive sorted by that key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = batch[key].to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and last != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, i - start))
            last = keys[start]
            start = i
    if held:
        yield pa.Table.from_batches(held)
    del held
    released()
