"""The session that the engine expects."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(name: str = "factloom", **settings: str) -> SparkSession:
    """A session in UTC with adaptive plans; a map built from pairs keeps the last of equal keys."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application; theirs may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root, where = Path(__file__).parent, tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    archive = Path(where, f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in root.rglob("*.py"):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
