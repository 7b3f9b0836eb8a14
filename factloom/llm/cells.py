"""Dealing the rows of a key out to tasks: keys of many rows are split into pairs of blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import merged


def deal(rows: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """rows with columns cell and side, for keys that two or more members share.

    A key of up to `most` rows is one cell. The others have blocks by a hash of the member, and a cell for each
    pair of blocks, to which both bring their rows; side tells which of the two a row is of (null in cells of one
    block). Every two members of a key so meet once (twice or more only if the rows repeat).
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")
    blocks = sizes.select(key, F.ceil(F.col("rows") / F.lit(most)).alias("blocks"))
    own = F.pmod(F.xxhash64(member), F.col("blocks"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    pairs = F.explode(F.transform(others, lambda q: F.struct(F.least("own", q).alias("i"), F.greatest("own", q).alias("j"))))
    out = merged(rows, blocks, key).withColumn("own", own).withColumn("pair", pairs)
    side = F.when(F.expr("pair.i <> pair.j"), F.col("own") == F.col("pair.i"))
    cell = F.concat_ws("/", F.col(key).cast("string"), "pair.i", "pair.j")
    return out.withColumn("cell", cell).withColumn("side", side).drop("own", "pair", "blocks", key)
