"""Joins with the registry and other dimensions, counts, and set operations."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from factloom.functions.ratings import clean_label, label_prefixes
from factloom.functions.urls import registered_domain
from factloom.session import ship


def with_registry(reviews: DataFrame, registry: DataFrame, how: str = "inner") -> DataFrame:
    """reviews ⋈ registry by domain; how: inner, left_semi or left_anti. Spark broadcasts the registry if it is small."""
    return reviews.withColumn("domain", registered_domain(F.col("url"))).join(registry, "domain", how)


def recollection(before: DataFrame, after: DataFrame, registry: DataFrame) -> DataFrame:
    """domain, before, after, ratio of registered domains with any row before."""
    count = lambda rows, name: rows.withColumn("domain", registered_domain(F.col("url"))).groupBy("domain").agg(F.count("*").alias(name))
    out = registry.select("domain").join(count(before, "before"), "domain").join(count(after, "after"), "domain", "left").fillna(0, ["after"])
    return out.withColumn("ratio", F.try_divide(F.col("after").cast("double"), F.col("before")))


def prefix_labels(spark, reviews: DataFrame) -> DataFrame:
    """review_id, simplified by a join on label beginnings (a table of fixed size)."""
    table = spark.createDataFrame(list(label_prefixes().items()), "prefix string, simplified string")
    rows = reviews.select("review_id", clean_label(F.col("alternate_name")).alias("l"))
    labels = rows.select("l").where("l IS NOT NULL").distinct()
    known = labels.join(F.broadcast(table), F.startswith("l", "prefix")).groupBy("l").agg(F.min("simplified").alias("simplified"))
    return rows.join(known, "l", "left").select("review_id", "simplified")


def country_distribution(reviews: DataFrame, registry: DataFrame) -> DataFrame:
    rows = reviews.withColumn("domain", registered_domain(F.col("url"))).groupBy("domain").agg(F.count_distinct("url").alias("n"))
    return registry.join(rows, "domain", "left").groupBy("country").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n_urls"))


def newest_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key the last row by order."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def merged_by_precedence(frames: list[DataFrame], key: str) -> DataFrame:
    """Union of frames in which later ones win over earlier ones."""
    rows = [f.withColumn("_rank", F.lit(i)) for i, f in enumerate(frames)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return newest_by_key(out, key, "_rank").drop("_rank")


def overlaid(rows: DataFrame, later: DataFrame, key: str, order: str) -> DataFrame:
    """All of rows, each replaced by the last (by order) of later's rows of its key if there is any; and later's other keys.

    Rows that share a key stay as many as they are.
    """
    last = later.groupBy(key).agg(F.max_by(F.struct(*later.columns), order).alias("_last"))
    out = rows.join(last, key, "left").select(*[F.when(F.col("_last").isNotNull(), F.col("_last")[c]).otherwise(F.col(c)).alias(c) for c in rows.columns])
    return out.unionByName(last.join(rows.select(key), key, "left_anti").select("_last.*"))


def unknown(new: DataFrame, stored: DataFrame, key: str = "url") -> DataFrame:
    return new.join(stored.select(key).distinct(), key, "left_anti")


def agreeing(rows: DataFrame, key: str) -> DataFrame:
    """key, label, sources of keys on which all rows agree."""
    out = rows.groupBy(key).agg(F.count_distinct("label").alias("n"), F.min("label").alias("label"), F.array_join(F.array_sort(F.collect_set("retrieved_by")), ",").alias("sources"))
    return out.where("n = 1").drop("n")


def leaf_paths(value, path: str = "") -> list[str]:
    """Dotted paths of all leaves, without array positions; keys that begin with ifcn_info are passed over."""
    if isinstance(value, dict) and value:
        return [p for k, v in value.items() if not k.startswith("ifcn_info") for p in leaf_paths(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list) and value:
        return [p for v in value for p in leaf_paths(v, path)]
    return [path] if path else []


@F.pandas_udf(ArrayType(StringType()))
def _leaf_paths(rows: pd.Series) -> pd.Series:
    def of(text: str | None) -> list[str]:
        try:
            return leaf_paths(json.loads(text)) if text else []
        except ValueError:
            return []

    return rows.map(of)


def json_path_counts(rows: DataFrame, column: str) -> DataFrame:
    """path, n of the leaves of JSON documents of any depth; what can't be parsed counts for nothing."""
    ship(rows.sparkSession)
    return rows.select(F.explode(_leaf_paths(column)).alias("path")).groupBy("path").agg(F.count("*").alias("n"))


def link_path_counts(rows: DataFrame, column: str) -> DataFrame:
    """json_path_counts of paths whose last key speaks of links."""
    last = F.element_at(F.split("path", r"\."), -1)
    return json_path_counts(rows, column).where(last.rlike("url|appearance|sameAs"))
