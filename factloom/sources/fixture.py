"""Reviews made from the synthetic tables by plain arithmetic, so that SQL can make the same.

Four documents review each page; their claims are the first sentence of the page's base document with small or large changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.urls import registered_domain

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: The label of a review by doc_id % 12 (None: no label).
RAW_LABELS = ["False", " TRUE ", "mostly true, but outdated", "Fact Crescendo Rating: False", "not_verifiable", "", None, "no idea", "Half True", "This is correct - almost", "Unsubstantiated", "Credible statement"]
ENDINGS = ["", "!", " but something entirely different", "?!"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their hosts spread over sites: seven numbers, one page in eleven below a two-label suffix."""
    site = F.concat(F.lit(".site"), (F.col("page_id") % 7).cast("string"))
    abroad = F.regexp_replace("url", r"\.example\.(com|net|org)", F.concat(site, F.lit(".gov.br")))
    url = F.when(F.col("page_id") % 11 == 0, abroad).otherwise(F.replace("url", F.lit(".example."), F.concat(site, F.lit("."))))
    return table(spark, sf_dir, "pages").withColumn("url", url)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """review_id, url, k, claim_reviewed, alternate_name, best, worst, value, appearance, date_published, retrieved_by."""
    docs, pages = table(spark, sf_dir, "documents"), site_pages(spark, sf_dir)
    n = pages.count()
    d = docs.select(F.col("doc_id").alias("review_id"), F.col("source").alias("retrieved_by"), (F.col("doc_id") % n).alias("base"), F.floor(F.col("doc_id") / n).alias("k"))
    d = d.withColumn("a1", (F.col("review_id") * 7 + 1) % n).withColumn("a2", (F.col("review_id") * 13 + 5) % n)
    base = docs.where(F.col("doc_id") < n).select(F.col("doc_id").alias("base"), F.regexp_extract("text", r"^([^.\n]*)", 1).alias("opening"))
    link = lambda name: pages.select(F.col("page_id").alias(name), F.col("url").alias(f"{name}_url"))
    d = d.join(base, "base").join(link("base"), "base").join(link("a1"), "a1").join(link("a2"), "a2")
    label = F.lit(None).cast("string")
    for i, text in enumerate(RAW_LABELS):
        label = F.when(F.col("review_id") % 12 == i, F.lit(text).cast("string")).otherwise(label)
    ending = F.lit(ENDINGS[3])
    for i, text in enumerate(ENDINGS[:3]):
        ending = F.when(F.col("k") == i, text).otherwise(ending)
    unrated = F.col("review_id") % 11 == 0
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("review_id") % 30).cast("int"))
    return d.select(
        "review_id",
        F.col("base_url").alias("url"),
        F.col("k").cast("long").alias("k"),
        F.concat("opening", ending).alias("claim_reviewed"),
        label.alias("alternate_name"),
        F.when(unrated, -1).otherwise(5).alias("best"),
        F.when(unrated, -1).otherwise(1).alias("worst"),
        (F.col("review_id") % 7).cast("int").alias("value"),
        F.when(F.col("review_id") % 3 == 0, F.concat("a1_url", F.lit(", "), "a2_url")).otherwise(F.col("a1_url")).alias("appearance"),
        F.when(F.col("review_id") % 17 == 0, None).otherwise(day).alias("date_published"),
        "retrieved_by",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """domain, country of the known fact-checkers: domains of the pages of four sites in seven."""
    pages, nation = site_pages(spark, sf_dir), table(spark, sf_dir, "nation")
    rows = pages.where("page_id % 7 < 4").select(registered_domain(F.col("url")).alias("domain"), (F.col("page_id") % 25).cast("int").alias("n_nationkey"))
    return rows.join(nation, "n_nationkey").groupBy("domain").agg(F.min("n_name").alias("country"))


def redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, to: every seventh page leads to the next one."""
    pages = table(spark, sf_dir, "pages")
    ahead = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("to"))
    return pages.where("page_id % 7 = 0").select("page_id", "url").join(ahead, "page_id").groupBy("url").agg(F.min("to").alias("to"))
