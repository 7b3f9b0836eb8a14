"""Reviews: labels, clusters merged into one record, and the links that they are about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.ratings import credibility_label
from factloom.functions.urls import appearances, registered_domain
from factloom.operators.clustering import claim_clusters
from factloom.operators.relations import recollection
from factloom.operators.scratch import kept

#: "First" among reviews: by date, those without one last, then by number.
FIRST = ("date_published", "review_id")


def labelled(reviews: DataFrame) -> DataFrame:
    """reviews with label and domain."""
    return reviews.withColumn("label", credibility_label(F.col("alternate_name"), F.col("value"), F.col("best"), F.col("worst"))).withColumn("domain", registered_domain(F.col("url")))


def review_links(reviews: DataFrame) -> DataFrame:
    """One row for each single review and link: the labelled review's columns and `link`."""
    links = appearances(F.array("appearance"), F.col("url"))
    return labelled(reviews).withColumn("link", F.explode(links))


def records(reviews: DataFrame) -> DataFrame:
    """merged(reviews), written once for all tables that are made of it."""
    return kept(merged(reviews), "records")


def as_records(rows: DataFrame) -> DataFrame:
    """Merged records as they are; single reviews are merged first."""
    return rows if "appearances" in rows.columns else merged(rows)


def links_of(rows: DataFrame) -> DataFrame:
    """One row for each merged record and link: link, url, cluster, domain, label and claim_text (all texts) of the record and,
    of its first review, review_id, claim_reviewed, alternate_name, date_published, retrieved_by. rows: reviews or records."""
    first = F.get("reviews", 0)
    out = as_records(rows).withColumn("link", F.explode("appearances"))
    return out.select("link", "url", "cluster", "domain", "label", "claim_text", *[first[c].alias(c) for c in ("review_id", "claim_reviewed", "alternate_name", "date_published", "retrieved_by")])


def verdict(label: Column) -> Column:
    """The one label of a group, or check_me if there are several."""
    return F.when(F.count_distinct(label) > 1, "check_me").otherwise(F.min(label))


def merged(reviews: DataFrame) -> DataFrame:
    """One record for each page and cluster of claims: texts, label, links and the reviews in order.

    A record is as large as its cluster of reviews of one page, as its sink wants it. Domain and links are found once a record.
    """
    spread = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, but much to compute: not to be put together
    rows = labelled(reviews).join(claim_clusters(reviews).select("review_id", "cluster"), "review_id").drop("domain").repartition(spread, "url", "cluster")
    review = F.struct(F.coalesce(F.col("date_published").cast("string"), F.lit("9999")).alias("sort"), "review_id", "label", "alternate_name", "retrieved_by", "date_published", F.trim("claim_reviewed").alias("claim_reviewed"))
    out = rows.groupBy("url", "cluster").agg(
        F.array_sort(F.collect_set(F.trim("claim_reviewed"))).alias("claim_text"),
        verdict(F.col("label")).alias("label"),
        F.collect_set("appearance").alias("raw"),
        F.array_sort(F.collect_list(review)).alias("reviews"),
    ).withColumn("domain", registered_domain(F.col("url")))
    return out.select("url", "cluster", "domain", "claim_text", "label", appearances(F.col("raw"), F.col("url"), F.col("domain")).alias("appearances"), "reviews")


def different_texts(rows: DataFrame) -> DataFrame:
    """url, cluster, claim_text, n_clusters of the records of pages whose claims fall into several clusters."""
    merged_rows = as_records(rows).select("url", "cluster", "claim_text")
    several = merged_rows.groupBy("url").agg(F.count("*").alias("n_clusters")).where("n_clusters > 1")
    return merged_rows.join(several, "url")


def link_conflicts(reviews: DataFrame) -> DataFrame:
    """link, n_labels, n_reviews, final_label of every link; final_label is check_me where labels differ."""
    return links_of(reviews).groupBy("link").agg(F.count_distinct("label").alias("n_labels"), F.count("*").alias("n_reviews"), verdict(F.col("label")).alias("final_label"))


def disagreeing(reviews: DataFrame) -> DataFrame:
    return link_conflicts(reviews).where("n_labels > 1")


def disagreeing_records(rows: DataFrame) -> DataFrame:
    """link, and the whole record of each review of links whose records have several labels; a row for each link and record."""
    links = as_records(rows).withColumn("link", F.explode("appearances"))
    several = links.groupBy("link").agg(F.count_distinct("label").alias("n")).where("n > 1").select("link")
    return links.join(several, "link")


def link_table(reviews: DataFrame, only: str | None = None) -> DataFrame:
    """misinforming_url, misinforming_domain and the reviews of each link, in order; only: of one label."""
    rows = links_of(reviews)
    rows = rows.where(F.col("label") == only) if only else rows
    review = F.struct(F.coalesce(F.col("date_published").cast("string"), F.lit("9999")).alias("sort"), "review_id", "label", F.col("url").alias("review_url"), "claim_reviewed", "claim_text", "domain", "alternate_name", "date_published")
    out = rows.groupBy(F.col("link").alias("misinforming_url")).agg(F.array_sort(F.collect_list(review)).alias("reviews"))
    return out.withColumn("misinforming_domain", registered_domain(F.col("misinforming_url")))


def multi_reviewed(reviews: DataFrame) -> DataFrame:
    """link, n_domains, domains of links that two or more fact-checkers reviewed."""
    rows = links_of(reviews).groupBy("link").agg(F.array_sort(F.collect_set("domain")).alias("d"))
    return rows.where(F.size("d") > 1).select("link", F.size("d").cast("long").alias("n_domains"), F.array_join("d", ",").alias("domains"))


def last_by_domain(links: DataFrame) -> DataFrame:
    """link, domain, r (the last review), i (the domain's place by name), n (domains) of links of two domains or more."""
    last = links.groupBy("link", "domain").agg(F.max_by(F.struct("url", "label", "alternate_name"), "review_id").alias("r"))
    place = F.row_number().over(Window.partitionBy("link").orderBy("domain")) - 1
    count = F.count("*").over(Window.partitionBy("link"))
    return last.withColumn("i", place).withColumn("n", count).where("n > 1")


def wide_reviews(reviews: DataFrame, least: int = 3, most: int | None = None) -> DataFrame:
    """Links of two domains or more, with the last review of each domain side by side.

    There are columns for as many domains as any link has, and for `least` at least. With `most`, for as many at any time: then
    n_domains still counts all, and reviews_beyond has the others.
    """
    links = links_of(reviews).select("link", "domain", "url", "label", "alternate_name", "review_id")
    widest = most
    if most is None:
        links = kept(links, "links")
        widest = max(least, links.groupBy("link").agg(F.count_distinct("domain").alias("n")).agg(F.max("n")).first()[0] or 0)
    rows = last_by_domain(links)
    pick = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    cols = [pick(i, c).alias(f"{name}_{i}") for i in range(widest) for c, name in (("domain", "review_domain"), ("r.url", "review_url"), ("r.label", "label"), ("r.alternate_name", "original_label"))]
    return rows.groupBy("link").agg(F.count("*").alias("n_domains"), *cols)


def reviews_beyond(reviews: DataFrame, first: int) -> DataFrame:
    """link, place (from 0), review_domain, review_url, label, original_label of the domains that wide_reviews of `most` = first has
    no columns for, a row each."""
    rows = last_by_domain(links_of(reviews).select("link", "domain", "url", "label", "alternate_name", "review_id")).where(F.col("i") >= first)
    return rows.select("link", F.col("i").cast("long").alias("place"), F.col("domain").alias("review_domain"), F.col("r.url").alias("review_url"), "r.label", F.col("r.alternate_name").alias("original_label"))


def first_review(reviews: DataFrame) -> DataFrame:
    """link and its first review."""
    rows = links_of(reviews)
    order = F.struct(F.coalesce(F.col("date_published").cast("string"), F.lit("9999")), "review_id")
    return rows.groupBy("link").agg(F.min_by(F.struct("review_id", "url", "label"), order).alias("r")).select("link", "r.review_id", "r.url", "r.label")


def label_mapping(reviews: DataFrame) -> DataFrame:
    """label, original_label, n, domains (of the original label under any label), most frequent first."""
    rows = labelled(reviews).withColumn("original_label", F.coalesce("alternate_name", F.lit("")))
    counts = rows.groupBy("label", "original_label").agg(F.count("*").alias("n"))
    domains = rows.groupBy("original_label").agg(F.array_join(F.array_sort(F.collect_set("domain")), ",").alias("domains"))
    return counts.join(domains, "original_label").orderBy(F.desc("n"), "label", "original_label")


def job_stats(reviews: DataFrame, registry: DataFrame, known: DataFrame | None = None, made_of: DataFrame | None = None) -> DataFrame:
    """One row of the job's counters, and recollection: domain, before, after, ratio of each registered domain with reviews.

    known: the reviews collected again from registered fact-checkers' pages, which are merged; without them, theirs among
    `reviews` are taken. They count among the raw ones too. made_of: the records that known was merged into, if they are there.
    """
    members = registry.select("domain", F.lit(1).alias("member")).distinct()
    rows = reviews.withColumn("domain", registered_domain(F.col("url"))).join(members, "domain", "left")
    known = rows.where("member IS NOT NULL").select(*reviews.columns) if known is None else known
    unknown = F.col("member").isNull()
    base = rows.agg(
        F.count("*").alias("raw"),
        F.count_distinct(F.when(unknown, F.col("url"))).alias("urls_not_registered"),
        F.count_distinct(F.when(unknown, F.col("domain"))).alias("domains_not_registered"),
    )
    again = known.agg(F.count("*").alias("recollected_reviews"), F.count_distinct("url").alias("review_urls"))
    single = (merged(known) if made_of is None else made_of).select("url", "cluster", "label", F.explode_outer("appearances").alias("link"))
    record = F.struct("url", "cluster")
    made = single.agg(
        F.count_distinct(record).alias("merged_reviews"),
        F.count_distinct("link").alias("unique_appearances"),
        F.count_distinct(F.when(F.col("label") == "check_me", record)).alias("not_matching_labels"),
        F.count_distinct(F.when(F.col("label") == "not_credible", F.col("link"))).alias("links_not_credible"),
    )
    compared = recollection(reviews, known, registry).agg(F.array_sort(F.collect_list(F.struct("domain", "before", "after", "ratio"))).alias("recollection_stats"))  # as many as are registered
    out = base.crossJoin(again).crossJoin(made).crossJoin(registry.agg(F.count_distinct("domain").alias("registered_domains"))).crossJoin(compared)  # one row each
    return out.withColumn("raw_reviews", F.col("raw") + F.col("recollected_reviews")).drop("raw")
