"""Reviews of tweets: the status links among appearances, one record a tweet, and the job's counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.urls import status_id
from factloom.operators.reviews import review_links, verdict


def status_links(reviews: DataFrame, registry: DataFrame) -> DataFrame:
    """Links of registered fact-checkers' reviews with tweet_id (null for links that are no status)."""
    rows = review_links(reviews).join(registry.select("domain").distinct(), "domain", "left_semi")
    return rows.withColumn("tweet_id", status_id(F.col("link")))


def tweet_reviews(links: DataFrame, tweets: DataFrame) -> DataFrame:
    """tweet_id, label (check_me where reviews differ), n_reviews, n_labels, the reviews in order, and what is known of the
    tweet: tweets(id, text, created_at, screen_name, lang); null where it can't be had."""
    review = F.struct("review_id", "label", "alternate_name", "claim_reviewed", F.col("url").alias("review_url"), "retrieved_by")
    found = links.where("tweet_id IS NOT NULL").groupBy("tweet_id").agg(
        verdict(F.col("label")).alias("label"),
        F.count("*").alias("n_reviews"),
        F.count_distinct("label").alias("n_labels"),
        F.array_sort(F.collect_list(review)).alias("reviews"),
    )
    known = tweets.dropDuplicates(["id"]).withColumnRenamed("id", "tweet_id")
    return found.join(known, "tweet_id", "left")


def tweet_stats(reviews: DataFrame, registry: DataFrame, tweets: DataFrame) -> DataFrame:
    """One row of six counters. Reviews without any link count among those without a tweet."""
    links = status_links(reviews, registry)
    found = tweet_reviews(links, tweets)
    made = found.agg(
        F.count("*").alias("tweet_reviews"),
        F.count_if(F.col("text").isNull()).alias("tweets_not_found"),
        F.count_if(F.col("n_reviews") > 1).alias("tweets_of_several_reviews"),
        F.count_if(F.col("n_labels") > 1).alias("tweets_disagreeing"),
    )
    other = links.agg(F.count_if(F.col("tweet_id").isNull()).alias("links_without_tweet"), F.count_distinct(F.when(F.col("tweet_id").isNotNull(), F.col("review_id"))).alias("with_tweet"))
    from factloom.operators.relations import with_registry

    all_reviews = with_registry(reviews, registry.select("domain").distinct(), "left_semi").agg(F.count("*").alias("n"))
    return made.crossJoin(other).crossJoin(all_reviews).select(*made.columns, "links_without_tweet", (F.col("n") - F.col("with_tweet")).alias("reviews_without_tweet"))  # one row each


def labels_of_tweets(links: DataFrame) -> DataFrame:
    """label, original_labels (distinct, in order) of reviews of tweets."""
    rows = links.where("tweet_id IS NOT NULL")
    return rows.groupBy("label").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("alternate_name", F.lit("")))), "|").alias("original_labels"))
