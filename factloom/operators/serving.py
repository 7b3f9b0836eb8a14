"""What the service gives out: filtered links, a sample with a cursor, latest reviews and the topic extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.tables import ACCOUNT_DOMAINS, HOMEPAGE_PATHS, LEFT_OUT_DOMAINS, NEVER_SAMPLED, SOCIAL_DOMAINS, TOPIC_AFTER, TOPIC_WORDS
from factloom.functions.urls import path, registered_domain
from factloom.sources.pages import title as page_title


def satisfies(since: str | None = None, until: str | None = None, misinforming_domain: str | None = None, exclude: Sequence[str] = LEFT_OUT_DOMAINS, fact_checker_domain: str | None = None, no_homepages: bool = True) -> Column:
    """The filter on rows of a link table. Dates are compared as text; each bound may be met by another review."""
    url = F.col("misinforming_url")
    dates = F.filter(F.transform("reviews", lambda r: r["date_published"].cast("string")), lambda d: d.isNotNull())
    ok = ~url.isin(*NEVER_SAMPLED)
    if since:
        ok &= F.exists(dates, lambda d: d >= since)
    if until:
        ok &= F.exists(dates, lambda d: d <= until)
    if misinforming_domain:
        ok &= F.col("misinforming_domain") == misinforming_domain
    elif exclude:
        ok &= ~F.col("misinforming_domain").isin(*exclude)
    if fact_checker_domain:
        ok &= F.exists("reviews", lambda r: r["domain"] == fact_checker_domain)
    if no_homepages:
        ok &= ~path(url).isin(*HOMEPAGE_PATHS)
        if misinforming_domain in ACCOUNT_DOMAINS:
            ok &= F.size(F.filter(F.split(path(url), "/"), lambda p: p != "")) != 1
    return ok


def cursor_sample(links: DataFrame, keep: Column, seed: str, cursor: int) -> DataFrame:
    """The first link that passes from the cursor on, in a shuffled circle, and the next cursor.

    The circle is the order of md5(seed + link). The cursor's place is found by counts of the links by the first hex
    digits of their rank, and only links of one such slice are sorted for it; of the links that pass, the first two from
    there on are the least of two aggregations. Their ranks are kept for these jobs, none of which sorts them all.
    """
    rank = F.md5(F.concat(F.lit(seed), F.col("misinforming_url")))
    keyed = links.select("misinforming_url", "misinforming_domain", rank.alias("rank"), keep.alias("ok")).persist()
    kind = "misinforming_url string, misinforming_domain string, position long, next_cursor long"
    spark = links.sparkSession
    slices = {r["slice"]: r["n"] for r in keyed.groupBy(F.substring("rank", 1, 3).alias("slice")).agg(F.count("*").alias("n")).collect()}  # 4096 at most
    n = sum(slices.values())
    if not n:
        keyed.unpersist()
        return spark.createDataFrame([], kind)
    cursor %= n
    before = 0
    for slice_ in sorted(slices):
        if before + slices[slice_] > cursor:
            break
        before += slices[slice_]
    start = keyed.where(F.substring("rank", 1, 3) == slice_).select("rank").orderBy("rank").limit(cursor - before + 1).agg(F.max("rank")).first()[0]
    behind = F.when(F.col("rank") < start, 1).otherwise(0)
    two = keyed.where("ok").orderBy(behind, "rank", "misinforming_url").limit(2).collect()
    places = []
    for r in two:
        ahead = sum(v for k, v in slices.items() if k < r["rank"][:3])
        places.append(ahead + keyed.where((F.substring("rank", 1, 3) == r["rank"][:3]) & (F.col("rank") < r["rank"])).count())
    keyed.unpersist()
    rows = [(r["misinforming_url"], r["misinforming_domain"], p, places[1] if len(two) > 1 else (cursor - 1) % n) for r, p in list(zip(two, places, strict=True))[:1]]
    return spark.createDataFrame(rows, kind)


def latest(reviews: DataFrame, as_of: str, n: int = 100) -> DataFrame:
    """The n latest reviews that are dated and not of the future."""
    return reviews.where(F.col("date_published") <= F.lit(as_of).cast("date")).orderBy(F.desc("date_published"), "review_id").limit(n)


def latest_with_page(reviews: DataFrame, pages: DataFrame, as_of: str, n: int = 100, first: int = 10) -> DataFrame:
    """Of the n latest reviews the first ten whose page has a title."""
    rows = latest(reviews, as_of, n)
    titled = pages.select("url", page_title(F.col("html")).alias("title")).where("title <> ''").groupBy("url").agg(F.min("title").alias("title"))
    return rows.join(titled, "url").orderBy(F.desc("date_published"), "review_id").limit(first)


def topic_extract(links: DataFrame, words: Sequence[str] = TOPIC_WORDS, after: str = TOPIC_AFTER) -> DataFrame:
    """Columns of the first review of links that are on the topic and recent (no date counts as '0')."""
    first = F.get("reviews", 0)
    dates = F.transform("reviews", lambda r: F.coalesce(r["date_published"].cast("string"), F.lit("0")))
    text = F.lower(F.concat_ws(" ", first["claim_reviewed"], first["review_url"]))
    about = F.lit(False)
    for w in words:
        about |= F.contains(text, F.lit(w))
    rows = links.where(about & (F.array_max(dates) > after))
    one_line = lambda c: F.replace(c, F.lit("\n"), F.lit("\\n"))
    return rows.select("misinforming_url", "misinforming_domain", one_line(first["claim_reviewed"]).alias("claim"), first["review_url"].alias("review_url"), first["domain"].alias("fact_checker"), first["label"].alias("label"), F.size("reviews").cast("long").alias("n_reviews"), F.array_max(dates).alias("last_date"))


def topic_recent(links: DataFrame, after: str = TOPIC_AFTER) -> DataFrame:
    """Links with a review after a day (no date counts as '0'), and their last date."""
    last = F.array_max(F.transform("reviews", lambda r: F.coalesce(r["date_published"].cast("string"), F.lit("0"))))
    return links.withColumn("last_date", last).where(F.col("last_date") > after)


def topic_package(extracts: dict[str, DataFrame], path: str, date: str) -> dict[str, int]:
    """Each extract as tab-separated text below path/date, and how many rows it has."""
    counts = {}
    for name, rows in extracts.items():
        rows.write.mode("overwrite").option("escape", '"').csv(f"{path}/{date}/{name}", sep="\t", header=True)
        counts[name] = rows.count()
    return counts


def article(html: Column) -> Column:
    """title, description and the length of the text of a page, of what there is."""
    meta = lambda name: F.regexp_extract(html, rf'(?is)<meta[^>]*(?:name|property)="{name}"[^>]*content="([^"]*)"', 1)
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    words = F.trim(F.regexp_replace(text, r"\s+", " "))
    title = F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
    return F.struct(
        F.nullif(F.coalesce(F.nullif(title, F.lit("")), meta("og:title")), F.lit("")).alias("title"),
        F.nullif(F.coalesce(F.nullif(meta("description"), F.lit("")), meta("og:description")), F.lit("")).alias("description"),
        F.length(words).cast("long").alias("text_length"),
    )


def not_social(domain: Column) -> Column:
    return ~domain.isin(*SOCIAL_DOMAINS)


def first_per_checker(reviews: DataFrame, n: int = 100) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("date_published"), "url", "review_id"))
    return reviews.withColumn("domain", registered_domain(F.col("url"))).withColumn("place", place).where(F.col("place") <= n)


def snapshots(index: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Entries of the snapshot index by the text of their date; `latest` comes after every date."""
    out = index
    if since:
        out = out.where(F.col("date") >= since)
    if until:
        out = out.where(F.col("date") <= until)
    return out


def daily(index: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """The snapshots in a range, the latest first."""
    return snapshots(index, since, until).orderBy(F.desc("date"))


def sample(links: DataFrame, seed: str, cursor: int | None = None, since: str = "2019-01-01", until: str | None = None, misinforming_domain: str | None = None, exclude: Sequence[str] = LEFT_OUT_DOMAINS, fact_checker_domain: str | None = None, no_homepages: bool = True) -> DataFrame:
    """What the sample route gives: the first link from the cursor on that satisfies the filter, its place and the next
    cursor; without a cursor, or with one beyond the links, from a place that follows from the seed."""
    n = links.count()
    if cursor is None or not 0 <= cursor < n:
        cursor = int(links.sparkSession.range(1).select(F.pmod(F.xxhash64(F.lit(seed)), F.lit(max(1, n))).alias("c")).first()["c"])
    found = cursor_sample(links, satisfies(since, until, misinforming_domain, exclude, fact_checker_domain, no_homepages), seed, cursor)
    return found.withColumn("current_cursor", F.lit(cursor).cast("long"))
