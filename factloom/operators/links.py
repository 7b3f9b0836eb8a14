"""Links followed to where they end: through known redirects, web archives and chains of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.urls import canonical, form_target, is_archive, registered_domain, unwrapped
from factloom.operators.scratch import kept

#: Keys of redirects count up to so many characters.
KEY = 1000


def page_address(link: Column) -> Column:
    """Where an archive says what a link is of: perma.cc in its public answer, the others in the page itself."""
    number = F.regexp_extract(link, r"^https?://(?:www\.)?perma\.cc/([^/?#]+)", 1)
    return F.when(number != "", F.concat(F.lit("https://perma.cc/api/v1/public/archives/"), number, F.lit("/?format=json"))).otherwise(link)


def known_steps(redirects: DataFrame) -> DataFrame:
    """key, next (a key), to (as it was saved) of redirects(url, to); of several for one key the smallest."""
    rows = redirects.where("url IS NOT NULL AND to IS NOT NULL").groupBy(F.substring("url", 1, KEY).alias("key")).agg(F.min("to").alias("to"))
    return rows.select("key", canonical(F.col("to")).alias("next"), "to")


def archive_steps(links: DataFrame, pages: DataFrame) -> DataFrame:
    """key, next, to of archive links(key): by their address (web.archive.org), or by the saved page(url, html) of others.

    Links that an archive can't resolve have no step.
    """
    saved = pages.where(is_archive(F.col("url"))).groupBy(canonical(F.col("url")).alias("address")).agg(F.min("html").alias("html"))
    asked = links.withColumn("address", canonical(page_address(F.col("key")))).join(saved, "address", "left")
    answer = F.get_json_object("html", "$.url")
    target = F.when(registered_domain(F.col("key")) == "archive.org", unwrapped(F.col("key"))).when(registered_domain(F.col("key")) == "perma.cc", answer).otherwise(form_target(F.col("html"), registered_domain(F.col("key"))))
    return asked.select("key", canonical(target).alias("next"), target.alias("to"))


def steps(links: DataFrame, redirects: DataFrame, pages: DataFrame) -> DataFrame:
    """key, next, to: all redirects, and those archive links without one that are among links(key) or that a step leads to.

    An archive's target may be an archive's link again, so they are looked up in rounds until none is new; each round needs
    only what the round before has found.
    """
    onward = "to IS NOT NULL AND key <> coalesce(next, '')"  # a link that leads to itself has no step
    known = kept(known_steps(redirects), "redirects").where(onward)
    archives = lambda rows, c: rows.select(F.col(c).alias("key")).where(is_archive(F.col("key")))
    found, new = known, archives(links, "key").union(archives(known, "next")).distinct()
    while True:
        more = kept(archive_steps(new.join(found.select("key"), "key", "left_anti"), pages), "archives").where(onward)
        if more.isEmpty():
            return found
        found, new = found.unionByName(more), archives(more, "next").distinct()


def ends(edges: DataFrame) -> DataFrame:
    """key, to: the end of the chain that begins with each key of edges(key, next, to); keys that lead into a cycle are left out.

    Pointer doubling: each round a pointer becomes that of where it points, so a chain of n steps takes log2(n) rounds. As long as
    any chain is unfinished, the next round finishes some of it; so once a round finishes none, only cycles are left.
    """
    now = kept(edges.join(edges.select(F.col("key").alias("next"), F.lit(True).alias("on")), "next", "left").select("key", "next", "to", F.coalesce("on", F.lit(False)).alias("open")), "pointers")
    done, now, left = now.where("NOT open"), now.where("open"), None
    while (n := now.count()) and n != left:
        left = n
        all_ = done.unionByName(now)
        ahead = all_.select(F.col("key").alias("next"), F.col("next").alias("_next"), F.col("to").alias("_to"), F.col("open").alias("_open"))
        moved = kept(now.join(ahead, "next").select("key", F.col("_next").alias("next"), F.col("_to").alias("to"), F.col("_open").alias("open")), "pointers")
        done, now = done.unionByName(moved.where("NOT open")), moved.where("open")
    return done.select("key", "to")


def resolved_links(rows: DataFrame, redirects: DataFrame, pages: DataFrame, column: str = "url") -> DataFrame:
    """rows with each link replaced by the end of its chain; redirects(url, to), pages(url, html).

    A step: a known redirect wins; else a link of an archive gives way to what it is a snapshot of. A link without a step is in
    its canonical form, and so is one that leads into a cycle, or that an archive can't resolve. Null or unsound links become null.
    Of a shortener without a saved redirect nothing is known, so it stays.
    """
    asked = rows.withColumn("_own", canonical(F.col(column)))
    edges = steps(asked.select(F.col("_own").alias("key")).where("key IS NOT NULL"), redirects, pages)
    known = ends(edges).select(F.col("key").alias("_own"), F.col("to").alias("_to"))
    return asked.join(known, "_own", "left").withColumn(column, F.coalesce("_to", "_own")).select(*rows.columns)
