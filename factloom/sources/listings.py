"""Listing pages of fact-checkers: saved pages (source, number, html) to article rows, and the rules that end a crawl.

Each source is described by selectors, not by code. A row keeps its place, so that rules about the order of a
crawl (stop at the first repeated article, stop after so many known ones) are window expressions over it.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.dates import day_of
from factloom.functions.markup import parsed, select
from factloom.functions.ratings import simplified_label
from factloom.session import ship

FIELDS = ["url", "title", "subtitle", "claim", "author", "original_label", "date", "country"]
ROWS = "source string, number long, place long, next string, " + ", ".join(f"{f} string" for f in FIELDS)


@dataclass(frozen=True)
class Listing:
    """item: selector of an article; fields: selector and attribute (None: text) of each, where the article has them."""

    item: str
    fields: dict[str, tuple[str, str | None]]
    base: str = ""
    next: str = ""


#: Where each source's listing pages hold what.
LISTINGS: dict[str, Listing] = {
    "snopes": Listing("main.base-main article.media-wrapper", {"url": ("a.fact_check", "href"), "title": ("h5.title", None), "subtitle": ("p.subtitle", None), "date": ("span.date", None)}),
    "politifact": Listing("div.m-statement", {"url": ("div.m-statement__quote a", "href"), "claim": ("div.m-statement__quote a", None), "author": ("div.m-statement__author a", None), "original_label": ("div.m-statement__meter img", "alt"), "date": ("footer.m-statement__footer", None)}, "https://www.politifact.com"),
    "factcheck_org": Listing("main#main article", {"url": ("h3.entry-title a", "href"), "title": ("h3.entry-title a", None), "subtitle": ("div.entry-content p", None), "date": ("header.entry-header div.entry-meta", None)}),
    "factcheckni": Listing("main#main article", {"url": ("h2.entry-title a", "href"), "title": ("h2.entry-title a", None), "subtitle": ("div.entry-content p", None), "date": ("header.entry-header div.entry-meta time.entry-date", "datetime")}),
    "leadstories": Listing("article", {"url": ("a", "href"), "title": ("h1", None), "subtitle": ("p.mod-default-article-description", None), "date": ("time", "datetime"), "original_label": ("span.caption-overlay", None)}),
    "istinomer": Listing("article", {"url": ("a", "href"), "claim": ("h2.posttitle a", None)}),
    "weeklystandard": Listing("ul.ThumbnailAuthorDateList-items li div.ThumbnailAuthorDatePromo-info", {"url": ("a.Link", "href"), "title": ("a.Link", None)}, next="li.ColumnList-nextPage a"),
    "teyit_org": Listing("article", {"url": ("div a", "href")}),
    "fullfact": Listing("div.postlist-item", {"url": ("h2.postlist-item-heading a", "href"), "title": ("h2.postlist-item-heading a", None), "subtitle": ("p", None)}, "https://fullfact.org"),
    "fullfact_feed": Listing("li", {"url": ("a", "href"), "title": ("a", None), "date": ("small.date", None)}, "https://fullfact.org"),
    "euvsdisinfo": Listing("div.disinfo-db-post", {"url": ("a", "href"), "title": ("td.cell-title", None), "date": ("td.disinfo-db-date", None), "country": ("td.cell-country", None)}, "https://euvsdisinfo.eu"),
}


def articles(html: str, listing: Listing) -> tuple[list[dict], str | None]:
    """The articles of a page, in order, and the address of the next page if it names one."""
    top = parsed(html)
    found = []
    for item in select(top, listing.item):
        row = {}
        for name, (selector, attr) in listing.fields.items():
            hits = select(item, selector)
            row[name] = None if not hits else hits[0].attrs.get(attr) if attr else hits[0].text().strip()
        if row["url"]:
            row["url"] = listing.base + row["url"]
            found.append(row)
    onward = select(top, listing.next) if listing.next else []
    return found, onward[0].attrs.get("href") if onward else None


def listing_rows(pages: DataFrame) -> DataFrame:
    """Raw rows of saved pages (source, number, html); pages of unknown sources and nulls give none."""

    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ROWS.split(", "))])

    def work(batches):
        for batch in batches:
            out = []
            for source, number, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if source in LISTINGS and html:
                    rows, onward = articles(html, LISTINGS[source])
                    out += [{"source": source, "number": number, "place": i, "next": onward} | r for i, r in enumerate(rows)]
            yield pa.RecordBatch.from_pylist(out, schema)

    ship(pages.sparkSession)
    return pages.select("source", F.col("number").cast("long").alias("number"), "html").mapInArrow(work, ROWS)


def cleaned(rows: DataFrame) -> DataFrame:
    """Listing rows with days, simplified labels and claims: what follows the last dot of a date line is its date, and a
    claim may be a subtitle that says so."""
    said = F.when(F.startswith("subtitle", F.lit("CLAIM: ")), F.replace("subtitle", F.lit("CLAIM: "), F.lit("")))
    when = F.trim(F.element_at(F.split("date", "•"), -1))
    return rows.withColumn("label", simplified_label(F.col("original_label"))).withColumn("claim", F.coalesce("claim", said)).withColumn("date", F.coalesce(day_of(when).cast("string"), when))


def _order() -> list[Column]:
    return [F.col("number"), F.col("place")]


def until_repeated(rows: DataFrame) -> DataFrame:
    """Rows of each source before the first article (url and date) that came before."""
    seen = F.row_number().over(Window.partitionBy("source", "url", "date").orderBy(*_order())) > 1
    ended = F.max(F.col("seen").cast("int")).over(Window.partitionBy("source").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("seen", seen).withColumn("ended", ended).where("ended = 0").drop("seen", "ended")


def until_known(rows: DataFrame, stored: DataFrame, most: int) -> DataFrame:
    """New rows of each source up to where `most` in a row were stored (url) already."""
    known = stored.select("url").distinct().withColumn("known", F.lit(1))
    rows = rows.join(known, "url", "left").withColumn("known", F.coalesce("known", F.lit(0)))
    along = Window.partitionBy("source").orderBy(*_order())
    rows = rows.withColumn("fresh", F.sum(1 - F.col("known")).over(along))
    run = F.sum("known").over(Window.partitionBy("source", "fresh").orderBy(*_order()))
    ended = F.max((F.col("run") >= most).cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("run", run).withColumn("ended", ended).where("ended = 0 AND known = 0").drop("known", "fresh", "run", "ended")


def last_of_each(rows: DataFrame, key: str = "url") -> DataFrame:
    """Of rows with equal key the last of the crawl."""
    place = F.row_number().over(Window.partitionBy("source", key).orderBy(*[c.desc() for c in _order()]))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def merged_listings(frames: list[DataFrame]) -> DataFrame:
    """Several crawls of one source as one: of equal links the right-most crawl's row stays."""
    from factloom.operators.relations import merged_by_precedence

    return merged_by_precedence(frames, "url")
