"""Review documents inside web pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from factloom.session import ship

TOO_LARGE = 10_000_000


def fetched(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """url, html from a page cache; pages over ten million bytes give TOO LARGE, unknown ones null."""
    html = F.when(F.octet_length("html") > TOO_LARGE, "TOO LARGE").otherwise(F.col("html"))
    return urls.join(pages.select("url", html.alias("html")).dropDuplicates(["url"]), "url", "left")


def title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?i)<title\b[^>]*>([^<]*)</title>", 1)


def repaired(raw: Column) -> Column:
    """JSON as it is, or with the quotes inside claimReviewed made harmless if that makes it parse."""
    inner = F.regexp_extract(raw, r'(?s)"claimReviewed"\s*:\s*"(.*?)"\s*(?:,\s*"|\})', 1)
    fixed = F.replace(raw, inner, F.replace(F.replace(inner, F.lit('\\"'), F.lit('"')), F.lit('"'), F.lit('\\"')))
    return F.when(F.try_parse_json(raw).isNotNull(), raw).otherwise(fixed)


def jsonld(pages: DataFrame) -> DataFrame:
    """url, doc (VARIANT) of every ClaimReview in JSON-LD scripts: at the top, or else inside @graph; url is the page's."""
    scripts = F.regexp_extract_all("html", F.lit(r"(?is)<script[^>]*ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    docs = pages.select("url", F.posexplode(scripts).alias("n", "raw")).select("url", "n", F.try_parse_json(repaired(F.col("raw"))).alias("doc"))
    docs = docs.where("doc IS NOT NULL")
    items = docs.selectExpr("url", "n", "CASE WHEN schema_of_variant(doc) LIKE 'ARRAY%' THEN from_json(to_json(doc), 'array<string>') ELSE array(to_json(doc)) END AS items")
    top = items.select("url", F.explode("items").alias("raw")).select("url", F.try_parse_json("raw").alias("doc"))
    is_review = F.expr("coalesce(contains(to_json(try_variant_get(doc, '$[\"@type\"]')), 'ClaimReview'), false)")
    direct = top.where(is_review)
    graph = top.selectExpr("url", "explode(from_json(to_json(try_variant_get(doc, '$[\"@graph\"]')), 'array<string>')) AS raw").select("url", F.try_parse_json("raw").alias("doc")).where(is_review)
    # The graph counts only for pages without a review at the top.
    return direct.unionByName(graph.join(direct.select("url").distinct(), "url", "left_anti"))


class _Items(HTMLParser):
    """Properties of ClaimReview items, as dotted names."""

    def __init__(self):
        super().__init__()
        self.stack: list[tuple[str, str | None, bool]] = []
        self.found: dict[str, str] = {}
        self.depth = 0
        self.open: str | None = None

    def name(self, prop: str) -> str:
        return ".".join([p for _, p, _ in self.stack if p] + [prop])

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        prop, scope = a.get("itemprop"), "itemscope" in a
        start = scope and "ClaimReview" in (a.get("itemtype") or "")
        if (self.depth or start) and tag not in ("meta", "link", "img", "br", "input", "hr"):
            self.stack.append((tag, prop if scope and self.depth else None, scope))
            self.depth += 1
        if self.depth and prop and not scope:
            value = a.get("content") or a.get("href") or a.get("src") or a.get("datetime")
            if value is not None:
                self.found[self.name(prop)] = value
            else:
                self.open = self.name(prop)
                self.found.setdefault(self.open, "")

    def handle_data(self, data):
        if self.open:
            self.found[self.open] += data.strip()

    def handle_endtag(self, tag):
        self.open = None
        if self.depth and self.stack and self.stack[-1][0] == tag:
            self.stack.pop()
            self.depth -= 1


def _item(html: str | None) -> dict[str, str] | None:
    if not html or "ClaimReview" not in html:
        return None
    parser = _Items()
    parser.feed(html)
    return parser.found or None


@F.pandas_udf(MapType(StringType(), StringType()))
def _microdata(html: pd.Series) -> pd.Series:
    return html.map(_item)


def microdata(pages: DataFrame) -> DataFrame:
    """url, properties (map) of pages with a ClaimReview item; several items become one."""
    ship(pages.sparkSession)
    marked = pages.where(F.contains("html", F.lit("ClaimReview")) & F.contains("html", F.lit("itemscope")))
    return marked.select("url", _microdata("html").alias("properties")).where("properties IS NOT NULL")


def widget_ids(html: Column) -> Column:
    """Ids of shared-fact widgets that a page links to."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'href="[^"]*sharethefacts\.co/share/([^"/?#]+)'), F.lit(1)))


def textual_label(doc: str = "doc") -> Column:
    """The textual rating of a raw document (VARIANT), whichever of the known shapes it has."""
    get = lambda p: F.expr(f"try_variant_get({doc}, '{p}', 'string')")
    roots = ["$.reviewRating.properties", "$.reviewRating", "$.properties.reviewRating.properties", "$.properties.reviewRating"]
    shapes = [f"{root}{tail}" for root in roots for tail in ('.alternateName["@value"]', ".alternateName[0]", ".alternateName", "")]
    plain = lambda c: F.when(~F.startswith(c, F.lit("{")) & ~F.startswith(c, F.lit("[")) & (c != ""), c)
    return F.coalesce(*[plain(get(p)) for p in shapes])
