"""From raw documents to labelled reviews: the shapes that a schema.org review comes in, and which parser a page gets.

A raw document is a VARIANT. Fields that may be text, an object or a list become arrays first; a review row has
url, claim_reviewed, author, alternate_name, best, worst, value, links (raw), date_published, retrieved_by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.dates import day_of
from factloom.functions.ratings import credibility_label
from factloom.functions.tables import MICRODATA_DOMAINS, UNMARKED_DOMAINS
from factloom.functions.urls import appearances, canonical, corrected, registered_domain
from factloom.operators.relations import newest_by_key
from factloom.sources.pages import fetched, jsonld, microdata, textual_label, widget_ids


def _json(path: str, doc: str = "doc") -> str:
    return f"to_json(try_variant_get({doc}, '{path}', 'variant'))"


def listed(raw: str) -> str:
    """SQL for the elements of a JSON value: those of a list, else the value itself; none for null and empty text."""
    kind = f"schema_of_variant(try_parse_json({raw}))"
    return f"""CASE WHEN {raw} IS NULL OR {raw} IN ('null', '""') THEN array() WHEN {kind} LIKE 'ARRAY%' THEN from_json({raw}, 'array<string>')
        WHEN {kind} LIKE 'OBJECT%' THEN array({raw}) ELSE array(try_variant_get(try_parse_json({raw}), '$', 'string')) END"""


def raw_links(doc: str = "doc") -> Column:
    """All links that a document gives as appearances: firstAppearance, appearance, then itemReviewed.url, each as text, as
    an object with url or as a list of these; itemReviewed may lie below properties. Nulls and empty text are left out."""
    parts = []
    for field, inner in (("firstAppearance", True), ("appearance", True), ("url", False)):
        raw = f"coalesce({_json(f'$.itemReviewed.{field}', doc)}, {_json(f'$.properties.itemReviewed.{field}', doc)})"
        elements = F.expr(listed(raw)).cast("array<string>")
        if inner:
            elements = F.flatten(F.transform(elements, lambda x: F.when(F.startswith(x, F.lit("{")), F.array(F.get_json_object(x, "$.url"))).otherwise(F.array(x))))
        parts.append(elements)
    return F.filter(F.concat(*parts), lambda x: x.isNotNull() & (x != ""))


def rating_number(field: str, doc: str = "doc") -> Column:
    """A rating's number as text; a JSON number with a fraction loses it, text keeps it (and is no whole number then)."""
    found = []
    for root in ("$.reviewRating", "$.properties.reviewRating", "$.reviewRating.properties"):
        get = lambda kind, at=f"{root}.{field}": f"try_variant_get({doc}, '{at}', '{kind}')"
        cut = f"CAST(CAST(sign({get('double')}) * floor(abs({get('double')})) AS BIGINT) AS STRING)"
        found.append(F.expr(f"CASE WHEN {_json(f'{root}.{field}', doc)} RLIKE '^-?[0-9]' THEN {cut} ELSE {get('string')} END"))
    return F.coalesce(*found)


def claim_text(doc: str = "doc") -> Column:
    """claimReviewed, of a list the first; blanks around are cut."""
    first = F.get(F.expr(listed(_json("$.claimReviewed", doc))).cast("array<string>"), 0)
    return F.trim(F.coalesce(first, F.lit("")))


def author_name(doc: str = "doc") -> Column:
    raw = F.get(F.expr(listed(_json("$.author", doc))).cast("array<string>"), 0)
    return F.when(F.startswith(raw, F.lit("{")), F.get_json_object(raw, "$.name")).otherwise(raw)


def reviews_of(documents: DataFrame, retrieved_by: str | None = None, asked: str | None = None) -> DataFrame:
    """Review rows of raw documents (doc); what is no object is passed over, and documents without url keep a null one.

    asked: a column whose link takes the place of the document's own.
    """
    get = lambda p: F.expr(f"try_variant_get(doc, '{p}', 'string')")
    rows = documents.where(F.expr("schema_of_variant(doc) LIKE 'OBJECT%'"))
    source = F.lit(retrieved_by).cast("string") if retrieved_by else get("$.retrieved_by")
    return rows.select(
        (F.col(asked) if asked else get("$.url")).alias("url"),
        claim_text().alias("claim_reviewed"),
        author_name().alias("author"),
        textual_label().alias("alternate_name"),
        rating_number("bestRating").alias("best"),
        rating_number("worstRating").alias("worst"),
        rating_number("ratingValue").alias("value"),
        raw_links().alias("links"),
        day_of(get("$.datePublished")).alias("date_published"),
        source.alias("retrieved_by"),
    )


def finished(rows: DataFrame) -> DataFrame:
    """Review rows with label, domain and appearances (canonical, foreign to the fact-checker, distinct)."""
    label = credibility_label(F.col("alternate_name"), F.col("value"), F.col("best"), F.col("worst"))
    return rows.withColumn("label", label).withColumn("domain", registered_domain(F.col("url"))).withColumn("appearances", appearances(F.col("links"), F.col("url")))


def parser_of(url: Column) -> Column:
    """Which parser a page gets, by its registered domain."""
    domain = registered_domain(url)
    return F.when(domain.isin(*MICRODATA_DOMAINS), "microdata").when(domain.isin(*UNMARKED_DOMAINS), "none").otherwise("jsonld")


def microdata_documents(pages: DataFrame) -> DataFrame:
    """url, doc of pages with microdata: dotted properties as nested objects of a ClaimReview document."""
    found = microdata(pages)
    return found.select("url", F.try_parse_json(unflattened(F.col("properties"))).alias("doc"))


def unflattened(properties: Column) -> Column:
    """A map of dotted names (two levels) as JSON text of nested objects with @type."""
    names = F.map_keys(properties)
    heads = F.array_distinct(F.transform(names, lambda k: F.substring_index(k, ".", 1)))

    def member(head: Column) -> Column:
        below = F.map_filter(properties, lambda k, v: F.startswith(k, F.concat(head, F.lit("."))))
        nested = F.to_json(F.transform_keys(below, lambda k, v: F.substring(k, F.length(head) + 2, F.length(k))))
        plain = F.get(F.from_json(F.to_json(F.array(F.element_at(properties, head))), "array<string>"), 0)
        text = F.regexp_replace(F.to_json(F.array(plain)), r"^\[|\]$", "")
        return F.concat(F.regexp_replace(F.to_json(F.array(head)), r"^\[|\]$", ""), F.lit(":"), F.when(F.size(below) > 0, nested).otherwise(text))

    return F.concat(F.lit('{"@type":"ClaimReview"'), F.array_join(F.transform(heads, lambda h: F.concat(F.lit(","), member(h))), ""), F.lit("}"))


def retrieved(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """The review rows, labelled, of asked-for links (url) from saved pages (url, html).

    Links are looked up in their canonical form. Each page goes to its domain's parser, a review's url is the asked one,
    and links without a page, a review or a parser give no row.
    """
    saved = pages.select(canonical(F.col("url")).alias("key"), "html").where("key IS NOT NULL").dropDuplicates(["key"])
    asked = urls.select("url", canonical(F.col("url")).alias("key")).where("key IS NOT NULL").distinct()
    found = fetched(asked.select("key").distinct().withColumnRenamed("key", "url"), saved.withColumnRenamed("key", "url"))
    found = found.where("html IS NOT NULL AND html <> 'TOO LARGE'").withColumn("parser", parser_of(F.col("url")))
    docs = jsonld(found.where("parser = 'jsonld'")).select("url", "doc").unionByName(microdata_documents(found.where("parser = 'microdata'")))
    rows = docs.withColumnRenamed("url", "key").join(asked, "key")
    return finished(reviews_of(rows, asked="url"))


def enriched(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Labelled review rows and, after them, what the saved pages of their links (corrected where they are known to be
    wrong) hold."""
    asked = rows.select(corrected(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()
    return rows.unionByName(retrieved(asked, pages), allowMissingColumns=True)


def shared_facts(pages: DataFrame) -> DataFrame:
    """url and the address of each shared-fact widget that a saved page links to."""
    ids = pages.select("url", F.explode(widget_ids(F.col("html"))).alias("id"))
    return ids.select("url", F.concat(F.lit("https://www.sharethefacts.co/share/"), "id").alias("widget"))


def csv_reviews(rows: DataFrame) -> DataFrame:
    """Review rows from a spreadsheet of fact-checks with these columns; words of the link cell that begin with http are
    its links, in canonical form."""
    cell = lambda name: F.col(f"`{name}`")
    words = F.filter(F.split(F.trim(F.coalesce(cell("Link to the original piece"), F.lit(""))), r"\s+"), lambda x: F.startswith(x, F.lit("http")))
    return rows.select(
        canonical(cell("URL to fact-checked article (in your language)")).alias("url"),
        F.trim(F.coalesce(cell("What did you fact-check?"), F.lit(""))).alias("claim_reviewed"),
        cell("Organization").alias("author"),
        cell("Final rating").alias("alternate_name"),
        cell("Explanation").alias("explanation"),
        cell("Who said/posted it?").alias("claim_author"),
        F.filter(F.transform(words, canonical), lambda x: x.isNotNull()).alias("links"),
        day_of(cell("When did you see the claim?")).alias("date_published"),
        F.lit("poynter_covid").alias("retrieved_by"),
    )


def release_link(html: Column, base: str = "https://datacommons.org") -> Column:
    """The address of the release that a download page names (a#download)."""
    tag = F.regexp_extract(html, r'(?is)(<a\b[^>]*\bid="download"[^>]*>)', 1)
    return F.nullif(F.concat(F.lit(base), F.regexp_extract(tag, r'(?i)\bhref="([^"]*)"', 1)), F.lit(base))


def release_documents(spark, path: str) -> DataFrame:
    """doc of every review in a release file (JSON-LD within HTML, .gz or plain; one text a file)."""
    text = spark.read.text(path, wholetext=True)
    return jsonld(text.select(F.lit(None).cast("string").alias("url"), F.col("value").alias("html"))).select("doc")


def rest_items(pages: DataFrame, homepage: str) -> DataFrame:
    """id, url, raw of a paged REST feed saved as (page, body): items below `raw`, of equal ids the last, links made of
    the homepage and the slug. Pages from the first empty one on count for nothing."""
    body = F.try_parse_json("body")
    items = F.from_json(F.to_json(F.try_variant_get(body, "$.raw", "variant")), "array<string>")
    rows = pages.select("page", items.alias("items"))
    first_empty = rows.where(F.coalesce(F.size("items"), F.lit(0)) < 1).agg(F.min("page").alias("stop"))
    rows = rows.crossJoin(F.broadcast(first_empty)).where("stop IS NULL OR page < stop")  # one row
    rows = rows.select("page", F.posexplode("items").alias("place", "raw")).withColumn("id", F.get_json_object("raw", "$.id"))
    rows = rows.withColumn("seq", F.struct("page", "place"))
    return newest_by_key(rows, "id", "seq").select("id", F.concat(F.lit(homepage), F.get_json_object("raw", "$.slug")).alias("url"), "raw")


def registry_of(raw: DataFrame) -> DataFrame:
    """domain, name, country, language, website, avatar of a registry's JSON (rows of `raw`, with a place); of equal
    domains the last."""
    get = lambda p: F.get_json_object("raw", p)
    rows = raw.select(registered_domain(get("$.website")).alias("domain"), *[get(f"$.{c}").alias(c) for c in ("name", "country", "language", "website", "avatar")], F.col("place").alias("seq"))
    return newest_by_key(rows.where("domain <> ''"), "domain", "seq").drop("seq")
