"""Readers of the feeds' formats: each gives documents or rows as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_tsv(spark: SparkSession, path: str, header: bool = True, sep: str = "\t") -> DataFrame:
    return spark.read.csv(path, sep=sep, header=header, multiLine=True, maxCharsPerColumn=-1, quote='"', escape='"')


def read_csv_feed(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, sep=",")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document a line as VARIANT; what can't be parsed is null and can be set aside."""
    text = spark.read.text(path)
    return text.select(F.try_parse_json("value").alias("doc"), F.col("value").alias("raw"))


def feed_items(feed: DataFrame) -> DataFrame:
    """doc of each element of item lists in a feed with a column `feed` (VARIANT); nulls are passed over."""
    items = feed.selectExpr("inline(from_json(to_json(variant_get(feed, '$.dataFeedElement')), 'array<struct<item:array<string>>>'))")
    return items.where("item IS NOT NULL").select(F.explode("item").alias("raw")).where("raw IS NOT NULL").select(F.try_parse_json("raw").alias("doc"))


def bucket_keys(listing: DataFrame) -> DataFrame:
    """key of each <Contents> in XML bucket listings with a column `xml`."""
    found = F.regexp_extract_all("xml", F.lit(r"(?s)<Contents>.*?<Key>([^<]*)</Key>.*?</Contents>"), F.lit(1))
    return listing.select(F.explode(found).alias("key"))


def positional_reviews(pages: DataFrame) -> DataFrame:
    """Reviews from a positional-array API: a prefix of five characters, then nested arrays; missing numbers are -1."""
    doc = F.try_parse_json(F.expr("substr(body, 6)"))
    rows = pages.select(doc.alias("doc")).selectExpr("explode(from_json(to_json(try_variant_get(doc, '$[0][1]')), 'array<string>')) AS raw").select(F.try_parse_json("raw").alias("r"))
    get = lambda p, kind: F.expr(f"try_variant_get(r, '{p}', '{kind}')")
    number = lambda i: F.coalesce(get(f"$[0][3][0][9][{i}]", "int"), F.lit(-1))
    return rows.select(
        get("$[0][0]", "string").alias("claim_reviewed"),
        get("$[0][3][0][1]", "string").alias("url"),
        get("$[0][3][0][3]", "string").alias("alternate_name"),
        number(0).alias("value"),
        number(1).alias("worst"),
        number(2).alias("best"),
        F.timestamp_seconds(get("$[0][2]", "bigint")).alias("published"),
    )


def spreadsheet_cells(rows: DataFrame) -> DataFrame:
    """place, cells of a spreadsheet feed (place, entry: a JSON object): keys gsx$name to name, blanks cut; a cell is a text
    or an object with $t."""
    cells = F.from_json("entry", "map<string,string>")
    named = F.transform_keys(F.map_filter(cells, lambda k, v: F.startswith(k, F.lit("gsx$"))), lambda k, v: F.replace(F.regexp_replace(k, r"^gsx\$", ""), F.lit("."), F.lit("_")))
    plain = lambda v: F.when(F.startswith(v, F.lit("{")), F.get_json_object(v, "$['$t']")).otherwise(v)
    return rows.select("place", F.transform_values(named, lambda k, v: F.trim(plain(v))).alias("cells"))


def spreadsheet_rows(rows: DataFrame) -> DataFrame:
    """place, cells of all rows but the first, whose cells are the names that take the place of the keys."""
    cells = spreadsheet_cells(rows)
    first = cells.agg(F.min_by("cells", "place").alias("names"), F.min("place").alias("top"))
    out = cells.crossJoin(F.broadcast(first)).where("place > top")  # one row
    return out.select("place", F.transform_keys("cells", lambda k, v: F.coalesce(F.try_element_at(F.col("names"), k), k)).alias("cells"))


def counted_by_link(occurrences: DataFrame) -> DataFrame:
    """Rows of a topic feed with the number of rows that their link has."""
    counts = occurrences.groupBy("link").agg(F.count("*").alias("n_of_link"))
    return occurrences.join(counts, "link")


def topic_feed(feed: DataFrame) -> DataFrame:
    """link, date, debunk_link, title, factchecker, country of each occurrence in a topic feed (column `raw`)."""
    schema = "array<struct<disinfoLink:string,ocurrences:array<struct<date:string,debunkLink:string,debunkTitle:string,factchecker:string,country:struct<name:string>>>>>"
    rows = feed.select(F.explode(F.from_json("raw", schema)).alias("e")).select(F.col("e.disinfoLink").alias("link"), F.explode("e.ocurrences").alias("o"))
    clean = lambda c: F.trim(F.replace(F.replace(c, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("\\n")))
    out = rows.select(clean(F.col("link")).alias("link"), F.col("o.date").alias("date"), clean(F.col("o.debunkLink")).alias("debunk_link"), clean(F.col("o.debunkTitle")).alias("title"), clean(F.col("o.factchecker")).alias("factchecker"), F.col("o.country.name").alias("country"))
    return out.where(F.startswith("link", F.lit("http")))


def hoax_map(rows: DataFrame) -> DataFrame:
    """id, title, label, motivation, url, appearances from {hoaxes: {url: id}, debunks: {id: [..]}} (column `raw`)."""
    doc = rows.select(F.from_json("raw", "struct<hoaxes:map<string,string>,debunks:map<string,array<string>>>").alias("d"))
    links = doc.select(F.explode("d.hoaxes").alias("link", "id")).groupBy("id").agg(F.array_sort(F.collect_set("link")).alias("appearances"))
    debunks = doc.select(F.explode("d.debunks").alias("id", "f"))
    out = debunks.join(links, "id", "left")
    return out.select("id", F.get("f", 0).alias("title"), F.get("f", 1).alias("label"), F.get("f", 2).alias("motivation"), F.get("f", 3).alias("url"), F.coalesce("appearances", F.array().cast("array<string>")).alias("appearances"))


def feed_links(occurrences: DataFrame) -> DataFrame:
    """Distinct links of a topic feed's rows, of the topics and of their debunks."""
    both = occurrences.select("link").union(occurrences.select("debunk_link"))
    return both.where("link <> ''").distinct()
