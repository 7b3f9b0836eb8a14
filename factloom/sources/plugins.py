"""Sources as plug-ins: what each is, how its saved input is read, and how its raw rows become rows of the store.

A plug-in never fetches. Input lies below a folder by the source's id, in the form that its reader knows; raw rows are
saved before they are turned into reviews, so that `update=False` replays them. One source's failure doesn't stop the
others: it is a row of the report.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import store
from factloom.sources import listings, raw_reviews as rr, readers

Read = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Source:
    id: str
    homepage: str
    name: str
    description: str
    read: Read
    rows: Callable[[DataFrame], DataFrame]


SOURCES: dict[str, Source] = {}


def register(source: Source) -> Source:
    SOURCES[source.id] = source
    return source


def _saved_pages(source: str) -> Read:
    return lambda spark, path: spark.read.parquet(path).withColumn("source", F.lit(source))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    return readers.read_documents(spark, path).select("raw").where("raw IS NOT NULL")


def _reviews(source: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: rr.reviews_of(raw.select(F.try_parse_json("raw").alias("doc")), source)


def _listing(source: str, repeated: bool = False) -> Callable[[DataFrame], DataFrame]:
    def rows(pages: DataFrame) -> DataFrame:
        found = listings.cleaned(listings.listing_rows(pages))
        return listings.last_of_each(listings.until_repeated(found) if repeated else found)

    return rows


#: Id, homepage, name, and whether a crawl of its listing ends at the first repeated article.
LISTED = [
    ("euvsdisinfo", "https://euvsdisinfo.eu/", "EUvsDisinfo", False),
    ("factcheck_org", "https://www.factcheck.org/", "FactCheck.org", False),
    ("factcheckni", "https://factcheckni.org/", "FactCheckNI", True),
    ("fullfact", "https://fullfact.org/", "Full Fact", False),
    ("istinomer", "https://www.istinomer.rs/", "Istinomer", False),
    ("leadstories", "https://leadstories.com/", "Lead Stories", False),
    ("politifact", "https://www.politifact.com/", "PolitiFact", False),
    ("snopes", "https://www.snopes.com/", "Snopes", True),
    ("teyit_org", "https://teyit.org/", "Teyit", False),
    ("weeklystandard", "https://www.washingtonexaminer.com/", "The Weekly Standard", False),
]
for _id, _home, _name, _repeated in LISTED:
    register(Source(_id, _home, _name, "articles of saved listing pages", _saved_pages(_id), _listing(_id, _repeated)))
register(Source("datacommons_feeds", "https://datacommons.org/", "Data Commons feeds", "reviews of a data feed", lambda spark, path: readers.feed_items(spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("feed"))).select(F.to_json("doc").alias("raw")), _reviews("datacommons_feeds")))
register(Source("datacommons_research_dataset", "https://datacommons.org/", "Data Commons research dataset", "reviews of a release file", lambda spark, path: rr.release_documents(spark, path).select(F.to_json("doc").alias("raw")), _reviews("datacommons_research_dataset")))
register(Source("google_factcheck_explorer", "https://toolbox.google.com/factcheck/explorer", "Fact Check Explorer", "reviews of a positional feed, saved as text", lambda spark, path: spark.read.text(path, wholetext=True).withColumnRenamed("value", "body"), lambda raw: readers.positional_reviews(raw)))
register(Source("chequeado", "https://chequeado.com/", "LatamChequea", "rows of a spreadsheet feed", lambda spark, path: spark.read.parquet(path), lambda raw: readers.spreadsheet_rows(raw)))
register(Source("lemonde_decodex_hoax", "https://www.lemonde.fr/verification/", "Decodex", "hoaxes and their debunks", lambda spark, path: spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw"), lambda raw: readers.hoax_map(raw)))
register(Source("poynter_covid", "https://www.poynter.org/ifcn-covid-19-misinformation/", "CoronaVirusFacts", "rows of a table of fact-checks", lambda spark, path: readers.read_tsv(spark, path, sep=","), rr.csv_reviews))
register(Source("ukrainefacts", "https://ukrainefacts.org/", "UkraineFacts", "occurrences of a topic feed", lambda spark, path: spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw"), lambda raw: readers.topic_feed(raw)))


def collect(spark: SparkSession, root: str, target: str, update: bool = True, only: list[str] | None = None) -> DataFrame:
    """Run the plug-ins one after another. Returns id, n_rows, error of each; rows lie below target by source."""
    report = []
    for source in SOURCES.values():
        if only is not None and source.id not in only:
            continue
        try:
            if update:
                store.save_raw(source.read(spark, f"{root}/{source.id}"), target, source.id)
            rows = source.rows(spark.read.parquet(f"{target}/raw/{source.id}"))
            store.replace_rows(rows, target, source.id)
            report.append((source.id, spark.read.parquet(f"{target}/rows/{source.id}").count(), None))
        except Exception as e:  # a plug-in may fail in any way; the others go on
            report.append((source.id, None, f"{type(e).__name__}: {e}".split("\n")[0][:500]))
    return spark.createDataFrame(report, "id string, n_rows long, error string")
