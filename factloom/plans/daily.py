"""The daily job as one plan: reviews to merged records, link tables, statistics and the topic extract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factloom.operators import relations, reviews as rv, serving, store
from factloom.operators.scratch import kept


def tables(reviews: DataFrame, registry: DataFrame, recollected: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of a day: the eleven of the job, the statistics, the comparison with the last collection and the topic extract.

    Claims are clustered and merged once; the merged records and the link tables are written, and all others read them.

    recollected: reviews collected again from the pages of registered fact-checkers; without them, theirs among `reviews`
    take their place. Reviews of unknown fact-checkers take part in no table but the raw one and the list of them.
    """
    known = recollected if recollected is not None else relations.with_registry(reviews, registry.select("domain"), "left_semi").drop("domain")
    records = rv.records(known)
    links, bad = kept(rv.link_table(records), "links"), kept(rv.link_table(records, "not_credible"), "links")
    return {
        "claim_reviews_raw": reviews.unionByName(known, allowMissingColumns=True),
        "claim_reviews_raw_recollected": known,
        "not_ifcn_sources": relations.with_registry(reviews, registry, "left_anti").select("domain").distinct(),
        "claim_reviews": records,
        "different_texts": rv.different_texts(records),
        "disagreeing_reviews": rv.disagreeing_records(records),
        "links_not_credible": bad.select("misinforming_url"),
        "links_not_credible_full": bad,
        "links_all": links.select("misinforming_url"),
        "links_all_full": links,
        "claim_labels_mapping": rv.label_mapping(known),
        "stats": rv.job_stats(reviews, registry, known, records),
        "recollection_stats": relations.recollection(reviews, known, registry),
        "topic": serving.topic_extract(links),
    }


def run(reviews: DataFrame, registry: DataFrame, path: str, date: str, recollected: DataFrame | None = None) -> None:
    store.write_snapshot(tables(reviews, registry, recollected), path, date)


def main(args: list[str]) -> None:
    """reviews registry target date [recollected]: the job over saved tables, from the command line."""
    from factloom.session import session

    spark = session("daily")
    reviews, registry, target, date, *more = args
    run(spark.read.parquet(reviews), spark.read.parquet(registry), target, date, spark.read.parquet(more[0]) if more else None)


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
