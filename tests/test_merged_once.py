"""Domains and links of merged records are found once a record, in as many tasks as there are partitions."""

from pyspark.sql import functions as F

from factloom.operators import reviews as rv


def test_links_are_found_once_a_record(spark):
    kind = "review_id long, url string, claim_reviewed string, alternate_name string, best int, worst int, value int, appearance string, date_published date, retrieved_by string"
    links = ["https://a.com/x", "https://fact.org/own", "https://b.com/y", "https://a.com/x", None, "", "no link"]
    rows = spark.createDataFrame([(i, "https://www.fact.org/p", "claim", "False", 5, 1, 1, x, None, "s") for i, x in enumerate(links)], kind)
    out = rv.merged(rows)
    record = out.collect()[0]
    assert out.columns == ["url", "cluster", "domain", "claim_text", "label", "appearances", "reviews"]
    assert (record["domain"], record["appearances"], len(record["reviews"])) == ("fact.org", ["https://a.com/x", "https://b.com/y"], 7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression [url") :]
    assert "raw" in plan and "|$2" not in below  # no domain is taken of single reviews
    assert out.select(F.size("appearances")).first()[0] == 2
