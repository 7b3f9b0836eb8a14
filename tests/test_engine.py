import math

import pytest
from pyspark.sql import functions as F

from factloom.functions import ratings, urls
from factloom.functions.dates import day_of
from factloom.operators import clustering, relations, serving, store
from factloom.operators import reviews as rv
from factloom.plans import daily
from factloom.sources import fixture, pages, plugins, raw_reviews, readers
from factloom.streaming import incremental

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "label,best,worst,value,expected",
    [
        ("False", "1", "5", "5", "not_credible"),
        ("whatever", "5", "1", "3", "uncertain"),
        ("Free text", "-1", "-1", "-1", "not_verifiable"),
        ("Unsubstantiated", "5", "1", "1", "not_credible"),
        ("unknown", "5", "1", "3.5", "not_verifiable"),
        ("Credible statement", "", "", "", "credible"),
        (None, "1", "1", "1", "not_verifiable"),
        ("false because it's a lie", "5", "1", "5", "not_credible"),
    ],
)
def test_labels(spark, label, best, worst, value, expected):
    lit = lambda x: F.lit(x).cast("string")
    assert one(spark, ratings.credibility_label(lit(label), lit(value), lit(best), lit(worst))) == expected


def test_scores(spark):
    for score, label in ((0.9, "credible"), (0.8, "mostly_credible"), (0.7, "mostly_credible"), (0.6, "uncertain"), (0.5, "uncertain"), (0.4, "not_credible"), (0.3, "not_credible"), (None, "not_verifiable")):
        assert one(spark, ratings.score_label(F.lit(score).cast("double"))) == label
    assert one(spark, ratings.numeric_score(F.lit(5), F.lit(1), F.lit(5))) == 0.0
    assert one(spark, ratings.numeric_score(F.lit(3), F.lit(5), F.lit(1))) == 0.5
    assert one(spark, ratings.numeric_score(F.lit(0), F.lit(10), F.lit(1))) == 0.0
    assert one(spark, ratings.simplified_label(F.lit("unsupported"))) is None
    assert one(spark, ratings.french_rating(F.lit("Exagéré"))) == 1
    prefixes = ratings.label_prefixes()
    assert not [(a, b) for a in prefixes for b in prefixes if b.startswith(a) and prefixes[a] != prefixes[b]]


@pytest.mark.parametrize(
    "url,expected",
    [
        ("https://a.com/x#top", "https://a.com/x?#top"),
        ("https://a.com/x//y/../z/?b=1&a=&b=2&fbclid=3", "https://a.com/x/z?a=&b=2"),
        ("ftp://a.com", None),
        ("A.com/", "https://a.com"),
        ("http://a.com:80/x/", "http://a.com/x"),
        ("http://a.com:8080/x", "http://a.com:8080/x"),
        ("http://a.com:443/x", "http://a.com:443/x"),
        ("https://a.com:443/x", "https://a.com/x"),
        ("https://a.com/?q=a b&z=%41&q=%zz", "https://a.com?q=%25zz&z=A".replace("com?", "com/?")),
        ("https://a.com/%2541 b#\u00e9", "https://a.com/A%20b?#%C3%A9"),
        (None, None),
    ],
)
def test_canonical(spark, url, expected):
    assert one(spark, urls.canonical(F.lit(url).cast("string"))) == expected


def test_other_links(spark):
    assert one(spark, urls.unwrapped(F.lit("https://web.archive.org/web/2022/https:/site.com/p"))) == "https://site.com/p"
    assert one(spark, urls.status_id(F.lit("https://twitter.com/u_1/status/976170425272160258?x=1"))) == 976170425272160258
    assert one(spark, urls.registered_domain(F.lit("https://www.a.b.co.uk/x"))) == "b.co.uk"
    assert one(spark, urls.registered_domain(F.lit(""))) == ""
    for url, domain in (("https://www.example.gov.br/x", "example.gov.br"), ("http://t.co/1", "t.co"), ("http://gov.br", ""), ("http://10.0.0.1/", ""), ("http://localhost/", "")):
        assert one(spark, urls.registered_domain(F.lit(url))) == domain
    assert one(spark, urls.appearances(F.array(F.lit("https://archive.me.org/z")), F.lit("https://www.me.org/x"))) == []
    assert one(spark, urls.is_shortener(F.lit("https://bit.ly/1"))) and one(spark, urls.is_shortener(F.lit("http://on.fb.me/1")))
    assert one(spark, urls.split_appearances(F.array(F.lit("http://a.x/1,http://b.x/2")))) == ["http://a.x/1", "http://b.x/2", "http://a.x/1,http://b.x/2"]
    assert one(spark, urls.appearances(F.array(F.lit("http://c.com/z/"), F.lit("1"), F.lit("file.html")), F.lit("https://me.org/x"))) == ["http://c.com/z"]
    assert one(spark, urls.escaped(F.lit("http://a.com/%2541é"))) == "http://a.com/A%C3%A9"


@pytest.mark.parametrize("d,expected", [((3, 6, 3), [[0, 1], [2]]), ((4, 5, 5), [[0, 1], [2]]), ((2, 3, 3), [[0, 1, 2]])])
def test_ward(d, expected):
    import numpy as np

    a, b, c = d
    m = np.array([[0, a, b], [a, 0, c], [b, c, 0]], float)
    assert sorted(clustering.ward(m, 5)) == expected


def test_ward_of_weighted_points():
    import numpy as np

    d = np.array([[0, 4.0], [4.0, 0]])
    assert clustering.ward(d, 5, [1, 1]) == [[0, 1]]
    # Two copies each: the height is sqrt(2 * 2 * 2 / 4) * 4 = 5.657, as with all four points.
    assert clustering.ward(d, 5, [2, 2]) == [[0], [1]]
    full = np.kron(d, np.ones((2, 2)))
    assert sorted(clustering.ward(full, 5)) == [[0, 1], [2, 3]]


def test_claim_clusters(spark):
    rows = [(1, "u", "abc"), (2, "u", "abcd"), (3, "u", "something else entirely"), (4, "u", " abc "), (5, "v", "abc"), (6, "v", None), (7, "w", "a text of its own, far away"), (8, "w", "no")]
    cr = spark.createDataFrame(rows, "review_id long, url string, claim_reviewed string")
    assert {r["review_id"]: r["cluster"] for r in clustering.claim_clusters(cr).collect()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 5, 7: 7, 8: 8}


def test_embedding_clusters(spark):
    rows = [(1, [0.0, 0.0], 1), (2, [0.1, 0.0], 1), (3, [5.0, 0.0], 1), (4, [0.0, 0.0], 2)]
    got = clustering.embedding_clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), 0.9)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1)]


def test_store(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "s"), ("b", 2, "t")], "url string, n int, retrieved_by string")
    new = spark.createDataFrame([("a", 3)], "url string, n int")
    assert sorted(store.replaced(old, new, "s").collect()) == [("a", 3, "s"), ("b", 2, "t")]
    with pytest.raises(ValueError):
        store.replaced(old, new.where("false"), "s")
    assert sorted(store.upserted(old, new, "url").select("url", "n").collect()) == [("a", 3), ("b", 2)]
    store.write_source(new, str(tmp_path / "store"), "s")
    store.write_source(new, str(tmp_path / "store"), "t")
    store.write_source(new.withColumn("n", F.lit(9)), str(tmp_path / "store"), "s")
    assert sorted(spark.read.parquet(str(tmp_path / "store")).select("n", "retrieved_by").collect()) == [(3, "t"), (9, "s")]


def test_daily_snapshot(spark, tmp_path):
    cr, reg = fixture.reviews(spark, SF), fixture.registry(spark, SF)
    daily.run(cr, reg, str(tmp_path), "2024_01_01")
    stats = store.read_snapshot(spark, str(tmp_path), "stats").first()
    known = relations.with_registry(cr, reg, "left_semi")
    assert stats["raw_reviews"] == cr.count() + known.count() and stats["recollected_reviews"] == known.count()
    assert store.read_snapshot(spark, str(tmp_path), "claim_reviews_raw").count() == stats["raw_reviews"]
    assert store.read_snapshot(spark, str(tmp_path), "claim_reviews").count() == stats["merged_reviews"]
    links = store.read_snapshot(spark, str(tmp_path), "links_all_full")
    assert links.count() == links.select("misinforming_url").distinct().count() > 0


def test_records_are_made_anew_once_cleared(spark):
    from factloom import catalog
    from factloom.operators import scratch

    first = catalog.queries()["links_not_credible"](spark, SF)
    n = first.count()
    scratch.clear(spark)
    assert catalog.queries()["links_not_credible"](spark, SF).count() == n > 0


def test_snapshots_of_reviews_collected_again(spark, tmp_path):
    """The counters are those of the given reviews; a date written again is replaced as a whole, an unknown one is an error."""
    cr, reg, path = fixture.reviews(spark, SF), fixture.registry(spark, SF), str(tmp_path)
    none = cr.limit(0)
    daily.run(cr, reg, path, "2024_01_02", none)
    stats = store.read_snapshot(spark, path, "stats", "2024_01_02").first()
    assert (stats["merged_reviews"], stats["recollected_reviews"], stats["raw_reviews"]) == (0, 0, cr.count())
    assert store.read_snapshot(spark, path, "claim_reviews").count() == 0 and all(r["after"] == 0 for r in stats["recollection_stats"])
    some = relations.with_registry(cr, reg, "left_semi").where("review_id % 2 = 0").select(*cr.columns)
    daily.run(cr, reg, path, "2024_01_01", some)
    assert store.read_snapshot(spark, path, "stats", "2024_01_01").first()["recollected_reviews"] == some.count()
    assert store.read_snapshot(spark, path, "stats").first()["merged_reviews"] == 0  # latest is the later date
    daily.run(cr, reg, path, "2024_01_02", some)
    again = store.read_snapshot(spark, path, "disagreeing_reviews")
    assert {"claim_text", "reviews", "label"} <= set(again.columns) and again.groupBy("link").agg(F.count_distinct("label").alias("n")).where("n < 2").isEmpty()
    assert store.read_snapshot(spark, path, "different_texts").where("size(claim_text) = 0").isEmpty()
    with pytest.raises(KeyError):
        store.read_snapshot(spark, path, "stats", "2024_01_03")
    with pytest.raises(KeyError):
        store.read_snapshot(spark, path, "no_table")


def test_cursor_goes_round(spark):
    links = rv.link_table(fixture.reviews(spark, SF)).cache()
    keep = serving.satisfies(since="2024-01-25", exclude=())
    expected = links.where(keep).count()
    cursor, seen = 0, []
    for _ in range(5):
        row = serving.cursor_sample(links, keep, "s", cursor).first()
        seen.append(row["misinforming_url"])
        cursor = row["next_cursor"]
    assert len(set(seen)) == min(5, expected)


def test_sample_route(spark):
    links = rv.link_table(fixture.reviews(spark, SF)).cache()
    for cursor in (None, 10**9, 3):
        row = serving.sample(links, "seed", cursor).first()
        assert 0 <= row["current_cursor"] < links.count() and (cursor != 3 or row["current_cursor"] == 3)
    assert serving.sample(links, "seed", 0, misinforming_domain="nowhere.org").count() == 0


def test_readers(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("url\ttext\nu1\tx\n")
    assert readers.read_tsv(spark, str(tmp_path / "a.tsv")).collect() == [("u1", "x")]
    (tmp_path / "d.json").write_text('{"url": "u"}\n[1]\nbroken{\n')
    assert [r["n"] for r in readers.read_documents(spark, str(tmp_path / "d.json")).select(F.col("doc").isNull().alias("n")).collect()] == [False, False, True]
    feed = spark.createDataFrame([('{"dataFeedElement":[{"item":[{"url":"u1"},null]},{"item":null}]}',)], "raw string").select(F.try_parse_json("raw").alias("feed"))
    assert readers.feed_items(feed).selectExpr("try_variant_get(doc, '$.url', 'string') AS u").collect() == [("u1",)]
    listing = spark.createDataFrame([("<R><Contents><Key>k1</Key></Contents><Contents><Key>k2</Key></Contents></R>",)], "xml string")
    assert [r["key"] for r in readers.bucket_keys(listing).collect()] == ["k1", "k2"]
    topic = spark.createDataFrame([('[{"disinfoLink":" http://x ","ocurrences":[{"date":"d","debunkLink":"l","debunkTitle":"a\\nb","factchecker":"f","country":{"name":"c"}}]},{"disinfoLink":"no","ocurrences":[{}]}]',)], "raw string")
    assert readers.topic_feed(topic).select("link", "title").collect() == [("http://x", "a\\nb")]
    assert sorted(r["link"] for r in readers.feed_links(readers.topic_feed(topic)).collect()) == ["http://x", "l"]
    hoax = spark.createDataFrame([('{"hoaxes":{"u":"1"},"debunks":{"1":["t","Faux","m","d"],"2":["t2","Vrai","m","d"]}}',)], "raw string")
    assert {r["id"]: r["appearances"] for r in readers.hoax_map(hoax).collect()} == {"1": ["u"], "2": []}
    rows = spark.createDataFrame([(0, '{"gsx$a.b":{"$t":"Name"},"id":"x"}'), (1, '{"gsx$a.b":" 1 ","id":"x"}')], "place int, entry string")
    assert readers.spreadsheet_rows(rows).collect() == [(1, {"Name": "1"})]
    api = spark.createDataFrame([(")]}'\n" + '[[0,[[["claim",0,1700000000,[[0,"u",0,"False",0,0,0,0,0,[1,1,5]]]]]]]]',)], "body string")
    assert readers.positional_reviews(api).select("claim_reviewed", "url", "alternate_name", "value", "best").collect() == [("claim", "u", "False", 1, 5)]


def test_pages(spark):
    html = '<div itemscope itemtype="http://schema.org/ClaimReview"><span itemprop="claimReviewed">x</span></div>'
    rows = spark.createDataFrame([("u", html), ("v", "<p>"), ("w", None)], "url string, html string")
    assert [(r["url"], r["properties"]) for r in pages.microdata(rows).collect()] == [("u", {"claimReviewed": "x"})]
    assert pages.jsonld(rows).count() == 0
    cached = pages.fetched(spark.createDataFrame([("u",), ("z",)], "url string"), rows)
    assert sorted((r["url"], r["html"] is None) for r in cached.collect()) == [("u", False), ("z", True)]
    docs = [('{"reviewRating":{"alternateName":["Half True"]}}', "Half True"), ('{"reviewRating":"False"}', "False"), ('{"properties":{"reviewRating":{"properties":{"alternateName":"True"}}}}', "True"), ("{}", None)]
    got = spark.createDataFrame([(d,) for d, _ in docs], "raw string").select(F.try_parse_json("raw").alias("doc")).select(pages.textual_label().alias("x"))
    assert [r["x"] for r in got.collect()] == [x for _, x in docs]


def test_streams(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    events = fixture.table(spark, SF, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("url", F.col("user_id").cast("string"))

    def run():
        stream = incremental.new_reviews(spark.readStream.schema(events.schema).parquet(source), "365 days")
        stream.select("url").writeStream.foreachBatch(incremental.upsert_sink(target, "url")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
        return incremental.upserted_table(spark, target)

    events.where("event_id % 2 = 0").write.parquet(source)
    assert run().count() == events.where("event_id % 2 = 0").select("url").distinct().count()
    events.where("event_id % 2 = 1").write.mode("append").parquet(source)
    assert run().count() == events.select("url").distinct().count()
    sink = incremental.upsert_sink(target, "url")
    rows = spark.createDataFrame([("new",), ("new",)], "url string").distinct()
    sink(rows, 7)
    sink(rows, 7)  # a batch that is run again
    assert incremental.upserted_table(spark, target).count() == events.select("url").distinct().count() + 1
    assert len(incremental.versions(spark, target)) <= 2, "old versions go"
    assert incremental.tumbling(fixture.table(spark, SF, "events")).agg(F.sum("n")).first()[0] == events.count()


def test_sets(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "url string, n int")
    assert sorted(relations.newest_by_key(rows, "url", "n").collect()) == [("a", 2), ("b", 1)]
    assert relations.unknown(rows, rows.where("url = 'a'")).collect() == [("b", 1)]
    assert sorted(relations.merged_by_precedence([rows.where("n = 1"), rows.where("n = 2")], "url").collect()) == [("a", 2), ("b", 1)]
    assert math.isclose(relations.recollection(rows.withColumn("url", F.concat(F.lit("http://"), "url", F.lit(".org"))), rows.limit(0), spark.createDataFrame([("a.org", "x")], "domain string, country string")).first()["ratio"], 0.0)


def test_agreeing(spark):
    rows = spark.createDataFrame([("a", "x", "s"), ("a", "x", "t"), ("b", "x", "s"), ("b", "y", "s")], "domain string, label string, retrieved_by string")
    assert relations.agreeing(rows, "domain").collect() == [("a", "x", "s,t")]


def test_leaf_paths():
    import json

    assert sorted(relations.leaf_paths(json.loads('{"a":{"b":1},"l":[{"u":1},[2]],"p":{"q":{"r":{"s":1}}},"ifcn_info":{"z":1},"e":{}}'))) == ["a.b", "e", "l", "l.u", "p.q.r.s"]


def test_links_of_merged_records(spark):
    rows = [(1, "https://a.org/1", "one claim", "False", "http://bad.com/x"), (2, "https://a.org/1", "one claim!", "True", "http://bad.com/x"), (3, "https://b.org/1", "other", "False", "http://bad.com/x, http://sub.b.org/own")]
    cr = spark.createDataFrame([(i, u, c, lab, 5, 1, 1, link, None, "s") for i, u, c, lab, link in rows], "review_id long, url string, claim_reviewed string, alternate_name string, best int, worst int, value int, appearance string, date_published date, retrieved_by string")
    assert [tuple(r) for r in rv.link_conflicts(cr).where("link = 'http://bad.com/x'").collect()] == [("http://bad.com/x", 2, 2, "check_me")]
    only = rv.link_table(cr, "not_credible").where("misinforming_url = 'http://bad.com/x'").first()
    assert [r["review_url"] for r in only["reviews"]] == ["https://b.org/1"]
    assert rv.links_of(cr).where("link LIKE '%own%'").count() == 0


RAW = [
    {"url": "https://www.me.org/r1", "claimReviewed": "  a claim ", "reviewRating": {"ratingValue": "5", "bestRating": "1", "worstRating": "5", "alternateName": "False"}, "itemReviewed": {"url": "http://bad.com/x/", "appearance": []}, "datePublished": "2019-02-03 10:00"},
    {"url": "https://www.me.org/r2", "claimReviewed": ["first"], "reviewRating": {"ratingValue": 3.5, "bestRating": 5, "worstRating": 1}, "itemReviewed": {"appearance": [{"url": "http://b.com/1/"}, {"url": "http://sub.me.org/own"}], "firstAppearance": "http://c.com/2"}},
    {"url": "https://www.me.org/r3", "reviewRating": {"ratingValue": 1, "bestRating": 1, "worstRating": 1}, "itemReviewed": {"appearance": ["http://e.com/1", "1", "file.html"]}},
    {"url": "https://www.me.org/r4", "properties": {"reviewRating": {"properties": {"alternateName": "Half True"}}, "itemReviewed": {"appearance": {"url": "http://f.com"}, "url": ["http://g.com"]}}},
    {"url": "https://www.me.org/r5", "reviewRating": {"ratingValue": -1, "bestRating": -1, "worstRating": -1, "alternateName": "free text"}, "itemReviewed": {"url": "", "sameAs": []}},
]


def test_raw_reviews(spark):
    import json

    docs = spark.createDataFrame([(json.dumps(d),) for d in [*RAW, ["no object"], "text"]], "raw string").select(F.try_parse_json("raw").alias("doc"))
    got = {r["url"][-2:]: r for r in raw_reviews.finished(raw_reviews.reviews_of(docs)).collect()}
    assert {k: (r["label"], r["appearances"]) for k, r in got.items()} == {
        "r1": ("not_credible", ["http://bad.com/x"]),
        "r2": ("uncertain", ["http://b.com/1", "http://c.com/2"]),
        "r3": ("not_verifiable", ["http://e.com/1"]),
        "r4": ("uncertain", ["http://f.com", "http://g.com"]),
        "r5": ("not_verifiable", []),
    }
    assert str(got["r1"]["date_published"]) == "2019-02-03" and got["r2"]["value"] == "3" and got["r1"]["claim_reviewed"] == "a claim"


@pytest.mark.parametrize("text,day", [("2021-03-04T23:00:00-05:00", "2021-03-04"), ("March 3, 2020", "2020-03-03"), ("3 Mar. 2020", "2020-03-03"), ("12/31/2021", "2021-12-31"), ("31/12/2021", "2021-12-31"), ("stated on April 2, 2020 in an interview", "2020-04-02"), ("Monday, July 6th, 2020", "2020-07-06"), ("20220304", "2022-03-04"), ("20220304T101500Z", "2022-03-04"), ("Mar 2022", "2022-03-01"), ("3.4.22", "2022-04-03"), ("3. 4. 2022.", "2022-04-03"), ("3 de marzo de 2020", "2020-03-03"), ("1er février 2021", "2021-02-01"), ("12 août 2019", "2019-08-12"), ("3 Mart 2020", "2020-03-03"), ("15 Ağustos 2021", "2021-08-15"), ("3. oktobar 2020.", "2020-10-03"), ("5. децембар 2018", "2018-12-05"), ("7 dicembre 2020", "2020-12-07"), ("4 Mei 2021", "2021-05-04"), ("3-Mar-20", "2020-03-03"), ("Dec 31 '99", "1999-12-31"), ("31 février 2021", None), ("2021/3/4", "2021-03-04"), ("99999999", None), ("5 minutes 2020", None), ("rubbish", None), ("", None), (None, None)])
def test_days(spark, text, day):
    assert one(spark, day_of(F.lit(text).cast("string")).cast("string")) == day


def test_plugins(spark, tmp_path):
    import json

    (tmp_path / "in" / "datacommons_feeds").mkdir(parents=True)
    (tmp_path / "in" / "datacommons_feeds" / "feed.json").write_text(json.dumps({"dataFeedElement": [{"item": [RAW[0], None]}, {"item": None}]}))
    page = '<main id="main"><article><h2 class="entry-title"><a href="http://n/1">T</a></h2><div class="entry-content"><p>CLAIM: moon</p></div></article></main>'
    spark.createDataFrame([(1, page), (2, page)], "number int, html string").write.parquet(str(tmp_path / "in" / "factcheckni"))
    run = lambda update: {r["id"]: (r["n_rows"], r["error"] is None) for r in plugins.collect(spark, str(tmp_path / "in"), str(tmp_path / "out"), update, ["datacommons_feeds", "factcheckni", "snopes"]).collect()}
    assert run(True) == {"datacommons_feeds": (1, True), "factcheckni": (1, True), "snopes": (None, False)}
    assert run(False) == run(True), "raw rows are replayed"
    assert spark.read.parquet(str(tmp_path / "out" / "rows" / "factcheckni")).select("claim", "retrieved_by").collect() == [("moon", "factcheckni")]
    assert len(plugins.SOURCES) == 17


def test_store_index(spark, tmp_path):
    index = spark.createDataFrame([("2024_01_01", {"a": "/x"}), ("latest", {"a": "/y"}), ("2024_01_02", {})], "date string, files map<string,string>")
    assert store.data_file(index, "a") == "/y"
    for call in (lambda: store.data_file(index, "b"), lambda: store.index_entry(index, "2020_01_01")):
        with pytest.raises(KeyError):
            call()
    assert store.stale_dates(index, "2024_01_01").collect() == [("2024_01_02",)]
    made = []
    for _ in range(2):
        assert store.loaded_or_made(spark, str(tmp_path / "t"), lambda: made.append(1) or index).count() == 3
    assert made == [1]
    store.write_csv(index.select("date"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3
    assert serving.topic_package({"one": index.select("date"), "two": index.select("date").limit(1)}, str(tmp_path / "pkg"), "d") == {"one": 3, "two": 1}


def test_entry_without_the_operators_of_the_pipeline(tmp_path):
    """The entry module and its queries are there when the subpackage, its tests and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parents[1]
    shutil.copytree(root / "factloom", tmp_path / "factloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not [x for x in q if x.startswith('op') or x == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    for pipeline_left in (False, True):
        if pipeline_left:
            shutil.copy(root / "corpus_pipeline.py", tmp_path)
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""} | {k: v for k, v in __import__("os").environ.items() if k == "JAVA_HOME"})


def test_wide_reviews_keeps_every_domain(spark):
    rows = [(i, f"https://site{i}.org/a", "False", 5, 1, 1, "https://bad.example/x" if i < 5 else "https://bad.example/y") for i in range(7)]
    reviews = spark.createDataFrame(rows, "review_id long, url string, alternate_name string, best int, worst int, value int, appearance string")
    reviews = reviews.withColumns({"claim_reviewed": F.lit("c"), "date_published": F.lit(None).cast("date"), "retrieved_by": F.lit("s")})
    wide = {r["link"]: r.asDict() for r in rv.wide_reviews(reviews).collect()}
    assert sorted(r["n_domains"] for r in wide.values()) == [2, 5]
    for r in wide.values():
        assert sum(r[f"review_domain_{i}"] is not None for i in range(5)) == r["n_domains"]
        assert sum(r[f"review_url_{i}"] is not None for i in range(5)) == r["n_domains"]
    assert "review_domain_5" not in next(iter(wide.values()))
