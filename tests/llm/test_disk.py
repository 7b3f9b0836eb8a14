"""What is left on disk of a query's intermediate tables and shuffles."""

import time

import corpus_pipeline
from factloom.llm import common, op7_line_dedup, op9_suffix_dedup
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, documents


def tables(spark) -> set[str]:
    return {path for s, path in common._made if s is spark}


def shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    frame = spark.range(50_000).withColumn("k", F.xxhash64("id")).groupBy("k").count()  # kept: no garbage to collect
    table = common.materialise(frame, "counted")
    for _ in range(20):  # executors delete them a moment later
        if left := shuffle_files(spark) - before:
            time.sleep(0.5)
    assert not left and table.count() == frame.count() == 50_000
    assert spark.conf.get(common.ENDED) == "false"


def test_only_marks_stay(spark):
    docs = documents(spark, awkward())
    rows = {
        "lines": lambda: op7_line_dedup.line_digests(docs),
        "kept lines": lambda: op7_line_dedup.deduplicated(docs),
        "bytes": lambda: op9_suffix_dedup.dedup_digests(docs),
        "copies": lambda: corpus_pipeline.ngram_jaccard(spark, docs, ""),
    }
    for name, make in rows.items():
        before = tables(spark)
        out = make()
        assert len(tables(spark) - before) <= 1, name
        assert out.count() > 0


def test_pipeline_keeps_the_last_table_only(spark):
    before = tables(spark)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in tables(spark) - before] == ["after-suffix_dedup"]
    assert out.count() > 0
