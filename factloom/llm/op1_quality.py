"""Operator 1, quality rules, with DataFrame functions only.

Every document is measured and tested against rules. Failures are aggregated by host (the source column); the
rate of a host is shrunk to an empirical beta prior, fitted by the moments of all hosts' rates, so that hosts of
few documents lie near the rest. The verdicts on hosts then go back to their documents:

* rejected (shrunk rate over `reject_rate`): no document stays;
* trusted (under `trust_rate`): a document may fail one rule beside the base rules;
* ordinary: a document that fails any rule goes.

A document that fails a base rule goes on every host. Null and empty texts have no words and fail. A null source
is a host of its own. Rows that repeat are measured each. Very long texts are measured whole. A rate that equals a bound
is neither over nor under it. Extra columns, of any name, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise

BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
#: Parts that hot hosts are dealt to when verdicts are joined.
SALTS = 32


def bind(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more, each word counted once.

    Hashes tell whether any window repeats; only then are the windows themselves sorted and compared.
    """
    n = F.size(words) - WINDOW + 1
    starts = F.sequence(F.lit(0), n - 1)

    def windows(hashes: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)]))

    def exact(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(starts, lambda i: F.struct(F.get(hashes, i).alias("h"), F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("i"))))

        def positions(rows: Column) -> Column:
            def same(k: Column, other: Column) -> Column:
                a, b = F.get(rows, k), F.get(rows, other)
                return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

            def at(k: Column) -> Column:
                return F.when(same(k, k - 1) | same(k, k + 1), F.get(rows, k)["i"])

            return F.sort_array(F.filter(F.transform(F.sequence(F.lit(0), F.size(rows) - 1), at), lambda x: x.isNotNull()))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        step = lambda acc, x: F.struct(x.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("total"))
        return F.aggregate(bind(keyed, positions), start, step, lambda acc: acc["total"])

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(exact(hashes))

    hashes = bind(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(n < 2, 0).otherwise(bind(hashes, counted))


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))

    def of(words: Column) -> Column:
        joined = F.array_join(words, "")

        def counts(joined: Column, lines: Column) -> Column:
            chars = F.length(joined)
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                chars.cast("long").alias("word_chars"),
                (chars - F.length(F.translate(joined, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                (chars - F.length(F.translate(joined, CAPITALS, ""))).cast("long").alias("n_capitals"),
                F.size(lines).cast("long").alias("n_lines"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                repeat_words(words).cast("long").alias("n_repeat_words"),
            )

        return bind(joined, lambda joined: bind(lines, lambda lines: counts(joined, lines)))

    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return bind(words, of)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Each true where a document fails; all over the columns of measures()."""
    return {
        "base_failed": base_failed(),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "capitals": 10 * F.col("n_capitals") > 3 * F.col("word_chars"),
        "copied_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host, the measures and one flag fails_<rule> for each rule."""
    out = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("\x00null")).alias("host"), measures(F.col("text")).alias("m"))
    out = out.select("doc_id", "host", "m.*")
    return out.select("*", *[rule.alias(f"fails_{name}") for name, rule in rules().items()])


def host_verdicts(rows: DataFrame, trust_rate: float = 0.05, reject_rate: float = 0.9) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, verdict for every host in measured rows."""
    failed = F.col("fails_base_failed")
    for name in list(rules())[1:]:
        failed = failed | F.col(f"fails_{name}")
    hosts = materialise(rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(failed.cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("var")).first()  # one row for all hosts
    mean, var = moments["mean"] or 0.0, moments["var"] or 0.0
    # With hardly any spread the prior is held at a thousand documents' weight; with very much, at one's.
    weight = max(1.0, min(1000.0, mean * (1 - mean) / max(var, 1e-12) - 1))
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    verdict = F.when(F.col("shrunk_rate") > reject_rate, "rejected").when(F.col("shrunk_rate") < trust_rate, "trusted").otherwise("ordinary")
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate")).withColumn("verdict", verdict)


def _kept() -> Column:
    broken = sum((F.col(f"fails_{name}").cast("int") for name in list(rules())[1:]), F.lit(0))
    allowed = F.when(F.col("verdict") == "trusted", 1).otherwise(0)
    return ~F.col("fails_base_failed") & (F.col("verdict") != "rejected") & (broken <= allowed)


def with_verdicts(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Join the verdicts by host; the rows of a host are dealt to SALTS parts, as one may hold a third of all."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    parts = verdicts.select("host", "verdict").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(parts, ["host", "salt"]).withColumn("kept", _kept()).drop("salt")


def quality(docs: DataFrame, trust_rate: float = 0.05, reject_rate: float = 0.9) -> DataFrame:
    """One row a document: doc_id, the measures, base_failed, verdict of its host, kept."""
    rows = materialise(measured(docs), "measured")
    out = with_verdicts(rows, host_verdicts(rows, trust_rate, reject_rate))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("fails_base_failed").alias("base_failed"), "kept")


def kept_documents(docs: DataFrame, trust_rate: float = 0.05, reject_rate: float = 0.9) -> DataFrame:
    """The rows of docs that stay, with docs' own columns.

    Texts are measured once, and written beside the outcome of the rules unless these leave no way to stay; the verdicts
    on hosts are then made from the outcomes alone (a read of these columns). Hosts with the ordinary verdict aren't
    joined at all; the others are a list that Spark broadcasts when it is small by its own size check, and joins by salted
    key otherwise.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    host = F.coalesce(F.col("source").cast("string"), F.lit("\x00null")).alias("host")
    rows = docs.select(row, host, F.xxhash64("doc_id").alias("salt"), measures(F.col("text")).alias("m")).select("row", "host", "salt", "m.*")
    flags = [F.col(f"fails_{name}") for name in rules()]
    rows = rows.select("row", "host", F.pmod("salt", F.lit(SALTS)).alias("salt"), *[rule.alias(f"fails_{name}") for name, rule in rules().items()])
    broken = sum((f.cast("int") for f in flags[1:]), F.lit(0))
    rows = materialise(rows.withColumn("row", F.when(~flags[0] & (broken <= 1), F.col("row"))), "measured")
    verdicts = materialise(host_verdicts(rows, trust_rate, reject_rate).where("verdict <> 'ordinary'").select("host", "verdict"), "verdicts")
    parts = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    out = rows.where("row IS NOT NULL").join(parts, ["host", "salt"], "left").withColumn("verdict", F.coalesce("verdict", F.lit("ordinary")))
    return out.where(_kept()).select("row.*")
