"""Operator 11, filter interaction audit: what each of five filters removes in every order, by inclusion and exclusion.

Each document is measured once. Its five failures are flags; over a part the sums of flag products are the numbers of
joint failures J(S) of the 32 sets S of filters. Everything else follows from these 32 numbers (and the same two sums over
good and toxic documents), without another look at the documents:

* survivors of a set T of filters: the sum over S within T of (-1)^|S| J(S) (Moebius inversion);
* removed at a step: survivors before it less survivors after it; redundant: J({f}) less removed;
* failures of f alone: the sum over S with f of (-1)^(|S|-1) J(S);
* Shapley value: the Harsanyi dividend of S is (-1)^(|S|-1) J(S), of which each of its filters has a share of 1/|S|; over all
  120 orders that is 120/|S|, a whole number.

Texts don't move: only a digest (SHA-256), the flags and the part do, and they meet their equals after sums by digest and part.

Null texts are empty and equal to empty ones. Rows repeated with one doc_id count each, and none of them is the copy of
another. A row without a doc_id has no smaller one, so it never fails E, and has no labels; it also makes no other row fail. A
null part is the empty one. Of several labels of one doc_id, any that is 1 counts. An empty table gives no rows. Other columns
are ignored. A very long text is read in pieces; its distinct words are kept in memory.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import slices

FILTERS = "ABCDE"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
BLANK = re.compile(rb"[\x20\x09-\x0D]")
SIGNS = re.compile(rb"[#$%&*|]")
#: Bytes of a text whose words are taken at once.
PIECE = 4_000_000
WEIGHTS = ("n", "good", "toxic")


def words_of(text: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in lists; a word ends at one of six ASCII blanks, and so does a piece."""
    start = 0
    while start < len(text):
        blank = BLANK.search(text, start + piece)
        end = blank.start() if blank else len(text)
        yield text[start:end].split()
        start = end


def failures(text: bytes, n_chars: int, piece: int = PIECE) -> int:
    """Bits of the failed filters A to D."""
    words, distinct = 0, set()
    for part in words_of(text, piece):
        words += len(part)
        distinct.update(part)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (words < 200) | (100 * len(distinct) < 50 * words) << 1 | (100 * capitals > 3 * n_chars) << 2 | bool(SIGNS.search(text)) << 3


def measured(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, digest, own (bits of A to D) of every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch["text"], "")
            sizes = pc.utf8_length(texts).to_pylist()
            raw = [x.as_buffer().to_pybytes() if x.as_buffer() else b"" for x in texts]
            own = pa.array([failures(x, n) for x, n in zip(raw, sizes, strict=True)], pa.int32())
            digest = pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], digest, own], ["doc_id", "part", "digest", "own"])

    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), "text")
    return rows.mapInArrow(measure, "doc_id long, part string, digest binary, own int")


def failing(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask (bits of the failed filters), n, good, toxic: sums over rows that fail alike, several rows a part and mask.

    Sums by digest, part and doc_id need no exchange beyond that of the join with the labels; those by digest and part are
    made within tasks first, so many copies of one text arrive as few rows. Only then do a digest's parts meet.
    """
    known = labels.groupBy(F.col("doc_id").alias("key")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("key IS NOT NULL")
    # rows without a doc_id have keys that are spread, and match nothing by the second condition
    rows = measured(docs, part).withColumn("key", F.coalesce("doc_id", -1 - F.monotonically_increasing_id()))
    rows = rows.join(known.withColumnRenamed("key", "known"), (F.col("key") == F.col("known")) & F.col("doc_id").isNotNull(), "left")
    by_id = rows.groupBy("key", "doc_id", "digest", "part").agg(F.first("own").alias("own"), F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    has_id = F.col("doc_id").isNotNull()
    sums = by_id.groupBy("digest", "part").agg(
        F.first("own").alias("own"),
        F.min("doc_id").alias("least"),
        F.min_by(F.struct(*WEIGHTS), F.col("doc_id")).alias("first"),  # one row, as rows of one doc_id are summed already
        *[F.sum(F.when(has_id, F.col(w)).otherwise(0)).alias(w) for w in WEIGHTS],
        *[F.sum(F.when(has_id, 0).otherwise(F.col(w))).alias(f"{w}_no_id") for w in WEIGHTS],
    )
    both = sums.withColumn("overall", F.min("least").over(Window.partitionBy("digest")))  # as many rows as a text has parts
    is_first = F.col("least") == F.col("overall")
    stays = lambda w: F.when(is_first, F.col(f"first.{w}")).otherwise(0)
    kinds = F.array(
        F.struct(F.col("own").alias("mask"), *[(F.col(f"{w}_no_id") + stays(w)).alias(w) for w in WEIGHTS]),
        F.struct((F.col("own") + 16).alias("mask"), *[(F.col(w) - stays(w)).alias(w) for w in WEIGHTS]),
    )
    return both.select("part", F.explode(kinds).alias("k")).select("part", "k.*").where("n > 0")


def joint_failures(rows: DataFrame) -> DataFrame:
    """part, and n, good, toxic: of each an array J with the sum of flag products for every set of filters, by its bits."""
    alike = rows.groupBy("part", "mask").agg(*[F.sum(w).alias(w) for w in WEIGHTS])
    sets = alike.withColumn("set", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))))
    product = (F.col("mask").bitwiseAND(F.col("set")) == F.col("set")).cast("int")  # 1 where all flags of the set are
    sums = sets.groupBy("part", "set").agg(*[F.sum(F.col(w) * product).alias(w) for w in WEIGHTS])
    whole = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("set", *WEIGHTS))).alias("j"))  # 32 of a part
    return whole.select("part", *[F.col(f"j.{w}").alias(w) for w in WEIGHTS])


def audit(joint: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the sums of joint_failures."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    sets = F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))
    sign = lambda s: F.when(F.bit_count(s) % 2 == 0, 1).otherwise(-1)
    share = lambda s: F.floor(F.lit(len(orders)) / F.bit_count(s)).cast("long")

    def summed(chosen, term) -> Column:
        return F.aggregate(F.filter(sets, chosen), F.lit(0).cast("long"), lambda acc, s: acc + term(s))

    def survivors(w: str) -> Column:
        """By the bits of each set of filters: how many fail none of them."""
        return F.transform(sets, lambda t: summed(lambda s: s.bitwiseAND(F.bitwise_not(t)) == 0, lambda s: sign(s) * F.get(w, s)))

    def by_filter(term) -> Column:
        """By the number of each filter: the sum of term over the sets that hold it."""
        return F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda i: summed(lambda s: F.getbit(s, i) == 1, term))

    steps = []
    for order in orders:
        before = 0
        for step, name in enumerate(order, 1):
            i = FILTERS.index(name)
            steps.append({"filter_order": order, "step": step, "i": i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    arrays = joint.select(
        "part",
        *[survivors(w).alias(f"{w}_left") for w in WEIGHTS],
        F.array(*[F.get("n", F.lit(1 << i)) for i in range(len(FILTERS))]).alias("fail"),
        by_filter(lambda s: -sign(s) * F.get("n", s)).alias("alone"),
        by_filter(lambda s: -sign(s) * F.get("n", s) * share(s)).alias("shapley"),
    )
    rows = arrays.withColumn(
        "at",
        F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, i: int, before: int, after: int>>")),
    )
    lost = {w: F.get(f"{w}_left", F.col("at.before")) - F.get(f"{w}_left", F.col("at.after")) for w in WEIGHTS}
    of_filter = lambda c: F.get(c, F.col("at.i"))
    return rows.select(
        "part",
        "at.filter_order",
        "at.step",
        F.get("n_left", F.col("at.after")).alias("kept"),
        lost["n"].alias("removed"),
        (of_filter("fail") - lost["n"]).alias("redundant"),
        of_filter("alone").alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        of_filter("shapley").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of docs(doc_id, text, <part>) under labels(doc_id, quality, toxic)."""
    return audit(joint_failures(failing(docs, labels, part)))
