"""Operator 3, toxicity: maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Tokens (lower-cased runs of letters and digits) get log-odds between toxic and clean training documents, with a
Dirichlet prior in proportion to the tokens of both. Those surely on the toxic side (z of `least_z` or more, in
`least_docs` toxic documents or more) form a lexicon of at most `most_tokens`; each other token costs `drift`. A
linear scan finds all maximal scoring segments of a text (Ruzzo and Tompa, 1999). By Karlin and Altschul (1990)
a segment of score S in n tokens is met K n exp(-lambda S) times by chance, lambda being the root of the scores'
moment equation over clean text and K fitted to the best segments of clean training documents; those met under
`most_expected` times are the toxic passages. The documents' scores join the best passage, the sum of all and the
lexicon's share in a logistic calibration.

Labels are read only for documents whose crc32(doc_id as text) mod 5 is not 0, and of those at most
`sample` (default 200,000, the first by a hash of doc_id): the classifier's documented bound. Corpus passes cover all rows.

Null and empty texts have no passage and get the score of such documents. Labels that are null are passed
over; repeated labels of a document count once (the largest); with no label of either class every score is 0.
Very long texts are scanned whole, in time linear in their tokens. Of segments of equal sums the first and shortest is
taken; a score of 0.5 exactly is predicted toxic. Rows that repeat a doc_id are scored each. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import materialise, slices
from factloom.llm.textkernel import words

#: Bytes between tokens: ASCII other than letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: K of the calibration is held to this range, so that passages can be listed before it is known.
LEAST_K, MOST_K = 1e-3, 1.0


@dataclass
class Lexicon:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    drift: float
    rate: float  # lambda

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the lexicon's tokens."""
        if not len(self.tokens) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0)
        i = np.searchsorted(self.tokens, hashes)
        i[i == len(self.tokens)] = 0
        at = np.flatnonzero(self.tokens[i] == hashes)
        return at, self.scores[i[at]]


def maximal_segments(at: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text, from its positive tokens alone, in linear time.

    Each candidate keeps a link to the nearest earlier one with a lesser sum before it. Those between the two have no
    lesser sum than it, so a later search that gets to it goes on from its link, and passes by them for good.
    """
    found: list[tuple] = []  # first, last, sum before it, sum up to its end, link
    total, last = 0.0, -1
    for p, s in zip(at, scores, strict=True):
        total -= drift * (p - last - 1)
        first, low, high, k = p, total, total + s, len(found) - 1
        total, last = high, p
        while True:
            while k >= 0 and found[k][2] >= low:
                k = found[k][4]
            if k < 0 or found[k][3] >= high:
                found.append((first, p, low, high, k))
                break
            first, _, low, _, link = found[k]
            del found[k:]
            k = link
    return [(a, b, high - low) for a, b, low, high, _ in found]


def chance_rate(scores: np.ndarray, shares: np.ndarray, drift: float) -> float:
    """The positive root of sum p exp(lambda s) = 1 over clean text."""
    rest = max(0.0, 1 - shares.sum())
    f = lambda x: float((shares * np.exp(np.minimum(700, x * scores))).sum()) + rest * math.exp(-x * drift) - 1
    low, high = 1e-9, 1.0
    if not len(scores):
        return 1.0
    while f(high) < 0 and high < 100:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return max(low, 1e-6)


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def training_labels(labels: DataFrame, sample: int) -> dict[str, np.ndarray]:
    """doc_id and toxic of the bounded sample, sorted by doc_id."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    got = rows.toPandas().sort_values("doc_id")
    return {"doc_id": got["doc_id"].to_numpy(np.int64), "toxic": got["toxic"].to_numpy(np.int64)}


def fit_lexicon(docs: DataFrame, known: dict[str, np.ndarray], least_z: float = 3.0, least_docs: int = 3, most_tokens: int = 65_536, prior_share: float = 0.1, drift: float = 0.15) -> Lexicon:
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        ids, toxic = shared.value["doc_id"], shared.value["toxic"]
        for batch in batches:
            doc = batch["doc_id"].fill_null(-1).to_numpy()
            i = np.minimum(np.searchsorted(ids, doc), max(0, len(ids) - 1))
            there = (ids[i] == doc) & batch["doc_id"].is_valid().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(len(doc), bool)
            for part in slices(iter([batch.filter(pa.array(there)).append_column("toxic", pa.array(toxic[i[there]]))]), "text"):
                h, starts = words(part["text"], between=BETWEEN)
                row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                pair = np.unique(np.rec.fromarrays([h, row]))  # a token counts once a document
                token, back, n = np.unique(pair["f0"], return_inverse=True, return_counts=True)
                bad = np.bincount(back, part["toxic"].to_numpy()[pair["f1"]], len(token)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(bad), pa.array(n - bad)], ["token", "toxic", "clean"])

    counts = docs.select("doc_id", "text").mapInArrow(count, "token long, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = materialise(counts, "token-counts")
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = totals[0] or 0, totals[1] or 0
    if not n_toxic or not n_clean:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0), drift, 1.0)
    prior = prior_share * (n_toxic + n_clean)  # of the same weight beside the data at every size
    a = F.lit(prior) * (F.col("toxic") + F.col("clean")) / F.lit(n_toxic + n_clean)
    t, c = F.col("toxic") + a, F.col("clean") + a
    odds = F.log(t / (F.lit(n_toxic + prior) - t)) - F.log(c / (F.lit(n_clean + prior) - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    top = counts.where(F.col("toxic") >= least_docs).select("token", odds.alias("odds"), z.alias("z"), (c / F.lit(n_clean + prior)).alias("share"))
    top = top.where(F.col("z") >= least_z).orderBy(F.desc("z"), "token").limit(most_tokens).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    scores = top["odds"].to_numpy(float)[order]
    return Lexicon(tokens[order], scores, drift, chance_rate(scores, top["share"].to_numpy(float)[order], drift))


def passages_of(lexicon: Lexicon, hashes: np.ndarray) -> tuple[list[tuple[int, int, float]], int, float]:
    """Segments (first token, last token, -ln of the number expected by chance if K were 1) that may be toxic passages,
    how many tokens are in the lexicon, and the best segment's lambda S (0 if there is none)."""
    at, scores = lexicon.hits(hashes)
    if not len(at):
        return [], 0, 0.0
    base = math.log(max(1, len(hashes)))
    found = [(a, b, lexicon.rate * s) for a, b, s in maximal_segments(at.tolist(), scores.tolist(), lexicon.drift)]
    return [(a, b, x - base) for a, b, x in found if x - base >= math.log(LEAST_K)], len(at), max(x for _, _, x in found)


def segments(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, n_tokens, n_hits, best and the segments that may be toxic passages (spans in tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def scan(batches):
        for batch in slices(batches, "text"):
            h, starts = words(batch["text"], between=BETWEEN)
            rows = [(b - a, *passages_of(shared.value, h[a:b])) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            spans = [[{"first": a, "last": b, "surprise": e} for a, b, e in r[1]] for r in rows]
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("surprise", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.float64()), pa.array(spans, kind)], ["doc_id", "n_tokens", "n_hits", "best", "passages"])

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_tokens long, n_hits long, best double, passages array<struct<first long, last long, surprise double>>")


def chance_constant(clean: DataFrame) -> float:
    """K, by maximum likelihood over clean documents: the best of n tokens is S or less with probability
    exp(-K n exp(-lambda S)), and documents without any segment tell only that theirs is 0 or less."""
    got = clean.agg(F.count_if(F.col("best") > 0).alias("n"), F.sum(F.col("n_tokens") * F.exp(-F.col("best"))).alias("size")).first()
    return min(MOST_K, max(LEAST_K, got["n"] / got["size"])) if got["size"] else LEAST_K


def surprising(found: DataFrame, k: float, most_expected: float) -> DataFrame:
    """found with the toxic passages alone: those met under most_expected times by chance, with -ln of that number."""
    spans = F.transform("passages", lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), (p["surprise"] - F.lit(math.log(k))).alias("surprise")))
    return found.withColumn("passages", F.filter(spans, lambda p: p["surprise"] >= F.lit(-math.log(most_expected))))


def features() -> list[F.Column]:
    best = F.coalesce(F.array_max(F.transform("passages", lambda p: p["surprise"])), F.lit(0.0))
    total = F.aggregate("passages", F.lit(0.0), lambda acc, p: acc + p["surprise"])
    share = F.col("n_hits") / F.greatest(F.lit(1), F.col("n_tokens"))
    return [F.least(best, F.lit(50.0)) / 10, F.log1p(F.greatest(total, F.lit(0.0))), F.least(100 * share, F.lit(20.0))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Intercept and weights by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) * np.eye(len(w)) / 100, x.T @ (y - p) - ridge * len(x) / 100 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 200_000, most_expected: float = 1.0) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, passages of every row of docs."""
    known = training_labels(labels, sample)
    lexicon = fit_lexicon(docs, known)
    found = materialise(segments(docs, lexicon), "segments")
    ids = docs.sparkSession.createDataFrame(pa.table({"doc_id": known["doc_id"], "toxic": known["toxic"]}))
    labelled = found.join(F.broadcast(ids), "doc_id")  # at most `sample` labels
    found = surprising(found, k := chance_constant(labelled.where("toxic = 0")), most_expected)
    seen = surprising(labelled, k, most_expected).select(*[f.alias(f"x{i}") for i, f in enumerate(features())], "toxic").toPandas()
    names = [c for c in seen.columns if c != "toxic"]
    y = seen["toxic"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        w = fit_logistic(seen[names].to_numpy(float), y)
        line = F.lit(float(w[0]))
        for f, weight in zip(features(), w[1:].tolist(), strict=True):
            line = line + f * F.lit(weight)
        score = 1 / (1 + F.exp(-line))
    else:
        score = F.lit(0.0)
    out = found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), score.alias("score"), F.size("passages").cast("long").alias("n_passages"), "passages")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "passages")
