"""Operator 13, cross-tokenizer alignment: tokens of two tokenizers cut into the smallest groups with common ends.

A dangling-suffix transducer reads both token rows. Its state is which side leads and the bytes by which it leads, always an end
of one token; the side behind takes its next token, and the step is kept by (side, rest, token). Each step links the two tokens
it compares, and an empty rest closes a group.

Where both tokenizers split (a single space between non-blank characters: the byte-level one always does, and the piece model
does if no piece has a space after another character, which is looked up), a group ends too; so a text's groups are those of its
segments one after another, and segments repeat. Only distinct segments are encoded and aligned, by blocks of `block_bytes` of
text. A text with a segment whose bytes don't come back is encoded whole instead.

Link counts over the corpus: a block sends each of its id pairs once, with its sum; counts and the highest count of each B id
come back to the blocks that asked, and a block adds up its documents, each block by itself (a cogroup). Its links stand in a table in the shared folder meanwhile,
so texts are read and encoded once. No row is as large as the corpus: a block is bounded, a pair's rows are the blocks that hold it,
and rows of one B id are at most as many as A has tokens.

Nulls, empty texts, and texts whose tokens' bytes aren't a space and the text: zeros and an empty string. Repeated rows count each,
also in the link counts. A very long text is a block of its own. Ties for the highest count are all highest. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import materialise, released, ship, slices
from factloom.llm.segments import cut

SPACE = "▁"
#: Segments up to so many characters are kept for later blocks, up to so many at once; as are steps of the transducer.
KEPT_CHARS, KEPT, STEPS = 48, 300_000, 500_000
#: Blocks of one row group of the table of blocks.
GROUP = 4


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 is itself, others follow at 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Groups and links of two token rows.

    A state is a number for (side that leads, rest): 0 for an empty rest, positive if A leads, negative if B does. Steps are kept
    by state and next token. The bytes of a rest are those of the ends of tokens, so their number is bounded by the vocabularies.
    """

    FAIL = 1 << 60
    SHIFT = 20  # tokens have numbers below this power of two

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.bytes = (a_bytes, b_bytes)
        self.names = ([str(i) for i in range(len(a_bytes))], [str(i) for i in range(len(b_bytes))])
        self.rests: list[bytes] = [b""]
        self.numbers: dict[bytes, int] = {b"": 0}
        self.steps: dict[int, int] = {}
        self.starts = [self.number(x) for x in a_bytes]

    def number(self, rest: bytes) -> int:
        if rest not in self.numbers:
            self.numbers[rest] = len(self.rests)
            self.rests.append(rest)
        return self.numbers[rest]

    def step(self, state: int, token: int) -> int:
        """The state once the side behind has taken the token; FAIL if that doesn't fit."""
        side = 1 if state > 0 else -1
        rest, other = self.rests[abs(state)], self.bytes[state > 0][token]
        if rest.startswith(other):
            to = side * self.number(rest[len(other) :])
        elif other.startswith(rest):
            to = -side * self.number(other[len(rest) :])
        else:
            to = self.FAIL
        if len(self.steps) >= STEPS:
            self.steps.clear()
        self.steps[state << self.SHIFT | token] = to
        return to

    def align(self, a: list[int], b: list[int]) -> tuple[list[str], list[int]] | None:
        """Each group as `a1,a2|b1`, and the links as a << 32 | b; None if the bytes differ."""
        groups, links, steps, starts, shift, fail = [], [], self.steps, self.starts, self.SHIFT, self.FAIL
        name_a, name_b = self.names
        i = j = 0
        try:
            while i < len(a):
                top = a[i]
                i += 1
                of_a, of_b, state = name_a[top], "", starts[top]
                while state:
                    if state > 0:
                        token = b[j]
                        j += 1
                        of_b = f"{of_b},{name_b[token]}" if of_b else name_b[token]
                        links.append(top << 32 | token)
                        to = steps.get(state << shift | token)
                        state = self.step(state, token) if to is None else to
                        if state < 0:
                            top = token
                    else:
                        token = a[i]
                        i += 1
                        of_a = f"{of_a},{name_a[token]}"
                        links.append(token << 32 | top)
                        to = steps.get(state << shift | token)
                        state = self.step(state, token) if to is None else to
                        if state > 0:
                            top = token
                    if state == fail:
                        return None
                groups.append(f"{of_a}|{of_b}")
        except IndexError:  # one side ended first
            return None
        return (groups, links) if j == len(b) else None


class Aligner:
    """Alignments of texts under two tokenizer files, by way of their distinct segments."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.encode_a = getattr(self.a, "encode_batch_fast", self.a.encode_batch)  # without offsets
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        table = byte_level()
        token = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        # an added token is no byte-level string; it never comes out, as its string is plain text
        a_bytes = [bytes(table[c] for c in t) if all(c in table for c in t) else t.encode() for t in token]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.transducer = Transducer(a_bytes, b_bytes)
        self.a_lengths = np.array([len(x) for x in a_bytes])
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.known: dict[str, tuple | None] = {}

    def entries(self, segments: list[str]) -> list[tuple | None]:
        """Of each segment: tokens of A and B, groups, its groups as text, its links as bytes of 64-bit numbers; None if bytes differ."""
        new = [x for x in segments if x not in self.known]
        made: dict[str, tuple | None] = {}
        for i in range(0, len(new), 2000):
            part = new[i : i + 2000]
            for text, a, b in zip(part, self.encoded(part), self.b.encode(part, num_threads=1), strict=True):
                made[text] = self._entry(text, a, b)
        known = self.known
        out = [made[x] if x in made else known[x] for x in segments]
        if len(known) + len(made) > KEPT:  # those of this block stay, if they aren't too many
            known = self.known = {}
            made = dict(zip(segments, out, strict=True)) if len(segments) <= KEPT else {}
        known.update((k, v) for k, v in made.items() if len(k) <= KEPT_CHARS)
        return out

    def encoded(self, segments: list[str]) -> list[list[int]]:
        """A's tokens of a space and each segment.

        Segments without blanks at their ends go as one text, in which the tokenizer splits at the spaces between them; each
        has the tokens that end where it does. Should its bytes not come out that way, and for the others, each goes by itself.
        """
        joined = [x for x in segments if x and not x[0].isspace() and not x[-1].isspace()] if self.splits else []
        found: dict[str, list[int]] = {}
        if joined:
            ids = self.encode_a([" " + " ".join(joined)], add_special_tokens=False)[0].ids
            ends = np.cumsum(self.a_lengths[ids])
            wanted = np.cumsum([len(x.encode()) + 1 for x in joined])
            at = np.searchsorted(ends, wanted)
            if len(ends) and at[-1] == len(ends) - 1 and np.array_equal(ends[at], wanted):
                cuts = [0, *(at + 1).tolist()]
                found = {x: ids[cuts[i] : cuts[i + 1]] for i, x in enumerate(joined)}
        rest = [x for x in segments if x not in found]
        if rest:
            found.update(zip(rest, (x.ids for x in self.encode_a([" " + x for x in rest], add_special_tokens=False)), strict=True))
        return [found[x] for x in segments]

    def _entry(self, text: str, a: list[int], b: list[int]) -> tuple | None:
        found = self.transducer.align(a, b)
        if found is None or b"".join(map(self.transducer.bytes[0].__getitem__, a)) != (" " + text).encode():
            return None
        groups, links = found
        return len(a), len(b), len(groups), ";".join(groups), array("q", links).tobytes()

    def block(self, texts: list[str]) -> dict:
        """Of a block of texts: columns with an item a text, its distinct id pairs with their sums, and each text's pairs by place.

        Texts without tokens have zeros and no pairs.
        """
        rows = self.parts(texts)
        names = list(dict.fromkeys(chain.from_iterable(rows)))
        entries = self.entries(names)
        failed = {p for p, e in zip(names, entries, strict=True) if e is None}
        if failed:  # whole texts instead of segments, or nothing
            for i, row in enumerate(rows):
                if not failed.isdisjoint(row):
                    rows[i] = [texts[i]] if len(row) > 1 else []
            names = list(dict.fromkeys(chain.from_iterable(rows)))
            entries = self.entries(names)
            failed = {p for p, e in zip(names, entries, strict=True) if e is None}
            rows = [row if failed.isdisjoint(row) else [] for row in rows]
            entries = [(0, 0, 0, "", b"") if e is None else e for e in entries]
        place = {p: i for i, p in enumerate(names)}
        lengths = np.array([len(row) for row in rows], np.int64)
        of_text = np.repeat(np.arange(len(rows)), lengths)
        segment = np.fromiter(map(place.__getitem__, chain.from_iterable(rows)), np.int64, int(lengths.sum()))
        out = {}
        for i, name in enumerate(("n_a", "n_b", "n_groups")):
            values = np.array([e[i] for e in entries], np.int64)
            out[name] = np.bincount(of_text, values[segment], len(rows)).astype(np.int64) if len(segment) else np.zeros(len(rows), np.int64)
        said = {p: e[3] for p, e in zip(names, entries, strict=True)}
        out["groups_sha256"] = [hashlib.sha256(";".join(map(said.__getitem__, row)).encode()).hexdigest() if row else "" for row in rows]
        return out | self._pairs(entries, of_text, segment, len(rows))

    @staticmethod
    def _pairs(entries: list[tuple], of_text: np.ndarray, segment: np.ndarray, n: int) -> dict:
        sizes = np.array([len(e[4]) // 8 for e in entries], np.int64)
        links = np.frombuffer(b"".join([e[4] for e in entries]), np.int64)
        pairs, at = np.unique(links, return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        both, times = np.unique(of_text * max(1, len(entries)) + segment, return_counts=True)
        text, which = np.divmod(both, max(1, len(entries)))
        each = sizes[which]
        # the places of all links of every (text, segment), one after another
        inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        key = np.repeat(text, each) * max(1, len(pairs)) + at[np.repeat(starts[which], each) + inner]
        times = np.repeat(times, each)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        sums = np.add.reduceat(times, first) if len(first) else np.empty(0, np.int64)
        text, pair = np.divmod(key[first], max(1, len(pairs)))
        return {
            "n_links": np.bincount(text, sums, n).astype(np.int64),
            "pairs": pairs,
            "totals": np.bincount(pair, sums, len(pairs)).astype(np.int64),
            "n_pairs": np.bincount(text, minlength=n).astype(np.int32),
            "pair": pair.astype(np.int32),
            "times": sums.astype(np.int32),
        }

    def parts(self, texts: list[str]) -> list[list[str]]:
        if not self.splits:
            return [[x] if x else [] for x in texts]
        rows = [x.split(" ") if x else [] for x in texts]
        blank = {x for x in set(chain.from_iterable(rows)) if not x or x[0].isspace() or x[-1].isspace()}
        if blank:  # there are spaces beside other blanks, which are no safe boundary
            rows = [row if blank.isdisjoint(row) else cut(texts[i], True) for i, row in enumerate(rows)]
        return rows


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


BLOCKS = "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, pairs array<long>, totals array<long>, n_pairs array<int>, pair array<int>, times array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = 4_000_000) -> DataFrame:
    """A row for each block of texts (BLOCKS)."""
    ship(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", block_bytes):
            gc.disable()  # many small objects, none in a cycle
            found = aligner(a_path, b_path).block(pc.fill_null(batch["text"], "").to_pylist())
            gc.enable()
            columns = {"doc_id": batch["doc_id"].to_pylist()} | found
            kinds = {"groups_sha256": pa.string(), "n_pairs": pa.int32(), "pair": pa.int32(), "times": pa.int32()}
            arrays = [pa.array([number], pa.int64())]
            for name in names[1:]:
                values = pa.array(columns[name], kinds.get(name, pa.int64()))
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            yield pa.RecordBatch.from_arrays(arrays, names)
            number += 1
        released()

    names = [x.split()[0] for x in BLOCKS.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(blocks, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count, highest (is it the highest of its B id) over all blocks."""
    sums = blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return sums.select("pair", "count", (F.col("count") == F.max("count").over(of_b)).alias("highest"))


def alignment(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = 4_000_000) -> DataFrame:
    """RESULT of every row of docs(doc_id, text)."""
    # A row is a block: writers and readers hold a row group at a time, and would else take a hundred rows or a whole file.
    blocks = materialise(aligned_blocks(docs, a_path, b_path, block_bytes), "aligned", **{"parquet.block.row.count.limit": str(GROUP)})
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("i", "pair"))
    answers = asked.join(pair_counts(blocks), "pair").select("asker", "i", "count", "highest")  # as many as the block asked for

    def add(block: pa.Table, answer: pa.Table) -> pa.Table:
        """The result rows of one block."""
        row = {c: block[c].combine_chunks()[0].values for c in (*own, "n_pairs", "pair", "times")}
        n_pairs, pair, times = (row[c].to_numpy() for c in ("n_pairs", "pair", "times"))
        of_text = np.repeat(np.arange(len(n_pairs)), n_pairs)
        count = np.zeros(answer.num_rows, np.int64)
        highest = np.zeros(answer.num_rows, np.int64)
        at = answer["i"].to_numpy()
        count[at], highest[at] = answer["count"].to_numpy(), answer["highest"].to_numpy()
        total, best = np.zeros(len(n_pairs), np.int64), np.zeros(len(n_pairs), np.int64)
        np.add.at(total, of_text, times * count[pair])
        np.add.at(best, of_text, times * highest[pair])
        made = {c: row[c] for c in own} | {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table([made[c] for c in names], names)

    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    names = [x.split()[0] for x in RESULT.split(", ")]
    return blocks.drop("pairs", "totals").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(add, RESULT)
