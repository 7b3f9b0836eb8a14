"""Operator 6, packing: best-fit decreasing over a segment tree indexed by remaining capacity.

A document's ids are cut into full windows first; what is left of it, shorter than a window, goes with those
of other documents, longest first, each into the open window with the least room that still takes it. Every
task packs blocks of its own rows (`block` remainders at most, so its memory is bounded), and no row moves
between tasks. A sequence's id holds the task's partition and a running number.

Nulls and empty texts are one piece: the closing id alone. Repeated rows are packed each.
"""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from factloom.llm.common import slices
from factloom.llm.segments import SegmentTable

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class RoomTree:
    """Open windows by their room; finds the one with the least room of at least n."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.full = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        i = room + self.leaves
        while i and not self.full[i]:
            self.full[i] = 1
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, window), which leaves the tree, or None if no window has that much room."""
        i = least + self.leaves
        if not self.full[i]:
            while i > 1 and (i & 1 or not self.full[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.full[2 * i] else 2 * i + 1
        room = i - self.leaves
        window = self.open[room].pop()
        if not self.open[room]:
            self.full[i] = 0
            i >>= 1
            while i and not (self.full[2 * i] or self.full[2 * i + 1]):
                self.full[i] = 0
                i >>= 1
        return room, window


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """The window and the place in it of each length; windows are numbered from 0."""
    tree, made = RoomTree(window), 0
    where, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found, made = (window, made), made + 1
        room, where[i] = found
        offset[i] = window - room
        if room > lengths[i]:
            tree.put(room - lengths[i], where[i])
    return where, offset


#: A lower-case Latin word and at most one mark, which the pre-tokenizer splits just there.
PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u017f]+)([.,;:!?]?)").fullmatch


def _word_coder(tokenizer):
    """Ids of one pre-token by the tokenizer's own vocabulary.

    Ids follow the order of the joins, so the vocabulary serves as ranks of bytes; a word's end is a byte that
    no UTF-8 text holds. Vocabularies that aren't built so are turned down.
    """
    import json

    import tiktoken

    model = json.loads(tokenizer.to_str())["model"]
    suffix, vocab = model["end_of_word_suffix"], model["vocab"]
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in chars} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*chars}))}
    joins = [x if isinstance(x, str) else "".join(x) for x in (m.replace(" ", "") if isinstance(m, str) else m for m in model["merges"])]
    if [vocab[x] for x in joins] != list(range(512, 512 + len(joins))):
        raise ValueError("the ids of this vocabulary don't follow its joins")
    ranks = {}
    for token, i in vocab.items():
        if i < 512 + len(joins):
            bare = token.removesuffix(suffix) if len(token) > len(suffix) else token
            ranks[bytes(byte_of[c] for c in bare) + b"\xff" * (bare != token)] = i
    core = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    def code(piece: str) -> bytes:
        ids = core.encode_single_piece(piece.encode() + b"\xff")
        return struct.pack(f"<{len(ids)}I", *ids)

    return code


@lru_cache(maxsize=2)
def _encoder(path: str, end_id: int):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    word = _word_coder(tokenizer)

    def parts(texts: list[str]) -> list[bytes]:
        """As ids(), for texts without special strings and spaces; plain words skip the pre-tokenizer."""
        lows = [x.lower() for x in texts]
        plain = [PLAIN(x) for x in lows]
        rest = iter(ids([x for x, m in zip(texts, plain, strict=True) if m is None]))
        return [next(rest) if m is None else word(m[1]) + word(m[2]) if m[2] else word(m[1]) for m in plain]

    def ids(texts: list[str]) -> list[bytes]:
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        out: list[bytes] = []
        for i in range(0, len(texts), 5000):
            out += [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in encode(texts[i : i + 5000], add_special_tokens=False)]
        return out

    return ids, specials, SegmentTable(parts), int(end_id).to_bytes(4, "little")


def encode_texts(texts: list[str], path: str, end_id: int):
    """The ids of each text and the closing id, as little-endian bytes. This vocabulary drops white space, so
    texts are cut at every space."""
    ids, specials, table, end = _encoder(path, end_id)
    whole = {i for i, t in enumerate(texts) if any(s in t for s in specials)}
    words: set[str] = set()
    for i, text in enumerate(texts):
        if i not in whole:
            words.update(text.split(" "))
    table.learn(words)
    for i, text in enumerate(texts):
        yield (ids([text])[0] if i in whole else b"".join(map(table.known.__getitem__, text.split(" ")))) + end


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = 2048, block: int = 100_000, batch_bytes: int = 4_000_000) -> DataFrame:
    """Pieces of every row of docs(doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def work(batches):
        base = TaskContext.get().partitionId() << 40
        used = 0
        left: list[list] = []

        def rows(cols: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], COLUMNS)

        def flush():
            nonlocal used, left
            where, offset = best_fit_decreasing([x[2] for x in left], window)
            cols = [list(c) for c in zip(*left, strict=True)]
            yield rows([*cols, [base + used + w for w in where], offset])
            used += max(where) + 1
            left = []

        for batch in slices(batches, "text", batch_bytes):
            texts = pc.fill_null(batch["text"], "").to_pylist()
            full: list[list] = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode_texts(texts, path, end_id), strict=True):
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    piece = [doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n]
                    if length == window:
                        full.append([*piece, base + used, 0])
                        used += 1
                    else:
                        left.append(piece)
            if full:
                yield rows(list(zip(*full, strict=True)))
            if len(left) >= block:
                yield from flush()
        if left:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(work, PIECES)
