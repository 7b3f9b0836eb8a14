"""Operator 10, byte-level BPE: corpus-level merge replay over the distinct pieces of a block of texts.

All distinct pieces (matches of the pattern) of a block lie one after another in one array of tokens. An
inverted index leads from a pair, named by the rank that joins it, to the positions where it starts. Ranks
are taken in order; each joins all its positions at once, and only the pairs that touch a joined token are
looked up again. Decoding puts the bytes of the ids one after another.

Nulls and empty texts encode to no ids. Repeated rows are encoded each. Pieces in which a later join could
come before an earlier one (none in well-formed vocabularies) are encoded one pair at a time instead.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from factloom.llm.common import slices
from factloom.llm.segments import SegmentTable, cut, distinct

#: A Latin word and at most one mark: the pattern splits these just there.
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)([.,;:!?]?)").fullmatch
NONE = np.int32(2**31 - 1)


class MergeReplay:
    """Encodes many pieces at a time by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.width = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        joins, odd = {}, set()
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    joins[a * self.width + b] = rank
                    if (len(token[:i]) > 1 and a > rank) or (len(token[i:]) > 1 and b > rank):
                        odd.add(a * self.width + b)
        self.keys = np.array(sorted(joins), np.int64)
        self.to = np.array([joins[k] for k in self.keys.tolist()], np.int32)
        self.odd = np.isin(self.keys, np.array(sorted(odd), np.int64))

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank that joins each pair, or NONE, and whether that pair is out of order."""
        k = a.astype(np.int64) * self.width + b
        i = np.searchsorted(self.keys, k)
        i[i == len(self.keys)] = 0
        hit = self.keys[i] == k
        return np.where(hit, self.to[i], NONE), hit & self.odd[i]

    def one(self, piece: bytes) -> list[int]:
        """The plain way, for one piece: join the leftmost pair of the lowest rank until there is none."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (none of them empty) as little-endian unsigned 32-bit integers."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.r_[0, np.cumsum(sizes)]
        n = int(starts[-1])
        token = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.arange(1, n + 1, dtype=np.int64)
        after[starts[1:] - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[starts[:-1]] = -1
        rank = np.full(n, NONE, np.int32)
        strange: list[np.ndarray] = []
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        seen, turn = np.zeros(n, np.int32), 0

        def look(at: np.ndarray) -> None:
            """Look up the pairs that start at these positions and enter them in the index."""
            rank[at] = NONE
            at = at[after[at] >= 0]
            if not len(at):
                return
            r, odd = self._find(token[at], token[after[at]])
            if odd.any():
                strange.append(at[odd])
            rank[at] = r
            at, r = at[r != NONE], r[r != NONE]
            if not len(at):
                return
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
            for a, b, first in zip(cuts, cuts[1:], r[cuts[:-1]].tolist(), strict=False):
                if first not in index:
                    index[first] = []
                    heappush(heap, first)
                index[first].append(at[a:b])

        look(np.flatnonzero(after >= 0))
        while heap:
            r = heappop(heap)
            at = index.pop(r)
            at = np.sort(np.concatenate(at)) if len(at) > 1 else at[0]
            at = at[(rank[at] == r) & np.r_[True, at[1:] != at[:-1]]]
            if not len(at):
                continue
            if (rank[after[at]] == r).any():  # aaa: from the left, without overlaps
                taken, kept = -1, []
                nexts = after[at].tolist()
                for i, j in zip(at.tolist(), nexts, strict=True):
                    if i != taken:
                        kept.append(i)
                        taken = j
                at = np.array(kept, np.int64)
            gone = after[at]
            token[at] = r
            token[gone] = -1
            rank[gone] = NONE
            follow = after[gone]
            after[at] = follow
            before[follow[follow >= 0]] = at[follow >= 0]
            left = before[at]
            turn += 1
            seen[at] = turn
            look(np.r_[at, left[(left >= 0) & (seen[left] != turn)]])
        live = token >= 0
        ends = np.r_[0, np.cumsum(live)][starts] * 4
        flat = token[live].astype("<u4").tobytes()
        out = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        if strange:
            for i in np.unique(np.searchsorted(starts, np.concatenate(strange), side="right") - 1).tolist():
                out[i] = np.array(self.one(pieces[i]), "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def load(path: str) -> MergeReplay:
    with open(path, "rb") as f:
        return MergeReplay({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


@lru_cache(maxsize=2)
def _tables(path: str, pattern: str):
    import regex

    replay, find = load(path), regex.compile(pattern).findall

    def pieces_of(x: str) -> list[str]:
        m = PLAIN(x)
        return find(x) if m is None else [m[1], m[2]] if m[2] else [m[1]]

    def encode(segments: list[str]) -> list[bytes]:
        cuts = [pieces_of(x) for x in segments]
        pieces = list({p for x in cuts for p in x})
        ids = dict(zip(pieces, replay.encode([p.encode() for p in pieces]), strict=True))
        return [ids[x[0]] if len(x) == 1 else b"".join(map(ids.__getitem__, x)) for x in cuts]

    return replay, SegmentTable(encode, 100_000), SegmentTable(lambda xs: encode([" " + x for x in xs]), 300_000)


def encode_texts(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    _, first, later = _tables(path, pattern)
    heads, tails, odd = distinct(texts)
    heads.discard("")
    first.learn(heads)
    later.learn(tails)
    out = []
    for i, text in enumerate(texts):
        head, *rest = cut(text, i in odd)
        out.append((first.known[head] if head else b"") + b"".join(map(later.known.__getitem__, rest)))
    return out


def decode_ids(ids: bytes, path: str) -> bytes:
    return b"".join(map(load(path).bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, batch_bytes: int = 16_000_000) -> DataFrame:
    """doc_id, n_tokens, ids (binary), decoded (binary) of every row of docs(doc_id, text)."""

    def work(batches):
        for batch in slices(batches, "text", batch_bytes):
            ids = encode_texts(pc.fill_null(batch["text"], "").to_pylist(), path, pattern)
            yield from _rows(batch["doc_id"], ids, lambda i: i, lambda i: decode_ids(i, path), pa.binary())

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_tokens long, ids binary, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str, batch_bytes: int = 16_000_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: the digests are taken where the ids are made."""

    def digest(b: bytes) -> str:
        return hashlib.sha256(b).hexdigest()

    def work(batches):
        for batch in slices(batches, "text", batch_bytes):
            ids = encode_texts(pc.fill_null(batch["text"], "").to_pylist(), path, pattern)
            yield from _rows(batch["doc_id"], ids, digest, lambda i: digest(decode_ids(i, path)), pa.string())

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(doc_id, ids, of_ids, of_text, kind, step: int = 500):
    names = ["doc_id", "n_tokens", "ids", "decoded"] if kind == pa.binary() else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for i in range(0, len(ids), step):
        part = ids[i : i + step]
        yield pa.RecordBatch.from_arrays([doc_id.slice(i, step), pa.array([len(x) // 4 for x in part], pa.int64()), pa.array(map(of_ids, part), kind), pa.array(map(of_text, part), kind)], names)
