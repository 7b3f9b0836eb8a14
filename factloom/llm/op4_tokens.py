"""Operator 4, token counts: lengths only, from batches balanced by bytes, with texts split at safe boundaries.

Texts are gathered into batches of about `batch_bytes`, so long and short ones cost alike; a text is split at
single spaces, where the byte-level pre-tokenizer always splits. Only distinct segments are encoded, in
batches, and of each only the length is kept. Texts that hold a special token's string are encoded whole.

Nulls and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each. Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from factloom.llm.common import slices
from factloom.llm.segments import SegmentTable, cut, distinct


@lru_cache(maxsize=2)
def _counter(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def lengths(texts: list[str]) -> list[int]:
        encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        out: list[int] = []
        for i in range(0, len(texts), 5000):
            out += [len(x) for x in encode(texts[i : i + 5000], add_special_tokens=False)]
        return out

    first = SegmentTable(lengths, 50_000)
    later = SegmentTable(lambda xs: lengths([" " + x for x in xs]))
    return lengths, specials, first, later


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, as tokenizers gives them for the file at `path` without added special tokens."""
    lengths, specials, first, later = _counter(path)
    special = [any(x in text for x in specials) for text in texts]
    plain = ["" if x else text for text, x in zip(texts, special, strict=True)]
    heads, tails, odd = distinct(plain)
    first.learn(heads)
    later.learn(tails)
    known = later.known
    counts = []
    for i, text in enumerate(plain):
        head, *rest = cut(text, i in odd)
        counts.append(lengths([texts[i]])[0] if special[i] else first.known[head] + sum(map(known.__getitem__, rest)))
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = 1024, batch_bytes: int = 4_000_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of docs(doc_id, text)."""

    def count(batches):
        for batch in slices(batches, "text", batch_bytes):
            texts = pc.fill_null(batch["text"], "")
            n = pa.array(count_texts(texts.to_pylist(), path), pa.int64())
            size = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
