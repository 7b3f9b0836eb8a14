"""Blocks of operator 13 are written and read a few at a time, however many a task has."""

from pathlib import Path

import public_tokenizers
import pyarrow.parquet as pq

from factloom.llm import op13_alignment as op13
from tests.llm.helpers import documents, prose


def test_row_groups_hold_few_blocks(spark, monkeypatch):
    made = []
    write = op13.materialise
    monkeypatch.setattr(op13, "materialise", lambda *a, **k: made.append(write(*a, **k)) or made[-1])
    rows = [(i, prose(i, 40)) for i in range(150)]
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    docs = documents(spark, rows).coalesce(1)
    found = {r["doc_id"]: r for r in op13.alignment(docs, *paths, 500).collect()}
    files = [x for t in made for x in Path(t.scratch_path.removeprefix("file://")).glob("*.parquet")]
    groups = [m.row_group(i).num_rows for m in (pq.ParquetFile(x).metadata for x in files) for i in range(m.num_row_groups)]
    assert sum(groups) > 50 and max(groups) <= op13.GROUP
    whole = {r["doc_id"]: r for r in op13.alignment(docs, *paths).collect()}
    assert len(found) == 150 and found == whole
