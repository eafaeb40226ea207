"""What the functions that run in Python workers hold of an Arrow batch at a time."""

from __future__ import annotations

import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest

from tidemark.llm import neardup, packing, weak_labels

COUNT = 6000


def batch():
    ids = pa.array(range(COUNT))
    texts = pa.array([" ".join(f"some words{i % 40} of text{i * k % 97}" for k in range(120)) for i in range(COUNT)])
    return pa.RecordBatch.from_arrays([ids, ids, ids, texts], names=["doc_id", "node", "text_key", "text"])


@pytest.mark.parametrize("name", ["vote", "signatures", "sets", "cut"])
def test_a_large_batch_is_not_held_as_objects(name, monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "tokens", lambda path: SimpleNamespace(encode=lambda texts: [b"\0" * 400 for _ in texts]))
    work = {
        "vote": getattr(weak_labels, "vote", None), "signatures": neardup._signatures(5, 32, 4), "sets": neardup._sets(5),
        "cut": packing._cut("", 4096, 2, False),
    }[name]
    every = batch()
    list(work(iter([every.slice(0, 500)])))  # tables that are made once
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in work(iter([every])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == COUNT and peak < every.column(3).nbytes


def test_parts_are_the_rows_in_order():
    from tidemark.llm.common import text_parts

    texts = ["", None, "a" * 30, "é" * 8, "", "b" * 5, None, "c" * 9, "d", ""]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(text_parts([whole, whole.slice(0, 0), whole.slice(2, 3)], 16))
    assert pa.Table.from_batches(parts).to_pylist() == whole.to_pylist() + whole.slice(2, 3).to_pylist()
    assert len(parts) > 4 and all(p.num_rows for p in parts)
    for p in parts:
        sizes = [len((t or "").encode()) for t in p.column(1).to_pylist()]
        assert sum(sizes) - max(sizes) < 16
    assert list(text_parts([whole.slice(0, 0)])) == []
