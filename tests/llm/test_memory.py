"""Workers give their memory back at the end of a partition."""

from __future__ import annotations

import pyarrow as pa

from variantloom.llm import common


def test_blocks_give_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "given_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "defgh", ""]})
    blocks = list(common.text_blocks(iter([batch, batch]), 4))
    assert sum(b.num_rows for b in blocks) == 8 and calls == [1]


def test_giving_back_keeps_what_is_held():
    held = pa.array(range(100_000))
    common.given_back()
    assert held[99_999].as_py() == 99_999
