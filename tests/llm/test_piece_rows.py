"""The pipeline's pieces: made and decoded in one worker, equal to `encode`, and an error if a text is lost."""

from __future__ import annotations

import contextlib
import io

import pytest

from variantloom.llm import pieces


def test_one_python_node(odd):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        pieces.encoded_documents(odd).explain()
    assert out.getvalue().count("MapInArrow") == 1


def test_rows_are_those_of_encode(odd, empty):
    rows = pieces.encoded_documents(odd)
    assert rows.columns == ["doc_id", "lang", "source", "pieces", "n_pieces"] and dict(rows.dtypes)["n_pieces"] == "bigint"
    told = lambda r, n: (str(r.doc_id), str(r.lang), r.source, str(r.pieces), n)
    expected = [told(r, len(r.pieces or ())) for r in pieces.encode(odd).collect()]
    assert sorted(told(r, r.n_pieces) for r in rows.collect()) == sorted(expected)
    assert pieces.encoded_documents(empty).collect() == []


def test_lost_text_is_an_error():
    p, texts = pieces.Pieces(), ["the stone", None, "", "▁ 日"]
    ids = pieces.encoded(p, texts, 1, 0.1)
    assert pieces.lossless(p, texts, ids) is ids
    p.bytes = [b"?"] * len(p.bytes)
    with pytest.raises(ValueError, match="do not decode"):
        pieces.lossless(p, texts, ids)
