"""The letters of many units at once are those of each unit by itself, and a merge offers its new candidates at once."""

from __future__ import annotations

import random

import numpy as np

from variantloom.llm import pieces


def test_letters_of_many_units():
    p, rng = pieces.loaded(pieces.MODEL), random.Random(5)
    letters = ["a", "é", " ", pieces.MARK, "日", "🎉", "\n", "\t", "\x00", "\ud800", "\U0010ffff", "ß", "Z"]
    units = ["".join(rng.choices(letters, k=rng.randrange(1, 50))) for _ in range(300)]
    flat, sizes = p.symbols_of(units)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == [p.symbols(u) for u in units]
    assert [len(x) for x in p.symbols_of([])] == [0, 0]


def test_each_merge_offers_once(monkeypatch):
    """The table of pairs is asked once for each step of the agendas of a class of units, besides the first time."""
    p, asked = pieces.loaded(pieces.MODEL), []
    merged = pieces.Pieces.merged
    monkeypatch.setattr(pieces.Pieces, "merged", lambda self, left, right: (asked.append(len(left)), merged(self, left, right))[1])
    units = [p.symbols(u) for u in (" the", " stone", " water", " of")]
    flat, counts = pieces.agenda_many(p, *pieces.side_by_side(units), np.zeros(4, dtype=np.uint64), 0.0)
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [pieces.agenda_one(p, u, 0, 0.0) for u in units]
    assert len(asked) <= 1 + max(len(u) - n for u, n in zip(units, counts.tolist(), strict=True))
