"""Candidates of decontamination are kept by the words around them, all at once, as by plain counting."""

from __future__ import annotations

import numpy as np

from variantloom.llm import decontaminate


def test_enough_words():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(words, n))) for k, n in enumerate((5, 9, 20, 63))]
    tables = decontaminate.Tables(items)
    texts = [rng.choice(np.unique(np.concatenate([x for _, x in tables.items])), n) for n in (0, 3, 40, 200)]
    sizes = np.array([len(t) for t in texts])
    lefts = np.concatenate([[0], np.cumsum(sizes + 25)[:-1]])
    symbols = np.concatenate([np.concatenate([t, np.zeros(25, t.dtype)]) for t in texts]).astype(np.uint32)
    rows = np.stack([rng.integers(0, 4, 800), rng.integers(-30, 220, 800), rng.integers(0, 4, 800)], axis=1)
    want = []
    for t, at, i in rows.tolist():
        item = tables.items[i][1]
        most = int(decontaminate.EDITS * len(item))
        around = set(texts[t][max(0, at - most) : max(0, at - most, at + len(item) + most)].tolist())
        want.append(sum(int(w) in around for w in item) >= len(item) - most)
    assert decontaminate.enough_words(tables, symbols, lefts, sizes, rows).tolist() == want
    assert 0 < sum(want) < len(want)
    assert not len(decontaminate.enough_words(tables, symbols, lefts, sizes, rows[:0]))
