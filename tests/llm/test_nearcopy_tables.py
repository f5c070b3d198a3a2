"""The near-copy stage finds its candidates by fingerprints in pivot distance tables."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from variantloom.llm import nearcopies


def test_fingerprints_are_majorities():
    found = np.random.default_rng(1).integers(0, 1 << 64, 700, dtype=np.uint64)
    hashes = nearcopies.hashed(found)
    for word, own in zip(nearcopies.fingerprints(found).tolist(), hashes.tolist(), strict=True):
        assert word == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_keys_are_distance_differences():
    """Two nodes share a table's key if and only if their distances to its references differ alike from those to its base."""
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 64, nearcopies.WORDS, dtype=np.uint64)
    words = np.stack([one ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (k % 12, nearcopies.WORDS), dtype=np.uint64), axis=0) for k in range(60)])
    keys = nearcopies.table_keys(words, nearcopies.PART)
    far = lambda a, b: (int(a) ^ int(b)).bit_count()
    for t, (base, others) in enumerate(zip(*nearcopies.references(nearcopies.PART), strict=True)):
        shown = [tuple(far(x, r) - far(x, base) for r in others) for x in nearcopies.table_words(words)[:, t]]
        assert len(set(zip(shown, keys[:, t].tolist(), strict=True))) == len(set(shown)) == len(set(keys[:, t].tolist()))


@pytest.mark.parametrize("width", [1, 3, 1000])
@pytest.mark.parametrize("most", [4, 65_536])
def test_groups_of_near_guides(width, most, monkeypatch):
    """Members of a key are parted by chains of near guides, wherever batches end; keys with too many members stay whole."""
    monkeypatch.setattr(nearcopies, "MOST_HELD", most)
    rng, rows, signed = random.Random(3), [], lambda x: x - (x >> 63 << 64)
    for key in range(40):
        hubs = [rng.getrandbits(128) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.choice([1, 2, 3, 9])):
            guide = rng.choice(hubs) ^ (1 << rng.randrange(128))
            rows.append({"key": key, "band": key % 5, "node": len(rows), "n": 7, "guide_a": signed(guide >> 64), "guide_b": signed(guide & (1 << 64) - 1)})
    got: dict = {}
    for b in nearcopies.grouped(iter([pa.RecordBatch.from_pylist(rows[k : k + width]) for k in range(0, len(rows), width)])):
        for r in b.to_pylist():
            got.setdefault(r["key"], []).append(r["node"])
    want = []
    for key in range(40):
        own = [r for r in rows if r["key"] == key]
        label = list(range(len(own)))
        for _ in own:
            for x, a in enumerate(own):
                for y, b in enumerate(own):
                    if sum(((a[c] ^ b[c]) & ((1 << 64) - 1)).bit_count() for c in ("guide_a", "guide_b")) <= nearcopies.NEAR_GUIDE:
                        label[x] = label[y] = min(label[x], label[y])
        chains = [[r["node"] for r, k in zip(own, label, strict=True) if k == x] for x in set(label)]
        want += [g for g in chains if len(g) > 1]
    if most > len(rows):
        assert sorted(got.values()) == sorted(want)
    else:  # keys of over MOST_HELD members may stay whole
        assert all(any(set(g) <= set(o) for o in got.values()) for g in want)


def test_recall_at_the_threshold():
    """Pairs of similarity 0.8 to 0.82 share a table and have near guides."""
    rng, missed = np.random.default_rng(4), 0
    for k in range(300):
        n = (60, 150, 400)[k % 3]
        common, rest = np.split(rng.integers(0, 1 << 64, n + 2 * (n // 9), dtype=np.uint64), [n - n // 9])
        a, b = (nearcopies.fingerprints(np.concatenate([common, x])) for x in np.array_split(rest[: 2 * (n // 9)], 2))
        keys = nearcopies.table_keys(np.stack([a, b])[:, : nearcopies.WORDS], nearcopies.PART)
        missed += not ((keys[0] == keys[1]).any() and nearcopies.near_guides(a[nearcopies.WORDS :], b[nearcopies.WORDS :]))
    assert missed <= 3
