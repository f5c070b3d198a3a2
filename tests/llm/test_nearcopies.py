"""The pipeline's near-copy stage against brute force over all pairs, and odd ids."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

import corpus_pipeline
from variantloom.llm import nearcopies

SCHEMA = "doc_id long, text string"


def brute(texts: list[str]) -> set[int]:
    """The smallest index of each class of similarity 0.8 at least."""
    sets = []
    for t in texts:
        words = t.lower().split()
        sets.append({" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {root(x) for x in range(len(texts))}


def near_copies(seed: int) -> list[str]:
    """Texts with copies of every similarity from 0.6 to 1, hubs among them."""
    rng, out = random.Random(seed), []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 200))]
        out.append(" ".join(words))
        for _ in range(8):
            own = list(words)
            for _ in range(rng.randrange(0, 1 + len(own) // 20)):
                own[rng.randrange(len(own))] = "edited"
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


def test_near_copies_are_found_and_others_stay(spark):
    texts = near_copies(5)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.no_near_copies(spark, docs, "").collect()} == brute(texts)


@pytest.mark.parametrize("most_chunks", [0, 3, 99])
def test_small_chunks_meet(spark, most_chunks):
    """All clusters key by key, some of them, and none."""
    texts = near_copies(6)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    classes = nearcopies.classes(docs, chunk=2, most_chunks=most_chunks).collect()
    least: dict = {}
    for r in classes:
        least[r.component] = min(least.get(r.component, r.doc_id), r.doc_id)
    assert set(least.values()) == brute(texts)


def test_stage_keeps_null_and_repeated_ids(spark):
    texts = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcd"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (1, texts[1])]
    got = corpus_pipeline.no_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, texts[0]), (7, texts[2]), (7, texts[3]), (1, texts[1])])


def test_groups_across_batches():
    rng = random.Random(9)
    rows = sorted((rng.randrange(30), k, rng.randrange(8, 14)) for k in range(200))
    rows += [(99, k, 10) for k in range(300, 350)]
    sizes = {node: n for _, node, n in rows}
    sets = {node: sorted(rng.sample(range(n + 2), n)) for node, n in sizes.items()}
    groups: dict = {}
    for key, node, _ in rows:
        groups.setdefault(key, []).append(node)

    def classes(pairs) -> list:
        parent = {("c", x): ("c", x) for x in range(3)} | {x: ("c", x % 3) for x in sizes}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in pairs:
            parent[root(x)] = root(y)
        return [root(x) == root(y) for x in sizes for y in sizes]

    for width in (1, 2, 7, 1000):
        batches = [pa.RecordBatch.from_pylist([dict(zip(("key", "node", "n"), r, strict=True)) | {"band": 0} for r in rows[k : k + width]]) for k in range(0, len(rows), width)]
        got = [tuple(r.values()) for b in nearcopies.met(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted((key, 0, x, sizes[x], own[0], sizes[own[0]]) for key, own in groups.items() if len(own) > 1 for x in own)
        wide = lambda x: {"shingles": sets[x], "keys": [x] * nearcopies.BANDS, "sketch": b"a" * (nearcopies.BANDS * nearcopies.ROWS)}
        full = [pa.RecordBatch.from_pylist([{"key": k, "i": 0, "j": 0, "band": 0, "own": 0, "node": x, "n": n, "component": x % 3, **wide(x)} for k, x, n in rows[a : a + width]]) for a in range(0, len(rows), width)]
        pairs = {(r["a"], r["b"]) for b in nearcopies.crossed(iter(full)) for r in b.to_pylist()}
        alike = lambda x, y: 5 * len({*sets[x]} & {*sets[y]}) >= 4 * len({*sets[x]} | {*sets[y]})
        true = {(x, y) for own in groups.values() for x in own for y in own if x < y and x % 3 != y % 3 and alike(x, y)}
        assert pairs <= true and classes(pairs) == classes(true)


def test_large_groups_compare_few_pairs(spark, monkeypatch):
    """A loose group of many texts compares a bounded number of pairs for each text through joins, and loses no link."""
    rng, texts = random.Random(11), []
    base = [f"w{k}" for k in range(150)]
    for _ in range(150):
        own = list(base)
        for k in rng.sample(range(len(own)), 5):
            own[k] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    pairs, verified = [], nearcopies.verified

    def counted(found, sets):
        pairs.append(found.distinct().count())
        return verified(found, sets)

    monkeypatch.setattr(nearcopies, "verified", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.no_near_copies(spark, docs, "").collect()} == brute(texts)
    assert max(pairs) <= 4 * len(texts)
