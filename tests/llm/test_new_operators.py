"""Spelling variants, passages and manifests: against SQL, plain Python and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from variantloom.llm import fmindex, merkle, passages, queries, variants


def cells(df: pd.DataFrame) -> list[tuple]:
    one = lambda v: "NULL" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", ["op11_variants", "op12_passages", "op13_merkle"])
def test_against_sql(name, spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert cells(queries.QUERIES[name](spark, sf_dir).toPandas()) == cells(con.execute(queries.ORACLES[name]).df())


def brute_words(rows: list[tuple], width: int = 35) -> dict:
    """Kept words of each row, by counting all windows."""
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    held = Counter(tuple(w[k : k + width]) for w in split for k in range(len(w) - width + 1))
    out = {}
    for (i, _), w in zip(rows, split, strict=True):
        gone = {j for k in range(len(w) - width + 1) if held[tuple(w[k : k + width])] > 1 for j in range(k, k + width)}
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest())
    return out


def passage_rows() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "c", "né", "日本", "x" * 30])
    passage = [word() for _ in range(90)]
    rows = []
    for i in range(80):
        cut = rng.randrange(0, 60)
        middle = passage[cut : cut + rng.randrange(20, 60)] if i % 2 else []
        sep = rng.choice([" ", "\n", "\t \r"])
        rows.append((i, sep.join([word() for _ in range(rng.randrange(0, 60))] + middle + [word() for _ in range(rng.randrange(0, 60))])))
    rows += [(200, "same " * 200), (201, "same " * 34), (202, "ab cd " * 60), (203, rows[1][1]), (204, " ".join(passage)), (205, " ".join(passage[:35])), (206, " ".join(passage[:34])), (207, ""), (208, None)]
    return rows


@pytest.mark.parametrize("most,shard", [(4_096, 400_000), (2, 400_000), (4_096, 500), (0, 100)])
def test_passages(spark, most, shard, monkeypatch):
    """Also with shards of few pieces, and with every mark too hot for one shard."""
    monkeypatch.setattr(passages, "MOST_PIECES", most)
    searched = passages.searched

    def small(batches):
        passages.SHARD = shard
        yield from searched(batches)

    monkeypatch.setattr(passages, "searched", small)
    rows = passage_rows()
    got = passages.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_words(rows)


def test_index_counts():
    rng = np.random.default_rng(3)
    string = np.concatenate([np.append(rng.integers(1, 5, n), 0) for n in rng.integers(1, 45, 60)])
    index = fmindex.Index(string)
    text = "".join(map(chr, string + 97))
    for _ in range(200):
        pattern = rng.integers(1, 5, rng.integers(1, 8))
        low, high = np.zeros(1, dtype=np.int64), np.full(1, index.n)
        for s in pattern[::-1]:
            low, high = index.step(np.array([s]), low, high)
        want = len(re.findall(f"(?={''.join(map(chr, pattern + 97))})", text))
        assert max(0, int(high[0] - low[0])) == want


def test_windows_have_one_piece():
    """Every window of a text lies in one chunk, and equal windows have equal marks."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 300))) for _ in range(30)] + ["a " * 80, "", "x " * 35]
    text, mark, first, n = passages.chunks_of(pa.array(texts))
    seen, marks = Counter(), {}
    for t, m, f, k in zip(text, mark, first, n, strict=True):
        for s in range(f, f + k):
            seen[t, s] += 1
            assert marks.setdefault(tuple(texts[t].split()[s : s + 35]), m) == m
    assert seen == Counter({(t, s): 1 for t, x in enumerate(texts) for s in range(len(x.split()) - 34)})


def edits(word: str, rng: random.Random) -> str:
    at, letter = rng.randrange(len(word) + 1), rng.choice("abcé")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def test_near_words_share_a_rare_gram():
    rng = random.Random(7)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 12))) for _ in range(400)]
    held = Counter(p[a : a + q] for w in words for p in [f"^{w}$"] for a in range(len(p)) for q in range(2, 6) if a + q <= len(p))
    for least in (0, 3, 40, 10**9):
        frequent = {g: n for g, n in held.items() if n > least}
        lists = lambda w: {(g, d) for batch in [pa.record_batch([pa.array([w]), pa.array([1])], names=["word", "n"])] for out in variants.lists_of(frequent)([batch]) for g, d in zip(*[out.column(c).to_pylist() for c in ("gram", "distance")])}  # noqa: B023, E731
        for _ in range(150):
            a = rng.choice(words)
            b = edits(a, rng)
            if len(b) >= 5 and a != b:
                assert lists(a) & lists(b)


def brute_variants(rows: list[tuple]) -> dict:
    held: Counter = Counter()
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            held[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in held.items() if len(w) >= 5 and k >= 3}

    def near(a: str, b: str) -> bool:
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by = {w: [o for o in n if near(w, o)] for w in n}
    best = {w: min(by[w], key=lambda o: (-n[o], o)) if by[w] else None for w in n}
    form = {w: o if o and n[o] >= 2 * n[w] else None for w, o in best.items()}

    def root(w: str) -> str:
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(by[w]), n[form[w]] if form[w] else None) for w in n}


def test_variants(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    pool = base * 6 + [edits(w, rng) for w in base * 2] * 2 + [edits(edits(w, rng), rng) for w in base]
    rows = [(i, rng.choice([" ", "-", "9"]).join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(pool, k=rng.randrange(0, 60)))) for i in range(150)]
    # a chain of forms whose counts double, longer than one round of doubling follows
    chain = ["zzzzzzzz"[:k] + "abcdefgh"[k:] for k in range(8)]
    rows += [(1_000, " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k))), (None, "Straße Straße straße"), (5, None), (6, ""), (7, "ab × ÷ çççççç çççççç çççççç")]
    got = variants.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"), variants.noisy).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(rows)


def plain_manifest(rows: list[tuple]) -> dict:
    """root and, for each leaf, its proofs, by plain loops over (doc_id, source, lang, n_chars, text)."""
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees: dict = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h("".join(map(enc, r)))))

    def grow(level: list[str]) -> tuple[str, list[str]]:
        proofs, at = ["" for _ in level], list(range(len(level)))
        while len(level) > 1:
            for k, p in enumerate(at):
                proofs[k] += "".join(d for j, d in enumerate(level[p // 8 * 8 : p // 8 * 8 + 8]) if j != p % 8)
            level, at = [h("".join(level[k : k + 8])) for k in range(0, len(level), 8)], [p // 8 for p in at]
        return level[0], proofs

    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    own = {v: grow([d for *_, d in sorted(trees[v])]) for v in order}
    root, above = grow([own[v][0] for v in order])
    out = Counter((leaf, own[v][0], root, h(p + above[k])) for k, v in enumerate(order) for (*_, leaf), p in zip(sorted(trees[v]), own[v][1], strict=True))
    return out


@pytest.mark.parametrize("spread", [4_096, 5])
def test_manifest(spark, spread, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", spread)
    rows = [(i, f"s{i % 3}", f"l{i % 11}" if i % 5 else "l0", i, f"Text Number {i}") for i in range(700)]
    rows += [(3, None, None, None, None), (None, "s", "l0", 1, "A"), (None, "s", "l0", 1, "B"), (9_999, "s", "é", 5, ""), (9_998, "s", "日本", 5, "Ünï")] + [(50, "s", "l0", 7, "Copy")] * 40
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumn("tree", F.lit("clash")).withColumn("digest", F.lit("clash"))
    got = merkle.tampered(df).collect()
    assert Counter((r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == plain_manifest(rows)
    for r in got:
        text = next((x[4] for x in rows if x[0] == r.doc_id), None) if r.doc_id is not None else None
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None and text != text.translate(str.maketrans(merkle.UPPER, merkle.LOWER))
        assert r.verified == (not hit) == (r.folded_root == r.root)


def test_lone_documents(spark):
    one = spark.createDataFrame([(1, "s", "en", 3, "abc")], "doc_id long, source string, lang string, n_chars long, text string")
    row = merkle.tampered(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_edges(spark, odd, empty):
    for run in (lambda d: variants.spelling_groups(d, variants.noisy), variants.spelling_groups, passages.report, passages.deduplicated, merkle.tampered, merkle.proofs):
        assert run(empty).count() == 0
    n = odd.count()
    for run in (passages.report, passages.deduplicated, merkle.tampered):
        assert run(odd).count() == n
    kept = passages.deduplicated(odd)
    assert kept.columns == odd.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in kept.collect() if r.doc_id in (3, 6, 7)} == {(3, None, 0), (6, "", 0), (7, "12 34 !! ??", 11)}
    assert {r.word: (r.n, r.form) for r in variants.spelling_groups(odd).collect()} == {"quick": (3, None), "brown": (3, None), "jumps": (3, None), "river": (3, None), "today": (3, None)}
