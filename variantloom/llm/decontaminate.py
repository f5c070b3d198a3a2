"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts and items are sequences of lower-cased words. The CGK walk reads a sequence with a pointer: at step j it emits
the word under the pointer and moves on if a keyed bit of (j, word) is 1, so sequences at a small edit distance meet
again after an edit and their embeddings differ in few places: edit distance becomes Hamming distance. Walks are
made from every word of every text, and from several offsets of every item, so that an edit near the start of a
passage leaves other offsets intact. A hash table samples some places of the embedding; each walk serves several
tables, and several walks are made, so many that a window whose places agree with the chance `agree` shares some
table with probability `recall` at least. Candidates are verified by the exact word edit distance of the item to the
best part of the text around the window; a distance of up to 20 % of the item's words (similarity 0.8) is a match.

A walk of all words of a long item would be of little use: after an edit the two pointers may stay apart for long, so that far
places of the walk agree by chance only. Items of up to some ten words are embedded whole; of longer ones, windows of that size
from every third word are, and the edit distance is still that of the whole item.

Items with fewer than SHORTEST words would match ordinary prose, so they are matched exactly: a line of the text must have the
same words and no others. A block of items holds about `block_bytes` of text; larger benchmarks are taken block by block, one at
a time, each against all texts.

Edge cases: null and empty texts have no match; items that are null or have no word take no part; repeated rows give repeated results; null ids are reported as such; empty tables
give no rows; other columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from .common import mixed, text_blocks, texts_of, written

WORD = re.compile(r"\w+")
SHORTEST = 5
EDITS = 0.2
LINE = re.compile(r"[^\n]+")
PER_WALK = 6
#: Table keys that a text and an item must share, over all tables and windows.
HITS = 3
#: Steps of the walk, sampled places, the item sizes served (from, below), and how far apart and how near the end its windows begin.
CLASSES = ((5, 3, 5, 15, 1, 3), (20, 4, 15, 1 << 30, 3, 10))


class Ids(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxh32_intdigest(word.encode("utf-8", "surrogatepass")) | 1  # 0 is the end of a text
        return value


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Sampler:
    """The walks and the sampled places of one class of item sizes."""

    def __init__(self, steps: int, places: int, agree: float, recall: float, seed: int):
        need = math.ceil(math.log(1 - recall) / math.log(1 - agree**places))
        self.walks, self.steps = max(2, math.ceil(need / PER_WALK)), steps
        draw = mixed(np.arange(1, 1 + self.walks * steps + 4096, dtype=np.uint64) * np.uint64(2 * seed + 1))
        self.turns = (draw[: self.walks * steps] | np.uint64(1)).astype(np.uint32).reshape(self.walks, steps)
        rng = np.random.default_rng(seed)
        # one place in each stretch of the walk: neighbouring places would often show the same word
        ends = np.linspace(0, steps, places + 1).astype(int)
        self.tables = [[np.array([rng.integers(a, b) for a, b in zip(ends, ends[1:], strict=False)]) for _ in range(PER_WALK)] for _ in range(self.walks)]
        self.mixers = (draw[-4096:] | np.uint64(1)).astype(np.uint32)

    def keys(self, symbols: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """Of each table, the keys of the windows at `starts`. symbols ends in at least `steps` zeros."""
        for walk in range(self.walks):
            at = starts.copy()
            keys = [np.zeros(len(starts), dtype=np.uint32) for _ in self.tables[walk]]
            wanted: dict[int, list[tuple[int, int]]] = {}
            for t, places in enumerate(self.tables[walk]):
                for k, j in enumerate(places.tolist()):
                    wanted.setdefault(j, []).append((t, k))
            for j in range(max(wanted) + 1):
                seen = symbols.take(at)
                for t, k in wanted.get(j, ()):
                    keys[t] ^= (seen + np.uint32(k)) * self.mixers[t * 16 + k]
                    keys[t] *= np.uint32(0x9E3779B1)
                at += (seen * self.turns[walk, j]) >> np.uint32(31)
            yield from (x ^ (x >> np.uint32(15)) for x in keys)


class Tables:
    """LSH tables of a block of items."""

    def __init__(self, items: list[tuple[int, str]], agree: float = 0.7, recall: float = 0.97):
        ids = Ids()
        split = [(k, words) for k, words in ((k, words_of(t or "")) for k, t in items) if words]
        self.items = [(k, np.array([ids[w] for w in words], dtype=np.uint32)) for k, words in split]
        self.short: dict[tuple[str, ...], list[int]] = {}
        for i, (_, words) in enumerate(split):
            if len(words) < SHORTEST:
                self.short.setdefault(tuple(words), []).append(i)
        self.classes = []
        for n, (steps, places, low, high, apart, left) in enumerate(CLASSES):
            own = [(i, o) for i, (_, w) in enumerate(self.items) if low <= len(w) < high for o in sorted({*range(0, len(w) - left + 1, apart), len(w) - left})]
            if not own:
                continue
            sampler = Sampler(steps, places, agree, recall, 11 + n)
            flat = np.concatenate([np.concatenate([self.items[i][1][o:], np.zeros(steps + 1, np.uint32)]) for i, o in own])
            sizes = np.array([len(self.items[i][1]) - o + steps + 1 for i, o in own])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            tables = []
            for keys in sampler.keys(flat, starts):
                order = np.argsort(keys, kind="stable")
                seen = np.zeros(1 << 16, dtype=bool)
                seen[keys >> np.uint32(16)] = True
                tables.append((keys[order], order, seen))
            self.classes.append((sampler, own, tables))

    def candidates(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, window start and where the item would begin, of every window that shares a table key with a window of the item."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for sampler, own, tables in self.classes:
            item, offset = np.array(own, dtype=np.int64).T
            for (keys, order, seen), window in zip(tables, sampler.keys(symbols, starts), strict=True):
                hits = np.flatnonzero(seen[window >> np.uint32(16)])
                low = np.searchsorted(keys, window[hits], side="left")
                n = np.searchsorted(keys, window[hits], side="right") - low
                entry = order[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if n.any() else np.empty(0, dtype=np.int64)
                at = np.repeat(starts[hits], n)
                found.append((item[entry], at, at - offset[entry]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, dtype=np.int64),) * 3


def best_part(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smallest edit distance of the item to any part of the text, with that part's start and end (first of equals)."""
    n = len(text)
    cost, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    base = np.arange(n + 1)
    for k, word in enumerate(item, 1):
        # substitution or deletion first, then insertions as a running minimum; starts travel with the costs
        change = np.concatenate([[1 << 30], cost[:-1] + (text != word)])
        drop = cost + 1
        step, from_ = np.where(change <= drop, change, drop), np.where(change <= drop, np.concatenate([[0], start[:-1]]), start)
        step[0] = k
        packed = (step - base) * (n + 2) + from_
        run = np.minimum.accumulate(packed)
        cost, start = run // (n + 2) + base, run % (n + 2)
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


def enough_words(tables: Tables, symbols: np.ndarray, lefts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which candidates (text, where the item would begin, item) have enough of the item's words around them: each edit spares all words but one."""
    keep = np.zeros(len(rows), dtype=bool)
    order = np.argsort(rows[:, 2], kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(rows[order, 2])) + 1) if len(rows) else ():
        item = tables.items[rows[own[0], 2]][1]
        m, most = len(item), int(EDITS * len(item))
        step = max(1, 2_000_000 // (m * (m + 2 * most)))
        for k in range(0, len(own), step):
            text, begin = rows[own[k : k + step], 0], rows[own[k : k + step], 1]
            at = begin[:, None] + np.arange(-most, m + most)
            inside = (at >= 0) & (at < sizes[text][:, None])
            around = np.where(inside, symbols[np.where(inside, lefts[text][:, None] + at, 0)], np.uint32(0))
            keep[own[k : k + step]] = (item[:, None] == around[:, None, :]).any(axis=2).sum(axis=1) >= m - most
    return keep


def matches_of(tables: Tables, symbols: np.ndarray, found: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(item, first word, words, distance) of the best match of each item in one text, from candidates with enough of its words."""
    best: dict[int, tuple[int, int, int]] = {}
    for i, at in found:
        item = tables.items[i][1]
        m, most = len(item), int(EDITS * len(item))
        if i in best and best[i][0] == 0 and best[i][1] <= at:
            continue
        if 0 <= at and at + m <= len(symbols) and (symbols[at : at + m] == item).all():
            got = (0, at, m)
        else:
            low = max(0, at - most)
            around = symbols[low : max(low, at + m + most)]
            cost, a, b = best_part(item, around)
            got = (cost, low + a, b - a)
        if got[0] <= most and (i not in best or got < best[i]):
            best[i] = got
    return [(i, at, n, cost) for i, (cost, at, n) in sorted(best.items())]


def short_matches(text: str, short: dict[tuple[str, ...], list[int]]) -> list[tuple[int, int, int, int]]:
    """(item, first word, words, 0) of items whose words are those of a whole line; the first such line."""
    most, before, best = max(map(len, short)), 0, {}
    for m in LINE.finditer(text):
        words = words_of(m[0])
        if len(words) <= most:
            for i in short.get(tuple(words), ()):
                best.setdefault(i, (i, before, len(words), 0))
        before += len(words)
    return list(best.values())


def contaminated(texts: list[str], tables: Tables, ids: Ids | None = None) -> list[list[tuple[int, int, int, int]]]:
    """Matches of each text; ids may keep the words of the blocks before."""
    ids, pad = Ids() if ids is None else ids, max([s.steps for s, _, _ in tables.classes], default=0) + 1
    parts = [words_of(t) for t in texts]
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    out: list[list] = [[] for _ in texts]
    if not sizes.sum() or not tables.items:
        return out
    lefts = np.concatenate([[0], np.cumsum(sizes + pad)[:-1]])
    symbols = np.zeros(int((sizes + pad).sum()), dtype=np.uint32)
    flat = np.fromiter(map(ids.__getitem__, chain.from_iterable(parts)), dtype=np.uint32, count=int(sizes.sum()))
    starts = np.repeat(lefts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(flat))
    symbols[starts] = flat
    item, at, begin = tables.candidates(symbols, starts)
    # a passage meets its item in several tables or windows; one key alone is mostly a few common words
    text = np.searchsorted(lefts, at, side="right") - 1
    pair, which, hits = np.unique(text * len(tables.items) + item, return_inverse=True, return_counts=True)
    keep = hits[which] >= HITS
    rows = np.unique(np.stack([text[keep], begin[keep] - lefts[text[keep]], item[keep]], axis=1), axis=0)
    rows = rows[enough_words(tables, symbols, lefts, sizes, rows)].tolist()
    by_text: dict[int, list[tuple[int, int]]] = {}
    for t, b, i in rows:
        by_text.setdefault(t, []).append((i, b))
    for t, own in by_text.items():
        out[t] = matches_of(tables, symbols[lefts[t] : lefts[t] + sizes[t]], own)
    if tables.short:
        out = [sorted([*own, *short_matches(text, tables.short)]) for own, text in zip(out, texts, strict=True)]
    return out


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[Tables]:
    """Tables of one block of items after the other; the one before is given up when the next is asked for."""
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow()
        yield Tables(sorted(zip(own.column("item_id").to_pylist(), own.column("text").to_pylist(), strict=True), key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, first_word, n_words, distance, similarity of the best match of each item in each text."""
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id")))
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]

    def against(tables: Tables) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids = Ids()
            for batch in text_blocks(batches):
                held = shared.value
                rows = [(t, *m) for t, ms in enumerate(contaminated(texts_of(batch), held, ids)) for m in ms]
                item = [held.items[i] for _, i, _, _, _ in rows]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                    "item_id": pa.array([x[0] for x in item], item_type),
                    "first_word": pa.array([r[2] for r in rows], pa.int32()),
                    "n_words": pa.array([r[3] for r in rows], pa.int32()),
                    "distance": pa.array([r[4] for r in rows], pa.int32()),
                    "similarity": pa.array([1 - r[4] / len(x[1]) for r, x in zip(rows, item, strict=True)], pa.float64()),
                })

        return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, item_id {item_kind}, first_word int, n_words int, distance int, similarity double")

    # each block's matches are written before the next block is made
    return reduce(DataFrame.unionByName, (written(against(t)) for t in blocks_of(benchmark, block_bytes)))


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = 2_000_000) -> DataFrame:
    """The documents without any match, with all their columns, whatever their names."""
    names, schema, out = docs.columns, docs.schema, docs
    for tables in blocks_of(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(tables)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids = Ids()
            for batch in text_blocks(batches):
                yield batch.filter(pa.array([not m for m in contaminated(texts_of(batch), shared.value, ids)], pa.bool_())).select(names)

        out = written(out.mapInArrow(run, schema))
    return out
