"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives a few dozen surface measures. Cyclic boosting visits the measures in turn; each visit fits one
shallow tree (best two cuts over quantile bins) to the current residual and adds its small step to that measure's
lookup table. Then the pairs with the largest remaining gain get tables of their own, boosted the same way. A text's
score is a sum of table look-ups, done for a whole batch at once.

The model is fitted on a bounded sample (`most` labelled rows with the smallest hash of their id, a parameter); the
measures are computed by Spark tasks and only they and the label reach the driver. Everything is scored.

Edge cases: null or empty text has all measures 0 and is scored like any other; rows without a label are scored but
not learned; null labels are ignored; repeated labels of one document count once per row; with no labels the score
is 0.5; other columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, text_blocks, texts_of

MEASURES = (
    "log_chars", "log_words", "word_length", "longest_word", "distinct_share", "repeat_next", "upper_share", "digit_share", "mark_share", "odd_share",
    "blank_share", "line_length", "line_repeats", "short_words", "capital_words", "marked_words", "top_share", "bare_words", "letter_entropy", "wide_share",
)
KINDS = np.zeros(256, dtype=np.uint8)
for _c in range(256):
    KINDS[_c] = 1 if 65 <= _c <= 90 else 2 if 97 <= _c <= 122 else 3 if 48 <= _c <= 57 else 4 if _c in b" \t\n\r\x0b\x0c" else 5 if _c in b".,;:!?'\"()-" else 6 if _c < 128 else 7
WORD_END = re.compile(r"[^\w\s](?=\s|$)")


def measured(text: str) -> list[float]:
    """The measures of one text, in the order of MEASURES."""
    if not text:
        return [0.0] * len(MEASURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    kinds = np.bincount(KINDS[raw], minlength=8) / len(raw)
    words = text.split()
    n = max(1, len(words))
    sizes = np.array([len(w) for w in words] or [0])
    own: dict[str, int] = {}
    for w in words:
        own[w] = own.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    letters = np.bincount(raw, minlength=256) / len(raw)
    letters = letters[letters > 0]
    return [
        np.log1p(len(text)), np.log1p(len(words)), sizes.mean(), np.log1p(sizes.max()), len(own) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        kinds[1], kinds[3], kinds[5], kinds[6], kinds[4], np.log1p(len(text) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        (sizes <= 3).mean(), sum(w[0].isupper() for w in words) / n, len(WORD_END.findall(text)) / n, max(own.values(), default=0) / n,
        sum(not any(c.isalpha() for c in w) for w in own) / max(1, len(own)), -(letters * np.log(letters)).sum(), kinds[7],
    ]


def measures(texts: list[str]) -> np.ndarray:
    return np.array([measured(t) for t in texts], dtype=np.float64).reshape(-1, len(MEASURES))


def sample_ids(labels: DataFrame, target: str, most: int) -> DataFrame:
    """doc_id and y of at most `most` labelled training rows: those with the smallest hash of their id."""
    rows = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & (id_crc() % 5 != 0)).select("doc_id", F.col(target).cast("int").alias("y"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)


class Additive:
    """Lookup tables over quantile bins, for single measures and for pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = 24, rounds: int = 120, pair_rounds: int = 40, pairs: int = 6, step: float = 0.15):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.empty(0) for c in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.base = 0.0
        if not len(y):
            return
        mean = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(mean / (1 - mean)))
        at, margin = self.binned(x), np.full(len(y), self.base)
        for _ in range(rounds):
            for k in range(x.shape[1]):
                grow = step * self.tree(at[:, k], len(self.tables[k]), y, margin)
                self.tables[k] += grow
                margin += grow[at[:, k]]
        chosen = sorted(combinations(range(x.shape[1]), 2), key=lambda p: (-self.gain(at, p, y, margin), p))[:pairs]
        found = {p: np.zeros((len(self.tables[p[0]]), len(self.tables[p[1]]))) for p in chosen}
        for _ in range(pair_rounds):
            for (i, j), own in found.items():
                # a cut in one measure, then the best tree of the other on each side
                cut = max(1, len(self.tables[i]) // 2)
                for side in (at[:, i] < cut, at[:, i] >= cut):
                    grow = step * self.tree(at[side, j], len(self.tables[j]), y[side], margin[side])
                    own[np.unique(at[side, i])] += grow
                    margin[side] += grow[at[side, j]]
        self.pairs = [(i, j, own) for (i, j), own in found.items()]

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    @staticmethod
    def sums(at: np.ndarray, size: int, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

    @classmethod
    def tree(cls, at: np.ndarray, size: int, y: np.ndarray, margin: np.ndarray, ridge: float = 3.0) -> np.ndarray:
        """Leaf values over the bins, of the tree with the best first cut and then the best cut of its larger-gain side."""
        g, h = (np.concatenate([[0], np.cumsum(v)]) for v in cls.sums(at, size, y, margin))
        worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)

        def cut(a: int, b: int) -> tuple[float, int]:
            if b - a < 2:
                return 0.0, a
            mids = np.arange(a + 1, b)
            gains = worth(a, mids) + worth(mids, b) - worth(a, b)
            return float(gains.max()), int(mids[gains.argmax()])

        marks = {0, size}
        for _ in range(2):
            ends = sorted(marks)
            gain, mid = max(cut(a, b) for a, b in zip(ends, ends[1:], strict=False))
            if gain > 0:
                marks.add(mid)
        out, ends = np.zeros(size), sorted(marks)
        for a, b in zip(ends, ends[1:], strict=False):
            out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
        return out

    def gain(self, at: np.ndarray, pair: tuple[int, int], y: np.ndarray, margin: np.ndarray) -> float:
        """What a 4 x 4 table of the pair would still explain."""
        a, b = (at[:, k] * 4 // max(1, len(self.tables[k])) for k in pair)
        g, h = self.sums(a * 4 + b, 16, y, margin)
        return float((g**2 / (h + 3.0)).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        at = self.binned(x)
        margin = self.base + sum(t[at[:, k]] for k, t in enumerate(self.tables)) + sum(t[at[:, i], at[:, j]] for i, j, t in self.pairs)
        return 1 / (1 + np.exp(-margin))


def with_measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_blocks(batches):
        x = measures(texts_of(batch))
        yield pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64())), "y": batch.column("y")})


def fitted(docs: DataFrame, labels: DataFrame, most: int = 12_000) -> Additive:
    """The model of labels.quality, from at most `most` labelled training rows."""
    ids = sample_ids(labels, "quality", most)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "y")
    got = rows.mapInArrow(with_measures, "x array<double>, y int").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(MEASURES))
    y = np.asarray(got.column("y"), dtype=np.float64)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows came in
    return Additive(x[order], y[order])


def scored(docs: DataFrame, model: Additive, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; docs has doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            score = shared.value.score(measures(texts_of(batch)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(score, pa.float64()), "predicted": pa.array(score >= cut, pa.bool_()).cast(pa.int32())})

    marked = docs.select("doc_id", "text", (id_crc() % 5 == 0).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fitted(docs, labels))


def kept(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    schema, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            yield batch.filter(pa.array(shared.value.score(measures(texts_of(batch))) >= cut)).select(names)

    return docs.mapInArrow(run, schema)
