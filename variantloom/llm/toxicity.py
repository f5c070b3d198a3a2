"""Toxicity: a linear-chain conditional random field tags toxic tokens; marginals make document scores and spans.

Labels mark documents, so tokens are labelled first: a token feature (the word, or its first 3 to 6 letters) is toxic
when so many labelled toxic documents of the sample hold it, and so few others, that chance is ruled out for the
whole vocabulary (Bonferroni). Words of toxic documents with such a feature are tagged 1, words of other documents 0.
The chain runs over whole sentences, however long; chains of like length share a block. Its emissions are sums of
hashed feature weights, its transitions are learned, and forward-backward gives each token's marginal. A document's
score is a small logistic function of its largest marginal and of the sum of its marginals, so that one clear word
counts and many weak ones do not add up by length.

The model is fitted on a bounded sample of labelled rows: at most `most` documents and `most_bytes` of text by a hash of
their ids. Of these, all toxic rows and `most_clean` others, with all their sentences, teach the chain; all rows teach the words and the logistic
function. These three bounds on rows are parameters of `fitted`, and they bound what goes to the driver. All documents are scored, whole.

Edge cases: null or empty text has no token and gets the score of marginal 0; null labels are ignored; without both
kinds of labels every score is the base rate; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import id_crc, text_blocks, texts_of
from .quality import sample_ids

PARTS = re.compile(r"\w+|[.!?\n]+")
FEATURES = 1 << 16
PREFIXES = (3, 4, 5, 6)


def keys_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*{k}" for k in PREFIXES if len(word) > k)]


def hashed(word: str) -> list[int]:
    return [xxhash.xxh32_intdigest(x) % FEATURES for x in (*keys_of(word), "*" + word[-3:])]


def chains(text: str) -> tuple[list[str], list[int]]:
    """The words of a text, and the length of each of its chains."""
    words, sizes, run = [], [], 0
    for part in PARTS.findall(text.lower()):
        if part[0] in ".!?\n":
            if run:
                sizes.append(run)
            run = 0
            continue
        words.append(part)
        run += 1
    if run:
        sizes.append(run)
    return words, sizes


def like_sized(sizes: np.ndarray, cells: int = 1_000_000) -> Iterator[np.ndarray]:
    """Indices of chains in groups of like length (a factor of two at most), each of about `cells` cells or one chain."""
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    level = np.ceil(np.log2(np.maximum(8, sizes[order])))
    for some in np.split(order, np.flatnonzero(level[1:] != level[:-1]) + 1):
        if len(some):
            yield from np.array_split(some, max(1, min(len(some), int(len(some) * sizes[some[-1]] // cells))))


def tokens_of(starts: np.ndarray, sizes: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Where the tokens of some chains lie in the flat row of all tokens."""
    own = sizes[some]
    return np.repeat(starts[some] - np.concatenate([[0], np.cumsum(own)[:-1]]), own) + np.arange(own.sum())


def padded(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chains as rows, and which cells are tokens."""
    live = np.arange(int(sizes.max(initial=0))) < sizes[:, None]
    out = np.zeros(live.shape)
    out[live] = flat
    return out, live


def marginals(emit: np.ndarray, live: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over rows: P(tag 1) of each token, and forward and backward odds of tag 1 against tag 0.

    step[a, b] is the factor from tag a to tag b; step[2] is the start. Emissions favour tag 1.
    """
    push = np.exp(np.clip(emit, -30, 30))
    n, width = emit.shape
    ahead, back = np.zeros((width, n)), np.ones((width, n))
    push_t, live_t = push.T, live.T
    for t in range(width):
        came = (step[0, 1] + ahead[t - 1] * step[1, 1]) / (step[0, 0] + ahead[t - 1] * step[1, 0]) if t else step[2, 1] / step[2, 0]
        ahead[t] = push_t[t] * came
    for t in range(width - 2, -1, -1):
        next_odds = push_t[t + 1] * back[t + 1]
        value = (step[1, 0] + step[1, 1] * next_odds) / (step[0, 0] + step[0, 1] * next_odds)
        back[t] = np.where(live_t[t + 1], value, 1.0)
    odds = ahead * back
    return (np.where(live_t, odds / (1 + odds), 0.0)).T, ahead.T, back.T


class Tagger:
    """Weights of the chain, and the logistic function from marginals to a document's score."""

    def __init__(self, docs: list[tuple[str, int]], epochs: int = 80, most_clean: int = 600):
        self.weights = np.full(FEATURES, 0.0)
        self.bias, self.step = -4.0, np.ones((3, 2))
        self.finish = np.array([0.0, 0.0, 0.0])
        self.cache: dict[str, float] = {}
        good = [t for t, y in docs if not y]
        bad = [t for t, y in docs if y]
        mean = (len(bad) + 0.5) / (len(docs) + 1)
        self.finish[0] = np.log(mean / (1 - mean))
        if not good or not bad:
            return
        self.seeds = self.marked(good, bad, mean)
        self.train(self.examples(bad, True), self.examples(good[:most_clean], False), epochs)
        self.cache.clear()
        x, y = self.shape([t for t, _ in docs]), np.array([y for _, y in docs], dtype=float)
        self.finish = np.zeros(3)
        for _ in range(25):  # Newton steps of a ridge logistic regression
            p = 1 / (1 + np.exp(-(x @ self.finish)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
            self.finish += np.linalg.solve(hess, x.T @ (y - p) - 0.05 * self.finish)

    @staticmethod
    def marked(good: list[str], bad: list[str], mean: float) -> set[str]:
        held, clean = Counter(), Counter()
        for text in bad:
            held.update({k for w in set(chains(text)[0]) for k in keys_of(w)})
        need = np.log(max(2, len(held)) / 0.05)
        held = Counter({k: n for k, n in held.items() if n >= 3})
        for text in good:
            clean.update({k for w in set(chains(text)[0]) for k in keys_of(w) if k in held})
        out = set()
        for k, n in held.items():
            share, total = n / (n + clean[k]), n + clean[k]
            if share > 0.8:  # Chernoff bound on so many toxic documents by chance
                gap = share * np.log(share / mean) + ((1 - share) * np.log((1 - share) / (1 - mean)) if share < 1 else 0)
                if total * gap > need:
                    out.add(k)
        return out

    def examples(self, texts: list[str], toxic: bool) -> list[tuple[list[str], list[int]]]:
        """All chains of the texts, labelled. A toxic document without a marked token teaches nothing about tokens."""
        out = []
        for text in texts:
            words, sizes = chains(text)
            tags = [int(toxic and any(k in self.seeds for k in keys_of(w))) for w in words]
            if toxic and not any(tags):
                continue
            at = 0
            for n in sizes:
                out.append((words[at : at + n], tags[at : at + n]))
                at += n
        return out

    def train(self, bad: list, good: list, epochs: int) -> None:
        """Maximum likelihood by Adam; the gradient of a chain is tags minus marginals, for emissions and transitions."""
        rows = bad + good
        if not rows or not any(any(t) for _, t in rows):
            return
        sizes = np.array([len(w) for w, _ in rows])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        groups = [(g, tokens_of(starts, sizes, g)) for g in like_sized(sizes)]
        known: dict[str, list[int]] = {}
        for ws, _ in rows:
            for w in ws:
                if w not in known:
                    known[w] = hashed(w)
        lists = [known[w] for ws, _ in rows for w in ws]
        fan = np.array([len(x) for x in lists])
        features, owner = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(fan.sum())), np.repeat(np.arange(len(lists)), fan)
        tags = np.concatenate([t for _, t in rows]).astype(float)
        inner = np.ones(len(tags), dtype=bool)  # tokens that have another before them in their chain
        inner[starts[:-1][sizes > 0]] = False
        seen = np.zeros((3, 2))
        for a in (0, 1):
            for b in (0, 1):
                seen[a, b] = ((tags[:-1] == a) & (tags[1:] == b) & inner[1:]).sum()
            seen[2, a] = (tags[~inner] == a).sum()
        self.step = (seen + 1) / (seen + 1).sum(axis=1, keepdims=True)
        logs = np.log(self.step)
        memory = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((3, 2)), np.zeros((3, 2))]
        for k in range(1, epochs + 1):
            emit = np.bincount(owner, self.weights[features], len(lists)) + self.bias
            step = np.exp(logs)
            miss, joint = np.zeros(len(tags)), np.zeros((3, 2))
            for group, at in groups:
                cells, live = padded(emit[at], sizes[group])
                p, ahead, back = marginals(cells, live, step)
                miss[at] = tags[at] - p[live]
                joint[2] += [(1 - p[:, 0]).sum(), p[:, 0].sum()]
                if cells.shape[1] > 1:
                    push = np.exp(np.clip(cells, -30, 30))
                    from_ = np.stack([np.ones_like(ahead[:, :-1]), ahead[:, :-1]])
                    into = np.stack([np.ones_like(back[:, 1:]), push[:, 1:] * back[:, 1:]])
                    cross = from_[:, None] * step[:2, :, None, None] * into[None]
                    joint[:2] += (cross / cross.sum(axis=(0, 1)) * live[:, 1:]).sum(axis=(2, 3))
            g = np.bincount(features, np.repeat(miss, fan), FEATURES) - 0.02 * self.weights
            gs = (seen - joint) / len(rows) - 0.001 * logs
            for value, grad, m, v, rate in ((self.weights, g, memory[0], memory[1], 0.2), (logs, gs, memory[2], memory[3], 0.05)):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad**2
                value += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        self.step = np.exp(logs)

    def emissions(self, words: list[str]) -> list[float]:
        cache, out = self.cache, []
        if len(cache) > 400_000:
            cache.clear()
        for w in words:
            if (x := cache.get(w)) is None:
                x = cache[w] = float(sum(self.weights[k] for k in hashed(w)) + self.bias)
            out.append(x)
        return out

    def tagged(self, texts: list[str]) -> list[np.ndarray]:
        """Marginals of the tokens of each text."""
        flat, sizes, counts = [], [], []
        for text in texts:
            words, own = chains(text)
            flat += self.emissions(words)
            sizes += own
            counts.append(len(words))
        sizes, flat = np.array(sizes, dtype=np.int64), np.array(flat)
        p = np.zeros(len(flat))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for some in like_sized(sizes):
            at = tokens_of(starts, sizes, some)
            cells, live = padded(flat[at], sizes[some])
            p[at] = marginals(cells, live, self.step)[0][live]
        return np.split(p, np.cumsum(counts)[:-1])

    def inputs(self, tags: list[np.ndarray]) -> np.ndarray:
        return np.array([[1.0, p.max(initial=0.0), np.log1p(p[p > 0.05].sum())] for p in tags]).reshape(-1, 3)

    def shape(self, texts: list[str]) -> np.ndarray:
        return np.concatenate([self.inputs(self.tagged(texts[k : k + 500])) for k in range(0, len(texts), 500)])

    def scores(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        tags = self.tagged(texts)
        return 1 / (1 + np.exp(-(self.inputs(tags) @ self.finish))), tags


def spans_of(text: str, p: np.ndarray, cut: float) -> list[str]:
    """start:end (code points, end exclusive) of runs of tokens with marginals of at least cut."""
    if not (p >= cut).any():
        return []
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer: tokens keep their places only if cased one by one
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    tokens = [m for m in PARTS.finditer(low) if m[0][0] not in ".!?\n"]
    out: list[list[int]] = []
    for k, m in enumerate(tokens[: len(p)]):
        if p[k] >= cut:
            if out and out[-1][2] == k - 1:
                out[-1][1:] = [m.end(), k]
            else:
                out.append([m.start(), m.end(), k])
    return [f"{a}:{b}" for a, b, _ in out]


def fitted(docs: DataFrame, labels: DataFrame, most: int = 5_000, most_bytes: int = 64_000_000, most_clean: int = 600) -> Tagger:
    """The tagger of labels.toxic, from labelled training rows within the bounds of the module's text.

    Rows of more than an eighth of most_bytes are drawn last, and those of more than most_bytes never, so one long row does not keep the others out.
    """
    ids = sample_ids(labels, "toxic", most)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    # at most `most` rows are left here, or a few copies of each, so one ordered window holds their sizes
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("size")).groupBy("doc_id").agg(F.sum("size").alias("size"))
    order = Window.orderBy(F.col("size") * 8 > most_bytes, F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = sizes.filter(F.col("size") <= most_bytes).withColumn("upto", F.sum("size").over(order)).filter(F.col("upto") <= most_bytes).select("doc_id")
    got = rows.join(F.broadcast(fits), "doc_id").select(F.xxhash64("doc_id", "text").alias("k"), "text", "y").toArrow()
    drawn = sorted(zip(got.column("k").to_pylist(), got.column("text").to_pylist(), got.column("y").to_pylist(), strict=True))  # a fixed order that does not follow the texts
    return Tagger([(t, y) for _, t, y in drawn], most_clean=most_clean)


def tag_documents(docs: DataFrame, model: Tagger, cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, toxic_spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            texts = texts_of(batch)
            score, tags = shared.value.scores(texts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "score": pa.array(score, pa.float64()),
                "predicted": pa.array(score >= 0.5, pa.bool_()).cast(pa.int32()),
                "toxic_spans": pa.array([",".join(spans_of(t, p, cut)) for t, p in zip(texts, tags, strict=True)], pa.string()),
            })

    marked = docs.select("doc_id", "text", (id_crc() % 5 == 0).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, toxic_spans string")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return tag_documents(docs, fitted(docs, labels))
