"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled training text: each task sums its own (language, bucket) counts and
Spark adds them up. The model is a matrix of languages x `buckets` log-probabilities, broadcast in blocks of at most
BLOCK languages, so a block has a fixed bound and any number of languages is scored: rows pass the blocks one after
the other and carry their best language and the sum of all posteriors along. Scoring gathers the matrix rows of a batch's
n-grams and sums them per document in numpy.

Edge cases: null text and text without a letter give `und` with score 0; null languages are not learned; ties go to
the first language by name; without any learned language all is `und`; repeated rows and other columns are harmless;
very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc, text_blocks, texts_of, written

BUCKETS = 1 << 14
BLOCK = 250
#: n-gram lengths and their odd multipliers.
GRAMS = (1, 2, 3)


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point: itself if a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)


def hashed(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, the index of each text's first one, and whether it has a letter.

    A text becomes blank + letters (others as blanks) + blank; n-grams stay inside a text and those of blanks only are left out.
    """
    codes = letters()[np.frombuffer((" " + "  ".join(t.lower() for t in texts) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    sizes = np.array([len(t.lower()) + 2 for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    found, owners = [], []
    h = np.zeros(len(codes), dtype=np.uint32)
    some = np.zeros(len(codes), dtype=bool)
    for n in range(1, max(GRAMS) + 1):
        last = len(codes) - n + 1
        if last <= 0:
            break
        h = h[:last] * np.uint32(0x01000193) ^ codes[n - 1 :] * np.uint32(0x9E3779B1)
        some = some[:last] | (codes[n - 1 :] != 32)
        keep = some & (owner[:last] == owner[n - 1 :])
        x = h[keep] + np.uint32(n)
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append((x >> np.uint32(18)) % np.uint32(buckets) if buckets <= 1 << 14 else (x >> np.uint32(8)) % np.uint32(buckets))
        owners.append(owner[:last][keep])
    at, who = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    counts = np.bincount(who, minlength=len(texts))
    return at[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts)]), counts > 0


def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in text_blocks(batches):
        texts, langs = texts_of(batch), batch.column("lang").to_pylist()
        at, starts, _ = hashed(texts, BUCKETS)
        names, which = np.unique(langs, return_inverse=True)
        who = np.repeat(which, np.diff(starts))
        own = np.bincount(who * BUCKETS + at, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
        for k, name in enumerate(names):
            sums[str(name)] = sums.get(str(name), 0) + own[k]
            docs[str(name)] = docs.get(str(name), 0) + int((which == k).sum())
    for name, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * (len(at) + 1), pa.string()), "bucket": pa.array(np.append(at, -1), pa.int32()), "n": pa.array(np.append(own[at], docs[name]), pa.int64())})


Model = tuple[list[str], np.ndarray, np.ndarray]


def learned(docs: DataFrame, smoothing: float = 0.5, block: int = BLOCK) -> list[Model]:
    """Blocks of (language names, log priors, buckets x languages matrix) in order of names, from (text, lang) rows with null langs left out."""
    sums = docs.filter(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(counts, "lang string, bucket int, n long")
    rows = written(sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    of = {r.lang: r.n for r in rows.filter("bucket = -1").select("lang", "n").collect()}  # one row for each language
    names, total = sorted(of), float(sum(of.values()) + len(of))
    models = []
    for at in range(0, len(names), block):
        own = names[at : at + block]
        place = {x: k for k, x in enumerate(own)}
        got = rows.filter(F.col("lang").between(own[0], own[-1]) & (F.col("bucket") >= 0)).toArrow()
        grams = np.full((BUCKETS, len(own)), smoothing)
        grams[np.asarray(got.column("bucket")), [place[x] for x in got.column("lang").to_pylist()]] += np.asarray(got.column("n"))
        models.append((own, np.log(np.array([of[x] + 1.0 for x in own]) / total), np.log(grams / grams.sum(axis=0)).astype(np.float32)))
    return models


def passed(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Rows with their best language so far (best, its log posterior before scaling) and `mass`: the sum of all posteriors, as a multiple of the best."""
    langs, priors, matrix = model
    for batch in text_blocks(batches):
        texts = texts_of(batch)
        at, starts, some = hashed(texts, BUCKETS)
        total = np.zeros((len(texts), matrix.shape[1]))
        if len(at):
            full = np.flatnonzero(np.diff(starts))
            for k in range(matrix.shape[1]):
                total[full, k] = np.add.reduceat(matrix[:, k][at], starts[full], dtype=np.float64)
        total += priors
        best = total.argmax(axis=1)
        top = total.max(axis=1)
        mass = np.exp(total - top[:, None]).sum(axis=1)
        old, old_mass = (np.asarray(batch.column(c), dtype=np.float64) for c in ("top", "mass"))
        won = top > old
        high = np.maximum(top, old)
        name = [langs[b] if w else x for b, w, x in zip(best, won, batch.column("best").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in ("doc_id", "held_out", "text")}, "some": pa.array(some), "best": pa.array(name, pa.string()), "top": pa.array(high),
            "mass": pa.array(mass * np.exp(top - high) + old_mass * np.exp(old - high)),
        })


def predicted(docs: DataFrame, models: list[Model]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "held_out", "text", F.lit(False).alias("some"), F.lit(None).cast("string").alias("best"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("mass"))
    for model in models:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        rows = rows.mapInArrow(lambda b, shared=shared: passed(b, shared.value), f"doc_id {kind}, held_out boolean, text string, some boolean, best string, top double, mass double")
    return rows.select("doc_id", "held_out", F.when(F.col("some"), F.col("best")).otherwise("und").alias("lang_pred"), F.when(F.col("some"), 1 / F.col("mass")).otherwise(0.0).alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from rows whose crc32(doc_id as text) mod 4 is not 2, then predict every row."""
    marked = docs.select("doc_id", "text", "lang", (id_crc() % 4 == 2).alias("held_out"))
    return predicted(marked.drop("lang"), learned(marked.filter(~F.col("held_out"))))
