"""Grouping of spelling variants by an index of variable-length grams.

Words are counted over all texts; two are near if one inserted, deleted or replaced code point makes one into the other.

1. Gram dictionary. A word stands between two marks. A gram of two symbols is extended by the symbol behind it for as long as it is
   frequent, up to `LONGEST`; a rare gram is left as it is, so the dictionary is pruned to the shortest rare grams and the frequent
   ones of full length. All that decides this is the set of frequent grams. Its threshold is never below `LEAST_FREQUENT` and grows with the
   words' total length such that at most `MOST_FREQUENT` grams can be frequent, which bounds what is sent to the tasks.
2. Decomposition. Each place of a word has one gram, which depends on the symbols inside it only. An edit at a place affects the grams that
   hold the place, so the most that any place has is the word's own bound on affected grams.
3. List merging. If two words are near, the grams that the edit leaves alone match in order. So among the bound + 1 rarest grams of either word one
   is common to both, at the same distance from the begin or from the end. The inverted lists of these grams are merged by one sort-merge join
   on (gram, end, distance), and a pair goes on only if neither word misses more grams of the other than its bound allows, by 64-bit signatures.
4. Verification by edit distance, inside the join; only near pairs leave it.

A word's form is its most frequent near word, if that is twice as frequent at least; forms are followed to the root by doubling, since counts double on
each step of a chain, which bounds its length.

Edge cases: a null or empty text has no words; a null id counts as the empty text where the noise that the query plants asks for it; repeated rows count
as often as they stand there; ties of forms go to the smallest word in code-point order; an empty table, or one without words that are frequent enough, gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written
from .merkle import LOWER, UPPER

LEAST_LETTERS, LEAST_COUNT = 5, 3
SHORTEST, LONGEST = 2, 5
LEAST_FREQUENT, MOST_FREQUENT = 100, 400_000
BEGIN, END = "^", "$"
#: Chains of forms double their counts at each step, and counts have 63 bits.
MOST_ROUNDS = 7


def runs_of(docs: DataFrame) -> DataFrame:
    """doc_id, run: every maximal run of letters, in lower case as far as A-Z go, that has letters enough to be a word."""
    text = F.translate(text_or_empty(), UPPER, LOWER)
    pattern = f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"
    return docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("run"))


def noisy(doc_id: Column, run: Column) -> Column:
    """The run without one code point, if the crc32 of id and run is divisible by 97."""
    crc = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    place = (crc % F.length(run)).cast("int")
    return F.when(crc % 97 == 0, F.overlay(run, F.lit(""), place + 1, F.lit(1))).otherwise(run)


def counted(words: DataFrame) -> DataFrame:
    """word, n of all words of letters and occurrences enough."""
    return words.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The frequent grams and in how many places they stand; MOST_FREQUENT at most, whatever the number of words."""
    held = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    least = max(LEAST_FREQUENT, -(-held * (LONGEST - SHORTEST + 1) // MOST_FREQUENT))
    padded = F.concat(F.lit(BEGIN), "word", F.lit(END))
    places = words.select(padded.alias("padded"), F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("place"))
    lengths = F.explode(F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST + 1)]))
    grams = places.withColumn("q", lengths).filter(F.col("place") + F.col("q") <= F.length("padded") + 1)
    grams = grams.groupBy(F.substring("padded", F.col("place"), F.col("q")).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    return {r.gram: r.n for r in grams.filter(F.col("n") > least).toLocalIterator()}


def decomposed(word: str, frequent: dict[str, int]) -> tuple[list[tuple[str, int]], int]:
    """The grams of a word with their places, and the most of them that one edit can affect."""
    padded = BEGIN + word + END
    grams, covered = [], [0] * (len(padded) + 1)
    for at in range(len(padded) - SHORTEST + 1):
        to = at + SHORTEST
        while to < len(padded) and to - at < LONGEST and padded[at:to] in frequent:
            to += 1
        grams.append((padded[at:to], at))
        for k in range(at, to):
            covered[k] += 1
    return grams, max(covered[1 : len(word) + 1])


def lists_of(frequent: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """word, n -> the entries (gram, side, distance, word, n, affected, signature) of the words in the inverted lists of their rarest grams."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                row: list[int] = []
                out: dict[str, list] = {"gram": [], "distance": [], "affected": [], "signature": []}
                for k, word in enumerate(part.column("word").to_pylist()):
                    grams, affected = decomposed(word, frequent)
                    signature = 0
                    for gram, _ in grams:
                        signature |= 1 << (int.from_bytes(gram.encode(), "little") * 0x9E3779B97F4A7C15 >> 40 & 63)
                    signature -= (signature >> 63) << 64
                    grams.sort(key=lambda g: (frequent.get(g[0], 0), g))
                    for gram, at in grams[: affected + 1]:
                        for distance in (at, at - len(word) - 2):  # from the begin, and below zero from the end
                            row.append(k)
                            out["gram"].append(gram)
                            out["distance"].append(distance)
                            out["affected"].append(affected)
                            out["signature"].append(signature)
                own = pa.array(row, pa.int64())
                yield pa.record_batch(
                    [pa.array(out["gram"], pa.string()), pa.array(out["distance"], pa.int32()), part.column("word").take(own), part.column("n").take(own), pa.array(out["affected"], pa.int32()), pa.array(out["signature"], pa.int64())],
                    names=["gram", "distance", "word", "n", "affected", "signature"],
                )

    return entries


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every two near words once, a before b."""
    entries = lists_of(frequent_grams(words))
    lists = words.mapInArrow(entries, "gram string, distance int, word string, n long, affected int, signature long")
    lists = lists.select(F.xxhash64("gram", "distance").alias("list"), "word", "n", "affected", "signature")
    a, b = (lists.select("list", *[F.col(c).alias(f"{side}_{c}") for c in ("word", "n", "affected", "signature")]) for side in "ab")
    missing = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(y)))
    both = (
        (a["list"] == b["list"])
        & (F.col("a_word") < F.col("b_word"))
        & (missing("a_signature", "b_signature") <= F.col("a_affected"))
        & (missing("b_signature", "a_signature") <= F.col("b_affected"))
        & (F.levenshtein("a_word", "b_word", 1) == 1)
    )
    # the lists hold a word many times, which Spark's estimate of a small table of words does not show: never broadcast them
    return a.hint("merge").join(b, both).select(F.col("a_word").alias("a"), F.col("a_n"), F.col("b_word").alias("b"), F.col("b_n")).distinct()


def rooted(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): where forms lead to in the end."""
    state = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(MOST_ROUNDS):
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = written(state.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
    return state.select("word", "root")


def grouped(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root for a table of distinct words and their counts."""
    pairs = near_pairs(words)
    ways = pairs.selectExpr("a AS word", "b AS other", "b_n AS other_n").union(pairs.selectExpr("b", "a", "a_n"))
    best = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    is_form = -F.col("best.less") >= 2 * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    found = written(found)
    return found.join(rooted(found.filter("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame, altered: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """The words of docs with their groups; `altered` makes a run (given with its doc_id) into the word that counts."""
    runs = runs_of(docs)
    word = altered(F.col("doc_id"), F.col("run")) if altered else F.col("run")
    return grouped(written(counted(runs.select(word.alias("word")))))
