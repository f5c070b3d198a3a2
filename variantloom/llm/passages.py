"""Removal of repeated word passages: shards of the corpus in compressed FM-indexes, texts streamed through them.

A window is `WIDTH` consecutive words of one text; it is repeated if its words also start anywhere else. Searching every text in
the index of every shard would be quadratic in shards, so the shards are cut such that all places of a window lie in one of them:

1. Equal texts are one text that counts twice. Each window takes the leftmost smallest of its four-word hashes as its anchor, so
   equal windows lie alike to their anchors. Consecutive windows with one anchor whose distances to it lie in one half form a chunk of
   up to 16 windows; what all possible windows of the chunk share (20 words around the anchor) is hashed into its mark. Chunks whose mark stands at
   one place only hold no repeated window, and one aggregation with a join by mark drops them.
2. The words of the other chunks are the pieces. Every window of the corpus lies in one piece, so counts in pieces are counts of places.
   Equal pieces become one with a weight of two, as do windows below; two is all that counts.
3. A shard is a run of marks with all their pieces, up to `SHARD` words; its words are indexed once for each weight, and the pieces are streamed through
   the index: backward search over the wavelet matrix gives the longest strings that stand there twice, and those of WIDTH words or more
   are reported. A mark with more than `MOST_PIECES` different pieces (a phrase of 20 words in very many surroundings) would not fit in a
   shard: its pieces are cut into single windows, whose marks are the windows themselves, and go the same way.
4. Reported windows go back to the pieces' places and are joined to the texts. Texts are written once, in buckets by their key, so that no join
   shuffles them again.

Marks have 64 bits, and equal ones only make work. Texts and pieces are told apart by 128 bits, words inside a shard by themselves.

Edge cases: a null or empty text has no words; texts of fewer than WIDTH words are never cut; rows that are equal in text are places of their own, so all words of
a copy of WIDTH words or more go; null ids are rows like any other; an empty table gives no rows; other columns are kept by `deduplicated`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.operators.tables import shared_home

from .common import KEYS, mixed, text_blocks, text_keys, text_or_empty, written
from .fmindex import Index, repeated_windows

WIDTH = 35
GRAM, HALF = 4, 16
CORE = WIDTH - HALF + 1
MOST_PIECES, SHARD = 4_096, 400_000
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of BASE and of its inverse, n at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))):
            _powers[k] = np.multiply.accumulate(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, base)]))
    return _powers


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[begin:end] for every pair; it depends on nothing else."""
    up, down = powers(len(values) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return mixed((total[end] - total[begin]) * down[begin])


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of all words of the texts that offsets cut raw bytes into."""
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begin, end = solid.copy(), solid.copy()
    inner = offsets[(offsets > 0) & (offsets < len(raw))]
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def leftmost_smallest(values: np.ndarray, reach: int) -> np.ndarray:
    """For each place, where the leftmost smallest of the next `reach` values (a power of two) stands."""
    at = np.arange(len(values))
    step = 1
    while step < reach:
        left = values[:-step] <= values[step:]
        values, at = np.where(left, values[:-step], values[step:]), np.where(left, at[:-step], at[step:])
        step *= 2
    return at


def chunks_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, mark, first, n: all chunks of the texts; first is the word at which the first of the n windows starts."""
    none = np.empty(0, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    begin, end = word_bounds(raw, offsets)
    if len(begin) < WIDTH:
        return none, none, none, none
    word = span_hashes(raw.astype(np.uint64) + np.uint64(1), begin, end)
    owner = np.searchsorted(offsets, begin, side="right") - 1
    grams = word[: len(word) - GRAM + 1].copy()
    for k in range(1, GRAM):
        grams = mixed(grams) + word[k : len(word) - GRAM + 1 + k]
    anchor = leftmost_smallest(mixed(grams), WIDTH - GRAM + 1)
    start = np.arange(len(anchor))
    half = (anchor - start) // HALF
    whole = owner[: len(anchor)] == owner[WIDTH - 1 :]
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (half[1:] != half[:-1]) | (owner[1 : len(anchor)] != owner[: len(anchor) - 1])
    start, edges = start[whole], np.flatnonzero(new[whole])
    if not len(start):
        return none, none, none, none
    first, n = start[edges], np.diff(np.append(edges, len(start)))
    core = anchor[first] - HALF * half[first]
    mark = mixed(span_hashes(word, core, core + CORE) + half[first].astype(np.uint64))
    return owner[first], mark.view(np.int64), first - np.searchsorted(owner, owner[first]), n


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_blocks(batches, 2_000_000):
        text, mark, first, n = chunks_of(batch.column("text").cast(pa.string()))
        own = pa.array(text)
        kept = [batch.column(k).take(own) for k in (*KEYS, "copies")]
        yield pa.record_batch([*kept, pa.array(mark), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int8))], names=[*KEYS, "copies", "mark", "first", "n"])


def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the chunks that a text's row lists."""
    for batch in text_blocks(batches, 2_000_000):
        out: dict[str, list] = {"row": [], "mark": [], "first": [], "n": [], "piece": []}
        for row, (text, chunks) in enumerate(zip(batch.column("text").to_pylist(), batch.column("chunks").to_pylist(), strict=True)):
            words = text.encode().split()
            for c in chunks:
                for key in ("mark", "first", "n"):
                    out[key].append(c[key])
                out["row"].append(row)
                out["piece"].append(b" ".join(words[c["first"] : c["first"] + c["n"] + WIDTH - 1]).decode())
        own = pa.array(out["row"], pa.int64())
        kept = [batch.column(k).take(own) for k in (*KEYS, "copies")]
        yield pa.record_batch([*kept, pa.array(out["mark"], pa.int64()), pa.array(out["first"], pa.int32()), pa.array(out["n"], pa.int8()), pa.array(out["piece"], pa.string())], names=[*KEYS, "copies", "mark", "first", "n", "piece"])


def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (piece_a, piece_b, weight, piece) cut into their windows, each with its place `bit`."""
    for batch in text_blocks(batches, 200_000, lambda b: b.column("piece")):
        rows, bits, windows = [], [], []
        for row, piece in enumerate(batch.column("piece").to_pylist()):
            words = piece.split(" ")
            for k in range(len(words) - WIDTH + 1):
                rows.append(row)
                bits.append(k)
                windows.append(" ".join(words[k : k + WIDTH]))
        own = pa.array(rows, pa.int64())
        yield pa.record_batch([*[batch.column(k).take(own) for k in ("piece_a", "piece_b", "weight")], pa.array(bits, pa.int32()), pa.array(windows, pa.string())], names=["piece_a", "piece_b", "weight", "bit", "window"])


def settled(pieces: pa.Array, twice: np.ndarray) -> np.ndarray:
    """The masks of repeated windows of one shard's pieces."""
    words = pc.split_pattern(pieces, " ")
    symbols = np.asarray(words.flatten().dictionary_encode().indices).astype(np.int64) + 1
    length = np.asarray(pc.list_value_length(words)).astype(np.int64)
    begin = np.cumsum(length) - length
    column = np.arange(length.max())
    inside = column < length[:, None]
    rows = np.zeros(inside.shape, dtype=np.int64)
    rows[inside] = symbols
    # a string for each piece, once more for those at two places, each with a zero behind it
    both = np.concatenate([np.arange(len(length)), np.flatnonzero(twice)])
    ends = np.cumsum(length[both] + 1)
    string = np.zeros(int(ends[-1]), dtype=np.int64)
    at = np.ones(len(string), dtype=bool)
    at[ends - 1] = False
    string[at] = symbols[np.repeat(begin[both], length[both]) + np.arange(length[both].sum()) - np.repeat(np.cumsum(length[both]) - length[both], length[both])]
    return repeated_windows(Index(string), rows, length - WIDTH + 1, WIDTH)


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """piece_a, piece_b, mask of pieces with repeated windows, from pieces in the order of their marks; a shard ends where a mark ends."""
    held: list[pa.RecordBatch] = []
    size = 0

    def report(shard: pa.Table) -> Iterator[pa.RecordBatch]:
        if shard.num_rows:
            shard = shard.combine_chunks()
            mask = settled(shard.column("piece").combine_chunks(), np.asarray(shard.column("weight")) > 1)
            found = pa.array(np.flatnonzero(mask))
            out = shard.select(["piece_a", "piece_b"]).append_column("mask", pa.array(mask)).take(found)
            yield from out.to_batches()

    for batch in batches:
        held.append(batch)
        size += batch.num_rows * (WIDTH + HALF)
        if size > SHARD:
            rows = pa.Table.from_batches(held)
            marks = np.asarray(rows.column("mark"))
            borders = np.flatnonzero(marks[1:] != marks[:-1]) + 1
            done = 0
            while len(borders) and (rows.num_rows - done) * (WIDTH + HALF) > SHARD:
                # the last border within reach, or the first one beyond it
                k = int(np.searchsorted(borders, done + SHARD // (WIDTH + HALF), side="right")) - 1
                to = int(borders[k]) if k >= 0 and borders[k] > done else int(borders[k + 1]) if k + 1 < len(borders) else done
                if to == done:
                    break
                yield from report(rows.slice(done, to - done))
                done = to
            held = rows.slice(done).to_batches()
            size = (rows.num_rows - done) * (WIDTH + HALF)
    if held:
        yield from report(pa.Table.from_batches(held))


def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_words, n_removed, spans (word places, end exclusive) and kept words of every text with its repeated windows."""
    spans_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    for batch in text_blocks(batches, 2_000_000):
        n_words, n_removed, spans, kept = [], [], [], []
        for text, windows in zip(batch.column("text").to_pylist(), batch.column("windows").to_pylist(), strict=True):
            words = text.encode().split()
            change = np.zeros(len(words) + 1, dtype=np.int64)
            for w in windows or ():
                bits = np.flatnonzero(w["mask"] >> np.arange(HALF) & 1) + w["first"]
                change[bits] += 1
                change[bits + WIDTH] -= 1
            gone = np.cumsum(change)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
            spans.append([{"begin": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            if len(edges):
                words = [w for a, b in zip([0, *edges[1::2]], [*edges[::2], len(words)], strict=True) for w in words[a:b]]
            kept.append(b" ".join(words).decode())
        yield pa.record_batch(
            [batch.column(k) for k in KEYS] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.string())],
            names=[*KEYS, "n_words", "n_removed", "spans", "kept"],
        )


def bucketed_texts(docs: DataFrame) -> DataFrame:
    """Distinct texts (key_a, key_b, copies, text), written once in buckets by their key."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(*text_keys(), text_or_empty().alias("text")).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("copies"), F.max("text").alias("text"))
    name = f"texts_{uuid.uuid4().hex}"
    texts.write.format("parquet").option("path", f"{shared_home(spark)}/{name}").bucketBy(buckets, *KEYS).saveAsTable(name)
    return spark.table(name)


def cut_documents(docs: DataFrame) -> DataFrame:
    """key_a, key_b, n_words, n_removed, spans, kept for every distinct text of docs."""
    texts = bucketed_texts(docs)
    places = texts.mapInArrow(chunk_rows, "key_a long, key_b long, copies long, mark long, first int, n tinyint")
    marks = places.groupBy("mark").agg(F.sum("copies").alias("held")).filter("held > 1").select("mark")
    listed = places.join(marks, "mark").groupBy(*KEYS).agg(F.collect_list(F.struct("mark", "first", "n")).alias("chunks"))
    listed = written(listed)
    pieces = texts.join(listed, [*KEYS]).mapInArrow(cut_pieces, "key_a long, key_b long, copies long, mark long, first int, n tinyint, piece string")
    ids = [F.xxhash64("piece").alias("piece_a"), F.xxhash64(F.lit(1), "piece").alias("piece_b")]
    pieces = pieces.select(*KEYS, "copies", "mark", "first", *ids, "piece")

    weight = F.least(F.lit(2), F.sum(F.least(F.lit(2), F.col("copies")))).cast("int").alias("weight")
    distinct = written(pieces.groupBy("mark", "piece_a", "piece_b").agg(weight, F.max("piece").alias("piece")))
    hot = distinct.groupBy("mark").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > MOST_PIECES).select("mark")
    windows = distinct.join(hot, "mark").select("piece_a", "piece_b", "weight", "piece").mapInArrow(single_windows, "piece_a long, piece_b long, weight int, bit int, window string")
    windows = windows.withColumn("window_a", F.xxhash64("window")).withColumn("window_b", F.xxhash64(F.lit(1), "window"))
    once = windows.groupBy(F.col("window_a").alias("piece_a"), F.col("window_b").alias("piece_b")).agg(F.least(F.lit(2), F.sum("weight")).cast("int").alias("weight"), F.max("window").alias("piece"))
    columns = ["mark", "piece_a", "piece_b", "weight", "piece"]
    dealt = distinct.join(hot, "mark", "left_anti").select(columns).union(once.withColumn("mark", F.col("piece_a")).select(columns))
    found = written(dealt.repartition("mark").sortWithinPartitions("mark").mapInArrow(searched, "piece_a long, piece_b long, mask long"))

    hits = found.select(F.col("piece_a").alias("window_a"), F.col("piece_b").alias("window_b"), "mask")
    rejoined = windows.drop("window").join(hits, ["window_a", "window_b"]).groupBy("piece_a", "piece_b").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("mask"))
    masks = found.join(rejoined, ["piece_a", "piece_b"], "left_anti").union(rejoined)
    back = pieces.select(*KEYS, "first", "piece_a", "piece_b").join(masks, ["piece_a", "piece_b"]).groupBy(*KEYS).agg(F.collect_list(F.struct("first", "mask")).alias("windows"))
    out = "key_a long, key_b long, n_words long, n_removed long, spans array<struct<begin:int,end:int>>, kept string"
    return texts.select(*KEYS, "text").join(back, [*KEYS], "left").mapInArrow(cut_texts, out)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, spans, kept_sha256 for every row of docs."""
    found = cut_documents(docs).select(*KEYS, "n_words", "n_removed", "spans", F.sha2("kept", 256).alias("kept_sha256"))
    return docs.select("doc_id", *text_keys()).join(written(found), [*KEYS]).drop(*KEYS)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the words that stay as text, joined by blanks, and n_chars after it; a text without repeats stays as it is."""
    found = cut_documents(docs).filter("n_removed > 0").select(F.col("key_a").alias("cut_a"), F.col("key_b").alias("cut_b"), "kept")
    rows = docs.select(F.struct("*").alias("row"), *[k.alias(n) for k, n in zip(text_keys(), ("cut_a", "cut_b"), strict=True)]).join(found, ["cut_a", "cut_b"], "left")
    text = F.coalesce(F.col("kept"), F.col("row.text"))
    count = {"n_chars": F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length("kept").cast(docs.schema["n_chars"].dataType))} if "n_chars" in docs.columns else {}
    new = {"text": text} | count
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
