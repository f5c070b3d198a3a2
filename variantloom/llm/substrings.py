"""Removal of repeated byte strings by merged Burrows-Wheeler transforms of a parsed corpus.

A window is any 400-byte string of a text. It is repeated if it also starts anywhere else. A suffix order of every byte of
the corpus would be far larger than the corpus, so the texts are parsed first:

1. Each window takes the leftmost smallest 64-byte hash inside it as its anchor, so equal windows lie alike to
   their anchors. Windows are gathered in chunks of 128 starts by their distance to the anchor; what all windows of a chunk
   share (273 bytes) is hashed into a mark. Marks that occur at one place only are dropped, by one aggregation.
2. Chunks with a repeated mark are cut to 32 starts, whose windows share 369 bytes: the core. A piece is up to 31
   bytes, the core as one symbol, and up to 31 bytes. Equal pieces are merged with their first and last place. A
   piece at two places is repeated with all its windows; a core with one place has none.
3. Different pieces of one core are strings of 64 symbols. Slices of them are shards: each shard's rotations are
   sorted once into its Burrows-Wheeler transform, and all shards of a task are merged by iterative interleave
   refinement: the order by h+1 symbols comes from the order by h through the transforms alone. Block borders that
   appear in round h mark common prefixes of h symbols; a block that is left after 32 rounds is a repeated interval,
   that is a repeated window.
4. A core with more than `chunk` pieces does not go to one task: its pieces are dealt in chunks, and every two
   chunks meet in a task of their own. Beyond MOST_CHUNKS chunks its windows are counted by Spark instead, one hash
   each, with partial aggregation. All ways give the same masks.

Repeated marks reach the second pass over the texts as a bit table of fixed size; what it lets through by chance falls
out in step 2. Texts that occur twice are removed whole. Hashes have 64 bits.

Edge cases: null text counts as empty; texts under 400 bytes stay; repeated rows are copies of each other; null ids are
rows like any other; an empty table gives no rows; other columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_words, in_bits, mixed, text_blocks, text_or_empty, texts_of, written

LENGTH = 400
GRAM = 64
CHUNK, FINE = 128, 32
SIDE = FINE - 1
BITS = 1 << 26
MOST_CHUNKS = 64
BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the worker's next block."""
    have = _POWERS.get(base, np.ones(1, dtype=np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    _POWERS[base] = have
    return have[:n]


class Block:
    """Several texts as one buffer, with hashes of any of its parts."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(self.raw)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(mixed(self.raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=self.sums[1:])
        self.back = powers(pow(BASE, -1, 1 << 64), n + 1)

    def part(self, start: np.ndarray, size: int) -> np.ndarray:
        return mixed((self.sums[start + size] - self.sums[start]) * self.back[start])

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """mark, text index and core start in the text of every chunk of windows."""
        none = np.empty(0, dtype=np.int64)
        if len(self.raw) < LENGTH:
            return none.astype(np.uint64), none, none
        wide = LENGTH - GRAM + 1
        grams = mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * self.back[: len(self.raw) - GRAM + 1])
        # the smallest of each stretch, with its place: stretches meet at most two blocks of their own width
        low = np.uint64(max(24, len(grams).bit_length()))  # bits for the place; only texts of over 16 MB need more
        marked = grams >> low << low | np.arange(len(grams), dtype=np.uint64)
        padded = np.full(-(-len(marked) // wide) * wide, ~np.uint64(0))
        padded[: len(marked)] = marked
        padded = padded.reshape(-1, wide)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(marked) - wide + 1
        anchor = (np.minimum(behind[:n], ahead[wide - 1 : wide - 1 + n]) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        window = np.arange(n)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[:n]
        inside = window + LENGTH <= (self.starts + self.sizes)[owner]
        anchor, window, owner = anchor[inside], window[inside], owner[inside]
        step = (anchor - window) // CHUNK
        core = anchor - CHUNK * step
        first = np.ones(len(core), dtype=bool)
        first[1:] = (core[1:] != core[:-1]) | (step[1:] != step[:-1]) | (owner[1:] != owner[:-1])
        core, step, owner = core[first], step[first], owner[first]
        mark = self.part(core, LENGTH - CHUNK + 1) ^ mixed(step.astype(np.uint64) + np.uint64(77))
        return mark, owner, core - self.starts[owner]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, np.ndarray]]:
    """Blocks of texts, and the texts' keys."""
    for batch in text_blocks(batches, 2_000_000):
        texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch)]
        yield Block(texts), np.asarray(batch.column("text_key"), dtype=np.int64)


def bit(n: F.Column) -> F.Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))


def placed(key: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for a place in a text."""
    return mixed(key.view(np.uint64) ^ mixed(at.astype(np.uint64))).view(np.int64)


def marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, keys in blocks(batches):
        mark, owner, at = block.chunks()
        yield pa.RecordBatch.from_pydict({"mark": pa.array(mark.view(np.int64)), "place": pa.array(placed(keys[owner], at))})


def pieces_of(block: Block, owner: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The pieces of chunks whose cores start at `at`: core hash, both sides, their lengths, owner and place."""
    start = (at[:, None] - FINE * np.arange(CHUNK // FINE)).ravel()
    owner = np.repeat(owner, CHUNK // FINE)
    size = block.sizes[owner]
    ok = (start >= 0) & (np.maximum(0, start - SIDE) <= np.minimum(start, size - LENGTH))
    start, owner, size = start[ok], owner[ok], size[ok]
    base = block.starts[owner]
    left, right = np.minimum(start, SIDE), np.minimum(size - start - (LENGTH - SIDE), SIDE)
    sides = np.zeros((len(start), 2 * SIDE), dtype=np.uint8)
    k = np.arange(SIDE)
    last = max(0, len(block.raw) - 1)
    sides[:, :SIDE] = np.where(k >= SIDE - left[:, None], block.raw[np.clip((base + start)[:, None] - SIDE + k, 0, last)], 0)
    sides[:, SIDE:] = np.where(k < right[:, None], block.raw[np.clip((base + start)[:, None] + LENGTH - SIDE + k, 0, last)], 0)
    return {"core": block.part(base + start, LENGTH - SIDE), "sides": sides, "left": left, "right": right, "owner": owner, "start": start}


def transform(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The Burrows-Wheeler transform of a shard of strings of equal length: the sorted rotations (numbered row by row)
    and the symbol before each. Rotations are sorted by FINE symbols; deeper order is never asked for."""
    n, width = rows.shape
    twice = np.concatenate([rows, rows[:, :FINE]], axis=1).astype(">u2")
    views = np.lib.stride_tricks.sliding_window_view(twice, FINE, axis=1)[:, :width]
    order = np.argsort(np.ascontiguousarray(views).view(f"S{2 * FINE}").ravel(), kind="stable")
    return order, np.roll(rows, 1, axis=1).ravel()[order]


def merged(shards: list[np.ndarray], rounds: int = FINE) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms by interleave refinement: from which shard each suffix of the merged order comes, and
    the block (suffixes with an equal prefix of `rounds` symbols) that it is in."""
    flat = np.concatenate(shards)
    came = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s) for s in shards])
    block = np.zeros(len(flat), dtype=np.int64)
    seen = np.empty(len(flat), dtype=flat.dtype)
    for _ in range(rounds):
        seen[np.argsort(came, kind="stable")] = flat  # each shard's symbols, in the order of the interleave so far
        order = np.argsort(seen, kind="stable")
        came, symbol, was = came[order], seen[order], block[order]
        border = np.zeros(len(flat), dtype=bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (was[1:] != was[:-1])
        block = np.cumsum(border)
    return came, block


def repeated_windows(core: np.ndarray, sides: np.ndarray, left: np.ndarray, right: np.ndarray, shard_rows: int = 512) -> np.ndarray:
    """For each piece a mask: bit j is set if the window that starts j bytes before the core is in another piece too."""
    _, symbol = np.unique(core, return_inverse=True)
    rows = np.zeros((len(core), 2 * SIDE + 2), dtype=np.uint16)  # a border, left side, core, right side
    k = np.arange(SIDE)
    rows[:, 1 : SIDE + 1] = np.where(k >= SIDE - left[:, None], sides[:, :SIDE].astype(np.uint16) + 1, 0)
    rows[:, SIDE + 1] = symbol + 257
    rows[:, SIDE + 2 :] = np.where(k < right[:, None], sides[:, SIDE:].astype(np.uint16) + 1, 0)
    orders, transforms, base = [], [], 0
    for some in np.array_split(rows, max(1, -(-len(rows) // shard_rows))):
        order, own = transform(some)
        orders.append(order + base)
        transforms.append(own)
        base += some.size
    came, block = merged(transforms)
    suffix = np.empty(len(came), dtype=np.int64)
    suffix[np.argsort(came, kind="stable")] = np.concatenate(orders)
    piece, at = suffix // rows.shape[1], suffix % rows.shape[1]
    back = SIDE + 1 - at  # how many bytes before the core the suffix starts
    window = (back >= 0) & (back <= left[piece]) & (SIDE - back <= right[piece])
    many = np.bincount(block[window], minlength=int(block[-1]) + 1 if len(block) else 0)
    hit = window & (many[block] > 1)
    mask = np.zeros(len(core), dtype=np.int64)
    np.bitwise_or.at(mask, piece[hit], np.int64(1) << back[hit])
    return mask


def solved(batches: Iterator[pa.RecordBatch], most: int = 8_192) -> Iterator[pa.RecordBatch]:
    """piece, mask of the pieces of a partition sorted by meeting (core and chunks); meetings are never cut."""
    held: list[pa.RecordBatch] = []

    def run(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        sides = np.frombuffer(b"".join(table.column("sides").to_pylist()), dtype=np.uint8).reshape(n, 2 * SIDE)
        col = lambda x: np.asarray(table.column(x), dtype=np.int64)
        return pa.RecordBatch.from_pydict({"piece": pa.array(col("piece")), "mask": pa.array(repeated_windows(col("met"), sides, col("left"), col("right")))})

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            table = pa.Table.from_batches(held)
            met = np.asarray(table.column("met"), dtype=np.int64)
            cuts = np.flatnonzero(met[1:] != met[:-1]) + 1
            done = 0
            while True:
                fits = cuts[(cuts > done) & (cuts <= done + most)]
                later = cuts[cuts > done]
                if not len(later) or table.num_rows - done < most:
                    break
                to = int(fits[-1] if len(fits) else later[0])
                yield run(table.slice(done, to - done))
                done = to
            held = table.slice(done).to_batches()
    if held and sum(b.num_rows for b in held):
        yield run(pa.Table.from_batches(held))


def counted(pieces: DataFrame) -> DataFrame:
    """piece, mask of cores with many pieces: every window is one hash, counted by partial aggregation."""
    j = F.col("j")
    key = F.xxhash64("core", j, F.substring("sides", SIDE + 1 - j, j), F.substring("sides", F.lit(SIDE + 1), SIDE - j))
    windows = pieces.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(SIDE)))).filter("j <= left AND 31 - j <= right").select("piece", "j", key.alias("window"))
    twice = windows.groupBy("window").agg(F.min("piece").alias("a"), F.max("piece").alias("b")).filter("a <> b").select("window")
    return windows.join(twice, "window").groupBy("piece").agg(F.sum(bit(F.col("j"))).alias("mask"))


def removed(text: bytes, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the text that repeated windows cover."""
    starts = sorted({at - j for at, mask in places for j in range(FINE) if mask >> j & 1})
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = s + LENGTH
        else:
            out.append([s, s + LENGTH])
    return [(a, b) for a, b in out]


def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_blocks(batches):
        rows = []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            runs = removed(raw, [(p["start"], p["mask"]) for p in places])
            kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(raw)], strict=True))
            rows.append((sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_pydict({"text_key": batch.column("text_key"), "n_removed": pa.array([r[0] for r in rows], pa.int64()), "n_spans": pa.array([r[1] for r in rows], pa.int64()), "kept_sha256": pa.array([r[2] for r in rows], pa.string())})


def repeated_places(texts: DataFrame, chunk: int = 1_024) -> DataFrame:
    """text_key, start, mask: where the windows start..start-31 of the texts (text_key, text) are repeated."""
    spark = texts.sparkSession
    marks = texts.mapInArrow(marks_of, "mark long, place long")
    twice = marks.groupBy("mark").agg(F.min("place").alias("a"), F.max("place").alias("b")).filter("a <> b")
    shared = spark.sparkContext.broadcast(bit_words(twice.select("mark"), BITS))

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for block, keys in blocks(batches):
            mark, owner, at = block.chunks()
            place = mark & np.uint64(BITS - 1)
            hit = (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            p = pieces_of(block, owner[hit], at[hit])
            n = len(p["start"])
            sides = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(2 * SIDE)), pa.py_buffer(p["sides"].tobytes())])
            yield pa.RecordBatch.from_pydict({"core": pa.array(p["core"].view(np.int64)), "sides": sides, "left": pa.array(p["left"].astype(np.int32)), "right": pa.array(p["right"].astype(np.int32)), "text_key": pa.array(keys[p["owner"]]), "start": pa.array(p["start"].astype(np.int32))})

    found = texts.mapInArrow(emitted, "core long, sides binary, left int, right int, text_key long, start int")
    found = written(found.withColumn("piece", F.xxhash64("core", "sides", "left", "right")).withColumn("place", F.xxhash64("text_key", "start")))
    whole = (1 << FINE) - 1
    # sides stay behind: only pieces whose core has others need them
    pieces = found.groupBy("core", "piece").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    pieces = written(pieces)
    # counts and masks are written before they are joined: both sides of the join are then plain shuffles, which Spark splits where a key is hot
    cores = written(pieces.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # a piece at several places is settled, but others of its core still need it
    hot = spark.sparkContext.broadcast(bit_words(cores.select("core"), BITS))

    def with_rivals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bits(hot.value, np.asarray(batch.column("core"), dtype=np.int64))))

    sided = found.select("core", "piece", "sides", "left", "right")
    rivals = sided.mapInArrow(with_rivals, sided.schema).distinct().join(cores, "core")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("piece"), F.col("chunks")).cast("int")
    few = rivals.withColumn("chunks", chunks).filter(F.col("chunks") <= MOST_CHUNKS).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    few = few.select(F.xxhash64("core", F.least("own", "other"), F.greatest("own", "other")).alias("met"), "sides", "left", "right", "piece")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged_ = few.repartition(parts, "met").sortWithinPartitions("met", "piece").mapInArrow(solved, "piece long, mask long")
    masks = merged_.union(counted(rivals.filter(chunks > MOST_CHUNKS))).union(pieces.filter("a <> b").select("piece", F.lit(whole).cast("long")))
    masks = written(masks.groupBy("piece").agg(F.bit_or("mask").alias("mask")).filter("mask <> 0"))
    valid = bit(F.col("left") + 1) - 1  # windows that start inside the text
    ended = -bit(SIDE - F.col("right"))  # and end inside it
    rows = found.select("piece", "text_key", "start", "left", "right").join(masks, "piece")  # a row for each copy of a text
    return rows.select("text_key", "start", F.col("mask").bitwiseAND(valid).bitwiseAND(ended).alias("mask"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    text = text_or_empty()
    texts = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text"))
    places = written(repeated_places(texts).groupBy("text_key").agg(F.collect_set(F.struct("start", "mask")).alias("places")))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_key"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("own_sha256"))
    copies = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    alone = places.join(copies.filter("copies = 1"), "text_key").select("text_key", "places")
    # only texts that lose some bytes need to move: the others are kept back by a bit table of fixed size
    shared = docs.sparkSession.sparkContext.broadcast(bit_words(places.select("text_key"), BITS))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column("text_key"), dtype=np.int64).view(np.uint64) & np.uint64(BITS - 1)
            yield batch.filter(pa.array((shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)))

    moved = texts.mapInArrow(wanted, texts.schema).join(alone, "text_key")
    cut = moved.mapInArrow(cut_texts, "text_key long, n_removed long, n_spans long, kept_sha256 string")
    joined = rows.join(copies, "text_key", "left").join(cut, "text_key", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "own_sha256")).alias("kept_sha256"),
    )
