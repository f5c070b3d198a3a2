"""Near copies of whole texts: SimHash fingerprints in pivot distance tables find candidates, the exact five-word similarity decides.

A text's set holds the XXH64 (seed 42) of its shingles of five words. Texts with equal sets are one node. Two sets are
near copies if their Jaccard similarity is 0.8 or more. At 0.8 some 15 % of a fingerprint's bits differ, so one fingerprint
within a few bits would miss most such pairs: each node has WORDS fingerprints of 64 majority bits over its set, under
different keyed hashes, and two more, the guide. As in simhash.py, each table has references that differ from a base
reference only inside some bits of two fingerprints (its part), and is keyed by the differences between a node's Hamming
distances to them and to the base: nodes that agree in the part share the key. A pair with similarity s agrees in a part of k bits with the
chance c**k, where 1 - c = acos(2 * s / (1 + s)) / pi, and is missed by all BANDS tables with the chance (1 - c**k)**BANDS. Parts have
PART bits up to two million rows and one more for each doubling beyond, so that unrelated nodes seldom share a key.

Inside a key, nodes are put together only if a chain of members ties them whose guides differ by at most NEAR_GUIDE bits, at
0.8 four and a half standard errors above the mean (of unrelated pairs three in a million pass); each such group gets a key of its own. Keys of over MOST_HELD members are not parted, so no task holds them.

Members of a key are compared in three rounds. In the first two each key has one head, which is drawn by keyed hash:
four draws, then eight others, each for a share of the tables. A member meets the MEETS heads that it shares most tables with, so these rounds
compare MEETS pairs for each node at most, however large the groups are; they only make the third round small. In the third, keys whose members are still in several classes tie those classes to clusters; the
members of these classes (of a key, where the cluster is too large) compare all pairs of different classes inside a task, dealt in chunks of which every
two meet; only links leave it. Every link is decided on the whole sets; the third round leaves out pairs whose fingerprints
differ in more than FURTHEST of their bits, five standard errors beyond what sets of five shingles show at 0.8.

Edge cases: null and empty texts are copies of each other; texts shorter than a shingle are one shingle; null ids take
part like others, and a class of null ids only keeps one row; repeated ids with different texts are different rows; an empty
table gives no rows; other columns stay; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from .common import discarded, given_back, mixed, one_of_each, picked, text_blocks, texts_of, written
from .components import components

SIZE = 5
#: Tables, and the bytes of fingerprints for each of them.
BANDS, ROWS = 128, 1
WORDS = BANDS * ROWS // 8
PART, PER_PART = 18, 12
NEAR_GUIDE, FURTHEST, MOST_HELD = 38, 280, 65_536
#: Heads that a node meets in each of the first two rounds; the third compares all that these leave in different classes.
MEETS = 4
#: Similarity 4/5: common / (a + b - common) >= 4/5, that is 9 * common >= 4 * (a + b).
NEAR = "9 * size(array_intersect(x, y)) >= 4 * (size(x) + size(y))"
SEEDS = (mixed(np.arange(1, 3 + WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))[:, None]


def shingles(text: str, size: int = SIZE) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII blanks and letters only
    flat = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(flat, 42)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.unique(np.array([xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)], dtype=np.uint64))


def hashed(found: np.ndarray) -> np.ndarray:
    """Members (hashes themselves) under each fingerprint's own hash: a row for each fingerprint."""
    out = found * SEEDS
    return out ^ (out >> np.uint64(32))


def fingerprints(found: np.ndarray) -> np.ndarray:
    """The fingerprints of a set, the guide last: a bit is 1 if set in over half of the members' hashes."""
    ones = np.zeros((8, 2 + WORDS, 8), dtype=np.int64)
    for k in range(0, len(found), 1 << 14):
        hashes = hashed(found[k : k + (1 << 14)])
        held = np.zeros((2 + WORDS, -(-hashes.shape[1] // 15) * 15), dtype=np.uint64)
        held[:, : hashes.shape[1]] = hashes
        # sums of three members in lanes of two bits, of fifteen in lanes of four, and then of all in bytes
        for shift, lanes, parts in ((1, 0x5555555555555555, 3), (2, 0x3333333333333333, 5), (4, 0x0F0F0F0F0F0F0F0F, 1)):
            held = np.stack([held & np.uint64(lanes), held >> np.uint64(shift) & np.uint64(lanes)])
            size = held.shape[-1] // parts
            held = sum((held[..., x * size : (x + 1) * size] for x in range(1, parts)), start=held[..., :size])
        held = np.add.reduceat(held, np.arange(0, held.shape[-1], 17), axis=-1)
        ones += np.ascontiguousarray(held).view(np.uint8).reshape(8, 2 + WORDS, -1, 8).sum(axis=2, dtype=np.int64)
    return np.packbits((2 * ones > len(found)).transpose(1, 2, 0), axis=2, bitorder="little").reshape(-1, 8).view(np.uint64).ravel()


def table_words(words: np.ndarray) -> np.ndarray:
    """What each table reads of nodes (a row of fingerprints each): half of one fingerprint and half of another, so that tables have few bits in common."""
    t = np.arange(BANDS)
    low = np.uint64(0xFFFFFFFF)
    return words[:, t % WORDS] & low | words[:, (t + 1 + t // WORDS) % WORDS] & ~low


def references(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each table its base reference, and references that differ from the base inside the table's part only."""
    rng = np.random.default_rng(SIZE)
    base = rng.integers(0, 1 << 64, BANDS, dtype=np.uint64)
    part = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, bits, replace=False).astype(np.uint64)) for _ in range(BANDS)])
    return base, base[:, None] ^ (rng.integers(0, 1 << 64, (BANDS, PER_PART), dtype=np.uint64) & part[:, None])


def table_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """The keys of nodes (a row of fingerprints each) in all tables: differences of distances to the table's references."""
    base, others = references(bits)
    own = table_words(words)
    to_base = np.bitwise_count(own ^ base).astype(np.int16)
    keys = np.broadcast_to(mixed(np.arange(1, 1 + BANDS, dtype=np.uint64)), own.shape)
    for k in range(PER_PART):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + (np.bitwise_count(own ^ others[:, k]) - to_base).astype(np.uint64)
    return mixed(keys)


def lists(rows: np.ndarray) -> pa.Array:
    """Rows of equal length as a column of lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.view(np.int64).ravel()))


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_blocks(batches):
        sets = [shingles(t) for t in texts_of(part)]
        node = np.array([xxh64_intdigest(s.tobytes(), 7) for s in sets], dtype=np.uint64).view(np.int64)
        words = np.array([fingerprints(s) for s in sets], dtype=np.uint64).reshape(-1, 2 + WORDS)
        own = {c: part.column(c) for c in ("doc_id", "pick_a", "pick_b")}
        yield pa.RecordBatch.from_pydict(own | {"node": pa.array(node), "n": pa.array([len(s) for s in sets], pa.int32()), "guide_a": pa.array(words[:, -2].view(np.int64)), "guide_b": pa.array(words[:, -1].view(np.int64)), "words": lists(np.ascontiguousarray(words[:, :WORDS]))})


def keyed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """key, band, node, n, guide_a, guide_b: a row of each node for each table."""
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            some = batch.slice(k, 500)
            words = np.array(some.column("words").to_pylist(), dtype=np.int64).view(np.uint64).reshape(-1, WORDS)
            keys = table_keys(words, bits)
            each = {c: pa.array(np.repeat(np.asarray(some.column(c)), BANDS)) for c in ("node", "n", "guide_a", "guide_b")}
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64).ravel()), "band": pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(words)))} | each)


def near_guides(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(some ^ other).sum(axis=-1) <= NEAR_GUIDE


def tied(guide: np.ndarray) -> np.ndarray:
    """For each member of a key the first member that a chain of near guides ties it to."""
    label, left = np.arange(len(guide)), np.arange(len(guide))
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = near_guides(guide[left], guide[queue.pop()])
            label[left[near]] = root
            queue += left[near].tolist()
            left = left[~near]
    return label


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members (key, band, node, n) of a partition sorted by key that have a near guide beside them, each group of such under a key of its own."""
    names = ("key", "band", "node", "n", "guide_a", "guide_b")
    held: list[list[np.ndarray]] = []  # the rows of the last key, which may go on
    whole = None  # a key with too many members to hold

    def parted(cols: list[np.ndarray]) -> pa.RecordBatch:
        key, band, node, n = cols[:4]
        guide = np.stack(cols[4:], axis=1).view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        label = np.arange(len(key))
        two = starts[sizes == 2]
        two = two[near_guides(guide[two], guide[two + 1])]
        label[two + 1] = two
        for s, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            label[s : s + size] = s + tied(guide[s : s + size])
        order = np.argsort(label, kind="stable")
        order = order[np.bincount(label, minlength=len(label))[label[order]] > 1]
        new = mixed(key[order].view(np.uint64) ^ mixed(node[label[order]].view(np.uint64))).view(np.int64)
        return pa.RecordBatch.from_pydict({"key": pa.array(new), "band": pa.array(band[order]), "node": pa.array(node[order]), "n": pa.array(n[order])})

    def unparted(cols: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(names[:4], map(pa.array, cols[:4]), strict=True)))

    for batch in batches:
        cols = [np.asarray(batch.column(c), dtype=np.int64) for c in names]
        if not len(cols[0]):
            continue
        if whole is not None:
            more = int(np.searchsorted(cols[0] != whole, True))
            yield unparted([c[:more] for c in cols])
            if more == len(cols[0]):
                continue
            whole, cols = None, [c[more:] for c in cols]
        if held and held[0][0][0] != cols[0][0]:
            yield parted([np.concatenate(x) for x in zip(*held, strict=True)])
            held = []
        last = int(np.searchsorted(cols[0] == cols[0][-1], True))  # a sorted partition: the last key's rows stand together
        if last:
            yield parted([np.concatenate([*(h[k] for h in held), c[:last]]) for k, c in enumerate(cols)])
            held = []
        held.append([c[last:] for c in cols])
        if sum(len(h[0]) for h in held) > MOST_HELD:
            whole = held[0][0][0]
            yield unparted([np.concatenate(x) for x in zip(*held, strict=True)])
            held = []
    if held:
        yield parted([np.concatenate(x) for x in zip(*held, strict=True)])
        held = []
    given_back()


def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members (key, node, n) of keys with several, with the key's first member; the partition is sorted by key and node."""
    names, held = ("key", "band", "node", "n"), None  # held: the last row and its key's first node and size, and whether it was given out

    def out(cols: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(("key", "band", "node", "n", "head", "head_n"), map(pa.array, cols), strict=True)))

    for batch in batches:
        key, band, node, n = (np.asarray(batch.column(c), dtype=np.int64) for c in names)
        if not len(key):
            continue
        opens = np.concatenate([[held is None or held[0] != key[0]], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
        head, head_n = node[np.maximum(first, 0)], n[np.maximum(first, 0)]
        if held is not None:
            head, head_n = np.where(first < 0, held[1], head), np.where(first < 0, held[2], head_n)
        more = np.flatnonzero(~opens)
        if len(more):
            # a key's first member is given out with the second
            second = more[(node[more - 1] == head[more]) & (more > 0)]
            lead = np.array([0], dtype=np.int64)[: int(more[0] == 0 and held[3])]
            two = np.concatenate([lead, second]).astype(np.int64)
            yield out([np.concatenate([key[two], key[more]]), np.concatenate([band[two], band[more]]), np.concatenate([head[two], node[more]]), np.concatenate([head_n[two], n[more]]), np.concatenate([head[two], head[more]]), np.concatenate([head_n[two], head_n[more]])])
        held = (key[-1], head[-1], head_n[-1], bool(opens[-1]))


def grouped_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return met(grouped(batches))


def full_sets(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Of each node its sorted set, its keys, and its fingerprints."""
    for batch in text_blocks(batches):
        sets = [shingles(t) for t in texts_of(batch)]
        words = np.array([fingerprints(s)[:WORDS] for s in sets], dtype=np.uint64).reshape(-1, WORDS)
        yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), "keys": lists(table_keys(words, bits)), "sketch": pa.array([w.tobytes() for w in words], pa.binary())})


def links_inside(rows: dict[str, np.ndarray], lists: list[list], band: int, apart: bool) -> list[tuple[int, int]]:
    """Links between classes of one group (a cluster, a key, or two chunks of either): for each pair of classes that has any.

    In a key, a pair that shares an earlier table's key is left to that key. The fingerprints rule out pairs that differ in more than
    FURTHEST bits; the others are decided on the whole sets, which are numbered inside the group.
    """
    node, own, n, label = rows["node"], rows["own"], rows["n"], rows["component"].copy()
    keys = np.array(lists[1], dtype=np.int64).reshape(len(node), BANDS)
    sketch = np.frombuffer(b"".join(lists[2]), dtype=np.uint64).reshape(len(node), WORDS)
    sizes = np.array([len(s) for s in lists[0]])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    numbers = np.unique(np.concatenate(lists[0]), return_inverse=True)[1].astype(np.int32)
    held = np.zeros(int(numbers.max()) + 1, dtype=np.uint8)
    out = []
    for x in range(len(node) - 1):
        ok = (label[x + 1 :] != label[x]) & (5 * n[x + 1 :] >= 4 * n[x]) & (5 * n[x] >= 4 * n[x + 1 :])
        if apart:
            ok &= own[x + 1 :] != own[x]  # pairs inside a chunk meet in the chunk's own group
        ys = np.flatnonzero(ok) + x + 1
        if band:
            ys = ys[~(keys[ys, :band] == keys[x, :band]).any(axis=1)]
        ys = ys[np.bitwise_count(sketch[ys] ^ sketch[x]).sum(axis=1, dtype=np.int64) <= FURTHEST]
        if not len(ys):
            continue
        mine = numbers[starts[x] : starts[x] + sizes[x]]
        held[mine] = 1
        offsets = np.cumsum(sizes[ys]) - sizes[ys]
        members = numbers[np.repeat(starts[ys] - offsets, sizes[ys]) + np.arange(sizes[ys].sum())]
        common = np.add.reduceat(held[members], offsets, dtype=np.int64)
        held[mine] = 0
        for y in ys[9 * common >= 4 * (sizes[x] + sizes[ys])].tolist():
            if label[y] != label[x]:
                out.append((min(int(node[x]), int(node[y])), max(int(node[x]), int(node[y]))))
                label[label == label[y]] = label[x]
    return out


def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the groups (key, i, j) of a sorted partition, one group at a time; pairs never leave the task."""
    names, wide = ("key", "i", "j", "band", "own", "node", "n", "component"), ("shingles", "keys", "sketch")
    held: list[tuple] = []  # the rows of the open group

    def done() -> pa.RecordBatch:
        cols = {c: np.array([r[k] for r in held], dtype=np.int64) for k, c in enumerate(names)}
        sets = [np.asarray(r[len(names)], dtype=np.int64) for r in held]
        found = links_inside(cols, [sets, [r[len(names) + 1] for r in held], [r[len(names) + 2] for r in held]], held[0][3], held[0][1] != held[0][2])
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names), *([x.values if hasattr(x, "values") else x.as_py() for x in batch.column(c)] for c in wide), strict=True):
            if held and row[:3] != held[0][:3]:
                yield done()
                held = []
            held.append(row)
    if held:
        yield done()
        held = []
    given_back()


def sets_of_nodes(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """node, shingles, keys, sketch of each wanted node, from one of its texts; written once for all rounds."""
    picks = nodes.join(wanted, "node").select("node", "pick_a", "pick_b")
    texts = picked(docs).selectExpr("pick_a", "pick_b", "row.text AS text").join(picks, ["pick_a", "pick_b"]).dropDuplicates(["node"]).select("node", "text")
    return written(texts.mapInArrow(partial(full_sets, bits=bits), "node long, shingles array<long>, keys array<long>, sketch binary"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets have a similarity of 0.8 at least."""
    left, right = sets.selectExpr("node AS a", "shingles AS x"), sets.selectExpr("node AS b", "shingles AS y")
    return pairs.distinct().join(left, "a").join(right, "b").filter(NEAR).select("a", "b")


def nearest_heads(met: DataFrame) -> DataFrame:
    """The pairs (a, b) of each node and the MEETS heads that stand most often beside it in met (node, head), ties to the smaller head."""
    often = met.groupBy("node", "head").agg(F.count(F.lit(1)).alias("tables"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("tables"), "head"))  # a node has a row for each table at most
    return often.withColumn("rank", rank).filter(F.col("rank") <= MEETS).selectExpr("least(head, node) AS a", "greatest(head, node) AS b")


def drawn(node: str, group: str, draws: int, seed: int = 0) -> F.Column:
    """A keyed hash of the node, one of `draws` orders by the group."""
    return F.xxhash64(F.pmod(F.col(group), F.lit(draws)) + F.lit(seed), F.col(node))


def still_open(parts: DataFrame, *more: F.Column) -> DataFrame:
    """Keys whose members are in several classes: key, its least class, its members m and their sizes total, and more aggregates of parts."""
    keys = parts.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.sum("m").alias("m"), F.sum("total").alias("total"), *more)
    return written(keys.filter("least <> most").drop("most"))


def labelled(rows: DataFrame, near: DataFrame) -> DataFrame:
    """rows (node) with the class (component) that the links give each node."""
    return rows.join(components(near), "node", "left").withColumn("component", F.coalesce("component", "node"))


def classes(docs: DataFrame, chunk: int = 2_048, chunk_shingles: int = 1_000_000, most_chunks: int = BANDS // 2) -> DataFrame:
    """doc_id, pick_a, pick_b, component of every row: rows that links of similarity 0.8 reach share a component.

    Clusters of more than `most_chunks` chunks are taken key by key, which sends a member to its keys at most.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, pick_a long, pick_b long, node long, n int, guide_a long, guide_b long, words array<long>"
    bits = max(PART, (docs.count() - 1).bit_length() - 3)
    rows = written(picked(docs).selectExpr("row.doc_id", "row.text", "pick_a", "pick_b").mapInArrow(signed, schema))
    nodes = rows.dropDuplicates(["node"])
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = nodes.select("node", "n", "guide_a", "guide_b", "words").mapInArrow(partial(keyed, bits=bits), "key long, band int, node long, n int, guide_a long, guide_b long")
    # the draw is made after the shuffle, which is the largest of the stage
    dealt = keys.repartition(slots, "key").withColumn("draw", drawn("node", "band", 4)).sortWithinPartitions("key", "draw", "node").drop("draw")
    members = written(dealt.mapInArrow(grouped_heads, "key long, band long, node long, n long, head long, head_n long"))
    fits = "node <> head AND 5 * n >= 4 * head_n AND 5 * head_n >= 4 * n"
    sets = sets_of_nodes(members.select("node").distinct(), docs, nodes, bits)
    near = written(verified(nearest_heads(members.filter(fits)), sets))
    # from here on a key has one row for each class among its members, and one of these members stands for it
    drawn_ = F.struct(drawn("node", "key", 8, 4).alias("draw"), "node", "n")
    parts = written(labelled(members.select("key", "node", "n"), near).groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"), F.min(drawn_).alias("own")))
    opened = still_open(parts, F.min(F.struct("own", "component")).alias("h"))
    other = parts.join(opened.select("key", "h"), "key").filter("component <> h.component AND 5 * own.n >= 4 * h.own.n AND 5 * h.own.n >= 4 * own.n")
    first, near = near, written(near.union(verified(nearest_heads(other.selectExpr("own.node AS node", "h.own.node AS head")), sets)))
    now = written(labelled(members.select("node", "n").distinct(), near))
    parts_ = written(labelled(parts.select("key", F.col("component").alias("node"), "m", "total"), near).groupBy("key", "component").agg(F.sum("m").alias("m"), F.sum("total").alias("total")))
    open_ = still_open(parts_)
    # classes that open keys tie together are a cluster: each of its members goes once to each of its chunks, not once to each key
    ties = parts_.join(open_.select("key", "least"), "key").filter("least <> component").selectExpr("least AS a", "component AS b")
    clusters = components(ties).selectExpr("node AS component", "component AS cluster")
    inside = now.join(clusters, "component")
    # a chunk is bounded by its members and by the sizes of their sets
    chunks = F.ceil(F.greatest(F.col("m") / chunk, F.col("total") / chunk_shingles)).cast("int").alias("chunks")
    few = written(inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).select("cluster", chunks).filter(F.col("chunks") <= most_chunks))
    whole = inside.join(few, "cluster").select(F.col("cluster").alias("key"), F.lit(0).cast("long").alias("band"), "node", "n", "component", "chunks")
    large = inside.join(few, "cluster", "left_anti").select("node", "component")
    rest = members.select("key", "band", "node", "n").join(large, "node").join(open_.select("key", chunks), "key")
    left = whole.unionByName(rest.select(whole.columns))
    left = left.withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    left = left.select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "component")
    dealt = left.join(sets, "node").repartition(slots, "key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    more = dealt.mapInArrow(crossed, "a long, b long")
    found = components(near.union(more))
    discarded(first, near, members, parts, opened, now, parts_, few, open_, sets)
    return rows.join(found, "node", "left").select("doc_id", "pick_a", "pick_b", F.coalesce("component", "node").alias("component"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class of near copies: the smallest doc_id (null last), and of equal ids one text."""
    return one_of_each(docs, classes(docs))
