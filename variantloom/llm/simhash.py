"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint has 64 majority bits over the hashes of its word shingles. Equal fingerprints are one node.
For every node the Hamming distances to many reference fingerprints are computed. The references come in blocks:
those of block b differ from a base reference only inside the b-th part of the 64 bits, so the difference of two
distances shows how the node lies to that part alone. Nodes at most 3 bits apart agree in at least 2 of 5 parts, and so
in all distance differences of those two blocks: ten tables, keyed by the differences of two blocks, meet every
such pair. Inside a key, pairs whose distances to some reference differ by more than the radius are discarded (the
triangle inequality) and the others are verified bit by bit. A key's members give a spanning forest of links, never all pairs;
a member that is already linked is not compared again.

A key with more members than a task should hold is keyed once more: the three other parts have two halves each, and of these six
any three bits leave three halves alike, so twenty finer keys, by the distance differences of three halves, meet every pair of
such a key again, and the work grows with the members. A finer key leaves some 20 of 64 bits open; only where it still holds more
members than a task should are they dealt in chunks of which every two meet.

Edge cases: null and empty texts have fingerprint zero and are linked like any other; texts shorter than a shingle
are one shingle; repeated rows keep their rows and share a class; null ids take part, and a class of null ids only has
a null component; an empty table gives no rows; other columns are ignored; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import checkpointed, mixed, one_of_each, picked, text_blocks, texts_of, written
from .components import components

RADIUS = 3
PARTS = 5  # two of them agree in any pair within the radius
PER_PART = 8


def masks() -> list[int]:
    """The bits of each part."""
    ends = [64 * k // PARTS for k in range(PARTS + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]


def references() -> tuple[int, list[list[int]]]:
    """The base reference and, for each part, references that differ from it inside the part only."""
    words = mixed(np.arange(1, 2 + PARTS * PER_PART, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tolist()
    base = words[0]
    return base, [[base ^ (words[1 + b * PER_PART + k] & mask) for k in range(PER_PART)] for b, mask in enumerate(masks())]


def fingerprint(text: str, size: int) -> int:
    """64 majority bits over XXH64 (seed 42) of the shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII blanks and letters only
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= size:
        return xxh64_intdigest(flat, 42)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    found = np.array([xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)], dtype=np.uint64)
    bits = np.zeros(64, dtype=np.int64)
    for k in range(0, len(found), 1 << 16):
        bits += np.unpackbits(found[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(found)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the longs of `also` and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            found = np.array([fingerprint(t, size) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("doc_id", *also)} | {"fp": pa.array(found.view(np.int64))})

    longs = "".join(f", {c} long" for c in (*also, "fp"))
    return docs.select("doc_id", "text", *also).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}{longs}")


def keyed(nodes: DataFrame) -> DataFrame:
    """node, fp, key: one row for each pair of parts, keyed by the distance differences of their references."""
    signed = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
    base, parts = references()
    to_base = F.bit_count(F.col("fp").bitwiseXOR(signed(base)))
    table = nodes.select("node", "fp", *[F.bit_count(F.col("fp").bitwiseXOR(signed(r))).alias(f"d{b}_{k}") for b, rs in enumerate(parts) for k, r in enumerate(rs)], to_base.alias("d"))
    shown = lambda b: [F.col(f"d{b}_{k}") - F.col("d") for k in range(PER_PART)]
    pairs = [F.xxhash64(F.lit(t), *shown(a), *shown(b)) for t, (a, b) in enumerate(combinations(range(PARTS), 2))]
    return table.select("node", "fp", F.posexplode(F.array(*pairs)).alias("pair", "key"))


def halves() -> list[int]:
    """The bits of each half of each part, in order."""
    out = []
    for mask in masks():
        low, size = (mask & -mask).bit_length() - 1, mask.bit_count()
        out += [((1 << size // 2) - 1) << low, ((1 << size - size // 2) - 1) << low + size // 2]
    return out


def finer(rows: DataFrame) -> DataFrame:
    """node, fp, key of rows of hot keys (node, fp, key, pair): twenty keys each, by the differences of three halves of the parts that the key leaves open."""
    signed = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
    words = mixed(np.arange(1, 2 + 10 * PER_PART, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).tolist()
    base = words[0]
    to_base = F.bit_count(F.col("fp").bitwiseXOR(signed(base)))
    shown = [F.xxhash64(*[F.bit_count(F.col("fp").bitwiseXOR(signed(base ^ (words[1 + h * PER_PART + k] & mask)))) - to_base for k in range(PER_PART)]) for h, mask in enumerate(halves())]
    picks = []
    for a, b in combinations(range(PARTS), 2):
        open_ = [2 * p + x for p in range(PARTS) if p not in (a, b) for x in (0, 1)]
        picks.append(F.array(*[F.array(*[F.lit(x) for x in c]) for c in combinations(open_, 3)]))
    some = rows.withColumn("shown", F.array(*shown)).withColumn("pick", F.explode(F.get(F.array(*picks), F.col("pair"))))
    at = lambda k: F.get("shown", F.get("pick", F.lit(k)))
    return some.select("node", "fp", F.xxhash64("key", "pick", at(0), at(1), at(2)).alias("key"))


def near(fp: np.ndarray, table: np.ndarray, among: np.ndarray, x: int, radius: int) -> np.ndarray:
    """Which of `among` lie within the radius of x: first by the largest coordinate difference, then by the bits."""
    left = np.flatnonzero(np.abs(table[among] - table[x]).max(axis=1) <= radius)
    return left[np.bitwise_count(fp[among[left]] ^ fp[x]) <= radius]


def forest(node: np.ndarray, fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one key's members; each tree hangs on its smallest node."""
    order = np.argsort(node, kind="stable")
    node, fp = node[order], fp[order]
    base, parts = references()
    picks = [base, *(p[0] for p in parts), *(p[1] for p in parts)]
    table = np.stack([np.bitwise_count(fp ^ np.uint64(r)) for r in picks], axis=1).astype(np.int8)
    out, left = [], np.arange(len(node))
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            hits = near(fp, table, left, queue.pop(), radius)
            if len(hits):
                new = left[hits]
                out += [(int(node[root]), int(node[x])) for x in new]
                queue += new.tolist()
                left = np.delete(left, hits)
    return out


def linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links inside the groups of a partition that is sorted by group; only one group at a time is held."""
    names, held = ("key", "i", "j", "node", "fp"), None

    def found(cols: list[np.ndarray]) -> pa.RecordBatch:
        key, i, j, node, fp = cols
        fp = fp.view(np.uint64)
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
        two = starts[ends - starts == 2]
        two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
        a, b = node[two].tolist(), node[two + 1].tolist()
        for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            for x, y in forest(node[s:e], fp[s:e], radius):
                a.append(x)
                b.append(y)
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    for batch in batches:
        cols = [np.asarray(batch.column(n), dtype=np.int64) for n in names]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        if not len(cols[0]):
            continue
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield found([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield found(held)


def links(nodes: DataFrame, radius: int = RADIUS, chunk: int = 4_096) -> DataFrame:
    """a, b: links that connect all nodes (node, fp) with fingerprints within the radius."""
    if radius >= PARTS - 1:
        raise ValueError(f"two of {PARTS} parts agree only within {PARTS - 2} bits")
    rows = keyed(nodes)
    counted = lambda x: x.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    some = rows.join(counted(rows), "key")
    hot = written(finer(some.filter(F.col("n") > chunk)))
    every = some.filter(F.col("n") <= chunk).select("node", "fp", "key", "n").unionByName(hot.join(counted(hot), "key"))
    met = every.withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "fp")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(partial(linked, radius=radius), "a long, b long")


def classes(docs: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, pick_a, pick_b, fp, component of every row; a class is named by its smallest fingerprint, whatever its ids."""
    rows = checkpointed(fingerprints(picked(docs).select("row.doc_id", "row.text", "pick_a", "pick_b"), size, ("pick_a", "pick_b")))
    found = components(links(rows.select("fp").distinct().withColumn("node", F.col("fp")), radius))
    return rows.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id of every row: the smallest doc_id that links of at most `radius` bits reach."""
    rows = checkpointed(classes(docs, size, radius).select("doc_id", "fp", "component"))
    least = rows.groupBy("component").agg(F.min(F.col("doc_id").cast("long")).alias("component_id"))
    return rows.join(least, "component").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, size: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of each class stays: the one with the smallest doc_id (null last), and of equal ids one text."""
    return one_of_each(docs, classes(docs, size, radius))
