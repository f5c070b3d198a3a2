"""Merkle manifest of a table of documents, by time-forward processing.

Nodes are labelled (level, tree, index). A digest is a message to the node's parent, and the queue that delivers messages in
the order of their labels is external memory: a written table per level, shuffled and sorted by label by Spark. A round takes
all messages of the lowest level out of the queue, which cannot depend on each other, and puts one message for each receiving
node back in. A second sweep runs the labels backwards: each node receives the proof suffix from itself to the root, puts
its children's digests before it and delivers it to them; what reaches a leaf is its whole proof.

Each value of lang is a tree over its documents, ascending by doc_id; the roots of these trees are the leaves of one more
tree. While a level has several nodes, every `FAN` consecutive ones become the hash of their digests. A level has an eighth of the
rows of the one below, so the sweeps shuffle little more than the leaves, and no task holds more than one run of a node. Positions are taken
from a range partitioning, whose parts number their own rows; only one row for each part and tree is summed up.

Edge cases: a null lang is a tree of its own, first of all; null ids come first in their tree, and documents that share an id
are ordered by leaf digest. Rows that are equal in all five fields are counted before they are sorted and take consecutive places in
any order; long runs of them are dealt out by place before they are spread. A lone leaf is its tree's root. An empty table has no rows.
Other columns are ignored. A null id has no decimal text, so the query never tampers with such a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

FAN = 8
#: A run of equal rows longer than this is spread in two steps.
SPREAD = 4_096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest of a document that holds `text`."""
    return F.sha2(F.concat(*[encoded(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], encoded(text)), 256)


def joined_digest(digests: Column) -> Column:
    return F.sha2(F.concat_ws("", digests), 256)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, copies, ...) with `n`, the rows of their tree, and `index`, the place of a row's first copy in its tree.

    The rows must be distinct in tree and `order`. A part of the range partitioning numbers its own rows, and the parts of a tree are summed up beside it.
    """
    parts = written(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "tree").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = parts.groupBy("part", "tree").agg(F.sum("copies").alias("held"))
    upto = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.withColumn("start", F.sum("held").over(upto) - F.col("held")).withColumn("n", F.sum("held").over(Window.partitionBy("tree"))).drop("held")
    numbered = parts.withColumn("before", F.sum("copies").over(inside) - F.col("copies"))
    return numbered.join(starts, ["part", "tree"]).withColumn("index", F.col("start") + F.col("before")).drop("part", "start", "before")


def spread(rows: DataFrame) -> DataFrame:
    """One row for each copy, with its own index; a long run is dealt out by stretches of places first."""
    last = F.col("index") + F.col("copies") - 1
    short = rows.filter(F.col("copies") <= SPREAD).withColumn("index", F.explode(F.sequence("index", last)))
    stretches = rows.filter(F.col("copies") > SPREAD).withColumn("last", last).withColumn("from", F.explode(F.sequence(F.col("index"), F.col("last"), F.lit(SPREAD).cast("long"))))
    long = stretches.repartition("tree", "from").withColumn("index", F.explode(F.sequence("from", F.least(F.col("last"), F.col("from") + SPREAD - 1))))
    return short.unionByName(long.drop("from", "last")).drop("copies")


def swept_up(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The node tables of all levels (tree, index, children, digest) and the roots (tree, height, digest) of leaves (tree, n, index, digest, row)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    level, levels, roots = leaves, [], leaves.filter("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    while most > 1:
        delivered = level.filter("n > 1").withColumn("parent", F.floor(F.col("index") / FAN))
        children = F.array_sort(F.collect_list(F.struct("index", "digest", *(["row"] if "row" in level.columns else []))))
        nodes = delivered.groupBy("tree", "n", "parent").agg(children.alias("children"))
        nodes = written(nodes.select("tree", F.ceil(F.col("n") / FAN).alias("n"), F.col("parent").alias("index"), "children", joined_digest(F.col("children.digest")).alias("digest")))
        levels.append(nodes)
        level, most = nodes.drop("children"), -(-most // FAN)
        roots = roots.union(level.filter("n = 1").select("tree", F.lit(len(levels)).alias("height"), "digest"))
    return levels, roots


def swept_down(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame) -> DataFrame:
    """digest, row, subroot, path of every leaf; roots are (tree, height, digest, path)."""
    steps = "array<struct<place:int,siblings:array<string>>>"
    arrive = lambda height: roots.filter(F.col("height") == height)
    lone = leaves.filter("n = 1").select("tree", "row").join(arrive(0), "tree").select("digest", "row", F.col("digest").alias("subroot"), "path")
    held = None
    for height in range(len(levels), 0, -1):
        here = arrive(height).select("tree", F.lit(0).cast("long").alias("index"), F.col("digest").alias("subroot"), "path")
        held = here if held is None else held.unionByName(here)
        nodes = levels[height - 1].select("tree", "index", "children").join(held, ["tree", "index"])
        spread_out = nodes.select("tree", "subroot", "path", F.col("children.digest").alias("digests"), F.posexplode("children").alias("place", "child"))
        own = F.struct("place", F.filter("digests", lambda _, k: k != F.col("place")).alias("siblings"))
        held = spread_out.select("tree", F.col("child.index").alias("index"), F.col("child").alias("child"), "subroot", F.concat(F.array(own), "path").cast(steps).alias("path"))
        if height > 1:
            held = held.drop("child")
    if held is None:
        return lone
    return held.select("child.digest", "child.row", "subroot", "path").unionByName(lone)


def proofs(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """doc_id, leaf, claimed_leaf, subroot, root, path for every row of docs.

    path has one step for each level up to the root: the leaf's or node's place in its run and the digests of the run's other members.
    claimed_leaf is the digest of the row with the text `claimed` in place of its own, or null where `claimed` is null.
    """
    other = F.when(claimed.isNotNull(), leaf(claimed)) if claimed is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0"))  # null before all values, which keep their bytewise order
    rows = docs.select(tree.alias("tree"), "doc_id", leaf(F.col("text")).alias("digest"), other.alias("claimed_leaf"))
    rows = rows.groupBy("tree", "doc_id", "digest").agg(F.count(F.lit(1)).alias("copies"), F.first("claimed_leaf").alias("claimed_leaf"))
    places = spread(placed(rows, ["doc_id", "digest"]))
    leaves = written(places.select("tree", "n", "index", "digest", F.struct("doc_id", "claimed_leaf").alias("row")))
    levels, subroots = swept_up(leaves)

    tops = subroots.select(F.lit("").alias("tree"), "digest", F.struct(F.col("tree").alias("tree"), "height").alias("row"), F.lit(1).cast("long").alias("copies"))
    tops = written(placed(tops, ["row"]).select("tree", "n", "index", "digest", "row"))
    top_levels, top = swept_up(tops)
    top = top.withColumn("path", F.array().cast("array<struct<place:int,siblings:array<string>>>"))
    root = (top.first() or {"digest": None})["digest"]
    delivered = written(swept_down(tops, top_levels, top).select("row.tree", "row.height", "digest", "path"))
    found = swept_down(leaves, levels, delivered)
    return found.select("row.doc_id", F.col("digest").alias("leaf"), "row.claimed_leaf", "subroot", F.lit(root).alias("root"), "path")


def folded(start: Column, path: Column) -> Column:
    """The root that a digest and a path lead to."""

    def up(digest: Column, step: Column) -> Column:
        before = F.slice(step["siblings"], F.lit(1), step["place"])
        after = F.slice(step["siblings"], step["place"] + 1, F.lit(FAN))
        return joined_digest(F.concat(before, F.array(digest), after))

    return F.aggregate(path, start, up)


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of docs, checked against copies of which about a third have A-Z of their text in lower case."""
    chosen = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    found = proofs(docs, F.when(chosen, F.translate("text", UPPER, LOWER)))
    again = folded(F.coalesce("claimed_leaf", "leaf"), F.col("path"))
    proof = F.sha2(F.concat_ws("", F.flatten(F.col("path.siblings"))), 256)
    out = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
