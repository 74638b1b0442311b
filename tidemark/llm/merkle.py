"""Merkle manifest of a table of documents: a tree of threes for each source, and one over the sources.

The nodes of a tree are numbered in order and dealt into aligned blocks of 3^k. A block keeps each of its levels as one string of
64-character digests: substrings of three digests hash to the next level, and what flanks a digest in its three are the
siblings of a proof. The digests on top of the blocks are the nodes of the next round, until a tree fits into one block;
the tops of all trees are the leaves of the last tree. On the way back each block gets the siblings above it once, for all its
nodes. No step holds more than a block, whatever the size of a source.

A digest is the lower-case hex SHA-256 of its inputs' concatenation, in which digests stand as hex text. Rows of one
source and id are ordered by their leaves; equal rows are leaves of their own. A null source comes first, and a null id first in its
source. An empty table has no rows and no root. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.helpers import cut

#: Children of a node.
RUN = 3
#: Levels of a block, and its nodes on the lowest one.
LEVELS = 5
WIDTH = RUN**LEVELS
DIGEST = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """The digest of a row's fields, some of them changed."""
    return sha256(*[_field(changed.get(name, F.col(name))) for name in FIELDS])


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """`rows` with their place `at` (from 0) in the group and the group's size `n`; columns of `order` are not null or come first.

    All rows are sorted over the cluster by (group, order) once and kept; a row's place follows from its place in its partition and
    the counts of the partitions before. A large group lies in many partitions. Rows that are equal in all are told apart by where they
    were read.
    """
    told = rows.withColumn("_read", F.monotonically_increasing_id())
    by = [group, *order, "_read"]
    kept = cut(told.repartitionByRange(*by).sortWithinPartitions(*by).drop("_read"))
    placed = kept.withColumn("_place", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    counts = placed.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    within = Window.partitionBy(group)  # a row for each partition that holds the group
    before = within.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"), F.sum("_n").over(within).alias("n")
    )
    joined = placed.join(starts, [group, "_part"])
    return joined.select(*rows.columns, (F.col("_place") + F.col("_start")).alias("at"), "n")


def levels(lowest: Column, whole: Column) -> Column:
    """The levels of a block from the lowest up, each as one string.

    `whole` tells that the block is a whole tree, which ends with its first level of one digest; others have all levels.
    """

    def above(level: Column) -> Column:
        runs = F.ceil(F.length(level) / (DIGEST * RUN)).cast("int")
        digests = F.transform(
            F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(level.substr(i * (DIGEST * RUN) + 1, F.lit(DIGEST * RUN)), 256)
        )
        return F.array_join(digests, "")

    def climb(done: Column, _: Column) -> Column:
        level = F.element_at(done, -1)
        return F.when(whole & (F.length(level) <= DIGEST), done).otherwise(F.concat(done, F.array(above(level))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array(lowest), climb)


def siblings(block: Column, place: Column) -> Column:
    """Of the node at `place` of a block's lowest level: what stands left and right of its ancestors in their threes, from below to the block's top."""

    def beside(level: Column, j: Column) -> Column:
        node = F.floor(place / F.pow(F.lit(RUN), j)).cast("int")
        first = node - node % RUN
        return F.struct(
            level.substr(first * DIGEST + 1, (node - first) * DIGEST).alias("left"),
            level.substr((node + 1) * DIGEST + 1, (first + RUN - 1 - node) * DIGEST).alias("right"),
        )

    return F.slice(F.transform(block, beside), 1, F.size(block) - 1)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, digest, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _blocks(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """(tree, n, block, nodes): the nodes of each aligned block in order."""
    block = F.floor(F.col("at") / WIDTH)
    grouped = nodes.groupBy("tree", "n", block.alias("block"))
    return grouped.agg(F.array_sort(F.collect_list(F.struct("at", "hash", *carried))).alias("nodes"))


def _block_levels() -> Column:
    return levels(F.array_join(F.col("nodes.hash"), ""), F.col("n") <= WIDTH)


def _climb(nodes: DataFrame, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round from the leaves up, and the top of each tree: (tree, turn, hash)."""
    rounds, tops = [], None
    while True:
        blocks = cut(_blocks(nodes, carried if not rounds else ()).withColumn("top", F.element_at(_block_levels(), -1)))
        done = blocks.where(F.col("n") <= WIDTH).select("tree", F.lit(len(rounds)).alias("turn"), F.col("top").alias("hash"))
        tops = done if tops is None else tops.unionByName(done)
        rounds.append(blocks)
        further = blocks.where(F.col("n") > WIDTH)
        if further.isEmpty():
            return rounds, tops
        nodes = further.select("tree", F.col("block").alias("at"), F.ceil(F.col("n") / WIDTH).alias("n"), F.col("top").alias("hash"))


def _descend(rounds: list[DataFrame], tops: DataFrame, told: Sequence[str]) -> DataFrame:
    """The leaves with their whole paths. `tops` holds the path above each tree, its round, and the columns `told` to all its leaves."""
    above = None
    for turn in reversed(range(len(rounds))):
        here = tops.where(F.col("turn") == turn).select("tree", F.lit(0).cast("long").alias("block"), "path", *told)
        if above is not None:
            here = here.unionByName(above.select("tree", F.col("node.at").alias("block"), "path", *told))
        joined = rounds[turn].join(here, ["tree", "block"]).withColumn("levels", _block_levels())
        each = joined.select("tree", "block", "levels", F.explode("nodes").alias("node"), F.col("path").alias("further"), *told)
        place = (F.col("node.at") - F.col("block") * WIDTH).cast("int")
        above = each.select("tree", "node", F.concat(siblings(F.col("levels"), place), F.col("further")).alias("path"), *told)
    return above


def _tree_of(source: Column) -> Column:
    """A text that is never null and sorts as the source does, null first."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _trees(leaves: DataFrame, carried: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of the sources' trees, and of each tree (tree, turn, subroot, root, path): its top and the path above it."""
    rounds, tops = _climb(numbered(leaves, "tree", ["doc_id", "hash"]), carried)
    sources = numbered(tops.withColumn("one", F.lit("")), "one", ["tree"])
    forest, root = _climb(sources.select(F.lit("").alias("tree"), "at", "n", "hash", F.col("tree").alias("branch"), "turn"), ["branch", "turn"])
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    branches = _descend(forest, root.select("tree", "turn", nothing.alias("path"), F.col("hash").alias("root")), ["root"])
    return rounds, cut(branches.select("node.branch", "node.turn", F.col("node.hash").alias("subroot"), "root", "path").withColumnRenamed("branch", "tree"))


def _leaves(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tree_of(F.col("source")).alias("tree"), leaf().alias("hash"), *more)


def manifest(docs: DataFrame) -> DataFrame:
    """(source, subroot, root): the top of each source's tree, and the root over all."""
    _, branches = _trees(_leaves(docs), ["doc_id"])
    return branches.select(F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source"), "subroot", "root")


def proofs(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, changed): each row's leaf with its siblings up to the root.

    `path` holds what stands left and right on each level, from below. `changed` is another leaf of the row, carried along.
    """
    other = F.lit(None).cast("string") if changed is None else changed
    rounds, branches = _trees(_leaves(docs, other.alias("changed")), ["doc_id", "changed"])
    found = _descend(rounds, branches, ["subroot", "root"])
    return found.select("node.doc_id", F.col("node.hash").alias("leaf"), "subroot", "root", "path", "node.changed")


def tampered_leaf() -> Column:
    """The leaf after every line feed is deleted from the text, of rows whose decimal id has an even checksum; else null, as if the text has none."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    without = F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))
    return F.when(even & F.col("text").contains("\n"), leaf(text=without))


def verify_tampered(docs: DataFrame) -> DataFrame:
    """Each row's proof, and whether the root still follows after the tampering of `tampered_leaf`."""
    found = proofs(docs, tampered_leaf()).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
