"""Merkle manifest of a table: subtree roots, one root, a proof for every row, and checks against it.

Rows become leaves (SHA-256 of their encoded columns), ordered within their
tree. On every level each node meets the other nodes of its run by an equijoin
on computed sibling indices (index XOR 1 for runs of two, slot offsets for
longer ones); the nodes in slot zero, which then know their whole run, emit the
parents. The roots of all trees are the leaves of a last tree over the trees.
Going down again, a node's path is what its run holds besides itself, and then
its parent's path.

Built-in functions only. Joins go by (tree, index), so a tree that holds most
rows is spread like any other; no level is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillsieve.runtime import materialize

# Levels of a tree whose paths are joined before they are stored.
DOWN_LEVELS = 4
# Keys that the rows of a sorted partition are dealt to.
SALTS = 32
HASH = 256
# Of a path: what a run holds before and after the node, level by level upwards.
STEP = "struct<before:string,after:string>"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text, HASH)


def field(value: Column) -> Column:
    """A value so that fields can be concatenated without ambiguity: ``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Stored ``rows`` with ``index`` (0, 1, ... within ``tree`` by ``order``, nulls first) and ``nodes``, the tree's size.

    Rows are sorted by range; a row's index is its place in its partition plus
    the rows of its tree in earlier partitions. A row number breaks ties, so
    that equal rows do not crowd one partition; which of them comes first is
    not defined, and makes no difference if they are equal throughout.
    """
    marked = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    keys = [tree, *order, "_row"]
    placed = (
        marked.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    placed = materialize(placed.drop("_row"), "ordered")
    # One row for each partition and tree that meet: partitions + trees at most.
    sizes = placed.groupBy("_part", tree).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "_part", tree,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"),
        F.sum("_n").over(Window.partitionBy(tree)).alias("nodes"),
    )
    # A partition's rows are dealt to many keys: one may hold much of a tree.
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    bases = bases.withColumn("_salt", F.explode(salts))
    joined = placed.withColumn("_salt", F.col("_place") % SALTS).join(bases, ["_part", tree, "_salt"])
    return joined.select(*rows.columns, (F.col("_base") + F.col("_place")).alias("index"), "nodes")


@dataclass
class Forest:
    """Stored levels of one or more trees, from the leaves up, and their roots."""

    levels: list[DataFrame]  # tree, index, nodes, hash, before, after (and what the leaves carry)
    roots: DataFrame  # tree, hash
    fanout: int

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """The leaves with ``path``, an array of (before, after) from their level up to the root.

        ``above`` (tree and further columns, one of them ``path``) goes on from
        each root; its other columns are handed down to the leaves.
        """
        down = None
        more = [f"`{c}`" for c in above.columns if c not in ("tree", "path")] if above is not None else []
        for n in range(len(self.levels) - 1, -1, -1):
            level = self.levels[n]
            ended = level.where("nodes = 1")
            ended = ended.selectExpr("*", f"cast(array() as array<{STEP}>) AS path") if above is None else ended.join(above, "tree")
            if down is not None:
                parents = down.selectExpr("tree", "index AS _up", "path AS _path", *more)
                inner = level.where("nodes > 1").selectExpr("*", f"index div {self.fanout} AS _up").join(parents, ["tree", "_up"])
                columns = [f"`{c}`" for c in ended.columns if c != "path"]
                inner = inner.selectExpr(*columns, "concat(array(struct(before, after)), _path) AS path")
                ended = inner.unionByName(ended)
            down = materialize(ended, "paths") if n and n % DOWN_LEVELS == 0 else ended
        return down


def climb(nodes: DataFrame, fanout: int = 2) -> Forest:
    """All levels above ``nodes`` (tree, index, nodes, hash; further columns stay with the leaves).

    Every ``fanout`` consecutive nodes (the last run: fewer, even one) become the
    hash of their concatenation, until one node remains.
    """
    if fanout < 2:
        raise ValueError("a run has at least two nodes")
    level, size = nodes, nodes.agg(F.max("nodes")).first()[0] or 0
    levels, roots = [], None
    own = f"(index % {fanout})"
    # One column for each sibling: by XOR in runs of two, else by the offset from the node's own slot.
    siblings = {f"_s{o}": f"index - {own} + ({own} + {o}) % {fanout}" for o in range(1, fanout)}
    if fanout == 2:
        siblings = {"_s1": "index ^ 1"}
    run = f"array({', '.join(siblings)})"
    kept = [f"`{c}`" for c in nodes.columns if c not in ("tree", "index", "nodes", "hash")]
    while True:
        met = level
        for name, index in siblings.items():
            offered = level.where("nodes > 1").selectExpr("tree", "index AS _sibling", f"hash AS {name}")
            met = met.selectExpr("*", f"{index} AS _sibling").join(offered, ["tree", "_sibling"], "left").drop("_sibling")
        # Offsets 1, 2, ... are the slots after the node's own, then those before it.
        met = met.selectExpr(
            "tree", "index", "nodes", "hash", *(kept if not levels else []),
            f"array_join(slice({run}, int({fanout} - {own}), int({own})), '') AS before",
            f"array_join(slice({run}, 1, int({fanout} - 1 - {own})), '') AS after",
        )
        stored = materialize(met, "level")
        levels.append(stored)
        done = stored.where("nodes = 1").select("tree", "hash")
        roots = done if roots is None else roots.unionByName(done)
        if size <= 1:
            return Forest(levels, roots, fanout)
        size = -(-size // fanout)
        level = stored.where(f"nodes > 1 and {own} = 0").selectExpr(
            "tree", f"index div {fanout} AS index", f"(nodes + {fanout - 1}) div {fanout} AS nodes",
            f"sha2(concat(hash, after), {HASH}) AS hash",
        )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda own, step: digest(F.concat(step["before"], own, step["after"])))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(
    rows: DataFrame, tree: Column, order: Sequence[str], values: Sequence[str], carried: Sequence[str] = (), fanout: int = 2
) -> DataFrame:
    """Every row's leaf, its tree's root, the root of all, and its path to it.

    Returns the ``carried`` columns, leaf, subroot, root, path (array of before
    and after; lower-case hex digests). ``values`` are hashed in that order;
    ``order`` sorts the leaves of a tree (nulls first; leaf hashes break ties).
    Trees are ordered by the value of ``tree``, null first, else by its UTF-8
    bytes. Equal rows are leaves each. A null value is a field like any other,
    an empty text differs from it. An empty table has no root and gives no rows.
    Other columns of ``rows`` play no part; carried ones must not be named like
    the results.
    """
    taken = {"leaf", "subroot", "root", "path"} & set(carried)
    if taken:
        raise ValueError(f"columns with reserved names: {sorted(taken)}")
    leaves = rows.select(
        field(tree).alias("tree"),
        F.struct(*order).alias("_order"),
        leaf_hash(*map(F.col, values)).alias("hash"),
        F.struct(F.lit(True).alias("_kept"), *carried).alias("_carried"),
    )
    placed = ranked(leaves, "tree", ["_order", "hash"]).drop("_order")
    subtrees = climb(placed, fanout)
    # Trees are ordered by their names, not by the encoding of these.
    names = rows.select(field(tree).alias("tree"), tree.cast("string").alias("name")).distinct()
    named = subtrees.roots.join(names, "tree").select(F.lit("").alias("tree"), F.col("tree").alias("own"), "name", "hash")
    whole = climb(ranked(named, "tree", ["name"]), fanout)
    # One row, or none.
    found = whole.roots.select("hash").first()
    root = F.lit(found.hash if found else None).cast("string")
    above = whole.paths().select(F.col("own").alias("tree"), F.col("hash").alias("subroot"), "path")
    traced = subtrees.paths(materialize(above, "subroots"))
    return traced.select(
        *(F.col("_carried")[c].alias(c) for c in carried), F.col("hash").alias("leaf"), "subroot", root.alias("root"), "path"
    )
