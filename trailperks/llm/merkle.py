"""Merkle manifest of a table: digests of rows, trees of digests, and a proof for every row.

The digests of the rows of a group (their leaves), in the order of a key, are the nodes of a binary tree: while there are
several nodes, every two consecutive ones, and a last one alone, become the SHA-256 of their hexadecimal digests. What
remains is the subroot of the group; the subroots, in the order of the groups, form another tree, whose last node is the root.

No tree is ever in one place. Nodes are ranked in range partitions, and 2^``BLOCK_BITS`` consecutive nodes of a tree are a
superblock, which shrinks to one node wherever it is computed:

1. superblocks send their one node upwards, which are the nodes of the next exchange, until each tree has one node;
2. on the way back, the nodes of a level and the outer nodes that their superblock requires (the path of its own node up
   to the root, one row) are cogrouped by superblock. The function of a cogroup reduces its nodes again, joins their inner
   siblings to the outer ones, and on the level of the leaves folds each presented leaf with its siblings into a root.

So a superblock receives 2^10 digests and one path of some 65 bytes a level; a group with most of the rows is many
superblocks, while groups that are smaller than one share a task. Levels are written to the shared folder.

Defined results: a null value is written ``-``, any other as its number of UTF-8 bytes, a colon and the value. Null groups
come first, then groups by the bytes of their names; a null key comes first; rows with one key are ordered by their digest,
so repeated rows are neighbours whose order cannot matter. A group of one row has its leaf as its subroot, a table of one group
its subroot as its root. An empty table gives an empty result. Columns that are not named take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from trailperks.llm.common import keep, shuffle_partitions

#: Levels of a tree that one superblock holds.
BLOCK_BITS = 10

LEFT, RIGHT, ALONE = "<", ">", ""

PATH = "lower long, tree string, position long, steps array<string>, subroot string, root string"


def leaf_digest(*values: Column) -> Column:
    """The digest of a row: of all its values, each with its length, so no two rows are written alike."""
    texts = [value.cast("string") for value in values]
    written = [
        F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)) for text in texts
    ]
    return F.sha2(F.concat(*written), 256)


def digest(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def height(nodes: int) -> int:
    """Levels between so many nodes and the last one."""
    return (nodes - 1).bit_length()


def reduced(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of a superblock of a tree that has ``total`` nodes, the last one of a single node."""
    levels = [nodes]
    for _ in range(min(BLOCK_BITS, height(total))):
        below = levels[-1]
        levels.append([digest(below[at : at + 2]) for at in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]]) -> list[list[str]]:
    """For each node of the lowest level the steps up to the last one: the side of the sibling and its digest."""
    steps: list[list[str]] = [[] for _ in levels[0]]
    for number, level in enumerate(levels[:-1]):
        beside = [RIGHT + level[at + 1] if at % 2 == 0 else LEFT + level[at - 1] for at in range(len(level) - len(level) % 2)]
        beside += [ALONE] * (len(level) % 2)
        for at, own in enumerate(steps):
            own.append(beside[at >> number])
    return steps


def folded(node: str, steps: list[str]) -> str:
    """The root that a node and its siblings lead to."""
    for step in steps:
        side, other = step[:1], step[1:]
        node = digest([other, node] if side == LEFT else [node, other] if side == RIGHT else [node])
    return node


def superblocks(frame: pd.DataFrame) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """(tree, number, nodes in order) of the superblocks that were dealt to one task together."""
    frame = frame.sort_values(["tree", "position"], ignore_index=True)
    trees, blocks = frame["tree"].to_numpy(), frame["position"].to_numpy() >> BLOCK_BITS
    if len(frame):
        new = np.flatnonzero((trees[1:] != trees[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        for begin, end in zip([0, *new.tolist()], [*new.tolist(), len(frame)]):
            yield trees[begin], int(blocks[begin]), frame.iloc[begin:end]


def up(frame: pd.DataFrame) -> pd.DataFrame:
    """The one node that each superblock becomes."""
    out = []
    for tree, block, nodes in superblocks(frame):
        total = int(nodes["total"].iloc[0])
        last = reduced(nodes["node"].tolist(), total)[-1]
        out.append((tree, block, -(-total >> BLOCK_BITS), *last, nodes["home"].iloc[0]))
    return pd.DataFrame(out, columns=["tree", "position", "total", "node", "lower"])


def joined(frame: pd.DataFrame, paths: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[list[str]], tuple]]:
    """(nodes, their steps to the root, the path they share) for each superblock of a cogroup."""
    outer = {(path.tree, path.position): path for path in paths.itertuples(index=False)}
    for tree, block, nodes in superblocks(frame):
        path = outer[tree, block]
        inner = siblings(reduced(nodes["node"].tolist(), int(nodes["total"].iloc[0])))
        yield nodes, [steps + list(path.steps) for steps in inner], path


def down(frame: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
    """The paths of all nodes of a superblock, from that of its own node."""
    parts = [
        pd.DataFrame(
            {
                "lower": nodes["lower"].to_numpy(), "tree": nodes["tree"].to_numpy(), "position": nodes["position"].to_numpy(),
                "steps": steps, "subroot": path.subroot, "root": path.root,
            }
        )
        for nodes, steps, path in joined(frame, paths)
    ]
    return pd.concat(parts) if parts else pd.DataFrame(columns=["lower", "tree", "position", "steps", "subroot", "root"])


def finish(frame: pd.DataFrame, paths: pd.DataFrame) -> pd.DataFrame:
    """The paths of leaves, and the roots to which the presented leaves lead."""
    parts = [
        pd.DataFrame(
            {
                "key": nodes["key"].array, "tree": nodes["tree"].to_numpy(), "leaf": nodes["node"].to_numpy(),
                "subroot": path.subroot, "root": path.root, "proof": steps,
                "folded_root": [folded(leaf, own) for leaf, own in zip(nodes["presented"], steps)],
            }
        )
        for nodes, steps, path in joined(frame, paths)
    ]
    names = ["key", "tree", "leaf", "subroot", "root", "proof", "folded_root"]
    return pd.concat(parts) if parts else pd.DataFrame(columns=names)


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``position``, the rank among those of their tree, and ``total``, how many these are.

    Rows are numbered inside range partitions; how many rows of a tree lie in the ranges before is a sum over one row per
    tree and range. Equal rows are told apart by a random number, so they fill as many ranges as they need.
    """
    random = F.xxhash64(F.monotonically_increasing_id())
    by = ["tree", *order, "random"]
    ranges = nodes.withColumn("random", random).repartitionByRange(shuffle_partitions(nodes.sparkSession), *by)
    numbered = keep(
        ranges.sortWithinPartitions(*by).drop("random").withColumn("at", F.monotonically_increasing_id()), "merkle-ranks"
    ).withColumn("range", F.shiftright("at", 33))
    tree = Window.partitionBy("tree")
    held = numbered.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    before = F.sum("held").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("held")
    offsets = held.select("tree", "range", (before - F.col("first")).alias("offset"), F.sum("held").over(tree).alias("total"))
    placed = numbered.join(offsets, ["tree", "range"])
    return placed.withColumn("position", F.col("at") + F.col("offset")).drop("at", "range", "offset")


def dealt(nodes: DataFrame, rows: int) -> DataFrame:
    """``home``: the task of a superblock; trees of less than one share tasks of about as many nodes."""
    size = 2**BLOCK_BITS
    block = F.xxhash64("tree", F.shiftright("position", BLOCK_BITS))
    few = F.pmod(F.xxhash64("tree"), F.lit(-(-rows // size) or 1))
    return nodes.withColumn("home", F.when(F.col("total") > size, block).otherwise(few))


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of each exchange; those of the last one are the last nodes of their trees."""
    rows, largest = nodes.agg(F.count("*"), F.max("total")).first()
    levels, largest = [dealt(nodes, rows)], largest or 1
    while True:
        ones = levels[-1].groupBy("home").applyInPandas(up, "tree string, position long, total long, node string, lower long")
        ones = keep(ones, "merkle-nodes")
        levels.append(dealt(ones, ones.count()))
        largest = -(-largest >> BLOCK_BITS)
        if largest == 1:
            return levels


def descend(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the first exchange, or of their superblocks, from those of the last nodes of the trees."""
    for nodes in reversed(levels):
        paths = nodes.groupBy("home").cogroup(paths.groupBy("lower")).applyInPandas(down, PATH)
    return paths


def manifest(docs: DataFrame, leaf: Column, presented: Column | None = None, tree: str = "lang", order: str = "doc_id") -> DataFrame:
    """(key, tree, leaf, subroot, root, proof, folded_root): a row per row of ``docs``.

    ``leaf`` is the digest of a row, ``presented`` the one that is put to the proof (null, or none: the same). ``proof`` has a
    step per level from the leaf to the root: ``<`` or ``>`` and the digest on the left or right, or an empty text where a node has
    no sibling. ``key`` is the column ``order``.
    """
    name = F.when(F.col(tree).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    shown = leaf if presented is None else F.coalesce(presented, leaf)
    leaves = docs.select(name.alias("tree"), F.col(order).alias("key"), leaf.alias("node"), shown.alias("presented"))
    leaves = keep(leaves, "merkle-leaves")  # read once: what follows moves digests only
    # As text, because pandas has no integers beside nulls.
    levels = climb(ranked(leaves, ["key", "node"]).withColumn("key", F.col("key").cast("string")))

    # The subroots are the leaves of the outer tree; the names of their groups order them.
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node", "lower")
    inner = ranked(subroots, ["name"])
    outer = climb(inner)
    roots = outer[-1].select(
        "lower", "tree", "position", F.array().cast("array<string>").alias("steps"), F.lit("").alias("subroot"),
        F.col("node").alias("root"),
    )
    above = descend(outer[:-1], roots).select("position", "steps", "root")
    tops = inner.join(above, "position").select(
        "lower", F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "steps", F.col("node").alias("subroot"), "root"
    )
    paths = keep(descend(levels[1:-1], tops), "merkle-paths")
    proved = levels[0].groupBy("home").cogroup(paths.groupBy("lower")).applyInPandas(
        finish, "key string, tree string, leaf string, subroot string, root string, proof array<string>, folded_root string"
    )
    group = F.when(F.col("tree") != "-", F.substring("tree", 2, 2**31 - 1))
    return proved.withColumns({"key": F.col("key").cast(docs.schema[order].dataType), "tree": group})


def proof_digest(proof: Column) -> Column:
    """The SHA-256 of all siblings of a proof, from the lowest level up."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.substring(step, 2, 64)), ""), 256)
