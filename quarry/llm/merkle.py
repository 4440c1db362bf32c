"""Merkle manifest of a dataset: one tree per group of rows, one more over the groups' roots.

A row's leaf is the SHA-256 of its columns, each ``-`` if null, else its number
of UTF-8 bytes, ``:`` and its value; a node is the SHA-256 of its children's
hex digests, of which the last node of a level may have one only.

The leaves of a group ascend by id.  They are numbered by range partitions and
prefix counts (a group with all rows is spread like any other) and cut into
aligned blocks of 2**``HEIGHT`` leaves.  A block is a subtree of its own: its
digests lie in one byte array in van Emde Boas order, i.e. the tree is split at
half its height, the upper tree comes first, then each lower tree, each stored
the same way; ``addresses`` computes a node's place from its depth and number.
Block roots are the leaves of the next level of blocks, until a group is one
block; the groups' roots, by name, are the leaves of the last tree.

Proofs come from above: each block hands every child the path from its root to
the dataset's root, so a leaf needs its own block and one path.  No task holds
more than a block, its leaves and their paths; the driver sees counts of blocks.

Defined results: a null group is a group of its own, before all others; rows
without id come first in their group, rows that agree in it go by their leaf;
equal rows have leaves of their own.  An empty table has no rows and no root.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import frozen

#: Levels of a full block above its leaves.
HEIGHT = 10
#: A step of a path: which side the sibling is on (0: no sibling, 1: left, 2: right), and its digest.
STEP = 33

TREE = ""  # the group of the tree over all groups; names of groups begin with 0 or 1


def described(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (binary) of the columns' descriptions."""
    return F.unhex(F.sha2(F.concat(*[described(c) for c in columns]), 256))


def addresses(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Places of nodes ``number`` at ``depth`` (root: 0) in a tree of ``levels`` levels in van Emde Boas order."""
    place = np.zeros(len(number), np.int64)
    number = number.astype(np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        levels, depth = levels - upper, depth - upper
        place += (1 << upper) - 1 + (number >> depth) * ((1 << levels) - 1)
        number &= (1 << depth) - 1
    return place


class Block:
    """Digests of an aligned subtree in van Emde Boas order."""

    def __init__(self, size: int, height: int, nodes: np.ndarray):
        self.height, self.nodes = height, nodes
        self.sizes = [-(-size // (1 << height - d)) for d in range(height + 1)]  # nodes at each depth

    @classmethod
    def built(cls, leaves: np.ndarray, height: int) -> Block:
        """From the leaves' digests (n rows of 32 bytes), up to one root ``height`` levels above."""
        block = cls(len(leaves), height, np.zeros(((2 << height) - 1, 32), np.uint8))
        below = leaves
        block.nodes[addresses(height + 1, height, np.arange(len(leaves)))] = leaves
        for depth in range(height - 1, -1, -1):
            text = below.tobytes().hex().encode()
            below = np.frombuffer(b"".join([sha256(text[k:k + 128]).digest() for k in range(0, len(text), 128)]), np.uint8).reshape(-1, 32)
            block.nodes[addresses(height + 1, depth, np.arange(len(below)))] = below
        return block

    @classmethod
    def stored(cls, row: dict) -> Block:
        return cls(row["size"], row["height"], np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32))

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def paths(self, leaves: np.ndarray) -> np.ndarray:
        """The steps from each leaf to the root, ``STEP`` bytes each."""
        steps = np.zeros((len(leaves), self.height, STEP), np.uint8)
        for depth in range(self.height, 0, -1):
            number = leaves >> (self.height - depth)
            there = np.flatnonzero((number ^ 1) < self.sizes[depth])
            own, k = number[there], self.height - depth
            steps[there, k, 0] = 2 - (own & 1)
            steps[there, k, 1:] = self.nodes[addresses(self.height + 1, depth, own ^ 1)]
        return steps.reshape(len(leaves), -1)


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path make."""
    x = leaf
    for k in range(0, len(path), STEP):
        sibling = path[k + 1:k + STEP]
        parts = x if path[k] == 0 else sibling + x if path[k] == 1 else x + sibling
        x = sha256(parts.hex().encode()).digest()
    return x


def proof_digest(path: bytes) -> bytes:
    """SHA-256 of a path's siblings, as hex digests in order."""
    return sha256("".join([path[k + 1:k + STEP].hex() for k in range(0, len(path), STEP) if path[k]]).encode()).digest()


class Manifest(NamedTuple):
    """``leaves``: (row, id, group, pos, total, digest, claims); ``levels``: blocks (group, block, size, total, height, top, nodes),
    those of the leaves first; ``tree``: the same over the groups' roots; ``names``: (group, pos) of that tree's leaves."""

    leaves: DataFrame
    levels: list[DataFrame]
    tree: list[DataFrame]
    names: DataFrame
    height: int


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (group, ...) with ``pos``, their places from 0 in ``order`` within their group (nulls first), and ``total``, the group's rows.  ``rows`` must be frozen."""
    sliced = frozen(rows.repartitionByRange("group", *order).withColumn("slice", F.spark_partition_id()), "merkle-slices")
    upto = Window.partitionBy("group").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy("group", "slice").count().select("group", "slice", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"),
                                                             F.sum("count").over(Window.partitionBy("group")).alias("total"))
    inside = Window.partitionBy("group", "slice").orderBy(*order)
    placed = sliced.withColumn("nth", F.row_number().over(inside) - 1).join(before, ["group", "slice"])
    return placed.withColumn("pos", F.col("nth") + F.col("before")).drop("nth", "before", "slice")


_BLOCKS = "group string, block long, size long, total long, height int, top boolean, nodes binary"


def _build(height: int):
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table["total"][0].as_py()
        top = total <= 1 << height
        levels = (total - 1).bit_length() if top else height
        leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
        block = Block.built(leaves, levels)
        return pa.table({"group": table["group"][:1], "block": pa.array([table["pos"][0].as_py() >> height], pa.int64()), "size": pa.array([len(leaves)], pa.int64()), "total": pa.array([total], pa.int64()),
                         "height": pa.array([levels], pa.int32()), "top": pa.array([top]), "nodes": pa.array([block.nodes.tobytes()], pa.binary())})

    return build


def forest(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Levels of blocks over ``leaves`` (group, pos, digest, total), until every group has one block."""
    levels: list[DataFrame] = []
    while not levels or not levels[-1].filter("not top").isEmpty():
        made = leaves.select("group", "pos", "digest", "total").groupBy("group", F.floor(F.col("pos") / (1 << height)).alias("number")).applyInArrow(_build(height), _BLOCKS)
        levels.append(frozen(made, "merkle-blocks"))
        leaves = levels[-1].filter("not top").select("group", F.col("block").alias("pos"), F.substring("nodes", 1, 32).alias("digest"), F.ceil(F.col("total") / (1 << height)).alias("total"))
    return levels


def manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """Manifest of ``rows`` (row, id, group, digest, and claims of the caller): ``row`` tells rows apart, ``group`` isn't null."""
    leaves = frozen(ranked(frozen(rows, "merkle-rows"), ["id", "digest", "row"]), "merkle-leaves")
    levels = forest(leaves, height)
    roots = [b.filter("top").select(F.lit(TREE).alias("group"), F.col("group").alias("name"), F.substring("nodes", 1, 32).alias("digest")) for b in levels]
    names = roots[0]
    for more in roots[1:]:
        names = names.union(more)
    names = frozen(ranked(frozen(names, "merkle-roots"), ["name"]), "merkle-names")
    return Manifest(leaves, levels, forest(names, height), names, height)


_PATHS = "of string, number long, path binary, subroot binary, root binary"


def _hand_down(keep_subroot: bool, height: int):
    """From a block and the path above it: the path above each of its leaves, by the leaf's place in the group."""
    def paths(table: pa.Table) -> pa.Table:
        (r,) = table.to_pylist()
        block, places = Block.stored(r), np.arange(r["size"])
        n, above = len(places), r["path"] or b""
        leaves = block.nodes[addresses(block.height + 1, block.height, places)]
        return pa.table({"of": pa.array([r["group"]] * n, pa.string()), "number": pa.array((r["block"] << height) + places),
                         "path": pa.array([p.tobytes() + above for p in block.paths(places)], pa.binary()),
                         "subroot": pa.array([r["subroot"]] * n if keep_subroot else [x.tobytes() for x in leaves], pa.binary()),
                         "root": pa.array([r["root"] or block.root] * n, pa.binary())})

    return lambda blocks: blocks.groupBy("group", "block").applyInArrow(paths, _PATHS)


def _above(levels: list[DataFrame], tops: DataFrame | None, height: int) -> list[DataFrame]:
    """For each level, its blocks with the path above them, the subroot and the root; ``tops``: those of whole groups (of, path, subroot, root)."""
    out: list[DataFrame] = []
    handed = None
    for level in reversed(levels):
        if handed is not None:
            handed = frozen(_hand_down(tops is not None, height)(out[-1]), "merkle-paths")
            inner = level.filter("not top").join(handed, (F.col("group") == F.col("of")) & (F.col("number") == F.col("block"))).drop("of", "number")
        top = level.filter("top")
        whole = top.join(tops, F.col("group") == F.col("of")).drop("of") if tops is not None else top.select("*", *[F.lit(None).cast("binary").alias(c) for c in ("path", "subroot", "root")])
        out.append(whole if handed is None else whole.unionByName(inner))
        handed = out[-1]
    return out[::-1]


def _verify(height: int, claim: str):
    def verify(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        (r,) = blocks.to_pylist()
        paths = [p.tobytes() + (r["path"] or b"") for p in Block.stored(r).paths(leaves["pos"].to_numpy() & ((1 << height) - 1))]
        n = len(paths)
        return pa.table({"row": leaves["row"], "id": leaves["id"], "group": leaves["group"], "leaf": leaves["digest"],
                         "subroot": pa.array([r["subroot"]] * n, pa.binary()), "root": pa.array([r["root"]] * n, pa.binary()),
                         "path": pa.array(paths, pa.binary()), "proof": pa.array([proof_digest(p) for p in paths], pa.binary()),
                         "folded": pa.array([folded(x, p) for x, p in zip(leaves[claim].to_pylist(), paths, strict=True)], pa.binary())})

    return verify


def proofs(m: Manifest, claim: str = "digest") -> DataFrame:
    """Per leaf: row, id, group, leaf, subroot, root, path, proof (digest of its siblings) and folded, the root that ``claim`` and the path make."""
    height = m.height
    by_number = _hand_down(False, height)(_above(m.tree, None, height)[0])
    tops = frozen(by_number.join(m.names.select("pos", "name"), F.col("number") == F.col("pos")).select(F.col("name").alias("of"), "path", "subroot", "root"), "merkle-tops")
    left = m.leaves.withColumn("number", F.floor(F.col("pos") / (1 << height))).groupBy("group", "number")
    right = _above(m.levels, tops, height)[0].withColumn("number", F.col("block")).groupBy("group", "number")
    kind = m.leaves.schema["id"].dataType.simpleString()
    return left.cogroup(right).applyInArrow(_verify(height, claim), f"row long, id {kind}, group string, leaf binary, subroot binary, root binary, path binary, proof binary, folded binary")


def document_rows(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "lang", claims: dict[str, dict[str, Column]] | None = None) -> DataFrame:
    """Rows for ``manifest``, with the leaf of ``columns`` in this order; ``claims``: digests in which some columns have other values."""
    cells = {c: F.col(f"`{c}`") for c in columns}
    more = [leaf_digest([other.get(c, cells[c]) for c in columns]).alias(name) for name, other in (claims or {}).items()]
    # names sort null first, then as the text's bytes
    group = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group_col}`").cast("string")), F.lit("0"))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), group.alias("group"), leaf_digest(list(cells.values())).alias("digest"), *more)
