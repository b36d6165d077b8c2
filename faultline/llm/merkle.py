"""Merkle manifest of a dataset in the van Emde Boas layout (operator 13).

Every source is a tree over its rows in the order of their ids, and the
dataset is a tree over the sources' roots.  A tree is cut into aligned
subtrees of at most BLOCK_LEVELS levels.  A subtree is one row: its digests in
one array, laid out by splitting the subtree at half height again and again,
top part first, so that any path lies in few runs of neighbouring bytes.
Positions in that array are plain arithmetic (``veb_address``); building a
subtree and reading the siblings of a leaf both go through them.  The roots of
the subtrees are the leaves of the next tier, and so on to the root.

Rows are numbered inside their source by range sort and prefix counts, so a
source of any share is spread over all tasks; a task holds one subtree at a
time.  Paths come down tier by tier in joins on the subtree's number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .arrays import remembered
from .frames import add_columns, written

ARITY = 3
BLOCK_LEVELS = 6  # a subtree has at most 3**6 leaves and 1093 digests of 32 bytes
BLOCK_LEAVES = ARITY ** BLOCK_LEVELS
BLOCKS_AT_ONCE = 64
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def veb_address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` at ``depth`` in a complete tree of
    ``height`` levels below its root.

    The upper half of the levels is stored first, then each of the lower
    subtrees in turn, each laid out by the same rule.
    """
    levels = height + 1
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return veb_address(top - 1, depth, index)
    low = levels - top
    below = ARITY ** (depth - top)
    size_top, size_low = (ARITY ** top - 1) // (ARITY - 1), (ARITY ** low - 1) // (ARITY - 1)
    return size_top + index // below * size_low + veb_address(low - 1, depth - top, index % below)


def _layout(height: int) -> list[np.ndarray]:
    """Places of the nodes of each level, leaves first."""
    return remembered(("veb layout", height), lambda: [
        veb_address(height, depth, np.arange(ARITY ** depth)) for depth in range(height, -1, -1)])


def joined_hash(digests: list[bytes]) -> bytes:
    """Digest of digests, each as hex text."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def build_subtree(leaves: list[bytes], height: int) -> bytes:
    """All digests of a subtree in its layout; zeros where no node is."""
    places = _layout(height)
    nodes = np.zeros(((ARITY ** (height + 1) - 1) // (ARITY - 1), DIGEST), np.uint8)
    level = leaves
    for up in range(height + 1):
        nodes[places[up][:len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        if up < height:
            level = [joined_hash(level[i:i + ARITY]) for i in range(0, len(level), ARITY)]
    return nodes.tobytes()


def siblings_of(nodes: bytes, height: int, leaves: int, index: int) -> tuple[bytes, bytes]:
    """(siblings from the leaf's level up, one byte a level: 3 * size of the
    run + own place in it) of leaf ``index`` of a subtree of ``leaves``."""
    places, out, runs = _layout(height), [], []
    for up in range(height):
        first = index // ARITY * ARITY
        run = min(ARITY, leaves - first)
        for i in range(first, first + run):
            if i != index:
                at = int(places[up][i]) * DIGEST
                out.append(nodes[at:at + DIGEST])
        runs.append(ARITY * run + index - first)
        index, leaves = index // ARITY, -(-leaves // ARITY)
    return b"".join(out), bytes(runs)


def fold(leaf: bytes, siblings: bytes, runs: bytes) -> bytes:
    """The root that ``leaf`` leads to along its siblings."""
    at = 0
    for run in runs:
        size, place = divmod(run, ARITY)
        others = [siblings[i:i + DIGEST] for i in range(at, at + (size - 1) * DIGEST, DIGEST)]
        leaf = joined_hash(others[:place] + [leaf] + others[place:])
        at += (size - 1) * DIGEST
    return leaf


def leaf_digest(fields: list[Column]) -> Column:
    """sha256 of the fields: `-` for NULL, else size in bytes, colon, value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, ...) with position in their tree by ``order``, from 0,
    and levels, the height of the tree.

    Rows are range-sorted by tree and order and written; a row's position is
    its place in its range, less its tree's first, plus the tree's rows in the
    ranges before.
    """
    ranges = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(nodes.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
                     .withColumn("_at", F.monotonically_increasing_id()), "manifest-ranges")
    row, in_range = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_at", 33)
    ranged = ranged.withColumn("_range", in_range).withColumn("_row", row).drop("_at")
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    held = ranged.groupBy("tree", "_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("tree"))
    offsets = held.select("tree", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
                          sum(((total > F.lit(ARITY ** h)).cast("int") for h in range(1, 40)), (total > 1).cast("int")).alias("levels"))
    return (ranged.join(offsets, ["tree", "_range"]).withColumn("position", F.col("_row") + F.col("_offset"))
            .drop("_row", "_range", "_offset"))


def _subtrees(nodes: DataFrame, payload: list[str], tier: int) -> DataFrame:
    """One row a subtree: tree, levels, subtree (its number), height, leaves,
    root, nodes and the leaves' ``payload`` as lists."""
    member = F.struct("position", "digest", *payload)
    grouped = (nodes.groupBy("tree", "levels", F.expr(f"position div {BLOCK_LEAVES}").alias("subtree"))
               .agg(F.array_sort(F.collect_list(member)).alias("members")))  # at most BLOCK_LEAVES
    height = F.least(F.lit(BLOCK_LEVELS), F.col("levels") - F.lit(tier * BLOCK_LEVELS)).cast("int")
    grouped = grouped.select("tree", "levels", "subtree", height.alias("height"), F.size("members").alias("leaves"),
                             *[F.col(f"members.{c}").alias(c) for c in payload], F.col("members.digest").alias("digests"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heights = batch.column(batch.schema.get_field_index("height")).to_pylist()
            digests = batch.column(batch.num_columns - 1)
            for start in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                some = batch.slice(start, BLOCKS_AT_ONCE)
                nodes_ = [build_subtree(digests[start + i].as_py(), heights[start + i]) for i in range(some.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    some.columns[:-1] + [pa.array([n[:DIGEST] for n in nodes_], pa.binary()), pa.array(nodes_, pa.binary())],
                    names=batch.schema.names[:-1] + ["root", "nodes"])

    fields = [f for f in grouped.schema if f.name != "digests"]
    return grouped.mapInArrow(build, T.StructType(fields + [T.StructField("root", T.BinaryType()), T.StructField("nodes", T.BinaryType())]))


def build_tiers(nodes: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The subtrees of all tiers, lowest first, each written; ``nodes`` has
    tree, levels, position, digest and the payload of the lowest tier."""
    tiers = []
    while True:
        tiers.append(written(_subtrees(nodes, [] if tiers else payload, len(tiers)), "manifest-subtrees"))
        higher = tiers[-1].where(F.col("levels") > len(tiers) * BLOCK_LEVELS)
        if higher.isEmpty():
            return tiers
        nodes = higher.select("tree", "levels", F.col("subtree").alias("position"), F.col("root").alias("digest"))


def _ends_in(tier: int) -> Column:
    """Subtrees whose root is that of their tree."""
    return F.col("levels") <= (tier + 1) * BLOCK_LEVELS


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    parts = [t.where(_ends_in(i)).select("tree", "root") for i, t in enumerate(tiers)]
    return reduce(DataFrame.union, parts)


def _leaf_paths(subtrees: DataFrame, payload: list[str]) -> DataFrame:
    """One row a leaf of ``subtrees``, which carry the path of their own root:
    tree, position, payload, leaf and its path to the top."""
    lists = [subtrees.schema[c].dataType.elementType for c in payload]

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names) if c not in payload}
                n, nodes, height = row["leaves"], row["nodes"], row["height"]
                own = [siblings_of(nodes, height, n, k) for k in range(n)]
                at = (_layout(height)[0][:n] * DIGEST).tolist()
                first = row["subtree"] * BLOCK_LEAVES
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64())]
                    + [batch.column(batch.schema.get_field_index(c))[i].values for c in payload]
                    + [pa.array([nodes[a:a + DIGEST] for a in at], pa.binary()),
                       pa.array([s + row["siblings"] for s, _ in own], pa.binary()),
                       pa.array([r + row["runs"] for _, r in own], pa.binary()),
                       pa.array([row["subroot"]] * n, pa.binary()), pa.array([row["top"]] * n, pa.binary())],
                    names=["tree", "position", *payload, "leaf", "siblings", "runs", "subroot", "top"])

    binary = [T.StructField(c, T.BinaryType()) for c in ("leaf", "siblings", "runs", "subroot", "top")]
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("position", T.LongType())]
                          + [T.StructField(c, t) for c, t in zip(payload, lists)] + binary)
    return (subtrees.select("tree", "subtree", "height", "leaves", "nodes", "siblings", "runs", "subroot", "top", *payload)
            .mapInArrow(paths, schema))


def descend(tiers: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """Paths of all leaves of the lowest tier; ``tops`` has the path (siblings,
    runs, subroot, top) that leads on from the root of each tree."""
    above = None
    for i in range(len(tiers) - 1, -1, -1):
        ending = tiers[i].where(_ends_in(i)).select("tree", "subtree").join(tops, "tree")
        known = ending if above is None else ending.unionByName(above)
        with_path = tiers[i].join(known, ["tree", "subtree"])
        leaves = _leaf_paths(with_path, payload if i == 0 else [])
        above = leaves.select("tree", F.col("position").alias("subtree"), "siblings", "runs", "subroot", "top")
    return leaves


def merkle_paths(leaves: DataFrame, order: list[str], payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """(paths, subtrees) of the dataset whose rows are ``leaves``: source
    (string), digest (binary), ``order`` and ``payload`` columns.

    paths: source, payload, position in the source, leaf, subroot, root,
    siblings and runs of every row; ``fold`` leads from the leaf to the root.
    subtrees: the stored manifest, a row a subtree: source (NULL source and
    dataset alike NULL: see ``of_dataset``), of_dataset, tier, subtree, height,
    leaves, root and nodes in the van Emde Boas layout.

    Rows of a source ascend by ``order``, NULL first; rows that are equal in it
    are ordered by digest, and equal rows are interchangeable.  Sources ascend
    bytewise, NULL first.  No rows, no source: both tables are empty.
    """
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    nodes = leaves.select(tree.alias("tree"), "digest", *dict.fromkeys(order + payload))
    tiers = build_tiers(numbered(nodes, [*order, "digest"]), payload)
    roots = tree_roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest"))
    dataset = build_tiers(numbered(roots, ["of"]), ["of"])
    nothing = F.lit(b"")
    top = tree_roots(dataset).select("tree", nothing.alias("siblings"), nothing.alias("runs"), nothing.alias("subroot"),
                                     F.col("root").alias("top"))
    tops = descend(dataset, top, ["of"]).select(F.col("of").alias("tree"), "siblings", "runs", F.col("leaf").alias("subroot"), "top")
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias("source")
    paths = descend(tiers, tops, payload).select(source, *payload, "position", "leaf", "subroot", F.col("top").alias("root"),
                                                 "siblings", "runs")
    stored = [t.select(source, F.lit(of).alias("of_dataset"), F.lit(i).alias("tier"), "subtree", "height", "leaves", "root", "nodes")
              for of, forest in ((False, tiers), (True, dataset)) for i, t in enumerate(forest)]
    return paths, reduce(DataFrame.union, stored)


def folded(paths: DataFrame, leaf_col: str, out: str) -> DataFrame:
    """``paths`` with the root that ``leaf_col`` leads to along siblings and runs."""
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (leaf_col, "siblings", "runs")]
        return [pa.array([fold(*row) for row in zip(*columns)], pa.binary())]

    return add_columns(paths, [T.StructField(out, T.BinaryType())], compute)


def manifest_of(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, siblings, runs, altered (the leaf with the
    line feeds of the text deleted, where the crc32 of the id is even, else
    NULL) and folded_root (from altered, else from leaf) of every row.

    A leaf is the sha256 of ``fields``, each `-` if NULL and else its size in
    bytes, a colon and the value.  The trees of sources and dataset join three
    nodes at a time, the last run fewer.  NULL ids come first in their source
    and are not altered; repeated rows have a leaf each; an empty table has no
    rows; other columns are not looked at.
    """
    edited = [F.replace(F.col(f"`{c}`"), F.lit("\n"), F.lit("")) if c == text_col else F.col(f"`{c}`") for c in fields]
    even = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(2)) == 0
    leaves = written(docs.select(F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{id_col}`").alias("doc_id"),
                                 leaf_digest([F.col(f"`{c}`") for c in fields]).alias("digest"),
                                 F.when(even, leaf_digest(edited)).alias("altered")), "manifest-leaves")
    paths, _ = merkle_paths(leaves, ["doc_id"], ["doc_id", "altered"])
    start = paths.withColumn("_start", F.coalesce("altered", "leaf"))
    return folded(start, "_start", "folded_root").drop("_start")
