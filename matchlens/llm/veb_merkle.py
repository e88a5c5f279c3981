"""Merkle manifest of a table, its trees stored in van Emde Boas order.

The leaves of a tree are cut into aligned subtrees of a fixed height, the blocks; a block's root is a leaf of the next tier,
where the same is done again, until one block holds the root of the tree. Inside a block the nodes lie in van Emde Boas
order: the levels are split at half, the upper part is stored first and then each lower subtree, all of them in the
same way again. Any path from a leaf upward thus stays within few neighbouring ranges whatever the size of a cache line or a
page. The place of a node follows from its level and index by arithmetic; building and the lookup of siblings use it.

Every source has a tree of its own, and one more tree stands over their roots. A hot source is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.common import stage

ARITY = 16
# Merges inside a block: 256 leaves and the 17 nodes above them.
MERGES = 2
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def merges_of(n: int, arity: int = ARITY) -> int:
    """How often ``n`` nodes merge until one remains."""
    merges = 0
    while n > 1:
        n, merges = -(-n // arity), merges + 1
    return merges


def size(levels: int, n: int, arity: int = ARITY) -> int:
    """Nodes of a tree of that many levels over ``n`` leaves."""
    return sum(-(-n // arity**k) for k in range(levels))


def address(levels: int, n: int, level: int, index: int, arity: int = ARITY) -> int:
    """The place of a node; level 0 are the leaves. All subtrees but the last of a level are full."""
    if levels == 1:
        return index
    top = levels // 2
    low = levels - top
    above = -(-n // arity**low)
    if level >= low:
        return address(top, above, level - low, index, arity)
    full, per_tree = arity ** (low - 1), arity ** (low - 1 - level)
    tree = index // per_tree
    start = size(top, above, arity) + tree * size(low, full, arity)
    return start + address(low, min(full, n - tree * full), level, index % per_tree, arity)


@lru_cache(maxsize=1024)
def layout(levels: int, n: int, arity: int = ARITY) -> list[np.ndarray]:
    """The places of all nodes, level by level; what ``address`` gives for each."""
    if levels == 1:
        return [np.arange(n)]
    top = levels // 2
    low = levels - top
    above, full = -(-n // arity**low), arity ** (low - 1)
    trees = -(-n // full)
    start, step = size(top, above, arity), size(low, full, arity)
    last = layout(low, n - (trees - 1) * full, arity)
    places = []
    for level in range(low):
        before = np.zeros(0, dtype=np.int64)
        if trees > 1:
            before = (np.arange(trees - 1)[:, None] * step + layout(low, full, arity)[level][None, :]).ravel()
        places.append(start + np.concatenate([before, (trees - 1) * step + last[level]]))
    return places + layout(top, above, arity)


def digest(parts: list[bytes]) -> bytes:
    """Digests are concatenated as hex text."""
    return sha256(b"".join(parts).hex().encode()).digest()


def subtree(leaves: list[bytes], merges: int, arity: int = ARITY) -> bytes:
    """All nodes above and including ``leaves`` in van Emde Boas order."""
    places = layout(merges + 1, len(leaves), arity)
    nodes: list[bytes] = [b""] * size(merges + 1, len(leaves), arity)
    level = leaves
    for k, at in enumerate(places):
        if k:
            level = [digest(level[i : i + arity]) for i in range(0, len(level), arity)]
        for place, node in zip(at.tolist(), level):
            nodes[place] = node
    return b"".join(nodes)


def siblings(nodes: bytes, merges: int, n: int, leaf: int, arity: int = ARITY) -> list[tuple[bytes, bytes]]:
    """The digests left and right of the path from a leaf of a stored subtree, level by level."""
    out, index, many = [], leaf, n
    for level in range(merges):
        first = index - index % arity
        run = range(first, min(first + arity, many))
        at = {i: DIGEST * address(merges + 1, n, level, i, arity) for i in run if i != index}
        sides = (b"".join(nodes[p : p + DIGEST] for i, p in at.items() if (i > index) == right) for right in (False, True))
        out.append(tuple(sides))
        index, many = index // arity, -(-many // arity)
    return out


def all_siblings(nodes: bytes, merges: int, n: int, arity: int = ARITY) -> list[bytes]:
    """The packed path of every leaf of a stored subtree: as ``siblings``, looked up once for each run."""
    places = layout(merges + 1, n, arity)
    paths = [b""] * n
    for level in range(merges):
        width = arity**level
        at = places[level].tolist()
        for first in range(0, len(at), arity):
            run = [nodes[DIGEST * p : DIGEST * (p + 1)] for p in at[first : first + arity]]
            for i in range(len(run)):
                step = bytes((i, len(run) - 1 - i)) + b"".join(run[:i] + run[i + 1 :])
                low = (first + i) * width
                for leaf in range(low, min(low + width, n)):
                    paths[leaf] += step
    return paths


def unpacked(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The digests left and right of a packed path, level by level."""
    at = 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        middle = at + 2 + DIGEST * left
        end = middle + DIGEST * right
        yield path[at + 2 : middle], path[middle:end]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf has with these siblings."""
    for left, right in unpacked(path):
        leaf = digest([left, leaf, right])
    return leaf


def field(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def tree_of(source: Column) -> Column:
    """A key that is never null and sorts as the source does, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place ``pos`` in their ``tree`` by ``order``, and the number ``n`` of rows of the tree.

    Rows are sorted over all partitions at once, and a running id inside a partition gives the place there. Only the number
    of rows of each tree and partition is added up: a hot tree is spread, and no window holds more rows than partitions.
    """
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("many").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", "tree", (before - F.col("first")).alias("shift"), F.sum("many").over(tree).alias("n"))
    counts = stage(counts, "places")
    return placed.join(counts, ["part", "tree"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


BLOCKS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("leaves", pa.int32()), ("nodes", pa.binary())])


def span(merges: int) -> int:
    return ARITY**merges


def block_merges(n: int, merges: int) -> int:
    """The merges of a block in a tree of ``n`` leaves on this tier: all, if the tree has several blocks."""
    return merges if n > span(merges) else merges_of(n)


def build_tiers(leaves: DataFrame, merges: int = MERGES) -> list[DataFrame]:
    """Tables (tree, block, n, leaves, nodes) of blocks over ``leaves`` (tree, pos, n, digest), one for each tier, lowest first.

    ``n`` is the number of the tree's nodes on that tier, ``leaves`` that of the block.
    """

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        n = rows.column("n")[0].as_py()
        nodes = subtree(rows.column("digest").to_pylist(), block_merges(n, merges))
        row = [[key[0].as_py()], [key[1].as_py()], [n], [rows.num_rows], [nodes]]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(row, BLOCKS.types)], schema=BLOCKS)

    tiers = []
    while True:
        block = F.floor(F.col("pos") / span(merges)).alias("block")
        cut = leaves.select("tree", block, "pos", "n", "digest").groupBy("tree", "block")
        tier = stage(cut.applyInArrow(work, "tree string, block long, n long, leaves int, nodes binary"), "subtrees")
        tiers.append(tier)
        high = tier.where(F.col("n") > span(merges))
        if high.isEmpty():
            return tiers
        # The upper part comes first, so the root of every block is its first node.
        root, many = F.expr(f"substring(nodes, 1, {DIGEST})"), F.ceil(F.col("n") / span(merges))
        leaves = high.select("tree", F.col("block").alias("pos"), many.alias("n"), root.alias("digest"))


def tree_roots(tiers: list[DataFrame], merges: int = MERGES) -> DataFrame:
    """(tree, digest) of all trees."""
    tops = [t.where(F.col("n") <= span(merges)).select("tree", F.expr(f"substring(nodes, 1, {DIGEST})").alias("digest")) for t in tiers]
    return reduce(DataFrame.unionByName, tops)


def located(tiers: list[DataFrame], above: DataFrame, merges: int = MERGES) -> DataFrame:
    """The blocks of the lowest tier with the packed ``path`` of their roots; ``above`` (tree, path) leads on from the trees' roots."""
    upper = None
    for tier in reversed(tiers):
        blocks = tier.where(F.col("n") <= span(merges)).join(above, "tree")
        if upper is not None:
            blocks = blocks.unionByName(tier.where(F.col("n") > span(merges)).join(upper, ["tree", "block"]))
        if tier is tiers[0]:
            return blocks
        upper = stage(leaf_paths(blocks, merges).withColumnRenamed("pos", "block"), "paths")
    raise ValueError("no tiers")


PATHS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", pa.binary())])


def leaf_paths(blocks: DataFrame, merges: int = MERGES) -> DataFrame:
    """(tree, pos, path) of all leaves of blocks with their own ``path``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                paths = [p + row["path"] for p in all_siblings(row["nodes"], block_merges(row["n"], merges), row["leaves"])]
                pos = np.arange(len(paths)) + row["block"] * span(merges)
                yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * len(paths)), pa.array(pos), pa.array(paths, pa.binary())], schema=PATHS)

    return blocks.select("tree", "block", "n", "leaves", "nodes", "path").mapInArrow(work, "tree string, pos long, path binary")


@dataclass(frozen=True)
class Manifest:
    """The placed leaves (tree, pos, n, doc_id, digest, observed), the tiers of the sources' trees and those above, and the root."""

    leaves: DataFrame
    tiers: list[DataFrame]
    sources: DataFrame
    tops: list[DataFrame]
    root: bytes | None


def build_manifest(docs: DataFrame, observed: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text). ``observed`` is a text seen later, null if it is the same one."""
    original = [F.col(c) for c in FIELDS]
    seen = row_digest([*original[:-1], observed]) if observed is not None else None
    other = F.lit(None).cast("binary") if seen is None else F.when(observed.isNotNull(), seen)
    leaves = docs.select(
        tree_of(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), row_digest(original).alias("digest"), other.alias("observed")
    )
    # The running id spreads rows that are equal in everything; which of them comes first makes no difference.
    leaves = stage(leaves.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    placed = positions(leaves, ["doc_id", "digest", "salt"]).drop("salt")
    tiers = build_tiers(placed)
    sources = tree_roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = stage(positions(sources, ["source"]), "sources")
    tops = build_tiers(sources)
    root = tree_roots(tops).first()
    return Manifest(placed, tiers, sources, tops, root and bytes(root["digest"]))


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PROOF_FIELDS = pa.schema([(c, pa.string()) for c in PROOFS.replace(",", "").split()[::2]])
PROOF_FIELDS = PROOF_FIELDS.set(0, pa.field("doc_id", pa.int64())).set(6, pa.field("verified", pa.bool_()))


def prove(manifest: Manifest, merges: int = MERGES) -> DataFrame:
    """One row for each leaf: its digest, the roots, the digest of its siblings, and the root that what was observed leads to."""
    paths = leaf_paths(located(manifest.tops, manifest.sources.select("tree").distinct().withColumn("path", F.lit(b""))))
    above = manifest.sources.join(paths, ["tree", "pos"]).select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot"))
    above = stage(above, "source-paths")
    blocks = located(manifest.tiers, above.select("tree", "path")).join(above.select("tree", "subroot"), "tree")
    root = manifest.root

    def work(rows: pa.Table, stored: pa.Table) -> pa.Table:
        block = stored.slice(0, 1).to_pylist()[0]
        paths = all_siblings(block["nodes"], block_merges(block["n"], merges), block["leaves"])
        out = []
        for doc_id, pos, leaf, observed in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "pos", "digest", "observed"))):
            path = paths[pos % span(merges)] + block["path"]
            proof = digest([side for sides in unpacked(path) for side in sides])
            folded = fold(observed or leaf, path)
            out.append((doc_id, leaf.hex(), block["subroot"].hex(), root.hex(), proof.hex(), folded.hex(), folded == root))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PROOF_FIELDS.types)], schema=PROOF_FIELDS)

    rows = manifest.leaves.withColumn("block", F.floor(F.col("pos") / span(merges)))
    pairs = rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return pairs.applyInArrow(work, PROOFS)


def tampered_text() -> Column:
    """The text with A-Z in lower case where 5 divides the crc32 of the decimal id; else null. Null texts and ids: null."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.when(crc % 5 == 0, F.translate(F.col("text"), UPPER, LOWER))


def tampering_check(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and its check against a copy in which a fifth of the texts is in lower case.

    Null values are marked as such in the digest, so they differ from empty ones; a null source is a tree of its own and
    the first, a null doc_id the first of its tree. Rows with the same id follow in order of their digests; repeated rows are
    leaves of their own. Other columns are not part of the manifest. An empty table has no root and gives no rows.
    """
    return prove(build_manifest(docs, tampered_text()))
