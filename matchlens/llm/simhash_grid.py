"""Near-duplicate classes by SimHash, found with a grid over segment bit counts.

A 64-bit fingerprint is cut into 16 segments, and each segment is replaced by its number of set bits. The
Manhattan distance of two such vectors is never above the Hamming distance of the fingerprints, so all pairs within
two bits lie within Manhattan distance two. Two vectors at that distance share a grid point at distance one from
both; every distinct fingerprint therefore visits its own point and the neighbours one step away (33 at most), and
fingerprints that meet at a point are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import stage, text_of

SEED = 42
SHINGLE = 3
MAX_BITS = 2
SEGMENTS, BITS = 16, 4
SMALL_POINT = 64
TILE = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned; bit i is set if it is set in over half of the shingles' hashes. No word gives zero."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, carry: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``carry`` columns of every row with the fingerprint as signed long ``__fp``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("__text")], dtype=np.uint64)
            at = batch.schema.get_field_index("__text")
            yield batch.set_column(at, "__fp", pa.array(found.view(np.int64)))

    base = docs.select(*carry, text_of().alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema][:-1] + ["__fp long"]
    return base.mapInArrow(work, ", ".join(fields))


def grid_points(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, fingerprint) for the point of each fingerprint and its neighbours. Three bits hold a count of 0 to 4."""
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(BITS)
    counts = np.bitwise_count((fps[:, None] >> shifts) & np.uint64(15)).astype(np.int64)
    unit = np.int64(1) << (3 * np.arange(SEGMENTS, dtype=np.int64))
    own = counts @ unit
    up, down = np.nonzero(counts < BITS), np.nonzero(counts > 0)
    points = np.concatenate([own, own[up[0]] + unit[up[1]], own[down[0]] - unit[down[1]]])
    return points, np.concatenate([fps, fps[up[0]], fps[down[0]]])


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_BITS


def crowded_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All close pairs of one crowded point.

    Two fingerprints within two bits agree in at least one of three parts of their bits, so sorting by each part
    brings every pair into one run, and runs are compared tile by tile.
    """
    left, right = [], []
    for low, width in ((0, 22), (22, 21), (43, 21)):
        part = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
        order = np.argsort(part, kind="stable")
        ordered, part = fps[order], part[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            for i in range(a, b, TILE):
                for j in range(i, b, TILE):
                    rows, cols = ordered[i : min(i + TILE, b)], ordered[j : min(j + TILE, b)]
                    x, y = np.nonzero(_close(rows[:, None], cols[None, :]))
                    mine = x < y if i == j else slice(None)
                    left.append(rows[x[mine]])
                    right.append(cols[y[mine]])
    return np.concatenate(left), np.concatenate(right)


def links_of(points: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Close pairs among rows sorted by point."""
    starts = np.flatnonzero(np.concatenate([[True], points[1:] != points[:-1]]))
    sizes = np.diff(np.append(starts, len(points)))
    left, right = [], []
    for s, n in zip(starts[sizes > SMALL_POINT], sizes[sizes > SMALL_POINT]):
        a, b = crowded_links(fps[s : s + n])
        left.append(a)
        right.append(b)
    small = np.repeat(sizes <= SMALL_POINT, sizes)
    points, fps = points[small], fps[small]
    for step in range(1, SMALL_POINT):
        same = points[step:] == points[:-step]
        if not same.any():
            break
        a, b = fps[:-step][same], fps[step:][same]
        near = _close(a, b)
        left.append(a[near])
        right.append(b[near])
    if not left:
        return fps[:0], fps[:0]
    return np.concatenate(left), np.concatenate(right)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def close_pairs(distinct: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b of all values of ``fp`` (distinct longs) within two bits.

    A fingerprint has at most 2,080 neighbours within two bits, so pairs grow with the table, not with the
    square of a group.
    """

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, fps = grid_points(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(fps.view(np.int64))], names=["point", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_points, held_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def answer(points: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            a, b = (x.view(np.int64) for x in links_of(points, fps))
            pairs = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=LINKS)

        for batch in batches:
            points = np.concatenate([held_points, batch.column(0).to_numpy()])
            fps = np.concatenate([held_fps, batch.column(1).to_numpy().view(np.uint64)])
            if not len(points):
                continue
            # The last point may go on in the next batch.
            cut = int(np.searchsorted(points, points[-1]))
            held_points, held_fps = points[cut:], fps[cut:]
            if cut:
                yield answer(points[:cut], fps[:cut])
        if len(held_points):
            yield answer(held_points, held_fps)

    cells = distinct.select("fp").mapInArrow(spread_out, "point long, fp long")
    return cells.repartition("point").sortWithinPartitions("point").mapInArrow(meet, "a long, b long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of ``pairs`` (a, b); the root is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label of that label, so labels
    travel in doubling steps. Every round is written to the shared folder, which cuts the lineage.
    """
    edges = stage(pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = edges.join(labels.withColumnsRenamed({"node": "b", "root": "other"}), "b").groupBy("a").agg(F.min("other").alias("other"))
        lower = labels.join(around.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "other").alias("best"))
        up = labels.select(F.col("node").alias("best"), F.col("root").alias("jump"))
        moved = lower.join(up, "best").select("node", "root", F.least("best", "jump").alias("next"))
        moved = stage(moved, "labels")
        changed = moved.where("next <> root").limit(1).count()
        labels = moved.select("node", F.col("next").alias("root"))
        if not changed:
            return labels


def classes(docs: DataFrame, carry: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``carry`` columns (default: doc_id) of every row with ``__fp`` and ``__component``, the smallest doc_id reachable.

    Null and empty texts have fingerprint zero and are linked like any other. Null ids are ignored by the
    minimum, so a class without any id has a null component. Repeated rows share a class. Rows with equal
    fingerprints count as one node, so a huge group of copies adds one row to the search.
    """
    carry = ["doc_id"] if carry is None else carry
    known = stage(fingerprints(docs, ["doc_id"], shingle), "fingerprints")
    nodes = stage(known.groupBy(F.col("__fp").alias("fp")).agg(F.min("doc_id").alias("smallest")), "nodes")
    pairs = stage(close_pairs(nodes), "pairs")
    if pairs.limit(1).count():
        roots = stage(components(pairs), "roots")
        whole = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        lowest = whole.groupBy("root").agg(F.min("smallest").alias("__component"))
        named = whole.join(lowest, "root").select(F.col("fp").alias("__fp"), "__component")
    else:
        named = nodes.select(F.col("fp").alias("__fp"), F.col("smallest").alias("__component"))
    named = stage(named, "classes")
    rows = known if carry == ["doc_id"] else fingerprints(docs, carry, shingle)
    return rows.join(named, "__fp").select(*carry, "__fp", "__component")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    digits = F.lower(F.lpad(F.hex("__fp"), 16, "0"))
    return classes(docs).select("doc_id", digits.alias("fingerprint"), F.col("__component").alias("component_id"))
