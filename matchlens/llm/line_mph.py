"""Line deduplication over a sharded minimal perfect hash.

The distinct keys of frequent lines are dealt over shards, and each shard builds a minimal perfect hash: levels
of bit arrays, where a key belongs to the first level in which its bit is its own, and the rank of that bit is its
number. The number points into plain arrays: a fingerprint that tells strangers apart, the count, and the document
that keeps the line. Documents probe these arrays. They meet them by blocks: the distinct keys of a
block of documents go to the shards once, so a line in a third of all documents costs one probe per block.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.llm.common import BLANKS, give_back, lean, spread, stage, text_of

MIN_CHARS, MIN_DOCS = 20, 3
KEYS_PER_SHARD = 50_000
PROBES_PER_SHARD = 400_000
BYTES_PER_BLOCK = 16_000_000
NO_ID = -(1 << 63)
GAMMA = 2.0


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The stripped line with A-Z in lower case, or None if too short."""
    key = line.strip(BLANKS)
    # On bytes, lower() changes A-Z alone.
    return key.encode().lower() if len(key) >= min_chars else None


def digests(key: bytes) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(key)
    return (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63)


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a.view(np.uint64) + b.view(np.uint64) * np.uint64(2 * level + 0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """Levels of bits; a key's number is the rank of its bit over all levels."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sizes = [int(bits.sum()) for bits in levels]
        self.before = [np.concatenate([[0], np.cumsum(bits)]) for bits in levels]
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """For distinct pairs (a, b) of 64-bit values."""
        levels: list[np.ndarray] = []
        while len(a):
            size = max(8, int(GAMMA * len(a)))
            at = (_mixed(a, b, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        return cls(levels)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key; -1 or a stranger's number for keys that are not in the set."""
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for k, bits in enumerate(self.levels):
            if not len(left):
                break
            at = (_mixed(a[left], b[left], k) % np.uint64(len(bits))).astype(np.int64)
            own = bits[at]
            out[left[own]] = self.base[k] + self.before[k][at[own]]
            left = left[~own]
        return out

    def pack(self) -> bytes:
        sizes = struct.pack(f"<I{len(self.levels)}I", len(self.levels), *map(len, self.levels))
        return sizes + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpack(cls, blob: bytes) -> PerfectHash:
        (n,) = struct.unpack_from("<I", blob)
        sizes = struct.unpack_from(f"<{n}I", blob, 4)
        at, levels = 4 + 4 * n, []
        for size in sizes:
            packed = np.frombuffer(blob, np.uint8, -(-size // 8), at)
            levels.append(np.unpackbits(packed)[:size].astype(bool))
            at += len(packed)
        return cls(levels)


INDEX = pa.schema([("shard", pa.int64()), ("hash", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary()), ("keepers", pa.binary())])
HITS = pa.schema([("block", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keeper", pa.int64()), ("n", pa.int64())])


def build_index(frequent: DataFrame, shards: int) -> DataFrame:
    """One row of arrays for each shard of the frequent keys (h1, h2, n, keeper)."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2, n, keeper, shard = (table.column(c).to_numpy() for c in ("h1", "h2", "n", "keeper", "shard"))
        perfect = PerfectHash.build(h1, h2)
        at = perfect.number(h1, h2)
        arrays = [np.empty(len(h1), dtype="<i8") for _ in range(3)]
        for array, values in zip(arrays, (h1, n, keeper)):
            array[at] = values
        row = [[int(shard[0])], [perfect.pack()], *([a.tobytes()] for a in arrays)]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(row, INDEX.types)], schema=INDEX)

    sharded = frequent.withColumn("shard", F.pmod("h2", F.lit(shards)))
    schema = "shard long, hash binary, fingerprints binary, counts binary, keepers binary"
    return sharded.groupBy("shard").applyInArrow(build, schema)


def probe_index(probes: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(block, h1, h2, keeper, n) of the probes (block, h1, h2) that name a frequent key."""

    def look(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        if not asked.num_rows or not arrays.num_rows:
            return HITS.empty_table()
        h1, h2, block = (asked.column(c).to_numpy() for c in ("h1", "h2", "block"))
        row = arrays.slice(0, 1).to_pylist()[0]
        marks, counts, keepers = (np.frombuffer(row[c], "<i8") for c in ("fingerprints", "counts", "keepers"))
        at = PerfectHash.unpack(row["hash"]).number(h1, h2)
        hit = at >= 0
        hit[hit] = marks[at[hit]] == h1[hit]
        at = at[hit]
        return pa.Table.from_arrays([pa.array(x) for x in (block[hit], h1[hit], h2[hit], keepers[at], counts[at])], schema=HITS)

    sharded = probes.withColumn("shard", F.pmod("h2", F.lit(shards)))
    pairs = sharded.groupBy("shard").cogroup(index.groupBy("shard"))
    return pairs.applyInArrow(look, "block long, h1 long, h2 long, keeper long, n long")


KEYS = pa.schema([("block", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64())])


RESULTS = ("text", "n_lines", "n_dropped")


def _rewritten(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Every row as struct ``row``, with its remaining ``text``, ``n_lines`` and ``n_dropped``.

    The row's own columns stay inside the struct, so their names cannot clash with ours.
    """
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    blocks = spread(size, BYTES_PER_BLOCK)
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("own")
    # Rows are dealt by id and text, so neither many null ids nor many copies of a text fill one block.
    block = F.pmod(F.xxhash64("doc_id", text_of()), F.lit(blocks)).alias("block")
    rest = [docs[f"`{c}`"] for c in docs.columns if c != "text"]
    base = docs.select(F.struct(*rest).alias("row"), own, block, text_of().alias("body"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, b, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                keys = {k for line in value.as_py().split("\n") if (k := line_key(line, min_chars)) is not None}
                rows += [(b, *digests(k), i) for k in keys]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=KEYS)

    keys = stage(base.select("own", "block", "body").mapInArrow(lean(emit), "block long, h1 long, h2 long, id long"), "lines")
    frequent = keys.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    frequent = stage(frequent, "frequent")
    shards = max(spread(frequent.count(), KEYS_PER_SHARD), spread(keys.count(), PROBES_PER_SHARD))
    hits = probe_index(keys.select("block", "h1", "h2").distinct(), build_index(frequent, shards), shards)

    def rewrite(texts: pa.Table, found: pa.Table) -> pa.Table:
        keeper = dict(zip(zip(found.column("h1").to_pylist(), found.column("h2").to_pylist()), found.column("keeper").to_pylist()))
        out, lines_of, dropped_of = [], [], []
        for own_id, value in zip(texts.column("own").to_pylist(), texts.column("body")):
            lines = value.as_py().split("\n")
            left = lines
            if keeper:
                left = [x for x in lines if (k := line_key(x, min_chars)) is None or keeper.get(digests(k), own_id) == own_id]
            out.append("\n".join(left))
            lines_of.append(len(lines))
            dropped_of.append(len(lines) - len(left))
        rows = texts.select(["row"])
        for name, values in zip(RESULTS, (out, lines_of, dropped_of)):
            rows = rows.append_column(name, pa.array(values, pa.string() if name == "text" else pa.int64()))
        give_back()
        return rows

    kinds = T.StructType([base.schema["row"], *(T.StructField(c, T.StringType() if c == "text" else T.LongType()) for c in RESULTS)])
    return base.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(rewrite, kinds)


def drop_repeated_lines(
    docs: DataFrame, carry: list[str] | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Every row with its remaining ``text``, and ``n_lines`` and ``n_dropped``.

    ``carry`` are the other columns to keep (default: doc_id); one named as a result gives way to it. A key of at least
    ``min_chars`` code points that occurs in ``min_docs`` rows loses its lines everywhere but in the row with the largest
    doc_id. A null or empty text is one empty line. A null doc_id is smaller than all others; rows that share the largest
    doc_id all keep the line. Repeated rows count as rows of their own. An empty table gives an empty result.
    """
    kept = [c for c in (["doc_id"] if carry is None else carry) if c not in RESULTS]
    used = docs.select("text", *{"doc_id": 1, **dict.fromkeys(kept)})
    rows = _rewritten(used, min_chars, min_docs)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], *RESULTS)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` with all their columns and the remaining text in ``text``, by the rules above."""
    rows = _rewritten(docs, min_chars, min_docs)
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
