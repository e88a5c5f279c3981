"""Removal of long repeated passages with a logarithmic family of sorted suffix arrays.

A string of L bytes is the head of one suffix. Suffixes are kept in runs: neighbouring suffixes whose heads have the same
smallest K-byte fingerprint (minimizer) form one entry, about one for each 70 bytes. Equal heads have equal minimizers,
so a repeated string always shows as a shared minimizer. An entry is (minimizer, digest of all heads of the run).

Documents arrive in batches. The suffix array of a batch, its entries sorted by minimizer and digest, is merge-scanned
against every existing level to find shared minimizers. Then it joins the family: as long as a level of its size
exists, the two merge into one of twice the size, so an entry moves a logarithmic number of times.

A run whose digest occurs twice is repeated as a whole. For the others that share a minimizer the heads are compared one
by one, with one example of each different run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.llm.common import drop, lean, stage, text_of

LENGTH = 200
HEAD = 64
WINDOW = LENGTH - HEAD + 1
BATCHES = 4


def _mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    x = (a ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over each window of ``width``, by doubling."""
    out, size = x, 1
    while 2 * size <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def fingerprints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprints of all 64-byte and all 200-byte strings, each from two or three shorter ones."""
    padded = np.lib.stride_tricks.sliding_window_view(data, 8)
    level = np.ascontiguousarray(padded).view("<u8").reshape(-1)
    eight = level
    size, sixty_four = 8, None
    while size < 128:
        level = _mix(level[:-size], level[size:], size)
        size *= 2
        if size == HEAD:
            sixty_four = level
    n = len(data) - LENGTH + 1
    whole = _mix(_mix(level[:n], sixty_four[128 : 128 + n], 192), eight[192 : 192 + n], LENGTH)
    return sixty_four, whole


def runs_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, digest, first head, last head) of each run, and the heads that repeat within the text's own runs."""
    short, whole = fingerprints(data)
    least = _sliding(short, WINDOW, np.minimum)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.append(first[1:], len(least)) - 1
    place = np.arange(len(whole), dtype=np.uint64) - np.repeat(first, last - first + 1).astype(np.uint64)
    digest = np.add.reduceat(_mix(whole, place, 1), first)
    # A minimizer that stands twice under one run is the sign of a head that may repeat inside it.
    around = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    anchors = int((_sliding(around, WINDOW, np.maximum) == short).sum())
    inner = np.zeros(0, dtype=np.int64)
    if anchors != len(first):
        _, back, times = np.unique(whole, return_inverse=True, return_counts=True)
        inner = np.flatnonzero(times[back] > 1)
    return least[first], digest, first, last, inner


def spans_of(heads: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive heads (sorted) as byte spans."""
    if not len(heads):
        return []
    cuts = np.flatnonzero(np.diff(heads) > 1)
    return [(int(heads[a]), int(heads[b]) + LENGTH) for a, b in zip(np.append(0, cuts + 1), np.append(cuts, len(heads) - 1))]


RUNS = pa.schema([("row", pa.int64()), ("key", pa.int64()), ("digest", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
HEADS = pa.schema([("head", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("wanted", pa.bool_())])


def suffix_runs(texts: DataFrame) -> DataFrame:
    """Runs of all texts (row, text). Heads that repeat inside one run come as rows with a null digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            none: list[np.ndarray] = []
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(value.as_py().encode(), dtype=np.uint8)
                if len(data) < LENGTH:
                    continue
                key, digest, first, last, inner = runs_of(data)
                spans = np.array(spans_of(inner), dtype=np.int64).reshape(-1, 2)
                n = len(spans)
                parts.append([
                    np.full(len(key) + n, row, dtype=np.int64),
                    np.concatenate([key.view(np.int64), np.zeros(n, np.int64)]),
                    np.concatenate([digest.view(np.int64), np.zeros(n, np.int64)]),
                    np.concatenate([first, spans[:, 0]]).astype(np.int32),
                    np.concatenate([last, spans[:, 1] - LENGTH]).astype(np.int32),
                ])
                none.append(np.repeat([False, True], [len(key), n]))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                mask = np.concatenate(none)
                arrays = [pa.array(c, mask=mask) if f.name == "digest" else pa.array(c) for f, c in zip(RUNS, columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=RUNS)

    return texts.select("row", "text").mapInArrow(lean(work), "row long, key long, digest long, lo int, hi int")


class SuffixFamily:
    """Sorted arrays of entries (key, digest, n) whose sizes double from level to level."""

    def __init__(self):
        self.levels: list[DataFrame | None] = []

    @staticmethod
    def array(runs: DataFrame) -> DataFrame:
        """The suffix array of a batch. Copies collapse inside each task, so a huge group costs one entry a task."""
        counted = runs.groupBy("key", "digest").agg(F.count("*").alias("n"))
        return stage(counted.sortWithinPartitions("key", "digest"), "suffix-array")

    def add(self, array: DataFrame) -> DataFrame:
        """Scan the batch's array against all levels, then let it join them. Returns its shared keys.

        A key is shared if it stands twice in the batch, or in the batch and in a level.
        """
        merged = array.select("key", "n", F.lit(False).alias("old"))
        for level in self.levels:
            if level is not None:
                merged = merged.union(level.select("key", F.lit(0).alias("n"), F.lit(True).alias("old")))
        # Aggregation merges all levels in one pass, and copies of a hot key combine before the shuffle.
        seen = merged.groupBy("key").agg(F.sum("n").alias("n"), F.max("old").alias("old"))
        shared = stage(seen.where("n > 1 OR n = 1 AND old").select("key"), "shared")
        size = 0
        while size < len(self.levels) and self.levels[size] is not None:
            merged = self.levels[size].unionByName(array).groupBy("key", "digest").agg(F.sum("n").alias("n"))
            merged = stage(merged.sortWithinPartitions("key", "digest"), "suffix-level")
            drop(array, self.levels[size])
            array, self.levels[size] = merged, None
            size += 1
        self.levels += [None] * (size + 1 - len(self.levels))
        self.levels[size] = array
        return shared

    def entries(self) -> DataFrame:
        """All entries with their numbers over all levels."""
        levels = [level for level in self.levels if level is not None]
        whole = levels[0]
        for level in levels[1:]:
            whole = whole.unionByName(level)
        return whole if len(levels) == 1 else whole.groupBy("key", "digest").agg(F.sum("n").alias("n"))


def _heads(texts: DataFrame) -> DataFrame:
    """Fingerprints of the heads of given runs: texts (row, text, runs array of (lo, hi, wanted)) to (head, row, at, wanted)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, value, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                _, whole = fingerprints(np.frombuffer(value.as_py().encode(), dtype=np.uint8))
                at = np.concatenate([np.arange(r["lo"], r["hi"] + 1, dtype=np.int32) for r in runs])
                wanted = np.concatenate([np.full(r["hi"] + 1 - r["lo"], r["wanted"]) for r in runs])
                columns = [whole[at].view(np.int64), np.full(len(at), row, dtype=np.int64), at, wanted]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=HEADS)

    return texts.mapInArrow(lean(work), "head long, row long, at int, wanted boolean")


def repeated_spans(texts: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(row, lo, hi): ranges of heads of ``texts`` (row, text) that start at least twice; row is unique but for equal rows."""
    runs = stage(suffix_runs(texts), "runs")
    own = stage(runs.where("digest IS NULL").select("row", "lo", "hi"), "inner")
    real = runs.where("digest IS NOT NULL")
    family, found = SuffixFamily(), []
    for number in range(batches):
        batch = real.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == number)
        found.append(family.add(family.array(batch)))
    shared = stage(reduce(DataFrame.union, found).distinct(), "shared")
    entries = family.entries().join(shared, "key", "left_semi")
    kinds = entries.groupBy("key").agg(F.count("*").alias("kinds"))
    marked = stage(entries.join(kinds, "key").where("n > 1 OR kinds > 1"), "entries")

    hits = stage(real.join(marked, ["key", "digest"]).select("row", "lo", "hi", "key", "digest", "n", "kinds"), "hits")
    drop(runs, marked, shared, *found, *(level for level in family.levels if level is not None))
    whole = hits.where("n > 1").select("row", "lo", "hi")
    # Heads of runs that occur once are looked up among those of one example of every other run with the same key.
    single = hits.where("n = 1").select("row", "lo", "hi", F.lit(True).alias("wanted"))
    examples = (
        hits.where("n > 1 AND kinds > 1")
        .groupBy("key", "digest")
        .agg(F.min(F.struct("row", "lo", "hi")).alias("one"))
        .select("one.*", F.lit(False).alias("wanted"))
    )
    # A row that stands twice gives its heads twice, which is right: they do start twice.
    asked = single.unionByName(examples).groupBy("row").agg(F.collect_list(F.struct("lo", "hi", "wanted")).alias("runs"))
    heads = stage(_heads(texts.join(asked, "row").select("row", "text", "runs")), "heads")
    often = heads.groupBy("head").agg(F.count("*").alias("n")).where("n > 1").select("head")
    found = heads.where("wanted").join(often, "head").select("row", F.col("at").alias("lo"), F.col("at").alias("hi"))
    found = stage(found, "repeated-heads")
    drop(heads)
    return own.unionByName(whole).unionByName(found)


RESULTS = ("kept", "n_bytes", "n_removed", "n_spans")


def _cut(docs: DataFrame, batches: int, as_text: bool) -> DataFrame:
    """Every row as struct ``row`` with ``kept``, ``n_bytes``, ``n_removed`` and ``n_spans``.

    ``kept`` are the remaining bytes, or ``as_text`` their text without characters that lost some of their bytes. The row's
    own columns stay inside the struct, so their names cannot clash with ours.
    """
    key = F.xxhash64(F.col("doc_id"), text_of())
    rest = [docs[f"`{c}`"] for c in docs.columns if c != "text"]
    base = docs.select(F.struct(*rest).alias("row"), key.alias("key"), text_of().alias("text"))
    spans = repeated_spans(base.select(F.col("key").alias("row"), "text"), batches)
    spans = spans.groupBy(F.col("row").alias("key")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = base.join(spans, "key", "left").select("row", "text", "spans")
    kind, made = (T.StringType(), pa.string()) if as_text else (T.BinaryType(), pa.binary())
    schema = T.StructType([joined.schema["row"], T.StructField("kept", kind), *(T.StructField(c, T.LongType()) for c in RESULTS[1:])])

    def cut(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            kept, sizes, removed, counts = [], [], [], []
            ranges = batch.column("spans")
            ends = ranges.offsets.to_numpy()
            lo, hi = (ranges.values.field(i).to_numpy() for i in range(2))
            for i, value in enumerate(batch.column("text")):
                data, a, b = value.as_py().encode(), ends[i], ends[i + 1]
                left, spans = data, 0
                if b > a:
                    n = len(data) + 1
                    depth = np.bincount(lo[a:b], minlength=n) - np.bincount(hi[a:b] + LENGTH, minlength=n)
                    mask = np.cumsum(depth[:-1]) > 0
                    left = np.frombuffer(data, dtype=np.uint8)[~mask].tobytes()
                    spans = int(np.count_nonzero(mask[1:] > mask[:-1])) + int(mask[0])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                sizes.append(len(data))
                removed.append(len(data) - len(left))
                counts.append(spans)
            out = [batch.column("row"), pa.array(kept, made), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts))]
            yield pa.RecordBatch.from_arrays(out, names=["row", *RESULTS])

    return joined.mapInArrow(lean(cut), schema)


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, batches: int = BATCHES) -> DataFrame:
    """Every row with ``kept`` (remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans`` and the ``carry`` columns.

    Every byte under a string of 200 bytes that also starts elsewhere, in the same or another row, is removed; overlaps
    count, matches never cross texts, and all copies lose the string. A null text is empty, texts under 200 bytes
    stay as they are. Repeated rows are copies of each other. Null ids are allowed: rows are told apart by id and text.
    ``carry`` (default: doc_id) leaves out columns named as a result. An empty table gives an empty result.
    """
    kept = [c for c in (["doc_id"] if carry is None else carry) if c not in ("text", *RESULTS)]
    rows = _cut(docs.select("text", *{"doc_id": 1, **dict.fromkeys(kept)}), batches, False)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in kept], *RESULTS)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns and the remaining text in ``text``; a character that lost some of its bytes is left out."""
    rows = _cut(docs, BATCHES, True)
    return rows.select(*[F.col("kept").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
