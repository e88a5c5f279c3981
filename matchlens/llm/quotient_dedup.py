"""Exact deduplication with mergeable counting quotient filters.

Each partition packs the 64-bit fingerprints of its texts into counting quotient filters, one for each segment
of the fingerprint space: the quotient of a fingerprint selects a run, and the run holds sorted remainders
with counts. Filters of one segment merge without loss by merging their sorted remainders. Fingerprints whose
merged count exceeds one are the only ones whose texts are compared byte by byte.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import SPACE, spread, stage, text_of

PER_SEGMENT = 500_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", " ")


class QuotientFilter:
    """Sorted 64-bit fingerprints with counts, packed as runs of remainders.

    ``base`` and ``shift`` describe the segment: its fingerprints share the top ``64 - shift`` bits. With n entries the
    quotient takes about log2(n) of the remaining bits, and only the remainder is stored.
    """

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray):
        self.fingerprints, self.counts = fingerprints, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray) -> QuotientFilter:
        return cls(*np.unique(fingerprints, return_counts=True))

    def pack(self, shift: int) -> bytes:
        n = len(self.fingerprints)
        quotient_bits = min(shift, max(1, int(n).bit_length() - 1))
        width = shift - quotient_bits
        low = self.fingerprints & np.uint64((1 << shift) - 1)
        quotients = (low >> np.uint64(width)).astype(np.int64)
        run_lengths = np.bincount(quotients, minlength=1 << quotient_bits).astype("<u4")
        occupied = np.packbits(run_lengths > 0)
        nbytes = -(-width // 8)
        remainders = (low & np.uint64((1 << width) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :nbytes]
        many = np.flatnonzero(self.counts > 1).astype("<u4")
        parts = [
            struct.pack("<BIII", quotient_bits, n, int((run_lengths > 0).sum()), len(many)),
            occupied.tobytes(),
            run_lengths[run_lengths > 0].tobytes(),
            np.ascontiguousarray(remainders).tobytes(),
            many.tobytes(),
            self.counts[many].astype("<u8").tobytes(),
        ]
        return b"".join(parts)

    @classmethod
    def unpack(cls, blob: bytes, segment: int, shift: int) -> QuotientFilter:
        quotient_bits, n, runs, many = struct.unpack_from("<BIII", blob)
        at = struct.calcsize("<BIII")

        def take(kind: str, length: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, dtype=kind, count=length, offset=at)
            at += out.nbytes
            return out

        occupied = np.flatnonzero(np.unpackbits(take("u1", -(-(1 << quotient_bits) // 8)))[: 1 << quotient_bits])
        quotients = np.repeat(occupied.astype(np.uint64), take("<u4", runs))
        width = shift - quotient_bits
        nbytes = -(-width // 8)
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :nbytes] = take("u1", n * nbytes).reshape(n, nbytes)
        low = (quotients << np.uint64(width)) | wide.reshape(-1).view("<u8")
        counts = np.ones(n, dtype=np.int64)
        where = take("<u4", many)
        counts[where] = take("<u8", many)
        high = np.uint64(segment << shift) if shift < 64 else np.uint64(0)
        return cls(high | low, counts)

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Both are sorted, so a merge of the sorted runs finds equal fingerprints side by side."""
        both = np.concatenate([self.fingerprints, other.fingerprints])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, other.counts])[order]
        starts = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        return QuotientFilter(both[starts], np.add.reduceat(counts, starts) if len(both) else counts)


def merge_all(filters: list[QuotientFilter]) -> QuotientFilter:
    """Merge neighbours pairwise, so each entry is moved a logarithmic number of times."""
    while len(filters) > 1:
        filters = [a.merge(b) for a, b in zip(filters[::2], filters[1::2])] + filters[len(filters) & ~1 :]
    return filters[0]


def repeated_fingerprints(fingerprints: DataFrame, rows: int, per_segment: int = PER_SEGMENT) -> DataFrame:
    """(fp, n) of all values of the column ``fp`` that occur more than once.

    Segments follow the number of rows, so a merged segment holds about ``per_segment`` entries. A value that
    fills a third of the table is one entry with a count in each filter.
    """
    bits = (spread(rows, per_segment) - 1).bit_length()
    shift = 64 - bits

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [QuotientFilter.of(b["fp"].to_numpy().view(np.uint64)) for b in batches if len(b)]
        if not parts:
            return
        whole = merge_all(parts)
        segments = (whole.fingerprints >> np.uint64(shift)).astype(np.int64) if bits else np.zeros(len(whole.fingerprints), np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], segments[1:] != segments[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            blob = QuotientFilter(whole.fingerprints[a:b], whole.counts[a:b]).pack(shift)
            yield pd.DataFrame({"segment": [int(segments[a])], "filter": [blob]})

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = merge_all([QuotientFilter.unpack(blob, int(key[0]), shift) for blob in group["filter"]])
        many = whole.counts > 1
        return pd.DataFrame({"fp": whole.fingerprints[many].view(np.int64), "n": whole.counts[many]})

    filters = fingerprints.select("fp").mapInPandas(build, "segment long, filter binary")
    return filters.groupBy("segment").applyInPandas(merge, "fp long, n long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same bytes after each run of white space became one space; a null text
    is empty. The smallest doc_id of equal texts stays. Of repeated rows with one doc_id and equal texts one
    stays; a null doc_id comes after all others. Other columns are ignored, an empty table gives no rows.

    Text is shuffled only for fingerprints that occur more than once, and there Spark first combines equal
    texts inside each task, so a huge group of copies costs one text for each task.
    """
    base = docs.select("doc_id", normalised(text_of()).alias("norm"))
    hashed = base.select("doc_id", F.xxhash64("norm").alias("fp"), F.sha2("norm", 256).alias("text_sha256"))
    hashed = stage(hashed, "fingerprints")
    repeated = stage(repeated_fingerprints(hashed, hashed.count()), "repeated")
    # Byte verification: the text itself is the grouping key.
    suspects = base.withColumn("fp", F.xxhash64("norm")).join(repeated, "fp", "left_semi")
    verified = suspects.groupBy("fp", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = verified.select(F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    rows = hashed.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("repeats"))
    joined = rows.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy"),
        "text_sha256",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
