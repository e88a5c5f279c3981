"""Best-fit packing of documents into sequences under several capacities at once.

A piece of n tokens asks for (n tokens, 1 document, n * n attention cost). A bin has a residual capacity for each.
Pieces are placed from the longest on: among the bins where every residual suffices, the one with the smallest
weighted residual norm after placement, or the largest weighted dot product of demand and residual, takes it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import give_back, lean, spread, stage, text_of
from matchlens.llm.tree_bpe import LETTERS, UNFAMILIAR

PER_GROUP = 20_000
CACHED_WORDS = 400_000
END_OF_DOCUMENT = 2
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s0-9{LETTERS}]+|\s+(?!\S)|\s+")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. The defaults of the last two never bind before the tokens do."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> np.ndarray:
    """The bin of each piece; ``lengths`` descend. Ties go to the oldest bin."""
    limits, weights = capacity.limits(), np.array(capacity.weights)
    n = len(lengths)
    demand = np.column_stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2]) / limits
    if n and demand.max() > 1:
        raise ValueError("a piece is larger than a sequence")
    residual, names = np.ones((64, 3)), np.zeros(64, dtype=np.int64)
    smallest = demand[-1] if n else None
    bins, opened, live = np.empty(n, dtype=np.int64), 0, 0
    slack = 1e-12
    for i in range(n):
        need = demand[i]
        at = -1
        if live:
            left = residual[:live] - need
            fits = np.flatnonzero((left > -slack).all(axis=1))
            if len(fits):
                if capacity.rule == "dot":
                    at = fits[np.argmax(residual[fits] @ (weights * need))]
                else:
                    at = fits[np.argmin((left[fits] ** 2) @ weights)]
        if at < 0:
            if live == len(residual):
                residual, names = np.vstack([residual, np.ones((live, 3))]), np.concatenate([names, np.zeros(live, dtype=np.int64)])
            at, live = live, live + 1
            residual[at], names[at] = 1.0, opened
            opened += 1
        bins[i] = names[at]
        residual[at] -= need
        if (residual[at] < smallest - slack).any():
            # Not even the smallest piece fits: close the bin, keeping the order of the others.
            residual[at : live - 1], names[at : live - 1] = residual[at + 1 : live].copy(), names[at + 1 : live].copy()
            live -= 1
    return bins


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), per_group: int = PER_GROUP) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    Pieces are dealt at random over groups of about ``per_group``, which are packed independently; a group
    ends with at most a few open bins, so splitting costs a few sequences out of thousands. No group follows a
    column of the data, so none is hot. Pieces that fill a sequence skip the search.
    """
    pieces = stage(pieces, "pieces")
    groups = spread(pieces.count(), per_group)

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        lengths = group["length"].to_numpy()
        full = int((lengths >= capacity.tokens).sum())
        bins = np.concatenate([np.arange(full), full + best_fit(lengths[full:], capacity)])
        order = np.argsort(bins, kind="stable")
        sizes = lengths[order]
        ends = np.cumsum(sizes)
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        starts = np.repeat(ends[first] - sizes[first], np.diff(np.append(first, len(order))))
        offset = np.empty(len(order), dtype=np.int64)
        offset[order] = ends - sizes - starts
        group["sequence_id"] = (int(key[0]) << 40) + bins
        group["offset"] = offset
        give_back()
        return group.drop(columns="grp")

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.repartition(groups, "grp").groupBy("grp").applyInPandas(place, schema)


class Words(dict):
    """Packed ids of each word, filled on first use; starts anew when full."""

    def __init__(self, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        out = self[word] = np.array(self.encoding.encode_ordinary(word), dtype="<u4").tobytes()
        return out


class Coder:
    """Texts to packed ids with a byte-level vocabulary and its rank file, which hold the same tokens."""

    def __init__(self, vocabulary: str, ranks: str):
        self.vocabulary = vocabulary
        with open(vocabulary, encoding="utf-8") as file:
            self.specials = [t["content"] for t in json.load(file)["added_tokens"]]
        self.words = Words(ranks)

    @cached_property
    def tokenizer(self):
        """The library itself, made when the first text needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.vocabulary)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        return tokenizer

    def encode(self, text: str) -> bytes:
        if UNFAMILIAR.search(text) or any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.words.__getitem__, WORDS.findall(text)))


_coders: dict[tuple[str, str], Coder] = {}


def coder(vocabulary: str, ranks: str) -> Coder:
    if (vocabulary, ranks) not in _coders:
        _coders[vocabulary, ranks] = Coder(vocabulary, ranks)
    return _coders[vocabulary, ranks]


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def tokenised_pieces(docs: DataFrame, vocabulary: str, ranks: str, tokens: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``tokens`` ids of every row of ``docs`` (doc_id, text), each document ended by one id.

    Only longer documents are cut; then all pieces but the first are full. ``with_ids`` adds the ids as
    little-endian unsigned 32-bit numbers. A null or empty text is the closing id alone. Repeated rows give repeated
    pieces, a null doc_id stays null, other columns are ignored.
    """
    end = np.array([END_OF_DOCUMENT], dtype="<u4").tobytes()
    fields = PIECES if with_ids else pa.schema(list(PIECES)[:5])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(vocabulary, ranks)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = made.encode(value.as_py()) + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    size = (n - start) % tokens or tokens
                    part = ids[4 * start : 4 * (start + size)]
                    rows.append((doc_id, piece, start, size, zlib.crc32(part), part)[: len(fields)])
                    start, piece = start + size, piece + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), fields.types)], schema=fields)
        made.words.clear()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(lean(work), schema)


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str, capacity: Capacity = Capacity()) -> DataFrame:
    return pack(tokenised_pieces(docs, vocabulary, ranks, capacity.tokens), capacity)
