"""Token counts by heap-and-linked-list byte-pair merging.

The bytes of a word are a doubly linked list of symbols, and a heap holds its adjacent pairs that have a merge rule, by
rank and place. The lowest pair is popped and merged again and again; pairs that a merge has changed are told by their rank
when they come up. A word of n bytes has n tokens less its merges, so no token is ever named. Each distinct word is
merged once per task, and texts stay where they are: no shuffle, nothing broadcast but the path of the vocabulary.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import text_of
from matchlens.llm.tree_bpe import UNFAMILIAR, byte_letters
from matchlens.llm.vector_packing import WORDS

LIMIT = 1024
# What a task remembers at most: so many words, none longer than this.
CACHED_WORDS, CACHED_LENGTH = 400_000, 48


class MergeTable:
    """The merge rules of a byte-level vocabulary over numbered symbols; symbol b below 256 is the byte b."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, splitter = whole["model"], whole["pre_tokenizer"] or {}
        if model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or whole["normalizer"] or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level vocabulary")
        if splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("the vocabulary splits words in another way")
        number = {letter: b for b, letter in enumerate(byte_letters())}
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(number[left] << 32 | number[right], rank)
            self.merged.append(number.setdefault(left + right, len(number)))
        self.specials = sorted((t["content"] for t in whole["added_tokens"]), key=len, reverse=True)

    def count(self, word: bytes) -> int:
        """The number of tokens of one word."""
        n = len(word)
        if n < 2:
            return n
        symbols, rank, merged = [*word, -1], self.rank, self.merged
        # A heap entry is one number, rank * n + place.
        pairs = enumerate(map(rank.get, [a << 32 | b for a, b in zip(word, word[1:])]))
        heap = [r * n + i for i, r in pairs if r is not None]
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        merges = 0
        while heap:
            r, i = divmod(heappop(heap), n)
            j = after[i]
            # The symbol behind the end is -1, as are merged ones; no rule names it. A changed pair has another rank or none.
            if symbols[i] < 0 or rank.get(symbols[i] << 32 | symbols[j]) != r:
                continue
            symbols[i] = symbol = merged[r]
            symbols[j] = -1
            after[i] = k = after[j]
            before[k] = i
            merges += 1
            if k < n and (r := rank.get(symbol << 32 | symbols[k])) is not None:
                heappush(heap, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank.get(symbols[h] << 32 | symbol)) is not None:
                heappush(heap, r * n + h)
        return n - merges


_tables: dict[str, MergeTable] = {}


def merge_table(path: str) -> MergeTable:
    if path not in _tables:
        _tables[path] = MergeTable(path)
    return _tables[path]


class Counter(dict):
    """Tokens of words and texts; short words are remembered."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.table = merge_table(path)
        self.splitter = ByteLevel(add_prefix_space=False, use_regex=True)
        self.special = re.compile("|".join(map(re.escape, self.table.specials))) if self.table.specials else None

    def __missing__(self, word: str) -> int:
        tokens = self.table.count(word.encode())
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = tokens
        return tokens

    def words(self, text: str) -> Iterator[str]:
        if not UNFAMILIAR.search(text):
            return iter(WORDS.findall(text))
        return (text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text))

    def tokens(self, text: str) -> int:
        """A special token's text is one token and cuts the words around it."""
        if self.special is None:
            return sum(map(self.__getitem__, self.words(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(p))) for p in parts if p)


COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    Tokens are those of the vocabulary's library without begin or end tokens; special tokens' texts count as one token. A
    null text is empty, and an empty text has no bytes and no tokens. Repeated rows are counted each, a null doc_id stays
    null, other columns are ignored, and an empty table gives no rows. The time of a word is n log n in its bytes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            tokens = [counter.tokens(value.as_py()) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], schema=COUNTS)

    size = F.octet_length(text_of()).cast("long")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_bytes"), text_of().alias("text"))
    counted = base.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
