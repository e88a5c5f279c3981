"""Ranked lexical search, one term at a time, with a limited set of accumulators.

Documents are inverted block by block, for the terms of the items alone. In a block the postings of an item's terms are
read from the rarest term on, each adding to the accumulators of its documents. As soon as the best that all remaining terms
could add is below the k-th partial score, no document without an accumulator can get into the result: no accumulator is
created any more, and the remaining postings only complete those that exist, exactly. The k-th score so far, over all
blocks of a task, serves the next block from its first term on. The best of all tasks are merged at the end.

A block has a bounded number of documents and postings, and items are taken in blocks of bounded size too, so a
task's memory does not grow with a term, an item or a table.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.common import stage, text_of

TOP = 20
BLOCK_DOCS, BLOCK_POSTINGS = 4096, 500_000
ITEM_BYTES = 4_000_000
FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(FOLD).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Items:
    """A block of items: their ids, and the numbered terms of each with their repeats."""

    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[bytes, int]


def item_blocks(items: DataFrame, limit: int = ITEM_BYTES) -> Iterator[Items]:
    """The items (item_id, text) in blocks of about ``limit`` bytes of text; a larger one is a block of its own."""
    held, size = Items([], [], [], {}), 0
    for item_id, text in items.select("item_id", text_of()).toLocalIterator():
        found = Counter(terms(text))
        if not found:
            continue
        if held.ids and size + len(text) > limit:
            yield held
            held, size = Items([], [], [], {}), 0
        numbers = [held.vocabulary.setdefault(t, len(held.vocabulary)) for t in found]
        held.ids.append(item_id)
        held.terms.append(np.array(numbers, dtype=np.int64))
        held.repeats.append(np.array(list(found.values()), dtype=np.int64))
        size += len(text)
    if held.ids:
        yield held


INDEX = pa.schema([
    ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()),
    ("terms", pa.binary()), ("starts", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary()),
])
INDEX_TYPE = "n_docs long, n_terms long, ids array<bigint>, lengths binary, terms binary, starts binary, docs binary, tfs binary"


def inverted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Blocks of postings of the terms in ``vocabulary``: which documents hold each, and how often.

    ``n_docs`` and ``n_terms`` also count the documents without any of these terms.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()

        def fresh() -> None:
            nonlocal ids, lengths, which, term, tf, n_docs, n_terms
            ids, lengths, which, term, tf = [], array("q"), array("i"), array("i"), array("i")
            n_docs = n_terms = 0

        def answer() -> pa.RecordBatch:
            number = np.frombuffer(term, np.int32) if term else np.zeros(0, np.int32)
            order = np.argsort(number, kind="stable")
            present, starts = np.unique(number[order], return_index=True)
            sides = [np.frombuffer(x, np.int32)[order] if x else np.zeros(0, np.int32) for x in (which, tf)]
            blobs = [lengths.tobytes(), present.tobytes(), starts.astype(np.int32).tobytes(), *(x.tobytes() for x in sides)]
            row = [[n_docs], [n_terms], [ids], *([b] for b in blobs)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, INDEX.types)], schema=INDEX)

        ids = lengths = which = term = tf = n_docs = n_terms = None
        fresh()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(value.as_py())
                if not words:
                    continue
                n_docs += 1
                n_terms += len(words)
                counts = Counter(words)
                found = counts.keys() & known
                if found:
                    which.extend([len(ids)] * len(found))
                    term.extend([vocabulary[t] for t in found])
                    tf.extend([counts[t] for t in found])
                    ids.append(doc_id)
                    lengths.append(len(words))
                if len(ids) >= BLOCK_DOCS or len(term) >= BLOCK_POSTINGS:
                    yield answer()
                    fresh()
        if n_docs:
            yield answer()

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(work, INDEX_TYPE)


def statistics(index: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms with repeats, and documents of each of ``size`` terms, added up per task and then by Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, totals = np.zeros(size, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                present, starts = (np.frombuffer(row[c], np.int32) for c in ("terms", "starts"))
                df[present] += np.diff(np.append(starts, len(row["docs"]) // 4))
                totals += (row["n_docs"], row["n_terms"])
        held = np.flatnonzero(df)
        numbers, counts = np.concatenate([[-2, -1], held]), np.concatenate([totals, df[held]])
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts)], names=["term", "n"])

    # One row for each term of a bounded block of items.
    sums = index.select("n_docs", "n_terms", "terms", "starts", "docs").mapInArrow(work, "term long, n long")
    found = dict(sums.groupBy("term").agg(F.sum("n")).collect())
    df = np.zeros(size, np.int64)
    for number, n in found.items():
        if number >= 0:
            df[number] = n
    return found.get(-2, 0), found.get(-1, 0), df


def best(scores: np.ndarray, ids: np.ndarray, lost: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores; equal ones by ascending id, lost ids last."""
    at = np.arange(len(scores))
    if len(scores) > top:
        at = np.flatnonzero(scores >= np.partition(scores, -top)[-top])
    return at[np.lexsort((ids[at], lost[at], -scores[at]))[:top]]


class Block:
    """The postings of one block with the share of a term's weight that each earns."""

    def __init__(self, row: dict, docs: int, words: int):
        self.ids = np.array([i if i is not None else 0 for i in row["ids"]], dtype=np.int64)
        self.lost = np.array([i is None for i in row["ids"]], dtype=bool)
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.terms, starts, self.docs, tf = (np.frombuffer(row[c], np.int32) for c in ("terms", "starts", "docs", "tfs"))
        self.ends = np.append(starts, len(self.docs))
        m = 100 - 25 + (25 * lengths * docs) // words
        tf = tf.astype(np.int64)
        self.share = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs])
        self.most = np.maximum.reduceat(self.share, starts) if len(starts) else np.zeros(0, np.int64)

    def rank(self, numbers: np.ndarray, weights: np.ndarray, known: np.ndarray, top: int) -> tuple[np.ndarray, int]:
        """(score of each document, number of accumulators) for terms in order of rarity.

        ``known`` are scores of other documents. Documents that cannot be among the ``top`` may lack an accumulator: 0.
        """
        at = np.searchsorted(self.terms, numbers)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == numbers[here]
        at, weights = at[here], weights[here]
        left = np.cumsum((weights * self.most[at])[::-1])[::-1]
        scores, open_ = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        creating = True
        for t, w, most in zip(at, weights, left):
            if creating:
                partial = np.concatenate([scores, known])
                creating = len(partial) < top or most >= np.partition(partial, -top)[-top]
            part = slice(self.ends[t], self.ends[t + 1])
            docs, gain = self.docs[part], w * self.share[part]
            if creating:
                open_[docs] = True
            else:
                held = open_[docs]
                docs, gain = docs[held], gain[held]
            scores[docs] += gain
        return scores, int(open_.sum())


FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def best_of_tasks(index: DataFrame, items: Items, top: int) -> DataFrame:
    """(item, doc_id, score): the best of each item in each task; ``item`` is a place in ``items``."""
    docs, words, df = statistics(index, len(items.vocabulary))
    plans = []
    for numbers, repeats in zip(items.terms, items.repeats):
        order = np.argsort(df[numbers], kind="stable")
        weights = np.array([weight(docs, n) if n else 0 for n in df[numbers[order]].tolist()], dtype=np.int64)
        plans.append((numbers[order], weights * repeats[order]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        kept = [none] * len(plans)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], docs, words)
                for k, (numbers, weights) in enumerate(plans):
                    scores, _ = block.rank(numbers, weights, kept[k][0], top)
                    hit = np.flatnonzero(scores)
                    hit = hit[best(scores[hit], block.ids[hit], block.lost[hit], top)]
                    both = [np.concatenate(p) for p in zip(kept[k], (scores[hit], block.ids[hit], block.lost[hit]))]
                    won = best(*both, top)
                    kept[k] = tuple(x[won] for x in both)
        for k, (scores, ids, lost) in enumerate(kept):
            if len(scores):
                columns = [pa.array(np.full(len(scores), k)), pa.array(ids, mask=lost), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    return index.mapInArrow(work, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text).

    Null texts have no terms; such items, and those that share no term with any document, have no rows. Each repeated row
    is a document or an item of its own, under the same id. A null doc_id comes after all others of its score, null
    item ids stay null. Other columns are ignored. Empty tables give no rows.
    """
    parts = []
    for block in item_blocks(items, item_bytes):
        index = stage(inverted(docs, block.vocabulary), "postings")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best_of_tasks(index, block, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        # One row for each item of a bounded block.
        names = docs.sparkSession.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {dict(items.dtypes)['item_id']}")
        parts.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    kind = dict(items.dtypes)["item_id"]
    return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
