"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over hashed character n-grams separates the
languages whose codeword has the bit from the others. A text's margins are compared with all codewords: the loss of a
codeword weighs each bit by how reliably it was predicted for that language in training, and the smallest
loss wins. A second codeword nearly as close flags the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import id_crc, stage, text_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
CHUNK = 1 << 19
SALTS = 256
SMOOTHING = 0.5
SHARPNESS = 4.0
AMBIGUOUS = 0.1
UNKNOWN = "und"


@cache
def _lower_letters() -> np.ndarray:
    """Code point to its lower-case letter, and to a space if it is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _grams(letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, buckets) for each order; n-grams of spaces alone are left out."""
    out, key = [], np.zeros(len(letters), dtype=np.uint64)
    blank = letters == 32
    empty = np.ones(len(letters), dtype=bool)
    wide = letters.astype(np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(letters) - order + 1
        if n <= 0:
            break
        key = key[:n] * np.uint64(0x9E3779B97F4A7C15) + wide[order - 1 :] + np.uint64(order)
        empty = empty[:n] & blank[order - 1 :]
        if order in ORDERS:
            mixed = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            at = np.flatnonzero(~empty)
            out.append((at, (mixed[at] >> np.uint64(49)).astype(np.int64) % BUCKETS))
    return out


def _slices(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(letters, start of each slice, its text's number): whole texts in chunks of bounded size; n-grams never cross texts."""
    held: list[str] = []
    owners: list[int] = []
    size = 0

    def pack() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(h) for h in held])[:-1]])
        return _lower_letters()[codes], starts, np.array(owners)

    reach = max(ORDERS) - 1
    for i, text in enumerate(texts):
        for at in range(0, max(len(text), 1), CHUNK):
            # A slice repeats the last letters of the one before, so no n-gram of a long text is lost; a handful count twice.
            # Spaces on both sides, so that no n-gram takes letters of two texts.
            part = " " * (0 if at else reach) + text[max(0, at - reach) : at + CHUNK] + " " * reach
            held.append(part)
            owners.append(i)
            size += len(part)
            if size >= CHUNK:
                yield pack()
                held, owners, size = [], [], 0
    if held:
        yield pack()


def gram_sums(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the weights of all n-grams, number of n-grams) of each text."""
    sums = np.zeros((len(texts), weights.shape[1]))
    totals = np.zeros(len(texts), dtype=np.int64)
    columns = np.ascontiguousarray(weights.T, dtype=np.float64)
    for letters, starts, owners in _slices(texts):
        for at, buckets in _grams(letters):
            if not len(at):
                continue
            edges = np.searchsorted(at, starts)
            ends = np.append(edges[1:], len(at))
            some = ends > edges
            for bit, column in enumerate(columns):
                np.add.at(sums[:, bit], owners[some], np.add.reduceat(column[buckets], edges[some]))
            np.add.at(totals, owners, ends - edges)
    return sums, totals


def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """Codewords of +1 and -1, one row for each language.

    Up to six languages get the exhaustive code, all ways to split them in two; more get the best of 50 random codes by
    the smallest distance between rows.
    """
    if languages <= 6:
        splits = range(1, 1 << max(languages - 1, 0))
        columns = [[1] + [1 if not s >> i & 1 else -1 for i in range(languages - 1)] for s in splits]
        return np.array(columns or [[1]] * max(languages, 1), dtype=np.int8).reshape(-1, max(languages, 1)).T
    rng, bits = np.random.default_rng(seed), int(np.ceil(15 * np.log2(languages)))
    best, best_gap = None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(languages, bits))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        gap = (apart + np.eye(languages, dtype=int) * bits).min()
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def gram_counts(texts: DataFrame, salts: int = SALTS) -> dict[str, np.ndarray]:
    """N-gram counts of each language of (lang, text): BUCKETS numbers a language, whatever the number of texts.

    Each task sends one block of counts a language. They are added up in ``salts`` groups of tasks first and then by
    language, so no group holds the blocks of all tasks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                by.setdefault(lang, []).append(text.as_py())
            for lang, own in by.items():
                total = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for letters, _, _ in _slices(own):
                    for _, buckets in _grams(letters):
                        total += np.bincount(buckets, minlength=BUCKETS)
        if counts:
            blobs = [c.tobytes() for c in counts.values()]
            salt = [TaskContext.get().partitionId() % salts] * len(blobs)
            arrays = [pa.array(list(counts)), pa.array(salt, pa.int32()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "salt", "counts"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, dtype=np.int64) for b in group["counts"])
        return pd.DataFrame({"lang": [key[0]], "counts": [total.tobytes()]})

    schema = "lang string, counts binary"
    parts = texts.mapInArrow(work, "lang string, salt int, counts binary").groupBy("lang", "salt").applyInPandas(add, schema)
    summed = parts.groupBy("lang").applyInPandas(add, schema)
    return {r["lang"]: np.frombuffer(r["counts"], dtype=np.int64) for r in summed.collect()}


def bit_weights(counts: dict[str, np.ndarray], code: np.ndarray) -> np.ndarray:
    """(BUCKETS, bits): log odds of the two sides of each bit, every language counting alike."""
    shares = np.stack([(c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS) for c in counts.values()])
    side = lambda bit, sign: shares[code[:, bit] == sign].mean(axis=0) if (code[:, bit] == sign).any() else shares.mean(axis=0)
    return np.stack([np.log(side(b, 1)) - np.log(side(b, -1)) for b in range(code.shape[1])], axis=1).astype(np.float32)


def predict(docs: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs`` (doc_id, text, lang).

    Rows whose crc32(doc_id) mod ``folds`` is ``held_fold`` are held out; the others with a lang and a letter train. The
    prediction itself sees the text alone. A text without letters is ``und`` with score 0, as are all texts when
    nothing can be learned. A null doc_id counts as empty text in the fold. Repeated rows count each; other columns
    are ignored. ``score`` is the winner's share of exp(-loss) over all languages, ``ambiguous`` means that the
    runner-up's loss is within AMBIGUOUS.
    """
    held = (F.pmod(id_crc(), F.lit(folds)) == held_fold).alias("held_out")
    base = docs.select("doc_id", held, F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    trains = ~F.col("held_out") & F.col("lang").isNotNull()
    counts = {k: c for k, c in sorted(gram_counts(base.where(trains).select("lang", "text")).items()) if c.sum()}
    if not counts:
        return base.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    names, code = list(counts), codebook(len(counts))
    weights = bit_weights(counts, code)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, totals = gram_sums([t.as_py() for t in batch.column(3)], weights)
            means = sums / np.maximum(totals, 1)[:, None]
            columns = [*batch.columns[:3], pa.array(list(means), pa.list_(pa.float64())), pa.array(totals)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang", "margins", "n"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    scored = stage(
        base.mapInArrow(margins, f"doc_id {id_type}, held_out boolean, lang string, margins array<double>, n long"), "margins"
    )

    # How often each bit comes out right for each language in training.
    known = scored.where(trains & (F.col("n") > 0) & F.col("lang").isin(names))
    rights = known.groupBy("lang").agg(*[F.avg((F.col("margins")[b] > 0).cast("double")).alias(f"b{b}") for b in range(code.shape[1])])
    ahead = {r["lang"]: np.array([r[f"b{b}"] for b in range(code.shape[1])]) for r in rights.collect()}
    right = np.stack([np.where(code[i] > 0, ahead.get(k, np.full(code.shape[1], 0.5)), 1 - ahead.get(k, np.full(code.shape[1], 0.5))) for i, k in enumerate(names)])
    trust = np.maximum(right - 0.5, 1e-3)
    trust = trust / trust.sum(axis=1, keepdims=True)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            f = np.array(batch.column(2).to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1) * SHARPNESS
            losses = np.stack([np.logaddexp(0, -code[i] * f) @ trust[i] for i in range(len(names))], axis=1)
            order = np.argsort(losses, axis=1, kind="stable")
            best = np.take_along_axis(losses, order[:, :1], axis=1)
            score = 1 / np.exp((best - losses) * SHARPNESS).sum(axis=1)
            second = np.take_along_axis(losses, order[:, 1:2], axis=1)
            close = (second - best)[:, 0] < AMBIGUOUS if len(names) > 1 else np.zeros(len(f), dtype=bool)
            none = batch.column(3).to_numpy() == 0
            labels = np.where(none, UNKNOWN, np.array(names, dtype=object)[order[:, 0]])
            columns = [*batch.columns[:2], pa.array(labels, pa.string()), pa.array(np.where(none, 0.0, score)), pa.array(close | none)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    schema = f"doc_id {id_type}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return scored.select("doc_id", "held_out", "margins", "n").mapInArrow(decode, schema)
