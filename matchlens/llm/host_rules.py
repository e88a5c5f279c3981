"""Quality rules with verdicts on hosts.

Each document is counted once and judged by rules on those counts. Failures are added up by host, and the failure
rate of a host is shrunk toward that of all hosts by a beta prior fitted to them, so a host with few documents
is not condemned by chance. A host is rejected when even the low end of its shrunk rate is above a limit,
and its verdict goes back to its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import BLANKS, lean, stage, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """``max_host_rate``: failing share of a host's documents that the low end of its rate must exceed."""

    min_words: int = 10
    repeat_percent: int = 20
    symbol_percent: int = 10
    dup_lines: int = 3
    max_host_rate: float = 0.6
    deviations: float = 2.0


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that the text holds at least twice."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(np.fromiter((found[w] > 1 for w in windows), dtype=bool, count=len(windows)))
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((np.cumsum(covered) > 0).sum())


def count(text: str) -> tuple[int, int, int, int, int]:
    # On bytes, split() without argument splits at exactly the six ASCII blanks.
    words = text.encode().split()
    word_chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def counted(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` (text, source) with the counts as struct ``__counts`` and ``__host``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A last row of zeros gives the array of tuples its shape when the batch is empty.
            rows = [count(t.as_py()) for t in batch.column("__text")]
            found = np.array([*rows, (0,) * len(COUNTS)], dtype=np.int64)[:-1]
            counts = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))
            at = batch.schema.get_field_index("__text")
            yield batch.set_column(at, "__counts", counts)

    base = docs.select(*carry, F.col("source").cast("string").alias("__host"), text_of().alias("__text"))
    kinds = ", ".join(f"{c}: bigint" for c in COUNTS)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema][:-1] + [f"__counts struct<{kinds}>"]
    return base.mapInArrow(lean(work), ", ".join(fields))


def base_failed(limits: Limits) -> Column:
    c = F.col("__counts")
    return (c["n_words"] < limits.min_words) | (100 * c["n_repeat_words"] > limits.repeat_percent * c["n_words"])


def rule_failed(limits: Limits) -> Column:
    """Any rule at all: the base rules, too many symbols, or several repeated lines."""
    c = F.col("__counts")
    symbols = 100 * c["n_symbols"] > limits.symbol_percent * c["word_chars"]
    return base_failed(limits) | symbols | (c["n_dup_lines"] >= limits.dup_lines)


def host_verdicts(failures: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, n_docs, n_failed, rate, low, rejected) of rows (host, n_docs, n_failed).

    The prior's mean and strength come from the mean and the variance of the hosts' rates (method of
    moments, weighted by documents); only these sums leave the table. When the rates vary no more than chance
    allows, the prior is strong and all hosts share one rate.
    """
    n, rate = F.col("n_docs"), F.col("n_failed") / F.col("n_docs")
    sums = failures.agg(
        F.sum("n_failed").alias("f"), F.sum(n).alias("n"), F.sum(n * rate * rate).alias("s"), F.count("*").alias("hosts")
    ).first()
    mean = (sums["f"] or 0) / sums["n"] if sums["n"] else 0.0
    variance = max((sums["s"] or 0.0) / sums["n"] - mean * mean, 0.0) if sums["n"] else 0.0
    # Var(rate) = mean (1 - mean) / (strength + 1)
    strength = min(max(mean * (1 - mean) / variance - 1, 1.0), 1000.0) if variance > 1e-12 else 1000.0
    if (sums["hosts"] or 0) < 2:
        strength = 1.0
    a = F.lit(max(mean, 1e-6) * strength) + F.col("n_failed")
    total = F.lit(strength) + n
    shrunk = a / total
    low = shrunk - F.lit(limits.deviations) * F.sqrt(shrunk * (1 - shrunk) / (total + 1))
    return failures.select("host", "n_docs", "n_failed", shrunk.alias("rate"), low.alias("low"), (low > limits.max_host_rate).alias("rejected"))


def judged(docs: DataFrame, carry: list[str], limits: Limits = Limits()) -> DataFrame:
    """``carry`` columns of every row, with ``__counts``, ``__base_failed`` and ``__kept``.

    Rows without a host (null source) get no host verdict. Null and empty texts have no words and fail the
    base rules. Repeated rows count as often as they occur. An empty table gives an empty result. Every text is counted
    once: the rows are staged with their counts, and the hosts' totals read only those two columns.
    """
    rows = stage(counted(docs, carry), "counted")
    totals = (
        rows.groupBy(F.col("__host").alias("host"))
        .agg(F.count("*").alias("n_docs"), F.sum(rule_failed(limits).cast("long")).alias("n_failed"))
    )
    totals = stage(totals.where("host IS NOT NULL"), "hosts")
    # Staged, so that Spark knows its size and broadcasts it only when small.
    rejected = stage(host_verdicts(totals, limits).where("rejected").select(F.col("host").alias("__host"), F.lit(True).alias("__bad")), "verdicts")
    rows = rows.withColumn("__base_failed", base_failed(limits)).join(rejected, "__host", "left")
    kept = ~F.col("__base_failed") & F.col("__bad").isNull()
    return rows.select(*carry, "__counts", "__base_failed", kept.alias("__kept"))


def verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """doc_id, the five counts, base_failed, kept."""
    rows = judged(docs, ["doc_id"], limits)
    return rows.select("doc_id", "__counts.*", F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return judged(docs, docs.columns, limits).where("__kept").select(*docs.columns)
