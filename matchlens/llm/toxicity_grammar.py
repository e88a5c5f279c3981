"""Toxicity scores from a weighted finite-state grammar over clauses.

A text is a sequence of symbols: insults and threats with weights learned from labels, targets, negations, reporting
verbs, quotation marks and clause breaks. One small transducer follows each of these: it reads symbols, changes between
two states and adds a mark to some of the symbols it passes on. Negation marks later insults and threats of the clause as
denied, an open quotation marks them as quoted; a reporting verb, a target, an insult and a threat mark the break that ends
their clause. The transducers are composed once into one table, which reads a text symbol by symbol and adds up the
weights of each clause by their marks. A logistic model over the matched clauses gives the score, so a word inside a
denied or reported clause counts as such a clause, not as the word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import id_crc, stage, text_of

# Fixed word classes of the grammar; insults and the weights of threats are learned.
THREATS = frozenset("kill hurt destroy beat burn shoot stab crush attack punish töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset("you your yours he him she her they them their du dich dein ihr euch sie tu te toi vous votre ils elles tú ti usted ustedes ellos".split())
NEGATIONS = frozenset("not no never neither nor nicht kein keine nie ne pas jamais aucun nunca jamás ningún".split())
REPORTS = frozenset("said says say told reported called claims wrote sagte sagt schrieb dit disait raconte dijo dice escribió".split())
TOKENS = re.compile(r"[^\W\d_]+|[.;:!?|\n\"“”«»]")
BREAKS, QUOTES = frozenset(".;:!?|\n"), frozenset('"“”«»')

PREFIXES = range(4, 9)
MIN_LOG_ODDS = 2.0
ERRORS = 2.0
LEXICON_ROWS = 200_000
FIT_ROWS = 20_000
SHARES = 1 << 30
FLUSH = 200_000
CACHED_WORDS = 300_000
FEATURES = ("plain_max", "plain_sum", "plain_clauses", "denied", "reported", "aimed", "threat", "weak_threat", "hits")


def patterns_of(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if n < len(word))]


def distinct_patterns(text: str) -> set[str]:
    words = {w for w in TOKENS.findall(text.lower()) if len(w) > 1}
    return {p for w in words for p in patterns_of(w)}


def pattern_counts(texts: DataFrame) -> DataFrame:
    """(pattern, n, m): number of toxic and of clean texts (text, toxic) that hold each pattern."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean: Counter[str] = Counter()
        toxic: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            patterns = list(toxic.keys() | clean.keys())
            numbers = [pa.array([c[p] for p in patterns], pa.int64()) for c in (toxic, clean)]
            return pa.RecordBatch.from_arrays([pa.array(patterns, pa.string()), *numbers], names=["pattern", "n", "m"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                (toxic if label else clean).update(distinct_patterns(text.as_py()))
                if len(toxic) + len(clean) > FLUSH:
                    yield out()
                    toxic.clear()
                    clean.clear()
        if toxic or clean:
            yield out()

    parts = texts.select("text", "toxic").mapInArrow(work, "pattern string, n long, m long")
    return parts.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def learn_weights(labelled: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of insults and of threats from (doc_id, text, toxic); equal texts count once.

    An insult is a pattern whose log odds for toxic texts exceed MIN_LOG_ODDS by ERRORS standard errors, however rare it is;
    its weight are the log odds. Counting and choosing are one aggregation, and only the chosen ones reach the driver.
    The labelled sample bounds their number. A threat weighs 1 and as much more as its log odds surely exceed 0.
    """
    first = labelled.groupBy(F.xxhash64("text", "toxic")).agg(F.min("doc_id").alias("doc_id"))
    once = labelled.join(F.broadcast(first), "doc_id", "left_semi")
    sizes = once.agg(F.sum((F.col("toxic") == 1).cast("long")).alias("pos"), F.sum((F.col("toxic") == 0).cast("long")).alias("neg")).first()
    pos, neg = sizes["pos"] or 0, sizes["neg"] or 0
    if not pos or not neg:
        return {}, {}
    odds = F.log((F.col("n") + 0.5) / (pos + 1)) - F.log((F.col("m") + 0.5) / (neg + 1))
    error = F.sqrt(1 / (F.col("n") + 0.5) + 1 / (F.col("m") + 0.5))
    known = pattern_counts(once).withColumn("odds", odds).withColumn("surely", odds - ERRORS * error)
    rows = known.where((F.col("surely") >= MIN_LOG_ODDS) | F.col("pattern").isin(sorted(THREATS))).collect()
    insults = {r["pattern"]: r["odds"] for r in rows if r["surely"] >= MIN_LOG_ODDS}
    return insults, {r["pattern"]: 1 + max(0.0, r["surely"]) for r in rows if r["pattern"] in THREATS}


Symbol = frozenset[str]


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol read) to (next state, symbol put out), over all symbols it can meet."""

    start: Hashable
    arcs: dict[tuple[Hashable, Symbol], tuple[Hashable, Symbol]]

    def outputs(self) -> set[Symbol]:
        return {out for _, out in self.arcs.values()}


def switch(symbols: Iterable[Symbol], on: str, off: str, marked: set[str], mark: str) -> Transducer:
    """A two-state transducer: ``on`` opens it, ``off`` closes it; while open, it adds ``mark`` to symbols of the ``marked`` kinds.

    With ``on`` equal to ``off`` such symbols open and close it in turns. A symbol that closes it is still marked.
    """
    arcs = {}
    for symbol in symbols:
        for state in (False, True):
            then = not state if on == off and on in symbol else on in symbol or state and off not in symbol
            arcs[state, symbol] = (then, symbol | {mark} if state and symbol & marked else symbol)
    return Transducer(False, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """``second`` reads what ``first`` puts out; only states that can be reached."""
    symbols = {symbol for _, symbol in first.arcs}
    start = (first.start, second.start)
    arcs, seen, left = {}, {start}, [start]
    while left:
        state = left.pop()
        for symbol in symbols:
            a, between = first.arcs[state[0], symbol]
            b, out = second.arcs[state[1], between]
            arcs[state, symbol] = ((a, b), out)
            if (a, b) not in seen:
                seen.add((a, b))
                left.append((a, b))
    return Transducer(start, arcs)


KINDS = ("insult", "threat", "target", "negation", "report", "quote", "break")
HITS = {"insult", "threat"}


def clause_grammar() -> Transducer:
    """Negation, reported speech (quotations and verbs), target, insult and threat, composed in this order."""
    rules = [
        ("negation", "break", HITS, "denied"),
        ("quote", "quote", HITS, "quoted"),
        ("report", "break", {"break"}, "reported"),
        ("target", "break", {"break"}, "aimed"),
        ("insult", "break", {"break"}, "insulting"),
        ("threat", "break", {"break"}, "threatening"),
    ]
    whole = switch([frozenset({k}) for k in KINDS], *rules[0])
    return reduce(lambda built, rule: compose(built, switch(built.outputs(), *rule)), rules[1:], whole)


class Clause(NamedTuple):
    """Weights of the insults and threats of a clause, plain, denied and quoted, its number of insults, and its marks."""

    insults: tuple[float, float, float]
    threats: tuple[float, float, float]
    hits: int
    reported: bool
    aimed: bool


class Grammar:
    """The composed table, run over the symbols of a text."""

    def __init__(self, insults: dict[str, float], threats: dict[str, float] | None = None):
        self.insults, self.threats = insults, threats or {}
        self.known: dict[str, tuple[int, float] | None] = {}
        whole = clause_grammar()
        numbers = {whole.start: 0}
        for state, _ in whole.arcs:
            numbers.setdefault(state, len(numbers))
        self.table: list[list] = [[None] * len(KINDS) for _ in numbers]
        for (state, symbol), (then, out) in whole.arcs.items():
            kind = next(k for k in KINDS if k in symbol)
            self.table[numbers[state]][KINDS.index(kind)] = (numbers[then], self.action(kind, out))

    @staticmethod
    def action(kind: str, out: Symbol) -> int | tuple[bool, bool] | None:
        """What an arc does: add to one of six sums, end a matched clause (reported, aimed), or, as -1, an unmatched one."""
        if kind in HITS:
            return 3 * (kind == "threat") + (1 if "denied" in out else 2 if "quoted" in out else 0)
        if kind != "break":
            return None
        matched = "insulting" in out or {"threatening", "aimed"} <= out
        return ("reported" in out, "aimed" in out) if matched else -1

    def symbol(self, token: str) -> tuple[int, float] | None:
        """Kind and weight of a token, none for words outside the grammar. The fixed classes go before learned insults."""
        if token in THREATS:
            return KINDS.index("threat"), self.threats.get(token, 1.0)
        for kind, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("quote", QUOTES), ("break", BREAKS)):
            if token in words:
                return KINDS.index(kind), 0.0
        weight = max((self.insults.get(p, 0.0) for p in patterns_of(token)), default=0.0)
        return (KINDS.index("insult"), weight) if weight > 0 else None

    def symbols(self, text: str) -> list[tuple[int, float]]:
        tokens = TOKENS.findall(text.lower())
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = self.symbol(token)
        return [s for t in tokens if (s := known[t])]

    def clauses(self, text: str) -> list[Clause]:
        """The clauses with an insult, or with a threat and a target. A quotation goes on over breaks until it closes."""
        out: list[Clause] = []
        symbols = self.symbols(text)
        if not any(kind < 2 for kind, _ in symbols):
            return out
        state, hits, sums = 0, 0, [0.0] * 6
        for kind, weight in [*symbols, (KINDS.index("break"), 0.0)]:
            state, action = self.table[state][kind]
            if action is None:
                continue
            if kind < 2:
                sums[action] += weight
                hits += kind == 0
                continue
            if action != -1:
                out.append(Clause(tuple(sums[:3]), tuple(sums[3:]), hits, *action))
            hits, sums = 0, [0.0] * 6
        return out

    def features(self, text: str) -> list[float]:
        found = self.clauses(text)
        plain = [c.insults[0] for c in found if c.insults[0] and not c.reported]
        sums = [
            sum(plain),
            len(plain),
            sum(c.insults[1] for c in found),
            sum(c.insults[2] + c.insults[0] * c.reported for c in found),
            sum(sum(c.insults) for c in found if c.aimed),
            sum(c.threats[0] for c in found if c.aimed and not c.reported),
            sum(c.threats[1] + c.threats[2] + c.threats[0] * c.reported for c in found if c.aimed),
            sum(c.hits for c in found),
        ]
        return [max(plain, default=0.0), *(float(np.log1p(x)) for x in sums)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights and, last, the bias, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty @ w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return w


def sampled_labels(labels: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """About ``rows`` labels (doc_id, toxic, share), all if there are fewer, and the number of labels before.

    ``share`` is a hash of the id, even over [0, SHARES); a sample holds the labels below a limit. Ids are
    distinct, so its size strays from ``rows`` by a few square roots of it, and it may be broadcast.
    """
    known = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    found = known.count()
    return stage(known.where(F.col("share") < share_of(rows, found)), "labels"), found


def share_of(rows: int, found: int) -> int:
    return SHARES if found <= rows else SHARES * rows // found


def score(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, lexicon_rows: int = LEXICON_ROWS, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic) of rows whose crc32(doc_id) mod ``folds`` is not ``held_fold`` train; null labels and labels
    without a document are ignored. About ``lexicon_rows`` of them, those with the smallest hashes of their ids, give the
    lexicon, and the logistic model over the clause features is fitted to about ``fit_rows`` of these. Null and empty
    texts have no clause; a null doc_id counts as empty text in the fold and has no label. Repeated rows count each.
    Without labels of both kinds the score is the share of toxic labels, or 0 without any.
    """
    held = F.pmod(id_crc(), F.lit(folds)) == held_fold
    base = docs.select("doc_id", held.alias("held_out"), text_of().alias("text"))
    sample, found = sampled_labels(labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held), lexicon_rows)
    texts = base.where(~F.col("held_out")).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    insults, threats = learn_weights(stage(texts, "labelled"))
    id_type = base.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(insults, threats)
        for batch in batches:
            rows = [grammar.features(t.as_py()) for t in batch.column(2)]
            values = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], values], names=["doc_id", "held_out", "features"])

    measured = stage(base.mapInArrow(measure, f"doc_id {id_type}, held_out boolean, features array<double>"), "features")
    fit = F.broadcast(sample.where(F.col("share") < share_of(fit_rows, found)))
    rows = measured.where(~F.col("held_out")).join(fit, "doc_id").select("features", "toxic").collect()
    y = np.array([r["toxic"] for r in rows], dtype=np.float64)
    if len(y) and 0 < y.sum() < len(y):
        w = fit_logistic(np.array([r["features"] for r in rows]), y)
    else:
        share = float(y.mean()) if len(y) else 0.0
        w = np.array([0.0] * len(FEATURES) + [np.log((share + 1e-12) / (1 - share + 1e-12))])
    dot = F.lit(float(w[-1]))
    for i, weight in enumerate(w[:-1]):
        dot = dot + F.lit(float(weight)) * F.col("features")[i]
    value = 1 / (1 + F.exp(-dot))
    return measured.select("doc_id", "held_out", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
