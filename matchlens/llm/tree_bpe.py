"""BPE encoding and decoding; long unsplit words are encoded in parallel leaves and joined as a tree.

Text is split into words by the vocabulary's own rules, and a word's result is looked up, so each distinct word
is merged once per worker. No word reaches over a blank, so whole runs between blanks are looked up first. A word longer than a leaf would make one task slow, so its leaves are encoded by separate
tasks. Two neighbouring encodings are joined by encoding a window around the join again, and doubling that
window until its outer halves on both sides repeat the tokens that were there; from there on the two
encodings already agree with the encoding of the whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.common import stage, text_of

LEAF = 4096
CACHED_WORDS = 400_000
CACHED_RUNS, CACHED_LETTERS = 300_000, 1 << 24
WORD_END = "</w>"

LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
# Characters for which Python's classes, lower-casing and normal form equal those of the tokenizer's library.
UNFAMILIAR = re.compile("[^\x00-\x1b\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ſ]")
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte: itself if printable, else the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Merges:
    """The merge rules of a vocabulary file, applied to symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}

    def encode(self, symbols: Sequence[str]) -> list[str]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until no rule applies."""
        tokens: list[str | None] = list(symbols)
        after = [*range(1, len(tokens)), -1]
        before = list(range(-1, len(tokens) - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if (r := self.rank.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j] = a + b, None
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y >= 0 and (r := self.rank.get((tokens[x], tokens[y]))) is not None:
                    heapq.heappush(heap, (r, x, tokens[x], tokens[y]))
        return [t for t in tokens if t is not None]

    def split(self, token: str) -> list[str]:
        """The symbols a token was merged from."""
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            letters = list(token[: -len(WORD_END)])
            return [*letters[:-1], letters[-1] + WORD_END]
        return list(token)

    def join(self, left: list[str], right: list[str], window: int = 4) -> list[str]:
        """The encoding of the concatenation, given those of its two sides."""
        while True:
            a, b = left[-window:], right[:window]
            middle = self.encode([s for t in (*a, *b) for s in self.split(t)])
            half = window // 2
            left_agrees = len(a) == len(left) or middle[:half] == a[:half]
            right_agrees = len(b) == len(right) or middle[-half:] == b[-half:]
            if left_agrees and right_agrees:
                return left[: len(left) - len(a)] + middle + right[len(b) :]
            window *= 2

    def join_all(self, leaves: list[list[str]]) -> list[str]:
        while len(leaves) > 1:
            paired = [self.join(a, b) for a, b in zip(leaves[::2], leaves[1::2])]
            leaves = paired + leaves[len(leaves) & ~1 :]
        return leaves[0]


class Encoder:
    """Texts to ids with a vocabulary file of word-end BPE, one per worker."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.leaf = leaf
        self.merges = Merges(path)
        specials = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.unsplit = re.compile(rf"\S{{{leaf + 1}}}")
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        self.words: dict[str, tuple[str, str]] = {}
        # Ids and tokens of whole runs between blanks, which may be several words.
        self.ids: dict[str, str] = {}
        self.shown: dict[str, str] = {}
        self.held = 0

    def _pair(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), " ".join(map(self.tokenizer.id_to_token, ids))

    def _word(self, word: str) -> tuple[str, str]:
        """Ids and tokens of a word of ``WORDS`` in familiar letters, which the rules neither change nor split any more."""
        if word not in self.words:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            tokens = self.model.tokenize("".join([self.letters[b] for b in word.encode()]))
            self.words[word] = " ".join([str(t.id) for t in tokens]), " ".join([t.value for t in tokens])
        return self.words[word]

    def _learn(self, runs: list[str]) -> None:
        """Make ``ids`` and ``shown`` hold these runs."""
        fresh = set(runs).difference(self.ids)
        if not fresh:
            return
        self.held += sum(map(len, fresh))
        if len(self.ids) + len(fresh) > CACHED_RUNS or self.held > CACHED_LETTERS:
            self.ids.clear()
            self.shown.clear()
            fresh = set(runs)
            self.held = sum(map(len, fresh))
        for run in fresh:
            self.ids[run], self.shown[run] = (" ".join(filter(None, part)) for part in zip(*map(self._word, WORDS.findall(run))))

    def pieces(self, text: str) -> list[tuple[bool, str]]:
        """(is a special token, text) in order."""
        if self.special is None or "<" not in text:
            return [(False, text)]
        out, at = [], 0
        for match in self.special.finditer(text):
            out += [(False, text[at : match.start()]), (True, match.group())]
            at = match.end()
        return [*out, (False, text[at:])]

    def is_long(self, text: str) -> bool:
        return len(text) > self.leaf and self.unsplit.search(text) is not None

    def encode(self, text: str) -> tuple[str, str, int]:
        """(ids joined by spaces, decoded text, number of tokens) of a text without long words."""
        ids: list[str] = []
        shown: list[str] = []
        for special, piece in self.pieces(text):
            if not special and not UNFAMILIAR.search(piece):
                runs = piece.lower().split()
                self._learn(runs)
                ids += map(self.ids.__getitem__, runs)
                shown += map(self.shown.__getitem__, runs)
                continue
            coded = [self.tokenizer.token_to_id(piece)] if special else self.tokenizer.encode(piece, add_special_tokens=False).ids
            for parts, part in zip((ids, shown), self._pair(coded)):
                parts.append(part)
        joined = " ".join(filter(None, ids))
        return joined, " ".join(filter(None, shown)), joined.count(" ") + 1 if joined else 0

    def leaves(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """(word number, symbols of one leaf) in order; a special token is one symbol of its own."""
        word = 0
        for special, piece in self.pieces(text):
            if special:
                yield word, [piece]
                word += 1
                continue
            normal = self.tokenizer.normalizer.normalize_str(piece) if self.tokenizer.normalizer else piece
            for shown, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                symbols = [*shown[:-1], shown[-1] + WORD_END]
                for at in range(0, len(symbols), self.leaf):
                    yield word, symbols[at : at + self.leaf]
                word += 1


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, leaf: int) -> Encoder:
    if (path, leaf) not in _encoders:
        _encoders[path, leaf] = Encoder(path, leaf)
    return _encoders[path, leaf]


OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.string()), ("decoded", pa.string()), ("n_tokens", pa.int64()), ("text", pa.string())])


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode_texts(docs: DataFrame, vocabulary: str, leaf: int = LEAF, digests: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids, decoded.

    ``ids`` are decimal ids joined by spaces and ``decoded`` is the text that they decode to, special tokens included;
    with ``digests`` both are replaced by their sha256. A null text is empty and an empty text has no
    tokens. Repeated rows are encoded each, a null doc_id stays null, other columns are ignored.
    """
    fold = _sha if digests else str

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, leaf)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                if coder.is_long(text):
                    rows.append((doc_id, None, None, None, text))
                else:
                    ids, decoded, n = coder.encode(text)
                    rows.append((doc_id, fold(ids), fold(decoded), n, None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), OUT.types)], schema=OUT)

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    coded = stage(base.mapInArrow(work, "doc_id long, ids string, decoded string, n_tokens long, text string"), "encoded")
    short = coded.where("n_tokens IS NOT NULL").select("doc_id", "n_tokens", "ids", "decoded")
    return short.unionByName(_encode_long(coded.where("n_tokens IS NULL").select("doc_id", "text"), vocabulary, leaf, digests))


def _encode_long(docs: DataFrame, vocabulary: str, leaf: int, digests: bool) -> DataFrame:
    """The same for texts with long words: leaves are dealt over all tasks, then joined per document."""
    import pandas as pd

    fold = _sha if digests else str

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, leaf)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                # Leaves leave in bounded batches, whatever the length of the text.
                held: list[tuple] = []
                for order, (word, symbols) in enumerate(coder.leaves(text)):
                    held.append((row, doc_id, word, order, symbols))
                    if len(held) == 4096:
                        yield _leaf_batch(held)
                        held = []
                if held:
                    yield _leaf_batch(held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(vocabulary, leaf).merges
        special = {t.content for t in encoder(vocabulary, leaf).tokenizer.get_added_tokens_decoder().values()}
        for batch in batches:
            tokens = [s if len(s) == 1 and s[0] in special else merges.encode(s) for s in batch.column(4).to_pylist()]
            yield batch.set_column(4, "symbols", pa.array(tokens, pa.list_(pa.string())))

    def assemble(group: pd.DataFrame) -> pd.DataFrame:
        coder = encoder(vocabulary, leaf)
        words: dict[int, list[list[str]]] = {}
        for word, tokens in group.sort_values("ord")[["word", "symbols"]].itertuples(index=False):
            words.setdefault(word, []).append(list(tokens))
        tokens = [t for leaves in words.values() for t in coder.merges.join_all(leaves)]
        ids = " ".join(str(coder.tokenizer.token_to_id(t)) for t in tokens)
        row = {"doc_id": group["doc_id"].iloc[0], "n_tokens": len(tokens), "ids": fold(ids), "decoded": fold(" ".join(tokens))}
        return pd.DataFrame([row]).astype({"doc_id": "Int64"})

    schema = "row string, doc_id long, word long, ord long, symbols array<string>"
    # Repeated rows are encoded once; their number comes back below.
    distinct = docs.groupBy(F.sha2(F.concat_ws("|", F.col("doc_id").cast("string"), "text"), 256).alias("row"), "doc_id", "text")
    distinct = distinct.agg(F.count("*").alias("repeats"))
    leaves = distinct.select("row", "doc_id", "text").mapInArrow(cut, schema).repartition("row", "ord")
    whole = leaves.mapInArrow(encode, schema).groupBy("row").applyInPandas(
        lambda key, group: assemble(group).assign(row=key[0]), "doc_id long, n_tokens long, ids string, decoded string, row string"
    )
    repeated = whole.join(distinct.select("row", "repeats"), "row")
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return repeated.withColumn("copy", copies).select("doc_id", "n_tokens", "ids", "decoded")


LEAVES = pa.schema([("row", pa.string()), ("doc_id", pa.int64()), ("word", pa.int64()), ("ord", pa.int64()), ("symbols", pa.list_(pa.string()))])


def _leaf_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), LEAVES.types)], schema=LEAVES)


def decode_ids(coded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, decoded) of rows (doc_id, ids): the tokens' texts joined by spaces, as this vocabulary decodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(vocabulary, LEAF).tokenizer
        for batch in batches:
            ids = [[int(i) for i in (x or "").split()] for x in batch.column(1).to_pylist()]
            texts = tokenizer.decode_batch(ids, skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return coded.select("doc_id", "ids").mapInArrow(work, "doc_id long, decoded string")
