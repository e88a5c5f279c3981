"""The Merkle manifest, the ranked search and the token counts against brute force and the tokenizer's library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchlens.llm import heap_counts, queries, taat_search, veb_merkle

SMALL = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "a", "The end.\n\nThe  end.", "word " * 3000, "é漢字 ΑΣ İ <|endoftext|> 'S x\u0085y", (None, "a"), (None, None),
    (3, "a"), "<|endoftext|><|endoftext|> <|endoftext", "²³ 1234 ١٢  x \x1c y", "\U0001f600‍ don't DON'T we'll  \t\n z", "aaaaab" * 200,
]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merge(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, index):
    for level in levels[:-1]:
        first = index - index % 16
        yield level[first:index], level[index + 1 : first + 16]
        index //= 16


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text), sorted."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((h(*map(coded, row)), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in trees.values():
        leaves.sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    inner = {s: merge([leaf for leaf, _ in trees[s]]) for s in order}
    top = merge([inner[s][-1][0] for s in order])
    found = []
    for k, s in enumerate(order):
        for i, (leaf, row) in enumerate(trees[s]):
            node = leaf
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = h(*map(coded, (*row[:4], re.sub("[A-Z]", lambda m: m.group().lower(), row[4]))))
            proof = ""
            for left, right in [*climb(inner[s], i), *climb(top, k)]:
                proof += "".join(left + right)
                node = h(*left, node, *right)
            found.append((row[0], leaf, inner[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return sorted(found, key=repr)


def test_layout_and_addresses_agree():
    for arity in (2, 3, 16):
        for n in (1, 2, 3, 4, 5, 9, 16, 17, 40, 81, 300):
            for levels in range(veb_merkle.merges_of(n, arity) + 1, 7):
                places = veb_merkle.layout(levels, n, arity)
                assert sorted(x for level in places for x in level.tolist()) == list(range(veb_merkle.size(levels, n, arity)))
                for k, level in enumerate(places):
                    assert level.tolist() == [veb_merkle.address(levels, n, k, i, arity) for i in range(len(level))]


def test_lower_subtrees_are_contiguous():
    places = veb_merkle.layout(4, 8, 2)
    # Two levels on top, then four subtrees of one inner node and two leaves.
    assert [level.tolist() for level in places] == [[4, 5, 7, 8, 10, 11, 13, 14], [3, 6, 9, 12], [1, 2], [0]]


def test_siblings_of_one_leaf_equal_those_of_all():
    for n in (1, 2, 16, 17, 250, 256, 300):
        leaves = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(n)]
        merges = veb_merkle.merges_of(n)
        nodes = veb_merkle.subtree(leaves, merges)
        root = merge([x.hex() for x in leaves])[-1][0]
        assert nodes[:32].hex() == root
        paths = veb_merkle.all_siblings(nodes, merges, n)
        for i in {0, n // 2, n - 1}:
            assert list(veb_merkle.unpacked(paths[i])) == veb_merkle.siblings(nodes, merges, n, i)
            assert veb_merkle.fold(leaves[i], paths[i]).hex() == root
            assert veb_merkle.fold(b"\0" * 32, paths[i]).hex() != root


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_rows(spark, rows):
    docs = spark.createDataFrame(rows, COLUMNS)
    for name in ("tree", "pos", "n", "digest", "block", "path", "at", "part", "salt", "leaf", "root", "observed", "first", "many"):
        docs = docs.withColumn(name, docs["text"])
    return sorted((tuple(r) for r in veb_merkle.tampering_check(docs).collect()), key=repr)


def test_manifest_of_many_sources_nulls_and_repeats(spark):
    random.seed(1)
    # One hot source of several blocks, a lone leaf, null and empty sources, repeated rows and ids, and a long text.
    rows = [(i, "hot", "en", 3, f"Text {i}") for i in range(random.randint(600, 700))]
    rows += [(5, "hot", "en", 3, "Text 5")] * 3 + [(5, "hot", "de", 3, "Text 5"), (None, "hot", None, None, "A"), (10, "hot", None, None, None)]
    rows += [(1, None, None, None, None), (2, None, "", 0, ""), (None, None, None, None, None), (3, "", "x", 1, "É A"), (4, "é", "x", 1, "B")]
    rows += [(1000 + i, f"s{i}", "fr", i, "Ab " * (400_000 if i == 3 else i)) for i in range(40)] + [(9, "Zz\U0001f600", "a", -5, "Q"), (9, "zz￮", "a", 5, "Q")]
    assert manifest_rows(spark, rows) == brute_manifest(rows)


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "s", "en", 1, "T") for i in range(n)]
    assert manifest_rows(spark, rows) == brute_manifest(rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert veb_merkle.tampering_check(docs).count() == 0
    assert heap_counts.count_tokens(docs, BYTE).count() == 0
    assert taat_search.search(docs, items).count() == 0
    assert taat_search.search(spark.createDataFrame([(1, "s", "en", 1, "a")], COLUMNS), items.where("false")).count() == 0


def test_counts_equal_the_library(make):
    tokenizer = Tokenizer.from_file(BYTE)
    random.seed(3)
    letters = "abcdeé漢' \n\t12.!'srtl ́"
    texts = [*ODD, *("".join(random.choices(letters, k=random.randint(1, 60))) for _ in range(300)), "x" * 300_000, "ab cd " * 60_000]
    rows = heap_counts.count_tokens(make(texts, extra=True).withColumn("n_bytes", heap_counts.F.lit("x")), BYTE).collect()
    assert len(rows) == len(texts)
    expected = []
    for i, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (i, t)
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_counts_of_the_table(spark):
    tokenizer = Tokenizer.from_file(BYTE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op13_heap_counts(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_tokens == len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids) and r.n_bytes == len(texts[r.doc_id].encode())


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        heap_counts.MergeTable(public_tokenizers.path("word_bpe_49k.json"))


PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_search(docs, items, top=20):
    found = [[re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in PATTERN.findall(text or "")] for _, text in docs]
    counts = [Counter(f) for f in found]
    n, words = sum(map(bool, found)), sum(map(len, found))
    df = Counter(t for c in counts for t in c)
    for item_id, text in items:
        scored = []
        for (doc_id, _), f, c in zip(docs, found, counts):
            score = 0
            for t in PATTERN.findall(text or ""):
                t = re.sub("[A-Z]", lambda m: m.group().lower(), t)
                if c[t]:
                    m = 75 + 25 * len(f) * n // words
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:top], 1):
            yield item_id, rank, doc_id, -score


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(taat_search, "BLOCK_DOCS", 16)
    random.seed(2)
    words = [f"w{i}" for i in range(60)] + ["É", "漢字", "Ab", "AB", "x\u0085y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(random.choices(words, weights, k=random.randint(1, 40)))) for i in range(300)]
    # Ties at the last rank, repeated rows and ids, nulls, texts without terms, a long text.
    docs += [(1000 + i, "w59 w58") for i in range(40)] + [(7, "w59")] * 3 + [(None, "w59 w58"), (None, None), (5, ""), (6, " .,;"), (2000, "w3 zz " * 200_000)]
    random.shuffle(docs)
    items = [(i, " ".join(random.choices(words, k=random.randint(1, 12)))) for i in range(30)]
    items += [(100, "w59 w58"), (101, None), (102, ""), (103, "unknown"), (104, "w1 W1, w1-ab"), (None, "w2 w59"), (104, "w1 W1, w1-ab")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("term", "n_docs", "ids", "item", "item_id", "rank", "score"):
        table = table.withColumn(name, table["text"])
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", taat_search.F.lit("x")).withColumn("rank", taat_search.F.lit(1))
    expected = sorted(brute_search(docs, items), key=repr)
    for item_bytes in (4_000_000, 100):
        rows = taat_search.search(table, asked, item_bytes=item_bytes)
        assert dict(rows.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
        assert sorted(map(tuple, rows.collect()), key=repr) == expected


def test_accumulators_are_limited_to_what_can_win():
    """A rare term decides; documents with common terms alone get no accumulator, and survivors are complete."""
    rng = np.random.default_rng(0)
    n = 2000
    rare, common = np.arange(0, 40), np.arange(n)
    row = {
        "ids": list(range(n)), "lengths": np.full(n, 10, np.int64).tobytes(), "terms": np.array([3, 8], np.int32).tobytes(),
        "starts": np.array([0, 40], np.int32).tobytes(), "docs": np.concatenate([rare, common]).astype(np.int32).tobytes(),
        "tfs": np.concatenate([np.full(40, 9), rng.integers(1, 5, n)]).astype(np.int32).tobytes(),
    }
    block = taat_search.Block(row, n, 10 * n)
    numbers, weights = np.array([3, 8]), np.array([5000, 10])
    scores, accumulators = block.rank(numbers, weights, np.zeros(0, np.int64), 20)
    assert accumulators == 40
    assert (scores[:40] == 5000 * block.share[:40] + 10 * block.share[40:80]).all() and not scores[40:].any()
    # With a high enough score from elsewhere nothing is opened at all.
    assert block.rank(numbers, weights, np.full(20, 10**12), 20)[1] == 0
