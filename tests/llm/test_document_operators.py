"""Every document operator against brute force, and on null, empty, repeated, long and clashing input."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import compare, duck
from tokenizers import Tokenizer

import corpus_pipeline
from matchlens.llm import ecoc_language as ecoc
from matchlens.llm import host_rules as rules
from matchlens.llm import line_mph, maglev, queries, quotient_dedup, simhash_grid, suffix_levels, toxicity_grammar, tree_bpe, vector_packing

SMALL = "/root/testdata/sf0.001"
BYTE, RANKS, WORD = map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
ODD = [None, "", " ", "a", "a", "The end.\n\nThe  end.", "word " * 3000, "é漢字 ΑΣ İ <|endoftext|> 'S x\u0085y", "x" * 5000, (None, "a"), (None, None), (3, "a")]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert compare(queries.queries()[name](spark, SMALL), duck(SMALL), queries.oracle_sql()[name]) is None


def test_odd_rows_and_clashing_columns_leave_one_row_each(make, spark):
    docs = make(ODD, extra=True)
    labels = spark.createDataFrame([(0, 1), (4, 0), (3, None)], "doc_id long, toxic int")
    n = len(ODD)
    assert maglev.place(docs, "doc_id").count() == n
    assert quotient_dedup.exact_groups(docs).count() == n
    assert rules.verdicts(docs).count() == n
    assert line_mph.drop_repeated_lines(docs).count() == n
    assert simhash_grid.near_classes(docs).count() == n
    assert suffix_levels.remove_repeats(docs).count() == n
    assert tree_bpe.encode_texts(docs, WORD, leaf=256).count() == n
    assert ecoc.predict(docs).count() == n
    assert toxicity_grammar.score(docs, labels).count() == n
    assert vector_packing.pack_documents(docs, BYTE, RANKS).where("piece = 0").count() == n


def test_empty_tables(make, spark):
    docs = make(["x"]).where("false")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for result in (
        maglev.place(docs, "doc_id"),
        quotient_dedup.exact_groups(docs),
        rules.verdicts(docs),
        line_mph.drop_repeated_lines(docs),
        simhash_grid.near_classes(docs),
        suffix_levels.remove_repeats(docs),
        tree_bpe.encode_texts(docs, WORD),
        ecoc.predict(docs),
        toxicity_grammar.score(docs, labels),
        vector_packing.pack_documents(docs, BYTE, RANKS),
    ):
        assert result.count() == 0


def test_lookup_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    owner = maglev.fill_table(names, 1009)
    shares = np.bincount(owner)
    assert shares.max() - shares.min() <= 1
    fewer = maglev.fill_table(names[:-1], 1009)
    stayed = owner < 9
    assert (owner[stayed] == fewer[stayed]).mean() > 0.8
    double = np.bincount(maglev.fill_table(names, 1009, {"s3": 2}))
    assert abs(double[3] - 2 * double[0]) <= 2
    with pytest.raises(ValueError):
        maglev.fill_table(names, 1000)


def test_placement_follows_the_table(spark):
    names = list(maglev.SHARDS)
    owner = maglev.fill_table(names)
    rows = queries.op1_maglev_sharding(spark, SMALL).collect()
    for r in rows:
        signed = xxhash.xxh64_intdigest(str(r.doc_id), seed=42)
        signed -= (signed >> 63) << 64
        assert r.slot == signed % maglev.TABLE_SIZE and r.shard == names[owner[r.slot]]


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(0)
    for shift in (64, 60):
        segment = 0 if shift == 64 else 9
        values = rng.integers(0, 1 << 62, 3000, dtype=np.uint64) % np.uint64(1 << (shift - 1)) + np.uint64((segment << shift) % (1 << 64))
        values = np.concatenate([values, values[:700], values[:50]])
        parts = [quotient_dedup.QuotientFilter.of(p) for p in np.array_split(rng.permutation(values), 5)]
        packed = [quotient_dedup.QuotientFilter.unpack(p.pack(shift), segment, shift) for p in parts]
        whole = quotient_dedup.merge_all(packed)
        expected = np.unique(values, return_counts=True)
        assert (whole.fingerprints == expected[0]).all() and (whole.counts == expected[1]).all()


def test_exact_groups_of_odd_rows(make):
    rows = quotient_dedup.exact_groups(make([(5, "a  b"), (2, "a\tb"), (2, "a b"), (None, "a b"), (None, None), (7, ""), (9, "c")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in rows) == [
        (-1, 2, 4, False), (-1, 7, 2, False), (2, 2, 4, False), (2, 2, 4, True), (5, 2, 4, False), (7, 7, 2, True), (9, 9, 1, True),
    ]


def brute_repeats(texts):
    seen = collections.Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        kept = bytes(x for x, y in zip(b, gone) if not y)
        yield len(b), sum(gone), sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])), kept


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_repeats_match_brute_force(make, batches):
    random.seed(batches)
    base = "".join(random.choice("abcdefghij ") for _ in range(3000))
    texts = ["a" * 450, "ab" * 150, base[:500], base[100:700] + "zz" + base[100:400], base[250:460] + "é" * 120, None, base[:199], base[1000:1250] * 2]
    texts += [base[2000:2300] + "X" + base[2301:2600], base[2000:2600], "xyz" * 67, "xyz" * 66, base[:500]]
    rows = suffix_levels.remove_repeats(make(texts), batches=batches).collect()
    expected = list(brute_repeats([(t or "").encode() for t in texts]))
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected[r.doc_id]


def test_repeats_of_the_table(spark):
    texts = texts_of(spark)
    expected = dict(zip(texts, brute_repeats([t.encode() for t in texts.values()])))
    for r in queries.op3_suffix_levels(spark, SMALL).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (*expected[r.doc_id][:3], sha(expected[r.doc_id][3]))


def packed_ids(texts):
    tokenizer = Tokenizer.from_file(BYTE)
    return {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], dtype="<u4") for i, t in texts.items()}


def test_packing_is_gapless_and_tight(spark):
    ids = packed_ids(texts_of(spark))
    rows = queries.op5_vector_packing(spark, SMALL).collect()
    pieces, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for doc, whole in ids.items():
        at = 0
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(whole[at : at + r.length].tobytes())
            assert r.length == 1024 or k == 0
            at += r.length
        assert at == len(whole)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(map(len, ids.values()))
    assert len(bins) <= 1.02 * -(-total // 1024) + 2


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.sort(np.random.default_rng(1).integers(1, 900, 500))[::-1]
    capacity = vector_packing.Capacity(tokens=1000, documents=4, attention=600_000, rule=rule)
    lengths = lengths[lengths.astype(float) ** 2 <= capacity.attention]
    bins = vector_packing.best_fit(lengths, capacity)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 1000 and len(own) <= 4 and (own.astype(float) ** 2).sum() <= 600_000 * (1 + 1e-9)


def test_word_counts_match_brute_force(spark):
    texts = texts_of(spark)
    for r in queries.op6_host_rules(spark, SMALL).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        times = collections.Counter(windows)
        covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        counts = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_bad_hosts_are_rejected_small_ones_shrunk(make, spark):
    good = " ".join(f"word{i}" for i in range(40))
    poor = " ".join(f"#w{i}#$" for i in range(40))
    docs = make([(i, good) for i in range(200)], source="good")
    docs = docs.union(make([(1000 + i, poor if i % 10 else good) for i in range(200)], source="bad"))
    docs = docs.union(make([(2000, poor), (2001, good)], source="tiny")).union(make([(3000, poor)], source=None))
    kept = {r.doc_id: r.kept for r in rules.verdicts(docs).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(200))
    assert kept[2001] and kept[3000]


def test_host_verdicts_equal_a_plain_reading(make, spark):
    """Beta prior by moments over the hosts, low end of the shrunk rate, verdicts of whole hosts, in plain Python."""
    rng = random.Random(8)
    good = " ".join(f"word{i}" for i in range(30))
    shares = {"a": 0.05, "b": 0.95, "c": 0.7, "d": 0.66, "e": 0.3, "tiny": 1.0}
    rows = [(h, rng.random() < share) for h, share in shares.items() for _ in range(2 if h == "tiny" else 120)]
    docs = spark.createDataFrame([(i, "few words" if bad else good, h) for i, (h, bad) in enumerate(rows)], "doc_id long, text string, source string")
    limits = rules.Limits()
    sizes = {h: (sum(x == h for x, _ in rows), sum(x == h and bad for x, bad in rows)) for h in shares}
    whole = sum(n for n, _ in sizes.values())
    mean = sum(f for _, f in sizes.values()) / whole
    variance = sum(n * (f / n) ** 2 for n, f in sizes.values()) / whole - mean**2
    strength = min(max(mean * (1 - mean) / variance - 1, 1.0), 1000.0)
    rejected = set()
    for host, (n, failed) in sizes.items():
        rate = (mean * strength + failed) / (strength + n)
        if rate - limits.deviations * (rate * (1 - rate) / (strength + n + 1)) ** 0.5 > limits.max_host_rate:
            rejected.add(host)
    assert {"b"} <= rejected < set(shares) and "tiny" not in rejected
    kept = {r.doc_id: r.kept for r in rules.verdicts(docs, limits).collect()}
    assert kept == {i: not bad and h not in rejected for i, (h, bad) in enumerate(rows)}


def test_insults_are_learned_and_clauses_matter(make, spark):
    random.seed(0)
    plain = lambda: " ".join(random.choice("river stone cloud field lamp chair".split()) for _ in range(20))
    rows = [(i, plain() + (", you are a zorgel. " if i % 4 == 0 else ". ") + plain()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    scored = toxicity_grammar.score(make(rows), labels).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)


def test_clauses_of_sentences():
    grammar = toxicity_grammar.Grammar({"zorgel": 3.0}, {"kill": 2.0})
    clause, none = toxicity_grammar.Clause, (0.0, 0.0, 0.0)
    assert grammar.clauses("You are a zorgel. Not a zorgel! He said zorgel; \"zorgel. zorgel\" fine") == [
        clause((3.0, 0.0, 0.0), none, 1, False, True),
        clause((0.0, 3.0, 0.0), none, 1, False, False),
        clause((3.0, 0.0, 0.0), none, 1, True, True),
        clause((0.0, 0.0, 3.0), none, 1, False, False),
        clause((0.0, 0.0, 3.0), none, 1, False, False),
    ]
    assert grammar.clauses("I will kill you") == [clause(none, (2.0, 0.0, 0.0), 0, False, True)]
    assert grammar.clauses("I will kill you and not hurt him") == [clause(none, (2.0, 1.0, 0.0), 0, False, True)]
    assert grammar.clauses("You zorgel, not a zorgel") == [clause((3.0, 3.0, 0.0), none, 2, False, True)]
    assert not grammar.clauses("We kill time") and not grammar.clauses("")
    plain, told = grammar.features("I will kill you"), grammar.features("He said I will kill you")
    threat, weak = (toxicity_grammar.FEATURES.index(f) for f in ("threat", "weak_threat"))
    assert plain[threat] > 0 == plain[weak] and told[weak] > 0 == told[threat]


def test_composed_grammar_equals_a_plain_reading():
    rng = random.Random(3)
    grammar = toxicity_grammar.Grammar({"zorgel": 3.0, "blar*": 2.5}, {"kill": 2.0})
    weights = {"zorgel": 3.0, "blarfing": 2.5, "kill": 2.0, "hurt": 1.0}
    words = ["zorgel", "blarfing", "kill", "hurt", "you", "not", "said", '"', ".", "!", "stone"]
    for _ in range(2000):
        tokens = [rng.choice(words) for _ in range(rng.randint(0, 25))]
        wanted, quoted, clause = [], False, []
        for token in [*tokens, "."]:
            if token == '"':
                quoted = not quoted
            elif token not in ".!":
                clause.append((token, quoted))
            if token not in ".!":
                continue
            plain = [t for t, _ in clause]
            sums = {"insult": [0.0] * 3, "threat": [0.0] * 3}
            for i, (word, inside) in enumerate(clause):
                if word in weights:
                    kind = "threat" if word in ("kill", "hurt") else "insult"
                    sums[kind][1 if "not" in plain[:i] else 2 if inside else 0] += weights[word]
            hits = sum(w in ("zorgel", "blarfing") for w in plain)
            if hits or any(sums["threat"]) and "you" in plain:
                wanted.append((tuple(sums["insult"]), tuple(sums["threat"]), hits, "said" in plain, "you" in plain))
            clause = []
        assert [tuple(c) for c in grammar.clauses(" ".join(tokens))] == wanted, tokens


def test_rare_insults_are_learned_without_a_cap(make, spark):
    # 15 of 5,000 toxic texts hold the word, 0.3 %: rarity alone must not drop it, and copies of one text must not raise one.
    words = lambda i: "quark" if i < 15 else "glimmer" if i < 40 else "moss"
    rows = [(i, f"stone river{i % 7} {words(i)} {0 if 15 <= i < 40 else i}", int(i < 5000)) for i in range(30_000)]
    frame = spark.createDataFrame([(i, t if i < 15 or i >= 40 else "copied glimmer", y) for i, t, y in rows], "doc_id long, text string, toxic int")
    insults, threats = toxicity_grammar.learn_weights(frame)
    assert "quark" in insults and "glimmer" not in insults and "stone" not in insults and threats == {}


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 20):
        code = ecoc.codebook(n)
        gaps = [(code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2)]
        assert min(gaps) >= max(1, code.shape[1] // 4)


def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in queries.op2_ecoc_language(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_long_texts_are_summed_in_slices():
    text = "abc déf " * 200_000
    weights = np.random.default_rng(0).random((ecoc.BUCKETS, 2)).astype(np.float32)
    whole, n = ecoc.gram_sums([text, "x"], weights)
    half, m = ecoc.gram_sums(["abc déf " * 100_000], weights)
    assert abs(n[0] - 2 * m[0]) <= 20 and np.allclose(whole[0], 2 * half[0], rtol=1e-3)


def test_language_counts_do_not_depend_on_the_tasks(spark):
    rows = [(random.Random(i).choice(["xx", "yy"]), f"word{i} Größe\u00e9 {i % 5} lorem" * (i % 4)) for i in range(300)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    one, many = (ecoc.gram_counts(frame.repartition(n), salts=2) for n in (1, 5))
    assert set(one) == set(many) == {"xx", "yy"}
    assert all((one[k] == many[k]).all() and one[k].sum() > 0 for k in one)
    texts = [t for _, t in rows if t]
    weights = np.random.default_rng(1).normal(size=(ecoc.BUCKETS, 3)).astype(np.float32)
    together, alone = ecoc.gram_sums(texts, weights), [ecoc.gram_sums([t], weights) for t in texts]
    assert (together[1] == np.concatenate([n for _, n in alone])).all()
    assert np.allclose(together[0], np.concatenate([s for s, _ in alone]))


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-(1 << 62), 1 << 62, (2, 5000))
    perfect = line_mph.PerfectHash.unpack(line_mph.PerfectHash.build(a, b).pack())
    assert sorted(perfect.number(a, b)) == list(range(5000))


def test_lines_of_many_documents_stay_in_the_last(make):
    line = "This Line is long enough to count"
    docs = make([(1, f"a\n{line}"), (2, f" {line.upper()} \nb"), (9, f"{line}\n{line}"), (4, "short\nshort"), (None, line)])
    rows = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_mph.drop_repeated_lines(docs).collect()}
    assert rows == {1: ("a", 2, 1), 2: ("b", 2, 1), 9: (f"{line}\n{line}", 2, 0), 4: ("short\nshort", 2, 0), None: ("", 1, 1)}


def test_classes_match_brute_force(spark):
    fps = {}
    for i, text in texts_of(spark).items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[j : j + 3]) for j in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    for r in queries.op9_simhash_grid(spark, SMALL).collect():
        assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", find(r.doc_id))


def test_grid_loses_no_link_in_crowded_points(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(600)} | {rng.getrandbits(64) for _ in range(200)} | {0, 1, 3}
    signed = lambda x: x - ((x >> 63) << 64)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = {tuple(r) for r in simhash_grid.close_pairs(df).collect()}
    expected = {tuple(sorted((signed(a), signed(b)))) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 2}
    assert found == expected
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 1000)], "a long, b long")
    assert {tuple(r) for r in simhash_grid.components(chain).collect()} == {(i, 0) for i in range(301)} | {(900, 900), (1000, 900)}


def test_encoding_equals_the_library(make):
    random.seed(1)
    texts = [*(t for t in ODD if not isinstance(t, tuple)), "".join(random.choice("abcdefgh") for _ in range(20_000)) + " ok " + "ab" * 3000 + "!", "ŉ ſ ²½ a_b 'll 'LL", "<|startoftext|>" + "Q" * 900]
    tokenizer = Tokenizer.from_file(WORD)
    for r in tree_bpe.encode_texts(make(texts), WORD, leaf=256).collect():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids) == (len(ids), " ".join(map(str, ids)))
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_encoding_of_the_table(spark):
    tokenizer, texts = Tokenizer.from_file(WORD), texts_of(spark)
    for r in queries.op10_tree_bpe(spark, SMALL).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_pipeline_stages_work_on_what_is_left(make, spark):
    good = lambda seed: " ".join(f"{seed}word{i}" for i in range(30))
    line = "a boilerplate line of some length"
    texts = [good(0), good(0), "too short", *(good(i) + "\n" + line for i in range(1, 4)), good(9) + " " + "p" * 250, good(8) + " " + "p" * 250]
    docs = make(texts)
    left = {}
    for name, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, SMALL)
        left[name] = docs.collect()
    ids = {k: sorted(r.doc_id for r in rows) for k, rows in left.items()}
    assert ids["quality_rules"] == ids["line_dedup"] == [0, 1, 3, 4, 5, 6, 7]
    assert ids["near_dedup"] == ids["suffix_dedup"] == [0, 3, 4, 5, 6, 7]
    assert {r.doc_id: line in r.text for r in left["line_dedup"]} == {0: False, 1: False, 3: False, 4: False, 5: True, 6: False, 7: False}
    assert not any("p" * 10 in r.text for r in left["suffix_dedup"])
    assert all(r.n_chars == len(r.text) for r in left["suffix_dedup"])
    assert set(ids["packing"]) == {0, 3, 4, 5, 6, 7}


def test_pipeline_on_the_table(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


CLASHING = ("block", "kept", "n_lines", "n_dropped", "n_bytes", "n_removed", "n_spans", "row", "own", "body", "key", "spans", "keeper", "shard", "wins", "tid", "length")


def test_stages_carry_clashing_columns_and_odd_rows(make, spark):
    """Expected rows of the four filtering stages on nulls, ties, repeats, a long text and names that clash."""
    prose = " ".join(f"word{i} about nothing much" for i in range(40))
    long = " ".join(f"long{i}" for i in range(120_000))
    line = "this line stands in many documents"
    texts = [(0, prose), (1, prose + " again"), (2, long), (3, None), (4, ""), (5, prose), (5, prose), (None, prose + " too")]
    texts += [(10 + i, f"{line}\n" + " ".join(f"own{i}x{k}" for k in range(60))) for i in range(4)]
    docs = make(texts)
    for name in CLASHING:
        docs = docs.withColumn(name, rules.F.concat(rules.F.lit(f"{name} of "), rules.F.col("doc_id").cast("string")))
    columns = docs.columns
    for _, work in corpus_pipeline.STAGES[:4]:
        docs = vector_packing.stage(work(spark, docs, SMALL), "test")
        assert docs.columns == columns
    rows = {r.doc_id: r for r in docs.collect()}
    # Too few words: 3 and 4 go. The line of 0, 5 and 5 stays in both 5, that of the others in 13. Near copies: 1 stays of 1, 5, 5 and the null id.
    assert sorted(rows) == [0, 1, 2, 10, 11, 12, 13]
    assert rows[0].text == "" and rows[1].text == prose + " again" and rows[2].text == long
    for i in range(4):
        own = " ".join(f"own{i}x{k}" for k in range(60))
        assert rows[10 + i].text == (f"{line}\n{own}" if i == 3 else own)
    for r in rows.values():
        assert r.n_chars == len(r.text) and all(r[name] == f"{name} of {r.doc_id}" for name in CLASHING)
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.collect()} == set(rows)
    empty = spark.createDataFrame([], docs.schema)
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, empty, SMALL).count() == 0


def test_runs_of_familiar_characters_match_the_library():
    coder, library = tree_bpe.Encoder(WORD), Tokenizer.from_file(WORD)
    familiar = [c for c in map(chr, range(0x180)) if not tree_bpe.UNFAMILIAR.search(c)]
    rng = random.Random(5)
    texts = familiar + ["".join(rng.choice(familiar) for _ in range(60)) for _ in range(400)] + ["don't I'LL 're''s x's,y 12a3 ...'s"]
    before = tree_bpe.CACHED_RUNS, tree_bpe.CACHED_WORDS
    tree_bpe.CACHED_RUNS, tree_bpe.CACHED_WORDS = 50, 40
    try:
        for text in texts * 2:
            coded = library.encode(text, add_special_tokens=False)
            assert coder.encode(text) == (" ".join(map(str, coded.ids)), " ".join(coded.tokens), len(coded.ids)), text
            assert len(coder.ids) <= max(50, len(set(text.lower().split()))) and len(coder.words) <= 40
    finally:
        tree_bpe.CACHED_RUNS, tree_bpe.CACHED_WORDS = before


def test_a_learned_run_is_not_split_again(monkeypatch):
    coder = tree_bpe.Encoder(WORD)
    first = coder.encode("some words, again some words, again")
    monkeypatch.setattr(tree_bpe, "WORDS", None)
    assert coder.encode("some words, again some words, again") == first
