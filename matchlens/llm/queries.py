"""The registered queries of the document operators, on whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.llm import (
    ecoc_language,
    heap_counts,
    host_rules,
    line_mph,
    maglev,
    quotient_dedup,
    simhash_grid,
    suffix_levels,
    taat_search,
    toxicity_grammar,
    tree_bpe,
    veb_merkle,
    vector_packing,
)
from matchlens.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maglev.place(documents(spark, sf_dir).select("doc_id"), "doc_id")


def op2_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ecoc_language.predict(documents(spark, sf_dir))


def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_levels.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quotient_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotient_dedup.exact_groups(documents(spark, sf_dir))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return vector_packing.pack_documents(documents(spark, sf_dir), vocabulary, ranks)


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.verdicts(documents(spark, sf_dir))


def op7_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_grammar.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_line_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_mph.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_grid.near_classes(documents(spark, sf_dir))


def op10_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    coded = tree_bpe.encode_texts(documents(spark, sf_dir), vocabulary, digests=True)
    return coded.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


def op11_veb_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veb_merkle.tampering_check(documents(spark, sf_dir))


def op12_taat_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taat_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_heap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_maglev_sharding": op1_maglev_sharding,
        "op2_ecoc_language": op2_ecoc_language,
        "op3_suffix_levels": op3_suffix_levels,
        "op4_quotient_dedup": op4_quotient_dedup,
        "op5_vector_packing": op5_vector_packing,
        "op6_host_rules": op6_host_rules,
        "op7_toxicity_grammar": op7_toxicity_grammar,
        "op8_line_mph": op8_line_mph,
        "op9_simhash_grid": op9_simhash_grid,
        "op10_tree_bpe": op10_tree_bpe,
        "op11_veb_merkle": op11_veb_merkle,
        "op12_taat_search": op12_taat_search,
        "op13_heap_counts": op13_heap_counts,
        "pipeline": pipeline,
    }


TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
# Levels of merges that the SQL spells out: 16^5 documents a source, 16^3 sources.
LEVELS, TOP_LEVELS = 5, 3


def _merkle_sql() -> str:
    """Nodes t0, t1, ... level by level, and for each document its fold and siblings p0, p1, ... on the way up."""

    def coded(column: str) -> str:
        return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"

    def climb(name: str, levels: int, path: str) -> list[str]:
        steps = []
        for k in range(levels):
            t, p, left, right = f"{name}{k}", f"{path}{k}", "FILTER (t.pos < p.pos)", "FILTER (t.pos > p.pos)"
            run = "coalesce(string_agg(t.h, '' ORDER BY t.pos) {}, '')"
            steps.append(f"""{name}{k + 1} AS (
                SELECT tree, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n,
                    CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h
                FROM {t} GROUP BY tree, pos // 16)""")
            steps.append(f"""{path}{k + 1} AS (
                SELECT p.r, p.tree, p.pos // 16 AS pos, p.proof || {run.format("FILTER (t.pos <> p.pos)")} AS proof,
                    CASE WHEN any_value(t.n) > 1 THEN sha256({run.format(left)} || p.f || {run.format(right)}) ELSE p.f END AS f
                FROM {p} p JOIN {t} t ON t.tree = p.tree AND t.pos // 16 = p.pos // 16 GROUP BY p.r, p.tree, p.pos, p.proof, p.f)""")
        return steps

    bits = "flatten(list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor((xor(c, b) >> 1), CASE WHEN xor(c, b) % 2 = 1 THEN 3988292384 ELSE 0 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, CAST({bits} AS BIGINT[])), lambda c, b: {step}), 4294967295)"
    head = " || ".join(coded(c) for c in veb_merkle.FIELDS[:-1])
    lower = f"translate(text, '{veb_merkle.UPPER}', '{veb_merkle.LOWER}')"
    return ", ".join([
        f"""WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS tree, sha256({head} || {coded("text")}) AS leaf,
                CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {coded(lower)}) END AS seen
            FROM documents)""",
        """e AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM d)""",
        "t0 AS (SELECT tree, pos, n, leaf AS h FROM e)",
        "p0 AS (SELECT r, tree, pos, '' AS proof, coalesce(seen, leaf) AS f FROM e)",
        *climb("t", LEVELS, "p"),
        f"s AS (SELECT tree AS source, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t{LEVELS})",
        "u0 AS (SELECT '' AS tree, pos, n, h FROM s)",
        f"q0 AS (SELECT r, '' AS tree, s.pos, proof, f FROM p{LEVELS} JOIN s ON s.source = p{LEVELS}.tree)",
        *climb("u", TOP_LEVELS, "q"),
    ]) + f"""
        SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = u.h AS verified
        FROM q{TOP_LEVELS} JOIN d USING (r) JOIN s ON s.source = d.tree, u{TOP_LEVELS} u"""  # fmt: skip


def oracle_sql() -> dict[str, str]:
    return {
        "op11_veb_merkle": _merkle_sql(),
        "op12_taat_search": f"""
            WITH t AS (
                SELECT r, doc_id, unnest({TERMS}) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
            ),
            f AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
            n AS (SELECT r, count(*) AS n FROM t GROUP BY r),
            s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
            w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY term),
            i AS (SELECT item_id, k, unnest({TERMS}) AS term FROM (SELECT row_number() OVER () AS k, item_id, text FROM benchmark)),
            q AS (SELECT item_id, k, term, count(*) AS repeats FROM i GROUP BY ALL),
            x AS (
                SELECT item_id, k, r, doc_id,
                    sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))))::BIGINT AS score
                FROM q JOIN f USING (term) JOIN w USING (term) JOIN n USING (r), s GROUP BY ALL
            )
            SELECT item_id, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM x WHERE score > 0 QUALIFY rank <= 20
        """,
        "op4_quotient_dedup": r"""
            WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
            g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
        """,
        "op8_line_mph": r"""
            WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
            l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
            k AS (
                SELECT doc_id, i, line, translate(
                    regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
                FROM l
            ),
            f AS (
                SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
                GROUP BY key HAVING count(DISTINCT doc_id) >= 3
            ),
            x AS (SELECT k.*, keeper IS NULL OR keeper = doc_id AS stays FROM k LEFT JOIN f USING (key))
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
                sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
            FROM x GROUP BY doc_id
        """,
    }
