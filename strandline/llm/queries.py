"""The operators on the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, licenses, pii, repeats, toxicity
from strandline.llm.collocations import collocations
from strandline.llm.decontamination import find_leaks
from strandline.llm.exact_dedup import find_duplicates
from strandline.llm.hard_negatives import hard_negatives
from strandline.llm.language_model import score_documents
from strandline.llm.mixing import mix
from strandline.llm.near_dedup import Rule, near_duplicates
from strandline.llm.shared import read_documents
from strandline.llm.sharding import shard


def mixed(spark: SparkSession, folder: str) -> DataFrame:
    out = mix(read_documents(spark, folder), repetition=2.0)
    return out.select(
        "doc_id",
        "source",
        *(out[f"__{c}"].alias(c if c != "tokens" else "n_tokens") for c in ("tokens", "weight", "epochs", "copies")),
    )


def tokenized(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_documents(spark, folder).select("doc_id", "text")
    return bpe.digest(bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text"), path))


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_documents(spark, folder, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("id") % 100 == 0).drop("anchor_row", "positive_row", "negative_row")


QUERIES = {
    "op1_pii": lambda spark, folder: pii.digest(pii.find_pii(read_documents(spark, folder))),
    "op2_decontamination": lambda spark, folder: find_leaks(
        read_documents(spark, folder), read_documents(spark, folder, "benchmark")
    ).drop("text_hash"),
    "op3_lm_scoring": lambda spark, folder: score_documents(read_documents(spark, folder)),
    "op4_sharding": lambda spark, folder: shard(read_documents(spark, folder)),
    "op5_exact_dedup": lambda spark, folder: find_duplicates(read_documents(spark, folder)),
    "op6_minhash_near_dedup": lambda spark, folder: near_duplicates(read_documents(spark, folder), Rule(3, 85)).drop("text_hash", "component"),
    "op7_license_scans": lambda spark, folder: licenses.digest(licenses.scan_licenses(read_documents(spark, folder))),
    "op8_mixing": mixed,
    "op9_toxicity": lambda spark, folder: toxicity.digest(
        toxicity.score_toxicity(read_documents(spark, folder), read_documents(spark, folder, "labels"))
    ),
    "op10_suffix_array_dedup": lambda spark, folder: repeats.digest(repeats.remove_repeats(read_documents(spark, folder))),
    "op11_byte_bpe": tokenized,
    "op12_hard_negatives": mined_negatives,
    "op13_collocations": lambda spark, folder: collocations(read_documents(spark, folder)),
}

ORACLES = {
    "op13_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), p AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM t
        ), f AS (
            SELECT lang, size, phrase, count(*) AS f FROM (
                SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
                FROM p, range(1, 4) s(size))
            GROUP BY ALL
        ), n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY 1), c AS (
            SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10
        ), cut AS (
            SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
            FROM c, range(1, 3) s(k) WHERE k < size
        ), scored AS (
            SELECT cut.lang, cut.size, cut.phrase, a, h.f AS l, t.f AS r, (1000000::HUGEINT * a * a // (h.f::HUGEINT * t.f))::BIGINT AS score
            FROM cut JOIN f h ON cut.lang = h.lang AND head = h.phrase JOIN f t ON cut.lang = t.lang AND tail = t.phrase
            QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1
        ), held AS (
            SELECT lang, phrase, max(f) AS f FROM (
                SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, a AS f FROM c, range(1, 3) s(i) WHERE size = 3)
            GROUP BY 1, 2
        )
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase)::INT AS rank, s.phrase, a, l, r, n, score
        FROM scored s JOIN n ON s.lang = n.lang LEFT JOIN held ON size = 2 AND s.lang = held.lang AND s.phrase = held.phrase
        WHERE held.f IS NULL OR 100 * held.f < 50 * a
        QUALIFY rank <= 2000
    """,
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.n AS a, a.vec_id AS anchor_id, a.label AS anchor_label, b.n AS b, b.vec_id, b.label,
                   list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.n <> b.n AND len(a.q) = len(b.q)
        ), p AS (
            SELECT a, anchor_id, b AS p, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
            QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.a, p ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s ON p.a = s.a AND s.label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op2_decontamination": r"""
        WITH w AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), s AS (
            SELECT kind, id, text, list_filter(
                string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
            FROM w WHERE text IS NOT NULL
        ), l AS (
            SELECT DISTINCT least(len(words), 5) AS n FROM s WHERE kind = 'i' AND len(words) > 0
        ), g AS (
            SELECT DISTINCT kind, id, unnest(
                list_transform(range(1, len(words) - n + 2), lambda i: array_to_string(words[i:i + n - 1], ' '))) AS shingle
            FROM s JOIN l ON CASE WHEN kind = 'd' THEN n <= len(words) ELSE n = least(len(words), 5) END
        ), q AS (SELECT id AS item_id, count(*) AS n_shingles FROM g WHERE kind = 'i' GROUP BY 1)
        SELECT d.id AS doc_id, item_id, n_shingles, count(*) AS n_common, count(*) / n_shingles AS containment
        FROM g d JOIN g i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle JOIN q ON i.id = q.item_id
        GROUP BY d.id, item_id, n_shingles HAVING 100 * count(*) >= 80 * n_shingles
    """,
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
            FROM documents
        ), g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size
            FROM t
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
    """,
    "op6_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(
                string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
                     WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
            FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b USING (shingle) JOIN n na ON a.doc_id = na.doc_id JOIN n nb ON b.doc_id = nb.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
        ), c AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN c ON d.doc_id = c.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
    """,
}
