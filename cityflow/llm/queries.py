"""Registered queries of the operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cityflow.llm.centroids import centroid_clusters
from cityflow.llm.chat import format_chats, read_back, with_example
from cityflow.llm.common import table
from cityflow.llm.exact import content_sort
from cityflow.llm.licenses import scan_licenses
from cityflow.llm.negatives import hard_negatives
from cityflow.llm.packing import pack_documents
from cityflow.llm.pieces import code_documents, coded_digests
from cityflow.llm.pii import pii_spans, span_counts
from cityflow.llm.pseudo import pseudo_likelihood
from cityflow.llm.quality import judge
from cityflow.llm.sharding import shard_documents
from cityflow.llm.simhash import simhash_classes
from cityflow.llm.toxicity import learned, score_documents


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 shards of near-equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from every formatted conversation, and from one made of control strings."""
    return read_back(format_chats(with_example(table(spark, sf_dir, "conversations"))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy class of every document."""
    return simhash_classes(table(spark, sf_dir, "documents"), words=3)


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document, by a network that learned from all of them."""
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the public tokenizers, in the same place on all machines."""
    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence each piece of every document goes to."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, posterior quality and verdict of every document."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return span_counts(pii_spans(table(spark, sf_dir, "documents")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document; the largest id stays."""
    return content_sort(table(spark, sf_dir, "documents"), keep="largest")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text read back from them."""
    return coded_digests(code_documents(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learned(docs, table(spark, sf_dir, "labels")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"), clusters=16, rounds=3)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and quoted license texts of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_chat": op2_chat,
    "op3_simhash": op3_simhash,
    "op4_pseudo_likelihood": op4_pseudo_likelihood,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_pieces": op9_pieces,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroids": op12_centroids,
    "op13_licenses": op13_licenses,
}

_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Lengths of the marks around a turn in the output, and control strings in a text, each of which takes one more character.
_GUARDS = r"len(regexp_extract_all({0}, '<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<ROLE>>|<\\*</ROLE>>'))"
_ORDER = "ORDER BY turn NULLS FIRST, role, body"

_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _rounds(rounds: int) -> str:
    """Lloyd rounds, each from the centroids c<i> to c<i+1>."""
    parts = []
    for i in range(rounds + 1):
        parts.append(
            f"""d{i} AS (SELECT vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
                 FROM kept, c{i}),
              a{i} AS (SELECT vec_id, any_value(v) AS v, min(cluster) AS cluster, min(distance) AS distance
                 FROM (SELECT *, min(distance) OVER (PARTITION BY vec_id) AS least FROM d{i}) WHERE distance = least GROUP BY vec_id)"""
        )
        if i < rounds:
            parts.append(
                f"""u{i} AS (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{i}),
              s{i} AS (SELECT cluster, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM u{i} GROUP BY cluster, k),
              m{i} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n) ORDER BY k) AS c FROM s{i} GROUP BY cluster),
              c{i + 1} AS (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))"""
            )
    return ", ".join(parts)


SQL: dict[str, str] = {
    "op11_hard_negatives": f"""
        WITH taken AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_WHOLE}),
        scored AS (
          SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
          FROM taken a JOIN taken r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
        positives AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        ranked AS (
          SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
                 CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
          FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
           AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
    """,
    "op12_centroids": f"""
        WITH kept AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE {_WHOLE} AND len(embedding) = 64),
        c0 AS (
          SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS cluster, v AS c FROM kept
          QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
        {_rounds(3)}
        SELECT vec_id, a3.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a3.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a3 JOIN c3 USING (cluster)
    """,
    "op2_chat": f"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        guarded AS (SELECT *, length(body) + {_GUARDS.format('body')} AS body_chars, length(role) + {_GUARDS.format('role')} AS role_chars FROM turns)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' {_ORDER})) AS turns_sha256,
               CAST(coalesce(sum(length(body)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(body, '' {_ORDER}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(CASE role WHEN 'user' THEN 18 + body_chars WHEN 'assistant' THEN 7 + body_chars ELSE 24 + role_chars + body_chars END)
                 AS BIGINT) AS formatted_chars
        FROM guarded GROUP BY conv_id
    """,
    "op8_exact_dedup": f"""
        WITH normal AS (SELECT doc_id, {_NORMAL} AS body FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
               sha256(body) AS text_sha256
        FROM normal
    """,
}
