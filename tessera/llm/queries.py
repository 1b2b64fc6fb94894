"""Registered queries of the text operators, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.runtime import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    from tessera.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, by item."""
    from tessera.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of every document's SentencePiece ids and of what they decode to."""
    from tessera.llm.pieces import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of documents before it."""
    from tessera.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLES["op4_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS own FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
f AS (SELECT own, min(doc_id) AS least FROM g GROUP BY own),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN f USING (own) WHERE least < doc_id),
k AS (SELECT doc_id, k, ws[k] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM w)),
left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept FROM k ANTI JOIN hit USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
"""


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the written token files."""
    from tessera.llm.token_files import read_documents, write_tokens

    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, path)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    from tessera.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    from tessera.llm.language import languages

    return languages(table(spark, sf_dir, "documents"))


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    from tessera.llm.exact import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS own FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY own) AS keep_id, count(*) OVER (PARTITION BY own) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY own) AS kept, sha256(own) AS text_sha256
FROM t
"""


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the near-duplicate group of every document."""
    from tessera.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"))


@query
def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model log probabilities of every document."""
    from tessera.llm.lm import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    from tessera.llm.negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op11_hard_negatives"] = r"""
WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM t a JOIN t b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.other AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
                   AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
      WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The set size and the near-duplicate class of every document."""
    from tessera.llm.minhash import minhash_groups

    return minhash_groups(table(spark, sf_dir, "documents"))


ORACLES["op12_minhash"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.m),
c AS (SELECT d, min(m) AS component_id FROM r GROUP BY d)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c ON d = doc_id
"""


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the repaired text of every conversation, after damage."""
    from tessera.llm.conversations import damaged, repaired

    return repaired(damaged(table(spark, sf_dir, "conversations")))
