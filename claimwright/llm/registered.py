"""The registered query of each operator and, where SQL can express it, the SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, conversations, embeddings, language, licenses, lm, minhash, negatives, packing, pii, quality, sharding, toxicity
from .columns import held_out

Query = Callable[[SparkSession, str], DataFrame]


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text, learnt from the labels of three quarters of the ids."""
    held = held_out(F.col("doc_id"), 4, 2)
    documents = documents_of(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held)
    model = toxicity.fit_toxicity(spark, toxicity.with_labels(documents, labels))
    scored = toxicity.measure(documents, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again; digests of ids and bytes."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.decode_ids(bpe.encode_texts(documents_of(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts, components of near duplicates and the kept documents."""
    found = minhash.near_duplicates(spark, documents_of(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.95 and more, components and the kept vectors."""
    found = embeddings.near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text under the n-gram model of the training documents."""
    return lm.score_texts(documents_of(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every whole text and the verdict of line-first cleaning."""
    judged = quality.judge(documents_of(spark, sf_dir).select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *[F.col(f"judged.{n}").alias(n) for n in names])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learnt from four fifths of the documents."""
    held = held_out(F.col("doc_id"), 5, 0)
    documents = documents_of(spark, sf_dir)
    model = language.fit_languages(spark, documents.where(~held))
    found = language.predict_languages(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes; equal texts stay together."""
    found = sharding.shard_documents(spark, documents_of(spark, sf_dir), 8)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, one row per piece."""
    pieces = packing.pack_documents(documents_of(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: counts and digest of the strict spans, and all spans."""
    found = pii.find_identifiers(spark, documents_of(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.spans_text(F.concat("base", "added")).alias("spans"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, places of the base phrases, labels and restriction of every whole text."""
    found = licenses.scan_licenses(documents_of(spark, sf_dir))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, among all rows."""
    return negatives.mine_negatives(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


NEGATIVES_SQL = """
WITH r AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.id % 100 = 0 AND len(a.v) = len(b.v) AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5
"""


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all rebuilt conversations."""
    return conversations.prefix_trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


# crc32 bit by bit, lists of turns as prefixes, and a join of every node with those below it.
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS place,
    {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS said FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(said ORDER BY place) AS turns,
    xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
      lambda crc, byte: list_reduce(range(8), lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, byte)), CAST(4294967295 AS BIGINT)), 4294967295) % 6 AS h
  FROM t GROUP BY conv_id),
c AS (SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
p AS (SELECT conv_id, len(turns) AS size, depth, turns[1:depth] AS prefix FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM c)),
n AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256 FROM p GROUP BY depth, prefix),
k AS (SELECT a.depth, a.prefix, any_value(a.conv_id) AS conv_id, count(*) AS n_children FROM n a JOIN n b ON b.depth = a.depth + 1 AND b.prefix[1:a.depth] = a.prefix GROUP BY a.depth, a.prefix),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.prefix[n.depth].x) END AS saved
  FROM n LEFT JOIN k ON k.depth = n.depth AND k.prefix = n.prefix),
s AS (SELECT a.depth, a.prefix, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM m a JOIN m b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY a.depth, a.prefix)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.depth = m.depth AND s.prefix = m.prefix LEFT JOIN n u ON u.depth = m.depth - 1 AND u.prefix = m.prefix[1:m.depth - 1]
"""


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_quality_rules": op10_quality_rules,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {"op12_hard_negatives": NEGATIVES_SQL, "op13_conversation_trie": TRIE_SQL}
