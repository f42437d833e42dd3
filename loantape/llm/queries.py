"""One query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loantape.llm import bpe, html, language, mixing, negatives, pq, quality, sharding, simhash, suffixes, tries, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out()))
    rows = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    return language.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, radius=2)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", "n_chars")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.tokenise(docs, path, public_tokenizers.PATTERN, made).select("doc_id", *made)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs, kept=None).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16, scale=64, offset=1_000_000)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language": op1_language,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_main_text": op4_main_text,
    "op5_shards": op5_shards,
    "op6_embeddings": op6_embeddings,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}

SQL: dict[str, str] = {
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND len(a.v) = len(b.v)),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE alike AND id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER best <= 3""",
    "op13_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
              FROM documents)
        WINDOW same AS (PARTITION BY t)""",
}
