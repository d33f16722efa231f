"""The registered queries opN_<name>: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources import new_work_path

from . import (alignment, conversations, extraction, languages, licences, mixing, packing,
               partenum, quality_rules, repeats, token_planes, topk, toxicity)


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


TOP_K = """
WITH v AS (SELECT vec_id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
  AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_read(spark, sf_dir, "documents"), length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op3_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit_labelled(docs, _read(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"),
                                  _vocabulary("word_bpe_49k.json"), end_id=1)


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "token-planes")
    token_planes.write_tokens(_read(spark, sf_dir, "documents"), path,
                              _vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_planes.document_checksums(spark, path)


def op6_positional_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_phrases(_read(spark, sf_dir, "documents")).drop("found")


def op7_page_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = extraction.fit(_read(spark, sf_dir, "documents"))
    return extraction.extracted_pages(_read(spark, sf_dir, "pages"), model)


def op8_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_read(spark, sf_dir, "documents"),
                                          _vocabulary("piece_bpe_32k.model"))


def op9_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similarity_classes(_read(spark, sf_dir, "documents"))


def op10_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(_read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op11_mixture_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = languages.predict_languages(docs, languages.fit_languages(docs))
    return found.select("doc_id", languages.held_out(F.col("doc_id")).alias("held_out"),
                        "lang_pred", "score", "languages")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_read(spark, sf_dir, "documents"),
                                     _vocabulary("byte_bpe_50k.json"),
                                     _vocabulary("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.conversation_rows(_read(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(conversations.damage(rows))


QUERIES = {"op3_string_kernel_toxicity": op3_string_kernel_toxicity,
           "op1_suffix_array_dedup": op1_suffix_array_dedup,
           "op2_source_mixing": op2_source_mixing, "op10_segment_top_k": op10_segment_top_k,
           "op4_best_fit_packing": op4_best_fit_packing, "op5_token_planes": op5_token_planes,
           "op6_positional_licences": op6_positional_licences,
           "op7_page_marginals": op7_page_marginals,
           "op8_tokeniser_fertility": op8_tokeniser_fertility,
           "op9_partenum_join": op9_partenum_join,
           "op11_mixture_languages": op11_mixture_languages,
           "op12_token_alignment": op12_token_alignment,
           "op13_conversation_repair": op13_conversation_repair}
ORACLES: dict[str, str] = {"op10_segment_top_k": TOP_K,
                           "op6_positional_licences": licences.oracle()}
