"""The training-data pipeline: documents through five operators, each judged on its own input.

Every stage is written as Parquet and read back as the next stage's documents. All but the last
return the columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import mixing, packing, partenum, repeats, toxicity
from orderlens.llm.tables import written

#: No SQL: scores, draws and packing are beyond it; tests hold each stage against brute force.
ORACLE_SQL = None
#: Documents from this score on are rejected.
TOXIC = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every row whose document scores as toxic; null and empty texts stay. Rows that share
    a doc_id go together. Learns from the labelled documents that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit_labelled(docs, labels)
    rejected = _free(docs, "rejected")
    toxic = toxicity.toxicity_scores(docs, model).where(F.col("score") >= TOXIC).select(
        F.col("doc_id").alias(rejected)).distinct()
    return docs.join(toxic, F.col("doc_id").eqNullSafe(F.col(rejected)), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links of similar word sets join, the one with the smallest
    doc_id stays; rows without words, and rows without doc_id, are in no group and stay. Five
    words a shingle, similarity 0.8 or more. Rows that share a doc_id share its fate."""
    copy = _free(docs, "copy")
    gone = partenum.similarity_classes(docs, words=5, similarity=partenum.Fraction(8, 10)).where(
        "component_id <> doc_id").select(F.col("doc_id").alias(copy)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(copy), "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of 100 bytes or more that also starts earlier out of the texts; whole
    characters only. Null texts stay null, and so do ``n_chars`` that were null; otherwise
    ``n_chars`` is counted anew. Rows without a change stay as they are; no row is dropped."""
    columns = docs.columns
    row, of, cut_row, kept = (_free(docs, n) for n in ("text_hash", "cut_id", "cut_hash", "kept"))
    keyed = docs.withColumn(row, F.xxhash64(F.col("text").cast("string")))
    cut = repeats.remove_repeats(docs, length=100, characters=True).where("n_removed > 0").select(
        F.col("doc_id").alias(of), F.col("row").alias(cut_row),
        F.decode("kept", "UTF-8").alias(kept)).distinct()
    met = keyed.join(cut, F.col("doc_id").eqNullSafe(F.col(of))
                     & F.col(row).eqNullSafe(F.col(cut_row)), "left")
    left = F.col(kept)
    made = {"text": F.when(left.isNull(), F.col("text")).otherwise(left)}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(left.isNull() | F.col("n_chars").isNull(),
                                 F.col("n_chars")).otherwise(F.char_length(left).cast(kind))
    return met.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by target weights: each row as often as the mix takes it, up to
    three times; copies keep their doc_id."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece of each copy of a document."""
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [("toxicity", toxicity_filter), ("near_duplicates", near_duplicates),
          ("suffix_array_dedup", repeated_passages), ("source_mixing", source_mixing),
          ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
