"""The training-data pipeline: stages over ``documents``, each written before the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.llm import catalog, common, decontaminate, near_dedup, pieces, quality, suffix_dedup
from opsloom.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality model accepts; it learns from the labels that are not held out."""
    labels = catalog.table(configure(spark), sf_dir, "labels").where(~quality.held_out("doc_id", 3, 1))
    model = quality.fit_quality(docs, labels)
    return quality.score_quality(docs, model).where("predicted = 1").select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id; of repeated rows one."""
    configure(spark)
    groups = near_dedup.near_duplicate_groups(docs)
    kept = docs.join(groups.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the characters that repeated 200-byte strings cover."""
    configure(spark)
    cleaned = suffix_dedup.remove_repeats(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    whole = F.col("n_removed") == 0
    return cleaned.select(*(F.when(whole, F.col(c)).otherwise(changed[c]).alias(c) if c in changed else c for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = catalog.table(configure(spark), sf_dir, "benchmark")
    return decontaminate.mark_contaminated(docs, benchmark).where("not contaminated").select(*docs.columns)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether its text comes back from them."""
    model = catalog.tokenizer_file("piece_bpe_32k.model")
    encoded = pieces.decode_pieces(pieces.encode_texts(docs, model), model)
    back = F.col("decoded") == F.coalesce("text", F.lit(""))
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_pieces", "pieces", back.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]
# The quality model and the piece encoder have no SQL form; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
