"""The registered queries of this subpackage, one per operator, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.llm import (
    hnsw, html_extract, katz, licenses, line_dedup, mixing, near_dup, packing, quality, repeats, toxicity,
    url_filter, whitening,
)
from termtide.llm.oracles import ORACLES  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("doc").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "d2",
    )


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return found.select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op7_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = hnsw.embedding_links(table(spark, sf_dir, "embeddings"))
    own = F.col("component").eqNullSafe(F.col("id"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), own.alias("kept")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies"
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_texts(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (~toxicity.not_held_out("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = repeats.find_runs(table(spark, sf_dir, "documents"), rewrite=repeats.planted_places)
    return repeats.digests(runs).withColumnRenamed("doc", "doc_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.by_component(whitened).withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_extract": op4_html_extract,
    "op5_quality_rules": op5_quality_rules,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_katz_scores": op7_katz_scores,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_mixing": op10_mixing,
    "op11_toxicity": op11_toxicity,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_whitening": op13_whitening,
}
