"""The registered queries of this subpackage and the SQL that says the same, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.llm import oracles
from glyphmill.llm.clustering import clustered
from glyphmill.llm.decontaminate import find_leaks
from glyphmill.llm.html_text import extract_text
from glyphmill.llm.line_dedup import line_dedup
from glyphmill.llm.merkle import merkle_manifest
from glyphmill.llm.mixing import mixed
from glyphmill.llm.ngram_join import ngram_join
from glyphmill.llm.quality_model import quality_scores
from glyphmill.llm.quality_rules import judged
from glyphmill.llm.substring_dedup import substring_dedup
from glyphmill.llm.token_counts import counts_from_trees
from glyphmill.llm.token_files import read_digests, write_ids
from glyphmill.llm.vector_dedup import near_vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), width=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, run=3).select("row.doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_from_trees(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_digests(write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_breaks = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    return merkle_manifest(table(spark, sf_dir, "documents"), without_breaks, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dim=64)


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if callable(f) and (k == "pipeline" or k.startswith("op"))}


def oracle_sql() -> dict[str, str]:
    by_number = {k.lower() + "_": v for k, v in vars(oracles).items() if k.startswith("OP")}
    return {q: by_number[n] for q in queries() if (n := q.split("_")[0] + "_") in by_number}
