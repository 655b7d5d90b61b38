"""A corpus from documents: quality rules, near duplicates, decontamination, mixing, token files. Each stage works on the rows that the
one before it kept; all but the last give rows with the columns of documents.

Defined cases, in every stage: extra columns of any name come along; an empty table gives an empty one. A null text counts as empty."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go. Texts without words fail; a null source is a host; repeated rows fail or stay
    together."""
    from glyphmill.llm.quality_rules import keep_good

    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles connect, at a similarity of 0.8 or more, the one with the smallest id stays; of
    rows with that id the one with the smallest hash of its text, of equal rows one. Texts without words are linked with nothing, so they
    stay. A null doc_id is larger than any other."""
    from glyphmill.llm.ngram_join import first_of_each

    return first_of_each(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go. Items without words are never found, shorter ones are as a whole;
    repeated rows go or stay together."""
    from glyphmill.llm.decontaminate import drop_leaks

    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it. A null source is a source; repeated rows are taken together; documents without
    words cost nothing and come with their place in the draw."""
    from glyphmill.llm.mixing import repeated

    return repeated(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the ids and reads them back: (doc_id, start, n_tokens, ids_crc32) of each document in the files. Empty texts have
    the end id only; documents of null doc_id come first; repeated rows come each time."""
    from glyphmill.llm.token_files import read_digests, write_ids

    return read_digests(write_ids(docs, public_tokenizers.path(TOKENIZER), added=True))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source mix", mix_sources),
    ("token files", write_tokens),
]

#: The last stage, tokenization, isn't SQL; tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from glyphmill.llm._work import stored

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
