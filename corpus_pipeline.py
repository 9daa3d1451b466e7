"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; `run` writes and rereads what each returns, and removes what a stage
staged once its result is written.

Null and empty texts and texts without a letter go in the first stage, as their
language isn't recognised. Of repeated rows and rows that share a doc_id one
stays in the second; rows with a null doc_id stay. Texts of any length are
processed whole. An empty table gives an empty result, and extra columns are
carried up to the last stage whatever their names, but for `cut_spans`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segweave.llm import language_id, mixing, ngram_join, packing, shared, substring_dedup


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model is fitted on their labels."""
    return language_id.accepted(docs, language_id.train(docs), least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles at a Jaccard similarity of 0.75 link."""
    return ngram_join.representatives(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of lower id has."""
    return substring_dedup.deduplicated(docs).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.copies(docs, weights=(3, 1, 2), share=1.5, most=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    import public_tokenizers

    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), length=1024, end_id=0)


STAGES = [("language_id", language), ("ngram_jaccard", near_duplicates), ("substring_dedup", substrings), ("mixing", mix), ("packing", pack)]
#: The language model, the bands and the chunks are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        known = shared.made_paths()
        docs = shared.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        made = [p for p in shared.made_paths() if p not in known]
        shared.remove(spark, [*before, *made[:-1]])  # the stage's result stands: what it was made from may go
        before = made[-1:]
    return docs
