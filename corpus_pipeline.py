"""A training-data pipeline over ``documents``: each stage applies one operator and acts on it.

Every stage works on all rows that the one before it kept and returns the columns of documents, but
for the last, which returns token ids. Rows with nulls in any column pass through the filters
unless an operator decides against them; an empty table gives an empty table; further columns pass
through untouched as far as the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.llm import bpe_tree, decontaminate, ngram_join, pii, toxicity
from vocabspark.llm.queries import REJECT_FROM, TOKENIZER, ids_digest, table, toxicity_model
from vocabspark.llm.tables import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field scores below the threshold."""
    return toxicity.accepted(docs, toxicity_model(spark, docs, sf_dir), REJECT_FROM)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Five-word shingles, similarity 0.8 or more. Rows with a null id, and texts without words, are in no
    group and stay. Equal rows of one id are one document: one row of them stays.
    """
    groups = ngram_join.join(docs.select("doc_id", "text"), k=5, num=8, den=10)
    gone = groups.where("doc_id is not null and component_id < doc_id").select("doc_id", "n_shingles").distinct()
    rest = docs.join(gone.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return rest
    again = rest.join(repeated, "doc_id", "left_semi").select(docs.columns)
    return rest.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(again.dropDuplicates(["doc_id", "text"]))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), width=13)
    gone = stored(found.where("contaminated and doc_id is not null").select("doc_id").distinct(), "contaminated")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the names of its kinds and the length restated."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives its text back."""
    ranks = bpe_tree.read_ranks(spark, public_tokenizers.path(TOKENIZER))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    decoded = bpe_tree.decode(bpe_tree.encode(texts, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", tokenize_stage),
]

# The first stage is a fitted classifier, which SQL cannot state; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
