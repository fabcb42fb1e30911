"""One query per operator over its whole table; digests are derived from the operators' real outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.llm import bpe_tree, decontaminate, html_main, katz, merkle, ngram_join, paragraph_dedup, pii
from vocabspark.llm import suffix_dedup, toxicity, vector_codes, warc, winnow
from vocabspark.llm.tables import limit_batches
from vocabspark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
REJECT_FROM = 0.7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    limit_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(id: Column, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text; a null id is in fold 0."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % parts


@query
def op1_ngram_jaccard_join(spark, sf):
    return ngram_join.join(table(spark, sf, "documents"), k=3, num=90, den=100)


@query
def op2_benchmark_decontamination(spark, sf):
    found = decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"), width=13)
    items = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op3_substring_dedup(spark, sf):
    return paragraph_dedup.repeats(table(spark, sf, "documents"))


@query
def op4_document_fingerprints(spark, sf):
    found = winnow.against_next(table(spark, sf, "documents"))
    return found.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


@query
def op5_lm_scoring(spark, sf):
    docs = table(spark, sf, "documents")
    scored = katz.score(docs, fold(F.col("doc_id"), 10) != 0)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Model:
    """Learned from the labelled rows outside the held-out fold."""
    labels = table(spark, sf, "labels").where(fold(F.col("doc_id"), 3) != 1)
    return toxicity.learn(docs, labels)


@query
def op6_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_FROM).cast("int").alias("predicted"),
        "spans",
    )


@query
def op7_suffix_array_dedup(spark, sf):
    found = suffix_dedup.repeated_spans(table(spark, sf, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op8_html_extraction(spark, sf):
    found = html_main.extract(table(spark, sf, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)


@query
def op9_byte_bpe(spark, sf):
    ranks = bpe_tree.read_ranks(spark, public_tokenizers.path(TOKENIZER))
    encoded = bpe_tree.encode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe_tree.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_pii(spark, sf):
    found = pii.spans(table(spark, sf, "documents"))
    base = pii.KINDS[:4]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(pii.listed(F.col("spans"), base), 256).alias("base_sha256"),
        pii.listed(F.col("spans"), pii.KINDS).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )


@query
def op11_merkle_manifest(spark, sf):
    docs = table(spark, sf, "documents")
    columns = [F.col(name) for name in merkle.LEAF_COLUMNS]
    lowered = [*columns[:-1], merkle.ascii_lower(F.col("text"))]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    seen = F.when(tampered, merkle.leaf(lowered))
    rows = docs.select("doc_id", "lang", merkle.leaf(columns).alias("digest"), seen.alias("seen"))
    found = merkle.manifest(rows, "lang", ["doc_id"])
    folded = merkle.fold(F.coalesce("seen", "digest"), F.col("path"))
    told = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_vector_codes(spark, sf):
    coded, books = vector_codes.compress(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    listed = ",".join(map(str, books.ravel().tolist()))
    return coded.select(
        F.col("id").alias("vec_id"),
        F.array_join(F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "").alias("code"),
        "error",
        "label_error",
        F.sha2(F.lit(listed), 256).alias("codebooks_sha256"),
    )


@query
def op13_warc(spark, sf):
    folder = scratch_path(spark, "warc")
    warc.write(table(spark, sf, "pages"), folder)
    found = warc.records(warc.read(spark, folder, payloads=False))
    return found.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_page").alias("refers_to"),
    )
