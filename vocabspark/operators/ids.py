"""Id layout of a vocabulary: specials, alphabet, learned tokens, whitespace tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.operators.order import with_running_index


def assign_ids(
    added: DataFrame, alphabet: DataFrame, merges: DataFrame, whitespace: DataFrame
) -> DataFrame:
    """``(token, id, kind)`` of a BPE vocabulary.

    ``added``, ``alphabet`` and ``whitespace`` need ``token``; ``merges`` also needs
    ``rank``. A token learned by two merge rules keeps its first place.
    """
    learned = merges.groupBy("token").agg(F.min("rank").cast("double").alias("rank"))
    parts = {
        "special": _unranked(added),
        "alphabet": _unranked(alphabet),
        "merge": learned,
        "whitespace": _longest_first(whitespace),
    }
    return _number(parts).select("token", "id", "kind")


def assign_unigram_ids(added: DataFrame, uvocab: DataFrame, whitespace: DataFrame) -> DataFrame:
    """``(token, id, kind, logprob)`` of a unigram vocabulary, likeliest tokens first.

    Tokens outside the model (added and whitespace) have no score.
    """
    model = uvocab.join(added.select("token"), "token", "left_anti")
    parts = {
        "special": _unranked(added),
        "token": model.select("token", (-F.col("logprob")).alias("rank")),
        "whitespace": _longest_first(whitespace),
    }
    score = F.when(F.col("kind") == "token", -F.col("rank")).alias("logprob")
    return _number(parts).select("token", "id", "kind", score)


def _unranked(tokens: DataFrame) -> DataFrame:
    return tokens.select("token", F.lit(0.0).alias("rank"))


def _longest_first(tokens: DataFrame) -> DataFrame:
    return tokens.select("token", (-F.length("token")).cast("double").alias("rank"))


def _number(parts: dict[str, DataFrame]) -> DataFrame:
    rows = None
    for section, (kind, part) in enumerate(parts.items()):
        part = part.select("token", "rank", F.lit(kind).alias("kind"), F.lit(section).alias("section"))
        rows = part if rows is None else rows.unionByName(part)
    numbered = with_running_index(rows, ["section", "rank", "token"], "id")
    return numbered.withColumn("id", F.col("id").cast("int"))
