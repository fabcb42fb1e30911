"""Merge and trim jobs over finished vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.operators import vocab as vo
from vocabspark.operators.encode import Vocabulary
from vocabspark.session import checkpoint


def merge_bpe(
    base: Vocabulary, plus: Vocabulary, limit: int | None = None, order: str = "length"
) -> Vocabulary:
    """Union of two BPE vocabularies; everything but the merges comes from the base.

    Merges follow the union order, so with the length order the parts of a token always come
    before it. ``limit`` keeps the first merges only. Whitespace tokens keep the last ids.
    """
    fixed = base.tokens.where(~F.col("kind").isin("merge", "whitespace"))
    offset = fixed.count()
    union = checkpoint(vo.order_union(vo.union_bpe(base.merges, plus.merges), offset, order))
    if limit is not None:
        union = union.where(F.col("id") < offset + limit)
    end = offset + union.count()
    white = base.tokens.where(F.col("kind") == "whitespace")
    first = white.agg(F.min("id")).scalar()
    white = white.select("token", (F.col("id") - first + F.lit(end)).cast("int").alias("id"), "kind")
    tokens = vo.reindex_bpe(fixed, union).unionByName(white)
    merges = union.select((F.col("id") - offset).alias("rank"), "left", "right", "token")
    return Vocabulary(tokens, merges, base.spec)


def merge_unigram(
    base: DataFrame,
    plus: DataFrame,
    essentials: DataFrame,
    mode: str = "max",
    target: int | None = None,
) -> DataFrame:
    """Union of two unigram vocabularies, trimmed to ``target``, with all byte tokens, ordered."""
    union = checkpoint(vo.union_unigram(base, plus, mode))
    if target is not None:
        union = checkpoint(vo.trim_vocab(union, essentials, target))
    return vo.order_vocab(vo.repair_bytes(union, essentials))


def trim_unigram(base: DataFrame, essentials: DataFrame, target: int) -> DataFrame:
    """Add missing essentials, trim to ``target``, put essentials at the lowest scores, order."""
    filled = checkpoint(vo.add_essentials(base, essentials))
    trimmed = checkpoint(vo.trim_vocab(filled, essentials, target))
    return vo.order_vocab(vo.rescore_essentials(trimmed, essentials))
