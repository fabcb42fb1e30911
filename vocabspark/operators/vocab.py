"""Vocabulary tables: counts, audits, unions, trims and repairs.

Tables: BPE ``vocab(token, id, kind)`` and ``merges(rank, left, right, token)``; unigram
``uvocab(token, logprob)``. Ties are always broken by token, so every result is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.functions.bytelevel import byte_alphabet, to_byte_chars
from vocabspark.operators.inventory import FIXED_WHITESPACE, UNKNOWN_TOKEN
from vocabspark.operators.order import first_rows, with_running_index

# --- fixed values ---------------------------------------------------------------------
EPSILON = 1e-7
CONTROL_PREFIX = "<|"
# ----------------------------------------------------------------------------------------

UNION_MODES = ("mean", "max", "min")


# --- BPE vocabularies -------------------------------------------------------------------


def vocab_counts(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """Sizes of a BPE vocabulary and whether they add up: vocabulary = other + merged tokens."""
    n_merges = merges.agg(F.count(F.lit(1))).scalar()
    n_merge_tokens = merges.agg(F.count_distinct("token")).scalar()
    kind = F.col("kind")
    counted = vocab.agg(
        F.count(F.lit(1)).alias("n_vocab"),
        F.count_if(kind.isin("special", "whitespace")).alias("n_added"),
        F.count_if(kind != "merge").alias("n_no_merge"),
    )
    adds_up = F.col("n_vocab") == F.col("n_no_merge") + n_merge_tokens
    return counted.select("*", n_merges.alias("n_merges"), adds_up.alias("adds_up"))


def _merge_at_id(vocab: DataFrame, merges: DataFrame, offset: int) -> DataFrame:
    at_id = merges.select(
        "rank", "left", "right", (F.col("rank") + F.lit(offset)).cast("int").alias("id")
    )
    return at_id.join(vocab.select("id", "token"), "id")


def merge_misaligned(vocab: DataFrame, merges: DataFrame, offset: int) -> DataFrame:
    """Merges whose text differs from the token at ``rank + offset``."""
    joined = _merge_at_id(vocab, merges, offset)
    return joined.where(F.concat("left", "right") != F.col("token"))


def merge_by_token(vocab: DataFrame, merges: DataFrame, offset: int) -> DataFrame:
    """Each merge token with the rule at its place."""
    return _merge_at_id(vocab, merges, offset).select("token", "id", "rank", "left", "right")


def _rule_per_token(merges: DataFrame, prefix: str) -> DataFrame:
    """One rule per token, the last one; the exchange by token also serves the union join."""
    rule = F.max_by(F.struct("rank", "left", "right"), "rank")
    last = merges.groupBy("token").agg(rule.alias("rule"))
    return last.select("token", *[F.col(f"rule.{c}").alias(f"{prefix}_{c}") for c in ("rank", "left", "right")])


def union_bpe(base: DataFrame, plus: DataFrame) -> DataFrame:
    """Tokens of both merge lists with their rule; the base rule wins.

    Gives ``(token, left, right, base_rank, plus_rank, length)``.
    """
    joined = _rule_per_token(base, "base").join(_rule_per_token(plus, "plus"), "token", "full_outer")
    return joined.select(
        "token",
        F.coalesce("base_left", "plus_left").alias("left"),
        F.coalesce("base_right", "plus_right").alias("right"),
        "base_rank",
        "plus_rank",
        F.length("token").alias("length"),
    )


UNION_ORDERS = {
    "length": ("length", "base_first", "rank", "token"),
    "rank": ("base_first", "rank", "token"),
}


def order_union(union: DataFrame, start: int = 0, order: str = "length") -> DataFrame:
    """Number the union: by token length (parts come before wholes), or base first."""
    keyed = union.withColumn("base_first", F.col("base_rank").isNull().cast("int"))
    keyed = keyed.withColumn("rank", F.coalesce("base_rank", "plus_rank"))
    numbered = with_running_index(keyed, UNION_ORDERS[order], "id", start)
    return numbered.select(
        "token", F.col("id").cast("int").alias("id"), "left", "right", "base_rank", "plus_rank", "length"
    )


def reindex_bpe(base_vocab: DataFrame, ordered_union: DataFrame) -> DataFrame:
    """The base vocabulary with the union's tokens laid over it: ``(token, id, kind)``."""
    merged = ordered_union.select("token", "id", F.lit("merge").alias("kind"))
    kept = base_vocab.join(ordered_union.select("token"), "token", "left_anti")
    return kept.select("token", "id", "kind").unionByName(merged)


def merge_budget(target: int, n_whitespace: int, n_added: int, n_alphabet: int = 256) -> int:
    """Merges that fit a target vocabulary size."""
    return target - n_alphabet - n_whitespace - n_added


def budget_deficit(union: DataFrame, target_merges: int) -> DataFrame:
    """How many merges the union has, and how many short of the budget it is."""
    return union.agg(F.count(F.lit(1)).alias("n_union")).select(
        F.lit(target_merges).cast("long").alias("target_merges"),
        "n_union",
        (F.lit(target_merges) - F.col("n_union")).alias("deficit"),
    )


# --- unigram vocabularies ---------------------------------------------------------------


def union_unigram(
    base: DataFrame, plus: DataFrame, mode: str = "max", epsilon: float = EPSILON
) -> DataFrame:
    """Tokens of both vocabularies. Only scores of shared tokens change.

    ``mean`` averages them, ``min`` takes the lower one, ``max`` takes the higher one plus
    ``epsilon``, but not above 0.
    """
    a, b = F.col("base_logprob"), F.col("plus_logprob")
    shared = {
        "mean": (a + b) / 2,
        "max": F.least(F.lit(0.0), F.greatest(a, b) + F.lit(epsilon)),
        "min": F.least(a, b),
    }
    if mode not in shared:
        raise ValueError(f"mode must be one of {UNION_MODES}")
    joined = base.select("token", F.col("logprob").alias("base_logprob")).join(
        plus.select("token", F.col("logprob").alias("plus_logprob")), "token", "full_outer"
    )
    both = a.isNotNull() & b.isNotNull()
    return joined.select("token", F.when(both, shared[mode]).otherwise(F.coalesce(a, b)).alias("logprob"))


def top_by_score(uvocab: DataFrame, n: int) -> DataFrame:
    """The ``n`` likeliest tokens."""
    keyed = uvocab.withColumn("_less", -F.col("logprob"))
    return first_rows(keyed, n, ["_less", "token"]).drop("_less")


ORDERS = {
    "score": lambda: [F.desc("logprob"), F.asc("token")],
    "length": lambda: [F.length("token"), F.desc("logprob"), F.asc("token")],
}


def order_vocab(uvocab: DataFrame, order: str = "score") -> DataFrame:
    """Add ``pos``: likeliest first, or shortest first and likeliest first within a length."""
    return with_running_index(uvocab, ORDERS[order](), "pos")


def essential_tokens(
    spark: SparkSession, exemplars: DataFrame, whitespace: Sequence[int] = tuple(FIXED_WHITESPACE)
) -> DataFrame:
    """Tokens that must stay: byte alphabet, exemplars and space runs, in byte form."""
    runs = spark.createDataFrame([(" " * n,) for n in whitespace], "token string")
    text = exemplars.select("token").unionByName(runs)
    in_bytes = text.select(to_byte_chars(F.col("token")).alias("token"))
    return byte_alphabet(spark).select(F.col("ch").alias("token")).unionByName(in_bytes).distinct()


def add_essentials(uvocab: DataFrame, essentials: DataFrame) -> DataFrame:
    """Add the essential tokens that are missing, at the lowest score."""
    lowest = uvocab.agg(F.min("logprob")).scalar()
    missing = essentials.select("token").distinct().join(uvocab, "token", "left_anti")
    return uvocab.select("token", "logprob").unionByName(missing.select("token", lowest.alias("logprob")))


def trim_vocab(uvocab: DataFrame, essentials: DataFrame, target: int) -> DataFrame:
    """Drop the unlikeliest tokens until ``target`` are left.

    Essential tokens and control tokens stay, even if they alone exceed the target.
    """
    control = F.col("token").startswith(CONTROL_PREFIX)
    others = uvocab.where(~control).join(essentials, "token", "left_anti")
    protected = uvocab.where(control).unionByName(
        uvocab.where(~control).join(essentials, "token", "left_semi")
    )
    room = max(target - protected.count(), 0)
    return protected.unionByName(top_by_score(others, room))


def intermediate_size(vocab: DataFrame, target: int) -> DataFrame:
    """Size the model vocabulary must have for the whole to reach ``target``.

    Takes off the tokens that stand outside the model and the entries that share a token.
    """
    sized = vocab.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~F.col("kind").isin("special", "whitespace")).alias("n_unadded"),
        F.count_distinct("token").alias("n_distinct"),
    )
    offsets = sized.withColumn("internal_offset", F.col("n_total") - F.col("n_distinct"))
    offsets = offsets.withColumn("added_offset", F.col("n_total") - F.col("n_unadded"))
    size = F.lit(target) - (F.col("internal_offset") + F.col("added_offset"))
    return offsets.withColumn("intermediate_size", size)


def _byte_tokens(spark: SparkSession) -> DataFrame:
    return F.broadcast(byte_alphabet(spark).select(F.col("ch").alias("token")))


def floor_bytes(uvocab: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Push byte tokens below all others: ``min - epsilon``."""
    floor = uvocab.agg(F.min("logprob") - F.lit(epsilon)).scalar()
    is_byte = _byte_tokens(uvocab.sparkSession).withColumn("is_byte", F.lit(True))
    joined = uvocab.join(is_byte, "token", "left")
    return joined.select("token", F.when(F.col("is_byte"), floor).otherwise(F.col("logprob")).alias("logprob"))


def repair_bytes(
    uvocab: DataFrame, essentials: DataFrame | None = None, epsilon: float = EPSILON
) -> DataFrame:
    """Floor the byte tokens and put missing ones in place of the unlikeliest other tokens.

    The size stays the same as long as there are tokens to give up; byte tokens and
    ``essentials`` are not given up.
    """
    spark = uvocab.sparkSession
    bytes_ = _byte_tokens(spark)
    floor = uvocab.agg(F.min("logprob") - F.lit(epsilon)).scalar()
    missing = bytes_.join(uvocab, "token", "left_anti")
    others = uvocab.join(bytes_, "token", "left_anti")
    protected = others.limit(0)
    if essentials is not None:
        protected = others.join(essentials, "token", "left_semi")
        others = others.join(essentials, "token", "left_anti")
    kept = top_by_score(others, max(others.count() - missing.count(), 0))
    every_byte = bytes_.select("token", floor.alias("logprob"))
    return protected.unionByName(kept).unionByName(every_byte)


def rescore_essentials(
    uvocab: DataFrame, essentials: DataFrame, epsilon: float = EPSILON
) -> DataFrame:
    """Give essential tokens the lowest scores, lower the longer: ``min - epsilon * (length - 1)``."""
    lowest = uvocab.agg(F.min("logprob")).scalar()
    marked = essentials.select("token").distinct().withColumn("is_essential", F.lit(True))
    joined = uvocab.join(marked, "token", "left")
    score = lowest - F.lit(epsilon) * (F.length("token") - 1)
    return joined.select(
        "token", F.when(F.col("is_essential"), score).otherwise(F.col("logprob")).alias("logprob")
    )


# --- audits -----------------------------------------------------------------------------


def duplicate_tokens(vocab: DataFrame) -> DataFrame:
    """Tokens listed more than once."""
    return vocab.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dedupe_vocab(listed: DataFrame) -> DataFrame:
    """One entry per token of ``(pos, token, logprob)``; the last one wins."""
    return listed.groupBy("token").agg(F.max_by("logprob", "pos").alias("logprob"))


def exemplar_coverage(vocab: DataFrame, exemplars: DataFrame) -> DataFrame:
    """Per exemplar ``set``, how many exemplars the vocabulary holds."""
    held = vocab.select("token").distinct().withColumn("held", F.lit(True))
    return (
        exemplars.join(held, "token", "left")
        .groupBy("set")
        .agg(F.count(F.lit(1)).alias("n_exemplars"), F.count_if("held").alias("n_covered"))
    )


def check_size(vocab: DataFrame, target: int) -> DataFrame:
    """Distinct tokens against the intended size."""
    return vocab.agg(F.count_distinct("token").alias("n")).select(
        "n", F.lit(target).cast("long").alias("target"), (F.col("n") == target).alias("matches")
    )


def set_unk(meta: DataFrame, vocab: DataFrame, token: str = UNKNOWN_TOKEN) -> DataFrame:
    """Fill ``unk_id`` of a meta table with the id of the unknown token, if it has one."""
    unk_id = vocab.where(F.col("token") == token).agg(F.min("id")).scalar()
    return meta.withColumn("unk_id", unk_id)
