"""Reports over an encoded corpus, grouped by any columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.functions.normalize import normalize
from vocabspark.operators.encode import Vocabulary, decode, token_bytes
from vocabspark.operators.lattice import skew_join
from vocabspark.session import fits_broadcast

REPLACEMENT = "\ufffd"
FALLBACK_LABEL = "|ufb|"


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.round(part / whole, 6))


def invertibility(
    df: DataFrame,
    vocab: Vocabulary,
    by: Sequence[str] = (),
    key: str = "text",
    ids: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Share of texts that decode to themselves, and to their normal form."""
    back = decode(df, vocab, ids)
    same = F.col("decoded") == F.col(key)
    same_normal = F.col("decoded") == normalize(F.col(key), vocab.spec.normal_form)
    checked = back.select(*by, same.alias("same"), same_normal.alias("same_normal"))
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if("same").alias("n_invertible"),
        F.count_if("same_normal").alias("n_invertible_normal"),
        _ratio(F.count_if("same"), F.count(F.lit(1))).alias("share_invertible"),
    )


def length_stats(
    df: DataFrame, by: Sequence[str] = (), key: str = "text", tokens: Column | None = None
) -> DataFrame:
    """Characters, bytes and tokens, with their ratios.

    ``tokens`` is the array column to count, the token ids by default.
    """
    n = F.size(F.col("ids") if tokens is None else tokens)
    sized = df.select(
        *by,
        F.length(key).alias("chars"),
        F.octet_length(F.col(key)).alias("bytes"),
        F.when(n >= 0, n).alias("tokens"),
    )
    totals = sized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("chars").alias("chars"),
        F.sum("bytes").alias("bytes"),
        F.sum("tokens").alias("tokens"),
    )
    return totals.withColumn("chars_per_token", _ratio(F.col("chars"), F.col("tokens"))).withColumn(
        "bytes_per_token", _ratio(F.col("bytes"), F.col("tokens"))
    )


def token_frequency(
    encoded: DataFrame, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``(by..., id, n)``: how often each token is used; counted before the shuffle.

    ``weight`` names the column that says how often a row of ``encoded`` counts, for encoded
    distinct pieces.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    each = encoded.select(*by, times.cast("long").alias("_times"), F.explode("ids").alias("id"))
    return each.groupBy(*by, "id").agg(F.sum("_times").alias("n"))


def token_decode_table(vocab: Vocabulary) -> DataFrame:
    """Each token decoded alone: ``(id, token, decoded, is_fallback, has_fallback)``."""
    decoded = F.make_valid_utf8(F.col("bytes").cast("string"))
    return token_bytes(vocab).select(
        "id",
        "token",
        decoded.alias("decoded"),
        (decoded == REPLACEMENT).alias("is_fallback"),
        F.contains(decoded, F.lit(REPLACEMENT)).alias("has_fallback"),
    )


def _with_decoded(rows: DataFrame, table: DataFrame, spread: Column) -> DataFrame:
    """Join rows with the decode table, by broadcast only if it is small enough."""
    if fits_broadcast(table):
        return rows.join(F.broadcast(table), "id")
    return skew_join(rows, table, "id", spread)


def fallback_portion(
    encoded: DataFrame, vocab: Vocabulary, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Share of tokens that decode alone to exactly one U+FFFD, or hold one.

    Tokens are counted per group first, so the join sees one row per token and group.
    """
    used = _with_decoded(token_frequency(encoded, by, weight), token_decode_table(vocab), F.struct(*by, "id"))
    totals = used.groupBy(*by).agg(
        F.sum("n").alias("n_tokens"),
        F.coalesce(F.sum(F.when(F.col("is_fallback"), F.col("n"))), F.lit(0)).alias("n_fallback"),
        F.coalesce(F.sum(F.when(F.col("has_fallback"), F.col("n"))), F.lit(0)).alias("n_holding"),
    )
    return totals.withColumn("portion", _ratio(F.col("n_fallback"), F.col("n_tokens")))


def reconstruction(
    encoded: DataFrame, vocab: Vocabulary, ids: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Each token of each text decoded alone, ``|ufb|`` where that gives no character."""
    each = encoded.select(*ids, F.posexplode("ids").alias("pos", "id"))
    shown = F.when(F.col("is_fallback"), FALLBACK_LABEL).otherwise(F.col("decoded"))
    return _with_decoded(each, token_decode_table(vocab), F.struct(*ids, "pos")).select(
        *ids, "pos", "id", "token", shown.alias("shown")
    )


def unigram_alp(uvocab: DataFrame, budget: int) -> DataFrame:
    """Mean log probability: the sum of the scores over ``budget``."""
    return uvocab.agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.round(F.sum("logprob") / F.lit(budget), 6).alias("alp"),
    )
