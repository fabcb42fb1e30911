"""Corpus operators: projection, samples, filters, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.functions.patterns import NOT_BLANK
from vocabspark.operators.order import TAKE_ORDERED_ROWS, first_rows, with_running_index


def select_key(df: DataFrame, key: str = "text") -> DataFrame:
    """The text column alone, named ``text``."""
    return df.select(F.col(key).alias("text"))


def rows_to_keep(n_rows: int, percent: float) -> int:
    """Whole number of rows that ``percent`` of ``n_rows`` makes."""
    return int(n_rows * (percent / 100))


def sample_prefix(
    df: DataFrame,
    percent: float,
    order_by: Sequence[str],
    take_ordered_rows: int = TAKE_ORDERED_ROWS,
) -> DataFrame:
    """The first ``percent`` of the rows in ``order_by`` order."""
    if percent == 100:
        return df
    keep = rows_to_keep(df.count(), percent)
    return first_rows(df, keep, order_by, take_ordered_rows)


def shuffle_key(seed: int, order_by: Sequence[str]) -> Column:
    """A repeatable pseudo-random sort key: the same for any partitioning and engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in order_by]))


def shuffle(
    df: DataFrame, seed: int, order_by: Sequence[str], position: str | None = None
) -> DataFrame:
    """Rows in a seeded random order; seed 0 leaves them in the order of ``order_by``.

    With ``position``, that column tells each row's place, for a table that is written and read again.
    """
    keys = [*([shuffle_key(seed, order_by)] if seed else []), *order_by]
    if position is None:
        return df.orderBy(*keys) if seed else df
    return with_running_index(df, keys, position).orderBy(position)


def sample_shuffled(
    df: DataFrame,
    percent: float,
    seed: int,
    order_by: Sequence[str],
    take_ordered_rows: int = TAKE_ORDERED_ROWS,
) -> DataFrame:
    """A seeded random ``percent`` of the rows: the prefix of their shuffled order."""
    if seed == 0:
        return sample_prefix(df, percent, order_by, take_ordered_rows)
    keyed = df.withColumn("_shuffle", shuffle_key(seed, order_by))
    sampled = sample_prefix(keyed, percent, ["_shuffle", *order_by], take_ordered_rows)
    return sampled.drop("_shuffle")


def within_length(key: str, max_length: int) -> Column:
    """Whether the text has at most ``max_length`` characters; 0 or less switches it off."""
    return F.length(key) <= max_length if max_length > 0 else F.lit(True)


def not_blank(key: str) -> Column:
    """Whether the text holds anything but Unicode whitespace; null counts as blank."""
    return F.coalesce(F.col(key).rlike(NOT_BLANK), F.lit(False))


def filter_max_length(df: DataFrame, key: str = "text", max_length: int = 4096) -> DataFrame:
    return df.where(within_length(key, max_length)) if max_length > 0 else df


def filter_blank(df: DataFrame, key: str = "text") -> DataFrame:
    return df.where(not_blank(key))


def take(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order."""
    return first_rows(df, n, order_by)


def corpus_profile(
    df: DataFrame, by: Sequence[str] = (), key: str = "text", max_length: int = 4096
) -> DataFrame:
    """Rows before and after each filter, with characters and bytes kept, in one pass."""
    short, full = within_length(key, max_length), not_blank(key)
    kept = short & full
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(short).alias("n_short"),
        F.count_if(full).alias("n_not_blank"),
        F.count_if(kept).alias("n_kept"),
        F.coalesce(F.sum(F.when(kept, F.length(key))), F.lit(0)).alias("chars_kept"),
        F.coalesce(F.sum(F.when(kept, F.octet_length(F.col(key)))), F.lit(0)).alias("bytes_kept"),
    )
