"""Global order without moving everything to one task: running index and first-k rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from vocabspark.session import checkpoint

# Up to here a top-k runs as one TakeOrdered; beyond it, by a threshold on the key. The rows are the same.
TAKE_ORDERED_ROWS = 100_000
_NO_ORDER = (MapType, VariantType)

_ROW_BITS = (1 << 33) - 1


def _ranged(df: DataFrame, order: Sequence[Column | str]) -> tuple[DataFrame, list[int]]:
    """Range-partition and sort, fix the result, and number rows inside each partition.

    Range bounds come from a sample, so the partitioning is written out before it is used
    twice. Returns the table with ``_part`` and ``_row``, and rows per partition (as many
    numbers as partitions, whatever the data size).
    """
    ranged = checkpoint(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    counted = dict(ranged.groupBy("_part").count().collect())
    return ranged, [counted.get(part, 0) for part in range(max(counted, default=-1) + 1)]


def with_running_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "pos", start: int = 0
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the given total order."""
    ranged, sizes = _ranged(df, order)
    before = [0, *accumulate(sizes)]
    offset = F.get(F.lit(before).cast("array<long>"), F.col("_part"))
    return ranged.withColumn(name, offset + F.col("_row") + F.lit(start)).drop("_part", "_row")


def first_rows(
    df: DataFrame,
    k: int,
    keys: Sequence[str],
    take_ordered_rows: int = TAKE_ORDERED_ROWS,
) -> DataFrame:
    """The first ``k`` rows by ascending ``keys``, nulls first.

    Rows with equal keys go by their other columns, in the order of the table (maps aside), so that the
    result is the same rows for any ``k``, partitioning or size. A small ``k`` is one TakeOrdered. A larger one sorts
    the key columns alone and reads off the k-th key. All rows before that key are a filter of the table; of those
    that hold it, a quota is left, and only these rows are numbered in the order of their other columns.
    """
    rest = [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, _NO_ORDER)]
    if k <= take_ordered_rows:
        return df.orderBy(*keys, *rest).limit(max(k, 0))
    ranged, sizes = _ranged(df.select(*keys, _tail()), [*keys, "_tail"])
    if k >= sum(sizes):
        return df
    part, seen = 0, 0
    while seen + sizes[part] < k:
        seen += sizes[part]
        part += 1
    found = ranged.where((F.col("_part") == part) & (F.col("_row") == k - seen - 1)).first()
    last = [found[key] for key in keys]
    before, same = _before(keys, last), _same(keys, last)
    counted = ranged.agg(F.count_if(before).alias("before"), F.count_if(same).alias("same")).first()
    quota = k - counted.before
    if quota == counted.same:
        return df.where(_before(keys, last, or_same=True))
    tied = with_running_index(df.where(same).withColumn("_tail", _tail()), [*rest, "_tail"], "_pos")
    return df.where(before).unionByName(tied.where(F.col("_pos") < quota).drop("_pos", "_tail"))


def _tail() -> Column:
    """A last sort key that spreads equal rows over range partitions."""
    return F.monotonically_increasing_id().alias("_tail")


def _same(keys: Sequence[str], last: Sequence) -> Column:
    return reduce(Column.__and__, [F.col(key).eqNullSafe(F.lit(value)) for key, value in zip(keys, last)])


def _before(keys: Sequence[str], last: Sequence, or_same: bool = False) -> Column:
    """``keys < last`` (or ``<=``) in lexicographic order, nulls first, never null; scans can push it down."""
    head, value = F.col(keys[0]), F.lit(last[0])
    null = head.isNull()
    if len(keys) == 1 and or_same:
        return null if last[0] is None else null | (head <= value)
    below = F.lit(False) if last[0] is None else null | (head < value)
    if len(keys) == 1:
        return below
    return below | (head.eqNullSafe(value) & _before(keys[1:], last[1:], or_same))
