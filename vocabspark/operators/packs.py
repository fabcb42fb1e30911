"""Array columns in packs: a pack holds some rows' elements once each, and the rows as places in that list.

What is joined with a large table are the different elements of each pack, not every place of them, so that a shuffle
carries a few rows a pack where the texts have thousands of places. Inside tasks the same is done by a batch's parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.operators.lattice import skew_join
from vocabspark.session import checkpoint

# Elements of the rows that are handled together; a longer row is alone.
MOST_ELEMENTS = 1 << 18
# Elements of a pack: the more, the fewer of them are different ones.
PACK_ELEMENTS = 1 << 20
_PACK = "rows array<bigint>, codes binary, different array<string>"


# --- inside tasks -------------------------------------------------------------------------------------


def sizes_of(lists: pa.Array) -> np.ndarray:
    """Elements of each list; none in a null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def stretches(lists: pa.Array, most: int = MOST_ELEMENTS) -> Iterator[tuple[int, int]]:
    """Stretches of rows with ``most`` elements together, one row at least: begin and end."""
    ends = np.cumsum(sizes_of(lists))
    start, before = 0, 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop
        start, before = stop, int(ends[stop - 1])


def dictionary(flat: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The place of each text among the different ones, and these."""
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def flat_numbers(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and which of them are null."""
    flat = lists.flatten().cast(pa.int64())
    return pc.fill_null(flat, 0).to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)


def gathered(starts: np.ndarray, widths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs that ``which`` names, one after another, and where each begins and the last ends."""
    wide = widths[which]
    at = np.append(0, np.cumsum(wide))
    return np.repeat(starts[which] - at[:-1], wide) + np.arange(at[-1]), at


def list_array(values: pa.Array, sizes: np.ndarray, like: pa.Array) -> pa.Array:
    """Lists of the given sizes; null where ``like`` is."""
    offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null() if like.null_count else None)


# --- packs --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Packs:
    """``table(_pack, rows, codes, different)``: written out, since the packs' borders are those of batches.

    ``codes`` are compressed (:func:`places`): they are as many as the elements, and are written and shuffled.
    """

    table: DataFrame

    def keys(self) -> DataFrame:
        """``(_pack, place, key)``: the different elements of each pack."""
        return self.table.select("_pack", F.posexplode("different").alias("place", "key"))


def shut(codes: pa.ListArray) -> bytes:
    """Lists of places as compressed bytes."""
    sizes = pc.fill_null(pc.list_value_length(codes), -1).to_numpy(zero_copy_only=False).astype(np.int32)
    whole = np.concatenate([np.array([len(sizes)], np.int32), sizes, codes.flatten().to_numpy().astype(np.int32)]).tobytes()
    return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def opened(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Size of each list (-1: null) and all places from :func:`shut`."""
    whole = np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True), np.int32)
    rows = int(whole[0])
    return whole[1 : rows + 1], whole[rows + 1 :]


def places(codes: pa.Array) -> pa.Array:
    """The lists of places of each pack."""
    sizes, flat = zip(*map(opened, codes.to_pylist())) if len(codes) else ([], [])
    rows = np.append(0, np.cumsum([len(s) for s in sizes])).astype(np.int32)
    sizes, flat = (np.concatenate([np.zeros(0, np.int32), *parts]) for parts in (sizes, flat))
    ends = np.append(0, np.cumsum(np.maximum(sizes, 0))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=pa.array(sizes < 0))
    return pa.ListArray.from_arrays(pa.array(rows), lists)


def packed(df: DataFrame, elements: Column) -> Packs:
    """Packs of an array of strings without nulls, for a table that has a number ``_row`` of its own for each row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def pack_of(held: list[tuple[pa.Array, pa.Array]]) -> pa.RecordBatch:
            own = pa.concat_arrays([lists for lists, _ in held])
            coded = own.flatten().dictionary_encode()
            codes = pa.array([shut(list_array(coded.indices.cast(pa.int32()), sizes_of(own), own))], pa.binary())
            columns = [whole(pa.concat_arrays([rows for _, rows in held])), codes, whole(coded.dictionary)]
            return pa.RecordBatch.from_arrays(columns, names=["rows", "codes", "different"])

        held, size = [], 0
        for batch in batches:
            lists, rows = batch.column("elements"), batch.column("_row")
            for a, b in stretches(lists):
                amount = int(sizes_of(lists.slice(a, b - a)).sum())
                if held and size + amount > PACK_ELEMENTS:
                    yield pack_of(held)
                    held, size = [], 0
                held.append((lists.slice(a, b - a), rows.slice(a, b - a)))
                size += amount
        if held:
            yield pack_of(held)

    made = df.select("_row", elements.alias("elements")).mapInArrow(pack, _PACK)
    return Packs(checkpoint(made.withColumn("_pack", F.monotonically_increasing_id())))


def unpacked(packs: Packs, table: DataFrame, value: str, combine: Callable[[Column], Column]) -> DataFrame:
    """``(_row, value)``: for each row its elements' values of ``table(key, value)``, which has every key, combined.

    A null array stays null.
    """
    joined = skew_join(packs.keys(), table, "key", F.struct("_pack", "place"))
    in_order = F.array_sort(F.collect_list(F.struct("place", value)))
    found = joined.groupBy("_pack").agg(F.transform(in_order, lambda p: p[value]).alias("_values"))
    filled = packs.table.join(found.hint("merge"), "_pack", "left")
    values = F.coalesce("_values", F.array().cast(found.schema["_values"].dataType))
    lists = F.arrow_udf(places, "array<array<int>>")
    each = F.transform(lists("codes"), lambda c: combine(F.transform(c, lambda i: F.get(values, i))))
    made = F.arrays_zip(F.col("rows").alias("_row"), each.alias(value))
    return filled.select(F.inline(made)).toDF("_row", value)
