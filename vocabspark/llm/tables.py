"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.words import CHUNK_BYTES, chunks, forget, mix
from vocabspark.session import limit_batches, scratch_path


# Bits of a sieve for each number it lets pass, and the most of all: 16 MB in every task.
SIEVE_BITS, MOST_SIEVE_BITS = 16, 1 << 27


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors.

    Used where a table is read more than once and holds packed rows; zstd keeps it small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Made = TypeVar("Made")


def freed(made: Made) -> Made:
    """The same object; what the process no longer uses goes back to the system.

    A worker of Python lives on between its tasks, and what it holds stands beside the heap of later stages.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)
    return made


def tidy() -> None:
    """Gives back all that a task used; for its end."""
    forget()
    gc.collect()  # functions that carry their code hold what their tasks kept in cycles
    freed(None)


def tidied(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function over batches; at the end of its task all it used goes back to the system."""

    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        tidy()

    return run


def by_chunk(function: Callable[[pa.RecordBatch], pa.RecordBatch], text: str, limit: int = CHUNK_BYTES):
    """A mapInArrow function that sees a few megabytes of ``text`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text, limit):
                yield function(part)

    return tidied(run)


def input_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column, by one aggregate."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(amount: int, each: int) -> int:
    """Partitions for an amount of work at ``each`` units a task; grows with the input."""
    return max(1, -(-amount // each))


def fields_of(made: object) -> tuple:
    """The fields of a dataclass instance, for a broadcast: it then needs no class of this package on the executors."""
    return tuple(vars(made).values())


def sieved(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column`` (a long) is in ``wanted``, a table of longs without nulls, and a few others; for the side of a join.

    What the join would drop is dropped where it is read, and not shuffled. Each number marks a bit of a bounded map
    that goes to every task; the more numbers, the more other rows pass, but none of the wanted is lost.
    """
    numbers = wanted.toDF("number")
    room, bits = min(MOST_SIEVE_BITS, SIEVE_BITS * numbers.count()), 1 << 16
    while bits < room:
        bits *= 2

    def place(values: np.ndarray) -> np.ndarray:
        return (mix(values.view(np.uint64)) % np.uint64(bits)).astype(np.int64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(place(batch.column("number").to_numpy()))
            if not len(at):
                continue
            word = at >> 6
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            marks = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
            yield pa.record_batch({"word": word[first], "marks": marks.view(np.int64)})

    table = numbers.mapInArrow(tidied(mark), "word long, marks long").groupBy("word").agg(F.bit_or("marks").alias("marks")).toArrow()
    words = np.zeros(bits >> 6, np.int64)
    words[table["word"].to_numpy()] = table["marks"].to_numpy()
    sent = df.sparkSession.sparkContext.broadcast(words)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value.view(np.uint64)
        for batch in batches:
            values = batch.column(column)
            at = place(values.fill_null(0).to_numpy(zero_copy_only=False))
            keep = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield batch.filter(pa.compute.and_(pa.array(keep), values.is_valid()))

    return df.mapInArrow(tidied(sift), df.schema)
