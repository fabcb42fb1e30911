"""Product codes of vectors: a codebook per part, trained and applied through metric trees.

Rows are cut into chunks of ``CHUNK_ROWS`` inside the scan. A chunk holds one metric tree for each part position
(``metric_tree``); the chunks are written once, and every round reads them with the current codebooks, lets
the trees hand out whole balls, and brings back one sum and count per part, entry and task. Spark adds those
up; only the codebooks themselves (parts x entries x part length numbers) meet in the driver.

Defined cases. Rows whose vector is null, or holds a null, NaN or infinity, are dropped. The vector length
is that of the smallest id with a length the parts divide; a row of any other length is kept, without
code and error. Fewer rows than entries make as many entries as there are rows. Rows that share an id are rows of their own;
as first entries they order by their components. A null id comes after all others. Null labels are one label. Empty
tables give no rows. Squared distances of whole vectors must fit 62 bits; larger components are
an error. Other columns of the table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vocabspark.llm.metric_tree import Tree, build, nearest, sums_by_entry
from vocabspark.llm.tables import stored

CHUNK_ROWS = 4096
_KINDS = {
    "points": np.int64, "order": np.int32, "first": np.int32, "count": np.int32, "left": np.int32,
    "right": np.int32, "centre": np.float64, "radius": np.float64, "sums": np.int64,
}


@dataclass(frozen=True)
class Shape:
    """How vectors are coded."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Scaled components rounded down, as int64; an error if distances could pass 62 bits."""
    scaled = np.floor(vectors * scale)
    width = max(1, vectors.shape[-1])
    if scaled.size and np.abs(scaled).max() >= math.sqrt(2.0**62 / width) / 2:
        raise ValueError("components too large for whole distances of 62 bits")
    return scaled.astype(np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    inf = float("inf")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != inf) & (x != -inf))
    return vector.isNotNull() & finite


# --- chunks ---------------------------------------------------------------------------------------


def _packed(tree: Tree) -> dict[str, bytes]:
    """A tree as plain bytes. Points are small numbers as a rule and are written as narrow as they fit."""
    out = {name: np.ascontiguousarray(getattr(tree, name), kind).tobytes() for name, kind in _KINDS.items()}
    narrow = tree.points.astype(np.int16)
    if (narrow == tree.points).all():
        out["points"] = narrow.tobytes()
    return out


def _unpacked(row: dict[str, bytes], width: int) -> Tree:
    found = {name: np.frombuffer(row[name], kind) for name, kind in _KINDS.items() if name != "points"}
    n = len(found["order"])
    kind = np.int16 if len(row["points"]) == 2 * n * width else np.int64
    found["points"] = np.frombuffer(row["points"], kind).astype(np.int64).reshape(n, width)
    for name in ("centre", "sums"):
        found[name] = found[name].reshape(len(found["first"]), width)
    return Tree(**found)


def _whole_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``CHUNK_ROWS`` rows; the last one of a task may have fewer."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, CHUNK_ROWS - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == CHUNK_ROWS:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _planter(shape: Shape, length: int, schema: pa.Schema):
    """Vectors to chunks with a tree per part."""
    width = length // shape.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, chunk in enumerate(_whole_chunks(batches)):
            flat = chunk.column("vector").flatten().to_numpy(zero_copy_only=False)
            points = whole_numbers(flat.reshape(chunk.num_rows, length), shape.scale)
            cut = [np.ascontiguousarray(points[:, p * width : (p + 1) * width]) for p in range(shape.parts)]
            trees = [_packed(build(part)) for part in cut]
            one = pa.array([0, chunk.num_rows], pa.int32())
            columns = [
                pa.array([task + number], pa.int64()),
                pa.ListArray.from_arrays(one, chunk.column("id")),
                pa.ListArray.from_arrays(one, chunk.column("label")),
                pa.array([trees], schema.field("trees").type),
            ]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _chunked(rows: DataFrame, shape: Shape, length: int) -> DataFrame:
    tree = T.StructType([T.StructField(f.name, T.BinaryType()) for f in fields(Tree)])
    schema = T.StructType([
        T.StructField("chunk", T.LongType()),
        T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        T.StructField("labels", T.ArrayType(rows.schema["label"].dataType)),
        T.StructField("trees", T.ArrayType(tree)),
    ])
    return rows.mapInArrow(_planter(shape, length, to_arrow_schema(schema)), schema)


# --- rounds ---------------------------------------------------------------------------------------


def _trees(batch: pa.RecordBatch, row: int, width: int) -> list[Tree]:
    return [_unpacked(tree, width) for tree in batch.column("trees")[row].as_py()]


def _adder(books: np.ndarray):
    """Sums and counts of a task's chunks: one row per part and entry that has points."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(_trees(batch, row, width)):
                    more, n = sums_by_entry(tree, books[p])
                    sums[p] += more
                    counts[p] += n
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()),
            "entry": pa.array(entry, pa.int32()),
            "n": pa.array(counts[part, entry], pa.int64()),
            "sums": pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        })

    return run


def _next_books(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry moved to its points' mean, rounded down; entries without points stay."""
    told = chunks.select("trees").mapInArrow(_adder(books), "part int, entry int, n long, sums array<long>")
    each = told.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
    found = each.groupBy("part", "entry", "at").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).collect()
    out = books.copy()
    for row in found:
        out[row.part, row.entry, row.at] = row.value // row.n
    return out


def _coder(books: np.ndarray, schema: pa.Schema):
    """The nearest entry of every part of every row, and the squared distance to them."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                trees = _trees(batch, row, width)
                n = len(trees[0].order)
                codes, error = np.empty((n, parts), np.int32), np.zeros(n, np.int64)
                for p, tree in enumerate(trees):
                    codes[:, p] = nearest(tree, books[p])
                    off = tree.points - books[p][codes[tree.order, p]]
                    error[tree.order] += (off * off).sum(1)
                offsets = pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32))
                columns = [
                    pa.array(np.full(n, batch.column("chunk")[row].as_py()), pa.int64()),
                    batch.column("ids")[row].values,
                    batch.column("labels")[row].values,
                    pa.ListArray.from_arrays(offsets, pa.array(codes.ravel())),
                    pa.array(error),
                ]
                yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _coded(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    schema = T.StructType([
        T.StructField("chunk", T.LongType()),
        T.StructField("id", chunks.schema["ids"].dataType.elementType),
        T.StructField("label", chunks.schema["labels"].dataType.elementType),
        T.StructField("code", T.ArrayType(T.IntegerType())),
        T.StructField("error", T.LongType()),
    ])
    return chunks.mapInArrow(_coder(books, to_arrow_schema(schema)), schema)


def _with_label_error(rows: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels; a hot label meets its total chunk by chunk."""
    by_chunk = rows.groupBy("chunk", "label").agg(F.sum("error").alias("part_error"))
    total = by_chunk.groupBy(F.col("label").alias("of")).agg(F.sum("part_error").alias("label_error"))
    known = by_chunk.join(total, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("chunk").alias("at"), "of", "label_error"
    )
    same = (F.col("chunk") == F.col("at")) & F.col("label").eqNullSafe(F.col("of"))
    return rows.join(known, same).drop("at", "of")


# --- the operator ---------------------------------------------------------------------------------


def compress(
    vectors: DataFrame, id: str, vector: str, label: str, shape: Shape = Shape()
) -> tuple[DataFrame, np.ndarray]:
    """Rows ``(id, label, code, error, label_error)`` and the codebooks, (parts, entries, part length).

    ``code`` has the index of the nearest entry of each part.
    """
    rows = vectors.select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).where(usable(F.col("vector")))
    by_id = [F.asc_nulls_last("id"), "vector"]
    divided = (F.size("vector") > 0) & (F.size("vector") % shape.parts == 0)
    smallest = rows.where(divided).orderBy(*by_id).limit(1).collect()
    length = len(smallest[0].vector) if smallest else 0
    fitting = rows.where(F.size("vector") == length) if smallest else rows.limit(0)
    first = fitting.orderBy(*by_id).limit(shape.entries).collect()
    width = length // shape.parts
    seeds = whole_numbers(np.array([r.vector for r in first], float).reshape(len(first), length), shape.scale)
    books = np.ascontiguousarray(seeds.reshape(len(first), shape.parts, width).transpose(1, 0, 2))
    chunks = stored(_chunked(fitting, shape, length), "vectors") if smallest else _chunked(fitting, shape, length)
    for _ in range(shape.rounds if smallest else 0):
        books = _next_books(chunks, books)
    coded = _with_label_error(stored(_coded(chunks, books), "codes"))
    other = rows.where(F.size("vector") != length).select(
        "id",
        "label",
        F.lit(None).cast("array<int>").alias("code"),
        F.lit(None).cast("long").alias("error"),
        F.lit(None).cast("long").alias("label_error"),
    )
    return coded.drop("chunk").unionByName(other), books
