"""Benchmark decontamination with a positional inverted index of the documents.

The index is document-partitioned, as in a distributed search engine: each row of the stored index
covers a few megabytes of documents and holds, term by term, the sorted positions of every
benchmark term in them. A query (a window of benchmark words) is answered inside each row: the
postings of its rarest term give candidate places, and the postings of its other terms, shifted by
their offsets and taken from the next rarest on, are intersected with them. No posting is
shuffled; what goes to the tasks is the benchmark, whose size is checked.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import by_chunk, fields_of, stored
from vocabspark.llm.words import NOT_ALNUM, list_column, signed, words_of

# Words of all benchmark items together; they are gathered and broadcast (8 bytes each, and 4 for
# each place of a window). A larger benchmark is an error, to be run in several parts.
MAX_ITEM_WORDS = 4_000_000

_INDEX = (
    "doc_id array<long>, no_id array<boolean>, bounds array<int>, terms array<int>, sizes array<int>, positions array<int>"
)


@dataclass
class Queries:
    """Distinct windows of all items."""

    terms: np.ndarray  # sorted word hashes of the benchmark
    windows: np.ndarray  # windows x width: index into terms, -1 beyond a short item's end
    lengths: np.ndarray
    items: np.ndarray  # item ids, window by window
    item_at: np.ndarray  # where the items of each window begin, one more than windows


def item_windows(benchmark: DataFrame, width: int, id: str = "item_id", text: str = "text") -> Queries:
    """Windows of ``width`` words of each item; an item of fewer words, but not none, is one window.

    Items with a null id or without words have no windows. Equal windows are one query that names
    all their items.
    """

    def words(part: pa.RecordBatch) -> pa.RecordBatch:
        found = words_of(part.column("text"), NOT_ALNUM)
        each = [signed(found.hashes[a:b]) for a, b in zip(found.bounds[:-1], found.bounds[1:])]
        return pa.record_batch({"id": part.column("id"), "words": list_column(each, pa.int64())})

    items = benchmark.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    items = items.mapInArrow(by_chunk(words, "text"), "id long, words array<long>").where("size(words) > 0")
    items = stored(items, "items")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    if total > MAX_ITEM_WORDS:
        raise ValueError(f"the benchmark has {total} words, more than {MAX_ITEM_WORDS}: pass it in parts")
    table = items.toArrow().combine_chunks()
    every = [np.array(w, np.int64).view(np.uint64) for w in table["words"].to_pylist()]
    terms = np.unique(np.concatenate(every)) if every else np.zeros(0, np.uint64)
    rows, owners = [], []
    for item, hashes in zip(table["id"].to_pylist(), every):
        at = np.searchsorted(terms, hashes).astype(np.int32)
        if len(at) < width:
            at = np.append(at, np.full(width - len(at), -1, np.int32))
        found = np.lib.stride_tricks.sliding_window_view(at, width)
        rows.append(found)
        owners.append(np.full(len(found), item, np.int64))
    if not rows:
        return Queries(terms, np.zeros((0, width), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
    windows, window = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    owner = np.concatenate(owners)
    pairs = np.unique(np.stack([window.reshape(-1), owner], 1), axis=0)
    item_at = np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1))
    return Queries(terms, windows.astype(np.int32), (windows >= 0).sum(1), pairs[:, 1], item_at)


def build_index(docs: DataFrame, terms: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored positional index: per row a few megabytes of documents, one document at least.

    ``bounds`` holds where each document's words begin (and the end), ``terms`` the terms that occur,
    ``sizes`` how often, ``positions`` their word positions, term by term in ascending order.
    """
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def index(part: pa.RecordBatch) -> pa.RecordBatch:
        terms = known.value
        found = words_of(part.column("text"), NOT_ALNUM)
        at = np.zeros(0, np.int64)
        place = at
        if len(terms) and len(found.hashes):
            at = np.searchsorted(terms, found.hashes)
            at[at == len(terms)] = 0
            place = np.flatnonzero(terms[at] == found.hashes)
            at = at[place]
            order = np.argsort(at.astype(np.uint16) if len(terms) < 65536 else at, kind="stable")
            at, place = at[order], place[order]
        present, sizes = np.unique(at, return_counts=True)
        ids = part.column("id")
        return pa.record_batch(
            {
                "doc_id": pa.array([ids.fill_null(0).to_pylist()], pa.list_(pa.int64())),
                "no_id": pa.array([ids.is_null().to_pylist()], pa.list_(pa.bool_())),
                "bounds": list_column([found.bounds], pa.int32()),
                "terms": list_column([present], pa.int32()),
                "sizes": list_column([sizes], pa.int32()),
                "positions": list_column([place], pa.int32()),
            }
        )

    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return stored(docs.mapInArrow(by_chunk(index, "text"), _INDEX), "postings")


def find(index: DataFrame, queries: Queries, slop: int = 0) -> DataFrame:
    """Documents with the benchmark windows that occur in them.

    Returns a row per indexed document: ``(doc_id, n_words, n_hit, item_ids, hit_spans)``: words inside
    any occurrence, the items with an occurring window, and the maximal runs of hit words
    ``(start, end)``, end exclusive. ``slop`` 0 asks for exact phrases; with more, every further word may stand up to
    ``slop`` places from where the phrase would have it (a proximity match).
    """
    used = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x")).groupBy("x.terms").agg(F.sum("x.sizes"))
    frequency = np.zeros(len(queries.terms) + 1, np.int64)
    for term, n in used.collect():  # a row per benchmark term at most
        frequency[term] = n
    frequency[-1] = np.iinfo(np.int64).max  # places beyond a short window come last
    rarest_first = np.argsort(frequency[queries.windows], axis=1, kind="stable").astype(np.int16)
    sent = index.sparkSession.sparkContext.broadcast((fields_of(queries), rarest_first))

    def answer(batches):
        fields, rarest_first = sent.value
        queries = Queries(*fields)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in batch.schema.names}
                yield _answer(row, queries, rarest_first, slop)

    spans = "array<struct<start:int,end:int>>"
    return index.mapInArrow(
        answer, f"doc_id long, n_words long, n_hit long, item_ids array<long>, hit_spans {spans}"
    )


def _occurrences(row: dict, queries: Queries, rarest_first: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur in one index row, and the word where each occurrence begins."""
    terms, sizes = row["terms"].astype(np.int64), row["sizes"].astype(np.int64)
    postings = (np.repeat(terms, sizes) << 32) | row["positions"].astype(np.int64)
    starts = np.zeros(len(queries.terms) + 1, np.int64)
    present = np.zeros(len(queries.terms) + 1, bool)
    count = np.zeros(len(queries.terms) + 1, np.int64)
    starts[terms] = np.cumsum(sizes) - sizes
    count[terms] = sizes
    present[terms] = True
    present[-1] = True
    window = np.flatnonzero(present[queries.windows].all(1))
    none = np.zeros(0, np.int64)
    if not len(window):
        return none, none
    offset = rarest_first[window, 0].astype(np.int64)
    term = queries.windows[window, offset]
    many = count[term]
    window = np.repeat(window, many)
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin = (postings[np.repeat(starts[term], many) + within] & 0xFFFFFFFF) - np.repeat(offset, many)
    bounds = row["bounds"].astype(np.int64)
    end = begin + queries.lengths[window]
    doc = np.searchsorted(bounds, begin, "right") - 1
    keep = (begin >= 0) & (end <= bounds[np.minimum(doc + 1, len(bounds) - 1)])
    window, begin = window[keep], begin[keep]
    for step in range(1, rarest_first.shape[1]):
        if not len(window):
            break
        offset = rarest_first[window, step].astype(np.int64)
        term = queries.windows[window, offset].astype(np.int64)
        low = (term << 32) | np.maximum(begin + offset - slop, 0)
        at = np.searchsorted(postings, low)
        at[at == len(postings)] = 0
        met = (postings[at] >= low) & (postings[at] <= low + 2 * slop)
        met |= term < 0
        window, begin = window[met], begin[met]
    return window, begin


def _answer(row: dict, queries: Queries, rarest_first: np.ndarray, slop: int) -> pa.RecordBatch:
    bounds = row["bounds"].astype(np.int64)
    docs, total = len(bounds) - 1, int(bounds[-1])
    window, begin = _occurrences(row, queries, rarest_first, slop)
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + queries.lengths[window], -1)
    hit = np.cumsum(step[:-1]) > 0
    before = np.append(0, np.cumsum(hit))
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    inner = bounds[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < total)])
    inner = inner[hit[inner] & hit[inner - 1]]  # a run never goes on in the next document
    run_start = np.sort(np.append(np.flatnonzero(edge == 1), inner))
    run_end = np.sort(np.append(np.flatnonzero(edge == -1), inner))
    run_doc = np.searchsorted(bounds, run_start, "right") - 1
    items: list[set] = [set() for _ in range(docs)]
    for d, w in np.unique(np.stack([np.searchsorted(bounds, begin, "right") - 1, window], 1), axis=0).tolist():
        items[d].update(queries.items[queries.item_at[w] : queries.item_at[w + 1]].tolist())
    spans: list[list] = [[] for _ in range(docs)]
    for d, s, e in zip(run_doc.tolist(), run_start.tolist(), run_end.tolist()):
        spans[d].append({"start": s - int(bounds[d]), "end": e - int(bounds[d])})
    return pa.record_batch(
        {
            "doc_id": pa.array(row["doc_id"], pa.int64(), mask=row["no_id"].astype(bool)),
            "n_words": np.diff(bounds),
            "n_hit": before[bounds[1:]] - before[bounds[:-1]],
            "item_ids": pa.array([sorted(i) for i in items], pa.list_(pa.int64())),
            "hit_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        }
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 13, slop: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What each document holds of a benchmark, by windows of ``width`` words.

    Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased. Returns a row per
    input row: ``(id, n_words, n_hit, item_ids, hit_spans, contaminated)``; ``contaminated`` says that
    words were hit, at least one in twenty.

    A null or empty text has no words and is not contaminated. Rows with a null or repeated id are
    searched like any other. An empty benchmark hits nothing; an empty table gives an empty table.
    Other columns of either table are not read.
    """
    queries = item_windows(benchmark, width)
    found = find(build_index(docs, queries.terms, id, text), queries, slop)
    return found.withColumnRenamed("doc_id", id).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )
