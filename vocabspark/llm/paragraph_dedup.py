"""Substring dedup: repeated paragraphs and passages, by MinHash banding of paragraphs.

Units are the lines of a text (paragraphs) and, since a repeated passage often stands in the middle of
a line, the passages that a line is cut into at content-defined places: before a word whose hash is
the smallest among its ``RADIUS`` neighbours on either side. Such cuts move with the text, so two lines that share a
passage cut it at the same words.

Paragraphs are sets of word shingles. Each class of equal sets gets MinHash keys in bands; classes
that collide in a band are compared by exact Jaccard similarity, and links are clustered by components.
Passages are compared by equality. In each cluster the first unit, by document and place,
stays; the others are removals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.llm import links as li
from vocabspark.llm.components import components
from vocabspark.llm.ngram_join import set_digest
from vocabspark.llm.tables import by_chunk, stored
from vocabspark.llm.words import grams, list_column, mix, signed, text_buffer, words_of

SHINGLE = 5
# Rows of a band, and the share of pairs at the threshold that may be missed.
BAND_ROWS = 2
MISSED = 1e-3
RADIUS = 6

LINE, PASSAGE = 0, 1
_UNIT = "doc long, kind int, start int, end int, n_words int, n long, digest long, keys array<long>"


def bands_for(similarity: float, rows: int = BAND_ROWS, missed: float = MISSED) -> int:
    """Fewest bands of ``rows`` hashes by which pairs at the threshold are missed no more often than ``missed``."""
    return int(np.ceil(np.log(missed) / np.log1p(-(similarity**rows))))


def band_keys(shingles: np.ndarray, bounds: np.ndarray, bands: int) -> np.ndarray:
    """MinHash band keys, one row per set; sets lie one after another and are not empty."""
    out = np.empty((len(bounds) - 1, bands), np.uint64)
    for band in range(bands):
        key = np.full(len(bounds) - 1, band + 1, np.uint64)
        for row in range(BAND_ROWS):
            salt = np.uint64((band * BAND_ROWS + row + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))
            key = mix(key * np.uint64(31) + np.minimum.reduceat(mix(shingles ^ salt), bounds[:-1]))
        out[:, band] = key
    return out


def line_bounds(column: pa.Array):
    """Words of texts and where their lines begin: ``(words, bounds, doc of each line)``."""
    data, _ = text_buffer(column)
    found = words_of(column)
    doc = found.docs()
    line = np.searchsorted(np.flatnonzero(data == 0x0A), found.starts) + doc
    bounds = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
    return found, np.append(bounds, len(line)), doc[bounds] if len(line) else bounds


def passage_starts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words that begin a passage: line starts and content-defined cuts inside lines."""
    n = len(hashes)
    if not n:
        return bounds[:-1]
    order = (mix(hashes) & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    line = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    least = np.ones(n, bool)
    for j in range(1, RADIUS + 1):
        least[:-j] &= order[:-j] <= order[j:]
        least[j:] &= order[j:] <= order[:-j]
    inside = np.zeros(n, bool)
    if n > 2 * RADIUS:
        inside[RADIUS:-RADIUS] = line[: -2 * RADIUS] == line[2 * RADIUS :]
    return np.union1d(bounds[:-1], np.flatnonzero(least & inside))


def _line_sets(found, bounds: np.ndarray, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lines that have a shingle, and their sorted distinct shingles."""
    every = grams(found.hashes, k)
    chosen = np.flatnonzero(np.diff(bounds) >= k)
    sets = [np.unique(every[bounds[i] : bounds[i + 1] - k + 1]) for i in chosen.tolist()]
    return chosen, sets


def units(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """All paragraphs of at least ``k`` words and all passages, with digests; paragraphs with band keys."""
    bands = bands_for(similarity)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        column = part.column("text")
        data, offsets = text_buffer(column)
        found, bounds, doc = line_bounds(column)
        chosen, sets = _line_sets(found, bounds, k)
        starts = passage_starts(found.hashes, bounds)
        ends = np.append(starts[1:], len(found.hashes))
        whole = np.isin(starts, bounds[:-1]) & np.isin(ends, bounds[1:])
        kept = ~whole & (ends - starts > RADIUS)
        starts, ends = starts[kept], ends[kept]
        keys = [np.zeros(0, np.int64)] * (len(chosen) + len(starts))
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        if len(sets):
            made = signed(band_keys(np.concatenate(sets), np.append(0, np.cumsum(sizes)), bands))
            for i in np.flatnonzero(sizes * (1 - similarity) >= similarity - 1e-9).tolist():
                keys[i] = made[i]  # smaller sets are only like equal ones
        digest = [set_digest(s) for s in sets]
        passage = _run_digests(found.hashes, starts, ends)
        first = np.concatenate([bounds[chosen], starts])
        last = np.concatenate([bounds[chosen + 1], ends]) - 1
        owner = np.concatenate([doc[chosen], found.docs()[starts]]) if len(first) else first
        chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        base = chars[offsets[owner]]
        return pa.record_batch(
            {
                "doc": part.column("doc").take(pa.array(owner)),
                "kind": np.repeat(np.array([LINE, PASSAGE], np.int32), [len(chosen), len(starts)]),
                "start": (chars[found.starts[first]] - base).astype(np.int32),
                "end": (chars[found.ends[last]] - base).astype(np.int32),
                "n_words": (last - first + 1).astype(np.int32),
                "n": np.concatenate([sizes, ends - starts]),
                "digest": np.concatenate([np.array(digest, np.int64), signed(passage)]),
                "keys": list_column(keys, pa.int64()),
            }
        )

    return docs.mapInArrow(by_chunk(cut, "text"), _UNIT)


def _run_digests(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of words."""
    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    for j in range(int(size.max()) if len(size) else 0):
        live = np.flatnonzero(size > j)
        out[live] = mix(out[live] * np.uint64(0x9E3779B97F4A7C15) + hashes[starts[live] + j])
    return mix(out + size.astype(np.uint64))


def repeats(docs: DataFrame, k: int = SHINGLE, num: int = 8, den: int = 10, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Units that occur more than once: ``(id, kind, start, end, n_words, cluster, kept_id, removed)``.

    ``kind`` is ``line`` or ``passage``; ``start`` and ``end`` are code points of the text, end exclusive. ``kept_id`` is the
    document whose unit stays; ``removed`` is false for that unit alone. A line is as like
    another as the Jaccard similarity of their sets of ``k``-word shingles, ``num / den`` at least.

    Words are runs without white space, A-Z lower-cased. Lines of fewer than ``k`` words, and
    passages of ``RADIUS`` words or fewer, are no units. Texts that repeat nothing, null or empty ones among them,
    give no rows. Rows with a null id take no part. Equal rows of one id repeat each other at
    the same places and count as one. Other columns are not read; an empty table gives an empty table.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    every = stored(units(docs, k, num / den), "units")
    lines, passages = every.where(F.col("kind") == LINE), every.where(F.col("kind") == PASSAGE)
    one = lines.groupBy("digest").agg(
        F.min("doc").alias("doc"), F.count("*").alias("members"), F.min("n").alias("n"), F.max(F.size("keys")).alias("bands")
    )
    classes = stored(one, "line-classes")
    reps = lines.join(classes.select("digest", "doc"), ["digest", "doc"]).where("size(keys) > 0")
    reps = reps.dropDuplicates(["digest", "doc"])
    keys = reps.select(F.explode("keys").alias("key"), F.col("digest").alias("id"), "n")

    def tokens_of(part: pa.RecordBatch) -> pa.RecordBatch:
        found, bounds, doc = line_bounds(part.column("text"))
        chosen, sets = _line_sets(found, bounds, k)
        asked = [set(d) for d in part.column("digests").to_pylist()]
        out: dict[int, np.ndarray] = {}
        for i, tokens in zip(chosen.tolist(), sets):
            digest = set_digest(tokens)
            if digest in asked[doc[i]]:
                out[digest] = tokens
        return pa.record_batch(
            {
                "id": pa.array(list(out), pa.int64()),
                "n": np.fromiter(map(len, out.values()), np.int64, len(out)),
                "weight": np.ones(len(out), np.int64),
                "tokens": list_column([signed(t) for t in out.values()], pa.int64()),
            }
        )

    def fetch(wanted: DataFrame) -> DataFrame:
        chosen = classes.join(wanted.withColumnRenamed("id", "digest"), "digest").groupBy("doc").agg(F.collect_set("digest").alias("digests"))
        texts = docs.join(chosen.hint("shuffle_hash"), "doc").select("text", "digests")
        sets = texts.mapInArrow(by_chunk(tokens_of, "text"), "id long, n long, weight long, tokens array<long>")
        repeated = docs.groupBy("doc").count().where("count > 1")
        return sets if repeated.isEmpty() else sets.dropDuplicates(["id"])

    edges, _ = li.links(keys, fetch, num, den)
    found = components(edges)
    named = classes.join(found.withColumnRenamed("id", "digest"), "digest", "left").withColumn(
        "cluster", F.coalesce("component", "digest")
    )
    big = named.groupBy("cluster").agg(F.sum("members").alias("size")).where("size > 1")
    named = named.join(big, "cluster").select("digest", "cluster")
    more = passages.groupBy("digest").agg(F.count("*").alias("size")).where("size > 1").select("digest", F.col("digest").alias("cluster"))
    columns = ["cluster", "doc", "kind", "start", "end", "n_words"]
    members = lines.join(named, "digest").select(*columns).unionByName(passages.join(more, "digest").select(*columns))
    members = stored(members.distinct(), "members")
    place = F.struct("doc", "start", "end")
    kept = members.groupBy("kind", "cluster").agg(F.min(place).alias("kept"), F.count("*").alias("size")).where("size > 1")
    return members.join(kept, ["kind", "cluster"]).select(
        F.col("doc").alias(id),
        F.when(F.col("kind") == LINE, "line").otherwise("passage").alias("kind"),
        "start",
        "end",
        "n_words",
        "cluster",
        F.col("kept.doc").alias("kept_id"),
        (place != F.col("kept")).alias("removed"),
    )
