"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct word shingles (the tokens). Two documents link when the
Jaccard similarity of their sets reaches a threshold. Tokens are ordered: rare ones first, then
classes of frequent ones by rising frequency. Of a set of ``n`` tokens a linked set holds at least
``a = ceil(t * n)``, so the first ``n - a + 1`` tokens of either set hold their first common token, and
the first ``n - a + 2`` tokens of either set hold their first two. If the first common token is rare,
it is found as a single index key. If it is frequent, so is the second (the order puts rare tokens
first), and the pair of both is found as a combined key: a passage that thousands of documents
share then indexes only those whose prefixes share two such tokens. Candidates must then share enough
tokens of prefixes that are extended further, and what is left is verified on whole sets.

Combinations grow with the square of the prefix, so sets above ``COMBINED_UP_TO`` tokens index
frequent tokens singly; sets a little smaller, which may link with those, index both ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocabspark.llm import links as li
from vocabspark.llm.components import components
from vocabspark.llm.tables import by_chunk, sieved, stored, tidied
from vocabspark.llm.words import chunks, list_column, mix, shingle_sets, signed, words_of

# Sets of up to so many tokens index pairs of frequent tokens.
COMBINED_UP_TO = 512
# Rows of the table of frequent tokens that goes to every task: 9 bytes each.
FREQUENT_ROWS = 1 << 21
# Tokens of this class on (a count of 32, as a lower bound, see frequent_tokens) are indexed in combinations.
COMBINED_CLASS = 5
# Tokens a task holds before it counts them.
_HELD = 4 << 20


def frequent_tokens(docs: DataFrame, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated tokens (sorted) and their classes 1, 2, ...: the whole logarithms of their counts.

    Every document is counted, a few million tokens at a time; a token that occurs once in such a
    block does not count there, so a count is a lower bound and the shuffle holds repeated tokens only. Any
    one table gives the same links, since it only orders the tokens; of more than
    ``FREQUENT_ROWS`` tokens the most frequent are taken, so what is broadcast stays bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            keep = seen > 1
            return pa.record_batch({"token": signed(token[keep]), "seen": seen[keep].astype(np.int64)})

        for batch in batches:
            for part in chunks(batch, text):
                sets = shingle_sets(words_of(part.column(text)), k)
                held += sets
                size += sum(map(len, sets))
                if size > _HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    counts = docs.select(text).mapInArrow(tidied(count), "token long, seen long")
    counts = stored(counts.groupBy("token").agg(F.sum("seen").alias("seen")), "frequent")
    classes = counts.withColumn("class", F.floor(F.log2(F.col("seen").cast("double"))).cast("int"))
    sizes = sorted(((r[0], r[1]) for r in classes.groupBy("class").count().collect()), reverse=True)
    least, rows = 64, 0
    for cls, n in sizes:
        if rows + n > FREQUENT_ROWS:
            break
        least, rows = cls, rows + n
    table = classes.where(F.col("class") >= least).select("token", "class").toArrow()
    token = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], table["class"].to_numpy().astype(np.uint8)[order]


def index_keys(tokens: np.ndarray, classes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Index keys of one set: rare prefix tokens, and combinations of frequent ones.

    ``tokens`` are sorted. A set of one token can only be linked with an equal set, and needs no key.
    """
    n = len(tokens)
    if n < 2:
        return np.zeros(0, np.uint64)
    order = np.argsort(classes, kind="stable")
    prefix = n + (-num * n // den) + 1  # n - ceil(n * num / den) + 1
    rare = int(np.count_nonzero(classes < COMBINED_CLASS))
    keys = [tokens[order[: min(prefix, rare)]]]
    often = tokens[order[rare : prefix + 1]]
    heads = max(0, prefix - rare)  # frequent tokens inside the shorter prefix
    if heads:
        if n <= COMBINED_UP_TO:
            i, j = np.triu_indices(len(often), 1)
            keep = i < heads
            keys.append(mix(often[i[keep]] * np.uint64(3) + mix(often[j[keep]])))
        if den * n >= num * COMBINED_UP_TO:
            keys.append(mix(often[:heads] ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(keys)


def probe_of(tokens: np.ndarray, classes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """A longer prefix, 32 bits a token, and how many of its tokens a linked set's probe shares at least.

    If the prefix of a set is extended by ``l - 1`` tokens, it holds the first ``l`` tokens that a
    linked set shares with it; so two probes share the lesser of their ``l``. Tokens that equal another
    in 32 bits are listed once and not counted on.
    """
    n = len(tokens)
    prefix = n + (-num * n // den) + 1
    extra = min(max(1, n // 10), n - prefix + 1)
    order = np.argsort(classes, kind="stable")[: prefix + extra - 1]
    short = np.unique((tokens[order] >> np.uint64(32)).astype(np.uint32))
    return short.view(np.int32), max(0, extra - (len(order) - len(short)))


def set_digest(tokens: np.ndarray) -> int:
    """One number for a whole set: equal sets have equal ones."""
    if not len(tokens):
        return 0
    salted = mix(tokens + np.uint64(len(tokens)))
    parts = np.array([np.bitwise_xor.reduce(salted), salted.sum(dtype=np.uint64)], np.uint64)
    return int(mix(parts[:1] * np.uint64(5) + mix(parts[1:])).view(np.int64)[0])


def join(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Similarity self-join of documents on ``k``-word shingles at Jaccard ``num / den``, and its classes.

    Returns one row per input row: ``(id, n_shingles, component_id, n_links)``. ``component_id`` is the
    smallest id reachable by links (its own if there are none); ``n_links`` counts the documents
    that its set links with, copies included.

    Equal sets are one class: one member stands for it, so copies are never paired. A null or
    empty text, or one without words, has no shingles and links with nothing. Rows with a null id
    keep their row, link with nothing and have a null component. Rows that repeat an id and a set
    are one document; rows that repeat an id with another set are documents of their own that share
    the id. Other columns of ``docs`` are not read. An empty table gives an empty table.
    """
    rows, classes, edges, degrees = linked_classes(docs, k, num, den, id, text)
    reps = classes.select(F.col("digest"), F.col("rep"))
    linked = edges.join(reps.select(F.col("digest").alias("a"), F.col("rep").alias("rep_a")), "a")
    linked = linked.join(reps.select(F.col("digest").alias("b"), F.col("rep").alias("rep_b")), "b")
    found = components(linked.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    classes = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.join(degrees.withColumnRenamed("id", "digest"), "digest", "left").select(
        "digest",
        F.coalesce("component", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )
    joined = rows.join(classes, "digest", "left")
    alone = F.col("id").isNull() | F.col("component_id").isNull()
    return joined.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )


def linked_classes(docs: DataFrame, k: int, num: int, den: int, id: str, text: str) -> tuple[DataFrame, ...]:
    """Rows with their class, classes, links between classes, and documents linked with a class."""
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(frequent_tokens(docs, "text", k))

    def index(part: pa.RecordBatch) -> pa.RecordBatch:
        frequent, cls = table.value
        sets = shingle_sets(words_of(part.column("text")), k)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets)
        classes = np.zeros(len(flat), np.uint8)
        if len(frequent):
            at = np.searchsorted(frequent, flat)
            at[at == len(frequent)] = 0
            known = frequent[at] == flat
            classes[known] = cls[at[known]]
        ends = np.cumsum(sizes)
        keys = [
            signed(index_keys(tokens, classes[s:e], num, den))
            for tokens, s, e in zip(sets, (ends - sizes).tolist(), ends.tolist())
        ]
        digest = pa.array([set_digest(tokens) for tokens in sets], pa.int64())
        probes = [
            probe_of(tokens, classes[s:e], num, den) if e > s else (np.zeros(0, np.int32), 0)
            for tokens, s, e in zip(sets, (ends - sizes).tolist(), ends.tolist())
        ]
        return pa.record_batch(
            {
                "id": part.column("id"),
                "n": sizes,
                "digest": digest,
                "keys": list_column(keys, pa.int64()),
                "probe": list_column([p for p, _ in probes], pa.int32()),
                "least": np.array([least for _, least in probes], np.int32),
            }
        )

    rows = docs.mapInArrow(
        by_chunk(index, "text"), "id long, n long, digest long, keys array<long>, probe array<int>, least int"
    )
    rows = stored(rows, "index")
    present = rows.where("n > 0 and id is not null")
    classes = present.groupBy("digest").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies"))
    classes = stored(classes, "classes")
    # Rows of one class have the same keys and probes.
    keys = present.select(F.explode("keys").alias("key"), F.col("digest").alias("id"), "n")
    probes = present.select(F.col("digest").alias("id"), "probe", "least")

    def tokens_of(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(words_of(part.column("text")), k)
        wanted = part.column("digest").to_pylist()
        keep = [r for r, tokens in enumerate(sets) if set_digest(tokens) == wanted[r]]
        taken = part.take(pa.array(keep, pa.int64()))
        sets = [sets[r] for r in keep]
        return pa.record_batch(
            {
                "id": taken.column("digest"),
                "n": np.fromiter(map(len, sets), np.int64, len(sets)),
                "weight": taken.column("copies"),
                "tokens": list_column([signed(s) for s in sets], pa.int64()),
            }
        )

    def fetch(wanted: DataFrame) -> DataFrame:
        chosen = classes.join(wanted.withColumnRenamed("id", "digest"), "digest")
        chosen = chosen.select(F.col("rep").alias("id"), "digest", "copies")
        chosen = stored(chosen, "chosen")
        some = sieved(docs, "id", chosen.select("id"))
        texts = some.join(chosen.hint("shuffle_hash"), "id").select("digest", "copies", "text")
        sets = texts.mapInArrow(by_chunk(tokens_of, "text"), "id long, n long, weight long, tokens array<long>")
        repeated = present.groupBy("digest", "id").count().where("count > 1")
        return sets if repeated.isEmpty() else sets.dropDuplicates(["id"])

    edges, degrees = li.links(keys, fetch, num, den, probes)
    return rows, classes, edges, degrees
