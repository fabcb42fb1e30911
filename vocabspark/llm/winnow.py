"""Document fingerprints by winnowing, in DataFrame functions alone.

Grams are runs of ``GRAM`` tokens; a token is a run of characters without white space, in lower case,
or a single character beyond U+2E7F (scripts without spaces). Of every window of ``WINDOW``
consecutive grams the smallest hash is kept, the rightmost of equal ones, with its position. So two
texts that share ``GRAM + WINDOW - 1`` consecutive tokens share a fingerprint entry, and the positions say where.

Hashes and positions are packed in one long (31 bits of hash, then the complement of the
position), so one minimum settles both the hash and the tie. Window minima come from
doubling: minima of 2, 4, 8 grams, each from two minima of half the width.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import stored
from vocabspark.operators.order import with_running_index

GRAM = 3
WINDOW = 8  # a power of two

_TOKEN = r"[^\s\x{2E80}-\x{10FFFF}]+|[\x{2E80}-\x{10FFFF}]"
_LAST = (1 << 32) - 1


def with_winnow(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the packed fingerprint entries of a text in order of position.

    A null or blank text has none. A text of fewer tokens than a gram is one gram; one of fewer
    grams than a window is one window. Every step is a column of its own, so that a step's array is
    computed once and then read by position.
    """
    tokens, grams = f"{name}_tokens", f"{name}_grams"
    hashed = F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    df = df.withColumn(tokens, hashed)
    count = F.greatest(F.size(tokens) - (GRAM - 1), F.lit(1))

    def gram(x: Column, i: Column) -> Column:
        whole = F.xxhash64(x, *(F.get(F.col(tokens), i + j) for j in range(1, GRAM)))
        high = F.shiftleft(F.shiftrightunsigned(whole, 33), 32)
        return high.bitwiseOR(F.lit(_LAST) - i)

    df = df.withColumn(grams, F.slice(F.transform(tokens, gram), 1, count))
    width = 1
    while width < WINDOW:
        wider = f"{name}_{2 * width}"
        last = grams if width == 1 else f"{name}_{width}"
        df = df.withColumn(wider, F.transform(last, _lesser_of_two(last, width)))
        width *= 2
    windows = F.greatest(F.size(grams) - (WINDOW - 1), F.lit(1))
    minima = F.array_distinct(F.slice(F.col(f"{name}_{WINDOW}"), 1, windows))
    df = df.withColumn(name, minima)
    steps, width = [tokens, grams], 2
    while width <= WINDOW:
        steps.append(f"{name}_{width}")
        width *= 2
    return df.drop(*steps)


def _lesser_of_two(name: str, apart: int):
    """The lesser of an element and the one that many places on; nulls beyond the end do not count."""
    return lambda x, i: F.least(x, F.get(F.col(name), i + apart))


def hashes(entries: Column) -> Column:
    """Distinct hashes of packed entries."""
    return F.array_distinct(F.transform(entries, lambda p: F.shiftright(p, 32).cast("int")))


def written(entries: Column) -> Column:
    """Entries as text: ``hash@position``, comma-joined; the hash is hexadecimal."""
    return F.array_join(
        F.transform(entries, lambda p: F.concat(F.hex(F.shiftright(p, 32)), F.lit("@"), (F.lit(_LAST) - p.bitwiseAND(F.lit(_LAST))).cast("string"))),
        ",",
    )


def likeness(x: Column, y: Column) -> Column:
    """Jaccard similarity of two hash sets; of two empty ones 1."""
    shared = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, entries, fingerprint)`` for every row; narrow. Null and blank texts have no entries."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    rows = with_winnow(rows, "_text", "_entries")
    return rows.select(F.col("_id").alias(id), F.col("_entries").alias("entries"), written(F.col("_entries")).alias("fingerprint"))


def against_next(docs: DataFrame, id: str = "doc_id", text: str = "text", part: int = 4) -> DataFrame:
    """Fingerprints of each document, of an edited text of it, and how like they and the next one's are.

    The edited text has the last ``n_chars / part`` characters (rounded down) replaced by the first as many, or all,
    of the next document in ascending order of id (after the last: the first). Returns ``(id, n_chars,
    edited, fingerprint, edited_fingerprint, near_edited, near_next)``, a row per input row.

    A null text is empty. A null id comes first. Rows that repeat an id are ordered by a hash of
    their text; rows that repeat both are one document in the order, and each gets its result. A
    single document is its own next one. Other columns are not read; an empty table gives an empty table.

    The order is settled on ids alone. The text is shuffled once, by id; of the next document only
    the needed beginning and the hash set travel.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(body).alias("mark"), body.alias("text"))
    every = stored(rows.select("id", "mark", F.floor(F.length("text") / part).cast("int").alias("need")), "ids")
    unique = stored(every.distinct(), "distinct-ids")
    total = unique.count()
    repeated = every.count() > total
    order = with_running_index(unique, ["id", "mark"], "place")
    order = stored(order, "order") if total else order
    before = order.select(
        ((F.col("place") + 1) % F.lit(max(total, 1))).alias("place"), "need", F.col("id").alias("to_id"), F.col("mark").alias("to_mark")
    )
    needs = before.join(order.select("place", "id", "mark"), "place").select(
        F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), "need", "to_id", "to_mark"
    )
    same = F.col("id").eqNullSafe(F.col("next_id")) & (F.col("mark") == F.col("next_mark"))
    ahead = rows.join(needs.hint("shuffle_hash"), same).select("to_id", "to_mark", "need", F.col("text").alias("next"))
    ahead = with_winnow(ahead, "next", "entries").select(
        "to_id", "to_mark", F.substring("next", F.lit(1), F.col("need")).alias("head"), hashes(F.col("entries")).alias("next_set")
    )
    if repeated:
        ahead = ahead.dropDuplicates(["to_id", "to_mark"])
    same = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("mark") == F.col("to_mark"))
    full = rows.join(ahead.hint("shuffle_hash"), same).withColumn("n_chars", F.length("text"))
    kept = F.substring("text", F.lit(1), F.col("n_chars") - F.floor(F.col("n_chars") / part).cast("int"))
    full = full.select("id", "text", "n_chars", F.concat(kept, "head").alias("edited"), "next_set")
    full = with_winnow(with_winnow(full, "text", "own"), "edited", "new")
    full = full.select("id", "n_chars", "edited", "own", "new", "next_set", hashes(F.col("own")).alias("own_set"))
    return full.select(
        F.col("id").alias(id),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), hashes(F.col("new"))).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
    )
