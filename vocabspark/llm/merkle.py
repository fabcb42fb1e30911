"""Merkle manifest of a table: one tree per key, their roots under one root, a proof for each row.

A node's digest is the lower-case hex SHA-256 of its children's digests, written one after the
other as text. A *slot pivot* makes the tree: the nodes of one level are grouped by parent, and
one conditional aggregate per slot spreads the children over ``FANOUT`` columns. Concatenating the
columns hashes the parent; leaving out a child's own column gives its siblings. On the way down a
parent hands each child those siblings in front of its own path, so a row's proof needs no
join of its own: the last step unfolds the parents of the leaves.

Work that a hot key cannot skew: rows are numbered over range partitions of the order (key, id,
leaf), a tree's parents are grouped by (tree, place), never by tree, and what a row must know of its
key comes by a join on (block of rows, key).

Defined cases. Null is a key of its own, before all others; keys order bytewise. Null ids come first
in their tree and are never tampered with; rows equal in key and id order by leaf, and equal
rows get places of their own. An empty text is ``0:``, a null one ``-``. An empty table gives no rows.
Other columns of the table are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import stored
from vocabspark.operators.order import with_running_index

FANOUT = 8
# Rows that share one join key when rows learn of their tree.
BLOCK_ROWS = 100_000
PATH = "array<struct<before:string,after:string>>"
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its UTF-8 length before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``tree`` (a number, ascending with the key), ``place`` in it and ``size``, its leaves."""
    index = with_running_index(rows, ["key", "node"], "index")
    index = index.withColumn("block", F.floor(F.col("index") / BLOCK_ROWS))
    blocks = index.groupBy("block", "key").agg(F.min("index").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = blocks.groupBy(F.col("key").alias("of")).agg(F.min("first").alias("tree"), F.sum("n").alias("size"))
    known = blocks.join(trees, F.col("key").eqNullSafe(F.col("of")))
    known = known.select(F.col("block").alias("at"), "of", "tree", "size")
    joined = index.join(known, (F.col("block") == F.col("at")) & F.col("key").eqNullSafe(F.col("of")))
    return joined.select("tree", (F.col("index") - F.col("tree")).alias("place"), "size", "node")


SLOTS = [f"c{i}" for i in range(FANOUT)]


def _parents(nodes: DataFrame) -> DataFrame:
    """One row per parent, the child of each slot in a column of its own, and the parent's digest.

    The only node of a tree stays as it is.
    """
    slot = F.col("place") % FANOUT
    spread = [F.max(F.when(slot == i, F.col("node"))).alias(name) for i, name in enumerate(SLOTS)]
    pivoted = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place"), "size").agg(*spread)
    every = F.concat_ws("", *(F.col(name)["digest"] for name in SLOTS))
    alone = F.col("size") == 1
    return pivoted.withColumn("digest", F.when(alone, F.col("c0")["digest"]).otherwise(F.sha2(every, 256)))


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """Tables of parents, lowest first, until each tree is one node; each is written once.

    ``size`` is the number of nodes that the tree has on the level of the slots.
    """
    most = leaves.agg(F.max("size")).first()[0] or 0
    out = [stored(_parents(leaves), "merkle")]
    while (most := -(-most // FANOUT)) > 1:
        size = F.ceil(F.col("size") / FANOUT).alias("size")
        below = out[-1].select("tree", "place", size, F.struct("digest").alias("node"))
        out.append(stored(_parents(below), "merkle"))
    return out


def _children(parents: DataFrame) -> DataFrame:
    """The children in the slots of each parent, with their path to the root.

    A step of a path is the digests before and after the node's own, each as one text. A node that
    stands for its whole tree has no step there.
    """
    digests = [F.col(name)["digest"] for name in SLOTS]

    def child(i: int) -> Column:
        step = F.struct(
            F.concat_ws("", *digests[:i]).alias("before"), F.concat_ws("", *digests[i + 1 :]).alias("after")
        )
        path = F.when(F.col("size") == 1, F.col("path")).otherwise(F.concat(F.array(step), F.col("path")))
        place = F.col("place") * FANOUT + i
        return F.struct(place.alias("place"), F.col(SLOTS[i]).alias("node"), path.alias("path"))

    each = F.filter(F.array(*map(child, range(FANOUT))), lambda c: c["node"].isNotNull())
    return parents.select("tree", "roots", F.inline(each))


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Every leaf's ``node`` with its ``path`` and the ``roots`` that ``tops`` has for its tree."""
    found = tops.withColumn("place", F.lit(0).cast("long"))
    for depth in range(len(levels) - 1, -1, -1):
        above = levels[depth].join(found, ["tree", "place"])
        found = _children(above)
        if depth:
            found = found.drop("node")
    return found


def manifest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``subroot``, ``root`` and ``path``; ``rows`` hold their leaf in ``digest``.

    All columns must be orderable; the whole row settles ties of ``order``.
    """
    first = [*order, "digest"]
    node = F.struct(*first, *(name for name in rows.columns if name not in first))
    leaves = stored(rows.select(F.col(key).alias("key"), node.alias("node")), "merkle")
    trees = _levels(_placed(leaves))
    subroots = trees[-1].select(F.lit(0).alias("key"), F.struct("tree", "digest").alias("node"))
    over = _levels(_placed(subroots))
    root = over[-1].select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("roots"))
    tops = _paths(over, root).select(
        F.col("node")["tree"].alias("tree"),
        "path",
        F.struct(F.col("node")["digest"].alias("subroot"), F.col("roots").alias("root")).alias("roots"),
    )
    return _paths(trees, tops).select("node.*", "roots.*", "path")


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings give."""
    return F.aggregate(path, digest, lambda own, s: F.sha2(F.concat(s["before"], own, s["after"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings on a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)
