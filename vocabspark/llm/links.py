"""Links between sets that share index keys: verified exactly, also where one key is hot.

``keys(key, id, n)`` says which index keys a set has; two sets that may be linked share one.
Sets of a key with few holders are paired and verified one pair a row. Holders of a hot key (more
than ``HOT`` sets) are never paired: they are gathered in families (components over hot keys), each
family is dealt into blocks of bounded size, and a task compares two blocks by a matrix product.
A task gives back one row per set, not one per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.components import components
from vocabspark.llm.tables import freed, sieved, stored

# A key with more holders than this is hot. Pairs made from other keys are at most 16 a key holder.
HOT = 32
# Tokens of one block of a hot family; a task holds two.
BLOCK_TOKENS = 200_000
BLOCK_SETS = 512


def linked_sizes(overlap: Column, n: Column, m: Column, num: int, den: int) -> Column:
    """Whether ``overlap / union >= num / den``, in whole numbers."""
    return F.lit(den) * overlap >= F.lit(num) * (n + m - overlap)


def near_sizes(n: Column, m: Column, num: int, den: int) -> Column:
    """Sizes that allow a link at all."""
    return F.lit(den) * F.least(n, m) >= F.lit(num) * F.greatest(n, m)


def links(
    keys: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    num: int,
    den: int,
    probes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links at Jaccard ``num / den`` or more among distinct sets.

    ``keys(key long, id long, n long)``, where rows may be repeated; ``fetch(ids(id))`` returns ``(id, n, weight, tokens)`` of
    those sets, tokens sorted. ``probes(id, probe array, least)`` may rule pairs out before their sets are
    fetched: linked sets share the lesser ``least`` elements of their probes; rows may be repeated there, too. Returns ``edges(a, b)``, enough of them to connect whatever is linked,
    and ``degrees(id, n_links)``, the weights of all sets linked with a set.
    """
    # Most keys have one holder: their rows go no further than their count. Equal rows are one holder.
    again = stored(keys.groupBy("key").count().where("count > 1").select("key"), "repeated")
    repeated = stored(sieved(keys, "key", again).join(again, "key").distinct(), "holders")
    held = repeated.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = stored(repeated.join(held, "key"), "keys")
    few = shared.where(F.col("holders") <= HOT)
    hot = shared.where(F.col("holders") > HOT)

    hubs = hot.groupBy("key").agg(F.min("id").alias("b"))
    family = components(hot.select("key", F.col("id").alias("a")).join(hubs, "key").select("a", "b"))
    family = stored(family.withColumnRenamed("component", "family"), "family")

    x = few.select("key", F.col("id").alias("a"), F.col("n").alias("n_a"))
    y = few.select("key", F.col("id").alias("b"), F.col("n").alias("n_b"))
    pairs = x.join(y, "key").where("a < b").where(near_sizes(F.col("n_a"), F.col("n_b"), num, den))
    pairs = pairs.select("a", "b").distinct()
    own = family.select(F.col("id").alias("a"), F.col("family").alias("f_a"))
    other = family.select(F.col("id").alias("b"), F.col("family").alias("f_b"))
    pairs = pairs.join(own, "a", "left").join(other, "b", "left")
    pairs = pairs.where("f_a is null or f_b is null or f_a <> f_b").select("a", "b")
    if probes is not None:
        pairs = stored(pairs, "met")
        met = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
        probes = sieved(probes, "id", met).dropDuplicates(["id"])
        own = probes.select(F.col("id").alias("a"), F.col("probe").alias("p_a"), F.col("least").alias("l_a"))
        other = probes.select(F.col("id").alias("b"), F.col("probe").alias("p_b"), F.col("least").alias("l_b"))
        common = F.size(F.array_intersect("p_a", "p_b"))
        pairs = pairs.join(own, "a").join(other, "b").where(common >= F.least("l_a", "l_b")).select("a", "b")
    pairs = stored(pairs, "pairs")

    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = wanted.unionByName(family.select("id")).distinct()
    sets = stored(fetch(wanted), "sets")

    left = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("weight").alias("w_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("weight").alias("w_b"), F.col("tokens").alias("t_b"))
    overlap = F.size(F.array_intersect("t_a", "t_b")).cast("long")
    checked = pairs.join(left, "a").join(right, "b").withColumn("overlap", overlap)
    checked = checked.where(linked_sizes(F.col("overlap"), F.col("n_a"), F.col("n_b"), num, den))
    checked = stored(checked.select("a", "b", "w_a", "w_b"), "links")

    dense = stored(_family_links(family, sets, num, den), "family-links")
    edges = checked.select("a", "b").unionByName(
        dense.where("least < id").select(F.col("id").alias("a"), F.col("least").alias("b"))
    )
    degrees = (
        checked.select(F.col("a").alias("id"), F.col("w_b").alias("w"))
        .unionByName(checked.select(F.col("b").alias("id"), F.col("w_a").alias("w")))
        .unionByName(dense.select("id", F.col("found").alias("w")))
    )
    return edges, degrees.groupBy("id").agg(F.sum("w").alias("n_links"))


def _family_links(family: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside hot families, block by block: ``(id, least, found)``, a row per set and task.

    Sets are dealt by size class (a factor of num / den each) and by hash, so that a block holds
    about ``BLOCK_TOKENS`` tokens or ``BLOCK_SETS`` sets. Only equal or neighbouring classes can be
    linked, so only their blocks meet.
    """
    log = float(np.log(den / num))
    members = sets.join(family, "id").withColumn(
        "class", F.floor(F.ln(F.col("n")) / F.lit(log) + F.lit(1e-9)).cast("int") if num < den else F.lit(0)
    )
    room = members.groupBy("family", "class").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_TOKENS, F.count("*") / BLOCK_SETS)).cast("int").alias("blocks")
    )
    after = room.select("family", (F.col("class") - 1).alias("class"), F.col("blocks").alias("blocks_up"))
    before = room.select("family", (F.col("class") + 1).alias("class"), F.col("blocks").alias("blocks_down"))
    room = room.join(after, ["family", "class"], "left").join(before, ["family", "class"], "left")
    room = room.fillna(0, ["blocks_up", "blocks_down"])
    members = members.join(room, ["family", "class"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def meeting(side, low_class, low, high_class, high):
        return F.struct(
            F.lit(side).alias("side"), low_class.alias("c"), low.alias("i"), high_class.alias("d"), high.alias("j")
        )

    c, block, zero = F.col("class"), F.col("block"), F.lit(0)

    def upto(count):
        return F.sequence(zero, count - 1)

    # With itself and the other blocks of its class, then with those a class up and a class down.
    same = F.transform(
        upto(F.col("blocks")),
        lambda k: F.when(k < block, meeting(1, c, k, c, block)).otherwise(meeting(0, c, block, c, k)),
    )
    nothing = F.array().cast(
        "array<struct<side:int,c:int,i:int,d:int,j:int>>"
    )
    up = F.when(F.col("blocks_up") > 0, F.transform(upto(F.col("blocks_up")), lambda k: meeting(0, c, block, c + 1, k))).otherwise(nothing)
    down = F.when(F.col("blocks_down") > 0, F.transform(upto(F.col("blocks_down")), lambda k: meeting(1, c - 1, k, c, block))).otherwise(nothing)
    dealt = members.select("family", "id", "n", "weight", "tokens", F.explode(F.concat(same, up, down)).alias("m"))
    dealt = dealt.select("family", "m.c", "m.i", "m.d", "m.j", "m.side", "id", "n", "weight", "tokens")

    def compare(table: pa.Table) -> pa.Table:
        return freed(_compare_blocks(table, num, den))

    return dealt.groupBy("family", "c", "i", "d", "j").applyInArrow(compare, "id long, least long, found long")


def _compare_blocks(table: pa.Table, num: int, den: int) -> pa.Table:
    """Links between two blocks, or inside one block that meets itself."""
    side = table["side"].to_numpy()
    ids, n, weight = (table[c].to_numpy() for c in ("id", "n", "weight"))
    tokens = table["tokens"].combine_chunks()
    if isinstance(tokens, pa.ChunkedArray):
        tokens = pa.concat_arrays(tokens.chunks)
    flat, sizes = tokens.flatten().to_numpy(), tokens.value_lengths().to_numpy()
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(second)
    if alone:
        second = first
    owner = np.repeat(np.arange(len(ids)), sizes)
    _, name, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[name] > 1
    name, owner = name[keep], owner[keep]
    _, name = np.unique(name, return_inverse=True)
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    row = np.full(len(ids), -1)
    row[first] = np.arange(len(first))
    col = np.full(len(ids), -1)
    col[second] = np.arange(len(second))
    overlap = np.zeros((len(first), len(second)), np.int64)
    total = int(name[-1]) + 1 if len(name) else 0
    for start in range(0, total, 2048):
        a, b = np.searchsorted(name, (start, start + 2048))
        if a == b:
            continue
        left = np.zeros((len(first), 2048), np.float32)
        right = np.zeros((len(second), 2048), np.float32)
        t, o = name[a:b] - start, owner[a:b]
        on = row[o] >= 0
        left[row[o[on]], t[on]] = 1
        on = col[o] >= 0
        right[col[o[on]], t[on]] = 1
        overlap += np.rint(left @ right.T).astype(np.int64)
    union = n[first][:, None] + n[second][None, :] - overlap
    hit = den * overlap >= num * union
    if alone:
        np.fill_diagonal(hit, False)
    least = ids.copy()
    found = np.zeros(len(ids), np.int64)
    found[first] += hit @ weight[second]
    if not alone:
        found[second] += hit.T @ weight[first]
    linked = np.nonzero(hit)
    one, two = first[linked[0]], second[linked[1]]
    while True:  # smallest member that is reached inside these blocks
        low = np.minimum(least[one], least[two])
        was = least.copy()
        np.minimum.at(least, one, low)
        np.minimum.at(least, two, low)
        if (was == least).all():
            break
    return pa.table({"id": ids, "least": least, "found": found})
