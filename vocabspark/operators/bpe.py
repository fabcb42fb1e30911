"""Learn BPE merges, hundreds of them in a few Spark jobs.

The result is the same as merging the best pair one at a time (count descending, then left, then
right). Words are arrays of symbol numbers. The pair counts are an index that is kept as a table and
brought up to date by the differences that changed words make. A round goes like this:

* The *head*, the ``k`` best pairs of the index, is read off.
* Every word is cut wherever two neighbours are no pair of the head. What is left are *runs*, and equal
  runs of all words are counted together. A run is short, and there are few different ones.
* The merges that come next are found on the counted runs alone. This is exact as long as the best pair is
  more frequent than the last pair of the head: a pair that will be made by a merge stands where two symbols
  stand next to each other now, and if these are no pair of the head, it is no more frequent than they
  are. A merge that makes a symbol which exists already ends the round, since that symbol's neighbours are
  then known by two names.
* The merges are applied to all words in one scan without a shuffle, and the changed words' pairs are taken out
  of the index and put in anew.

How many pairs the head may have follows from how many runs it left in the round before: runs are counted before
they are fetched, and a head with too many of them is made smaller, down to the one best pair, which needs no
runs. So the driver holds a bounded table whatever the corpus. Words that are one symbol are dropped.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.session import checkpoint, keep, task_count

MERGES_SCHEMA = "rank int, left string, right string, token string, n long"
WORDS_PER_TASK = 200_000
# Pairs of the first head, and of the largest one.
FIRST_HEAD, LARGEST_HEAD = 64, 100_000
# Symbols of all runs that the driver may hold: about 100 bytes each.
MOST_RUN_SYMBOLS = 1_000_000
# Different runs that a task remembers.
RUNS_REMEMBERED = 200_000
# Symbols below are code points; merges count on from here.
FIRST_MERGE = 0x110000

Pair = tuple[int, int]


# --- pairs as columns -----------------------------------------------------------------------------


def to_words(counts: DataFrame) -> DataFrame:
    """``(word, n)``: each piece as an array of symbols, one per character at first."""
    return counts.select(F.regexp_extract_all("piece", F.lit("(?s)(.)"), F.lit(1)).alias("word"), "n")


def adjacent(word: Column) -> Column:
    """Array of the ``(l, r)`` neighbours in a word."""
    n = F.greatest(F.size(word) - 1, F.lit(0))
    return F.zip_with(
        F.slice(word, 1, n),
        F.slice(word, 2, n),
        lambda left, right: F.struct(left.alias("l"), right.alias("r")),
    )


def bpe_pair_counts(
    words: DataFrame, min_frequency: int = 0, max_token_length: int = 0
) -> DataFrame:
    """``(l, r, n)``: how often each pair of neighbours stands in the words.

    Pairs are summed inside each task before they are shuffled.
    """
    pairs = words.select(F.inline(adjacent(F.col("word"))), "n")
    pairs = _short_enough(pairs, max_token_length).groupBy("l", "r").agg(F.sum("n").alias("n"))
    return pairs.where(F.col("n") >= min_frequency) if min_frequency > 0 else pairs


def _short_enough(pairs: DataFrame, max_token_length: int) -> DataFrame:
    if max_token_length <= 0:
        return pairs
    return pairs.where(F.length("l") + F.length("r") <= max_token_length)


def merge_pairs(word: Column, batch: Sequence[tuple[str, str]]) -> Column:
    """Join the pairs of a batch, one after another, each from left to right."""
    for left, right in batch:
        word = _merged(word, left, right)
    return word


def _merged(word: Column, left: str, right: str) -> Column:
    def step(done: Column, symbol: Column) -> Column:
        joins = (F.element_at(done, -1) == left) & (symbol == right)
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(head, F.array(F.lit(left + right)))).otherwise(
            F.concat(done, F.array(symbol))
        )

    rest = F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0)))
    return F.when(F.size(word) > 1, F.aggregate(rest, F.slice(word, 1, 1), step)).otherwise(word)


# --- words as arrays of symbol numbers, inside tasks ------------------------------------------------


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a column of words, and where each word begins (one more than words)."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _keys(symbols: np.ndarray) -> np.ndarray:
    """Each symbol and the one after it as one number."""
    return (symbols[:-1].astype(np.int64) << 32) | symbols[1:]


def _inside(offsets: np.ndarray) -> np.ndarray:
    """Whether a symbol and the one after it stand in the same word."""
    same = np.ones(max(int(offsets[-1]) - 1, 0), bool)
    last = offsets[1:-1] - 1
    same[last[(last >= 0) & (last < len(same))]] = False
    return same


def _runs(symbols: np.ndarray, offsets: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest stretches whose neighbours are all pairs of the (sorted) head: begin and end."""
    if len(symbols) < 2:
        none = np.zeros(0, np.int64)
        return none, none
    keys = _keys(symbols)
    at = np.minimum(np.searchsorted(head, keys), len(head) - 1)
    joined = _inside(offsets) & (head[at] == keys)
    edge = np.diff(np.concatenate(([False], joined, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1


def _symbol_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces to words of code points."""
    for batch in batches:
        pieces = batch.column("piece").to_pylist()
        sizes = np.fromiter(map(len, pieces), np.int32, len(pieces))
        offsets = np.zeros(len(pieces) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.int32)
        words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(points))
        yield pa.RecordBatch.from_arrays([words, batch.column("n")], names=["ids", "n"])


def _run_counter(head: np.ndarray):
    """Words to counted runs; a run is its symbols' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, offsets = _flat(batch.column("ids"))
            begins, ends = _runs(symbols, offsets, head)
            n = batch.column("n").to_numpy()[np.searchsorted(offsets, begins, "right") - 1]
            counted: dict[bytes, int] = defaultdict(int)
            for begin, end, weight in zip(begins.tolist(), ends.tolist(), n.tolist()):
                counted[symbols[begin:end].tobytes()] += weight
            yield pa.RecordBatch.from_pydict({
                "run": pa.array(counted.keys(), pa.binary()), "n": pa.array(counted.values(), pa.int64())
            })

    return run


def merge_run(run: list[int], rules: dict[Pair, tuple[int, int]]) -> list[int]:
    """Apply merges ``pair -> (rank, symbol)`` to one run: lowest rank first, from left to right."""
    never = (len(rules), -1)
    while True:
        ranks = [rules.get(pair, never) for pair in zip(run, run[1:])]
        rank, made = min(ranks, default=never)
        if made < 0:
            return run
        out, i = [], 0
        while i < len(run):
            if i < len(ranks) and ranks[i][1] == made and ranks[i][0] == rank:
                out.append(made)
                i += 2
            else:
                out.append(run[i])
                i += 1
        run = out


def _merger(head: np.ndarray, rules: dict[Pair, tuple[int, int]]):
    """Words to words with the merges applied; ``was`` is the word before if that changed it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray | None] = {}
        for batch in batches:
            words = batch.column("ids")
            symbols, offsets = _flat(words)
            begins, ends = _runs(symbols, offsets, head)
            out, stay = symbols.copy(), np.ones(len(symbols) + 1, bool)
            changed = np.zeros(len(words), bool)
            word = np.searchsorted(offsets, begins, "right") - 1
            for begin, end, of in zip(begins.tolist(), ends.tolist(), word.tolist()):
                own = symbols[begin:end]
                key = own.tobytes()
                if key not in known:
                    if len(known) > RUNS_REMEMBERED:
                        known.clear()
                    made = merge_run(own.tolist(), rules)
                    known[key] = np.array(made, np.int32) if len(made) < len(own) else None
                new = known[key]
                if new is not None:
                    changed[of] = True
                    out[begin : begin + len(new)] = new
                    stay[begin + len(new) : end] = False
            before = np.concatenate(([0], np.cumsum(stay[:-1])))
            merged = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), pa.array(out[stay[:-1]]))
            was = pc.if_else(pa.array(changed), words, pa.scalar(None, words.type))
            yield pa.RecordBatch.from_arrays([merged, batch.column("n"), was], names=["ids", "n", "was"])

    return run


def _pair_sums(symbols: np.ndarray, offsets: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of neighbours in some words and their words' counts."""
    if len(symbols) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = _inside(offsets)
    return _keys(symbols)[same], np.repeat(n, np.diff(offsets))[:-1][same]


def _pair_changer(names: dict[int, str]):
    """``(l, r, n)``: pairs of the words, less those of the words that they were before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            keys, weights = _pair_sums(*_flat(batch.column("ids")), n)
            old, less = _pair_sums(*_flat(batch.column("was")), n)
            pairs, place = np.unique(np.concatenate((keys, old)), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, place, np.concatenate((weights, -less)))
            pairs, total = pairs[total != 0], total[total != 0]
            used, index = np.unique(np.concatenate((pairs >> 32, pairs & 0xFFFFFFFF)), return_inverse=True)
            shown = pa.array([names.get(i) or chr(i) for i in used.tolist()], pa.string())
            sides = [shown.take(pa.array(part)) for part in np.split(index, 2)]
            yield pa.RecordBatch.from_arrays([*sides, pa.array(total)], names=["l", "r", "n"])

    return run


# --- finding merges on counted runs -----------------------------------------------------------------


def next_merges(
    runs: list[tuple[list[int], int]],
    name: Callable[[int], str],
    known: set[str],
    last: tuple[int, str] | None,
    room: int,
    min_frequency: int,
    max_token_length: int,
    first_symbol: int,
) -> list[tuple[int, int, int, int]]:
    """Merges ``(left, right, symbol, n)`` that provably come next, at least one if there is any.

    ``runs`` hold all places of the pairs of the head. ``last`` is none if no pair is left out of it. Or else it
    has the highest count that a pair outside may have, and a bound: such pairs begin with nothing smaller, if they are
    there already. Those that merges make begin with the symbol made, or with what a pair outside begins with.
    """
    words = [run for run, _ in runs]
    counts: dict[Pair, int] = defaultdict(int)
    holders: dict[Pair, set[int]] = defaultdict(set)
    for i, (run, n) in enumerate(runs):
        for pair in zip(run, run[1:]):
            counts[pair] += n
            holders[pair].add(i)

    def entry(pair: Pair) -> tuple:
        return -counts[pair], name(pair[0]), name(pair[1]), pair

    def short(pair: Pair) -> bool:
        return max_token_length <= 0 or len(name(pair[0])) + len(name(pair[1])) <= max_token_length

    queue = [entry(pair) for pair in counts if short(pair)]
    heapq.heapify(queue)
    out: list[tuple[int, int, int, int]] = []
    symbols: dict[str, int] = {}
    made: list[str] = []
    names: dict[int, str] = {}
    outer, name = name, lambda i: names.get(i) or outer(i)
    while queue and len(out) < room:
        minus, left, right, pair = heapq.heappop(queue)
        n = counts[pair]
        if n != -minus:
            if n > 0:
                heapq.heappush(queue, entry(pair))
            continue
        if n < max(min_frequency, 1):
            break
        if out and last and not (n > last[0] or (n == last[0] and left < min(last[1], *made))):
            break
        token = left + right
        exists = token in known or token in symbols
        if exists and out:
            break
        symbol = first_symbol + len(symbols)
        symbols[token] = symbol
        names[symbol] = token
        made.append(token)
        out.append((*pair, symbol, n))
        if exists:
            break
        rule = {pair: (0, symbol)}
        fresh = set()
        for i in holders.pop(pair):
            old, weight = words[i], runs[i][1]
            new = merge_run(old, rule)
            if len(new) == len(old):
                continue
            for p in zip(old, old[1:]):
                counts[p] -= weight
            for p in zip(new, new[1:]):
                counts[p] += weight
                holders[p].add(i)
                if p[0] == symbol or p[1] == symbol:
                    fresh.add(p)
            words[i] = new
        for p in fresh:
            if short(p):
                heapq.heappush(queue, entry(p))
    return out


# --- training -----------------------------------------------------------------------------------------


class _Symbols:
    """Symbol numbers and names: code points, then merges in the order they were learned."""

    def __init__(self):
        self.names: dict[int, str] = {}
        self.numbers: dict[str, int] = {}

    def name(self, number: int) -> str:
        return self.names.get(number) or chr(number)

    def number(self, name: str) -> int:
        return ord(name) if len(name) == 1 else self.numbers[name]

    def add(self, name: str) -> int:
        """The number of a name, a new one if it has none."""
        if name not in self.numbers:
            number = FIRST_MERGE + len(self.numbers)
            self.numbers[name], self.names[number] = number, name
        return self.numbers[name]


def train_bpe(
    counts: DataFrame,
    n_merges: int,
    min_frequency: int = 0,
    max_token_length: int = 16,
    first_head: int = FIRST_HEAD,
    most_run_symbols: int = MOST_RUN_SYMBOLS,
) -> DataFrame:
    """Merge list ``(rank, left, right, token, n)`` learned from ``(piece, n)``.

    ``n`` is the count of the pair when it was merged. Stops early when no pair is left that
    is frequent and short enough. The bounds on the head and the runs change the number of rounds, never
    the result.
    """
    spark = counts.sparkSession
    counts = checkpoint(counts.where(F.length("piece") > 1).select("piece", F.col("n").cast("long").alias("n")))
    words = counts.repartition(task_count(counts, WORDS_PER_TASK)).mapInArrow(_symbol_numbers, "ids array<int>, n long")
    words = checkpoint(words.withColumn("was", F.array().cast("array<int>")))
    symbols, merges = _Symbols(), []

    def changes(changed: DataFrame) -> DataFrame:
        found = changed.mapInArrow(_pair_changer(dict(symbols.names)), "l string, r string, n long")
        return _short_enough(found, max_token_length)

    index = checkpoint(changes(words).groupBy("l", "r").agg(F.sum("n").alias("n")))
    size = first_head
    while len(merges) < n_merges:
        frequent = index.where(F.col("n") >= max(min_frequency, 1))
        best = frequent.orderBy(F.desc("n"), "l", "r").limit(size + 1).collect()
        if not best:
            break
        found = _round(words, best, size, symbols, n_merges - len(merges), min_frequency, max_token_length, most_run_symbols)
        size = found.next_size
        rules: dict[Pair, tuple[int, int]] = {}
        for left, right, n in found.merges:
            token = symbols.name(left) + symbols.name(right)
            rules[left, right] = (len(rules), symbols.add(token))
            merges.append((len(merges), symbols.name(left), symbols.name(right), token, n))
        if len(merges) >= n_merges:
            break
        words = checkpoint(
            words.where(F.size("ids") > 1).select("ids", "n").mapInArrow(_merger(found.head, rules), "ids array<int>, n long, was array<int>")
        )
        delta = changes(words.where(F.col("was").isNotNull()))
        index = checkpoint(index.unionByName(delta).groupBy("l", "r").agg(F.sum("n").alias("n")).where("n > 0"))
    return spark.createDataFrame(merges, MERGES_SCHEMA)


class _Found:
    """What a round found: its head as sorted keys, its merges, and the size of the next head."""

    def __init__(self, head: np.ndarray, merges: list[tuple[int, int, int]], next_size: int):
        self.head, self.merges, self.next_size = head, merges, next_size


def _head_keys(pairs: Sequence[Pair]) -> np.ndarray:
    return np.sort(np.array([(left << 32) | right for left, right in pairs], np.int64))


def _cut(best: list, size: int) -> tuple[list, tuple[int, str] | None]:
    """The head from the best pairs, and what is known of the best pair outside it.

    The head ends where counts change, so that all pairs of one count are in it or none; only if more than
    ``size`` pairs share the highest count does it hold the first ones of them.
    """
    if len(best) <= size:
        return best, None
    outside = best[size].n
    above = [row for row in best[:size] if row.n > outside]
    return (above, (outside, "")) if above else (best[:size], (outside, best[size - 1].l))


def _round(
    words: DataFrame, best: list, size: int, symbols: _Symbols, room: int, min_frequency: int,
    max_token_length: int, most_run_symbols: int,
) -> _Found:
    """The merges that come next, with a head no larger than its runs allow."""
    fits = True
    while size > 1 and len(best) > 1:
        head, last = _cut(best, size)
        keys = _head_keys([(symbols.number(row.l), symbols.number(row.r)) for row in head])
        runs = words.where(F.size("ids") > 1).select("ids", "n").mapInArrow(_run_counter(keys), "run binary, n long")
        runs = keep(runs.groupBy("run").agg(F.sum("n").alias("n")))
        held = (runs.agg(F.sum(F.octet_length("run"))).first()[0] or 0) // 4
        if held > most_run_symbols:
            runs.unpersist()
            size, fits = max(1, min(size, len(best)) // 4), False
            continue
        rows = [(np.frombuffer(row.run, np.int32).tolist(), row.n) for row in runs.collect()]
        runs.unpersist()
        found = next_merges(
            rows, symbols.name, set(symbols.numbers), last, room, min_frequency, max_token_length,
            FIRST_MERGE + len(symbols.numbers),
        )
        larger = 2 * size if fits and held * 4 < most_run_symbols else size
        return _Found(keys, [(left, right, n) for left, right, _, n in found], min(larger, LARGEST_HEAD))
    # The best pair alone is right without any runs.
    pair = symbols.number(best[0].l), symbols.number(best[0].r)
    return _Found(_head_keys([pair]), [(*pair, best[0].n)], 2)
